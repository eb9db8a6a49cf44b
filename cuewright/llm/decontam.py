"""Benchmark decontamination with an Aho-Corasick automaton.

Items and texts are normalised alike: A-Z lower-cased, words are runs of ASCII
digits and letters and of every character beyond ASCII, joined by one space.
Every window of ``window`` item words (the whole item where it has fewer) goes
into one automaton, which then reads each text once; a hit's place in the
normalised text is mapped back to words and to code points of the original.

A benchmark of up to ``block_bytes`` of text is one automaton and one pass.  A
larger one is cut into such blocks, so that an automaton's size is bounded: each
block is one more pass, and what the passes hit is united by row, with the same
result.  Null or empty texts have no words; items without id or words give no
windows; an item id that repeats is one item.  Every row of the input gives one
row, equal rows equal ones, rows without doc_id too; empty tables give none.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_rows

WINDOW = 8
BLOCK_BYTES = 8 << 20

_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def windows(item: list[bytes], n: int) -> set[bytes]:
    if not item:
        return set()
    return {b" " + b" ".join(item[i : i + n]) + b" " for i in range(max(1, len(item) - n + 1))}


def automaton(items: list[tuple[str, str]], n: int) -> ahocorasick.Automaton:
    """Values: (words in the window, item ids)."""
    owners: dict[bytes, set[str]] = {}
    for item_id, text in items:
        for w in windows(words(text), n):
            owners.setdefault(w, set()).add(item_id)
    found = ahocorasick.Automaton()
    for w, ids in owners.items():
        found.add_word(w.decode("latin-1"), (w.count(b" ") - 1, len(w), tuple(ids)))
    if owners:
        found.make_automaton()
    return found


def scan(found: ahocorasick.Automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, maximal hit runs as word positions (end exclusive), ids of items found."""
    ws = words(text)
    if not ws or not len(found):
        return len(ws), [], set()
    joined = b" " + b" ".join(ws) + b" "
    hits = list(found.iter(joined.decode("latin-1")))
    if not hits:
        return len(ws), [], set()
    starts, at = [], 0
    for w in ws:
        starts.append(at)
        at += len(w) + 1
    at_words = ((bisect_left(starts, end - size + 1), n) for end, (n, size, _) in hits)
    ids: set[str] = set()
    for _, (_, _, own) in hits:
        ids.update(own)
    return len(ws), _united([(a, a + n) for a, n in at_words]), ids


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word runs as code point spans of the text as it was."""
    raw = text.encode("utf-8", "surrogatepass")
    flat, spans, i, n = raw.translate(_TO_WORDS), [], 0, -1
    wanted = {a: b for a, b in runs}
    begin = stop = None
    for w in flat.split():
        n += 1
        i = flat.index(w, i)
        if n in wanted:
            begin, stop = i, wanted[n]
        i += len(w)
        if begin is not None and n + 1 == stop:
            spans.append((len(raw[:begin].decode("utf-8", "surrogatepass")), len(raw[:i].decode("utf-8", "surrogatepass"))))
            begin = None
    return spans


def _blocks(benchmark: DataFrame, size: int) -> Iterator[list[tuple[str, str]]]:
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t"))
    for r in rows.where("i is not null and t is not null").toLocalIterator():
        if block and held + len(r.t) > size:
            yield block
            block, held = [], 0
        block.append((r.i, r.t))
        held += len(r.t) + 16
    yield block


_HITS = "n_hit long, item_ids array<string>, spans array<struct<start:long,stop:long>>"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id or the columns to keep, n_words, n_hit, item_ids, spans): spans are code points of the original text, end exclusive."""
    base, spark = docs.select(*dict.fromkeys((*keep, "doc_id", "text"))) if keep else documents(docs), docs.sparkSession
    keep = keep or ("doc_id",)
    blocks = [spark.sparkContext.broadcast(block) for block in _blocks(benchmark, block_bytes)]
    if len(blocks) == 1:
        return _scanned(base, blocks[0], window, keep).drop("runs")
    key = ["doc_id", "text_key"]
    keyed = base.withColumn("text_key", _text_key(F.col("text")))
    hits = reduce(DataFrame.unionByName, (_scanned(keyed, block, window, key).where("n_hit > 0") for block in blocks))
    # rows equal in key and text are equal in their hits, and meet them all again below
    hits = hits.groupBy(*key).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs"))
    hits = hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "item_ids", "runs")
    met = keyed.join(hits, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key")), "left")

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            runs = [_united([(r["a"], r["b"]) for r in rs or ()]) for rs in x["runs"]]
            return {"n_words": [len(words(t)) for t in x["text"]], "n_hit": [sum(b - a for a, b in r) for r in runs],
                    "item_ids": [i or [] for i in x["item_ids"]], "spans": [_structs(t, r) for t, r in zip(x["text"], runs, strict=True)]}
        return run

    return map_rows(met.select(*dict.fromkeys((*keep, "text")), F.col("item_ids"), F.col("runs")), make, f"n_words long, {_HITS}", keep=keep)


def _text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _structs(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "stop": b} for a, b in original_spans(text, runs)] if runs else []


def _scanned(base: DataFrame, items, window: int, keep: Sequence[str]) -> DataFrame:
    def make() -> Callable[[dict], dict]:
        found = automaton(items.value, window)

        def run(x: dict) -> dict:
            got = [scan(found, t) for t in x["text"]]
            return {
                "n_words": [g[0] for g in got],
                "n_hit": [sum(b - a for a, b in g[1]) for g in got],
                "item_ids": [sorted(g[2]) for g in got],
                "runs": [[{"a": a, "b": b} for a, b in g[1]] for g in got],
                "spans": [_structs(t, g[1]) for t, g in zip(x["text"], got, strict=True)],
            }
        return run

    return map_rows(base, make, f"n_words long, {_HITS}, runs array<struct<a:long,b:long>>", keep=keep)


def digest(found: DataFrame, least_items: int = 2) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("item_ids") >= least_items).alias("contaminated"),
    )
