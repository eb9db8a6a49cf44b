"""Suffix-array dedup of bytes by linear grouping construction.

A byte goes where it lies in a string of 400 bytes that starts at another place
too, in whichever text.  Sorting every suffix of a corpus in one array neither
fits a machine nor the time of Python code, so suffixes are sorted where they
can matter, in blocks:

1. Equal texts are one class; a class of several rows goes whole.
2. Anchors (minimisers among windows of 350 bytes, one in each window of 400)
   that no other place repeats rule out the windows they stand for.
3. What is left of a text around a repeated anchor is a segment: the bytes to
   the left that its windows reach, the anchor as one symbol, the bytes to the
   right.  Segments that are equal are one, with its number of places; a segment
   of several places repeats in all its windows.
4. The distinct segments of an anchor stand together in a block, each ended by a
   symbol of its own.  ``gsaca.suffix_array`` sorts the block; a window repeats if
   a neighbour in that order shares its 51 symbols.
5. An anchor with more distinct segments than ``MOST`` would make a block that
   grows with the input: the windows of such anchors are counted by their hash
   instead, over all tasks.

Classes, anchors and segments are told apart by 128 bits of hash (64 only pick
candidates and deal out blocks); windows in blocks are compared byte by byte.
Null texts are empty.  Equal rows get equal results, rows without doc_id too: they
count as texts like others, but are no one's first row, so what only they hold
stays.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .anchors import column, encoded, text_key
from .common import documents, map_rows, staged
from .gsaca import suffix_array
from .hashing import _sliding, join, minimisers, mix, signed, windows

LENGTH = 400
CORE = 350
#: Distinct segments of an anchor that one block may hold, and symbols of a block that is not full yet.
MOST, BLOCK = 2048, 30_000
_RANGES = "array<struct<a:int,b:int>>"


def _finder(length: int, core: int) -> Callable[[], anchors.Finder]:
    def make() -> anchors.Finder:
        def find(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
            if len(raw) < length:
                return np.zeros(0, np.uint64), np.zeros(0, np.int64)
            g = windows(np.frombuffer(raw, np.uint8), core)
            pos = minimisers(g, length - core + 1)
            return g[pos], pos
        return find
    return make


def _overviews(base: DataFrame) -> DataFrame:
    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            raws = [encoded(t) for t in x["text"]]
            keys = [text_key(r) for r in raws]
            return {"doc_id": x["doc_id"], "k1": [k[0] for k in keys], "k2": [k[1] for k in keys], "n_bytes": [len(r) for r in raws],
                    "whole_sha256": [hashlib.sha256(r).hexdigest() for r in raws]}
        return run

    return staged(base.sparkSession, map_rows(base, make, "doc_id long, k1 long, k2 long, n_bytes long, whole_sha256 string"), "overviews")


def _by_anchor(raw: bytes, at: np.ndarray, length: int, core: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window that have each anchor, of those anchors that are in ``at``.

    A window's anchor is the leftmost of its smallest values, which its bytes alone
    decide; from window to window it never moves back.
    """
    g, w = windows(np.frombuffer(raw, np.uint8), core), length - core + 1
    low, pos = _sliding(g, w, np.minimum, (1 << 64) - 1), minimisers(g, w)
    i = np.searchsorted(pos, np.arange(len(low)))
    wrong = np.flatnonzero(g[pos[i]] != low)
    while len(wrong):
        i[wrong] += 1
        wrong = wrong[g[pos[i[wrong]]] != low[wrong]]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    last, p = np.r_[first[1:], len(low)] - 1, pos[i[first]]
    wanted = np.zeros(len(g), bool)
    wanted[at] = True
    return first[wanted[p]], last[wanted[p]], p[wanted[p]]


def _segments(held: DataFrame, length: int, core: int) -> DataFrame:
    """(h, h2, s1, s2, left, right, doc_id, k1, start, n): n windows from start on have the anchor (h, h2)."""

    names = ("h", "h2", "s1", "s2", "left", "right", "doc_id", "k1", "start", "n")

    def halves(data: bytes) -> tuple[int, int]:
        d = hashlib.blake2b(data, digest_size=16).digest()
        return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            rows: list[tuple] = []
            for d, k, t, at in zip(x["doc_id"], x["k1"], x["text"], x["at"], strict=True):
                raw = encoded(t)
                for first, last, p in zip(*(v.tolist() for v in _by_anchor(raw, np.array(at, np.int64), length, core)), strict=True):
                    left, right = raw[first:p], raw[p + core : last + length]
                    one, two = halves(raw[p : p + core]), halves(b"%d:" % len(left) + raw[first : last + length])
                    rows.append((*one, *two, left, right, d, k, first, last - first + 1))
            return {n: [r[i] for r in rows] for i, n in enumerate(names)}
        return run

    return map_rows(held, make, "h long, h2 long, s1 long, s2 long, left binary, right binary, doc_id long, k1 long, start long, n int", 64)


def repeated_in_block(segments: list[tuple[tuple[int, int], bytes, bytes, int]], length: int, core: int) -> list[np.ndarray]:
    """For segments (anchor, left, right, n): which of each one's n windows another place in the block repeats.

    Bytes are symbols 0 to 255, then come anchors, then each segment's own end.
    """
    names = {h: 256 + i for i, h in enumerate(dict.fromkeys(s[0] for s in segments))}
    width, parts, starts, at = length - core + 1, [], [], 0
    for i, (h, left, right, n) in enumerate(segments):
        parts.append(np.concatenate((np.frombuffer(left, np.uint8), [names[h]], np.frombuffer(right, np.uint8), [256 + len(names) + i])).astype(np.int64))
        starts.append(np.arange(at, at + n))
        at += len(parts[-1])
    text = np.concatenate(parts)
    window = np.zeros(len(text), bool)
    window[np.concatenate(starts)] = True
    order = np.array(suffix_array(text))
    order = order[window[order]]
    same = np.ones(max(0, len(order) - 1), bool)
    for j in range(width):
        same &= text[order[1:] + j] == text[order[:-1] + j]
    again = np.zeros(len(text), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return [again[s] for s in starts]


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [{"a": int(a), "b": int(b)} for a, b in edge.reshape(-1, 2)]


def _by_suffix_arrays(distinct: DataFrame, length: int, core: int) -> DataFrame:
    """(s1, s2, ranges) of segments that are unique as wholes, from blocks of whole anchor groups."""
    schema = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("ranges", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_in_block([((r[0], r[7]), r[3], r[4], r[5]) for r in rows], length, core)
        got = [(r[1], r[2], _runs(m)) for r, m in zip(rows, found, strict=True) if r[6] == 1 and m.any()]
        return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], type=schema.field(i).type) for i in range(3)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    if len(group) > 1:
                        held += group
                        size += sum(len(r[3]) + len(r[4]) + 2 for r in group)
                    group = []
                    if size >= BLOCK:
                        yield solve(held)
                        held, size = [], 0
                group.append(row)
        if len(group) > 1:
            held += group
        if held:
            yield solve(held)

    rows = distinct.select("h", "s1", "s2", "left", "right", "n", "places", "h2")
    return rows.repartition("h").sortWithinPartitions("h", "s1", "s2").mapInArrow(run, f"s1 long, s2 long, ranges {_RANGES}")


def _by_window_hashes(distinct: DataFrame, length: int, core: int) -> DataFrame:
    """The same for anchors with very many segments: windows counted by a 128-bit hash, combined before they move."""

    def make() -> Callable[[dict], dict]:
        width = length - core

        def run(x: dict) -> dict:
            out: dict[str, list] = {n: [] for n in ("w1", "w2", "s1", "s2", "off")}
            for h, h2, s1, s2, left, right, n in zip(*(x[c] for c in ("h", "h2", "s1", "s2", "left", "right", "n")), strict=True):
                both = np.frombuffer(left + right, np.uint8)
                start = np.arange(n)
                # a window is its bytes without the anchor, the anchor, and how far behind its start that stands
                for seed, (name, anchor) in enumerate((("w1", h), ("w2", h2))):
                    salt = np.uint64(anchor & (1 << 64) - 1) + (len(left) - start).astype(np.uint64)
                    out[name].append(signed(join(windows(both, width, seed)[:n], mix(salt))))
                for name, v in (("s1", np.full(n, s1)), ("s2", np.full(n, s2)), ("off", start)):
                    out[name].append(v)
            return {n: column(v) for n, v in out.items()}
        return run

    each = map_rows(distinct, make, "w1 long, w2 long, s1 long, s2 long, off long")
    again = staged(distinct.sparkSession, each.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2"), "windows")
    hits = each.join(again, ["w1", "w2"]).groupBy("s1", "s2").agg(F.collect_set("off").alias("offs"))
    return hits.select("s1", "s2", F.transform("offs", lambda o: F.struct(o.cast("int").alias("a"), (o + 1).cast("int").alias("b"))).alias("ranges"))


def removed_bytes(docs: DataFrame, length: int = LENGTH, core: int = CORE, most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed): removed are maximal byte runs, end exclusive."""
    spark = docs.sparkSession
    base = documents(docs)
    over = _overviews(base)
    kinds = anchors.classes(over)
    finder = _finder(length, core)
    held = anchors.anchored_texts(base, finder, True, kinds)
    found = staged(spark, _segments(held, length, core), "segments")

    distinct = staged(spark, found.groupBy("h", "h2", "s1", "s2", "left", "right", "n").agg(F.count("*").alias("places")), "distinct")
    groups = distinct.groupBy("h").agg(F.count("*").alias("m"), F.min("places").alias("fewest"))
    open_groups = staged(spark, groups.where("m > 1 and fewest = 1").select("h", "m"), "groups")
    whole = distinct.where("places > 1").select("s1", "s2", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("ranges"))
    small = distinct.join(open_groups.where(F.col("m") <= most).select("h"), "h", "left_semi")
    large = distinct.join(open_groups.where(F.col("m") > most).select("h"), "h", "left_semi")
    parts = whole.unionByName(_by_suffix_arrays(small, length, core))
    if not open_groups.where(F.col("m") > most).isEmpty():
        parts = parts.unionByName(_by_window_hashes(large, length, core))
    ranges = staged(spark, parts.groupBy("s1", "s2").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "ranges")

    spots = found.select("s1", "s2", "doc_id", "k1", "start").join(ranges, ["s1", "s2"])
    spots = spots.groupBy("doc_id", "k1").agg(F.collect_list(F.struct("start", "ranges")).alias("spots"))

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            n, sha, runs = [], [], []
            for t, spots in zip(x["text"], x["spots"], strict=True):
                raw = encoded(t)
                delta = np.zeros(len(raw) + 1, np.int64)
                for s in spots:
                    for r in s["ranges"]:
                        delta[s["start"] + r["a"]] += 1
                        delta[min(len(raw), s["start"] + r["b"] - 1 + length)] -= 1
                gone = np.cumsum(delta)[: len(raw)] > 0
                n.append(int(gone.sum()))
                sha.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
                runs.append([{"start": r["a"], "stop": r["b"]} for r in _runs(gone)])
            return {"doc_id": x["doc_id"], "k1": x["k1"], "n_removed": n, "kept_sha256": sha, "removed": runs}
        return run

    cut = map_rows(held.select("doc_id", "k1", "text").join(spots, ["doc_id", "k1"]), make,
                   "doc_id long, k1 long, n_removed long, kept_sha256 string, removed array<struct<start:long,stop:long>>", 64)
    cut = staged(spark, cut.dropDuplicates(["doc_id", "k1"]), "cut")
    later = staged(spark, over.join(kinds, ["k1", "k2"]), "classed")
    all_gone = (F.col("rows") > 1) & (F.col("n_bytes") >= length)
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    one = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    return later.join(cut, ["doc_id", "k1"], "left").withColumn(
        "removed", F.when(all_gone, one).otherwise(F.coalesce("removed", none))
    ).select(
        "doc_id", "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        "removed",
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
