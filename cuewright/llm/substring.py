"""Substring dedup by level-wise doubling.

Windows of words are looked at level by level: those of a first length, then of
twice that length, up to the length asked for (13 words: levels of 7 and 13, the
last one overlapping its halves).  Only windows that more than one text repeats
at a level are extended at the next, until the last level or until no candidate
is left.  At the first level only anchors, the minimisers among half-length
windows, are counted: each longer window holds one.

A word goes where it lies in a window whose words also start in a document with
a smaller id.  Equality is decided on 128-bit hashes of the words.

Null or empty texts have no words.  Rows without doc_id keep all words.  Equal
rows get equal results; rows that share an id but not a text are judged each on
its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .anchors import column, encoded, text_key
from .common import documents, map_rows, staged
from .hashing import minimisers, ngrams, signed, spans, word_bounds

LENGTH = 13
FIRST = 7


def levels(length: int, first: int = FIRST) -> list[int]:
    """Lengths that double up to ``length``: halves, rounded up, while they are no shorter than first."""
    out = [length]
    while (out[0] + 1) // 2 >= min(first, length):
        if (half := (out[0] + 1) // 2) == out[0]:
            break
        out.insert(0, half)
    return out


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(raw, np.uint8)
    a, b = word_bounds(x)
    return spans(x, a, b, 0), spans(x, a, b, 1)


def _finder(first: int, length: int) -> Callable[[], anchors.Finder]:
    def make() -> anchors.Finder:
        def find(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
            x = np.frombuffer(raw, np.uint8)
            g = ngrams(spans(x, *word_bounds(x)), first)
            pos = minimisers(g, length - first + 1)
            return g[pos], pos
        return find
    return make


def _overviews(base: DataFrame) -> DataFrame:
    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            raws = [encoded(t) for t in x["text"]]
            keys, ws = [text_key(r) for r in raws], [r.split() for r in raws]
            return {"doc_id": x["doc_id"], "k1": [k[0] for k in keys], "k2": [k[1] for k in keys], "n_words": [len(w) for w in ws],
                    "whole_sha256": [hashlib.sha256(b" ".join(w)).hexdigest() for w in ws]}
        return run

    return staged(base.sparkSession, map_rows(base, make, "doc_id long, k1 long, k2 long, n_words long, whole_sha256 string"), "overviews")


def _windows(held: DataFrame, size: int, extend: int) -> DataFrame:
    """128-bit hash of each window of ``size`` words to be looked at: (h1, h2, doc_id, k1, pos).

    ``extend`` 0: windows that hold an anchor of half length; otherwise windows
    whose two parts of ``extend`` words both survived.
    """

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            out: dict[str, list] = {n: [] for n in ("h1", "h2", "doc_id", "k1", "pos")}
            for d, k, t, at in zip(x["doc_id"], x["k1"], x["text"], x["at"], strict=True):
                a, b = _word_hashes(encoded(t))
                n = len(a) - size + 1
                if n <= 0:
                    continue
                at = np.array(at, np.int64)
                if extend:
                    alive = np.zeros(len(a) + size, bool)
                    alive[at] = True
                    pos = np.flatnonzero(alive[:n] & alive[size - extend : size - extend + n])
                else:
                    half = (size + 1) // 2
                    delta = np.zeros(n + 1, np.int64)
                    np.add.at(delta, np.clip(at - (size - half), 0, n), 1)
                    np.add.at(delta, np.clip(at + 1, 0, n), -1)
                    pos = np.flatnonzero(np.cumsum(delta)[:n] > 0)
                h1, h2 = ngrams(a, size), ngrams(b, size)
                for name, v in zip(out, (signed(h1[pos]), signed(h2[pos]), np.full(len(pos), d), np.full(len(pos), k), pos), strict=True):
                    out[name].append(v)
            return {n: column(v) for n, v in out.items()}
        return run

    return map_rows(held, make, "h1 long, h2 long, doc_id long, k1 long, pos long")


def removed_words(docs: DataFrame, length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, removed): removed are word positions, as runs with end exclusive."""
    base = documents(docs)
    over = _overviews(base)
    kinds = anchors.classes(over)
    steps = levels(length, first)
    finder = _finder(steps[0], steps[1] if len(steps) > 1 else steps[0])
    held = anchors.anchored_texts(base, finder, False, kinds)
    texts, extend = held.select("doc_id", "k1", "text"), 0
    for size in steps[1:] or steps:
        seen = _windows(held, size, extend)
        starts = seen.groupBy("h1", "h2").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest")).where("lowest < highest")
        starts = staged(docs.sparkSession, starts.select("h1", "h2", "lowest"), f"repeated{size}")
        again = seen.join(starts, ["h1", "h2"])
        if size == length:
            again = again.where("lowest < doc_id")
        at = staged(docs.sparkSession, again.groupBy("doc_id", "k1").agg(F.sort_array(F.collect_set("pos")).alias("at")), f"alive{size}")
        held = texts.join(at, ["doc_id", "k1"])
        if at.isEmpty():
            break
        extend = size

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            n, sha, runs = [], [], []
            for t, at in zip(x["text"], x["at"], strict=True):
                ws = encoded(t).split()
                delta = np.zeros(len(ws) + 1, np.int64)
                delta[np.array(at)] += 1
                np.add.at(delta, np.minimum(np.array(at) + length, len(ws)), -1)
                gone = np.cumsum(delta)[: len(ws)] > 0
                n.append(int(gone.sum()))
                sha.append(hashlib.sha256(b" ".join([w for w, g in zip(ws, gone.tolist(), strict=True) if not g])).hexdigest())
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                runs.append([{"start": int(a), "stop": int(b)} for a, b in edge.reshape(-1, 2)])
            return {"doc_id": x["doc_id"], "k1": x["k1"], "n_removed": n, "kept_sha256": sha, "removed": runs}
        return run

    cut = map_rows(held, make, "doc_id long, k1 long, n_removed long, kept_sha256 string, removed array<struct<start:long,stop:long>>")
    cut = staged(docs.sparkSession, cut.dropDuplicates(["doc_id", "k1"]), "cut")
    later = staged(docs.sparkSession, over.join(kinds, ["k1", "k2"]), "classed")
    whole = F.coalesce(F.col("doc_id") > F.col("rep"), F.lit(False)) & (F.col("n_words") >= length)
    all_gone = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("stop")))
    return later.join(cut, ["doc_id", "k1"], "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(whole, all_gone).otherwise(F.coalesce("removed", F.array().cast("array<struct<start:bigint,stop:bigint>>"))).alias("removed"),
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")
