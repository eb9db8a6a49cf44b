"""What exact substring removal shares: classes of equal texts, and anchors that other texts repeat.

An anchor is a minimiser of k-long windows among w of them, so every window of
k + w - 1 holds one, and equal windows hold equal ones.  A window can only occur
elsewhere if its anchor does; counting anchors, about 2 in w + 1 positions,
therefore replaces counting all windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, map_rows, staged
from .hashing import signed


def text_key(raw: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def classes(texts: DataFrame) -> DataFrame:
    """Of (doc_id, k1, k2): one row for each distinct text, its smallest doc_id and how many rows hold it."""
    return staged(texts.sparkSession, texts.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")), "classes")


def column(parts: Iterable[np.ndarray]) -> pa.Array:
    parts = list(parts)
    return pa.array(np.concatenate(parts).astype(np.int64, copy=False) if parts else np.zeros(0, np.int64))


#: From a text's bytes: hashes and positions of its anchors.
Finder = Callable[[bytes], tuple[np.ndarray, np.ndarray]]


def anchored_texts(base: DataFrame, finder: Callable[[], Finder], within: bool, kinds: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, text, at): the first text of each class that holds repeated anchors, and where.

    An anchor is repeated if two different texts hold it or, if ``within``, one
    text at two places; rows of equal texts count as one text, so groups of copies
    add nothing.  Anchors are written once and read twice, to count and to place them.
    """
    spark = base.sparkSession

    def make() -> Callable[[dict], dict]:
        find = finder()

        def run(x: dict) -> dict:
            out: dict[str, list] = {n: [] for n in ("h", "k1", "k2", "pos", "doc_id", "many")}
            for d, t in zip(x["doc_id"], x["text"], strict=True):
                raw = encoded(t)
                h, pos = find(raw)
                if not len(h):
                    continue
                a, b = text_key(raw)
                order = np.argsort(h, kind="stable")
                same = np.zeros(len(h) + 1, bool)
                same[1:-1] = h[order[1:]] == h[order[:-1]]
                many = np.zeros(len(h), bool)
                many[order] = same[1:] | same[:-1]
                for n, v in zip(out, (signed(h), np.full(len(h), a), np.full(len(h), b), pos, [d] * len(h), many), strict=True):
                    out[n].append(v)
            flat = {n: column(out[n]) for n in ("h", "k1", "k2", "pos")}
            flat["doc_id"] = pa.array([d for part in out["doc_id"] for d in part], pa.int64())
            return flat | {"many": pa.array(np.concatenate(out["many"]) if out["many"] else np.zeros(0, bool))}
        return run

    every = staged(spark, map_rows(base, make, "h long, k1 long, k2 long, pos long, doc_id long, many boolean"), "anchors")
    again = F.col("a") != F.col("b")
    agg = [F.min("k1").alias("a"), F.max("k1").alias("b")]
    if within:
        again, agg = again | F.col("many"), [*agg, F.max("many").alias("many")]
    repeated = staged(spark, every.groupBy("h").agg(*agg).where(again).select("h"), "repeated")
    at = every.where("doc_id is not null").join(repeated, "h").groupBy("doc_id", "k1", "k2").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    first = kinds.select("k1", "k2", F.col("rep").alias("doc_id"))
    at = staged(spark, at.join(first, ["k1", "k2", "doc_id"], "left_semi"), "places")
    drop(every, repeated)
    spoken = base.join(at, "doc_id")

    def keep() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            ok = [text_key(encoded(t)) == (a, b) for t, a, b in zip(x["text"], x["k1"], x["k2"], strict=True)]
            return {n: [v for v, y in zip(x[n], ok, strict=True) if y] for n in ("doc_id", "k1", "k2", "text", "at")}
        return run

    checked = map_rows(spoken.select("doc_id", "k1", "k2", "text", "at"), keep, "doc_id long, k1 long, k2 long, text string, at array<long>")
    return staged(base.sparkSession, checked, "candidates")
