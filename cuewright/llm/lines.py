"""Line dedup with two Bloom filters, for hashes seen once and seen twice.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.
Keys of at least ``least`` code points that two documents hold lose all their lines
but those of the document with the smallest id.

Each task keeps the distinct hashes of its documents' keys, with a mark on those that
two of them hold, and sends them by their first bits to slices of the filters.  A
slice puts each hash into the first filter or, if it is there already, or marked,
into the second.  A key of two documents is always in the second filter; of the
others only false positives are.  The second filter has BITS bits for each hash, up
to ``most_bits`` (128 MB), which is what is broadcast at most.  Lines whose hash is
in it are suspected, and only they are shuffled: as 128-bit digests, combined by task,
which confirm the repeat and give the first document.  A filter that is too full
for its input suspects more lines, up to all, at 24 bytes a line; no result changes.

Texts are shuffled once, to meet the numbers of the lines they lose.  Rows without
doc_id keep all lines and count as no document; rows that share an id are one
document, each with its own text; repeated rows get equal results.  Null and empty
texts are one empty line.  An empty table gives an empty table.  Other columns are
not read.  Very long texts are worked through in blocks of lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import encoded
from .common import _slices, documents, drop, forget, map_rows, staged
from .hashing import SPACE, mix, signed, spans

LEAST = 10
#: Slices of a filter, bits for each hash, and bits of a filter at most.
SLICES, BITS, MOST_BITS = 1 << 10, 16, 1 << 30
#: A hash sets PROBES bits of one block of 512.
PROBES, WORDS = 4, 8
#: Hashes that a task holds before it sends them, and bytes of text in a block of lines.
HELD, BLOCK_BYTES = 1 << 22, 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
U = np.uint64


class Filter:
    """Blocks of 512 bits; the hash gives the block by its bits behind the slice, the bits in it by its last 36."""

    def __init__(self, bits: int, data: bytes | None = None) -> None:
        self.words = np.zeros(bits // 64, np.uint64) if data is None else np.frombuffer(data, np.uint64)
        self.blocks = U(bits // 512)

    def _at(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # the first 10 bits choose the slice, the next 30 the block in it
        block, g = (h << U(10) >> U(34)) * self.blocks >> U(30), mix(h)
        for k in range(PROBES):
            bit = (g >> U(9 * k)) & U(511)
            yield (block * U(WORDS) + (bit >> U(6))).astype(np.int64), U(1) << (bit & U(63))

    def add(self, h: np.ndarray) -> None:
        for at, bit in self._at(h):
            np.bitwise_or.at(self.words, at, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at, bit in self._at(h):
            out &= self.words[at] & bit != 0
        return out


def slice_of(h: np.ndarray) -> np.ndarray:
    return (h >> U(54)).astype(np.int64)


def slice_bits(n: int, most_bits: int) -> int:
    """Bits of a slice for n hashes: a power of two, a block at least."""
    return max(512, min(1 << max(0, BITS * n - 1).bit_length(), most_bits) // SLICES)


def keys(texts: list[str], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row, line number, start, end) of keys that are long enough, block by block."""
    raws = [encoded(t) for t in texts]
    first = np.cumsum([0, *(len(r) + 1 for r in raws)])
    whole = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
    ends = np.flatnonzero(whole == 10)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    row = np.searchsorted(first, starts, side="right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, first[:-1])[row] if len(starts) else starts
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES)))
        x = _LOWER[whole[starts[at] : ends[to - 1] + 1]]
        a, z = starts[at:to] - starts[at], ends[at:to] - starts[at]
        solid = np.flatnonzero(~SPACE[x])
        i, j = np.searchsorted(solid, a), np.searchsorted(solid, z)
        some = np.flatnonzero(j > i)
        a, z = solid[i[some]], solid[j[some] - 1] + 1
        points = np.concatenate(([0], np.cumsum((x & 0xC0) != 0x80)))
        long = points[z] - points[a] >= least
        yield x, row[at:to][some][long], number[at:to][some][long], a[long], z[long]
        at = to


def _hashed(base: DataFrame, least: int) -> DataFrame:
    """(slice, once, twice): the distinct hashes of a task's documents by slice, and those that two of them hold."""
    schema = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(parts), return_counts=True)
        edge = np.searchsorted(h >> U(54), np.arange(SLICES + 1, dtype=np.uint64))
        own = [(s, h[a:b].tobytes(), h[a:b][n[a:b] > 1].tobytes()) for s, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*own, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        parts, held = [], 0
        for batch in batches:
            for at, n in _slices(batch, 256):
                rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for x, row, _, a, z in keys(batch.column(0).slice(at, n).to_pylist(), least):
                    rows.append(row)
                    hashes.append(spans(x, a, z))
                r, h = np.concatenate(rows), np.concatenate(hashes)
                order = np.lexsort((h, r))  # a key counts once in a document
                r, h = r[order], h[order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                parts.append(h[fresh])
                held += len(parts[-1])
                if held >= HELD:
                    yield packed(parts)
                    parts, held = [], 0
        if held:
            yield packed(parts)

    return base.select("text").mapInArrow(run, "slice int, once binary, twice binary")


def repeats_filter(base: DataFrame, least: int = LEAST, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """(slice, twice), a row for each slice of the second filter that is not empty, staged; and the bits of a slice."""
    spark = base.sparkSession
    sent = staged(spark, _hashed(base, least), "hashes")
    bits = slice_bits((sent.agg(F.sum(F.octet_length("once"))).first()[0] or 0) // 8, most_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([twice.words.tobytes()], pa.binary())], ["slice", "twice"])

        now = once = twice = None
        for batch in batches:
            for s, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if s != now:
                    if now is not None and twice.words.any():
                        yield out()
                    now, once, twice = s, Filter(bits), Filter(bits)
                h = np.frombuffer(a.as_buffer(), np.uint64)
                twice.add(h[once.has(h)])
                once.add(h)
                twice.add(np.frombuffer(b.as_buffer(), np.uint64))
        if now is not None and twice.words.any():
            yield out()

    found = sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, "slice int, twice binary")
    found = staged(spark, found, "twice")
    drop(sent)
    return found, bits


def suspected(base: DataFrame, twice: DataFrame, bits: int, least: int = LEAST) -> DataFrame:
    """(h1, h2, doc_id, k1, lines) for each key of a document whose hash is in the second filter; staged."""
    spark = base.sparkSession
    held = spark.sparkContext.broadcast({r[0]: bytes(r[1]) for r in twice.select("slice", "twice").collect()})

    def make() -> Callable[[dict], dict]:
        filters = {s: Filter(bits, v) for s, v in held.value.items()}
        none = Filter(bits, bytes(bits // 8))

        def run(x: dict) -> dict:
            out: dict[str, list] = {n: [] for n in ("h1", "h2", "row", "line")}
            for raw, row, line, a, z in keys(x["text"], least):
                h = spans(raw, a, z)
                ok, s = np.zeros(len(h), bool), slice_of(h)
                order = np.argsort(s, kind="stable")
                edge = np.flatnonzero(np.diff(s[order], prepend=-1, append=-1))
                for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    own = order[i:j]
                    ok[own] = filters.get(int(s[own[0]]), none).has(h[own])
                own = np.flatnonzero(ok)
                for n, v in zip(out, (h[own], spans(raw, a[own], z[own], 1), row[own], line[own]), strict=True):
                    out[n].append(v)
            h1, h2, row, line = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in out.values())
            order = np.lexsort((line, h2, h1, row))
            h1, h2, row, line = h1[order], h2[order], row[order], line[order]
            fresh = np.ones(len(h1), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            at = np.flatnonzero(fresh)
            lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(line)), pa.int32()), pa.array(line, pa.int32()))
            own = pa.array(row[at], pa.int64())
            return {"h1": pa.array(signed(h1[at].astype(np.uint64))), "h2": pa.array(signed(h2[at].astype(np.uint64))),
                    "doc_id": x.get("doc_id").take(own), "k1": x.get("k1").take(own), "lines": lists}
        return run

    rows = map_rows(base.where("doc_id is not null"), make, "h1 long, h2 long, doc_id long, k1 long, lines array<int>")
    rows = staged(spark, rows, "suspected")
    held.destroy()
    return rows


def deduplicated_lines(docs: DataFrame, least: int = LEAST, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): the lines that stay, joined as they were."""
    spark = docs.sparkSession
    base = documents(docs).withColumn("k1", F.xxhash64("text"))
    twice, bits = repeats_filter(base, least, most_bits)
    rows = suspected(base, twice, bits, least)
    firsts = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest")).where("lowest < highest")
    firsts = staged(spark, firsts.select("h1", "h2", "lowest"), "firsts")
    gone = rows.join(firsts, ["h1", "h2"]).where("lowest < doc_id")
    gone = staged(spark, gone.groupBy("doc_id", "k1").agg(F.flatten(F.collect_set("lines")).alias("gone")), "gone")
    drop(twice, rows, firsts)

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            text, some = x.get("text"), pc.is_valid(x.get("gone"))
            n = [len(g) if g else 0 for g in x["gone"]]
            kept = []
            for t, g in zip(text.filter(some).to_pylist(), (g for g in x["gone"] if g is not None), strict=True):
                out = set(g)
                kept.append("\n".join([line for i, line in enumerate(t.split("\n")) if i not in out]))
            return {"doc_id": x.get("doc_id"), "n_lines": pc.add(pc.count_substring(text, "\n"), 1).cast(pa.int64()), "n_dropped": n,
                    "text": pc.replace_with_mask(text, some, pa.array(kept, text.type))}
        return run

    met = base.join(gone.hint("shuffle_hash"), ["doc_id", "k1"], "left").select("doc_id", "text", "gone")
    return map_rows(met, make, "doc_id long, n_lines long, n_dropped long, text string")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
