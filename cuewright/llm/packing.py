"""Best-fit packing of token sequences by patterns of lengths.

1. Each whole text becomes ids and an end id; only what is longer than the
   sequence is cut into full pieces and a rest.
2. The histogram of piece lengths (at most ``size`` numbers, however many
   pieces) goes to the driver.  Patterns of two to four lengths that fill a
   sequence but for ``SLACK`` tokens are enumerated and their repeat counts fitted
   to the histogram by non-negative least squares.  Counts are rounded by largest
   remainder: first down, then one more of each pattern, the largest remainder
   first, as long as the histogram holds its pieces.  The residual histogram, on
   the test tables under a hundred sequences, is packed best-fit, longest first.
3. The plan, again bounded by the number of lengths, is sent back; the pieces of
   each length are numbered and take the plan's places in turn.

Numbering never sorts one length in one task: pieces of a length are numbered
within hashed sub-groups, whose sizes are then summed up.  Null texts are empty
(the end id alone); repeated rows are packed each on its own.
"""

from __future__ import annotations

import itertools
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, map_rows, remembered, staged

SIZE = 2048
TOKENIZER = "word_bpe_49k.json"
#: Tokens that a pattern may leave free.
SLACK = 8
#: Bytes, about, of the chunks whose ids a Python worker remembers from task to task of this step by default; others are encoded each time.
REMEMBERED, ENTRY = 160 << 20, 170
#: Sub-groups of one length at least, and pieces that make one more.
SUBGROUPS, GROUP_ROWS = 512, 1_000_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts as little-endian bytes, remembering what each chunk between white space became.

    The vocabulary lower-cases, drops white space and cuts between letters and
    other signs before it looks at anything.  So a text's ids are those of its
    chunks in turn, and a chunk's are those of its letters and of the signs
    behind them.  Chunks not met before are encoded together and told apart by
    the offsets of their tokens.
    """

    _PARTS = re.compile(rb"([^\x00-`{-\x7f]*[a-z])([^\x00-\x20A-Za-z0-9\x7f-\xff]+)")

    def __init__(self, path: str, most: int = REMEMBERED):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.t, self.known, self.held, self.most = Tokenizer.from_file(path), {}, 0, most

    def __call__(self, texts: list[str]) -> list[bytes]:
        known, out, open_rows, new = self.known, [], [], {}
        for t in texts:
            raw = t.encode("utf-8", "replace")
            ws = (raw if b"<|" in raw else raw.lower()).split()
            ids = list(map(known.get, ws))
            gaps = [i for i, v in enumerate(ids) if v is None]
            if gaps:
                open_rows.append((ids, gaps, ws))
                new.update(dict.fromkeys(ws[i] for i in gaps))
            out.append(ids)
        before = len(known)
        self._learn(list(new))
        for ids, gaps, ws in open_rows:
            for i in gaps:
                ids[i] = known[ws[i]]
        if self.held >= self.most:
            while len(known) > before:  # the last ones learned go again
                known.popitem()
        else:
            self.held += sum(len(w) + len(known[w]) + ENTRY for w in itertools.islice(reversed(known), len(known) - before))
        return [b"".join(ids) for ids in out]

    def _learn(self, new: list[bytes]) -> None:
        known, parts = self.known, {}
        for w in new:
            if (m := self._PARTS.fullmatch(w)) and b"<|" not in w:
                parts[w] = m.groups()
        whole = {w for w in new if w not in parts}
        held = {x for two in parts.values() for x in two if x not in known} - whole
        whole |= held
        self._encode([w for w in whole if b"<|" not in w])
        for w in whole:
            if b"<|" in w:
                known[w] = np.array(self.t.encode(w.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        for w, (a, b) in parts.items():
            known[w] = known[a] + known[b]

    def _encode(self, new: list[bytes]) -> None:
        for at in range(0, len(new), 2048):
            part = new[at : at + 2048]
            said = [w.decode() for w in part]
            found = self.t.encode(" ".join(said), add_special_tokens=False)
            raw = np.array(found.ids, dtype="<u4").tobytes()
            token = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
            begin = np.cumsum([0, *(len(w) + 1 for w in said)])
            cuts = (4 * np.searchsorted(token, begin)).tolist()
            for w, a, b in zip(part, cuts, cuts[1:], strict=False):
                self.known[w] = raw[a:b]


def encoder(path: str, most: int = REMEMBERED) -> Encoder:
    """The worker's encoder, with what it remembers."""
    return remembered(path, lambda: Encoder(path, most))


def pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = 0, most: int = REMEMBERED) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, cut only where they exceed size."""
    end = int(end_id).to_bytes(4, "little")

    def make() -> Callable[[dict], dict]:
        encode = encoder(path, most)

        def run(x: dict) -> dict:
            out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for d, ids in zip(x["doc_id"], encode(x["text"]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    for n, v in zip(out, (d, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        out[n].append(v)
            return out
        return run

    return map_rows(documents(docs), make, "doc_id long, piece int, start long, length long, ids_crc32 long", remember=path)


# ---- planning, on the histogram alone ------------------------------------------------------------------------


def enumerate_patterns(count: dict[int, int], size: int) -> list[tuple[int, ...]]:
    """For each length, the fullest patterns of two, three and four lengths that start with it."""
    have = sorted(n for n, c in count.items() if c and n < size)
    found: set[tuple[int, ...]] = set()

    def below(room: int) -> int | None:
        i = bisect_right(have, room)
        return have[i - 1] if i else None

    for a in have:
        room = size - a
        if (b := below(room)) is None:
            found.add((a,))
            continue
        found.add(tuple(sorted((a, b), reverse=True)))
        seconds = {have[bisect_right(have, s) - 1] for s in (room // 2, room // 3, 2 * room // 3, room - have[0]) if bisect_right(have, s)}
        for b in seconds:
            if (c := below(room - b)) is None:
                continue
            found.add(tuple(sorted((a, b, c), reverse=True)))
            for c2 in {x for s in ((room - b) // 2, room - b - have[0]) if (x := below(s))}:
                if (d := below(room - b - c2)) is not None:
                    found.add(tuple(sorted((a, b, c2, d), reverse=True)))
    return sorted(found, reverse=True)


def fit_counts(patterns: list[tuple[int, ...]], count: dict[int, int], sweeps: int = 40) -> np.ndarray:
    """Repeats x >= 0 that minimise |A x - histogram|**2, A holding each pattern's lengths: coordinate descent."""
    lengths = {n: i for i, n in enumerate(sorted(count))}
    target = np.array([count[n] for n in sorted(count)], float)
    columns = [(np.array([lengths[n] for n in c]), np.array(list(c.values()), float)) for c in map(Counter, patterns)]
    x, rest = np.zeros(len(patterns)), target.copy()
    norms = [float(w @ w) for _, w in columns]
    for _ in range(sweeps):
        moved = 0.0
        for j, (rows, w) in enumerate(columns):
            step = max(-x[j], float(w @ rest[rows]) / norms[j])
            if step:
                x[j] += step
                rest[rows] -= step * w
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return x


def best_fit(count: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each sequence filled with the longest that still fits; equal sequences are made at once."""
    left, have, out = {n: c for n, c in count.items() if c > 0}, sorted(n for n, c in count.items() if c > 0), []
    while have:
        room, use, taken = size, [], Counter()
        while have and room >= have[0]:
            i = bisect_right(have, room) - 1
            while i >= 0 and taken[have[i]] >= left[have[i]]:
                i -= 1
            if i < 0:
                break
            use.append(have[i])
            taken[have[i]] += 1
            room -= have[i]
        times = min(left[n] // k for n, k in taken.items())
        out.append((tuple(use), times))
        for n, k in taken.items():
            left[n] -= k * times
            if not left[n]:
                have.remove(n)
    return out


def plan(count: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): together they hold every piece of the histogram once."""
    patterns = enumerate_patterns(count, size)
    left, out = Counter({n: c for n, c in count.items() if c > 0}), []
    full = {n: c for n, c in left.items() if n >= size}
    out += [((n,), c) for n, c in full.items()]
    left -= Counter(full)
    patterns = [p for p in patterns if sum(p) >= size - SLACK]
    fitted = fit_counts(patterns, dict(left)) if patterns and left else []
    times: Counter = Counter()

    def take(j: int, most: int) -> None:
        need = Counter(patterns[j])
        k = min(most, *(left[n] // q for n, q in need.items()))
        if k > 0:
            times[j] += k
            for n, q in need.items():
                left[n] -= q * k

    for j in sorted(range(len(patterns)), key=lambda j: (-sum(patterns[j]), -fitted[j])):
        take(j, int(fitted[j]))
    for j in sorted(range(len(patterns)), key=lambda j: (int(fitted[j]) - fitted[j], -sum(patterns[j]))):
        if fitted[j] > 0:
            take(j, 1)
    out += [(patterns[j], k) for j, k in times.items()]
    return out + best_fit(dict(left), size)


def places(made: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[list[int], list[tuple[int, int]]]]:
    """For each length: ranks at which a run of places starts, and the run's first sequence and offset."""
    out: dict[int, tuple[list[int], list[tuple[int, int]]]] = defaultdict(lambda: ([], []))
    used: Counter = Counter()
    base = 0
    for lengths, times in made:
        at = 0
        for n in lengths:
            starts, where = out[n]
            starts.append(used[n])
            where.append((base, at))
            used[n] += times
            at += n
        base += times
    return dict(out)


# ---- on the pieces ---------------------------------------------------------------------------------------------


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Add sequence_id and offset to (doc_id, piece, start, length, ids_crc32)."""
    spark = cut.sparkSession
    # the numbers of one length are dealt out over sub-groups, so that a length with most pieces is no single task
    groups = max(SUBGROUPS, -(-cut.count() // GROUP_ROWS))
    cut = cut.withColumn("sub", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(groups)).cast("int"))
    sizes = cut.groupBy("length", "sub").agg(F.count("*").alias("n"))
    count = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most size rows
    made = spark.sparkContext.broadcast(places(plan(count, size)))
    before = sizes.select(
        "length", "sub",
        (F.sum("n").over(Window.partitionBy("length").orderBy("sub")) - F.col("n")).alias("before"),
    )
    # at most size * groups rows; an equal row may take either of two places, so ties need no order
    ranked = cut.withColumn("within", F.row_number().over(Window.partitionBy("length", "sub").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(before, ["length", "sub"])

    def make() -> Callable[[dict], dict]:
        where = made.value

        def run(x: dict) -> dict:
            seq, off = [], []
            for n, a, b in zip(x["length"], x["before"], x["within"], strict=True):
                starts, to = where[n]
                i = bisect_right(starts, a + b) - 1
                seq.append(to[i][0] + a + b - starts[i])
                off.append(to[i][1])
            return {k: x[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")} | {"sequence_id": seq, "offset": off}
        return run

    return map_rows(ranked, make, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", 4096)


def packed_documents(docs: DataFrame, path: str | None = None, size: int = SIZE, most: int = REMEMBERED) -> DataFrame:
    return pack(staged(docs.sparkSession, pieces(docs, path or tokenizer_path(), size, most=most), "pieces"), size)
