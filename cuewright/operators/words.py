"""Recognised words (title, pos, word, start, end in seconds) to cues: decoders' loops out, then cuts at pauses, sentences and clauses."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import text as X
from ..functions.rules import Options
from .tracks import flagged, speech_retimed

LOOP_GAP, GAP_SPLIT, MAX_CUE = 0.45, 0.65, 7.0
#: A word repeated more often than this is a decoder's loop, and so is a phrase of some words that comes so often; two of each stay.
WORDS_ALIKE, PHRASES, PHRASES_ALIKE = 4, (4, 3, 2), 4
_SENTENCE, _CLAUSE = r"[.!?…][\"'”’)]*$", r"[,;:—-][\"'”’)]*$"


# ---- loops ------------------------------------------------------------------------------------------------------


def _in_order(words: DataFrame) -> DataFrame:
    """Words with text and times in order, with ``i``, a word's number in its title, and its ``token``.

    The window asks for titles to be together and sorted, no more: words that come
    from titles dealt by title are not shuffled again.
    """
    good = words.select("title", "pos", "word", "start", "end").dropna(subset=["word", "start", "end"])
    rows = good.withColumn("i", F.row_number().over(Window.partitionBy("title").orderBy("pos"))).sortWithinPartitions("title", "pos")
    return rows.withColumn("token", X.token_key(F.col("word")))


class Unlooper:
    """Takes sorted rows batch by batch and gives those that loops leave.

    Stages follow one another: words said again and again, then phrases of each
    length.  A stage holds back the rows that it can't decide yet, a few repetitions
    at most: of a loop that goes on, those in the middle are left out at once, since
    they change nothing.  All rows that are held are in the order of the stream.
    """

    def __init__(self) -> None:
        self.held: pa.RecordBatch | None = None
        self.titles, self.stage, self.close = 0, np.zeros(0, np.int64), [np.zeros(0, bool) for _ in (1, *PHRASES)]

    def push(self, batch: pa.RecordBatch, last: bool = False) -> pa.RecordBatch:
        """Rows that are decided, with ``t``, which tells titles apart; the last batch decides all."""
        t = self.titles + np.cumsum(batch.column("i").to_numpy() == 1)
        self.titles = int(t[-1]) if len(t) else self.titles
        batch = batch.append_column("t", pa.array(t, pa.int64()))
        live = pa.Table.from_batches([b for b in (self.held, batch) if b is not None]).combine_chunks()
        code = live.column("token").combine_chunks().dictionary_encode().indices.to_numpy()
        said = pc.not_equal(live.column("token"), "").to_numpy()
        t, start, end = live.column("t").to_numpy(), *(live.column(c).cast(pa.float64()).to_numpy() for c in ("start", "end"))
        come, rest = np.arange(len(self.stage), live.num_rows), []
        for k in range(len(self.close)):
            own = self.close[k]
            at = np.r_[np.flatnonzero(self.stage == k), come]
            close = np.zeros(len(at), bool)
            close[1:] = (t[at[1:]] == t[at[:-1]]) & (start[at[1:]] - end[at[:-1]] <= LOOP_GAP)
            close[: len(own)] = own  # of rows held, what was before them may be gone
            give, hold = _phrases_once(code[at], t[at], said[at], close, PHRASES[k - 1], last) if k else _words_once(code[at], said[at], close, last)
            come, self.close[k] = at[give], close[hold]
            rest.append(at[hold])
        order = np.concatenate(rest[::-1])
        self.stage = np.concatenate([np.full(len(x), len(rest) - 1 - k) for k, x in enumerate(rest[::-1])])
        self.held = _taken(live, order)
        return _taken(live, come)


def _taken(rows: pa.Table, places: np.ndarray) -> pa.RecordBatch:
    taken = rows.take(pa.array(places, pa.int64())).combine_chunks()
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in taken.columns], schema=rows.schema)


def _words_once(code: np.ndarray, said: np.ndarray, close: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places given, places held): of a word said again and again without a pause, the first two; the last run may go on."""
    n = len(code)
    again = close & said
    again[1:] &= code[1:] == code[:-1]
    again[:1] = False
    first = np.flatnonzero(~again)
    times = np.diff(np.r_[first, n])
    nth = np.arange(n) - np.repeat(first, times)
    keep = (np.repeat(times, times) <= WORDS_ALIKE) | (nth < 2)
    done = n if last or not n else int(first[-1])
    hold = np.arange(done, n)
    return np.flatnonzero(keep[:done]), hold if len(hold) <= WORDS_ALIKE + 1 else np.r_[hold[:2], hold[1 - WORDS_ALIKE :]]


def _phrases_once(code: np.ndarray, t: np.ndarray, said: np.ndarray, close: np.ndarray, n: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places given, places held): from the start on, of a phrase of n words that comes PHRASES_ALIKE times at least, the first two.

    A word equals the one n before it in stretches; a phrase at a comes again as
    often as the stretch behind it has n words, and as no pause stands before a repetition.
    """
    size, least = len(code), n * PHRASES_ALIKE
    same = np.zeros(size + 1, np.int64)
    if size > n:
        same[n + 1 :] = np.cumsum((code[n:] == code[:-n]) & (t[n:] == t[:-n]))
    spoken = np.r_[0, np.cumsum(said)]
    a = np.arange(max(size - least + 1, 0))
    fits = (same[a + least] - same[a + n] == least - n) & (spoken[a + n] > spoken[a])
    for r in range(1, PHRASES_ALIKE):
        fits &= close[a + n * r]
    found, at, keep = np.flatnonzero(fits), 0, np.ones(size, bool)
    while (p := int(np.searchsorted(found, at))) < len(found):
        at, times = int(found[p]), PHRASES_ALIKE
        while at + n * (times + 1) <= size and close[at + n * times] and same[at + n * (times + 1)] - same[at + n * times] == n:
            times += 1
        if at + n * (times + 1) > size and not last:
            half = PHRASES_ALIKE // 2
            return np.flatnonzero(keep[:at]), np.r_[at : at + n * half, at + n * (times - PHRASES_ALIKE + half) : size]
        keep[at + 2 * n : at + n * times] = False
        at += n * times
    done = size if last else max(at, size - least + 1, 0)
    return np.flatnonzero(keep[:done]), np.arange(done, size)


def unlooped(words: DataFrame) -> DataFrame:
    """(title, pos, word, start, end) without the repeats that decoders make; words without text or times are skipped.

    Words stream through a task in order: a title's words never meet in memory, and none is shuffled more than once.
    """
    rows = _in_order(words)
    schema = rows.drop("i", "token").schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loops, batch = Unlooper(), None
        for batch in batches:
            yield loops.push(batch).select(names)
        if batch is not None:
            yield loops.push(batch.slice(0, 0), last=True).select(names)

    return rows.mapInArrow(run, schema)


# ---- cuts -------------------------------------------------------------------------------------------------------


class Cutter:
    """Cuts words into cues of at most ``most`` characters, by places on the line of their summed lengths."""

    def __init__(self, words: Sequence[str], start: np.ndarray, end: np.ndarray, most: int):
        self.n, self.most, self.start, self.end = len(words), most, start, end
        self.ends = np.cumsum([len(w) + 1 for w in words]) if words else np.zeros(0, np.int64)
        self.begins = self.ends - np.array([len(w) + 1 for w in words], np.int64)
        self.clause = np.array([bool(re.search(_CLAUSE, w)) for w in words], bool)
        self.sentence = np.flatnonzero([bool(re.search(_SENTENCE, w)) for w in words])
        self.pauses = np.flatnonzero(np.r_[False, start[1:] - end[:-1] >= GAP_SPLIT]) if self.n else np.zeros(0, np.int64)

    def size(self, a: int, b: int) -> int:
        """Characters of words a to b, b exclusive, joined by spaces."""
        return int(self.ends[b - 1] - self.begins[a] - 1)

    def _next(self, places: np.ndarray, at: int) -> int:
        i = np.searchsorted(places, at)
        return int(places[i]) if i < len(places) else self.n

    def cues(self, seen: int = 0, last: bool = True) -> list[tuple[int, int]]:
        """(first, last exclusive) of each cue; if more words may follow, of those that end whatever comes.

        ``rest`` is where the first cue that is left starts, with the number of its words that are part of it already.
        """
        out, a = [], 0  # a cue starts at a; words before ``seen`` are part of it already
        while a < self.n:
            full = max(int(np.searchsorted(self.ends, self.begins[a] + self.most + 1, side="right")), seen, a + 1)
            if full >= self.n and not last:
                break
            late = np.flatnonzero(self.end[max(seen, a + 1) : full] - self.start[a] > MAX_CUE)
            rest = min(self._next(self.pauses, max(seen, a + 1)), max(seen, a + 1) + int(late[0]) if len(late) else self.n)
            enough = int(np.searchsorted(self.ends, self.begins[a] + 1 + self.most * 0.45))
            closed = self._next(self.sentence, max(enough, max(seen - 1, a))) + 1
            stop = min(full, rest)
            if closed <= min(stop, self.n):
                cut = seen = closed
            elif full <= rest and full < self.n:
                # over budget: back to the last clause that is long enough; what follows it is carried on with the next word
                cut = full
                if full - a > 2:
                    able = np.arange(a + 1, full)
                    able = able[self.clause[able - 1] & (self.ends[able - 1] - self.begins[a] - 1 >= self.most * 0.35)]
                    cut = int(able[-1]) if len(able) else full
                seen = full + 1
            else:
                cut = seen = min(stop, self.n)
            out.append((a, cut))
            a = cut
        self.rest = a, max(seen - a, 0)
        return [piece for a, b in out for piece in self.within(a, b)]

    def within(self, a: int, b: int) -> list[tuple[int, int]]:
        """Words a to b in pieces that fit: what is carried on can be too long.

        A piece ends, of the places where it fits, at the last clause that is no
        shorter than two fifths, else at the last clause, else at the last place;
        a word that doesn't fit alone takes half of what is left with it.
        """
        out = []
        while b - a > 1 and self.size(a, b) > self.most:
            last = min(int(np.searchsorted(self.ends, self.begins[a] + 1 + self.most, side="right")), b - 1)
            clauses = a + 1 + np.flatnonzero(self.clause[a:last])
            long = clauses[self.ends[clauses - 1] - self.begins[a] - 1 >= self.most * 0.4]
            best = long if len(long) else clauses
            cut = int(best[-1]) if len(best) else last if last > a else a + max(1, (b - a) // 2)
            out.append((a, cut))
            a = cut
        return [*out, (a, b)]


def with_parts(words: DataFrame, most: int, rounds: int = 3) -> DataFrame:
    """With ``part``: cues of one part do not depend on words of another, because each part's first word starts a cue.

    A word behind a pause starts a cue unless the words before it are over the
    budget and leave a rest behind a clause.  A cue in the making has no more than
    two budgets, so that can't be if no word so near before it ends a clause (or is
    longer than the budget); nor if from the last word that starts a cue to it, itself
    included, all fits.  Each round finds words by those of the round before.
    """
    w = Window.partitionBy("title").orderBy("pos")
    rows = words.withColumn("size", F.length("word").cast("long") + 1)
    rows = rows.withColumns({"end_at": F.sum("size").over(w), "pause": F.col("start") - F.lag("end").over(w) >= GAP_SPLIT})
    clause = F.last(F.when(F.col("word").rlike(_CLAUSE) | (F.col("size") > most), F.col("end_at")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    begin = F.col("end_at") - F.col("size")
    rows = rows.withColumn("fresh", F.col("pause").isNull() | (F.col("pause") & F.coalesce(begin - clause > 2 * most + 2, F.lit(True))))
    for _ in range(rounds):
        since = F.last(F.when(F.col("fresh"), begin), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("fresh", F.col("fresh") | (F.col("pause") & (F.col("end_at") - 1 - since <= most)))
    part = F.sum(F.col("fresh").cast("int")).over(w)
    return rows.select(*words.columns, part.alias("part"))


class Cuts:
    """Takes words that loops left batch by batch and gives cues (title, pos, text, start, end).

    Of a title in the making, the words of the cue that can't be decided yet are held.
    """

    def __init__(self, most: int):
        self.most, self.t = most, None
        self._begin()

    def _begin(self) -> None:
        self.words, self.start, self.end, self.seen, self.pos = [], np.zeros(0), np.zeros(0), 0, 0

    def _cut(self, last: bool) -> Iterator[tuple]:
        cutter = Cutter(self.words, self.start, self.end, self.most)
        for a, b in cutter.cues(self.seen, last):
            text = re.sub(r"\s+", " ", " ".join(self.words[a:b]))
            if not re.fullmatch(r"[\W_]+", text):
                self.pos += 1
                yield self.title, self.pos, text, self.start[a], self.end[b - 1]
        at, self.seen = cutter.rest
        self.words, self.start, self.end = self.words[at:], self.start[at:], self.end[at:]

    def push(self, batch: pa.RecordBatch, last: bool = False) -> Iterator[tuple]:
        t, words = batch.column("t").to_numpy(), [w.strip(" \t\n\x0b\f\r") for w in batch.column("word").to_pylist()]
        start, end = (batch.column(c).cast(pa.float64()).to_numpy() for c in ("start", "end"))
        some = np.array([w != "" for w in words], bool)
        ends = np.r_[np.flatnonzero(t[1:] != t[:-1]) + 1, len(t)] if len(t) else []
        for a, b in zip([0, *ends[:-1]], ends, strict=False):
            if t[a] != self.t:
                yield from self._cut(True)
                self._begin()
                self.t, self.title = t[a], batch.column("title")[int(a)].as_py()
            kept = a + np.flatnonzero(some[a:b])
            self.words += [words[i] for i in kept]
            self.start, self.end = np.r_[self.start, start[kept]], np.r_[self.end, end[kept]]
        yield from self._cut(last)


def cues_of_words(words: DataFrame, opt: Options = Options()) -> DataFrame:
    """(title, pos, text, start, end) of recognised words, loops left out.

    Words stream through a task, from loops to cuts, and only cues leave it.
    """
    most = opt.max_cpl * opt.max_lines
    rows = _in_order(words)
    schema = T.StructType([rows.schema["title"], *T.StructType.fromDDL("pos int, text string, start double, end double")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loops, cuts, batch = Unlooper(), Cuts(most), None

        def made(batch: pa.RecordBatch, last: bool = False) -> pa.RecordBatch:
            cues = list(zip(*cuts.push(loops.push(batch, last), last), strict=True)) or [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(cues, arrow, strict=True)], schema=arrow)

        for batch in batches:
            yield made(batch)
        if batch is not None:
            yield made(batch.slice(0, 0), last=True)

    return rows.mapInArrow(run, schema)


def transcribed(words: DataFrame, opt: Options = Options()) -> DataFrame:
    """Words to a timed, wrapped draft without recurring boilerplate."""
    draft = speech_retimed(cues_of_words(words, opt), opt)
    if opt.strip_boilerplate:
        draft = flagged(draft, opt).where("not halluc").drop("halluc")
    return draft.withColumn("pos", F.row_number().over(Window.partitionBy("title").orderBy("pos"))).withColumn("text", X.wrap(F.col("text"), opt.max_cpl))
