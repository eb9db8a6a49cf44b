"""Operators on cues (title, pos, num, start_ms, end_ms, text): classes, slices, findings, statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.rules import Options
from .tracks import boilerplate

#: A silence to be looked at, and how many of a title are said.
SILENCE_MS, SILENCES = 120_000, 5


def by_title() -> WindowSpec:
    return Window.partitionBy("title").orderBy("pos")


def classified(cues: DataFrame) -> DataFrame:
    t = F.col("text")
    return cues.withColumns({"speaker": X.speaker(t), "sound": X.is_sound(t), "inaudible": X.is_inaudible(t), "bleep": X.is_bleep(t)})


def class_counts(cues: DataFrame) -> DataFrame:
    return cues.groupBy("title").agg(F.count("*").alias("n"), *(F.count_if(c).alias(c) for c in ("sound", "inaudible", "bleep")), F.count_if(F.col("speaker").isNotNull()).alias("speaker"))


def duplicate_numbers(cues: DataFrame, key: str = "num") -> DataFrame:
    return cues.groupBy("title", key).agg(F.count("*").alias("n")).where("n > 1")


def sliced(cues: DataFrame, parts: int) -> DataFrame:
    """Contiguous parts of ceil(n / parts) cues; few cues give fewer parts."""
    n = F.count("*").over(Window.partitionBy("title"))
    return cues.withColumn("part", (F.floor((F.row_number().over(by_title()) - 1) / F.ceil(n / F.lit(parts))) + 1).cast("int"))


def slice_contract(cues: DataFrame, parts: int) -> DataFrame:
    """(title, part, lo, hi, n): numbers of each part's first and last cue, and how many it has.  Read off a part's last row, so that rows are sorted once and nothing is grouped."""
    upto = by_title().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cues.select("title", "pos", "num").withColumns({"place": F.row_number().over(by_title()), "total": F.count("*").over(Window.partitionBy("title"))})
    rows = rows.withColumn("size", F.ceil(F.col("total") / F.lit(parts)))
    rows = rows.withColumns({"part": (F.floor((F.col("place") - 1) / F.col("size")) + 1).cast("int"), "nth": (F.col("place") - 1) % F.col("size") + 1})
    rows = rows.withColumn("first", F.last(F.when(F.col("nth") == 1, F.struct("num")), ignorenulls=True).over(upto))
    ends = rows.where("nth = size or place = total")
    return ends.select("title", "part", F.col("first.num").alias("lo"), F.col("num").alias("hi"), F.col("nth").cast("long").alias("n"))


def slice_gaps(cues: DataFrame, contract: DataFrame) -> DataFrame:
    """Cues in no slice, and in more than one: no rows prove coverage."""
    hit = cues.join(contract.select("title", "lo", "hi", "part"), "title").where("num between lo and hi").groupBy("title", "num").agg(F.count("*").alias("times"))
    return cues.select("title", "num").join(hit, ["title", "num"], "left").select("title", "num", F.coalesce("times", F.lit(0)).alias("times")).where("times <> 1")


# ---- findings ---------------------------------------------------------------------------------------------------


def finding(severity: str, rule: str, when: Column, detail: Column | str = "") -> Column:
    d = F.lit(detail) if isinstance(detail, str) else detail
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), d.cast("string").alias("detail")))


def exploded(cues: DataFrame, found: list[Column]) -> DataFrame:
    """(title, num, severity, rule, detail): one row for each finding that is not null."""
    some = cues.select("title", "num", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f"))
    return some.select("title", "num", "f.severity", "f.rule", "f.detail")


def with_previous(cues: DataFrame) -> DataFrame:
    """Valid cues with the one before each, and the text of the last one before it that says something; inverted cues take no part."""
    valid = cues.where("end_ms > start_ms")
    said = F.when(X.plain(F.col("text")) != "", F.col("text"))
    return valid.withColumns({
        "prev_end": F.lag("end_ms").over(by_title()), "prev_start": F.lag("start_ms").over(by_title()),
        "prev_text": F.last(said, ignorenulls=True).over(by_title().rowsBetween(Window.unboundedPreceding, -1))})


def first_misnumbered(cues: DataFrame) -> DataFrame:
    off = cues.withColumn("place", F.row_number().over(by_title())).where("num <> place")
    return off.groupBy("title").agg(F.min("place").alias("place"), F.min_by("num", "place").alias("num"))


def qa_findings(cues: DataFrame, opt: Options = Options(), patterns: Iterable[str] | None = None) -> DataFrame:
    """Findings of one track by itself.  One shuffle, by title: every rule but boilerplate's is a column of the same windowed rows.

    What an empty cue says is not looked at; of long silences a title's first five are said.
    """
    t = F.col("text")
    dur = F.col("end_ms") - F.col("start_ms")
    speed = X.cps(t, dur)
    gap = F.col("start_ms") - F.col("prev_end")
    rows = with_previous(cues).withColumns({"empty": X.plain(t) == "", "n_lines": F.size(X.said_lines(t)), "wide": F.array_max(F.transform(X.said_lines(t), F.length))})
    rows = rows.withColumn("silences", F.count_if(gap > SILENCE_MS).over(by_title()))
    key, prev_key = X.norm_key(t), X.norm_key(F.col("prev_text"))
    bi, ei = X.tag_counts(t, "i")
    bb, eb = X.tag_counts(t, "b")
    said = ~F.col("empty")
    found = exploded(rows, [
        finding("HARD", "non-monotonic", F.col("start_ms") < F.col("prev_start")),
        finding("HARD", "empty", F.col("empty")),
        finding("HARD", "unbalanced", said & ((bi != ei) | (bb != eb))),
        finding("HARD", "mojibake", X.has_mojibake(t)),
        finding("HARD", "literal-escape", X.has_literal_escape(t)),
        finding("SOFT", "overlap", gap < 0, (-gap).cast("string")),
        finding("SOFT", "short", dur < opt.min_duration_ms, dur.cast("string")),
        finding("SOFT", "punct-only", said & X.is_punctuation(X.untagged(t))),
        finding("SOFT", "lines", said & (F.col("n_lines") > opt.max_lines), F.col("n_lines").cast("string")),
        finding("SOFT", "long-line", said & (F.col("wide") > opt.max_cpl), F.col("wide").cast("string")),
        finding("SOFT", "cps-hard", said & (speed > opt.hard_cps)),
        finding("SOFT", "cps-target", said & (speed > opt.max_cps) & (speed <= opt.hard_cps)),
        finding("SOFT", "dup-adjacent", said & (key != "") & (key == prev_key)),
        finding("SOFT", "all-caps", said & X.is_all_caps(t)),
        finding("SOFT", "gap", (gap > SILENCE_MS) & (F.col("silences") <= SILENCES), gap.cast("string")),
    ])
    inverted = cues.where("end_ms <= start_ms").select("title", "num", F.lit("HARD").alias("severity"), F.lit("inverted").alias("rule"), F.lit("").alias("detail"))
    numbering = first_misnumbered(cues).select("title", "num", F.lit("HARD").alias("severity"), F.lit("numbering").alias("rule"), F.col("place").cast("string").alias("detail"))
    return union_all([found, inverted, numbering, boilerplate_findings(cues, opt, patterns)])


def boilerplate_findings(cues: DataFrame, opt: Options = Options(), patterns: Iterable[str] | None = None) -> DataFrame:
    """A soft finding for each cue that is boilerplate; the detail tells what clean-up does with it."""
    note = F.when(~F.col("removable"), f"below {opt.min_repeats} repeats, stays").otherwise("recurs, will be removed" if opt.strip_boilerplate else "recurs, but removal is off")
    hits = boilerplate(cues, opt.min_repeats, patterns).select("title", "pos", F.concat(X.plain(F.col("text")), F.lit(": "), note).alias("detail"))
    return cues.select("title", "pos", "num").join(hits, ["title", "pos"]).select("title", "num", F.lit("SOFT").alias("severity"), F.lit("boilerplate").alias("rule"), "detail")


def overlap_counts(cues: DataFrame) -> DataFrame:
    """(title, overlaps): cues that start before the one before them ends, out of order or not; every title has a row."""
    before = F.lag("end_ms").over(by_title())
    return cues.withColumn("late", F.coalesce(F.col("start_ms") < before, F.lit(False))).groupBy("title").agg(F.count_if("late").alias("overlaps"))


def long_gaps(cues: DataFrame, least_ms: int = SILENCE_MS, most: int = SILENCES) -> DataFrame:
    """The first few silences of each title."""
    g = with_previous(cues).withColumn("gap_ms", F.col("start_ms") - F.col("prev_end")).where(F.col("gap_ms") > least_ms)
    return g.withColumn("rank", F.row_number().over(by_title())).where(F.col("rank") <= most).select("title", "pos", "gap_ms", "rank")


def nearest_ranks(values: DataFrame, value: str, percents: Sequence[int]) -> DataFrame:
    """(title, p...) of (title, value): elements at round-half-even(percent / 100 * (n - 1)) in order; values are counted first, so a title's array is as long as its distinct values."""
    counts = values.groupBy("title", F.col(value).alias("v")).agg(F.count("*").alias("c"))
    upto, n = F.sum("c").over(Window.partitionBy("title").orderBy("v")), F.sum("c").over(Window.partitionBy("title"))
    at = counts.withColumns({"upto": upto, "n": n})
    rank = lambda p: F.rint(F.lit(p) * (F.col("n") - 1) / 100) + 1
    return at.groupBy("title").agg(*(F.min(F.when(F.col("upto") >= rank(p), F.col("v"))).alias(f"p{p}") for p in percents))


def qa_summary(cues: DataFrame, opt: Options = Options(), patterns: Iterable[str] | None = None) -> DataFrame:
    """One row a title: cues in all, the last one's end, speeds (thousandths of characters a second), line widths, durations, and
    how often each rule of readability is broken.

    Durations are those of valid cues; speeds and widths, a line each, those of valid cues that say something.
    """
    t = F.col("text")
    dur = F.col("end_ms") - F.col("start_ms")
    speed = X.cps(t, dur)
    said = X.plain(t) != ""
    lines = X.said_lines(t)
    rows = with_previous(cues).select(
        "title", dur.alias("dur"), F.when(said, F.floor(X.n_spoken(t) * 1000000 / dur).cast("long")).alias("speed"),
        F.when(said, F.transform(lines, F.length)).alias("wide"), (said & (speed > opt.hard_cps)).alias("over_hard"), (said & (speed > opt.max_cps) & (speed <= opt.hard_cps)).alias("over_target"),
        (said & (F.size(lines) > opt.max_lines)).alias("many"), (dur < opt.min_duration_ms).alias("brief"), (F.col("start_ms") < F.col("prev_end")).alias("late"))
    counts = rows.groupBy("title").agg(
        F.max("speed").alias("cps_max"), F.max(F.array_max("wide")).cast("long").alias("cpl_max"), F.count_if("over_target").alias("over_target"), F.count_if("over_hard").alias("over_hard"),
        F.coalesce(F.sum(F.size(F.filter("wide", lambda w: w > opt.max_cpl))), F.lit(0)).cast("long").alias("long_lines"), F.count_if("many").alias("many_lines"), F.count_if("brief").alias("short"),
        F.count_if("late").alias("overlaps"), F.min("dur").alias("shortest_ms"))
    out = cues.groupBy("title").agg(F.count("*").alias("n"), F.max_by("end_ms", "pos").alias("runtime_ms")).join(counts, "title", "left")
    wide = rows.select("title", F.explode(F.col("wide").cast("array<bigint>")).alias("wide"))
    for of, c, name, ps in ((rows.where("speed is not null"), "speed", "cps", (50, 90)), (wide, "wide", "cpl", (50, 90)), (rows, "dur", "dur", (50,))):
        out = out.join(nearest_ranks(of, c, ps).select("title", *(F.col(f"p{p}").alias(f"{name}_p{p}") for p in ps)), "title", "left")
    b = boilerplate(cues, opt.min_repeats, patterns).groupBy("title").agg(F.count("*").alias("boilerplate"), F.count_if("removable").alias("removable"))
    zero = [c for c in ("over_target", "over_hard", "long_lines", "many_lines", "short", "overlaps", "boilerplate", "removable")]
    return out.join(b, "title", "left").na.fill(0, zero).select("title", "n", "runtime_ms", "cps_p50", "cps_p90", "cps_max", "cpl_p50", "cpl_p90", "cpl_max", "dur_p50", "shortest_ms", *zero)


def totals(found: DataFrame) -> DataFrame:
    return found.groupBy("title").agg(F.count_if(F.col("severity") == "HARD").alias("hard"), F.count_if(F.col("severity") == "SOFT").alias("soft"))


def top_findings(found: DataFrame, severity: str, most: int) -> DataFrame:
    """The first findings of a severity in each title, by number and rule; counts are never cut."""
    w = Window.partitionBy("title").orderBy("num", "rule", "detail")
    ranked = found.where(F.col("severity") == severity).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= most).drop("rank")


def cue_at(cues: DataFrame, wanted: DataFrame) -> DataFrame:
    """The cues of (title, num) pairs, with what was asked for but isn't there as nulls."""
    return wanted.select("title", "num").distinct().join(cues, ["title", "num"], "left")


def file_findings(files: DataFrame, problems: DataFrame, cues: DataFrame) -> DataFrame:
    """(title, severity, rule, detail) of whole files (title, text, encoding): what a look at single cues can't say."""
    t = F.col("text")
    of = files.select("title", F.explode(F.filter(F.array(
        finding("HARD", "not-utf8", F.col("encoding") != "utf-8", F.col("encoding")), finding("HARD", "bom", t.startswith("\ufeff")),
        finding("HARD", "literal-escape", X.has_literal_escape(t)), finding("HARD", "mojibake", X.has_mojibake(t))), lambda x: x.isNotNull())).alias("f"))
    of = of.select("title", "f.severity", "f.rule", "f.detail")
    bad = problems.groupBy("title").agg(F.count("*").cast("string").alias("detail")).select("title", F.lit("HARD").alias("severity"), F.lit("malformed").alias("rule"), "detail")
    none = files.select("title").distinct().join(cues.select("title").distinct(), "title", "left_anti")
    return of.unionByName(bad).unionByName(none.select("title", F.lit("HARD").alias("severity"), F.lit("no-cues").alias("rule"), F.lit("").alias("detail")))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
