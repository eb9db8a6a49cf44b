"""Findings of a built target: on its own text, against its manifest, and against the source."""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.rules import Options, Pack, contains_term
from .cues import exploded, finding, first_misnumbered, union_all

OVERLAP_MS = 50
LINE_SLACK = 3
CPS_FLOOR_MS = 100


def target_findings(cues: DataFrame, pack: Pack, opt: Options = Options(), allowed: DataFrame | None = None) -> DataFrame:
    """Rules on each cue; ``allowed`` (title, num, phrases) are source phrases that may stay."""
    t = F.col("text")
    flat = X.plain(t)
    prev = F.lag("end_ms").over(Window.partitionBy("title").orderBy("pos"))
    rows = cues.withColumn("prev_end", prev)
    rows = rows.join(allowed, ["title", "num"], "left") if allowed is not None else rows.withColumn("phrases", F.lit(None).cast("array<string>"))
    dur = F.col("end_ms") - F.col("start_ms")
    speed = X.cps(t, dur, CPS_FLOOR_MS)
    bi, ei = X.tag_counts(t, "i")
    bb, eb = X.tag_counts(t, "b")
    said = X.said_lines(t)
    found = [
        finding("HARD", "mojibake", X.has_mojibake(t)), finding("HARD", "literal-escape", X.has_literal_escape(t)), finding("HARD", "unbalanced-tag", (bi != ei) | (bb != eb)),
        finding("SOFT", "overlap", F.col("start_ms") < F.col("prev_end") - OVERLAP_MS), finding("SOFT", "short", dur < opt.min_duration_ms),
        finding("SOFT", "lines", F.size(said) > opt.max_lines), finding("SOFT", "long-line", X.widest(t) > opt.max_cpl + LINE_SLACK),
        finding("SOFT", "cps-hard", speed > opt.hard_cps), finding("SOFT", "cps-target", (speed > opt.max_cps) & (speed <= opt.hard_cps)),
    ]

    def hit(severity: str, rule: str, c: Column) -> Column:
        return finding(severity, rule, c.isNotNull(), c)

    if pack.banned or pack.phrases:
        found.append(hit("HARD", "banned", pack.banned_hit(flat)))
    for e in pack.exempt:  # each term is said once a cue
        found.append(hit("HARD", "banned-context", Pack(exempt=(e,)).exempt_violation(flat)))
    if pack.leftover:
        found.append(hit("HARD", "leftover", pack.leftover_hit(t, F.col("phrases"))))
    if pack.caution:
        found.append(hit("SOFT", "caution", pack.caution_hit(flat)))
    numbering = first_misnumbered(cues).select("title", "num", F.lit("HARD").alias("severity"), F.lit("numbering").alias("rule"), F.col("place").cast("string").alias("detail"))
    return exploded(rows, found).unionByName(numbering)


def _rows(df: DataFrame, rule: str, severity: str = "HARD", num: str = "num", detail: Column | None = None) -> DataFrame:
    return df.select("title", F.col(num).cast("int").alias("num"), F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), (detail if detail is not None else F.lit("")).cast("string").alias("detail"))


def manifest_findings(target: DataFrame, made: DataFrame, source: DataFrame, pack: Pack | None = None, marker: str = Options.inaudible) -> DataFrame:
    """Target against manifest and source: lost and extra cues, timestamps, coverage, tags, numbers, markers, names.

    ``marker`` is what a target says where the source couldn't be heard.

    source needs droppable and inaudible.
    """
    kept = made.where("not drop").select("title", F.col("out").alias("num"), "src", F.col("ts").alias("want"))
    both = kept.join(target.select("title", "num", "ts", "text"), ["title", "num"], "full_outer")
    src = made.select("title", "out", "drop", F.explode("src").alias("n"))
    s = source.select("title", F.col("num").alias("n"), F.col("text").alias("said"), "droppable", "inaudible")
    seen = src.groupBy("title", F.col("n")).agg(F.count("*").alias("times"), F.bool_or("drop").alias("dropped"))
    cover = s.join(seen, ["title", "n"], "left")
    pairs = src.where("not drop").join(s, ["title", "n"]).groupBy("title", F.col("out").alias("num")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "said"))), lambda x: x["said"]), "\n").alias("said"), F.bool_or("inaudible").alias("inaudible"))
    pairs = pairs.join(target.select("title", "num", "text"), ["title", "num"])
    a, b = X.n_numbers(F.col("said")), X.n_numbers(F.col("text"))
    out = [
        _rows(both.where("text is null and want is not null"), "lost-cue"), _rows(both.where("want is null"), "manifest-count"),
        _rows(both.where("ts <> want"), "ts-differs", detail=F.col("want")), _rows(cover.where("times > 1"), "covered-twice", num="n"),
        _rows(cover.where("times is null"), "unaccounted", num="n"), _rows(cover.where("dropped and not droppable"), "dropped-not-droppable", num="n"),
        _rows(pairs.where(X.tag_multiset(F.col("said")) != X.tag_multiset(F.col("text"))), "tag-set-differs"),
        _rows(pairs.where((a > 0) & (F.abs(a - b) >= 2)), "digit-drift", "SOFT", detail=F.concat_ws("/", a, b)),
        _rows(pairs.where(F.col("inaudible") & ~F.contains(F.col("text"), F.lit(marker))), "inaudible-marker", "SOFT", detail=F.lit(marker)),
    ]
    if pack:
        for have, want in pack.entities:
            out.append(_rows(pairs.where(contains_term(F.col("said"), have) & ~contains_term(F.col("text"), want)), "entity-missing", "SOFT", detail=F.lit(want)))
    return union_all(out)


def _matched(target: DataFrame, source: DataFrame) -> DataFrame:
    """(title, num, place, bad): each target cue up to the first bad one of its title, with the place in the source's
    order that it takes: the nearest behind the one before that has its timestamp line.

    Where a title's lines come once in its source, windows decide.  The others are
    walked with an index of each line's places, searched for the next one: in a
    task a title, whose memory holds the numbers of places and cues, not their texts.
    """
    by_pos = Window.partitionBy("title").orderBy("pos")
    s = source.select("title", "ts", F.row_number().over(by_pos).alias("place"))
    lines = s.groupBy("title", "ts").agg(F.count("*").alias("times"), F.min("place").alias("place"))
    t = target.select("title", "num", "ts", F.row_number().over(by_pos).alias("k")).join(lines, ["title", "ts"], "left")
    t = t.withColumn("often", F.max(F.coalesce("times", F.lit(0)) > 1).over(Window.partitionBy("title")))

    before = F.max("place").over(Window.partitionBy("title").orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
    once = t.where("not often").withColumn("bad", F.col("place").isNull() | F.coalesce(F.col("place") <= before, F.lit(False)))
    upto = F.sum(F.col("bad").cast("int")).over(Window.partitionBy("title").orderBy("k"))
    once = once.withColumn("upto", upto).where((F.col("upto") == 0) | (F.col("bad") & (F.col("upto") == 1))).select("title", "num", "place", "bad")

    again = t.where("often")
    indexed = s.join(again.select("title", "ts").distinct(), ["title", "ts"], "left_semi")
    number = dict(target.dtypes)["num"]
    both = indexed.select("title", "ts", "place", F.lit(None).cast(number).alias("num")).unionByName(again.select("title", "ts", F.col("k").alias("place"), "num"))

    def walk(rows: pa.Table) -> pa.Table:
        index: dict[str, list[int]] = {}
        cues, at, out = [], 0, []
        for place, num, ts in sorted(zip(*(rows[c].to_pylist() for c in ("place", "num", "ts")), strict=True), key=lambda r: r[0]):
            if num is None:
                index.setdefault(ts, []).append(place)
            else:
                cues.append((num, ts))
        for num, ts in cues:
            own = index.get(ts, [])
            i = bisect.bisect_right(own, at)
            bad = i == len(own)
            at = at if bad else own[i]
            out.append((num, None if bad else at, bad))
            if bad:
                break
        num, place, bad = zip(*out, strict=True)
        title = rows["title"].combine_chunks()[: 1]
        return pa.table({"title": pa.array(title.to_pylist() * len(out), title.type), "num": pa.array(num, rows.schema.field("num").type), "place": pa.array(place, pa.int32()), "bad": pa.array(bad)})

    walked = both.groupBy("title").applyInArrow(walk, f"title {dict(t.dtypes)['title']}, num {number}, place int, bad boolean")
    return once.unionByName(walked)


def ordered_timestamps(target: DataFrame, source: DataFrame) -> DataFrame:
    """Without a manifest: target timestamps must be an ordered part of the source's; the first of each title that isn't."""
    return _rows(_matched(target, source).where("bad"), "ts-not-in-order")


def dropped_dialogue(target: DataFrame, source: DataFrame) -> DataFrame:
    """Without a manifest: source cues at places that the target doesn't take and that may not be dropped."""
    taken = _matched(target, source).where("not bad").select("title", "place")
    rows = source.withColumn("place", F.row_number().over(Window.partitionBy("title").orderBy("pos")))
    return _rows(rows.where("not droppable").join(taken, ["title", "place"], "left_anti"), "dialogue-dropped")


def source_findings(files: DataFrame, problems: DataFrame, sources: DataFrame, standalone: bool = False, marker: str = Options.inaudible) -> DataFrame:
    """(title, num, severity, rule, detail) of target files (title, text) as wholes; ``sources`` has the titles with a source.

    Encoding slips, speaker labels and bracket tags are said once a file, wherever in
    it they are; the inaudible marker of the language is no bracket tag.
    """
    t = F.col("text")
    one = lambda when, rule, severity="HARD": _rows(files.where(when).withColumn("num", F.lit(None)), rule, severity)
    whole = [
        one(t.startswith("\ufeff"), "bom"), one(X.has_mojibake(t), "mojibake"), one(X.has_literal_escape(t), "literal-escape"),
        _rows(problems.groupBy("title").agg(F.count("*").cast("string").alias("n")).withColumn("num", F.lit(None)), "malformed", detail=F.col("n")),
        one(t.rlike(X.LABEL), "speaker-label", "SOFT"), one((F.replace(t, F.lit(marker), F.lit("")) if marker else t).rlike(r"\[[^\]]+\]"), "bracket-tag", "SOFT"),
    ]
    alone = files.select("title").distinct().join(sources.select("title").distinct(), "title", "left_anti").withColumn("num", F.lit(None))
    whole.append(_rows(alone, "standalone" if standalone else "missing-source", "SOFT" if standalone else "HARD"))
    return union_all(whole)
