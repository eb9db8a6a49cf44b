"""Worker batches: coverage and overlap guards, rewriting, build with a manifest, recovery, patches.

Guards give rows, not exceptions: a title with a row fails, the others go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import timing
from ..functions.rules import Options
from .cues import union_all

DROP = "<DROP>"


def _numbers(entries: DataFrame, cues: DataFrame) -> DataFrame:
    """One row for each number of an entry between the first and the last of its title's source, however far a slip of the
    pen reaches; reversed entries have none, and are problems by themselves."""
    ends = cues.groupBy("title").agg(F.min("num").alias("_low"), F.max("num").alias("_high"))
    rows = entries.join(ends, "title").withColumns({"_low": F.greatest("lo", "_low"), "_high": F.least("hi", "_high")}).where("_low <= _high")
    return rows.withColumn("num", F.explode(F.sequence("_low", "_high"))).drop("_low", "_high")


def _ends(ranges: DataFrame, *by: str, **levels: Column) -> DataFrame:
    """Where ranges lo to hi begin and have ended: (by, at, levels), each level up by so much and down again."""
    edge = lambda at, sign: F.struct(at.cast("long").alias("at"), *((sign * c).cast("long").alias(n) for n, c in levels.items()))
    ok = ranges.where("hi >= lo")
    return ok.select(*by, F.explode(F.array(edge(F.col("lo"), 1), edge(F.col("hi").cast("long") + 1, -1))).alias("e")).select(*by, "e.*")


def _swept(ends: DataFrame, *by: str) -> DataFrame:
    """(by, lo, hi, levels): stretches over which every level, the sum of its ups and downs, stays as it is.

    ``ends`` are dealt by title, which serves all that is grouped by title and more.
    """
    levels = [c for c in ends.columns if c not in (*by, "at")]
    at = ends.groupBy(*by, "at").agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in levels))
    w = Window.partitionBy(*by).orderBy("at")
    return at.select(*by, F.col("at").alias("lo"), (F.lead("at").over(w) - 1).alias("hi"), *(F.sum(c).over(w).alias(c) for c in levels)).where("hi is not null")


def overlaps(entries: DataFrame) -> DataFrame:
    """(title, num, upto, kind, files): numbers that two entries hold, in one file or in several; neighbours that the same
    entries hold are one row.  Ranges are swept, not written out."""
    number = dict(entries.dtypes)["lo"]
    own = _swept(_ends(entries.select("title", "file", "lo", "hi").repartition("title"), "title", "file", n=F.lit(1)), "title", "file").where("n > 0")
    both = _swept(_ends(own, "title", n=F.col("n"), files=F.lit(1)), "title").where("n > 1")
    return both.select("title", F.col("lo").cast(number).alias("num"), F.col("hi").cast(number).alias("upto"), F.when(F.col("files") > 1, "two-files").otherwise("same-file").alias("kind"), "files")


def coverage(cues: DataFrame, entries: DataFrame) -> DataFrame:
    """(title, num, upto, kind): source numbers without entry, each a row, and runs of entry numbers without source."""
    number = dict(cues.dtypes)["num"]
    source = _ends(cues.select("title", F.col("num").alias("lo"), F.col("num").alias("hi")), "title", source=F.lit(1))
    parts = _swept(source.unionByName(_ends(entries, "title", n=F.lit(1)), allowMissingColumns=True).repartition("title"), "title")
    parts = parts.withColumn("kind", F.when((F.col("source") > 0) & (F.col("n") == 0), "missing").when((F.col("source") == 0) & (F.col("n") > 0), "extra"))
    w = Window.partitionBy("title").orderBy("lo")
    fresh = (F.col("kind") == "missing") | ~F.lag("kind").over(w).eqNullSafe(F.col("kind"))
    runs = parts.withColumn("run", F.sum(F.coalesce(fresh, F.lit(True)).cast("int")).over(w)).where("kind is not null")
    return runs.groupBy("title", "run", "kind").agg(F.min("lo").cast(number).alias("num"), F.max("hi").cast(number).alias("upto")).select("title", "num", "upto", "kind")


def consolidated(entries: DataFrame) -> DataFrame:
    """(title, head, text) in numeric order of heads."""
    return entries.select("title", "lo", X.head(F.col("lo"), F.col("hi")).alias("head"), "text")


def with_droppable(cues: DataFrame, allowed: DataFrame, opt: Options = Options()) -> DataFrame:
    """Add droppable and drop_reason: sound cues where the option says so, and allowed numbers.  Defined once."""
    a = allowed.groupBy("title", "num").agg(F.first("reason").alias("allow_reason"), F.lit(True).alias("allowed"))
    ok = F.coalesce("allowed", F.lit(False))
    sound = F.col("sound") & F.lit(opt.drop_pure_sound)
    return cues.join(a, ["title", "num"], "left").withColumns({
        "droppable": sound | ok, "drop_reason": F.when(ok, F.coalesce(F.nullif("allow_reason", F.lit("")), F.lit("allowed"))).when(sound, "sound")}).drop("allowed", "allow_reason")


def _spans(cues: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries with the positions of their ends."""
    a = cues.select("title", F.col("num").alias("lo"), F.col("pos").alias("pos_lo"), F.col("ts").alias("ts_lo"))
    b = cues.select("title", F.col("num").alias("hi"), F.col("pos").alias("pos_hi"), F.col("ts").alias("ts_hi"))
    return entries.join(a, ["title", "lo"], "left").join(b, ["title", "hi"], "left")


def build_problems(cues: DataFrame, entries: DataFrame, opt: Options = Options()) -> DataFrame:
    """(title, num, rule) for all that must not be built; cues need droppable and speaker."""
    e = _spans(cues, entries)
    body = F.btrim("text")
    single = [
        (~F.lit(opt.allow_merge) & (F.col("lo") != F.col("hi")), "merge-not-allowed"), (F.col("pos_lo").isNull() | F.col("pos_hi").isNull(), "unknown-cue"),
        (F.col("pos_hi") < F.col("pos_lo"), "reversed"), ((F.col("lo") != F.col("hi")) & (F.col("pos_hi") - F.col("pos_lo") != F.col("hi") - F.col("lo")), "not-contiguous"),
        ((F.col("lo") != F.col("hi")) & (body == DROP), "drop-merged"), (body == "", "empty"),
        ((body != DROP) & F.regexp_replace("text", r"^\n+|\n+\z", "").rlike(r"\n[ \t]*\n"), "blank-line"),
        ((body != DROP) & (F.size(F.filter(F.split(X.wrap(F.col("text"), opt.max_cpl), "\n"), lambda x: F.btrim(x) != "")) > opt.max_lines), "too-many-lines"),
    ]
    rows = e.select("title", F.col("lo").alias("num"), F.explode(F.filter(F.array(*(F.when(c, r) for c, r in single)), lambda x: x.isNotNull())).alias("rule"))
    inside = _numbers(entries, cues).select("title", "lo", "hi", "num", "text").join(cues.select("title", "num", "speaker", "droppable"), ["title", "num"])
    speakers = inside.where("lo <> hi").groupBy("title", F.col("lo").alias("num")).agg(F.count_distinct(F.coalesce("speaker", F.lit(""))).alias("s")).where("s > 1")
    dropped = inside.where((F.btrim("text") == DROP) & ~F.col("droppable"))
    twice = overlaps(entries)
    lost = coverage(cues, entries).where("kind = 'missing'")
    return union_all([rows, speakers.select("title", "num", F.lit("two-speakers").alias("rule")), dropped.select("title", "num", F.lit("drop-not-allowed").alias("rule")),
                      twice.select("title", "num", F.lit("covered-twice").alias("rule")), lost.select("title", "num", F.lit("unaccounted").alias("rule"))])


def manifest(cues: DataFrame, entries: DataFrame, opt: Options = Options()) -> DataFrame:
    """Lineage of a build: (title, out, src, ts, text, src_hash, tgt_hash, drop, reason), out null where dropped.

    Entries are taken in source order and renumbered; a merged entry runs from
    its first cue's start to its last cue's end.
    """
    e = _spans(cues, entries)
    src = _numbers(entries, cues).select("title", "lo", "num").join(cues.select("title", "num", "pos", F.col("text").alias("said"), "drop_reason"), ["title", "num"])
    src = src.groupBy("title", "lo").agg(F.array_sort(F.collect_list(F.struct("pos", "num", "said", "drop_reason"))).alias("s"))
    e = e.join(src, ["title", "lo"]).withColumn("drop", F.btrim("text") == DROP)
    kept = F.when(~F.col("drop"), F.lit(1)).otherwise(0)
    body = X.wrap(F.regexp_replace("text", r"^\n+|\n+\z", ""), opt.max_cpl)
    said = F.array_join(F.transform("s", lambda x: F.regexp_replace(x["said"], "\n", " ")), " ")
    keep = lambda c: F.when(~F.col("drop"), c)
    return e.select(
        "title", keep(F.sum(kept).over(Window.partitionBy("title").orderBy("pos_lo"))).cast("int").alias("out"), F.transform("s", lambda x: x["num"]).alias("src"),
        keep(F.when(F.col("lo") == F.col("hi"), F.col("ts_lo")).otherwise(timing.merged_span(F.col("ts_lo"), F.col("ts_hi")))).alias("ts"),
        keep(body).alias("text"), keep(X.content_hash(said)).alias("src_hash"), keep(X.content_hash(body)).alias("tgt_hash"), "drop",
        F.when(F.col("drop"), F.get("s", F.lit(0))["drop_reason"]).alias("reason"))


def built(made: DataFrame) -> DataFrame:
    """Cues (title, pos, num, ts, text, start_ms, end_ms) of a manifest."""
    a, z = timing.span_bounds(F.col("ts"))
    return made.where("not drop").select("title", F.col("out").alias("pos"), F.col("out").alias("num"), "ts", "text", a.alias("start_ms"), z.alias("end_ms"))


def header(made: DataFrame, opt: Options, config_version: str) -> DataFrame:
    return made.groupBy("title").agg(F.lit(1).alias("schema"), F.count_if(~F.col("drop")).alias("kept"), F.count_if("drop").alias("dropped"),
                                     F.lit(opt.allow_merge).alias("allow_merge"), F.lit(config_version).alias("config_version"))


# ---- recovery and patches ---------------------------------------------------------------------------------------


def reconstructed(delivered: DataFrame, made: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (title, head, text) from delivered cues by the manifest, and the rows it can't place."""
    rows = made.select("title", F.col("out").alias("num"), "src", "drop")
    kept = rows.where("not drop").join(delivered.select("title", "num", F.col("text")), ["title", "num"], "left")
    head = X.head(F.array_min("src"), F.array_max("src"))
    dropped = rows.where("drop").select("title", F.array_min("src").alias("lo"), head.alias("head"), F.lit(DROP).alias("text"))
    return (kept.where("text is not null").select("title", F.array_min("src").alias("lo"), head.alias("head"), "text").unionByName(dropped),
            kept.where("text is null").select("title", "num", F.lit("lost-cue").alias("rule")))


def reconstructed_by_time(delivered: DataFrame, cues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same without a manifest, by equal timestamp lines; these must be unique on both sides, and what is absent droppable."""
    def dup(d: DataFrame) -> DataFrame:
        return d.groupBy("title", "ts").agg(F.count("*").alias("n"), F.min("num").alias("num")).where("n > 1").select("title", "num", F.lit("duplicate-timestamp").alias("rule"))

    at = cues.join(delivered.select("title", "ts", F.col("text").alias("said")), ["title", "ts"], "left")
    lost = at.where("said is null and not droppable").select("title", "num", F.lit("unaccounted").alias("rule"))
    entries = at.select("title", F.col("num").alias("lo"), F.col("num").cast("string").alias("head"), F.coalesce("said", F.lit(DROP)).alias("text"))
    return entries, union_all([dup(delivered), dup(cues), lost])


def patched(entries: DataFrame, patch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with the texts of a patch (title, head, text; the last of a head counts if line_no is there), and its unknown heads."""
    last = patch.groupBy("title", "head").agg(F.max_by("text", "line_no").alias("new")) if "line_no" in patch.columns else patch.select("title", "head", F.col("text").alias("new"))
    out = entries.join(last, ["title", "head"], "left").withColumn("text", F.coalesce("new", "text")).drop("new")
    return out, last.join(entries.select("title", "head"), ["title", "head"], "left_anti").select("title", "head")
