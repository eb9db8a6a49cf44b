"""Cue-shaped views of the star-schema tables, so that every operator has data at any scale; integers throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import timing


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tracks: durations and gaps follow from title and position, and break every timing rule somewhere."""
    w = Window.partitionBy("title").orderBy("pos")
    c = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("title"), "turn", F.col("role").alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    c = c.withColumn("pos", F.row_number().over(Window.partitionBy("title").orderBy("turn"))).withColumn("n", F.length("text"))
    k, g = (F.col("title") + F.col("pos")) % 4, (3 * F.col("title") + F.col("pos")) % 5
    dur = F.when(k == 0, F.lit(500)).when(k == 1, 100 + 20 * F.col("n")).when(k == 2, 200 + 40 * F.col("n")).otherwise(200 + 80 * F.col("n"))
    gap = F.when(g == 0, -700).when(g == 1, 0).when(g == 2, 40).when(g == 3, 2000).otherwise(130000)
    c = c.withColumns({"dur": dur.cast("long"), "gap": gap})
    start = 5000 + F.coalesce(F.sum(F.col("dur") + F.col("gap")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = c.withColumn("start_ms", start.cast("long")).withColumn("end_ms", F.col("start_ms") + F.col("dur"))
    num = F.col("pos") + F.when((F.col("title") % 7 == 0) & (F.col("pos") > 2), 1).otherwise(0)
    return c.select("title", "pos", num.cast("int").alias("num"), "speaker", "text", "start_ms", "end_ms", timing.format_span(F.col("start_ms"), F.col("end_ms")).alias("ts"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tracks of their lines."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("title"), "lang", "source", F.posexplode(F.split("text", "\n")).alias("p", "text"))
    return d.select("title", (F.col("p") + 1).alias("pos"), (F.col("p") + 1).alias("num"), "text", "lang", "source")


def spans(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """Events as intervals of each user: as long as their value says, in seconds."""
    e = read(spark, sf_dir, "events")
    # from local time to local time: the session's time zone plays no part
    start = F.floor(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))") / 1000)
    e = e.where(F.col("event_type") == kind) if kind else e
    return e.select(F.col("user_id").alias("title"), F.col("event_id").alias("id"), start.alias("start_ms"), (start + F.floor(F.col("value") * 1000)).cast("long").alias("end_ms"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("title"), F.coalesce("html", F.lit("")).alias("text"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as worker entries: four files a document, some lines missing, some in two files, some merged with the next."""
    x = lines(spark, sf_dir)
    e = x.where("(title + pos) % 11 <> 0").select("title", F.concat(F.lit("w"), F.col("pos") % 4).alias("file"), F.col("pos").alias("first_line"), F.col("num").alias("lo"), F.col("num").alias("hi"), "text")
    again = e.where("(title + lo) % 13 = 0").withColumn("file", F.concat(F.lit("w"), (F.col("lo") + 1) % 4))
    return e.unionByName(again)

