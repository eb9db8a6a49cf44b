"""Delivery of a stream of files: each title once for each version, whatever is restarted when.

A micro-batch is a delivery named after its number.  Spark gives a batch that was not
finished again under the same number; a delivery that is done is not made again, one
that was prepared is finished, and one that failed before has changed nothing.  A
title's newest version is kept in a state table, so that a version that comes late,
in a batch of its own, does not replace a newer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..sources.delivery import deliver
from ..sources.state import StateTable


def delivered_versions(spark, folder: str) -> StateTable:  # noqa: ANN001
    """(title, version, delivery, updated_at): what a folder has been given; the time of a change is the version."""
    return StateTable(spark, f"{folder.rstrip('/')}/_delivered", ["title"], "title string, version long, delivery string", "long")


def deliver_batch(files: DataFrame, batch: int, folder: str, name: str, suffix: str = ".srt", compact_every: int = 100) -> list[str]:
    """Deliver the newest versions of (title, text, version) that the folder doesn't have; titles of the delivery.

    Of equal versions in one batch the greater text is taken, so that a batch that is repeated gives the same.
    """
    spark, at = files.sparkSession, f"{name}-{batch:012d}"
    table = delivered_versions(spark, folder)
    newest = files.select(F.col("title").cast("string").alias("title"), "text", F.col("version").cast("long").alias("version"))
    newest = newest.groupBy("title").agg(F.max(F.struct("version", "text")).alias("f")).select("title", "f.text", "f.version")
    # what this very batch has delivered before it was stopped is part of it again
    before = table.current().where(F.col("delivery") != at).select("title", F.col("version").alias("had"))
    fresh = newest.join(before, "title", "left").where("had is null or version > had").select("title", "text", "version")
    fresh = fresh.persist()
    try:
        titles = deliver(fresh, folder, suffix, delivery=at)
        table.append(fresh.select("title", "version", F.lit(at).alias("delivery"), F.col("version").alias("updated_at")), at)
    finally:
        fresh.unpersist()
    if batch and batch % compact_every == 0:
        table.compact()
    return titles


def delivering(files: DataFrame, folder: str, name: str, checkpoint: str, suffix: str = ".srt") -> DataStreamWriter:
    """A stream of (title, text, version) as deliveries to a folder; start it with the trigger you like."""
    def each(batch: DataFrame, number: int) -> None:
        deliver_batch(batch, number, folder, name, suffix)

    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
