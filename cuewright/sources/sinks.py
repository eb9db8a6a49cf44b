"""Timed text to documents: one SRT for each title, and the proof by reading it again; ``delivery`` brings them to their place."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .delivery import deliver, opened, same_file, write_bytes  # noqa: F401  (documents and their delivery are used together)
from .subtitles import parse_cues


def srt_text(cues: DataFrame) -> DataFrame:
    """(title, text): the file of each title's cues (title, pos, ts, text), numbered from 1."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "ts", "text")))
    block = F.transform("rows", lambda x, i: F.concat((i + 1).cast("string"), F.lit("\n"), x["ts"], F.lit("\n"), x["text"], F.lit("\n")))
    return cues.groupBy("title").agg(rows.alias("rows")).select("title", F.array_join(block, "\n").alias("text"))


def written_differences(cues: DataFrame) -> DataFrame:
    """Read-after-write proof: positions whose timestamp line or text a parse of the written text doesn't give back."""
    again = parse_cues(srt_text(cues)).select("title", "pos", F.col("ts").alias("ts2"), F.col("text").alias("text2"))
    row = cues.select("title", "pos", "ts", "text")
    same: Column = F.col("ts").eqNullSafe(F.col("ts2")) & F.col("text").eqNullSafe(F.col("text2"))
    return row.join(again, ["title", "pos"], "full_outer").where(~same)


def write_tables(df: DataFrame, path: str, *by: str) -> None:
    """A new version as Parquet; inputs are never deleted."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def source_documents(cues: DataFrame) -> DataFrame:
    """(title, json): the parsed source of each title as one JSON array in order of position."""
    columns = [c for c in ("pos", "num", "ts", "text", "speaker", "sound", "inaudible", "bleep") if c in cues.columns]
    return cues.groupBy("title").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*columns)))).alias("json"))


def slice_documents(sliced: DataFrame) -> DataFrame:
    """(title, part, json): each slice's cues (number, text) as one JSON array."""
    return sliced.groupBy("title", "part").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("pos", "num", "text"))), lambda x: x.dropFields("pos"))).alias("json"))


def manifest_documents(made: DataFrame, head: DataFrame) -> DataFrame:
    """(title, json): a build's manifest, its header with all its rows in source order."""
    row = F.struct(F.array_min("src").alias("lo"), "out", "src", "ts", "src_hash", "tgt_hash", "drop", "reason")
    rows = made.groupBy("title").agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x.dropFields("lo")).alias("cues"))
    fields = [c for c in head.columns if c != "title"]
    return head.join(rows, "title").select("title", F.to_json(F.struct(*fields, "cues")).alias("json"))


def write_documents(df: DataFrame, path: str) -> None:
    """(title, json) or (title, part, json) as text files, partitioned by the other columns."""
    df.write.mode("overwrite").partitionBy(*(c for c in df.columns if c != "json")).text(path)


def write_titles(df: DataFrame, path: str) -> None:
    """(title, json) as one file for each title, ``<title>.json``, all in one folder.

    Tasks write through Arrow's file systems, as ``title_files`` does, each file under a
    hidden name first; a task that runs again puts the same files in their place.  Spark's
    own writer takes a folder, checksums and several processes of the system a title.
    """
    def run(rows: Iterator[Row]) -> None:
        store, root = opened(path)
        store.create_dir(root)
        for r in rows:
            if r["title"] is None or "/" in str(r["title"]):
                raise ValueError(f"{r['title']!r} is no name for a file")
            part = f"{root}/_{uuid.uuid4().hex}"
            write_bytes(store, part, r["json"].encode("utf-8"))
            store.move(part, f"{root}/{r['title']}.json")

    opened(path)[0].create_dir(opened(path)[1])  # no titles: an empty folder
    df.select("title", "json").foreachPartition(run)
