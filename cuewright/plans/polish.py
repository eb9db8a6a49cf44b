"""Clean-up of files that came from elsewhere, as one call: in full, or only their encoding and a shift of all cues.

Titles that can't be cleaned are rows of the report, with a reason; nothing of them is
written.  A dry run is the report without the delivery.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timing
from ..functions.rules import Options
from ..operators import cues as C
from ..operators import tracks
from ..sources import sinks, subtitles
from ..sources.delivery import deliver


@dataclass
class Polished:
    #: (title, text, path) of the files that change.
    files: DataFrame
    #: (title, status, reason, cues, and what was done): ``polished``, ``moved``, ``reencoded``, ``untouched`` or ``refused``.
    report: DataFrame

    def deliver(self, folder: str, suffix: str = ".srt", dry_run: bool = False, delivery: str | None = None) -> list[str]:
        """Write what changes, with backups where a file replaces itself; titles written (none in a dry run)."""
        return [] if dry_run else deliver(self.files, folder, suffix, delivery=delivery)


def _refused(files: DataFrame) -> DataFrame:
    """(title, reason) of files that don't parse cleanly or hold no cue."""
    bad = subtitles.parse_problems(files).groupBy("title").agg(F.lit("malformed").alias("reason"))
    none = files.select("title").join(subtitles.parse_cues(files).select("title").distinct(), "title", "left_anti")
    return bad.unionByName(none.join(bad, "title", "left_anti").select("title", F.lit("no-cues").alias("reason")))


def full(files: DataFrame, opt: Options = Options(), patterns: Iterable[str] | None = None) -> Polished:
    """All of clean-up on (title, text, encoding, path); the report counts what was done to each title."""
    wrong = _refused(files)
    good = files.join(wrong, "title", "left_anti")
    cues = subtitles.parse_cues(good)
    done = tracks.polished(cues, opt, patterns).withColumn("ts", timing.format_span(F.col("start_ms"), F.col("end_ms")))
    # a title that loses all its cues is an empty file, which nobody asked for
    out = good.select("title", "path").join(sinks.srt_text(done), "title").select("title", "text", "path")
    counts = tracks.polish_counts(cues, opt, patterns)
    left = done.groupBy("title").agg(F.count("*").alias("cues"))
    rows = good.select("title").join(counts, "title").join(left, "title", "left").select(
        "title", F.when(F.col("cues").isNull(), "refused").otherwise("polished").alias("status"), F.when(F.col("cues").isNull(), "nothing-left").alias("reason"), F.coalesce("cues", F.lit(0)).alias("cues"),
        *(c for c in counts.columns if c != "title"))
    return Polished(out, rows.unionByName(wrong.select("title", F.lit("refused").alias("status"), "reason"), allowMissingColumns=True))


def surgical(files: DataFrame, shift_ms: int = 0) -> Polished:
    """Only the encoding, the byte order mark, line ends and, if asked, the time of every cue: texts, line breaks and
    numbers are proved to be as they were before anything is written.

    The report has the cues that were stopped at 0 and the overlaps that this made.
    """
    wrong = _refused(files)
    good = files.join(wrong, "title", "left_anti")
    marked = F.col("text").startswith("﻿")
    plain = F.regexp_replace(F.regexp_replace("text", "^﻿", ""), "\r\n?", "\n")
    plain = F.when(plain.endswith("\n"), plain).otherwise(F.concat(plain, F.lit("\n")))
    rows = good.select("title", "path", "text", ((F.col("encoding") != "utf-8") | marked).alias("foreign"), plain.alias("plain"))
    rows = rows.withColumn("changes", F.col("foreign") | F.lit(shift_ms != 0))
    moved = tracks.shifted(rows.select("title", F.col("plain").alias("text")), shift_ms) if shift_ms else rows.select("title", F.col("plain").alias("text"))
    before, after = subtitles.parse_cues(good.select("title", "text")), subtitles.parse_cues(moved)
    differ = tracks.shift_differences(before, after, shift_ms).select("title").distinct().withColumn("differs", F.lit(True))
    stops = tracks.clamped(rows.select("title", F.col("plain").alias("text")), shift_ms)
    late = C.overlap_counts(after).join(C.overlap_counts(before).withColumnRenamed("overlaps", "were"), "title").select("title", F.greatest(F.col("overlaps") - F.col("were"), F.lit(0)).alias("new_overlaps"))
    status = F.when(F.col("differs"), "refused").when(~F.col("changes"), "untouched").otherwise("moved" if shift_ms else "reencoded")
    report = rows.select("title", "changes").join(differ, "title", "left").join(stops, "title").join(late, "title", "left").select(
        "title", status.alias("status"), F.when(F.col("differs"), "alters-more").alias("reason"), F.col("cues").cast("long").alias("cues"), F.col("clamped").cast("long").alias("clamped"), F.coalesce("new_overlaps", F.lit(0)).alias("new_overlaps"))
    out = rows.where("changes").select("title", "path").join(differ, "title", "left_anti").join(moved, "title").select("title", "text", "path")
    return Polished(out, report.unionByName(wrong.select("title", F.lit("refused").alias("status"), "reason"), allowMissingColumns=True))


def polish(files: DataFrame, opt: Options = Options(), patterns: Iterable[str] | None = None, reencode_only: bool = False, shift_ms: int = 0) -> Polished:
    """Clean-up as a user asks for it; a shift leaves all else alone, as does ``reencode_only``."""
    return surgical(files, shift_ms) if reencode_only or shift_ms else full(files, opt, patterns)
