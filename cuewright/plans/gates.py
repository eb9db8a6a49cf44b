"""The gate chain from worker batches to delivery, for all titles in one plan.

batches -> normalized -> rewritten -> built with a manifest -> findings -> gates.
A title that fails a gate is a row with its reason; the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Options, Pack, Rewrite, rewritten
from ..operators import batches, tracks, validate
from ..sources import sinks, subtitles
from ..sources.delivery import deliver
from ..sources.state import AT, StateTable

#: Fields of a title's state besides its key; ``updated_at`` is the number of the run.
STATE = "title string, status string, stage string, error string, version string"


@dataclass
class Finalized:
    manifest: DataFrame
    cues: DataFrame
    findings: DataFrame
    gates: DataFrame

    def passed(self) -> DataFrame:
        return self.gates.groupBy("title").agg(F.bool_and("passed").alias("ok")).where("ok").select("title")

    def files(self) -> DataFrame:
        """(title, text) of the titles that passed every gate."""
        return sinks.srt_text(self.cues.join(self.passed(), "title", "left_semi"))

    def states(self) -> DataFrame:
        """Status of each title: done, or built or failed with the first stage that stopped it."""
        stages = F.create_map(*(x for i, n in enumerate(("normalize", "build", "validate", "align")) for x in (F.lit(n), F.lit(i))))
        first = self.gates.groupBy("title").agg(F.min(F.when(~F.col("passed"), F.struct(stages[F.col("stage")].alias("i"), F.col("stage").alias("stage"), F.col("reason").alias("reason")))).alias("f"))
        status = F.when(F.col("f").isNull(), "done").when(F.col("f.stage") == "build", "failed").otherwise("built")
        return first.select("title", status.alias("status"), F.col("f.stage").alias("stage"), F.col("f.reason").alias("error"))


def finalize(source: DataFrame, files: DataFrame, allowed: DataFrame, pack: Pack, fixes: Sequence[Rewrite] = (), opt: Options = Options(), phrases: DataFrame | None = None) -> Finalized:
    """source: classified cues; files: (title, file, text) of worker batches; allowed: (title, num, reason)."""
    clean = files.withColumn("text", subtitles.sanitized(F.col("text")))
    entries = subtitles.batch_entries(clean)
    fixed = entries.withColumn("text", rewritten(F.col("text"), list(fixes))) if fixes else entries
    src = batches.with_droppable(source, allowed, opt)
    normal = batches.overlaps(entries).select("title", F.lit("normalize").alias("stage"), F.col("kind").alias("reason"))
    normal = normal.unionByName(batches.coverage(source, entries).select("title", F.lit("normalize").alias("stage"), F.col("kind").alias("reason")))
    wrong = batches.build_problems(src, fixed, opt).select("title", F.lit("build").alias("stage"), F.col("rule").alias("reason"))
    made = batches.manifest(src, fixed, opt)
    out = batches.built(made)
    found = validate.target_findings(out, pack, opt, phrases).unionByName(validate.manifest_findings(out, made, src, pack, opt.inaudible))
    hard = found.where("severity = 'HARD'").select("title", F.lit("validate").alias("stage"), F.col("rule").alias("reason"))
    drift = tracks.drift_windows(source.select("title", "num", "text"), fixed.where("lo = hi").select("title", F.col("lo").alias("num"), "text"))
    drift = drift.select("title", F.lit("align").alias("stage"), F.lit("drift").alias("reason"))
    failures = normal.unionByName(wrong).unionByName(hard).unionByName(drift).groupBy("title", "stage").agg(F.min("reason").alias("reason"))
    every = source.select("title").distinct().select("title", F.explode(F.array(*map(F.lit, ("normalize", "build", "validate", "align")))).alias("stage"))
    gates = every.join(failures, ["title", "stage"], "left").withColumn("passed", F.col("reason").isNull())
    return Finalized(made, out, found, gates)


def unfinished(versions: DataFrame, table: StateTable) -> DataFrame:
    """Of (title, version): what the state doesn't know as done in that version."""
    done = table.current().where("status = 'done'").select("title", "version")
    return versions.select("title", "version").join(done, ["title", "version"], "left_anti")


def resumed(versions: DataFrame, table: StateTable, run: int, work: Callable[[DataFrame], Finalized], folder: str, suffix: str = ".srt") -> list[str]:
    """One run of the chain over the titles that are left, delivered and recorded; the titles delivered.

    ``work`` makes the chain of (title, version) that are left.  The files of a run
    are one delivery and its states one change, both under its number: a run that
    died goes on where it stopped when it is made again, and a title that is done
    is left alone until its version changes.
    """
    name = f"run-{run:09d}"
    left = unfinished(versions, table)
    made = work(left)
    titles = deliver(made.files(), folder, suffix, delivery=name)
    states = made.states().join(left, "title").select(F.col("title").cast("string").alias("title"), "status", "stage", "error", "version", F.lit(run).cast("long").alias(AT))
    # an error that is gone must be said to be gone: null would say nothing
    table.append(states.withColumns({c: F.coalesce(c, F.lit("")) for c in ("stage", "error")}), name)
    return titles
