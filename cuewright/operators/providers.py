"""Where media tools and language models plug in, and the ledger of what reviewers find.

An adapter is a function that a task builds once (so it may load a model) and
then calls on batches; the engine sees tables only.  Nothing here knows a tool.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tables that adapters give: text of a chosen stream, rendered audio, recognised words, translations, reviews, pictures.
SCHEMAS = {
    "extract": "title string, text string", "render": "title string, path string, isolated boolean", "words": "title string, pos int, word string, start double, end double",
    "translate": "title string, num int, text string", "review": "title string, num int, issue string, severity string, evidence string", "picture": "title string, num int, image binary",
}
Adapter = Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]


def adapted(rows: DataFrame, kind: str, make: Adapter) -> DataFrame:
    """Apply an adapter of a kind to rows, batch by batch; its answer must have the kind's columns."""
    names = [c.split()[0] for c in SCHEMAS[kind].split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = make()
        for batch in batches:
            out = f(batch)
            if missing := [n for n in names if n not in out.columns]:
                raise ValueError(f"adapter for {kind} gives no {', '.join(missing)}")
            yield out[names]

    return rows.mapInPandas(run, SCHEMAS[kind])


def rendering(streams: DataFrame, loudness: DataFrame, silent_db: float = -50.0) -> DataFrame:
    """(title, index, isolate): whether to take the centre channel alone: six channels or more, and it isn't silent.

    loudness: (title, mean_db) of the centre channel, where it was measured.
    """
    rows = streams.join(loudness, "title", "left")
    return rows.select("title", "index", ((F.coalesce("channels", F.lit(0)) >= 6) & (F.coalesce("mean_db", F.lit(0.0)) >= silent_db)).alias("isolate"))


# States of an issue, those it may change to, and severities that hold up a title.
STATES = {"open": ("open", "fixed", "rejected-with-evidence", "user-deferred"), "fixed": ("fixed", "open"), "rejected-with-evidence": ("rejected-with-evidence", "open"), "user-deferred": ("user-deferred", "open")}
BLOCKING = ("CRITICAL", "MAJOR")


def ledger(events: DataFrame) -> DataFrame:
    """Of (title, issue, severity, state, evidence, round): the last state of each issue, and how many rounds it took."""
    last = F.max_by(F.struct("severity", "state", "evidence"), "round")
    g = events.groupBy("title", "issue").agg(last.alias("x"), F.max("round").alias("round"), F.count("*").alias("entries"))
    return g.select("title", "issue", "x.severity", "x.state", "x.evidence", "round", "entries")


def ledger_problems(events: DataFrame) -> DataFrame:
    """(title, issue, round, rule): unknown states, changes that are not allowed, and rejections without evidence."""
    w = Window.partitionBy("title", "issue").orderBy("round")
    rows = events.withColumn("before", F.coalesce(F.lag("state").over(w), F.lit("open")))
    allowed = F.create_map(*(x for k, v in STATES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    rule = (F.when(~F.col("state").isin(*STATES), "unknown-state").when(~F.coalesce(F.array_contains(F.element_at(allowed, F.col("before")), F.col("state")), F.lit(False)), "not-allowed")
            .when((F.col("state") == "rejected-with-evidence") & (F.btrim(F.coalesce("evidence", F.lit(""))) == ""), "no-evidence"))
    return rows.withColumn("rule", rule).where("rule is not null").select("title", "issue", "round", "rule")


def verdicts(events: DataFrame, rounds: int = 2) -> DataFrame:
    """(title, verdict): PROCEED without open blocking issues, NEEDS-HUMAN once they have lasted for the rounds, else REVIEW."""
    now = ledger(events).withColumn("blocks", (F.col("state") == "open") & F.col("severity").isin(*BLOCKING))
    g = now.groupBy("title").agg(F.count_if("blocks").alias("open"), F.max(F.when(F.col("blocks"), F.col("round"))).alias("last"))
    return g.select("title", F.when(F.col("open") == 0, "PROCEED").when(F.col("last") >= rounds, "NEEDS-HUMAN").otherwise("REVIEW").alias("verdict"))
