"""Readiness of worker files as a stream: a slice is ready when its file holds the last cue and has stopped changing.

Stability is a matter of processing time, not of event time: a slice's state is
what was seen last, and a timer tells when that has held long enough.  State that
nobody has changed for long goes by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OBSERVED = "title string, part int, hi int, last int, size long, mtime double"
FLAGS = "title string, part int, flag string"
#: Timers and expiring state need this state store.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Watch(StatefulProcessor):
    """One slice: LAST-CUE or UNSTABLE at a change, and what it has come to when its timer runs out."""

    def __init__(self, stable_ms: int, keep_ms: int):
        self.stable_ms, self.keep_ms = stable_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "size long, mtime double, complete boolean", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        last = None
        for batch in rows:
            at = batch.sort_values(["mtime", "size"], kind="stable").iloc[-1]
            if last is None or (at["mtime"], at["size"]) >= (last["mtime"], last["size"]):
                last = at
        now = (int(last["size"]), float(last["mtime"]), bool(last["last"] == last["hi"]))
        if self.seen.exists() and tuple(self.seen.get()) == now:
            return  # an unchanged look makes no wait longer
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.seen.update(now)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stable_ms)
        yield self._flag(key, "UNSTABLE" if now[2] else "LAST-CUE")

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        if self.seen.exists():
            yield self._flag(key, "READY" if self.seen.get()[2] else "LAST-CUE")

    @staticmethod
    def _flag(key: tuple, flag: str) -> pd.DataFrame:
        return pd.DataFrame([(*key, flag)], columns=["title", "part", "flag"])


def ready_slices(observed: DataFrame, stable_ms: int = 60_000, keep_ms: int = 7 * 24 * 3_600_000) -> DataFrame:
    """Of a stream of observations: (title, part, flag) whenever a slice's flag may have changed.

    LAST-CUE while the file ends early, UNSTABLE after a change, READY once, when
    nothing has changed for ``stable_ms``, however often it was looked at.  A later change makes a slice UNSTABLE
    again: writers thought dead do come back.  A slice without a change for
    ``keep_ms`` is forgotten, and new when it is seen again.
    """
    if keep_ms <= stable_ms:
        raise ValueError("state must be kept longer than a slice is watched")
    observed.sparkSession.conf.set(PROVIDER, ROCKSDB)
    return observed.groupBy("title", "part").transformWithStateInPandas(Watch(stable_ms, keep_ms), FLAGS, "Append", "ProcessingTime")


def without_late_copies(entries: DataFrame, at: str = "seen_at", late: str = "10 minutes") -> DataFrame:
    """Each (title, file, lo) once within the watermark: a worker that writes again doesn't count twice."""
    return entries.withWatermark(at, late).dropDuplicatesWithinWatermark(["title", "file", "lo"])
