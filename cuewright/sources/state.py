"""State that outlives a run: a snapshot and the changes since, as Parquet, merged by the newest value of each field.

    table = StateTable(spark, "hdfs://store/state", ["title"], "title string, status string, version string")
    table.append(changes, "run-12")       # (keys, any of the fields, updated_at); null says nothing
    table.current()                       # one row a key: (keys, fields, updated_at)
    table.compact()                       # the same, read faster; changes that come later still merge by their time

A change is a folder under its own name and counts when Spark has finished it; a name
that is there is not written again, so a run that is repeated changes nothing.  A
snapshot keeps a time for each field, not one for a row: a late change is merged
into it as into the changes it stands for.  Which changes a snapshot stands for is
written with it, and it counts from then on, so a compaction that dies leaves the
table as it was and changes appended meanwhile are not lost.  Of equal times the
greater value wins.  Nothing is deleted but by ``vacuum``.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AT = "updated_at"


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or temporary where all runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cuewright-")
    path = f"{base.rstrip('/')}/cuewright-state/{uuid.uuid4().hex}"
    store = Store(spark, path)
    store.fs.deleteOnExit(store.path(""))
    return path


class Store:
    """The few calls on Spark's own file system that a table needs."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):  # noqa: ANN201
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self.fs.create(self.path(part))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(self.path(part), self.path(name)):
            self.delete(part)
            raise FileExistsError(f"{self.root}/{name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class StateTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, at: str = "timestamp"):
        """``schema``: keys and fields; ``at``: the type of ``updated_at``."""
        self.spark, self.keys, self.store = spark, list(keys), Store(spark, path)
        self.rows = T.StructType([*T.StructType.fromDDL(schema), T.StructField(AT, T.StructType.fromDDL(f"x {at}")["x"].dataType)])
        self.fields = [f.name for f in self.rows if f.name not in (*keys, AT)]
        if missing := set(keys) - set(self.rows.names):
            raise ValueError(f"keys without a type: {sorted(missing)}")

    # ---- writing --------------------------------------------------------------------------------------------

    def append(self, changes: DataFrame, name: str) -> bool:
        """Add changes under a name; False if that name is there, and nothing is done."""
        if not re.fullmatch(r"[\w.-]+", name):
            raise ValueError(f"a change's name is letters, digits, dots and dashes, not {name!r}")
        if name in self.changes() or name in self._snapshot()[1]:
            return False
        if unknown := set(changes.columns) - set(self.rows.names):
            raise ValueError(f"unknown fields: {sorted(unknown)}")
        if missing := {*self.keys, AT} - set(changes.columns):
            raise ValueError(f"changes without {sorted(missing)}")
        said = [F.col(f.name).cast(f.dataType) if f.name in changes.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.rows]
        changes.select(*said).write.mode("overwrite").parquet(f"{self.store.root}/changes/{name}")
        return True

    def compact(self) -> str:
        """A new snapshot of all changes that are finished now; its name."""
        held, included = self._snapshot()
        names = [n for n in self.changes() if n not in included]
        ordinal = max((int(n.split(".")[0]) for n in self.store.names("snapshots") if n.endswith(".json")), default=-1) + 1
        folder = f"{ordinal:09d}-{uuid.uuid4().hex}"
        self._merged(held, names).write.parquet(f"{self.store.root}/snapshots/{folder}")
        # two compactions at a time: the second finds the number taken, and nothing is lost
        self.store.write(f"snapshots/{ordinal:09d}.json", json.dumps({"folder": folder, "included": sorted({*included, *names})}))
        return folder

    def vacuum(self) -> list[str]:
        """Delete changes that the newest snapshot stands for, and older snapshots; readers of these must be through."""
        held, included = self._snapshot()
        gone = [f"changes/{n}" for n in self.changes() if n in included]
        gone += [f"snapshots/{n}" for n in self.store.names("snapshots") if held and not n.startswith(held.split("-")[0])]
        for name in gone:
            self.store.delete(name)
        return gone

    # ---- reading --------------------------------------------------------------------------------------------

    def changes(self) -> list[str]:
        """Names of finished changes that are there."""
        return [n for n in self.store.names("changes") if self.store.exists(f"changes/{n}/_SUCCESS")]

    def _snapshot(self) -> tuple[str | None, set[str]]:
        marks = [n for n in self.store.names("snapshots") if n.endswith(".json")]
        if not marks:
            return None, set()
        said = json.loads(self.store.read(f"snapshots/{marks[-1]}"))
        return said["folder"], set(said["included"])

    def _merged(self, held: str | None, names: Sequence[str]) -> DataFrame:
        """(keys, fields as (at, value), updated_at) of a snapshot and changes: one shuffle, combined before it."""
        kept = T.StructType([self.rows[k] for k in self.keys] + [T.StructField(f, T.StructType([T.StructField("at", self.rows[AT].dataType), T.StructField("value", self.rows[f].dataType)])) for f in self.fields] + [self.rows[AT]])
        said = [F.when(F.col(f).isNotNull(), F.struct(F.col(AT).alias("at"), F.col(f).alias("value"))).alias(f) for f in self.fields]
        paths = [f"{self.store.root}/changes/{n}" for n in names]
        # paths after one schema: one scan, however many changes there are
        rows = self.spark.read.schema(self.rows).parquet(*paths).select(*self.keys, *said, AT) if paths else self.spark.createDataFrame([], kept)
        if held:
            rows = rows.unionByName(self.spark.read.schema(kept).parquet(f"{self.store.root}/snapshots/{held}"))
        return rows.groupBy(*self.keys).agg(*(F.max(f).alias(f) for f in self.fields), F.max(AT).alias(AT))

    def current(self) -> DataFrame:
        held, included = self._snapshot()
        rows = self._merged(held, [n for n in self.changes() if n not in included])
        return rows.select(*self.keys, *(F.col(f"{f}.value").alias(f) for f in self.fields), AT)
