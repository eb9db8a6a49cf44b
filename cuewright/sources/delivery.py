"""Files delivered in two phases: tasks write beside the targets, and only when all are done does anything move.

    df.write.format("title_files").mode("append").option("delivery", "monday").save("hdfs://store/out")

writes one file for each row (title, text, and path if it is known where a title was
read from).  Tasks write to ``_deliveries/<delivery>/`` in the target folder.  When all
have ended well the list of moves is written as ``<delivery>.prepared``: from then on
the delivery counts, and its moves are made, or made again, until all are; then the
list becomes ``<delivery>.done``.  A task or job that fails before leaves no target
changed, one that dies after is finished by ``finish`` or by the same delivery's next
run, and a delivery that is done is not made again.  Names alone pass through the driver.

Folders are paths or URIs of any file system that Arrow opens (local, HDFS, S3, GCS);
a move replaces its target, where the store can, in one step.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

LEDGER = "_deliveries"
#: Moves made at the same time.
MOVERS = 16


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path on it of a folder."""
    if "://" in folder:
        return fs.FileSystem.from_uri(folder.rstrip("/"))
    return fs.LocalFileSystem(), os.path.abspath(folder.removeprefix("file:"))


def exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def read_bytes(store: fs.FileSystem, path: str) -> bytes:
    with store.open_input_stream(path) as f:
        return f.read()


def write_bytes(store: fs.FileSystem, path: str, data: bytes) -> None:
    with store.open_output_stream(path) as f:
        f.write(data)


def same_file(a: str, b: str) -> bool:
    """Whether two paths are one file, however they are spelled."""
    a, b = (x.removeprefix("file://").removeprefix("file:") for x in (a, b))
    try:
        return os.path.samefile(a, b)
    except OSError:
        return os.path.normpath(a) == os.path.normpath(b)


@dataclass
class Written(WriterCommitMessage):
    """What one task has written: (title, staged file, file that the title was read from)."""

    files: list[tuple[str, str, str | None]]


class TitleWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.folder, self.suffix = options["path"], options.get("suffix", ".srt")
        self.backup = options.get("backup", "true").lower() == "true"
        self.delivery = options.get("delivery") or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.-]+", self.delivery):
            raise ValueError(f"a delivery's name is letters, digits, dots and dashes, not {self.delivery!r}")

    def write(self, iterator: Iterator[Row]) -> Written:
        store, root = opened(self.folder)
        task = TaskContext.get()
        mine = f"{root}/{LEDGER}/{self.delivery}/{task.partitionId()}-{task.taskAttemptId()}"
        store.create_dir(mine)
        out = []
        for k, r in enumerate(iterator):
            data = r["text"].encode("utf-8")
            if data.startswith(b"\xef\xbb\xbf"):
                raise ValueError(f"{r['title']}: text starts with a byte order mark")
            if not r["title"] or "/" in r["title"]:
                raise ValueError(f"{r['title']!r} is no name for a file")
            write_bytes(store, f"{mine}/{k}", data)
            out.append((r["title"], f"{mine}/{k}", r["path"] if "path" in r else None))
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.folder)
        files = sorted(x for m in messages if m for x in m.files)
        again = {a[0] for a, b in zip(files, files[1:], strict=False) if a[0] == b[0]}
        if again:
            raise ValueError(f"titles that come twice: {sorted(again)[:5]}")
        moves = []
        for title, staged, source in files:
            target = f"{root}/{title}{self.suffix}"
            moves.append({"title": title, "from": staged, "to": target, "keep": bool(self.backup and source and same_file(source, target) and exists(store, target))})
        ledger = f"{root}/{LEDGER}/{self.delivery}"
        store.create_dir(f"{root}/{LEDGER}")
        write_bytes(store, f"{ledger}.listing", json.dumps(moves).encode())
        store.move(f"{ledger}.listing", f"{ledger}.prepared")
        _finished(store, ledger)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = opened(self.folder)
        ledger = f"{root}/{LEDGER}/{self.delivery}"
        if not exists(store, f"{ledger}.prepared"):
            for left in (ledger, f"{ledger}.listing"):
                _remove(store, left)


def _remove(store: fs.FileSystem, path: str) -> None:
    kind = store.get_file_info(path).type
    if kind == fs.FileType.Directory:
        store.delete_dir(path)
    elif kind == fs.FileType.File:
        store.delete_file(path)


def _move(store: fs.FileSystem, move: dict) -> None:
    if not exists(store, move["from"]):
        return  # made before
    if move["keep"] and not exists(store, f"{move['to']}.bak"):
        store.copy_file(move["to"], f"{move['to']}.bak.part")
        store.move(f"{move['to']}.bak.part", f"{move['to']}.bak")
    store.move(move["from"], move["to"])


def _finished(store: fs.FileSystem, ledger: str) -> None:
    """Make the moves of a prepared delivery that haven't been made."""
    moves = json.loads(read_bytes(store, f"{ledger}.prepared"))
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda m: _move(store, m), moves))
    _remove(store, ledger)
    store.move(f"{ledger}.prepared", f"{ledger}.done")


class TitleFiles(DataSource):
    """``title_files``: see the module."""

    @classmethod
    def name(cls) -> str:
        return "title_files"

    def schema(self) -> str:
        return "title string, text string, path string"

    def writer(self, schema, overwrite: bool) -> TitleWriter:  # noqa: ANN001
        return TitleWriter(self.options)


def finish(folder: str, delivery: str | None = None) -> list[str]:
    """Make what prepared deliveries (or one) have left undone; the names of those that now are done."""
    store, root = opened(folder)
    found = store.get_file_info(fs.FileSelector(f"{root}/{LEDGER}", allow_not_found=True))
    names = sorted(f.base_name.removesuffix(".prepared") for f in found if f.base_name.endswith(".prepared"))
    for name in (n for n in names if delivery in (None, n)):
        _finished(store, f"{root}/{LEDGER}/{name}")
    return [n for n in names if delivery in (None, n)]


def delivered(folder: str, delivery: str) -> list[str] | None:
    """Titles of a delivery that is done; None if it isn't."""
    store, root = opened(folder)
    path = f"{root}/{LEDGER}/{delivery}.done"
    return [m["title"] for m in json.loads(read_bytes(store, path))] if exists(store, path) else None


def registered(spark: SparkSession) -> None:
    spark.dataSource.register(TitleFiles)


def deliver(files: DataFrame, folder: str, suffix: str = ".srt", backup: bool = True, delivery: str | None = None) -> list[str]:
    """Deliver (title, text) to a folder, all files or none; the titles.

    Where ``path`` names the file a title was read from and that very file is the
    target, it is copied to ``.bak`` first.  A ``delivery`` that is named is made
    once, however often it is asked for.
    """
    name = delivery or uuid.uuid4().hex
    finish(folder, name)
    if (done := delivered(folder, name)) is not None:
        return done
    registered(files.sparkSession)
    rows = files.select(files["title"].cast("string").alias("title"), "text", *(c for c in ("path",) if c in files.columns))
    rows.write.format("title_files").mode("append").options(suffix=suffix, backup=str(backup).lower(), delivery=name).save(folder)
    return delivered(folder, name)
