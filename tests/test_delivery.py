import json
import os

import pytest
from pyspark.sql import functions as F

from cuewright.sources import delivery


def tree(folder):
    return {p.relative_to(folder).as_posix(): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc") and delivery.LEDGER not in p.parts}


def files(spark, n, text="text"):
    return spark.range(n).repartition(3).select(F.concat(F.lit("t"), "id").alias("title"), F.concat(F.lit(text), "id").alias("text"))


def test_all_or_none(spark, tmp_path):
    """A task that fails when others have written leaves every target as it was, and nothing beside."""
    assert delivery.deliver(files(spark, 6, "old"), str(tmp_path)) == [f"t{i}" for i in range(6)]
    before = tree(tmp_path)
    bad = files(spark, 6, "new").withColumn("text", F.when(F.col("title") == "t4", F.concat(F.lit("﻿"), "text")).otherwise(F.col("text")))
    with pytest.raises(Exception, match="byte order mark"):
        delivery.deliver(bad, str(tmp_path), delivery="bad")
    assert tree(tmp_path) == before and delivery.delivered(str(tmp_path), "bad") is None
    left = sorted(p.name for p in (tmp_path / delivery.LEDGER).iterdir() if not p.name.startswith("."))
    assert len(left) == 1 and left[0].endswith(".done")
    twice = files(spark, 2, "new").unionByName(files(spark, 1, "again"))
    with pytest.raises(Exception, match="come twice"):
        delivery.deliver(twice, str(tmp_path))
    with pytest.raises(Exception, match="no name"):
        delivery.deliver(spark.createDataFrame([("../x", "y")], "title string, text string"), str(tmp_path))
    assert tree(tmp_path) == before


def test_a_delivery_is_made_once(spark, tmp_path):
    assert delivery.deliver(files(spark, 3, "one"), str(tmp_path), delivery="batch-7") == ["t0", "t1", "t2"]
    seen = {p: os.stat(tmp_path / p).st_mtime_ns for p in tree(tmp_path)}
    assert delivery.deliver(files(spark, 3, "two"), str(tmp_path), delivery="batch-7") == ["t0", "t1", "t2"]
    assert {p: os.stat(tmp_path / p).st_mtime_ns for p in tree(tmp_path)} == seen
    with pytest.raises(Exception, match="letters"):
        delivery.deliver(files(spark, 1), str(tmp_path), delivery="a/b")


@pytest.mark.parametrize("made", [0, 1, 3])
def test_death_after_the_list_is_finished(spark, tmp_path, monkeypatch, made):
    """The process dies when some of the moves are made; the rest is made later, each once, with the backups of the first try."""
    (tmp_path / "t0.srt").write_text("first")
    rows = files(spark, 3, "new").withColumn("path", F.concat(F.lit(f"file:{tmp_path}/"), "title", F.lit(".srt")))
    staged = tmp_path / delivery.LEDGER / "d"
    staged.mkdir(parents=True)
    moves = []
    for i in range(3):
        (staged / str(i)).write_text(f"new{i}")
        moves.append({"title": f"t{i}", "from": f"{staged}/{i}", "to": f"{tmp_path}/t{i}.srt", "keep": i == 0})
    (tmp_path / delivery.LEDGER / "d.prepared").write_text(json.dumps(moves))
    store, _ = delivery.opened(str(tmp_path))
    for m in moves[:made]:
        delivery._move(store, m)
    monkeypatch.setattr(delivery, "registered", None)  # the rows must not be needed again
    assert delivery.deliver(rows, str(tmp_path), delivery="d") == ["t0", "t1", "t2"]
    assert tree(tmp_path) == {"t0.srt": "new0", "t1.srt": "new1", "t2.srt": "new2", "t0.srt.bak": "first"}
    assert delivery.finish(str(tmp_path)) == [] and not staged.exists()


def test_uris_and_other_folders(spark, tmp_path):
    """A file: path, a file:// URI and a plain path are one folder; a title read elsewhere needs no backup."""
    for folder in (f"file:{tmp_path}", f"file://{tmp_path}", str(tmp_path)):
        delivery.deliver(files(spark, 1, folder[:5]).withColumn("path", F.lit("/elsewhere/t0.srt")), folder, suffix=".txt")
    assert tree(tmp_path) == {"t0.txt": f"{str(tmp_path)[:5]}0"}
    assert delivery.deliver(files(spark, 0), str(tmp_path)) == []
