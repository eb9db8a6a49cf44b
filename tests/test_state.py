import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cuewright.sources import delivery, state
from cuewright.streaming import delivery as stream_delivery

SCHEMA = "title string, status string, version long"


def merged(changes):
    """Newest value of each field, by key; of equal times the greater value."""
    out = {}
    for batch in changes:
        for key, status, version, at in batch:
            row = out.setdefault(key, [None, None, at])
            for i, v in enumerate((status, version)):
                if v is not None and (row[i] is None or (at, v) > row[i]):
                    row[i] = (at, v)
            row[2] = max(row[2], at)
    return {k: (s and s[1], v and v[1], at) for k, (s, v, at) in out.items()}


def rows(table):
    return {r.title: (r.status, r.version, r.updated_at) for r in table.current().collect()}


def test_late_changes_merge_alike_before_and_after_snapshots(spark, tmp_path):
    """Each batch may be older than what a snapshot holds; nulls say nothing; compaction and vacuum change no row."""
    rng = random.Random(3)
    batches = [[(rng.choice("abcdef"), rng.choice((None, "x", "y", "z")), rng.choice((None, 1, 2)), rng.randrange(50)) for _ in range(12)] for _ in range(7)]
    plain, compacted = (state.StateTable(spark, f"{tmp_path}/{n}", ["title"], SCHEMA, "long") for n in "pc")
    assert rows(plain) == {} and plain.current().columns == ["title", "status", "version", "updated_at"]
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, f"{SCHEMA}, updated_at long")
        assert plain.append(df, f"b{i}") and compacted.append(df, f"b{i}")
        if i % 2:
            compacted.compact()
        if i == 5:
            assert compacted.vacuum() and not compacted.append(df, "b1")
        assert rows(plain) == rows(compacted) == merged(batches[: i + 1])
    assert not plain.append(spark.createDataFrame(batches[0], f"{SCHEMA}, updated_at long"), "b3")


def test_unfinished_writes_do_not_count(spark, tmp_path):
    t = state.StateTable(spark, str(tmp_path), ["title"], SCHEMA, "long")
    t.append(spark.createDataFrame([("a", "done", 1)], "title string, status string, updated_at long"), "one")
    want = rows(t)
    t.append(spark.createDataFrame([("a", "lost", 9)], "title string, status string, updated_at long"), "two")
    os.remove(tmp_path / "changes" / "two" / "_SUCCESS")
    (tmp_path / "snapshots").mkdir()
    (tmp_path / "snapshots" / "000000000-x").mkdir()  # a compaction that died
    assert rows(t) == want == {"a": ("done", None, 1)}
    t.compact()
    assert rows(t) == want
    assert t.append(spark.createDataFrame([("a", "kept", 9)], "title string, status string, updated_at long"), "two") and rows(t)["a"][0] == "kept"


def test_two_compactions_at_a_time(spark, tmp_path, monkeypatch):
    t = state.StateTable(spark, str(tmp_path), ["title"], SCHEMA, "long")
    t.append(spark.createDataFrame([("a", "x", 1)], "title string, status string, updated_at long"), "one")
    write = t.store.write

    def later(name, text):
        monkeypatch.setattr(t.store, "write", write)
        state.StateTable(spark, str(tmp_path), ["title"], SCHEMA, "long").compact()
        write(name, text)

    monkeypatch.setattr(t.store, "write", later)
    with pytest.raises(FileExistsError):
        t.compact()
    assert rows(t) == {"a": ("x", None, 1)} and not list((tmp_path / "snapshots").glob("*.part"))


def test_refusals(spark, tmp_path):
    t = state.StateTable(spark, str(tmp_path), ["title"], SCHEMA)
    for bad, match in (("title string, updated_at timestamp, other int", "unknown"), ("title string, status string", "without")):
        with pytest.raises(ValueError, match=match):
            t.append(spark.createDataFrame([], bad), "x")
    with pytest.raises(ValueError, match="letters"):
        t.append(spark.createDataFrame([], "title string, updated_at timestamp"), "a/b")
    with pytest.raises(ValueError, match="keys"):
        state.StateTable(spark, str(tmp_path), ["id"], SCHEMA)


# ---- a stream of files -----------------------------------------------------------------------------------------------


def put(inbox, name, *files):
    (inbox / f".{name}").write_text("\n".join(json.dumps(dict(zip(("title", "text", "version"), f, strict=True))) for f in files))
    (inbox / f".{name}").rename(inbox / f"{name}.json")


def run(spark, tmp_path, each=None):
    source = spark.readStream.schema("title string, text string, version long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    writer = stream_delivery.delivering(source, str(tmp_path / "out"), "s", str(tmp_path / "at"))
    q = (writer.foreachBatch(each) if each else writer).trigger(availableNow=True).start()
    q.awaitTermination(180)


def out(tmp_path):
    return {p.name: p.read_text() for p in (tmp_path / "out").glob("*.srt")}


@pytest.mark.parametrize("dies", ["before", "prepared", "delivered", "recorded"])
def test_a_stream_that_is_stopped_in_a_batch(spark, tmp_path, monkeypatch, dies):
    """Wherever the second batch dies, a restart delivers each title of it once, and no move is made twice."""
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "1", ("a", "a1", 1), ("b", "b1", 1))
    run(spark, tmp_path)
    assert out(tmp_path) == {"a.srt": "a1", "b.srt": "b1"}
    put(tmp_path / "in", "2", ("a", "a2", 2), ("c", "c2", 2), ("c", "c1", 1))
    folder, names = str(tmp_path / "out"), []

    class Death(Exception):
        pass

    def each(batch, number):
        if dies == "before":
            raise Death
        if dies == "prepared":
            # the list is written and one file moved, then the process is gone
            batch = batch.select("title", "text").where("text <> 'c1'").persist()
            ledger = tmp_path / "out" / delivery.LEDGER
            (ledger / f"s-{number:012d}").mkdir(parents=True)
            moves = []
            for i, r in enumerate(batch.collect()):
                (ledger / f"s-{number:012d}" / str(i)).write_text(r.text)
                moves.append({"title": r.title, "from": f"{ledger}/s-{number:012d}/{i}", "to": f"{folder}/{r.title}.srt", "keep": False})
            (ledger / f"s-{number:012d}.prepared").write_text(json.dumps(moves))
            delivery._move(delivery.opened(folder)[0], moves[0])
            raise Death
        if dies == "delivered":
            monkeypatch.setattr(stream_delivery.StateTable, "append", lambda *a: (_ for _ in ()).throw(Death()))
        try:
            stream_delivery.deliver_batch(batch, number, folder, "s")
        finally:
            monkeypatch.undo()
        raise Death

    with pytest.raises(Exception, match="Death"):
        run(spark, tmp_path, each)
    seen = {p: os.stat(tmp_path / "out" / p).st_mtime_ns for p in out(tmp_path) if dies in ("delivered", "recorded")}
    run(spark, tmp_path)
    assert out(tmp_path) == {"a.srt": "a2", "b.srt": "b1", "c.srt": "c2"}
    assert all(os.stat(tmp_path / "out" / p).st_mtime_ns == t for p, t in seen.items())
    done = [json.loads(p.read_text()) for p in sorted((tmp_path / "out" / delivery.LEDGER).glob("*.done"))]
    assert [sorted(m["title"] for m in d) for d in done] == [["a", "b"], ["a", "c"]] and names == []
    got = stream_delivery.delivered_versions(spark, folder).current()
    assert {r.title: r.version for r in got.collect()} == {"a": 2, "b": 1, "c": 2}


def test_a_late_version_does_not_replace_a_newer_one(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, *files in (("1", ("a", "a3", 3)), ("2", ("a", "a2", 2), ("b", "b1", 1)), ("3", ("a", "a3 again", 3))):
        put(tmp_path / "in", name, *files)
        run(spark, tmp_path)
    assert out(tmp_path) == {"a.srt": "a3", "b.srt": "b1"}
    assert stream_delivery.deliver_batch(spark.createDataFrame([("a", "a4", 4)], "title string, text string, version long"), 200, str(tmp_path / "out"), "s") == ["a"]
    table = stream_delivery.delivered_versions(spark, str(tmp_path / "out"))
    assert table._snapshot()[0] and {r.title: r.version for r in table.current().where(F.col("title") == "a").collect()} == {"a": 4}


# ---- the gate chain, resumed -----------------------------------------------------------------------------------------


def test_runs_resume_where_they_stopped(spark, tmp_path, monkeypatch):
    """Done titles are left alone, failed ones tried again, a new version too; a run that dies before its state is written is finished."""
    from cuewright.plans import gates

    texts = {"t": "Eins", "u": "", "v": "Un"}
    worked, folder = [], str(tmp_path / "out")

    def work(left):
        titles = sorted(r.title for r in left.collect())
        worked.append(titles)
        rows = [(t, 1, 1, "00:00:01,000 --> 00:00:02,000", texts[t]) for t in titles]
        out = spark.createDataFrame(rows, "title string, pos int, num int, ts string, text string")
        judged = out.select("title", F.lit("normalize").alias("stage"), F.when(F.col("text") == "", "missing").alias("reason"))
        return gates.Finalized(out, out, out, judged.withColumn("passed", F.col("reason").isNull()))

    table = state.StateTable(spark, f"{tmp_path}/state", ["title"], gates.STATE, "long")
    versions = lambda **v: spark.createDataFrame([(t, v.get(t, "1")) for t in "tuv"], "title string, version string")

    def dying(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(table, "append", dying)
    with pytest.raises(RuntimeError, match="gone"):
        gates.resumed(versions(), table, 1, work, folder)
    monkeypatch.undo()
    seen = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("*.srt")}
    assert gates.resumed(versions(), table, 1, work, folder) == ["t", "v"]
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("*.srt")} == seen and sorted(seen) == ["t.srt", "v.srt"]
    now = {r.title: (r.status, r.stage) for r in table.current().collect()}
    assert now == {"t": ("done", ""), "v": ("done", ""), "u": ("built", "normalize")}
    texts |= {"u": "Ein", "v": "Une"}
    assert gates.resumed(versions(v="2"), table, 2, work, folder) == ["u", "v"]
    assert gates.resumed(versions(v="2"), table, 3, work, folder) == []
    assert worked == [["t", "u", "v"], ["t", "u", "v"], ["u", "v"], []]
    assert {r.title: (r.status, r.version, r.error) for r in table.current().collect()} == {"t": ("done", "1", ""), "u": ("done", "1", ""), "v": ("done", "2", "")}
    assert "Une" in (tmp_path / "out" / "v.srt").read_text()
