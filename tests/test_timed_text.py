import json
import random
import time

import pytest
from pyspark.sql import functions as F

from cuewright.functions import text as X
from cuewright.functions import timing
from cuewright.functions.rules import Options, Pack, Rewrite, Sense, boilerplate_patterns, rewritten
from cuewright.operators import batches, cues, providers, tracks, validate
from cuewright.plans import gates, queries, queries_files
from cuewright.sources import settings, sinks, subtitles
from cuewright.streaming import readiness

SRT = """1
00:00:01,000 --> 00:00:02,500
Hello there.

2
00:00:03,000 --> 00:00:04,5
First line

after a blank line

3
00:00:05,000 --> 00:00:06,000 X1:10
[music]
"""


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("r")).first().r


def track(spark, rows):
    data = [("t", i + 1, i + 1, "", text, a, b) for i, (text, a, b) in enumerate(rows)]
    return spark.createDataFrame(data, "title string, pos int, num int, ts string, text string, start_ms long, end_ms long")


def test_parse_keeps_blank_lines_inside_a_cue(spark):
    got = subtitles.parse_cues(spark.createDataFrame([("a", SRT)], "title string, text string")).orderBy("pos").collect()
    assert [(r.num, r.start_ms, r.end_ms) for r in got] == [(1, 1000, 2500), (2, 3000, 4500), (3, 5000, 6000)]
    assert got[1].text == "First line\n\nafter a blank line"
    assert subtitles.parse_problems(spark.createDataFrame([("a", SRT)], "title string, text string")).count() == 0


def test_parse_reports_what_is_no_cue(spark):
    bad = "x\nno index\n\n1\n00:00:01,000 --> 00:00:02,000\ntext\n2\n00:00:03,000 --> 00:00:04,000\nhidden"
    kinds = {r.kind for r in subtitles.parse_problems(spark.createDataFrame([("a", bad)], "title string, text string")).collect()}
    assert kinds == {"no-index", "embedded-header", "count"}


@pytest.mark.parametrize(("raw", "want"), [
    ("é".encode(), ("é", "utf-8")), ("é".encode("cp1252"), ("é", "cp1252")), ("é".encode("utf-16"), ("é", "utf-16")), (b"\x81\xe9", ("\x81é", "latin-1")), ("﻿a".encode(), ("﻿a", "utf-8"))])
def test_decode(raw, want):
    assert subtitles.decode_bytes(raw) == want


def test_decode_as_asked_must_fit():
    with pytest.raises(UnicodeDecodeError):
        subtitles.decode_bytes(b"\xe9", "utf-8")


def test_decode_as_asked_row_by_row(spark):
    rows = spark.createDataFrame([(1, bytearray(b"\xc3\xa9"), "cp1252"), (2, bytearray(b"\xc3\xa9"), None), (3, None, None)], "id int, raw binary, asked string")
    got = rows.select("id", subtitles.decoded(F.col("raw"), F.col("asked")).alias("g")).orderBy("id").collect()
    assert [tuple(r.g) for r in got] == [("Ã©", "cp1252"), ("é", "utf-8"), ("", "utf-8")]


#: Empty lines; single bytes that read as UTF-8, as a mark (of whole or broken text) or as cp1252's own signs; what is no letter of Latin-1.
ODD = ("", "é", "Ã©", "â\x82¬", "ï»¿x", "ÿþ", "ÿþab", "þÿabc", "ÿþ\0\0abcd", "\0\0þÿ", "\x80é", "\x81é", "\x85", "Â\x80", "\xa0", "a\xa0b", "\ufeffé", "œé", "\U0001f600", "\0", "\r")


def test_decode_query_equals_its_sql_on_odd_lines(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    texts = ["\n".join(["x"] * n + [t]) for t in ODD for n in range(3)] + [None, "\n\n\n\n"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["decode_bytes"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(tuple(r) for r in got) == sorted(con.execute(queries.SQL["decode_bytes"]).fetchall())


@pytest.mark.parametrize(("text", "want"), [("hÃ©roe", "héroe"), ("MÃO", "MÃO"), ("aÃ±o\nplain\nâ‚¬ Ã‰l", "año\nplain\n€ Él"), ("Â¿QuÃ©?", "¿Qué?"), ("", ""), ("﻿a`nb\\nc", "a\nb\nc")])
def test_sanitized(spark, text, want):
    assert one(spark, text, subtitles.sanitized) == want


def test_timestamps(spark):
    assert one(spark, "00:59:59,999 --> 01:00:00.5", lambda c: timing.format_span(*timing.span_bounds(c))) == "00:59:59,999 --> 01:00:00,500"
    assert one(spark, "nothing", lambda c: timing.span_bounds(c)[1]) is None
    assert spark.range(1).select(timing.format_millis(F.lit(-5)).alias("x"), timing.millis(F.lit(0.0025)).alias("y")).first()[:] == ("00:00:00,000", 2)


@pytest.mark.parametrize(("text", "want"), [
    ("[music]", True), ("JOHN: [sighs]", True), ("[applause", True), ("[door opens", False), ("Hello", False), ("...", True), ("", False), ("- (laughter)", True)])
def test_sound(spark, text, want):
    assert one(spark, text, X.is_sound) is want


def brute_wrap(text, width=42):
    ws = text.split()
    flat = " ".join(ws)
    if len(flat) <= width or len(ws) < 2:
        return flat
    cuts = [(max(len(" ".join(ws[:i])), len(" ".join(ws[i:]))) > width, abs(len(" ".join(ws[:i])) - len(" ".join(ws[i:]))), i) for i in range(1, len(ws))]
    i = min(cuts)[2]
    return " ".join(ws[:i]) + "\n" + " ".join(ws[i:])


def test_wrap_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join("x" * rng.randint(1, 12) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.wrap(F.col("t")).alias("w"))
    assert all(r.w == brute_wrap(r.t) for r in df.collect())
    assert one(spark, "- Who is there? " + "x" * 40, X.wrap).startswith("- Who is there? x")


def brute_collapse(rows):
    out = []
    for text, a, b in rows:
        if out and out[-1][0] == text and a - out[-1][2] <= 1500:
            out[-1][2] = max(out[-1][2], b)
        else:
            out.append([text, a, b])
    return [tuple(x) for x in out]


def test_loops_equal_brute_force(spark):
    rng, rows, at = random.Random(2), [], 0
    for _ in range(300):
        at += rng.choice((100, 1400, 1700))
        rows.append((rng.choice("ab"), at, at + rng.randint(10, 900)))
        at = max(at, rows[-1][2] - 300)
    got = tracks.loops_collapsed(track(spark, rows)).orderBy("pos").collect()
    assert [(r.text, r.start_ms, r.end_ms) for r in got] == brute_collapse(rows)


def test_retimed_has_no_overlap_and_keeps_order(spark):
    got = tracks.retimed(track(spark, [("a long line of text", 0, 100), ("b", 90, 200), ("c", 5000, 9000), ("d", 8000, 8100)])).orderBy("start_ms").collect()
    assert got[0].start_ms == 40
    assert all(x.end_ms <= y.start_ms for x, y in zip(got, got[1:], strict=False))
    assert [r.pos for r in got] == [1, 2, 3, 4]


def test_boilerplate_needs_repeats_and_whole_cues(spark):
    rows = [("Thanks for watching!", 0, 1), ("thanks for watching", 2, 3), ("(Thanks for watching!)", 4, 5), ("Subtitles by Amara.org", 6, 7), ("Thanks for watching the dog.", 8, 9), ("Copyright law will not save you", 10, 11)]
    got = {r.pos: (r.times, r.removable) for r in tracks.boilerplate(track(spark, rows)).collect()}
    assert got == {1: (3, True), 2: (3, True), 3: (3, True), 4: (1, False)}


def test_polish_without_boilerplate_times_the_rest_alike(spark):
    rows = [("Hello", 0, 900)] + [("Thanks for watching!", 2000 + 4000 * i, 2500 + 4000 * i) for i in range(3)] + [("Bye", 20000, 21000)]
    kept = tracks.polished(track(spark, rows)).orderBy("pos").collect()
    everything = tracks.polished(track(spark, rows), Options(strip_boilerplate=False)).where("text not like 'Thanks%'").orderBy("pos").collect()
    assert [(r.text, r.start_ms, r.end_ms) for r in kept] == [(r.text, r.start_ms, r.end_ms) for r in everything]


def test_shift_moves_headers_only(spark):
    text = SRT.replace("Hello there.", "At\n7\n00:00:09,000 --> 00:00:10,000 he said.")
    df = spark.createDataFrame([("a", text)], "title string, text string")
    moved = tracks.shifted(df, -1500).first().text
    assert "00:00:09,000 --> 00:00:10,000 he said." in moved
    assert moved.startswith("1\n00:00:00,000 --> 00:00:01,500\n")
    assert "00:00:03,500 --> 00:00:04,500 X1:10" in moved
    assert tracks.shift_differences(subtitles.parse_cues(df), subtitles.parse_cues(tracks.shifted(df, 1250)), 1250).count() == 0


def brute_shift(text, ms):
    """Cue by cue: a header is an index line at the start or behind a blank line, with a timestamp line under it."""
    import re

    stamp = r"(\d{1,2}):(\d{2}):(\d{2})[,.](\d{1,3})"
    whole = re.compile(rf"[ \t]*{stamp}[ \t]*-->[ \t]*{stamp}")
    lines, moved, stopped = text.split("\n"), {}, 0
    for i, line in enumerate(lines[:-1]):
        m = whole.match(lines[i + 1])
        if m and line.lstrip("\ufeff").strip().isdigit() and (i == 0 or not lines[i - 1].strip("\ufeff").strip()):
            g = m.groups()
            a, z = (((int(h) * 60 + int(mi)) * 60 + int(s)) * 1000 + int(k.ljust(3, "0")) for h, mi, s, k in (g[:4], g[4:]))
            stopped += a + ms < 0
            b = max(0, a + ms)
            said = (f"{t // 3600000:02d}:{t // 60000 % 60:02d}:{t // 1000 % 60:02d},{t % 1000:03d}" for t in (b, max(0, b + z - a)))
            moved[i + 1] = " --> ".join(said) + lines[i + 1][m.end() :]
    return "\n".join(moved.get(i, line) for i, line in enumerate(lines)), stopped


@pytest.mark.parametrize("ms", [-1500, 0, 1250, -10**8])
def test_shift_equals_brute_force(spark, ms):
    rng = random.Random(ms)
    parts = ("1", "", " ", "2", "007", "00:00:01,000 --> 00:00:02,500", " 0:00:03.5-->00:00:04,25 X1:10", "00:59:59,900 --> 01:00:00,000\r", "00:00:09,000 --> 00:00:08,000", "text", "5\r", "\ufeff", "\ufeff3", "a 00:00:01,000 --> 00:00:02,000")
    texts = ["\n".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(400)] + [None, SRT]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "title string, text string")
    got = {r.title: r.text for r in tracks.shifted(df, ms).collect()}
    stops = {r.title: r.clamped for r in tracks.clamped(df.where("text is not null"), ms).collect()}
    for i, t in enumerate(texts):
        if t is not None:
            assert (got[str(i)], stops[str(i)]) == brute_shift(t, ms)
    assert got["400"] is None


def test_slices_are_contiguous_and_may_be_fewer(spark):
    got = cues.slice_contract(track(spark, [("x", i, i + 1) for i in range(5)]), 4).orderBy("part").collect()
    assert [(r.lo, r.hi, r.n) for r in got] == [(1, 2, 2), (3, 4, 2), (5, 5, 1)]


def test_batches_and_build(spark):
    files = spark.createDataFrame([("t", "a", "noise\n1|||Uno\nmore\n\n2|||Dos\n2|||otra"), ("t", "b", "3..4|||Tres y cuatro\n5|||")], "title string, file string, text string")
    e = batches_entries = subtitles.batch_entries(files)
    got = [(r.lo, r.hi, r.text) for r in e.orderBy("lo").collect()]
    assert got == [(1, 1, "Uno\nmore"), (2, 2, "Dos\notra"), (3, 4, "Tres y cuatro"), (5, 5, "<DROP>")]
    src = track(spark, [(f"s{i}", 1000 * i, 1000 * i + 500) for i in range(5)]).withColumn("ts", timing.format_span(F.col("start_ms"), F.col("end_ms")))
    src = cues.classified(src).withColumn("sound", F.col("num") == 5)
    src = batches.with_droppable(src, spark.createDataFrame([], "title string, num int, reason string"))
    opt = Options(allow_merge=True)
    assert batches.build_problems(src, batches_entries, opt).count() == 0
    assert {r.rule for r in batches.build_problems(src, batches_entries).collect()} == {"merge-not-allowed"}
    made = batches.manifest(src, e, opt)
    out = batches.built(made).orderBy("pos").collect()
    assert [r.ts for r in out][-1] == "00:00:02,000 --> 00:00:03,500"
    assert sinks.written_differences(batches.built(made)).count() == 0
    assert validate.manifest_findings(batches.built(made), made, src).where("severity = 'HARD'").count() == 0
    lost = batches.built(made).where("num <> 2")
    assert [(r.num, r.rule) for r in validate.manifest_findings(lost, made, src).where("severity = 'HARD'").collect()] == [(2, "lost-cue")]
    entries, missing = batches.reconstructed(batches.built(made), made)
    assert missing.count() == 0
    assert {r.head for r in entries.collect()} == {"1", "2", "3..4", "5"}


def test_rules(spark):
    p = Pack(banned=("ordenador", r"jod\w*"), exempt=(("tío", Sense(before=("mi",), capital=True)),), leftover=("the", "right"), loanwords=("right",))
    assert one(spark, "El ORDENADOR", p.banned_hit) == "ORDENADOR"
    assert one(spark, "computadora", p.banned_hit) is None
    assert one(spark, "mi tío dijo", p.exempt_violation) is None
    assert one(spark, "oye tío ven", p.exempt_violation) == "tío"
    assert one(spark, "<i>the</i> right the", p.leftover_hit) == "the"
    assert one(spark, "Ordenador y ordenador", lambda c: rewritten(c, [Rewrite("ordenador", "computadora")])) == "Computadora y computadora"
    assert one(spark, "<DROP>", lambda c: rewritten(c, [Rewrite("drop", "x")])) == "<DROP>"


@pytest.mark.parametrize("bad", [{"max_cpl": True}, {"max_cpl": 0}, {"strip_boilerplate": "yes"}, ["x"], {"unknown": 1}, {"max_cps": 0}, {"hard_cps": -1.5}, {"inaudible": 3}])
def test_options_fail_loud(bad):
    with pytest.raises(ValueError, match="option"):
        Options.read(bad)


def test_patterns_fail_loud():
    with pytest.raises(ValueError, match="extra pattern 0"):
        boilerplate_patterns(["("])
    with pytest.raises(ValueError, match="list"):
        boilerplate_patterns("abc")


def brute_retimed(rows, least=700, cps=17.0):
    out, before = [], 0.0
    starts = [a / 1000 for _, a, _ in rows]
    for i, (text, a, b) in enumerate(rows):
        s, e = max(a / 1000, before + 0.04), b / 1000
        room = max((starts[i + 1] if i + 1 < len(rows) else e + 10) - 0.04, s + 0.05)
        e = min(e, room)
        for want in (s + least / 1000, s + len(text.replace(" ", "")) / cps):
            e = max(e, min(want, room))
        before = e
        out.append((round(s * 1000), round(e * 1000)))
    return out


def test_retimed_equals_the_fold_it_stands_for(spark):
    rng, at, rows = random.Random(8), 0, []
    for _ in range(400):
        rows.append(("x" * rng.randint(1, 60), at, at + rng.choice((10, 90, 800, 3000))))
        at += rng.choice((0, 1, 5, 30, 60, 95, 700, 4000))
    rows.sort(key=lambda r: (r[1], r[2]))
    got = [(r.start_ms, r.end_ms) for r in tracks.retimed(track(spark, rows)).orderBy("pos").collect()]
    want = brute_retimed(rows)
    assert len(got) == len(want) and all(abs(x - y) <= 1 for g, w in zip(got, want, strict=True) for x, y in zip(g, w, strict=True))


def brute_speech(rows, least=700, cps=17.0):
    out, before = [], 0.0
    for i, (text, a, b) in enumerate(rows):
        s = max(before + 0.001, a - 0.08, 0.0)
        room = max((rows[i + 1][1] if i + 1 < len(rows) else b + 5.0) - 0.04, s + 0.05)
        e = min(max(b + 0.35, (round(s * 1000) + least) / 1000, s + len(text.replace(" ", "")) / cps), room)
        before = e
        out.append((text, round(s * 1000), round(e * 1000)))
    return out


def test_speech_and_merged_tracks_equal_brute_force(spark):
    rng, at, rows = random.Random(9), 0.0, []
    for i in range(200):
        rows.append((f"cue {i} " + "x" * rng.randint(0, 40), at, at + rng.choice((0.05, 0.4, 2.0))))
        at = round(at + rng.choice((0.01, 0.06, 0.5, 2.5)), 3)
    df = spark.createDataFrame([("t", i, *r) for i, r in enumerate(rows)], "title string, pos int, text string, start double, end double")
    assert [(r.text, r.start_ms, r.end_ms) for r in tracks.speech_retimed(df).orderBy("pos").collect()] == brute_speech(rows)
    a = [("d", 0, 900), ("d", 2000, 2400), ("d", 2450, 9000)]
    b = [("a", 880, 890), ("a", 2300, 2420)]
    got = [(r.text, r.start_ms, r.end_ms) for r in tracks.merged_track(track(spark, a), track(spark, b)).orderBy("pos").collect()]
    assert got == [("d", 0, 900), ("a", 901, 951), ("d", 2000, 2400), ("a", 2401, 2420), ("d", 2450, 9000)]


def test_polish_counts(spark):
    rows = [("...", 0, 100), ("Hello", 200, 1200), ("hello", 1300, 2000), ("x" * 30 + " " + "y" * 30, 1990, 2000), ("short", 9000, 9100)]
    r = tracks.polish_counts(track(spark, rows)).first()
    assert (r.dropped_empty, r.collapsed_loops, r.rewrapped, r.overlaps_fixed, r.extended_short, r.dropped_boilerplate) == (1, 1, 1, 0, 2, 0)


def test_drift_is_found(spark):
    rng = random.Random(3)
    src = [("x" * rng.randint(5, 80)) for _ in range(70)]
    s = spark.createDataFrame([("t", i + 1, x) for i, x in enumerate(src)], "title string, num int, text string")
    t = spark.createDataFrame([("t", i + 2, x) for i, x in enumerate(src)], "title string, num int, text string")
    assert tracks.drift_windows(s, s).count() == 0
    assert {r.best for r in tracks.drift_windows(s, t).collect()} == {-1}
    assert tracks.merged_drift(tracks.drift_windows(s, t)).count() == 1


def test_interval_anti_join_equals_brute_force(spark):
    rng = random.Random(4)
    a = [("t", i, x := rng.randrange(10**6), x + rng.randrange(20000)) for i in range(200)]
    b = [("t", i, x := rng.randrange(10**6), x + rng.randrange(2000)) for i in range(40)]
    schema = "title string, id int, start_ms long, end_ms long"
    got = {r.id for r in tracks.without_neighbour(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 3000, 5000).collect()}
    assert got == {i for _, i, s, e in a if not any(y > s - 3000 and x < e + 3000 for _, _, x, y in b)}


def test_streams(spark):
    rows = [("t", 0, "subrip", None, {"language": "eng"}), ("t", 1, "subrip", None, {"language": "eng"}), ("t", 2, "hdmv_pgs_subtitle", None, {}), ("t", 3, "subrip", None, {"title": "Commentary"})]
    s = spark.createDataFrame(rows, "title string, index int, codec_name string, disposition struct<default:int,forced:int,hearing_impaired:int>, tags map<string,string>")
    r = tracks.chosen_streams(tracks.subtitle_scores(s)).first()
    assert (r["index"], r.score, r.tied) == (1, 100, True)


def test_state_keeps_what_a_change_leaves_out(spark):
    s = spark.createDataFrame([("a", "pending", "v1", 1)], "key string, status string, version string, updated_at int")
    r = tracks.latest(s, spark.createDataFrame([("a", "done", 2)], "key string, status string, updated_at int"), ["key"]).first()
    assert (r.status, r.version, r.updated_at) == ("done", "v1", 2)


def test_delivery_backs_up_what_it_overwrites(spark, tmp_path):
    (tmp_path / "a.srt").write_text("before")
    rows = [("a", "after", f"{tmp_path}/./a.srt"), ("b", "new", f"{tmp_path}/elsewhere.srt")]
    df = spark.createDataFrame(rows, "title string, text string, path string")
    assert sinks.deliver(df, str(tmp_path)) == ["a", "b"] == sinks.deliver(df, str(tmp_path))
    assert {p.name: p.read_text() for p in tmp_path.iterdir() if p.is_file() and not p.name.endswith(".crc")} == {"a.srt": "after", "a.srt.bak": "before", "b.srt": "new"}
    with pytest.raises(Exception, match="byte order mark"):
        sinks.deliver(spark.createDataFrame([("c", "﻿x")], "title string, text string"), str(tmp_path))
    assert not list(tmp_path.glob("*.tmp")) and not (tmp_path / "c.srt").exists()


def test_documents_are_written_and_read(spark, tmp_path):
    c = track(spark, [("a", 0, 1), ("b", 2, 3)])
    sinks.write_documents(sinks.source_documents(c), f"{tmp_path}/source")
    got = subtitles.read_json(spark, f"{tmp_path}/source", "pos int, num int, text string").orderBy("pos").collect()
    assert [(r.pos, r.text) for r in got] == [(1, "a"), (2, "b")]
    sinks.write_documents(sinks.slice_documents(cues.sliced(c, 2)), f"{tmp_path}/slices")
    assert spark.read.text(f"{tmp_path}/slices").orderBy("part").first().value == '[{"num":1,"text":"a"}]'
    sinks.write_tables(c, f"{tmp_path}/tables", "title")
    assert spark.read.parquet(f"{tmp_path}/tables").count() == 2


def test_source_json_writes_a_file_a_title_and_no_more(spark, tmp_path, monkeypatch):
    """No folder and no checksum for each title, whose processes took most of the time; an empty table is no fault."""
    rows = [(-5, 1, "a", "é\nb"), (-5, 0, "a", "x"), (7, 0, "b", None)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3).write.parquet(f"{tmp_path}/in/conversations.parquet")
    monkeypatch.setattr(queries_files.state, "scratch", lambda _: f"file://{tmp_path}/out")
    got = [(r.title, r.pos, r.num, r.text) for r in queries_files.source_json(spark, f"{tmp_path}/in").orderBy("title", "pos").collect()]
    assert got == [(-5, 1, 1, "x"), (-5, 2, 2, "é\nb"), (7, 1, 1, "")]
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*")) == ["source", "source/-5.json", "source/7.json"]
    sinks.write_titles(spark.createDataFrame([], "title long, json string"), f"file://{tmp_path}/none")
    assert subtitles.read_json(spark, f"{tmp_path}/none", "pos int").count() == 0
    with pytest.raises(Exception, match="no name for a file"):
        sinks.write_titles(spark.createDataFrame([("a/b", "[]")], "title string, json string"), f"file://{tmp_path}/bad")


def test_settings(spark, tmp_path):
    assert settings.merged({"a": {"x": 1, "y": 2}, "b": 3}, {"a": {"y": 5, "z": None}, "b": None, "c": 4}) == {"a": {"x": 1, "y": 5}, "b": 3, "c": 4}
    assert settings.merged({"a": 1}, None) == {"a": 1}
    language = {"banned": {"terms": ["foo"], "context_exempt": [{"term": "tío", "before": ["mi"]}]}, "leftover_source_markers": ["the"], "kept_loanwords": ["right"], "readability": {"max_cpl": 40, "min_duration": 0.8}}
    (tmp_path / "pack.json").write_text(json.dumps(language))
    (tmp_path / "empty.json").write_text("")
    read = settings.read(spark, f"{tmp_path}/pack.json")
    assert read == language and settings.read(spark, f"{tmp_path}/empty.json") == {}
    got = settings.settings({"readability": {"max_cpl": 44}, "named_entities_keep_verbatim": ["Ana", "House -> Casa"], "catchphrases": [{"find": "a", "replace": "b"}, {"find": "c"}], "asr": {"hallucination_min_repeats": 4}}, read)
    assert (got.options.max_cpl, got.options.min_duration_ms, got.options.min_repeats) == (44, 800, 4)
    assert got.pack.entities == (("Ana", "Ana"), ("House", "Casa")) and got.pack.exempt == (("tío", Sense(before=("mi",))),) and len(got.fixes) == 1
    pytest.importorskip("yaml")
    (tmp_path / "p.yaml").write_text("readability:\n  max_cpl: 30\n")
    assert settings.read(spark, f"{tmp_path}/p.yaml") == {"readability": {"max_cpl": 30}}
    with pytest.raises(ValueError, match="pack.kept_loanwords must be a list"):
        settings.pack({"kept_loanwords": "right"})


def test_adapters_and_ledger(spark):
    src = spark.createDataFrame([("t", 1, "uno"), ("t", 2, "dos")], "title string, num int, text string")

    def shout():
        return lambda pdf: pdf.assign(text=pdf.text.str.upper())

    assert [r.text for r in providers.adapted(src, "translate", shout).orderBy("num").collect()] == ["UNO", "DOS"]
    with pytest.raises(Exception, match="gives no"):
        providers.adapted(src, "words", shout).collect()
    events = [("t", "a", "MAJOR", "open", "", 1), ("t", "a", "MAJOR", "open", "", 2), ("t", "b", "MAJOR", "rejected-with-evidence", " ", 1), ("u", "c", "MINOR", "open", "", 1), ("v", "d", "CRITICAL", "open", "", 1)]
    e = spark.createDataFrame(events, "title string, issue string, severity string, state string, evidence string, round int")
    assert {r.title: r.verdict for r in providers.verdicts(e).collect()} == {"t": "NEEDS-HUMAN", "u": "PROCEED", "v": "REVIEW"}
    assert [(r.issue, r.rule) for r in providers.ledger_problems(e).collect()] == [("b", "no-evidence")]


def test_batch_heads_take_spaces_and_wide_ranges_are_rows(spark):
    files = spark.createDataFrame([("t", "a", "3 .. 4|||x\n5..2000000000|||y")], "title string, file string, text string")
    e = subtitles.batch_entries(files)
    assert [(r.lo, r.hi, r.text) for r in e.orderBy("lo").collect()] == [(3, 4, "x"), (5, 2000000000, "y")]
    assert batches.overlaps(e).count() == 0
    four = track(spark, [("s", 0, 1)] * 4)
    assert sorted((r.num, r.upto, r.kind) for r in batches.coverage(four, e).collect()) == [(1, 1, "missing"), (2, 2, "missing"), (5, 2000000000, "extra")]
    whole = spark.createDataFrame([("t", "a", 1, 20_000, "x"), ("t", "b", 7, 9, "y"), ("t", "b", 8, 12, "z")], "title string, file string, lo int, hi int, text string")
    many = spark.range(1, 20_001).selectExpr("'t' as title", "cast(id as int) as num")
    assert batches.coverage(many, whole).count() == 0
    assert sorted((r.num, r.upto, r.kind, r.files) for r in batches.overlaps(whole).collect()) == [(7, 7, "two-files", 2), (8, 9, "two-files", 2), (10, 12, "two-files", 2)]


def test_sweeps_equal_numbers_one_by_one(spark):
    rng = random.Random(11)
    entries = [(rng.choice("tu"), rng.choice("ab"), lo := rng.randrange(40), lo + rng.choice((0, 0, 1, 5, -2)), "x") for _ in range(60)]
    source = [(t, n) for t in "tu" for n in rng.sample(range(45), 25)]
    e = spark.createDataFrame(entries, "title string, file string, lo int, hi int, text string")
    c = spark.createDataFrame(source, "title string, num int")
    held = {}
    for t, f, lo, hi, _ in entries:
        for n in range(lo, hi + 1):
            held.setdefault((t, n), []).append(f)
    twice = {(t, n): ("two-files" if len(set(f)) > 1 else "same-file", len(set(f))) for (t, n), f in held.items() if len(f) > 1}
    assert {(r.title, n): (r.kind, r.files) for r in batches.overlaps(e).collect() for n in range(r.num, r.upto + 1)} == twice
    wrong = {(t, n, "missing") for t, n in source if (t, n) not in held} | {(t, n, "extra") for t, n in held if (t, n) not in source}
    assert {(r.title, n, r.kind) for r in batches.coverage(c, e).collect() for n in range(r.num, r.upto + 1)} == wrong


def test_gates(spark):
    said = ["Uno dos tres", "[music]", "Cuatro"]
    src = track(spark, [(s, 4000 * i + 1000, 4000 * i + 3000) for i, s in enumerate(said)]).withColumn("ts", timing.format_span(F.col("start_ms"), F.col("end_ms")))
    src = cues.classified(src.unionByName(src.withColumn("title", F.lit("u"))))
    files = spark.createDataFrame([("t", "w", "1|||Eins zwei drei\n2|||<DROP>\n3|||Vier"), ("u", "w", "1|||Eins\n3|||Vier")], "title string, file string, text string")
    allowed = spark.createDataFrame([], "title string, num int, reason string")
    done = gates.finalize(src, files, allowed, Pack())
    assert {r.title: r.ok for r in done.gates.groupBy("title").agg(F.bool_and("passed").alias("ok")).collect()} == {"t": True, "u": False}
    assert [r.title for r in done.files().collect()] == ["t"] and done.files().first().text.startswith("1\n00:00:01,000 --> 00:00:03,000\nEins zwei drei\n")
    states = {r.title: (r.status, r.stage) for r in done.states().collect()}
    assert states == {"t": ("done", None), "u": ("built", "normalize")}


def test_ready_slices_of_a_stream(spark, tmp_path):
    """UNSTABLE at once, READY once after the wait however often it is looked at, UNSTABLE again after a change."""
    inbox, schema = tmp_path / "in", "title string, part int, hi int, last int, size long, mtime double"
    inbox.mkdir()

    def put(name, *rows):
        (inbox / f".{name}").write_text("\n".join(json.dumps(dict(zip(("title", "part", "hi", "last", "size", "mtime"), r, strict=True))) for r in rows))
        (inbox / f".{name}").rename(inbox / f"{name}.json")

    put("1", ("t", 1, 9, 9, 100, 1.0), ("t", 2, 9, 4, 50, 1.0))
    stream = readiness.ready_slices(spark.readStream.schema(schema).json(str(inbox)), 1500)
    run = stream.writeStream.format("memory").queryName("flags").outputMode("append").trigger(processingTime="200 milliseconds").option("checkpointLocation", f"{tmp_path}/at").start()

    def said(part):
        return [r.flag for r in spark.sql(f"select flag from flags where part = {part}").collect()]

    def wait(part, want):
        end = time.time() + 60
        while said(part) != want and time.time() < end:
            time.sleep(0.2)
        assert said(part) == want

    try:
        wait(1, ["UNSTABLE"])
        for k in range(4):
            put(f"again{k}", ("t", 1, 9, 9, 100, 1.0))
            time.sleep(0.5)
        wait(1, ["UNSTABLE", "READY"])
        put("same", ("t", 1, 9, 9, 100, 1.0))
        time.sleep(2)
        assert said(1) == ["UNSTABLE", "READY"] and said(2)[0] == "LAST-CUE" and "READY" not in said(2)
        put("late", ("t", 1, 9, 9, 120, 2.0))
        wait(1, ["UNSTABLE", "READY", "UNSTABLE", "READY"])
    finally:
        run.stop()


def test_slices_nobody_changes_are_forgotten(spark, tmp_path):
    """State goes after its time: the same look is new then, and the slice is UNSTABLE and READY once more."""
    inbox, schema = tmp_path / "in", "title string, part int, hi int, last int, size long, mtime double"
    inbox.mkdir()
    row = json.dumps({"title": "t", "part": 1, "hi": 9, "last": 9, "size": 100, "mtime": 1.0})

    def put(name):
        (inbox / f".{name}").write_text(row)
        (inbox / f".{name}").rename(inbox / f"{name}.json")

    put("1")
    stream = readiness.ready_slices(spark.readStream.schema(schema).json(str(inbox)), 300, 4000)
    run = stream.writeStream.format("memory").queryName("kept").outputMode("append").trigger(processingTime="200 milliseconds").option("checkpointLocation", f"{tmp_path}/at").start()

    def said():
        return [r.flag for r in spark.sql("select flag from kept").collect()]

    try:
        end = time.time() + 90
        while said() != ["UNSTABLE", "READY"] and time.time() < end:
            time.sleep(0.2)
        time.sleep(5)
        put("2")
        while len(said()) < 4 and time.time() < end:
            time.sleep(0.2)
        assert said() == ["UNSTABLE", "READY"] * 2
    finally:
        run.stop()
    with pytest.raises(ValueError, match="longer"):
        readiness.ready_slices(spark.readStream.schema(schema).json(str(inbox)), 300, 300)


def test_late_copies_count_once(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.sql("select 't' title, 'a' file, 1 lo, timestamp'2024-01-01 00:00:00' seen_at union all select 't', 'a', 1, timestamp'2024-01-01 00:01:00' union all select 't', 'b', 1, timestamp'2024-01-01 00:01:00'").write.parquet(path)
    stream = readiness.without_late_copies(spark.readStream.schema("title string, file string, lo int, seen_at timestamp").parquet(path))
    run = stream.writeStream.format("memory").queryName("copies").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert sorted(r.file for r in spark.table("copies").collect()) == ["a", "b"]


def test_delivery(spark, tmp_path):
    df = spark.createDataFrame([("a", SRT)], "title string, text string")
    assert sinks.deliver(df, str(tmp_path)) == ["a"]
    assert (tmp_path / "a.srt").read_text() == SRT
    read = subtitles.raw_files(spark, str(tmp_path)).first()
    assert (read.title, read.text, read.encoding) == ("a", SRT, "utf-8")
    spark.dataSource.register(subtitles.SrtSource)
    assert spark.read.format("srt").load(str(tmp_path)).first().text == SRT


def test_build_queries_see_whole_texts(spark, tmp_path):
    """What lies behind the thirtieth character of a turn, and its lines, reach the build and the findings."""
    long = "- one line of the turn\n- a second one\n- a third one"
    said = ["short", long, "x" * 30 + " <i>1 2 3</i>", "4 5 6 <b>y</b>", "one", "two", "x" * 40 + "\n\nlast", "eight", "nine", "ten", "eleven", "twelve", "thirteen"]
    rows = [(c, i, "user", t) for c in (1, 2) for i, t in enumerate(said)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    wrong = {(r.title, r.num, r.rule) for r in queries.QUERIES["build_problems"](spark, str(tmp_path)).collect()}
    assert {(1, 2, "too-many-lines"), (1, 7, "blank-line")} <= wrong
    rules = {r.rule for r in queries.QUERIES["manifest_findings"](spark, str(tmp_path)).collect()}
    assert rules == {"lost-cue", "manifest-count", "ts-differs", "covered-twice", "unaccounted", "dropped-not-droppable", "tag-set-differs", "digit-drift", "inaudible-marker"}
