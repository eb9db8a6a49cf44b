"""Findings and statistics of tracks, case by case."""

import pytest
from pyspark.sql import functions as F

from cuewright.functions.rules import Options, Pack
from cuewright.operators import cues, tracks, validate


def track(spark, rows):
    data = [("t", i + 1, i + 1, text, a, b) for i, (text, a, b) in enumerate(rows)]
    return spark.createDataFrame(data, "title string, pos int, num int, text string, start_ms long, end_ms long")


def said(spark, rows, *rules, opt=Options()):
    found = cues.qa_findings(track(spark, rows), opt)
    return sorted((r.num, r.rule, r.detail) for r in found.collect() if r.rule in rules)


def at(texts, step=2000, long=1000):
    return [(t, step * i, step * i + long) for i, t in enumerate(texts)]


def test_repeats_are_seen_over_empty_cues(spark):
    rows = at(["Hola a todos", "", "Hola, a todos", "...", "hola a todos", "<i></i>", "Hola a todos!"])
    assert said(spark, rows, "dup-adjacent") == [(3, "dup-adjacent", ""), (7, "dup-adjacent", "")]  # signs alone are in between 3 and 5
    back = [("a a", 0, 500), ("a a", 900, 800), ("a a", 1000, 1500)]
    assert said(spark, back, "dup-adjacent", "inverted") == [(2, "inverted", ""), (3, "dup-adjacent", "")]


def test_blank_lines_are_no_lines(spark):
    rows = at(["a\n\nb", "a\n \nb\n\t\nc", "a\nb\nc", "\n\n\n"])
    assert said(spark, rows, "lines", "empty") == [(2, "lines", "3"), (3, "lines", "3"), (4, "empty", "")]
    got = validate.target_findings(track(spark, rows), Pack()).where("rule = 'lines'")
    assert sorted(r.num for r in got.collect()) == [2, 3]


def test_empty_cues_say_nothing_else(spark):
    rows = [("<i>", 0, 1000), ("  ", 1500, 1600)]
    assert said(spark, rows, "empty", "unbalanced", "short", "cps-hard") == [(1, "empty", ""), (2, "empty", ""), (2, "short", "100")]


def test_overlaps_of_cues_out_of_order_and_first_silences(spark):
    rows = [("a", 5000, 9000), ("b", 2000, 6000), ("c", 5500, 7000)]
    assert said(spark, rows, "overlap", "non-monotonic") == [(2, "non-monotonic", ""), (2, "overlap", "7000"), (3, "overlap", "500")]
    assert cues.overlap_counts(track(spark, rows)).first().overlaps == 2
    far = at([f"cue {i}" for i in range(9)], step=130_000)
    assert [n for n, _, _ in said(spark, far, "gap")] == [2, 3, 4, 5, 6]


def test_boilerplate_notes(spark):
    rows = at(["Thanks for watching!", "Hello", "thanks for watching", "(Thanks for watching!)", "Subtitles by Amara.org", "Thanks for watching the dog."])
    recurs = [(1, "Thanks for watching!"), (3, "thanks for watching"), (4, "(Thanks for watching!)")]
    for opt, note in ((Options(), "recurs, will be removed"), (Options(strip_boilerplate=False), "recurs, but removal is off")):
        want = [(n, "boilerplate", f"{t}: {note}") for n, t in recurs] + [(5, "boilerplate", "Subtitles by Amara.org: below 3 repeats, stays")]
        assert said(spark, rows, "boilerplate", opt=opt) == want
    assert len(said(spark, rows, "boilerplate", opt=Options(min_repeats=1))) == 4


def test_summary(spark):
    """Widths are those of all lines, speeds leave empty cues out, durations don't; inverted cues count as cues alone."""
    rows = [("x" * 50 + "\n" + "y" * 10, 0, 2000), ("", 3000, 3100), ("a\n\nb\nc", 3050, 5050), ("z" * 60, 6000, 8000), ("back", 9000, 8000), ("Thanks for watching!", 9000, 9500)]
    r = cues.qa_summary(track(spark, rows)).first()
    assert (r.n, r.runtime_ms, r.dur_p50, r.shortest_ms) == (6, 9500, 2000, 100)
    assert (r.cpl_max, r.cpl_p50, r.cpl_p90, r.long_lines, r.many_lines) == (60, 10, 50, 2, 1)  # widths 1 1 1 10 20 50 60
    assert (r.cps_max, r.cps_p50, r.over_hard, r.over_target) == (36000, 30000, 3, 0)  # 30, 1.5, 30 and 36 a second
    assert (r.short, r.overlaps, r.boilerplate, r.removable) == (2, 1, 1, 0)
    empty = cues.qa_summary(track(spark, [("", 5, 4)])).first()
    assert (empty.n, empty.cps_max, empty.dur_p50, empty.overlaps) == (1, None, None, 0)


STREAM = "title string, index int, codec_type string, channels int, disposition struct<default:int,comment:int>, tags map<string,string>"


def audio(title, index, lang, channels=2, name="", default=0, comment=0):
    return (title, index, "audio", channels, (default, comment), {"language": lang, "title": name})


def test_audio_choice(spark):
    rows = [audio("equal", 1, "eng"), audio("equal", 2, "eng"), audio("equal", 3, "fra", 6), audio("foreign", 1, "fra"), audio("none", 1, "eng", name="Director's Commentary"), audio("marked", 1, "eng", 8, comment=1),
            audio("marked", 2, "en"), audio("unknown", 1, "und", 1), audio("forced", 1, "fra"), audio("short", 1, "e", 2), audio("loud", 1, "fra", 12, default=1), audio("descr", 1, "eng", name="Descriptive"), audio("descr", 2, "", 0)]
    scores = tracks.audio_scores(spark.createDataFrame(rows, STREAM))
    got = tracks.chosen_audio(scores, spark.createDataFrame([("forced", 1)], "title string, index int"))
    assert {r.title: (r["index"], r.score, r.refused) for r in got.collect()} == {
        "equal": (1, 102, False), "foreign": (None, None, True), "none": (None, None, True), "marked": (2, 102, False), "unknown": (1, 11, False), "forced": (1, None, False), "short": (1, 102, False),
        "loud": (1, 13, False), "descr": (2, 10, False)}
    old = spark.createDataFrame([("t", 0, "audio", 2, (1,), {"language": "eng"})], "title string, index int, codec_type string, channels int, disposition struct<default:int>, tags map<string,string>")
    assert tracks.audio_scores(old).first().score == 107


@pytest.mark.parametrize("rows", [[], [("a", 0, 1)]])
def test_few_rows(spark, rows):
    df = track(spark, rows)
    assert cues.qa_summary(df).count() == len(rows) and cues.qa_findings(df.where(F.lit(False))).count() == 0


def test_slices_are_sorted_once_and_not_grouped(spark):
    """Numbers need not follow places; few cues give fewer parts, and one plan has one exchange, one sort and no aggregate."""
    rows = [(t, p, (7 * p) % 11 if p != 3 else None) for t, n in (("a", 10), ("b", 2), ("c", 1), ("d", 9)) for p in range(n)]
    df = spark.createDataFrame(rows, "title string, pos int, num int").repartition(3)
    got = cues.slice_contract(df, 4)
    want = set()
    for t in "abcd":
        nums = [num for title, _, num in rows if title == t]
        size = -(-len(nums) // 4)
        want |= {(t, k // size + 1, nums[k], nums[k : k + size][-1], len(nums[k : k + size])) for k in range(0, len(nums), size)}
    assert {tuple(r) for r in got.collect()} == want
    plan = df.sparkSession.createDataFrame(rows, "title string, pos int, num int")
    plan = cues.slice_contract(plan, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "Aggregate" not in plan, plan
