import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cuewright.functions.rules import Options
from cuewright.operators import tracks, words

SCHEMA = "title string, pos int, word string, start double, end double"


def timed(said, pause=lambda i: 0.05):
    out, at = [], 0.0
    for i, w in enumerate(said):
        at += pause(i)
        out.append((w, round(at, 3), round(at + 0.3, 3)))
        at = round(at + 0.3, 3)
    return out


def frame(spark, titles):
    rows = [(t, i, *w) for t, ws in titles.items() for i, w in enumerate(ws)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_title(df, *columns):
    out = {}
    for r in df.orderBy("title", "pos").collect():
        out.setdefault(r.title, []).append(tuple(r[c] for c in columns))
    return out


def bare(w):
    return re.sub(r"[\W_]+", "", w.lower())


def brute_unlooped(ws):
    """Word by word: runs of a word, then for each length of phrase the first that comes four times in a row."""
    near = lambda a, b: b[1] - a[2] <= words.LOOP_GAP
    runs = []
    for w in ws:
        if runs and bare(w[0]) and bare(runs[-1][-1][0]) == bare(w[0]) and near(runs[-1][-1], w):
            runs[-1].append(w)
        else:
            runs.append([w])
    left = [w for r in runs for w in (r if len(r) < 5 else r[:2])]
    for n in (4, 3, 2):
        at, kept = 0, []
        while at < len(left):
            phrase, times = [bare(w[0]) for w in left[at : at + n]], 1
            while any(phrase) and [bare(w[0]) for w in left[at + n * times : at + n * (times + 1)]] == phrase and near(left[at + n * times - 1], left[at + n * times]):
                times += 1
            kept += left[at : at + (2 * n if times > 3 else 1)]
            at += n * times if times > 3 else 1
        left = kept
    return left


def brute_cues(ws, most):
    """One word after the other; ``open`` is the cue in the making."""
    joined = lambda x: " ".join(w[0] for w in x)
    clause, sentence = re.compile(words._CLAUSE), re.compile(words._SENTENCE)
    made, open_ = [], []
    for w in ws:
        if open_ and len(joined(open_)) + 1 + len(w[0]) > most:
            cuts = [i for i in range(1, len(open_)) if clause.search(open_[i - 1][0]) and len(joined(open_[:i])) >= most * 0.35] if len(open_) > 2 else []
            made, open_ = (made + [open_[: cuts[-1]]], open_[cuts[-1] :]) if cuts else (made + [open_], [])
        elif open_ and (w[1] - open_[-1][2] >= words.GAP_SPLIT or w[2] - open_[0][1] > words.MAX_CUE):
            made, open_ = made + [open_], []
        open_ = [*open_, w]
        if sentence.search(w[0]) and len(joined(open_)) >= most * 0.45:
            made, open_ = made + [open_], []
    made += [open_] if open_ else []
    out = []
    for cue in made:
        while len(cue) > 1 and len(joined(cue)) > most:
            fits = [i for i in range(1, len(cue)) if len(joined(cue[:i])) <= most]
            rank = lambda i, c=cue: (bool(clause.search(c[i - 1][0])), len(joined(c[:i])) >= most * 0.4, i)
            cut = max(fits, key=rank) if fits else max(1, len(cue) // 2)
            out.append(cue[:cut])
            cue = cue[cut:]
        out.append(cue)
    return [(joined(c), c[0][1], c[-1][2]) for c in out if not re.fullmatch(r"[\W_]+", joined(c))]


def looping(rng):
    said = []
    while len(said) < 260:
        said += [rng.choice(("a", "b", "B!", "c", "...", "no", "d")) for _ in range(rng.randint(1, 6))] * rng.choice((1, 1, 2, 3, 4, 5, 7))
    return timed(said, lambda i: rng.choice((0.05, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05, 0.5)))


def test_loops_equal_brute_force(spark):
    """Phrases in phrases, loops that meet, bare tokens, pauses within and between repetitions, many titles and a lone word."""
    rng = random.Random(12)
    titles = {f"t{k}": looping(rng) for k in range(40)} | {"one": timed(["x"]), "same": timed(["no"] * 300), "bare": timed(["...", "!"] * 9), "gone": timed(["a", "b", "c", "d"] * 60)}
    want = {t: [(w,) for w, _, _ in brute_unlooped(ws)] for t, ws in titles.items()}
    got = by_title(words.unlooped(frame(spark, titles)), "word")
    assert got == want and sum(len(x) for x in want.values()) < sum(len(x) for x in titles.values()) * 0.9
    assert by_title(words.unlooped(frame(spark, {"t": timed(["no"] * 4 + ["go", "on"] * 3)})), "word") == {"t": [(w,) for w in ["no"] * 4 + ["go", "on"] * 3]}


def spoken(rng, n, longest=9, commas=1):
    said = ["x" * rng.randint(1, longest) + rng.choice(("", "", "", "", *("," * commas), ".")) for _ in range(n)]
    return timed(said, lambda i: rng.choice((0.02, 0.05, 0.1, 0.3, 0.7, 1.5)) if rng.random() < 0.25 else 0.05)


@pytest.mark.parametrize("most", [20, 84])
def test_cuts_equal_brute_force(most):
    rng = random.Random(most)
    for k in range(300):
        ws = spoken(rng, rng.randint(0, 120), rng.choice((4, 9, 30)), k % 3)
        start, end = np.array([w[1] for w in ws]), np.array([w[2] for w in ws])
        cut = words.Cutter([w[0] for w in ws], start, end, most).cues()
        got = [(" ".join(w[0] for w in ws[a:b]), ws[a][1], ws[b - 1][2]) for a, b in cut]
        assert [g for g in got if not re.fullmatch(r"[\W_]+", g[0])] == brute_cues(ws, most)


def test_parts_change_no_cue(spark):
    """A long title is many parts, and its cues are those of one pass over all its words; blank and unfinished words are skipped."""
    rng = random.Random(5)
    titles = {f"t{k}": spoken(rng, 400, rng.choice((4, 9, 60, 120)), k % 4) for k in range(24)} | {"punct": timed(["...", "!"]), "one": timed(["word"])}
    for opt in (Options(), Options(max_cpl=10)):
        most = opt.max_cpl * opt.max_lines
        want = {t: c for t, ws in titles.items() if (c := [(x, a, z) for x, a, z in brute_cues(brute_unlooped(ws), most)])}
        df = frame(spark, titles)
        got = by_title(words.cues_of_words(df, opt), "text", "start", "end")
        assert got == want
        parts = {r.title: r.n for r in words.with_parts(df, most).groupBy("title").agg({"part": "max"}).withColumnRenamed("max(part)", "n").collect()}
        assert max(parts.values()) > 8
    bad = spark.createDataFrame([("t", 0, None, 0.0, 0.1), ("t", 1, "a", None, 0.1), ("t", 2, " b ", 1.0, 1.2), ("t", 3, " ", 1.3, 1.4)], SCHEMA)
    assert by_title(words.cues_of_words(bad), "pos", "text") == {"t": [(1, "b")]}
    assert words.cues_of_words(bad.where("false")).collect() == []


def test_transcribed_is_timed_and_wrapped(spark):
    rng = random.Random(8)
    got = words.transcribed(frame(spark, {"t": spoken(rng, 500)})).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, len(got) + 1)) and all(a.end_ms <= b.start_ms for a, b in zip(got, got[1:], strict=False))
    assert max(len(line) for r in got for line in r.text.split("\n")) <= 84


def test_folds_carry_a_title_over_batches(spark):
    """More rows than an Arrow batch holds, in one title; the state goes on, and starts again with the next title."""
    n = 25_000
    df = spark.range(n).selectExpr("'t' as title", "id as start_ms", "id + 3 as end_ms", "'x' as text")
    other = spark.range(3).selectExpr("'u' as title", "id * 10 as start_ms", "id * 10 + 3 as end_ms", "'x' as text")
    got = tracks.merged_track(df, other)
    last = got.where("title = 't'").orderBy("pos").collect()
    before, want = None, []
    for i in range(n):
        s = i if before is None or i >= before else before + 1
        before = i + 3 if i + 3 > s else s + tracks.SQUEEZED_MS
        want.append((i + 1, s, before))
    assert [(r.pos, r.start_ms, r.end_ms) for r in last] == want
    assert [(r.start_ms, r.end_ms) for r in got.where("title = 'u'").orderBy("pos").collect()] == [(0, 3), (10, 13), (20, 23)]


@pytest.mark.parametrize("rows", [1, 7, 64])
def test_streams_do_not_depend_on_batches(spark, rows):
    """Loops and cues that begin in one batch and end many batches later, long loops, and titles that end within a batch."""
    rng = random.Random(rows)
    titles = {f"t{k}": looping(rng)[:120] for k in range(3)} | {"long": timed(["a", "b", "c"] * 50 + ["no"] * 90 + ["x,", "y"] * 40), "one": timed(["x"]), "said": spoken(rng, 250, 30, 1)}
    loops = {t: [(w,) for w, _, _ in brute_unlooped(ws)] for t, ws in titles.items()}
    most = Options().max_cpl * Options().max_lines
    cues = {t: [(x, a, z) for x, a, z in brute_cues(brute_unlooped(ws), most)] for t, ws in titles.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        df = frame(spark, titles)
        assert by_title(words.unlooped(df), "word") == loops
        assert by_title(words.cues_of_words(df), "text", "start", "end") == cues
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_stream_holds_few_words():
    """A loop without end is not held, nor a title: some repetitions and one cue's words are."""
    loops, cuts, n = words.Unlooper(), words.Cuts(84), 0
    for k in range(60):
        said = [f"{'abcd'[i % 4] if k < 30 else i}" for i in range(1000 * k, 1000 * k + 1000)]
        start = np.arange(1000 * k, 1000 * k + 1000) * 0.35
        batch = pa.record_batch({"title": ["t"] * 1000, "pos": range(1000), "word": said, "start": start, "end": start + 0.3, "i": range(1000 * k + 1, 1000 * k + 1001), "token": said})
        n += len(list(cuts.push(loops.push(batch))))
        assert loops.held.num_rows < 100 and len(cuts.words) < 100
    assert n > 1000


def test_words_dealt_by_title_are_shuffled_once(spark, tmp_path):
    from cuewright.plans import queries, queries_files  # noqa: F401

    spark.createDataFrame([(i, "a b c d") for i in range(20)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("stutter", "loop_ngrams", "skipped_words", "segment_words"):
        plan = queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan, (name, plan)


def test_drafts_are_shuffled_with_their_cues_alone(spark, tmp_path):
    """Documents once, cues to be timed, and timed cues to be counted: no join, and no step planned twice."""
    from cuewright.plans import queries, queries_files  # noqa: F401

    spark.createDataFrame([(i, "a b c d") for i in range(20)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    plan = queries.QUERIES["transcribe"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("MapInArrow") == 2 and "Join" not in plan, plan
