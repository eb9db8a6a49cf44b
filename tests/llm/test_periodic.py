import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuewright.llm import periodic


def brute(w, least, times):
    """Every maximal stretch that a period goes through, by trying all periods; the smallest of equal stretches."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, z - a, q) for (a, z), q in out.items())


def invented(rng):
    k, w = rng.choice((1, 2, 2, 3, 5)), []
    while len(w) < rng.randint(0, 90):
        if rng.random() < 0.5 and w:
            w += w[rng.randrange(len(w)) :]
        else:
            w += [rng.randrange(k) for _ in range(rng.randint(1, 7))] * rng.choice((1, 1, 2, 4, 6))
    return w[:160]


@pytest.mark.parametrize("least, times", [(2, 2), (4, 2), (6, 3), (6, 4)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least * times)
    for _ in range(1500):
        w = invented(rng)
        want = brute(w, least, times)
        assert sorted((a, z - a, p) for a, z, p in periodic.runs_of(w, least, times)) == want
        parts = periodic.pieces(np.zeros(len(w), np.int64), np.array(w, np.int64), least, times).tolist()
        cut = [(s + a, e - s, p) for a, z in parts for s, e, p in periodic.runs_of(w[a:z], least, times)]
        assert sorted(cut) == want


def test_structured_words():
    """Fibonacci words have no fourth powers but many squares; one long period and all equal words are one run each."""
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic.runs_of(b, 6, 4) == [] and sorted((s, e - s, p) for s, e, p in periodic.runs_of(b, 2, 2)) == brute(b, 2, 2)
    assert periodic.runs_of([7] * 3000) == [(0, 3000, 1)]
    assert periodic.runs_of(list(range(500)) * 5) == [(0, 2500, 500)]


def test_factors_are_longest_earlier_stretches():
    rng = random.Random(2)
    for _ in range(300):
        w = invented(rng)
        parts = periodic.factors(w)
        assert [a for a, _ in parts] == sorted({a for a, _ in parts}) and parts[:1] == [(0, -1)][: len(w)]
        for (a, b), z in zip(parts, [*(a for a, _ in parts[1:]), len(w)][: len(parts)], strict=True):
            earlier = lambda n, a=a: [s for s in range(a) if w[s : s + n] == w[a : a + n]]
            assert (b in earlier(z - a) if b >= 0 else z == a + 1 and not earlier(1)) and (z == len(w) or b < 0 or not earlier(z - a + 1))


def test_cutting_stops_at_its_rounds(monkeypatch):
    """A piece that loses one word a round is still whole when the rounds are over, and gives the same runs."""
    w = [x for k in range(60) for x in (k, k + 1)] + [0, 1] * 9
    whole = sorted((a, z - a, p) for a, z, p in periodic.runs_of(w))
    for rounds in (0, 1, 3):
        monkeypatch.setattr(periodic, "ROUNDS", rounds)
        parts = periodic.pieces(np.zeros(len(w), np.int64), np.array(w, np.int64), 6, 4).tolist()
        assert sorted((s + a, e - s, p) for a, z in parts for s, e, p in periodic.runs_of(w[a:z])) == whole == brute(w, 6, 4)


def expected(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(len(w))]
    runs = brute(w, 6, 4)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    listed = sha("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode())
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, listed, sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_brute_force(spark, docs, rows):
    """Nulls, empty texts, repeated rows, rows without an id and clashing columns; ids that get a planted tail."""
    chosen = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rng = random.Random(4)
    more = [(i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.choice((1, 2, 9, 40, 150))))) for i in chosen]
    more += [(chosen[0], None), (chosen[1], " \x1c é "), (chosen[2], "")]
    small = [r for r in rows if len(r[1] or "") < 5000]
    held = {r[0] for r in small}
    both = docs.where(F.col("doc_id").isin(*[i for i in held if i is not None]) | F.col("doc_id").isNull()).unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = periodic.digest(periodic.periodic_runs(periodic.with_planted_tails(both)))
    want = Counter(expected(r[0], r[1]) for r in [*small, *more])
    assert Counter(map(tuple, got.collect())) == want and sum(bool(k[1]) * v for k, v in want.items()) > 5


def test_long_texts_and_empty_tables(spark, none):
    words = " ".join(f"w{i % 997}" for i in range(200_000))
    got = periodic.periodic_runs(spark.createDataFrame([(1, words)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(0, 200_000, 997)] and got.collapsed == " ".join(f"w{i}" for i in range(997))
    assert periodic.digest(periodic.periodic_runs(periodic.with_planted_tails(none))).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(none, times=1)
