import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuewright.llm import lines
from cuewright.llm.hashing import mix

SPACES = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10):
    """rows: (doc_id, text)."""
    key = lambda line: line.strip(SPACES).translate(LOWER)
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= least:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        stay = [x for x in own if d is None or len(key(x)) < least or len(holders[key(x)]) < 2 or min(holders[key(x)]) == d]
        out.append((d, len(own), len(own) - len(stay), "\n".join(stay)))
    return out


def invented():
    rng = random.Random(9)
    pool = [" ".join(rng.choice(("Ärger", "the", "menu", "Read more", "©2024", "x")) for _ in range(rng.randint(1, 12))) for _ in range(60)] + ["", " ", "short", "é" * 9, "É" * 10, "z" * 500]
    rows = [(i, "\n".join(rng.choice(("", " ", "\t", "\r", "\v")) + (rng.choice(pool) if rng.random() < 0.6 else f"line {i} {rng.random()}") + rng.choice(("", "\r", "  ")) for _ in range(rng.randint(1, 15)))) for i in range(80)]
    rows += [(i, rows[7][1].swapcase()) for i in range(80, 90)] + [rows[3], rows[3], (5, "Another text of five\nread more the menu the x"), (None, rows[3][1]), (None, rows[3][1]), (-4, None), (95, ""), (96, "\n\n")]
    rows += [(97, "only here, twice only here\nonly here, twice only here"), (98, "\x00 nul and \x85 wide   spaces\nlast"), (99, "x" * 9 + "\n" + " wide space stays "), (100, "wide space stays\n wide space stays ")]
    return rows + [(200, "\n".join(f"a long text's line {i % 5000}" for i in range(30_000)))]


@pytest.mark.parametrize("least, bits", [(10, lines.MOST_BITS), (10, 1), (1, 1 << 22)])
def test_equals_brute_force(spark, least, bits):
    """Ties, repeated rows, ids that two texts share, no ids, odd white space, clashing columns; also when the filters are full."""
    rows = invented()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    df = df.withColumns({c: F.lit(1) for c in ("k1", "h1", "h2", "lines", "gone", "slice", "once", "twice")})
    got = Counter(map(tuple, lines.deduplicated_lines(df, least, bits).collect()))
    assert got == Counter(brute(rows, least))


def test_query_on_shared_rows(docs, rows, none):
    got = Counter(map(tuple, lines.digest(lines.deduplicated_lines(docs)).collect()))
    assert got == Counter((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute([r[:2] for r in rows]))
    assert lines.digest(lines.deduplicated_lines(none)).collect() == []


def test_blocks_of_lines(monkeypatch):
    texts = ["", "a\n\nbb  \n", "\n", " word " * 50 + "\n" + "é" * 12, "x"]
    whole = [(x[a:z].tobytes(), int(r), int(n)) for x, row, number, start, end in lines.keys(texts, 1) for r, n, a, z in zip(row, number, start, end, strict=True)]
    assert whole == [(k.encode(), r, n) for r, t in enumerate(texts) for n, x in enumerate(t.split("\n")) if (k := x.strip())]
    monkeypatch.setattr(lines, "BLOCK_BYTES", 7)
    small = [(x[a:z].tobytes(), int(r), int(n)) for x, row, number, start, end in lines.keys(texts, 1) for r, n, a, z in zip(row, number, start, end, strict=True)]
    assert small == whole and list(lines.keys([], 1)) == []


def test_filters(spark):
    """Nothing is forgotten; few others are found; only what came twice, in one task or in two, is in the second filter."""
    h = mix(np.arange(40_000, dtype=np.uint64))
    f = lines.Filter(1 << 19)
    f.add(h[:20_000])
    assert f.has(h[:20_000]).all() and f.has(h[20_000:]).mean() < 0.01
    assert lines.slice_bits(0, 1 << 30) == 512 and lines.slice_bits(1 << 20, 1 << 30) == 1 << 14 and lines.slice_bits(1 << 40, 1 << 30) == 1 << 20
    rows = [(i, f"said by one only {i}\nsaid by two of them {i // 2}") for i in range(4000)]
    base = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("k1", F.xxhash64("text"))
    found, bits = lines.repeats_filter(base)
    assert bits == lines.slice_bits(6000, lines.MOST_BITS)
    seen = lines.suspected(base, found, bits).collect()
    assert 4000 <= len(seen) < 4200  # 4,000 lines of two documents; of 4,000 others, those that collide
