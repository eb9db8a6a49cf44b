import random
import time

import pytest
from pyspark.sql import functions as F

from cuewright.operators import validate

SCHEMA = "title string, pos int, num int, ts string"


def walk(source, target):
    """Line by line: (places taken, number of the first target cue that finds none)."""
    at, taken = 0, []
    for num, ts in target:
        found = next((i for i in range(at, len(source)) if source[i] == ts), None)
        if found is None:
            return taken, num
        taken.append(found)
        at = found + 1
    return taken, None


def test_ordered_timestamps_equal_a_walk(spark):
    """Lines that come once, often, or nowhere; targets in order, out of order, too long; titles on one side only."""
    rng = random.Random(7)
    source, target, titles = [], [], {}
    for k in range(120):
        often = k % 3
        s = [str(rng.randrange((10**6, 12, 4)[often])) for _ in range(rng.randint(0, 30))]
        t = [x for x in s if rng.random() < 0.6]
        if rng.random() < 0.5 and t:
            t.insert(rng.randrange(len(t)), rng.choice(("nowhere", *s)))
        titles[f"t{k}"] = (s, t)
        source += [(f"t{k}", 3 * i, i + 1, x) for i, x in enumerate(s)]
        target += [(f"t{k}", 2 * i, 100 + i, x) for i, x in enumerate(t)]
    src = spark.createDataFrame(source, SCHEMA).withColumn("droppable", F.col("num") % 4 == 0).repartition(3)
    tgt = spark.createDataFrame(target, SCHEMA).repartition(3)
    want_bad, want_lost = set(), set()
    for name, (s, t) in titles.items():
        taken, bad = walk(s, list(zip(range(100, 100 + len(t)), t, strict=True)))
        if bad is not None:
            want_bad.add((name, bad))
        want_lost |= {(name, i + 1) for i in range(len(s)) if i not in taken and (i + 1) % 4}
    assert {(r.title, r.num) for r in validate.ordered_timestamps(tgt, src).collect()} == want_bad and len(want_bad) > 20
    got = [(r.title, r.num) for r in validate.dropped_dialogue(tgt, src).collect()]
    assert len(got) == len(set(got)) and set(got) == want_lost


@pytest.mark.parametrize("lines", [50_000, 40])
def test_a_long_title_takes_seconds(spark, lines):
    n = 50_000
    c = spark.range(n).select(F.lit("t").alias("title"), F.col("id").cast("int").alias("pos"), F.col("id").cast("int").alias("num"), (F.col("id") % lines).cast("string").alias("ts"), F.lit(False).alias("droppable"))
    t = c.where("pos % 5 <> 0")
    began = time.time()
    assert validate.ordered_timestamps(t, c).count() == 0
    assert time.time() - began < 30
    assert validate.dropped_dialogue(t, c).count() == n // 5
