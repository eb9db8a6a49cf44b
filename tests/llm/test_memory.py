"""What Python workers hold and give back."""

import re

import pyarrow as pa

from cuewright.llm import packing
from cuewright.llm.common import SLICE_BYTES, give_back, map_rows


def resident():
    with open("/proc/self/status") as f:
        return int(re.search(r"VmRSS:\s+(\d+)", f.read())[1]) / 1024


def test_batches_are_bounded_in_bytes(spark):
    docs = spark.range(0, 1600, 1, 1).selectExpr("id AS doc_id", "repeat('words of ten', 1000) AS text")  # 19 MB in one task
    assert map_rows(docs, lambda: lambda x: {"n": [len(t) for t in x["text"]]}, "n long").where("n = 12000").count() == 1600

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})

    got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 18 << 20 and max(got) < SLICE_BYTES + (1 << 20)


def test_rows_longer_than_a_batch(spark):
    docs = spark.range(0, 3, 1, 1).selectExpr("id AS doc_id", "repeat('abcdefgh', 700000) AS text")
    assert [r.n for r in map_rows(docs, lambda: lambda x: {"n": [len(t) for t in x["text"]]}, "n long").collect()] == [5_600_000] * 3


def test_freed_memory_is_given_back():
    blocks = [bytes(3000) for _ in range(30_000)]
    pins = blocks[::300]  # what lives on keeps the heap from shrinking by itself
    full = resident()
    del blocks
    give_back()
    assert resident() < full - 60 and len(pins) == 100


def test_bound_of_remembered_chunks():
    texts = [" ".join(f"word{i}x{k}, and" for k in range(300)) for i in range(40)]
    whole, small = packing.Encoder(packing.tokenizer_path()), packing.Encoder(packing.tokenizer_path(), 100_000)
    for t in texts:
        assert whole([t]) == small([t])
    assert small.held < 400_000 < whole.held and len(small.known) < len(whole.known) / 4
