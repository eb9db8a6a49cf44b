import re

import pytest

import corpus_pipeline as P
from cuewright.llm import pii

BENCH = ["alpha bravo charlie delta echo foxtrot golf hotel india", "one red fox went over two lazy brown dogs today"]
EN = "the and of with this from they have been which".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of which each stage must drop or change known ones."""
    path = str(tmp_path_factory.mktemp("sf"))
    rows, n = [], 40
    for i in range(n):
        rows.append((i, " ".join(f"{EN[(i + j) % 10]} w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}" for j in range(30 + i)), "en", "s", 0))
    rows += [(100, rows[5][1], "en", "s", 0), (101, rows[6][1] + " tail", "en", "s", 0), (102, "123 456", "en", "s", 0), (103, None, "en", "s", 0),
             (104, f"the {BENCH[0]} and {BENCH[1]} of", "en", "s", 0), (105, f"{rows[7][1][:60]} mail me at a.b@example.com now of the", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(BENCH)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {r[0]: r[1] for r in rows}


def shingles(text, n=5):
    ws = text.lower().split()
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))}


def test_stages_against_brute_force(spark, folder):
    path, texts = folder
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        docs = stage(spark, docs, path)
        assert tuple(docs.columns) == P.COLUMNS, k
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id: r.text for r in docs.collect()})
    lettered = {i for i, t in texts.items() if t and re.search("[a-z]", t)}
    assert set(kept[0]) == lettered
    near = {i for i in lettered if not any(j < i and len(shingles(texts[i]) & shingles(texts[j])) >= 0.8 * len(shingles(texts[i]) | shingles(texts[j])) for j in lettered)}
    assert set(kept[1]) == near and {100, 101}.isdisjoint(near)
    assert set(kept[2]) == near - {104}
    assert kept[3] == {i: pii.redact(texts[i], pii.spans(texts[i])[1]) for i in near - {104}}
    assert "<EMAIL>" in kept[3][105]


def test_run(spark, folder):
    path, _ = folder
    got = P.run(spark, path).collect()
    assert {r.doc_id for r in got}.isdisjoint({100, 101, 102, 103, 104}) and {0, 39, 105} <= {r.doc_id for r in got}
    assert max(r.offset + r.length for r in got) <= 2048


def test_rows_without_id_with_shared_ids_and_repeated(spark, folder):
    path, texts = folder
    columns = "doc_id long, text string, lang string, source string, n_chars long, text_key string, score double"
    rows = [(i, t, "en", "s", 0, "clash", 0.5) for i, t in texts.items()]
    rows += [(None, texts[9] + " without an id of its own and more words than before", "en", "s", 0, "", 0.5), (8, texts[8], "en", "s", 0, "", 0.5), (10, f"{BENCH[0]} {BENCH[1]}", "en", "s", 0, "", 0.5)]
    docs = spark.createDataFrame(rows, columns)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, path)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = [(r.doc_id, r.text) for r in docs.collect()]
    assert sum(i is None for i, _ in got) == 1 and sum(i == 8 for i, _ in got) == 1
    assert [t for i, t in got if i == 10] == [texts[10]]


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").where("false")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
