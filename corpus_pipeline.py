"""A training corpus from raw documents: language, near-duplicates, contamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and all rows its predecessor kept; all
but the last return the columns of ``documents``.  Decisions are made row by row:
rows that share a doc_id are judged each on its own text, and rows without doc_id
go through all stages.  Repeated rows, equal in doc_id and text, are one document
to the near-duplicate stage, which keeps one of them.  Null and empty texts have no
language and go in the first stage.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuewright.llm import decontam, langid, minhash, packing, pii
from cuewright.llm.common import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose most probable language has less than this share is in no language.
LEAST_SCORE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what has no letters, or no language that stands out."""
    found = langid.languages(docs, langid.learn(docs), keep=COLUMNS)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, word 5-grams at 0.8, keep the document with the smallest id."""
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).distinct()
    kept = staged(spark, kept, "kept")
    rows = docs.select(*COLUMNS).withColumn("text_key", F.md5(F.coalesce("text", F.lit(""))))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left_semi")
    return rows.dropDuplicates(["doc_id", "text_key"]).select(*COLUMNS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which two or more benchmark items occur, or most of whose words belong to one."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.where((F.size("item_ids") < 2) & (F.col("n_hit") * 2 <= F.col("n_words"))).select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; every document stays."""
    clean = pii.redacted(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; workers remember half as many chunks as in packing alone, as executors are full of what came before."""
    return packing.packed_documents(docs, most=packing.REMEMBERED // 2)


STAGES = [
    ("language", known_language),
    ("near_duplicates", first_of_group),
    ("decontamination", uncontaminated),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: A learned classifier, sketches and a tokenizer have no SQL form; the test compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
