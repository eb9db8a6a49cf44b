"""Licence scans with a trained paragraph classifier, in DataFrame functions alone.

Fitting happens on the driver, on the known wordings and bounded samples: each
wording in several damaged forms, and as ``unknown`` unrelated sentences and
``sample_rows`` documents' paragraphs (of those of at most ``sample_chars``
characters).  The model is a sparse multinomial logistic
regression on word 1- to 3-grams (presence, scaled by the root of their number).
Features are grams of the wordings, but for those of common words alone (words in
``common_share`` of the unknown paragraphs or more); the ``max_features`` strongest stay.  A
temperature fitted on forms held out of training calibrates its probabilities,
the unknown class included, whose bias is the largest.

Scanning is native.  Every paragraph is split into words.  Each feature has a key,
its rarest word; a paragraph without any key has no feature, so its score is the
bias alone and it is unknown.  The others are split into grams; those that are
features are joined with the broadcast weights (at most ``max_features`` rows) and summed up.  What is not
unknown is then compared with the wordings of the predicted family: it is
confirmed if enough of the 1- and 2-grams of the shorter one are shared.

Paragraphs end at line breaks, except where a line goes on: no final punctuation
and a lower-case start of the next.  Null or empty texts have no paragraphs.
Repeated rows get equal results; rows that share a doc_id but not a text share the
sum of their findings; rows without doc_id have none, and empty tables no rows.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, staged
from .license_texts import TEMPLATES, UNRELATED

UNKNOWN = "unknown"
SAMPLE_ROWS, SAMPLE_CHARS = 200, 65_536
MAX_FEATURES = 4000
LEAST_SHARE = 0.5
COMMON_SHARE = 0.02
#: A sampled paragraph with any of these is not taken for an example of ``unknown``; scans do not look at them.
CUES = ("licen", "copyright", "rights reserved", "warrant", "redistribut", "permission", "public domain", "spdx", "proprietary", "creative commons", "waived all", "free software")
_GAP = "(?<![.:;!?])\n(?=[a-z(])"


def _words(text: str) -> list[str]:
    return [w for x in re.sub(r"[^a-z0-9.+-]+", " ", text.lower()).split(" ") if (w := x.strip(".-+"))]


def grams(text: str) -> list[str]:
    ws = _words(text)
    return sorted({" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)})


def paragraphs(text: str | None) -> list[str]:
    return [p for p in (x.strip(" ") for x in re.sub(_GAP, " ", text or "").split("\n")) if p]


def has_cue(text: str) -> bool:
    low = text.lower()
    return any(c in low for c in CUES)


@dataclass
class Model:
    classes: list[str]
    weights: dict[str, np.ndarray]
    bias: np.ndarray
    temperature: float
    #: Each feature holds one of these words.
    keys: list[str]

    def probabilities(self, text: str) -> np.ndarray:
        """The same figures as the scan's; for tests."""
        g = grams(text)
        z = self.bias + sum((self.weights[x] for x in g if x in self.weights), np.zeros(len(self.classes))) / math.sqrt(max(1, len(g)))
        e = np.exp((z - z.max()) / self.temperature)
        return e / e.sum()


def _damaged(text: str, rng: random.Random) -> str:
    ws = text.split()
    keep = [w for w in ws if rng.random() > 0.08] or ws
    if len(keep) > 14 and rng.random() < 0.4:
        a = rng.randrange(len(keep) // 3)
        keep = keep[a : a + max(10, len(keep) * 2 // 3)]
    if rng.random() < (0.3 if len(ws) > 4 else 0.8):
        keep = [*rng.choice((("Copyright", "2021", "The", "Authors."), ("Note:",), ("*",), ("//",), ("Code:",), ("Distributed", "under"), ("This", "is", "under", "the"))), *keep]
    return " ".join(keep)


def fit(unknown: list[str], seed: int = 5, epochs: int = 12, max_features: int = MAX_FEATURES, common_share: float = COMMON_SHARE) -> Model:
    met = Counter(w for t in (*UNRELATED, *unknown) for w in set(_words(t)))
    common = {w for w, n in met.items() if n > 1 and n >= common_share * (len(UNRELATED) + len(unknown))}
    rng = random.Random(seed)
    classes = [*TEMPLATES, UNKNOWN]
    rows = [(text, k) for k, name in enumerate(TEMPLATES) for text in TEMPLATES[name]]
    train = [(grams(t if i == 0 else _damaged(t, rng)), k) for t, k in rows for i in range(12)]
    held = [(grams(_damaged(t, rng)), k) for t, k in rows for _ in range(3)]
    other = [(grams(t), len(classes) - 1) for t in (*UNRELATED, *unknown)]
    rng.shuffle(other)
    other += [(grams(_damaged(t, rng)), len(classes) - 1) for t in UNRELATED for _ in range(4)]
    train += [x for i, x in enumerate(other) if i % 5]
    held += [x for i, x in enumerate(other) if not i % 5]
    names = {g: i for i, g in enumerate(sorted({g for gs, k in train if k < len(classes) - 1 for g in gs if not common.issuperset(g.split(" "))}))}
    w, b = np.zeros((len(names), len(classes))), np.zeros(len(classes))
    sw, sb = np.full_like(w, 1e-3), np.full_like(b, 1e-3)
    coded = [(np.array([names[g] for g in gs if g in names], int), k, math.sqrt(max(1, len(gs)))) for gs, k in train]
    for _ in range(epochs):
        rng.shuffle(coded)
        for ids, k, root in coded:
            z = b + w[ids].sum(axis=0) / root
            p = np.exp(z - z.max())
            p /= p.sum()
            p[k] -= 1
            g = p / root + 1e-4 * w[ids]
            sw[ids] += g * g
            w[ids] -= 0.3 * g / np.sqrt(sw[ids])
            sb += p * p
            b -= 0.1 * p / np.sqrt(sb)
    strongest = np.argsort(-np.abs(w - w.mean(axis=1, keepdims=True)).max(axis=1), kind="stable")[:max_features]
    by_id = {i: g for g, i in names.items()}
    b[-1] = max(b[-1], b[:-1].max() + 1e-6)
    weights = {by_id[i]: w[i] for i in strongest.tolist()}
    keys = sorted({min((x for x in g.split(" ") if x not in common), key=lambda x: (met[x], x)) for g in weights})
    model = Model(classes, weights, b, 1.0, keys)
    scored = [(model.bias + sum((model.weights[x] for x in gs if x in model.weights), np.zeros(len(classes))) / math.sqrt(max(1, len(gs))), k) for gs, k in held]

    def loss(t: float) -> float:
        return -sum(z[k] / t - z.max() / t - math.log(np.exp((z - z.max()) / t).sum()) for z, k in scored)

    model.temperature = min((0.25 * 1.15**i for i in range(24)), key=loss)
    return model


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit with all paragraphs without a cue of a hashed sample of documents as further unknown ones."""
    able = documents(docs).where(F.length("text") <= sample_chars)
    ids = able.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).where("doc_id is not null").orderBy("h", "doc_id").limit(sample_rows)
    chosen = [r.doc_id for r in ids.collect()]
    texts = able.where(F.col("doc_id").isin(chosen)).orderBy("doc_id", "text").limit(2 * sample_rows).collect() if chosen else []
    return fit([p for r in texts for p in paragraphs(r.text) if not has_cue(p)])


def _native_words(text: Column) -> Column:
    """As ``_words``: words without dots, dashes and plus signs around them."""
    parts = F.split(F.regexp_replace(F.lower(text), "[^a-z0-9.+-]+", " "), " ")
    return F.filter(F.transform(parts, lambda w: F.btrim(w, F.lit(".-+"))), lambda w: w != "")


def _native_grams(ws: Column, sizes: tuple[int, ...]) -> Column:
    def of(n: int) -> Column:
        starts = F.when(F.size(ws) >= n, F.sequence(F.lit(1), F.size(ws) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(ws, i, n), " "))

    return F.array_distinct(F.concat(*(of(n) for n in sizes)))


def _split(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.regexp_replace(text, _GAP, " "), "\n"), lambda p: F.btrim(p)), lambda p: p != "")


def _parts(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, said, h): paragraphs and the 128-bit hashes of their texts."""
    parts = documents(docs).where("doc_id is not null").select("doc_id", F.posexplode(_split(F.col("text"))).alias("paragraph", "said"))
    return parts.withColumn("h", F.md5("said"))


def scan(docs: DataFrame, model: Model, least_share: float = LEAST_SHARE) -> DataFrame:
    """The findings with their texts: (doc_id, paragraph, h, family, probability, template, share, confirmed, text)."""
    key = ["doc_id", "paragraph", "h"]
    return findings(docs, model, least_share).join(_parts(docs).dropDuplicates(key).withColumnRenamed("said", "text"), key)


def findings(docs: DataFrame, model: Model, least_share: float = LEAST_SHARE) -> DataFrame:
    """Paragraphs that share a gram with the model: (doc_id, paragraph, h, family, probability, template, share, confirmed)."""
    spark = docs.sparkSession
    key = ["doc_id", "paragraph", "h"]
    words = _parts(docs).withColumn("ws", _native_words(F.col("said")))
    keyed = words.where(F.arrays_overlap("ws", F.lit(model.keys))) if model.keys else words.where("false")
    keyed = staged(spark, keyed.select(*key, "ws"), "keyed").dropDuplicates(key)
    parts = keyed.select(*key, _native_grams(F.col("ws"), (1, 2, 3)).alias("grams"))

    weights = F.broadcast(_weights(spark, model))
    kinds = range(len(model.classes))
    # only the model's features become rows: a key may be a frequent word, and most grams around it are none
    featured = F.filter("grams", lambda g: g.isin(list(model.weights)))
    seen = parts.select(*key, F.size("grams").alias("n"), F.explode(featured).alias("gram")).join(weights, "gram")
    sums = seen.groupBy(*key, "n").agg(*(F.sum(F.col("w")[k]).alias(f"s{k}") for k in kinds))
    z = [(F.lit(float(model.bias[k])) + F.col(f"s{k}") / F.sqrt(F.col("n"))) / F.lit(float(model.temperature)) for k in kinds]
    scored = sums.select(*key, F.array(*z).alias("z"))
    scored = scored.withColumn("e", F.transform("z", lambda v: F.exp(v - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    names = F.array(*(F.lit(c) for c in model.classes))
    scored = scored.select(*key, F.get(names, (F.array_position("z", F.array_max("z")) - 1).cast("int")).alias("family"), (F.array_max("e") / total).alias("probability"))
    scored = scored.withColumn("family", F.when(F.col("probability") >= 0.5, F.col("family")).otherwise(UNKNOWN))
    scored = staged(spark, scored, "scored")

    known = F.broadcast(_wordings(spark))
    like = keyed.join(scored.where(F.col("family") != UNKNOWN).select(*key), key, "left_semi")
    pairs = like.select(*key, _native_grams(F.col("ws"), (1, 2)).alias("pairs"))
    met = pairs.select(*key, F.size("pairs").alias("n"), F.explode("pairs").alias("gram")).join(known, "gram")
    shares = met.groupBy(*key, "template", "owner", "size").agg((F.count("*") / F.least(F.first("n"), F.first("size"))).alias("share"))
    best = shares.groupBy(*key, "owner").agg(F.max(F.struct("share", "template")).alias("b"))
    best = best.select(*key, F.col("owner").alias("family"), "b.share", "b.template")
    return scored.join(best, [*key, "family"], "left").select(
        *key, "family", "probability", "template", F.coalesce("share", F.lit(0.0)).alias("share"),
        ((F.col("family") != UNKNOWN) & (F.coalesce("share", F.lit(0.0)) >= least_share)).alias("confirmed"))


def _weights(spark: SparkSession, model: Model) -> DataFrame:
    return spark.createDataFrame([(g, [float(v) for v in w]) for g, w in model.weights.items()], "gram string, w array<double>")


def _wordings(spark: SparkSession) -> DataFrame:
    rows = []
    for family, texts in TEMPLATES.items():
        for i, t in enumerate(texts):
            ws = _words(t)
            pairs = sorted({" ".join(ws[j : j + n]) for n in (1, 2) for j in range(len(ws) - n + 1)})
            rows += [(g, f"{family}/{i}", family, len(pairs)) for g in pairs]
    return spark.createDataFrame(rows, "gram string, template string, owner string, size int")


def by_document(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """One row for each document: its confirmed families, how many paragraphs they have and how many are
    unknown, and the highest probability of a confirmed one."""
    per = found.where("confirmed").groupBy("doc_id").agg(
        F.count("*").alias("n_confirmed"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.round(F.max("probability"), 4).alias("probability"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.size(_split(F.col(text).cast("string"))), F.lit(0)).alias("n"))
    rows = rows.withColumn("n", F.greatest("n", F.lit(0)))
    return rows.join(per, "doc_id", "left").withColumn("n_confirmed", F.coalesce("n_confirmed", F.lit(0)).cast("long")).select(
        "doc_id", "n_confirmed", F.greatest(F.col("n") - F.col("n_confirmed"), F.lit(0)).cast("long").alias("n_unknown"), F.coalesce("families", F.lit("")).alias("families"), "probability")
