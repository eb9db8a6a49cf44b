import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 long, h string, length long, sub int"


def invented(rng, n):
    return " ".join(rng.choice(("the", "of", "and", "to")) if rng.random() < 0.3 else "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies, near copies, shared passages; names that clash."""
    rng = random.Random(11)
    base = [invented(rng, n) for n in (120, 90, 300, 40, 12, 13, 14, 1, 2)]
    passage, line = invented(rng, 90), invented(rng, 20)
    texts = [None, "", "   \n", "x", *base, base[0], base[0], base[1] + " end", base[0].replace("the", "thee", 1), "aaaa" * 300, ("go on. " * 400).strip(), invented(rng, 20000)]
    texts += [f"{invented(rng, 15)}\n{passage}\n{invented(rng, 15)}" for _ in range(6)] + [f"{line} {invented(rng, 5)}" for _ in range(4)]
    for _ in range(8):
        ws = base[2].split()
        ws[rng.randrange(len(ws))] = "edited"
        texts.append(" ".join(ws))
    out = [(i, t, "en", "s", 0, 7, "h", 3, 1) for i, t in enumerate(texts)]
    rng.shuffle(out)
    return out + [out[3], out[3], (None, "a row without an id", None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
