import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cuewright.llm import merkle

H = lambda s: sha256(s.encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    return ["-" if (i >> h ^ 1) >= len(x) else ("<" if i >> h & 1 else ">") + x[i >> h ^ 1] for h, x in enumerate(levels[:-1])]


@pytest.mark.parametrize("height", range(7))
def test_block_roots_and_traversal(height):
    """Every size of block, also those that end early, gives the paths of the whole tree; stacks stay as high as it."""
    for n in range(1, (1 << height) + 1):
        leaves = [H(str(i)) for i in range(n)]
        levels = [leaves]
        for _ in range(height):
            levels.append([H("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
        assert merkle.block_root(leaves, height) == levels[-1][0]
        assert list(merkle.traversal(leaves, height)) == [path(levels, i) for i in range(n)]


def test_traversal_holds_few_nodes(monkeypatch):
    stacks, most = [], []

    class Seen(merkle.Treehash):
        __slots__ = ()

        def __init__(self, height):
            super().__init__(height)
            stacks.append(self)

        def step(self, leaf):
            super().step(leaf)
            most.append(sum(len(s.nodes) for s in stacks))

    monkeypatch.setattr(merkle, "Treehash", Seen)
    for _ in merkle.traversal([H(str(i)) for i in range(1024)], 10):
        pass
    assert max(most) <= 3 * 10


def leaf(doc_id, source, lang, n_chars, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def expected(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by_lang, out = defaultdict(list), []
    for d, t, g, s, n in rows:
        hurt = leaf(d, s, g, None if n is None else n + 1, t) if d is not None and zlib.crc32(str(d).encode()) % 7 == 0 else None
        by_lang[g].append((d is not None, d or 0, leaf(d, s, g, n, t), d, hurt))
    order = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(by_lang[g])]) for g in order}
    upper = tree([trees[g][-1][0] for g in order])
    for k, g in enumerate(order):
        for i, (_, _, own, d, hurt) in enumerate(sorted(by_lang[g], key=lambda x: x[:3])):
            steps = path(trees[g], i) + path(upper, k)
            node = hurt or own
            for s in steps:
                node = H(s[1:] + node if s[0] == "<" else node + s[1:])
            out.append((d, own, trees[g][-1][0], upper[-1][0], H("".join(s[1:] for s in steps)), node, node == upper[-1][0]))
    return out


def sample():
    rows = [(i, f"text {i} é", ("en", "de", None, "", "é", "Z")[(i * i) % 7 % 6], None if i % 5 == 0 else "s", None if i % 11 == 0 else i % 9) for i in range(90)]
    return rows + [(3, "another text of 3", "en", "s", 1), rows[4], rows[4], (None, None, None, None, None), (None, "no id", "en", "", 2), (-5, "x" * 200_000, "fr", "s", 200_000)]


@pytest.mark.parametrize("block", [2, 4, 16, merkle.BLOCK])
def test_query_equals_whole_trees(spark, block):
    """Nulls anywhere, repeated rows, ties in doc_id, lone leaves, blocks that end early, and columns named like our own."""
    df = spark.createDataFrame(sample(), "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    df = df.withColumns({c: F.lit(1) for c in ("tree", "pos", "n", "row", "digest", "path", "block", "hurt", "_part")})
    got = [tuple(r) for r in merkle.digest(df, block).collect()]
    assert Counter(got) == Counter(expected(sample()))
    assert {r[6] for r in got} == {True, False}


def test_one_leaf_and_none(spark, none):
    one = spark.createDataFrame([(14, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    r = merkle.manifest(one).first()
    assert r.leaf == r.subroot == r.root == leaf(14, "s", "en", 1, "a") and r.path == []
    assert [tuple(x) for x in merkle.digest(one).collect()] == expected([(14, "a", "en", "s", 1)])
    assert merkle.manifest(none).collect() == [] and merkle.digest(none).collect() == []


def test_carried_columns_and_refusals(spark, none):
    df = spark.createDataFrame(sample(), "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.manifest(df, {"row": F.upper("source"), "pos": F.length("text")}, 4)
    assert got.columns == [*merkle.RESULT, "row", "pos"] and {r.row for r in got.collect()} == {None, "S", ""}
    with pytest.raises(ValueError):
        merkle.manifest(none, block=3)
    with pytest.raises(ValueError):
        merkle.manifest(none, {"leaf": F.lit(1)})


def test_ranks_do_not_depend_on_partitions(spark):
    rows = [("=en" if i % 3 else "-", i // 2 if i % 7 else None, i) for i in range(500)]
    for parts in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = merkle.ranked(spark.createDataFrame(rows, "tree string, k long, v long").repartition(3), "tree", ["k", "v"]).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        for t in ("-", "=en"):
            own = sorted((r.pos, r.k is not None, r.k or 0, r.v) for r in got if r.tree == t)
            assert [o[0] for o in own] == list(range(len(own))) and own == sorted(own, key=lambda o: o[1:]) and {r.n for r in got if r.tree == t} == {len(own)}
