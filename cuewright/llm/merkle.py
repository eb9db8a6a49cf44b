"""Merkle manifest of a dataset, with an authentication path for each row.

Rows are leaves; those of one tree (one ``lang``) ascend by doc_id, two consecutive
nodes become the hash of both, a lone last one the hash of itself, until one is
left, the tree's root.  The roots of all trees, in their order, are leaves of a
tree in turn, whose root stands for the dataset.

Ranks need no window over a tree: rows are range-partitioned by tree and order,
and counts of each partition give where its rows begin.  A tree is cut into aligned
blocks of ``block`` leaves.  On the way up a stack of as many nodes as a block has
levels gives a block's root; blocks are leaves of the next, ``block`` times
smaller table, until each tree has one node.  On the way down a block's leaves get
their paths by Merkle's traversal: for each level a stack builds the next node of
the path while earlier leaves go out, the lowest stack first, in as many steps a
leaf as twice the levels.  What lies above a block is the same for its leaves:
their block's own path comes to them as one row and is appended.

A block is a task's unit, so a tree that holds all rows is spread like many.  Ties
in doc_id go by leaf digest, so equal rows are leaves side by side.  Null doc_id
comes first and is never tampered with; null lang is a tree of its own, before the
others.  Texts are hashed whole.  An empty table gives an empty table.  Columns other
than those of a leaf are not read; columns to carry along keep their names apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, drop, staged

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = ("doc_id", "lang", "leaf", "subroot", "root", "path")
#: Leaves of a block, a power of two.
BLOCK = 1024
#: Steps of a path: the sibling's side before its digest, or neither.
LEFT, RIGHT, NONE = "<", ">", "-"


def leaf_digest(*values: Column) -> Column:
    """SHA-256 over all values: ``-`` for null, else byte count, ``:`` and value."""
    parts = []
    for v in values:
        v = v.cast("string")
        parts.append(F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts), 256)


def joined(left: str | None, right: str | None) -> str | None:
    """A node from its children; one that is lone is hashed alone, and none of none."""
    if left is None:
        return None
    return sha256((left + (right or "")).encode()).hexdigest()


class Treehash:
    """A node made of consecutive leaves, one leaf or one hash a step, with at most one node for each level in hand."""

    __slots__ = ("height", "nodes", "at")

    def __init__(self, height: int) -> None:
        self.height, self.nodes, self.at = height, [], 0

    def start(self, at: int) -> None:
        self.nodes, self.at = [], at

    def full(self) -> bool:
        return bool(self.nodes) and self.nodes[0][0] == self.height

    def lowest(self) -> int:
        """Level of the last node in hand; what has none yet counts as its height."""
        return self.nodes[-1][0] if self.nodes else self.height

    def step(self, leaf: Callable[[int], str | None]) -> None:
        own = self.nodes
        if len(own) > 1 and own[-1][0] == own[-2][0]:
            (level, right), (_, left) = own.pop(), own.pop()
            own.append((level + 1, joined(left, right)))
        else:
            own.append((0, leaf(self.at)))
            self.at += 1

    def finish(self, leaf: Callable[[int], str | None]) -> str | None:
        while not self.full():
            self.step(leaf)
        return self.nodes[0][1]


def block_root(leaves: list[str], height: int) -> str:
    """Root of a block with one stack; leaves that are missing at its end cost nothing."""
    own: list[tuple[int, str]] = []
    for x in leaves:
        level = 0
        while own and own[-1][0] == level:
            x, level = joined(own.pop()[1], x), level + 1
        own.append((level, x))
    level, x = own.pop()
    while level < height:
        x = joined(own.pop()[1], x) if own and own[-1][0] == level else joined(x, None)
        level += 1
    return x


def traversal(leaves: list[str], height: int) -> Iterator[list[str]]:
    """The path of each leaf in turn, from its level to the block's root."""
    n, size = len(leaves), 1 << height
    leaf = lambda i: leaves[i] if i < n else None
    path: list[str | None] = []
    stacks = [Treehash(h) for h in range(height)]
    for h, s in enumerate(stacks):
        s.start(1 << h)
        path.append(s.finish(leaf))
        s.start(0)
        s.finish(leaf)
    for i in range(n):
        yield [NONE if x is None else (LEFT if i >> h & 1 else RIGHT) + x for h, x in enumerate(path)]
        behind = i + 1
        busy = []
        for h, s in enumerate(stacks):
            if behind % (1 << h) == 0:
                if s.full():
                    path[h] = s.nodes[0][1]
                at = (behind + (1 << h)) ^ (1 << h)
                if at < size:
                    s.start(at)
            if not s.full():
                busy.append(s)
        for _ in range(2 * height - 1):
            if not busy:
                break
            s = min(busy, key=Treehash.lowest)
            s.step(leaf)
            if s.full():
                busy.remove(s)


def height_of(n: int, block: int) -> int:
    """Levels of a block in a tree of n leaves."""
    return (min(n, block) - 1).bit_length()


def ranked(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """With ``pos``, a row's place in its tree from 0, and ``n``, the tree's size; staged."""
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = staged(spark, placed.withColumn("_part", F.shiftright("_at", 33)), "placed")
    parts = placed.groupBy("_part", tree).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    w = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_rows").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("_part", tree, "_first", before.alias("_before"), F.sum("_rows").over(w).alias("n"))
    out = placed.join(parts, ["_part", tree]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
    out = staged(spark, out.drop("_part", "_at", "_first", "_before"), "ranked")
    drop(placed)
    return out


def _by_block(rows: DataFrame, schema: str, make: Callable[[list[dict]], Iterator[dict]]) -> DataFrame:
    """``make`` for the rows of each block, in order of pos; rows have tree, block and pos."""
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            made = list(make(rows))
            return pa.RecordBatch.from_arrays([pa.array([r[t.name] for r in made], type=t.type) for t in arrow], schema=arrow)

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["tree"], row["block"]) != (held[0]["tree"], held[0]["block"]):
                    yield out(held)
                    held = []
                held.append(row)
        if held:
            yield out(held)

    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(run, schema)


def climbed(leaves: DataFrame, block: int = BLOCK) -> list[DataFrame]:
    """Tables (tree, pos, n, digest) from leaves to roots; each has a row for a block of the one before."""
    def roots(rows: list[dict]) -> Iterator[dict]:
        n = rows[0]["n"]
        yield {"tree": rows[0]["tree"], "pos": rows[0]["block"], "n": -(-n // block), "digest": block_root([r["digest"] for r in rows], height_of(n, block))}

    out = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = out[-1].select("tree", "pos", "n", "digest", F.floor(F.col("pos") / block).alias("block"))
        out.append(staged(leaves.sparkSession, _by_block(below, "tree string, pos long, n long, digest string", roots), "blocks"))
        most = -(-most // block)
    return out


def descended(levels: list[DataFrame], top: DataFrame, block: int = BLOCK) -> DataFrame:
    """(tree, row, digest, path, roots) for each leaf: its path up to its tree's root and on along ``top``'s.

    ``top`` has (tree, path, roots) for the root of each tree; ``row`` is what the leaves bring along.
    """
    above = top.select("tree", F.lit(0).cast("long").alias("pos"), "path", "roots")
    strings = F.lit(None).cast("array<string>")
    for k, level in list(enumerate(levels))[:-1][::-1]:
        row = level.schema["row"].dataType.simpleString() if k == 0 else "int"
        own = level.select(
            "tree", F.floor(F.col("pos") / block).alias("block"), "pos", "n", "digest", F.col("row") if k == 0 else F.lit(None).cast("int").alias("row"),
            strings.alias("path"), strings.alias("roots"))
        shared = above.select(
            "tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("digest"),
            F.lit(None).cast(row).alias("row"), "path", "roots")

        def paths(rows: list[dict]) -> Iterator[dict]:
            shared, own = rows[0], rows[1:]
            steps = traversal([r["digest"] for r in own], height_of(own[0]["n"], block))
            for r, path in zip(own, steps, strict=True):
                yield r | {"path": path + shared["path"], "roots": shared["roots"]}

        above = _by_block(own.unionByName(shared), f"tree string, pos long, row {row}, digest string, path array<string>, roots array<string>", paths)
    if len(levels) == 1:  # every tree is a lone leaf
        above = levels[0].join(top, "tree")
    return above.select("tree", "row", "digest", "path", "roots")


def manifest(docs: DataFrame, carry: Mapping[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, lang, leaf, subroot, root, path) and the columns to carry, one row for each of ``docs``.

    ``path`` has a string for each level, from the leaf to the dataset's root: ``<``
    or ``>`` and the digest of the sibling on that side, or ``-`` if there is none.
    """
    carry = dict(carry or {})
    if block < 2 or block & (block - 1):
        raise ValueError("a block has a power of two of leaves")
    if clash := set(carry) & set(RESULT):
        raise ValueError(f"columns of the result: {sorted(clash)}")
    spark, key = docs.sparkSession, F.col("doc_id").cast("long")
    row = F.struct(key.alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.struct(F.lit(0).alias("_"), *(c.alias(n) for n, c in carry.items())).alias("carried"))
    tree = F.when(F.col("lang").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))  # - before =, so nulls come first
    leaves = docs.select(tree.alias("tree"), key.alias("doc_id"), leaf_digest(*(F.col(c) for c in COLUMNS)).alias("digest"), row.alias("row"))
    leaves = staged(spark, leaves, "leaves")
    levels = climbed(ranked(leaves, "tree", ["doc_id", "digest"]), block)
    drop(leaves)
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest", F.col("tree").alias("row"))
    upper = climbed(ranked(subroots, "tree", ["of"]), block)
    root = upper[-1].select("tree", F.array().cast("array<string>").alias("path"), F.array("digest").alias("roots"))
    top = descended(upper, root, block).select(F.col("row").alias("tree"), "path", F.concat(F.array("digest"), "roots").alias("roots"))
    found = descended(levels, staged(spark, top, "top"), block)
    return found.select(
        "row.doc_id", "row.lang", F.col("digest").alias("leaf"), F.col("roots")[0].alias("subroot"), F.col("roots")[1].alias("root"), "path",
        *(F.col("row.carried")[n].alias(n) for n in carry))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    def step(node: Column, s: Column) -> Column:
        side, other = F.substring(s, 1, 1), F.substring(s, 2, 64)
        return F.sha2(F.when(side == LEFT, F.concat(other, node)).when(side == RIGHT, F.concat(node, other)).otherwise(node), 256)

    return F.aggregate(path, leaf, step)


def siblings(path: Column) -> Column:
    """Digests of a path, one behind the other."""
    return F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), "")


def digest(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every row's proof, folded again after one more character was claimed for each row whose crc32 of doc_id 7 divides."""
    values = [F.col(c) for c in COLUMNS]
    hurt = F.when(F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0, leaf_digest(*(c + 1 if n == "n_chars" else c for n, c in zip(COLUMNS, values, strict=True))))
    found = manifest(docs, {"hurt": hurt}, block)
    found = found.withColumn("folded_root", folded(F.coalesce("hurt", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
