"""MinHash near-duplicates by bottom-k sketches of one hash function.

1. Each text's set of word shingles is hashed once; equal sets are one class,
   represented by its smallest doc_id.
2. A set's sketch is its k smallest hashes.  Two sets whose Jaccard similarity
   reaches the threshold share at least o of them: exactly, where both sketches
   are whole sets; otherwise with odds of missing about 1e-9 (o = 20 of 48 where
   38 are expected at 0.8).  So of each sketch only the k - o + 1 rarest values
   need inverted lists; values that one set alone holds count, but list nothing.
3. Short lists (``SHORT`` members at most) give all their pairs, which is linear
   in the lists' rows.  A pair's union sketch estimates its similarity; what could
   reach the threshold is verified on the whole sets.
   A longer list is replaced by lists of two values: a pair whose first value in
   common, rarest first, is v shares o - 1 later ones too, so of the values behind v,
   up to the k - o + 2nd, its second one is in both sketches, and both are listed under
   the two.  So lists stay short as a corpus grows, but for groups of texts that have
   much in common.  Union sketches are compared in rounds of so many pairs a document
   (``ROUND``), so that what they take on disk is no more than a part of the input.
4. Where a list of two values is long again, its members have a leader, the smallest
   doc_id of the first value's list, with which each member is compared in full: what
   one of the two sets lacks are the member's differences D.
   Members that have little in common with it are compared with the empty set
   instead (D is the whole set); since linked texts are about as near to the leader
   one as the other, a band of similarity that belongs to both groups loses no pair.
   A leader that is linked with a smaller one, in whose list it is, gives its members
   to that one, and the empty set has one group for all lists: a text in many lists has
   its differences listed once for each leader that is left and near it, and its whole
   set once.
   For members a and b, a and b differ in as much as D_a and D_b do, so to be
   linked they must share (F_a + F_b) / 2 differences at least, F being |D| less
   the set's part of what the threshold allows.  Of members of one component
   nothing is asked: what one component alone differs in is left out, and so is a
   member whose other differences are too few for any possible partner.  Of the rest
   only the rarest differences get inverted lists
   of their own (as many as may be missed, and one), and a pair is made only where
   what both have left from the meeting place on is enough.  A group of thousands of
   texts that are near one another, but mostly below the threshold, so gives few
   pairs: differences that no other member has, or that few have, rule them out.
5. Links join components.

Sets are compared as sets of 63-bit hashes of shingles, see ``hashing``.

Null or empty texts have an empty set and are linked with nothing.  Rows without
doc_id are left out of the lists.  Equal rows get equal results; rows that share
an id share its component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import encoded
from .common import documents, drop, map_rows, staged
from .hashing import mix, ngrams, signed, spans, word_bounds

K = 48
OVERLAP = 20
#: Lists of at most so many members give all their pairs.
SHORT = 16
#: Pairs a document whose sketches are compared at a time.
ROUND = 4
#: Percent of similarity to a list's leader from which on a member counts as near it.
NEAR = 40
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(raw: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; of fewer words, the whole sequence is one."""
    x = np.frombuffer(raw.translate(LOWER), np.uint8)
    a, b = word_bounds(x)
    if not len(a):
        return np.zeros(0, np.uint64)
    h = spans(x, a, b)
    g = ngrams(h, n) if len(h) >= n else mix(ngrams(h, len(h)) + np.uint64(len(h)))
    return np.unique(g >> np.uint64(1))  # without the top bit, signed and unsigned order agree


def _sketches(base: DataFrame, n: int, k: int) -> DataFrame:
    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            sets = [shingles(encoded(t), n) for t in x["text"]]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            return {"n_shingles": [len(s) for s in sets],
                    "k1": [int.from_bytes(d[:8], "little", signed=True) for d in keys], "k2": [int.from_bytes(d[8:], "little", signed=True) for d in keys],
                    "sketch": pa.array([signed(s[:k]).tolist() for s in sets], pa.list_(pa.int64()))}
        return run

    keyed = base.withColumn("text_key", F.md5("text"))
    return map_rows(keyed, make, "n_shingles long, k1 long, k2 long, sketch array<long>", keep=("doc_id", "text_key"))


def _lists(reps: DataFrame, k: int, overlap: int, threshold: int, short: int) -> DataFrame:
    """(v, doc_id, n, lead, m): inverted lists of the rarest retained values, with their smallest members and sizes;
    instead of lists of more than ``short`` members, those of their value and a second one, with the lead of the first."""
    spark = reps.sparkSession
    values = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("sketch").alias("v"))
    shared = staged(spark, values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    held = values.join(shared, "v").groupBy("doc_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    kept = F.least("n", F.lit(k))
    # a set of n has partners of n * 100 / threshold at most: then both sketches are whole
    exact = F.col("n") * 100 <= F.lit(k * threshold)
    least = F.when(exact, F.ceil(F.col("n") * threshold / 100.0 - 1e-9)).otherwise(F.lit(overlap)).cast("int")
    alone = (kept - F.size("vs")).cast("int")
    room = (kept.cast("int") - least + 1 - alone).cast("int")
    held = held.where(F.size("vs") >= least).where(room > 0)
    # the last value is a second one only
    held = held.select("doc_id", "n", room.alias("room"), (least < 2).alias("one"), F.transform(F.slice("vs", F.lit(1), room + 1), lambda x: x["v"]).alias("vs"))
    held = staged(spark, held, "prefixes")
    firsts = held.select("doc_id", "n", F.explode(F.slice("vs", F.lit(1), F.col("room"))).alias("v"))
    sizes = staged(spark, firsts.groupBy("v").agg(F.count("*").alias("m"), F.min("doc_id").alias("lead")).where("m > 1"), "sizes")
    members = staged(spark, firsts.join(sizes, "v").select("v", "doc_id", "n", "lead", "m"), "members")
    drop(shared, sizes)

    long = members.where(F.col("m") > short).select("doc_id", "lead", "v").join(held, "doc_id").withColumn("at", F.array_position("vs", F.col("v")).cast("int"))
    seconds = F.slice("vs", F.col("at") + 1, F.col("room") - F.col("at") + 1)
    # whoever may be linked by one value alone meets the others of its kind under that value
    seconds = F.when(F.col("one"), F.concat(F.array("v"), seconds)).otherwise(seconds)
    twos = long.select("doc_id", "n", "lead", "v", F.explode(seconds).alias("w")).select(F.xxhash64("v", "w").alias("v"), "doc_id", "n", "lead")
    twos = staged(spark, twos, "twos")
    sizes = staged(spark, twos.groupBy("v").agg(F.count("*").alias("m")).where("m > 1"), "twosizes")
    out = staged(spark, members.where(F.col("m") <= short).union(twos.join(sizes, "v").select("v", "doc_id", "n", "lead", "m")), "inverted")
    drop(held, members, twos, sizes)
    return out


def _sets(base: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(doc_id, s): whole sets of the wanted documents, each once; rows are already together by doc_id after the join."""

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            return {"doc_id": x["doc_id"], "s": pa.array([signed(shingles(encoded(t), n)) for t in x["text"]], pa.list_(pa.int64()))}
        return run

    return map_rows(base.join(wanted, "doc_id").dropDuplicates(["doc_id"]), make, "doc_id long, s array<long>", 64)


def _short_pairs(short: DataFrame, reps: DataFrame, k: int, overlap: int, threshold: int) -> DataFrame:
    """(a, b) of short lists whose union sketch allows the threshold."""
    spark = short.sparkSession
    a = short.select("v", F.col("doc_id").alias("a"), F.col("n").alias("na"))
    b = short.select("v", F.col("doc_id").alias("b"), F.col("n").alias("nb"))
    fits = (F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    pairs = staged(spark, a.join(b, "v").where(fits).select("a", "b").distinct(), "pairs")
    # a sketch's leading 31 bits do here: they keep the order, and what they confuse is verified
    few = F.transform("sketch", lambda h: F.shiftright(h, 32).cast("int"))
    ska, skb = reps.select(F.col("doc_id").alias("a"), few.alias("sa")), reps.select(F.col("doc_id").alias("b"), few.alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    rounds, near = 1 + pairs.count() // max(1, ROUND * reps.count()), []
    for i in range(rounds):
        some = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == i)
        near.append(staged(spark, some.join(ska, "a").join(skb, "b").where(both * k >= F.size(union) * overlap).select("a", "b"), "near"))
    out = staged(spark, reduce(DataFrame.union, near), "alike")
    drop(pairs, *near)
    return out


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the threshold."""
    x, y = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("s").alias("y"))
    both = pairs.join(y, "b").join(x, "a").withColumn("i", F.size(F.array_intersect("x", "y")))
    return both.where(100 * F.col("i") >= threshold * (F.size("x") + F.size("y") - F.col("i"))).select("a", "b")


def _centred(entries: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(lead, doc_id): instead of leaders linked with a smaller one, in whose list they are, that one, if it stands for itself.

    Two members of a list keep one leader in common, and a leader is a member of the one that takes its place.
    """
    leads = entries.select(F.col("lead").alias("a")).distinct()
    pairs = entries.select(F.col("doc_id").alias("a"), F.col("lead").alias("b")).join(leads, "a", "left_semi")
    alike = _verified(pairs, sets, threshold).select(F.col("a").alias("doc_id"), F.col("b").alias("lead"))
    alike = staged(entries.sparkSession, alike, "alike")
    own = alike.join(alike.select(F.col("doc_id").alias("lead")), "lead", "left_anti")
    centres = own.groupBy(F.col("doc_id").alias("lead")).agg(F.min("lead").alias("centre"))
    moved = entries.join(centres, "lead", "left").select(F.coalesce("centre", "lead").alias("lead"), "doc_id")
    moved = staged(entries.sparkSession, moved.where("lead <> doc_id").distinct(), "centred")
    drop(entries, alike)
    return moved


def _differences(entries: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(lead, doc_id, n, nl, m, d, s): sizes of a member's and its leader's sets and of the m elements that either has
    and the other lacks; of near members these, d, and of far ones the whole set, s, the other being null."""
    leads = sets.join(entries.select(F.col("lead").alias("doc_id")).distinct(), "doc_id", "left_semi")
    own, first = sets.select("doc_id", "s"), leads.select(F.col("doc_id").alias("lead"), F.col("s").alias("sl"))
    both = entries.join(own, "doc_id").join(first, "lead").withColumn("d", F.concat(F.array_except("s", "sl"), F.array_except("sl", "s")))
    both = both.select("lead", "doc_id", "s", F.size("s").cast("long").alias("n"), F.size("sl").cast("long").alias("nl"), F.size("d").alias("m"), "d")
    shared = (F.col("n") + F.col("nl") - F.col("m")) / 2
    alike = 100 * shared / (F.col("n") + F.col("nl") - shared)
    return both.select("lead", "doc_id", "n", "nl", "m", F.when(alike >= NEAR, F.col("d")).alias("d"), F.when(alike < NEAR + 100 - threshold, F.col("s")).alias("s"))


def _pairs_by_differences(diffs: DataFrame, comp: DataFrame, threshold: int) -> DataFrame:
    """(a, b): members of one group, of different components, that can share the differences a link needs.

    A group is a leader's near members, or all members that are far from some leader.
    """
    spark = diffs.sparkSession
    whole, part = 100 + threshold, 100 - threshold
    near = diffs.where("d is not null").select("lead", "doc_id", "n", F.lit(False).alias("far"), "d")
    far = diffs.where("s is not null").dropDuplicates(["doc_id"])
    far = far.select(F.lit(0).cast("long").alias("lead"), "doc_id", "n", F.lit(True).alias("far"), F.col("s").alias("d"))
    named = near.union(far).join(comp, "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    lead_comp = comp.select(F.col("doc_id").alias("lead"), F.col("comp").alias("main"))
    group = ["lead", "far"]
    open_groups = named.groupBy(*group).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select(*group)
    open_groups = staged(spark, open_groups.join(lead_comp, "lead", "left").select(*group, F.coalesce("main", "lead").alias("main")), "open")
    named = staged(spark, named.join(open_groups, group).withColumn("f", F.size("d") * whole - F.col("n") * part), "named")
    drop(diffs)

    def fit(members: DataFrame) -> DataFrame:
        """Members with c differences that others may share, where f and g of some possible partner go with theirs."""
        members = members.withColumn("g", 2 * whole * F.col("c") - F.col("f"))
        # of whole sets, F is as large as the set, and a partner's set has the threshold's part of this one's size at least
        fewest = F.greatest(F.col("fewest"), F.when(F.col("far"), F.col("f") * threshold / 100))
        least = F.greatest(F.lit(1), F.ceil((F.col("f") + fewest) / F.lit(2.0 * whole) - 1e-9)).cast("int")
        return members.where("f <= most and fewest <= g").withColumn("room", F.col("c") - least + 1).where("room > 0")

    # what a single member has is counted for that member; those whose other differences are too few need no list of them
    each = named.select(*group, "doc_id", "comp", F.explode("d").alias("e"))
    across = (F.min("comp") != F.max("comp")).alias("across")
    counts = staged(spark, each.groupBy(*group, "e").agg(F.count("*").alias("df"), F.min("doc_id").alias("doc_id"), across), "counts")
    alone = counts.where("df = 1").groupBy(*group, "doc_id").agg(F.count("*").alias("alone"))
    members = named.select(*group, "doc_id", "f", (F.col("comp") == F.col("main")).alias("same"), F.size("d").alias("size")).join(alone, [*group, "doc_id"], "left")
    members = members.select(*group, "doc_id", "f", "same", (F.col("size") - F.coalesce("alone", F.lit(0))).cast("int").alias("c")).where("c > 0")
    members = staged(spark, members, "members")
    # members of the leader's component have partners in others only
    limits = members.select(*group, "f", "c", F.explode(F.when(F.col("same"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("same"))
    limits = staged(spark, limits.groupBy(*group, "same").agg(F.max(2 * whole * F.col("c") - F.col("f")).alias("most"), F.min("f").alias("fewest")), "limits")
    able = fit(members.join(limits, [*group, "same"])).select(*group, "doc_id", "most", "fewest")
    listed = staged(spark, named.join(able, [*group, "doc_id"]), "listed")
    shared = staged(spark, counts.where("across").select(*group, "e", "df"), "repeated")
    drop(named, counts, members, limits)
    held = listed.select(*group, "doc_id", F.explode("d").alias("e")).join(shared, [*group, "e"])
    held = held.groupBy(*group, "doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("es")).withColumn("c", F.size("es"))
    held = staged(spark, fit(held.join(listed.drop("d", "n"), [*group, "doc_id"])), "held")
    drop(shared, listed)
    spots = held.select(*group, "doc_id", "comp", "main", "f", "g", "c", F.posexplode(F.slice("es", F.lit(1), F.col("room"))).alias("pos", "x"))
    spots = staged(spark, spots.select(*group, "doc_id", "comp", "main", "f", "g", (F.col("c") - F.col("pos")).alias("left"), F.col("x.e").alias("e")), "spots")
    one = spots.where("comp <> main").select(*group, "e", *(F.col(c).alias(f"{c}1") for c in ("doc_id", "comp", "f", "g", "left")))
    other = spots.select(*group, "e", "main", *(F.col(c).alias(f"{c}2") for c in ("doc_id", "comp", "f", "g", "left")))
    able = F.expr(f"comp1 <> comp2 and (comp2 = main or doc_id1 < doc_id2) and f1 <= g2 and f2 <= g1 and {2 * whole} * least(left1, left2) >= f1 + f2")
    pairs = one.join(other, [*group, "e"]).where(able).select(F.least("doc_id1", "doc_id2").alias("a"), F.greatest("doc_id1", "doc_id2").alias("b")).distinct()
    pairs = staged(spark, pairs, "candidates")
    drop(open_groups, held, spots)
    return pairs


def components(links: DataFrame) -> DataFrame:
    """(node, least): smallest node reachable over links (a, b), by spreading minima and jumping to the minimum's own."""
    spark = links.sparkSession
    both = staged(spark, links.select("a", "b").union(links.select("b", "a")).distinct(), "both")
    label = staged(spark, both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("least")), "label")
    while True:
        seen = both.join(label.select(F.col("node").alias("b"), F.col("least").alias("l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        nxt = label.join(seen, "node").select("node", "least", F.least("least", "l").alias("to"))
        jump = label.select(F.col("node").alias("to"), F.col("least").alias("far"))
        nxt = staged(spark, nxt.join(jump, "to").select("node", F.col("least").alias("was"), F.least("to", "far").alias("least")), "next")
        drop(label)
        label = nxt
        if nxt.where("was <> least").isEmpty():
            drop(both)
            return staged_as(nxt, nxt.select("node", "least"))


def staged_as(source: DataFrame, df: DataFrame) -> DataFrame:
    """``df`` reads the staged table ``source`` and is dropped with it."""
    df._staged_at = source._staged_at
    return df


def near_duplicates(docs: DataFrame, words: int = 5, threshold: int = 80, k: int = K, overlap: int = OVERLAP, short: int = SHORT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key): components of documents linked at ``threshold`` percent
    Jaccard; text_key is the text's md5, for rows that share an id."""
    spark = docs.sparkSession
    base = documents(docs)
    every = staged(spark, _sketches(base, words, k), "sketches")
    kinds = staged(spark, every.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "kinds")
    first = kinds.select("k1", "k2", F.col("rep").alias("doc_id"))
    reps = staged(spark, every.join(first, ["k1", "k2", "doc_id"], "left_semi").dropDuplicates(["doc_id", "k1", "k2"]).select("doc_id", "n_shingles", "sketch"), "reps")
    lists = _lists(reps, k, overlap, threshold, short)
    near = _short_pairs(lists.where(F.col("m") <= short), reps, k, overlap, threshold)
    entries = staged(spark, lists.where(F.col("m") > short).where("doc_id <> lead").select("lead", "doc_id").distinct(), "entries")
    ids = near.select(F.col("a").alias("doc_id")).union(near.select("b")).union(entries.select("lead")).union(entries.select("doc_id"))
    wanted = staged(spark, ids.distinct(), "wanted")
    sets = staged(spark, _sets(base, wanted, words), "sets")
    drop(reps, lists, wanted)
    entries = _centred(entries, sets, threshold)

    diffs = staged(spark, _differences(entries, sets, threshold), "differences")
    close = F.col("m") * (100 + threshold) <= (F.col("n") + F.col("nl")) * (100 - threshold)
    led = diffs.where(close).select(F.col("lead").alias("a"), F.col("doc_id").alias("b"))
    links = staged(spark, _verified(near, sets, threshold).union(led), "links")
    found = components(links)
    comp = found.select(F.col("node").alias("doc_id"), F.col("least").alias("comp"))
    pairs = _pairs_by_differences(diffs, comp, threshold)
    more = staged(spark, _verified(pairs, sets, threshold), "more")
    drop(near, entries, sets, links, pairs)

    # the links found last join components; nodes that no link had so far stand for themselves
    at, bt = comp.select(F.col("doc_id").alias("a"), F.col("comp").alias("ca")), comp.select(F.col("doc_id").alias("b"), F.col("comp").alias("cb"))
    over = more.join(at, "a", "left").join(bt, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    joined = components(over)
    nodes = comp.select("doc_id").union(more.select("a")).union(more.select("b")).distinct().join(comp, "doc_id", "left")
    nodes = nodes.withColumn("node", F.coalesce("comp", "doc_id")).join(joined, "node", "left").select("doc_id", F.coalesce("least", "node").alias("comp"))
    named = kinds.join(nodes.withColumnRenamed("doc_id", "rep"), "rep", "left").select("k1", "k2", F.coalesce("comp", "rep").alias("component_id"))
    named = staged(spark, named, "named")
    drop(kinds, found, more, joined)
    members = every.select("doc_id", "text_key", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    found = members.select("doc_id", "n_shingles", component.alias("component_id"), "text_key")
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key")


def digest(found: DataFrame) -> DataFrame:
    return found.drop("text_key")
