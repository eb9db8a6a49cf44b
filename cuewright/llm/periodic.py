"""Runs of repeated words by the method of Kolpakov and Kucherov.

A run is a stretch of words with smallest period q, at least ``times`` periods and
``least`` words long, that no neighbouring word extends.  A suffix automaton with
the first end of each state gives the factorisation: each factor is the longest
stretch that also starts earlier.  Runs that touch a border of factors are found
there by Main's algorithm, from longest common extensions in both directions.  All
others lie inside a factor and are copied from the factor's earlier occurrence.

A word of a run occurs in it at least ``times`` times.  So a text is first cut at
words that are rarer, and its pieces again at words that are rare in them; what is
left alone goes through the automaton, with the same runs as the whole text.  Time
and memory are linear in a text, but for a factor that Main's algorithm owes to the
overlap of neighbouring windows, 1 + 2 / (times - 1) at most.

Each row is judged alone: nothing is shuffled, ties and repeated rows need no rule,
other columns never matter.  Null, empty and blank texts have no words and no runs;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import encoded
from .common import documents, map_rows

LEAST, TIMES = 6, 4
#: Rounds of cutting; a piece that could still be cut goes through the automaton as it is.
ROUNDS = 24
_RUNS = "array<struct<start:long,length:long,period:long>>"


def suffix_automaton(w: list[int]) -> tuple[list[dict[int, int]], list[int]]:
    """Transitions of each state, and the place where the first occurrence of its strings ends."""
    to: list[dict[int, int]] = [{}]
    link, size, first, last = [-1], [0], [-1], 0
    for i, c in enumerate(w):
        new, at = len(to), last
        to.append({})
        size.append(size[last] + 1)
        first.append(i)
        link.append(0)
        while at >= 0 and c not in to[at]:
            to[at][c] = new
            at = link[at]
        if at >= 0:
            q, longest = to[at][c], size[at] + 1
            if size[q] != longest:
                q, twin = len(to), q
                to.append(to[twin].copy())
                size.append(longest)
                first.append(first[twin])
                link.append(link[twin])
                link[twin] = q
                while at >= 0 and to[at].get(c) == twin:
                    to[at][c] = q
                    at = link[at]
            link[new] = q
        last = new
    return to, first


def factors(w: list[int]) -> list[tuple[int, int]]:
    """(start, start of an earlier occurrence or -1) of each factor."""
    to, first = suffix_automaton(w)
    out, at, n = [], 0, len(w)
    while at < n:
        state, end = 0, at
        while end < n and first[following := to[state][w[end]]] < end:
            state, end = following, end + 1
        out.append((at, first[state] - (end - at) + 1 if end > at else -1))
        at = max(end, at + 1)
    return out


def _prefixes(s: list[int], upto: int) -> list[int]:
    """How long a prefix of s starts at each place below ``upto``; 0 at the first."""
    z, left, right, n = [0] * upto, 0, 0, len(s)
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _touching(w: list[int], left: int, at: int, end: int, least: int, times: int, found: dict[tuple[int, int], int]) -> None:
    """Add runs that start in (left, at], or at the text's start, and end in [at, end]."""
    most = (end - left) // times
    if not most or end - left < least:
        return
    n, t, v = len(w), w[left:at], w[at:end]
    near, far = min(most, len(t)), min(most, len(v))
    ahead = _prefixes([*v, -1, *t[len(t) - near :], *v], len(v) + 1 + near)
    back = _prefixes([*t[::-1], -1, *v[:far][::-1]], len(t) + 1 + far)
    split = len(v) + 1 + near
    candidates = []
    for p in range(1, near + 1):  # a period lies before the border
        behind = back[p] if p < len(t) else 0
        over = ahead[split - p]
        if behind + over + p >= times * p:
            candidates.append((at - p - behind, at + over, p))
    split = len(t) + 1 + far
    for p in range(1, far + 1):  # a period lies behind the border, and none before it
        behind = back[split - p]
        over = ahead[p] if p < len(v) else 0
        if behind < p and behind + over + p >= times * p:
            candidates.append((at - behind, at + p + over, p))
    for a, z, p in candidates:
        if z - a < least or (a == left and left) or (z == end and z < n and w[z] == w[z - p]):
            continue
        if found.get((a, z), p) >= p:
            found[a, z] = p


def runs_of(w: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, stop, period) of every run, by start and period; words are numbers from 0."""
    n, parts = len(w), factors(w)
    borders = [a for a, _ in parts] + [n]
    found: dict[tuple[int, int], int] = {}
    for h in range(1, len(borders)):
        at, before = borders[h], borders[h - 1]
        end = borders[h + 1] if h + 1 < len(borders) else n
        # a longer reach to the left would make the factor before longer
        left = max(0, before - -(-(end - before) // (times - 1)))
        _touching(w, left, at, end, least, times, found)
    if not found:
        return []
    by_start: list[list[tuple[int, int]] | None] = [None] * n
    for (a, z), p in found.items():
        by_start[a] = [*(by_start[a] or ()), (z, p)]
    for (at, earlier), end in zip(parts, borders[1:], strict=True):
        if earlier < 0:
            continue
        shift = at - earlier
        for a in range(earlier + 1, end - shift):
            for z, p in by_start[a] or ():
                if z + shift < end:
                    by_start[a + shift] = [*(by_start[a + shift] or ()), (z + shift, p)]
    return sorted(((a, z, p) for a, own in enumerate(by_start) for z, p in own or ()), key=lambda r: (r[0], r[2]))


def pieces(text: np.ndarray, word: np.ndarray, least: int, times: int) -> np.ndarray:
    """(start, stop) of stretches, none over two texts, that can hold runs; ``text`` ascends."""
    place = np.arange(len(word))
    part, done = text.astype(np.int64), []
    for _ in range(ROUNDS):
        _, own, count = np.unique(part * (int(word.max(initial=0)) + 1) + word[place], return_inverse=True, return_counts=True)
        ok = count[own] >= times
        if ok.all():
            break
        cut = np.unique(part[~ok])
        whole = ~np.isin(part, cut, assume_unique=False)
        if whole.any():
            done.append(_stretches(place[whole], part[whole], least)[0])
        ok &= ~whole
        place, part = place[ok], part[ok]
        spans, size = _stretches(place, part, 0)
        long = size >= least
        part = np.repeat(np.arange(len(size)), size)
        stays = long[part]
        place, part = place[stays], part[stays]
        if not len(place):
            break
    if len(place):
        done.append(_stretches(place, part, least)[0])
    out = np.concatenate(done) if done else np.zeros((0, 2), np.int64)
    return out[np.argsort(out[:, 0])]


def _stretches(place: np.ndarray, part: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring places of one part, as (start, stop), and how many places each has."""
    if not len(place):
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero((np.diff(place) != 1) | (np.diff(part) != 0)) + 1
    a, z = place[np.concatenate(([0], edge))], place[np.concatenate((edge - 1, [len(place) - 1]))] + 1
    spans = np.stack((a, z), 1)[z - a >= least]
    return spans, z - a


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): runs by start, then period, and the text's words but those behind a run's first period.

    Words are what ASCII white space parts; in ``collapsed`` one space joins them.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            texts = [encoded(t).split() for t in x["text"]]
            known: dict[bytes, int] = {}
            word = np.array([known.setdefault(w, len(known)) for ws in texts for w in ws], np.int64)
            n = np.array([len(ws) for ws in texts], np.int64)
            begin = np.cumsum(n) - n
            text = np.repeat(np.arange(len(texts)), n)
            runs: list[list[dict]] = [[] for _ in texts]
            for a, z in pieces(text, word, least, times).tolist():
                names: dict[int, int] = {}
                w = [names.setdefault(c, len(names)) for c in word[a:z].tolist()]
                own = int(text[a])
                shift = a - int(begin[own])
                runs[own] += [{"start": s + shift, "length": e - s, "period": p} for s, e, p in runs_of(w, least, times)]
            kept = []
            for ws, own in zip(texts, runs, strict=True):
                if own:
                    gone = np.zeros(len(ws) + 1, np.int64)
                    for r in own:
                        gone[r["start"] + r["period"]] += 1
                        gone[r["start"] + r["length"]] -= 1
                    ws = [w for w, g in zip(ws, np.cumsum(gone)[:-1].tolist(), strict=True) if not g]
                kept.append(b" ".join(ws).decode("utf-8", "surrogatepass"))
            return {"doc_id": x["doc_id"], "n_words": n.tolist(), "runs": runs, "collapsed": kept}
        return run

    return map_rows(documents(docs), make, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """Documents, of which a tenth, told by doc_id, go on from some word with a few words over and over.

    Rows without doc_id stay as they are.
    """
    base = documents(docs)
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = base.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    chosen = chosen.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    chosen = chosen.withColumn("p", (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    tail = F.slice("w", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(tail, F.ceil((n - F.col("a")) / F.col("p")).cast("int"))), F.lit(1), n - F.col("a"))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), again), " ")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest length / period, the first of equal ones; null if there is none."""
    return F.aggregate(
        runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    best = found.withColumn("best", strongest())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
