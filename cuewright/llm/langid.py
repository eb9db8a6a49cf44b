"""Language identification with a linear-chain conditional random field.

Words (runs of letters, lower-cased) are labelled one after the other.  A word's
potentials are sums of learned weights of its character n-grams, of its affixes
and of its entry in a lexicon of frequent words; transition weights between the
labels of neighbours are learned as well.  Training sequences splice passages of
different texts, so that changes of language within a text are seen.
Forward-backward gives each word's label probabilities; a text's language is
the one with the largest sum of them, and its score that sum's share.

Fitting takes a bounded sample, ``sample_rows`` labelled rows chosen by hash of
those of at most ``sample_chars`` characters, with their whole texts; every text, whole, is then labelled.  Long texts are cut
into segments only for speed: products of segments' transfer matrices carry the
chain exactly over the cuts.

Texts that are null or have no letter are ``und`` with score 0, and so is all
when there is nothing to learn from.  Rows without doc_id are labelled too and
never learned from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_rows

SAMPLE_ROWS, SAMPLE_CHARS = 1200, 65_536
LEXICON = 3000
BUCKETS = 1 << 16
SEGMENT = 48
REMEMBERED = 100_000
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    ws = _WORD.findall((text or "").lower())
    if ws and not "".join(ws).isalpha():
        ws = [w for w in ws if any(c.isalpha() for c in w)]
    return ws


def _features(ws: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and the word each belongs to."""
    lengths = np.fromiter((len(w) + 2 for w in ws), np.int64, len(ws))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    c = np.frombuffer("".join(f"\x02{w}\x03" for w in ws).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(ws)), lengths)
    ids, owners = [], []

    def add(h: np.ndarray, own: np.ndarray, kind: int) -> None:
        h = (h + np.uint64(kind * 7919)) * np.uint64(0x9E3779B97F4A7C15)
        ids.append((h >> np.uint64(48)).astype(np.int64) % BUCKETS)
        owners.append(own)

    mul, h = np.uint64(1_000_003), c
    for n in (2, 3):
        h = h[:-1] * mul + c[n - 1 :]
        inside = owner[: len(h)] == owner[n - 1 :]
        add(h[inside], owner[: len(h)][inside], n)
    for n in (4, 5):
        fits = np.flatnonzero(lengths >= n)
        for kind, at in ((10 + n, starts[fits]), (20 + n, ends[fits] - n)):
            h = np.zeros(len(fits), np.uint64)
            for j in range(n):
                h = h * mul + c[at + j]
            add(h, fits, kind)
    known = [(lexicon[w], i) for i, w in enumerate(ws) if w in lexicon]
    if known:
        a = np.array(known, np.int64)
        ids.append(a[:, 0] + BUCKETS)
        owners.append(a[:, 1])
    return np.concatenate(ids), np.concatenate(owners)


def _emit(ids: np.ndarray, owner: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(owner, weights=weights[ids, j], minlength=n) for j in range(weights.shape[1])], axis=1)


def forward_backward(potentials: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, segment: int = SEGMENT, messages: bool = False):
    """Label probabilities of every word; potentials are log scores, row by row, of sequences of the given lengths.

    With ``messages`` also each word's forward message and its potential times its backward message.
    """
    total, k = potentials.shape
    lengths = lengths[lengths > 0]
    if not total:
        return np.zeros((0, k))
    a = np.exp(transitions - transitions.max())
    psi = np.exp(potentials - potentials.max(axis=1, keepdims=True))
    pieces = -(-lengths // segment)
    first = np.cumsum(pieces) - pieces
    n, seq = int(pieces.sum()), np.repeat(np.arange(len(lengths)), pieces)
    part = np.arange(n) - first[seq]
    begin = (np.cumsum(lengths) - lengths)[seq] + part * segment
    size = np.minimum(segment, lengths[seq] - part * segment)
    width = int(size.max())
    x = np.ones((n, width, k))
    valid = np.arange(width) < size[:, None]
    x[valid] = psi  # segments follow one another as the words do

    m = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(width):
        v = valid[:, t]
        step = (m[v] @ a) * x[v, t][:, None, :]
        m[v] = step / step.sum(axis=(1, 2), keepdims=True)
    into, out = np.ones((n, k)), np.ones((n, k))
    for j in range(int(pieces.max()) - 1):
        more = np.flatnonzero(pieces > j + 1)
        s = first[more] + j
        f = np.einsum("nk,nkl->nl", into[s], m[s])
        into[s + 1] = f / f.sum(axis=1, keepdims=True)
        e = first[more] + pieces[more] - 1 - j
        b = np.einsum("nkl,nl->nk", m[e], out[e])
        out[e - 1] = b / b.sum(axis=1, keepdims=True)
    alpha, beta = np.empty_like(x), np.empty_like(x)
    f = into
    for t in range(width):
        f = (f @ a) * x[:, t]
        f = f / f.sum(axis=1, keepdims=True)
        alpha[:, t] = f
    b = out
    for t in range(width - 1, -1, -1):
        beta[:, t] = b
        b = np.where(valid[:, t, None], (b * x[:, t]) @ a.T, b)
        b = b / b.sum(axis=1, keepdims=True)
    p = alpha * beta
    p = (p / p.sum(axis=2, keepdims=True))[valid]
    return (p, alpha[valid], (beta * x)[valid]) if messages else p


@dataclass
class Model:
    labels: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray


def fit(rows: list[tuple[str, str]], epochs: int = 4, seed: int = 7) -> Model:
    """Learn from (text, language): AdaGrad on the conditional likelihood of spliced passages."""
    rows = [(ws, lang) for text, lang in rows if lang and (ws := words(text))]
    labels = sorted({lang for _, lang in rows})
    counts = Counter(w for ws, _ in rows for w in ws)
    lexicon = {w: i for i, (w, c) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]) if c > 2}
    k = max(1, len(labels))
    model = Model(labels, lexicon, np.zeros((BUCKETS + LEXICON, k), np.float32), np.zeros((k, k)))
    if len(labels) < 2:
        return model
    rng = np.random.default_rng(seed)
    passages = []
    for ws, lang in rows:
        at = 0
        while at < len(ws):
            n = int(rng.integers(3, 40))
            passages.append((ws[at : at + n], labels.index(lang)))
            at += n
    share = np.bincount([y for _, y in passages], minlength=k) / len(passages)
    passages = [p for p in passages if rng.random() < min(1.0, 1.5 * share[share > 0].min() / share[p[1]] + 0.3)]
    types = {w: i for i, w in enumerate(dict.fromkeys(w for ws, _ in passages for w in ws))}
    ids, owner = _features(list(types), lexicon)
    order = np.argsort(owner, kind="stable")
    ids, bounds = ids[order], np.searchsorted(owner[order], np.arange(len(types) + 1))
    gw, gt = np.full(model.weights.shape, 1e-2, np.float32), np.full((k, k), 1e-2)
    for _ in range(epochs):
        mixed = [passages[i] for i in rng.permutation(len(passages))]
        for at in range(0, len(mixed), 600):
            batch = mixed[at : at + 600]
            cuts = np.minimum(np.cumsum(rng.integers(1, 6, len(batch))), len(batch))
            cuts = np.unique(np.append(cuts, len(batch)))
            sizes = np.array([len(ws) for ws, _ in batch])
            lengths = np.add.reduceat(sizes, np.append(0, cuts[:-1])[np.append(0, cuts[:-1]) < len(batch)])
            token = np.array([types[w] for ws, _ in batch for w in ws])
            gold = np.repeat([y for _, y in batch], sizes)
            used, local = np.unique(token, return_inverse=True)
            spans = [ids[bounds[u] : bounds[u + 1]] for u in used]
            flat, own = np.concatenate(spans), np.repeat(np.arange(len(used)), [len(s) for s in spans])
            p, ahead, behind = forward_backward(_emit(flat, own, len(used), model.weights)[local], lengths, model.transitions, messages=True)
            err = -p
            err[np.arange(len(gold)), gold] += 1
            by_type = np.stack([np.bincount(local, weights=err[:, j], minlength=len(used)) for j in range(k)], axis=1)
            touched, where = np.unique(flat, return_inverse=True)
            grad = np.stack([np.bincount(where, weights=by_type[own, j], minlength=len(touched)) for j in range(k)], axis=1)
            grad -= 1e-3 * model.weights[touched]
            gw[touched] += grad**2
            model.weights[touched] += 0.3 * grad / np.sqrt(gw[touched])
            # transitions: pairs of neighbours seen less those expected
            starts = np.cumsum(lengths) - lengths
            inner = np.ones(len(gold), bool)
            inner[starts] = False
            at1 = np.flatnonzero(inner)
            a = np.exp(model.transitions - model.transitions.max())
            pair = ahead[at1 - 1][:, :, None] * a * behind[at1][:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            g = np.zeros((k, k))
            np.add.at(g, (gold[at1 - 1], gold[at1]), 1)
            g -= pair.sum(axis=0)
            gt += g**2
            model.transitions += 0.2 * g / np.sqrt(gt)
    return model


class Labeller:
    """Label probabilities with a model, remembering the potentials of words met before."""

    def __init__(self, model: Model):
        self.m, self.known, self.table = model, {}, np.zeros((0, max(1, len(model.labels))))

    def __call__(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known, self.table = {}, self.table[:0]
        new = list(dict.fromkeys(w for ws in texts for w in ws if w not in self.known))
        if new:
            self.table = np.concatenate((self.table, _emit(*_features(new, self.m.lexicon), len(new), self.m.weights)))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        lengths = np.array([len(ws) for ws in texts])
        token = np.array([self.known[w] for ws in texts for w in ws], np.int64)
        p = forward_backward(self.table[token], lengths, self.m.transitions)
        return np.split(p, np.cumsum(lengths)[:-1])


def _held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def learn(docs: DataFrame, lang: str = "lang", sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on rows with a language whose crc32(doc_id as text) mod 5 is not 0: a hashed sample of at most sample_rows."""
    able = documents(docs.where(F.col(lang).isNotNull())).where("doc_id is not null").where(~_held_out()).where(F.length("text") <= sample_chars)
    ids = able.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).orderBy("h", "doc_id").limit(sample_rows)
    chosen = [r.doc_id for r in ids.collect()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    got = rows.where(F.col("doc_id").isin(chosen) & F.col("lang").isNotNull() & (F.length("text") <= sample_chars)).orderBy("doc_id", "text", "lang").limit(2 * sample_rows).collect() if chosen else []
    return fit([(r.text, r.lang) for r in got])


def languages(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id or the columns to keep, lang_pred, score, n_words, shares) of each row, from the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[dict], dict]:
        label = Labeller(held.value)
        labels = held.value.labels

        def run(x: dict) -> dict:
            texts = [words(t) for t in x["text"]]
            lang, score, shares = [], [], []
            for ws, p in zip(texts, label(texts), strict=True):
                if not ws or not labels:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    shares.append({})
                    continue
                s = p.mean(axis=0)
                best = int(s.argmax())
                lang.append(labels[best])
                score.append(float(min(1.0, s[best])))
                shares.append({n: float(v) for n, v in zip(labels, s, strict=True)})
            return {"lang_pred": lang, "score": score, "n_words": [len(ws) for ws in texts], "shares": [list(s.items()) for s in shares]}
        return run

    rows = docs.select(*dict.fromkeys((*keep, "text"))) if keep else documents(docs)
    return map_rows(rows, make, "lang_pred string, score double, n_words long, shares map<string,double>", 128, keep or ("doc_id",))


def labelled_words(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, words, langs): each word of code-switched texts with its most probable language."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[dict], dict]:
        label = Labeller(held.value)

        def run(x: dict) -> dict:
            texts = [words(t) for t in x["text"]]
            langs = [[held.value.labels[i] for i in p.argmax(axis=1)] if len(p) and held.value.labels else [UNKNOWN] * len(p) for p in label(texts)]
            return {"doc_id": x["doc_id"], "words": texts, "langs": langs}
        return run

    return map_rows(documents(docs), make, "doc_id long, words array<string>, langs array<string>", 128)


def digest(docs: DataFrame, model: Model) -> DataFrame:
    return languages(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")
