"""Personal data in whole texts, also where it is disguised.

Plain identifiers are found on the text itself (``base``).  Then transducers
rewrite disguises and keep, for each character written, the source characters
it stands for: homoglyphs (full-width forms, look-alike Greek and Cyrillic
letters, other scripts' digits) become ASCII, runs of spelled digits become
digits, encoded signs, and ``at``/``dot`` in brackets or between words become @ and a full
stop, each for itself.  Identifiers of the rewritten text map back to source spans, and those
that do not lie within a plain one of their kind are added.

Secrets (values given to a token, key or password, and keys of well-known forms) are
a list of their own beside the four kinds, and are redacted with them.

Offsets are code points, end exclusive.  Null or empty texts have no spans.  Equal
rows get equal results, rows without doc_id too; empty tables give no rows.
Overlapping spans are all listed, by start and kind.  Time is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_rows

KINDS = ("email", "ip", "card", "phone")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IN_DOTS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; a local part can only end at an @, so only those are looked at."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((a, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Chains of numbers and dots hold one match in each four numbers from the left."""
    out = []
    for m in _DOTTED.finditer(text):
        parts = [(p.start(), p.end()) for p in _IN_DOTS.finditer(text, m.start(), m.end())]
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(n := text[a:b].lstrip("0")) <= 3 and int(n or "0") <= 255 for a, b in four):
                out.append((four[0][0], four[3][1]))
    return out


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]


def identify(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    found = [(k, a, b) for k, f in zip(KINDS, (emails, ips, cards, phones), strict=True) for a, b in f(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


# ---- transducers -----------------------------------------------------------------------------------------------

# Letters of other scripts that look like ASCII ones.
_LOOK_ALIKE = dict(zip("АВЕКМНОРСТХаеорсухіјѕԁΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTXaeopcyxijsdABEZHIKMNOPTYXo", strict=True))
_AT_SIGNS = {"＠": "@", "﹫": "@"}
_DOTS = {"．": ".", "。": ".", "․": ".", "﹒": "."}
_INVISIBLE = frozenset("​‌‍⁠﻿­")

# Digit words.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_WORD = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?<![^\W_])(?:(?:plus|{_WORD}|[0-9])(?:[ \t,.-]+|(?![^\W_]))){{7,}}", re.I)
_SPELLED_ONE = re.compile(rf"(?<![^\W_])(plus|{_WORD}|[0-9])(?![^\W_])", re.I)
_BRACKETED = re.compile(r"[\[({<][ \t]*(?:(at|@|ät|arroba|arobase)|dot|\.|punkt|punto|point)[ \t]*[\])}>][ \t]*", re.I)
# Unbracketed words; French "point" is too frequent a word in English.
_WORDED_DOT = re.compile(r"(?<=[ \t])(?:dot|punkt|punto)[ \t]+(?=[A-Za-z0-9-])", re.I)
_WORDED_AT = re.compile(r"(?<=[ \t])(?:at|arroba|arobase)[ \t]+(?=[A-Za-z0-9-])", re.I)
# What may follow a whole address and a dot in words: the country at its end, with nothing behind it.
_COUNTRY = re.compile(r"[A-Za-z]{2}(?![ \t]*[\w-])")
_LABEL_DOT = r"(?:\.|[ \t]+(?:dot|punkt|punto)[ \t]+|[ \t]*[\[({<][ \t]*(?:dot|\.|punkt|punto|point)[ \t]*[\])}>][ \t]*)"
# A host name whose last label is letters (or an encoded one), as every top-level label is.
_HOST = re.compile(rf"[A-Za-z0-9-]+(?:{_LABEL_DOT}[A-Za-z0-9-]+)*{_LABEL_DOT}(?:[A-Za-z]{{2,63}}|xn--[A-Za-z0-9-]+)(?![A-Za-z0-9])", re.I)
# Words that are no host name, as in "look at the dot com boom".
_NO_HOST = re.compile(r"(?:the|a|an|this|that|each|every|any|your|our|my|his|her|their|its|some)(?:[ \t]+(?:dot|punkt|punto)[ \t]|\.)", re.I)
# Character references and percent codes of @ and the full stop.
_ENCODED = re.compile(r"(&(?:#0*64|#x0*40|commat);|%40)|&(?:#0*46|#x0*2e|period);|%2e", re.I)


class Tape:
    """A text under rewriting: the start and end in the source of each character."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, None, None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace disjoint spans, in order; each character written stands for the whole span it replaces."""
        if not edits:
            return
        if self.start is None:
            self.start, self.end = list(range(len(self.text))), list(range(1, len(self.text) + 1))
        out, s, e, at = [], [], [], 0
        for a, b, new in edits:
            out += (self.text[at:a], new)
            s += self.start[at:a] + [self.start[a]] * len(new)
            e += self.end[at:a] + [self.end[b - 1]] * len(new)
            at = b
        self.text = "".join(out) + self.text[at:]
        self.start, self.end = s + self.start[at:], e + self.end[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (self.start[a], self.end[b - 1]) if self.start is not None else (a, b)


def _plain(c: str) -> str | None:
    if c in _INVISIBLE:
        return ""
    if c in _LOOK_ALIKE:
        return _LOOK_ALIKE[c]
    if c in _AT_SIGNS or c in _DOTS:
        return _AT_SIGNS.get(c) or _DOTS[c]
    if c.isdecimal():
        return str(unicodedata.digit(c))
    n = unicodedata.normalize("NFKC", c)
    return n if n != c and len(n) == 1 and n.isascii() else None


# All that ``_plain`` may change; the second class is what it changes within the ranges of the first.
_BEYOND_LATIN = re.compile("[^\x00-\xac\xae-ɏ‐-‣‥-‧€]|[\xa0ª²³¹ºſ]")


def _homoglyphs(tape: Tape) -> None:
    if tape.text.isascii():
        return
    edits = [(m.start(), m.end(), p) for m in _BEYOND_LATIN.finditer(tape.text) if (p := _plain(m[0])) is not None]
    soft = [(i, i + 1, "") for i, c in enumerate(tape.text) if c == "­"] if "­" in tape.text else []
    tape.rewrite(sorted({*edits, *soft}))


def _digit(word: str) -> str:
    """The digit of a word; casefold and dotless i because ``re.I`` lets ſ, İ and ı stand for s and i."""
    word = word.casefold().replace("i̇", "i").replace("ı", "i")
    return "+" if word == "plus" else _DIGIT_WORDS.get(word, word)


def _digits(tape: Tape) -> None:
    edits = []
    for m in _SPELLED.finditer(tape.text):
        words = list(_SPELLED_ONE.finditer(tape.text, m.start(), m.end()))
        new = [_digit(w[1]) for w in words]
        if sum(d != "+" and len(w[1]) > 1 for w, d in zip(words, new, strict=True)) < 5:
            continue
        for i, (w, d) in enumerate(zip(words, new, strict=True)):
            if w[1] != d:
                edits.append((w.start(), w.end(), d))
            if i + 1 < len(words):
                edits.append((w.end(), words[i + 1].start(), "" if d == "+" else " "))
    tape.rewrite(edits)


def _encoded(tape: Tape) -> None:
    if "&" in tape.text or "%" in tape.text:
        tape.rewrite([(m.start(), m.end(), "@" if m[1] else ".") for m in _ENCODED.finditer(tape.text)])


def _signs(tape: Tape) -> None:
    """Every bracketed at and dot and every dot between words, but behind a whole address only
    before a country ("a@b.com dot the i" goes on with words); an at between words only before a
    host name, if a dot of the address is disguised as well ("see us at example.com" is no address)."""
    t, found = tape.text, []

    def add(m: re.Match, sign: str) -> None:
        a = m.start()
        while a and t[a - 1] in " \t":
            a -= 1
        found.append((a, m.end(), sign))

    if any(x in t for x in "[({<"):
        for m in _BRACKETED.finditer(t):
            add(m, "@" if m[1] else ".")
    low = t.lower()
    if "dot" in low or "punkt" in low or "punto" in low:
        whole = {b for _, b in emails(t)}
        for m in _WORDED_DOT.finditer(t):
            add(m, ".")
            if found[-1][0] in whole and not _COUNTRY.match(t, m.end()):
                found.pop()
    dots = {b: a for a, b, sign in found if sign == "."}
    starts = sorted(dots.values())
    for m in _WORDED_AT.finditer(t) if dots else ():
        a = m.start()
        while a and t[a - 1] in " \t":
            a -= 1
        if not a or t[a - 1] not in _LOCAL_CHARS or not (host := _HOST.match(t, m.end())) or _NO_HOST.match(t, m.end()):
            continue
        first = a
        while first and t[first - 1] in _LOCAL_CHARS:
            first -= 1
        if bisect_left(starts, host.end()) > bisect_left(starts, host.start()) or (first in dots and t[dots[first] - 1 : dots[first]] in _LOCAL_CHARS):
            found.append((a, m.end(), "@"))
    edits, last = [], 0
    for a, b, sign in sorted(found):
        if b > last:
            edits.append((max(a, last), b, sign))
            last = b
    tape.rewrite(edits)


def spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Plain spans, and all: the plain ones with those of the rewritten text that lie in none of their kind."""
    text = text or ""
    base = identify(text)
    tape = Tape(text)
    for step in (_homoglyphs, _encoded, _digits, _signs):
        step(tape)
    if tape.start is None:
        return base, base
    out, plain = list(base), {k: [(x, y) for kind, x, y in base if kind == k] for k in KINDS}
    for kind, a, b in identify(tape.text):
        s, e = tape.source(a, b)
        i = bisect_right(plain[kind], (s, len(text)))  # those of a kind are disjoint, so only the last one from the left can hold it
        if not i or plain[kind][i - 1][1] < e:
            out.append((kind, s, e))
    return base, sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_NAMED = re.compile(
    r"(?<![^\W_])(?:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|passw(?:or)?d|pwd)[\"']?[ \t]{0,3}[:=][ \t]{0,3}(?P<q>[\"']?)(?P<value>[A-Za-z0-9+/_.~-]{12,})(?=(?P=q))", re.I)
_NAMES = ("key", "token", "secret", "pass", "pwd")
# Forms of keys that say themselves what they are, with what each starts with.
_KEYS = {"AKIA": r"AKIA[0-9A-Z]{16}", "gh": r"gh[pousr]_[A-Za-z0-9]{36}", "xox": r"xox[abpr]-[A-Za-z0-9-]{10,}", "sk-": r"sk-[A-Za-z0-9]{20,}", "AIza": r"AIza[A-Za-z0-9_-]{35}"}
_KEY_FORMS = {start: re.compile(rf"(?<![A-Za-z0-9_-]){form}(?![A-Za-z0-9])") for start, form in _KEYS.items()} | {"-----BEGIN ": re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")}


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    """("secret", start, end) of values that hold letters and digits and are named as secret, and of keys of known forms."""
    text, found = text or "", []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [m.span("value") for m in _NAMED.finditer(text) if any(c.isdigit() for c in m["value"]) and any(c.isalpha() for c in m["value"])]
    for start, form in _KEY_FORMS.items():
        if start in text:
            found += [m.span() for m in form.finditer(text)]
    return [("secret", a, b) for a, b in sorted(set(found))]


def redact(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """Each span, or overlapping spans together, becomes the first one's kind in angle brackets."""
    if not found:
        return text
    out, at, i = [], 0, 0
    while i < len(found):
        kind, a, b = found[i]
        while i + 1 < len(found) and found[i + 1][1] < b:
            i += 1
            b = max(b, found[i][2])
        out += (text[at:a], f"<{kind.upper()}>")
        at = b
        i += 1
    return "".join(out) + text[at:]


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of plain spans by kind, base and all spans as structs, secrets likewise)."""
    span = "array<struct<kind:string,start:long,stop:long>>"

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            got = [spans(t) for t in x["text"]]
            form = lambda f: [{"kind": k, "start": a, "stop": b} for k, a, b in f]
            return {"doc_id": x["doc_id"], "base": [form(g[0]) for g in got], "every": [form(g[1]) for g in got], "secrets": [form(secrets(t)) for t in x["text"]]}
        return run

    found = map_rows(documents(docs), make, f"doc_id long, base {span}, every {span}, secrets {span}")
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, "base", "every", "secrets")


def digest(found: DataFrame) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("every").alias("spans"),
                        F.size("secrets").cast("long").alias("n_secret"), (F.size("every") + F.size("secrets")).cast("long").alias("n_found"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, with every span found in ``text`` replaced by its kind; null stays null."""
    rest = [c for c in docs.columns if c != text]

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            return {text: [None if t is None else redact(t, sorted(spans(t)[1] + secrets(t), key=lambda s: s[1])) for t in x[text]]}
        return run

    return map_rows(docs, make, f"`{text}` string", keep=rest).select(*docs.columns)
