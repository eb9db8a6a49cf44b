"""Rule packs, validated and compiled to column expressions when a plan is built."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

WORD = r"[\p{L}\p{N}_]"


def _quoted(text: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", text)


def bounded(fragments: Iterable[str], literal: bool = False) -> str:
    """One case-blind alternation with word borders on both sides."""
    parts = [_quoted(f) if literal else f.replace(r"\w", WORD) for f in fragments]
    return rf"(?iu)(?<!{WORD})(?:{'|'.join(parts)})(?!{WORD})"


def holds_any(text: Column, parts: Iterable[str]) -> Column:
    """Whether one of the lower-case ASCII literals can be in the text, as a case-blind pattern sees it: false proves that none is.

    Four letters beyond ASCII stand for ASCII ones in such patterns; a text with one of them may hold anything.
    """
    low = F.lower(text)
    found = [low.contains(p) for p in dict.fromkeys(parts)] + [text.contains(c) for c in "ſ\u212aİı"]
    return reduce(lambda a, b: a | b, found)


def may_hold(text: Column, terms: Iterable[str]) -> Column:
    """The same for literals of any form: white space in them is a border, and one that isn't ASCII always may be there."""
    parts = [max(t.split() or [""], key=len).lower() for t in terms]
    return holds_any(text, parts) if all(p and p.isascii() for p in parts) else F.lit(True)


@dataclass(frozen=True)
class Options:
    """Typed settings; wrong types fail when they are read, not when they are used."""

    max_cpl: int = 42
    max_lines: int = 2
    max_cps: float = 17.0
    hard_cps: float = 26.0
    min_duration_ms: int = 700
    min_repeats: int = 3
    strip_boilerplate: bool = True
    allow_merge: bool = False
    drop_pure_sound: bool = True
    #: What stands in a target where the source couldn't be heard.
    inaudible: str = "[inaudible]"

    @classmethod
    def read(cls, section: object) -> Options:
        if section is None:
            return cls()
        if not isinstance(section, Mapping):
            raise ValueError(f"options must be a mapping, not {type(section).__name__}")
        kinds = {name: type(f.default) for name, f in cls.__dataclass_fields__.items()}
        got = {}
        for name, value in section.items():
            if name not in kinds:
                raise ValueError(f"unknown option {name}")
            kind = kinds[name]
            ok = isinstance(value, kind) if kind in (bool, str) else isinstance(value, (int, float) if kind is float else int) and not isinstance(value, bool)
            if not ok:
                raise ValueError(f"option {name} must be {kind.__name__}, not {value!r}")
            if kind is int and value < 1:
                raise ValueError(f"option {name} must be at least 1")
            if kind is float and not value > 0:
                raise ValueError(f"option {name} must be more than 0")
            got[name] = kind(value)
        return cls(**got)


@dataclass(frozen=True)
class Rewrite:
    """``word``: a literal between word borders, any case, keeping a capital; ``regex``: a case-sensitive template."""

    find: str
    replace: str
    kind: str = "word"

    def apply(self, text: Column) -> Column:
        if self.kind == "regex":
            return F.regexp_replace(text, self.find, re.sub(r"\\(\d)", r"$\1", self.replace))
        first, rest = _quoted(self.find[:1]), _quoted(self.find[1:])
        new = self.replace.replace("\\", r"\\").replace("$", r"\$")
        upper = rf"(?<!{WORD})(?=\p{{Lu}})(?iu:{first}{rest})(?!{WORD})"
        lower = rf"(?<!{WORD})(?!\p{{Lu}})(?iu:{first}{rest})(?!{WORD})"
        def both(t: Column) -> Column:
            return F.when(may_hold(t, [self.find]), F.regexp_replace(F.regexp_replace(t, upper, new[:1].upper() + new[1:]), lower, new)).otherwise(t)

        return once(text, both)

    def hits(self, text: Column) -> Column:
        pattern = self.find if self.kind == "regex" else bounded([self.find], literal=True)
        return F.regexp_count(text, F.lit(pattern)).cast("long")


def rewrites(section: Sequence[Mapping] | None) -> list[Rewrite]:
    """Rules with both find and replace, in order; ``type`` or ``match_type`` gives the kind."""
    out = []
    for r in section or ():
        if r.get("find") and r.get("replace") is not None:
            out.append(Rewrite(r["find"], r["replace"], r.get("type") or r.get("match_type") or "word"))
    return out


def rewritten(text: Column, rules: Sequence[Rewrite], drop: str = "<DROP>") -> Column:
    """All rules in order; an entry that is only the drop mark stays."""
    return F.when(F.btrim(text) == drop, text).otherwise(reduce(lambda x, r: r.apply(x), rules, text))


def rule_hits(text: Column, rules: Sequence[Rewrite]) -> list[Column]:
    """Hits of each rule on the text as the rules before it leave it."""
    out, at = [], text
    for r in rules:
        out.append(r.hits(at))
        at = r.apply(at)
    return out


@dataclass(frozen=True)
class Sense:
    """When a term is meant well: by the word before it, the word after it, or a capital next to it."""

    before: tuple[str, ...] = ()
    after: tuple[str, ...] = ()
    capital: bool = False

    def condemns(self, x: Column) -> Column:
        """Whether nothing excuses an occurrence (hit, before, after, capital)."""
        return ~(x["before"].isin(*self.before) | x["after"].isin(*self.after) | (x["capital"] & F.lit(self.capital)))


# Senses that packs name.
SENSES: dict[str, Sense] = {
    "family": Sense(before=("mi", "tu", "su", "sus", "mis", "tus", "nuestro", "nuestra", "nuestros", "nuestras", "el", "la", "los", "las", "un", "una"), capital=True),
    "valer": Sense(before=("más", "te", "le", "les", "se", "nos", "me"), after=("la", "mucho", "poco", "nada", "más", "menos", "otra", "cada", "cualquier", "que", "pena")),
}


def occurrences(text: Column, term: str) -> Column:
    """Each place of a term (a regex, between word borders, any case): (hit, before, after, capital).

    ``before`` and ``after`` are the words next to it, in lower case and bare of
    signs at their ends; ``capital`` tells whether what follows starts with one.
    """
    pattern = bounded([term])

    def at(parts: Column) -> Column:
        def place(i: Column) -> Column:
            sizes = lambda xs, n: F.aggregate(F.slice(xs, F.lit(1), n), F.lit(0), lambda a, x: a + F.length(x))
            start, hit = sizes(parts["rest"], i + 1) + sizes(parts["hits"], i), F.get(parts["hits"], i)
            before = F.substring_index(F.regexp_replace(F.substring(text, F.lit(1), start), r"\s+\z", ""), " ", -1)
            after = F.regexp_replace(F.substring(text, start + F.length(hit) + 1, F.length(text)), r"\A\s+", "")
            bare = lambda w: F.btrim(F.lower(w), F.lit(",.¡!¿?"))
            return F.struct(hit.alias("hit"), bare(before).alias("before"), bare(F.substring_index(after, " ", 1)).alias("after"), after.rlike(r"\A\p{Lu}").alias("capital"))

        return F.transform(F.sequence(F.lit(0), F.size(parts["hits"]) - 1), place)

    parts = F.struct(F.split(text, pattern, -1).alias("rest"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(text.rlike(pattern), once(parts, at))


def is_plain(fragment: str) -> bool:
    """Whether a regex fragment stands for itself alone."""
    return re.escape(fragment).replace("\\ ", " ") == fragment


@dataclass(frozen=True)
class Pack:
    """A language's rules.  ``banned`` and ``caution`` are regex fragments between word borders, ``phrases`` are regexes,
    ``exempt`` pairs of a regex between word borders and the sense in which it is fine; the rest are literals."""

    banned: tuple[str, ...] = ()
    phrases: tuple[str, ...] = ()
    caution: tuple[str, ...] = ()
    leftover: tuple[str, ...] = ()
    loanwords: tuple[str, ...] = ()
    exempt: tuple[tuple[str, Sense], ...] = ()
    entities: tuple[tuple[str, str], ...] = ()

    def banned_hit(self, text: Column) -> Column:
        """The first banned term or phrase; null without."""
        parts = [bounded(self.banned).removeprefix("(?iu)")] if self.banned else []
        parts += [f"(?:{p})".replace(r"\w", WORD) for p in self.phrases]
        return F.nullif(F.btrim(F.regexp_extract(text, "(?iu)" + "|".join(parts), 0)), F.lit("")) if parts else F.lit(None).cast("string")

    def caution_hit(self, text: Column) -> Column:
        return once(text, lambda t: _hit(t, bounded(self.caution), self.caution if all(map(is_plain, self.caution)) else None))

    def leftover_hit(self, text: Column, allowed: Column | None = None) -> Column:
        """First source word left over, outside italics, loanwords and the cue's allowed phrases."""
        quoted = lambda p: F.concat(F.lit("(?iu)"), F.regexp_replace(p, r"([\\.\[\]{}()*+?^$|])", r"\\$1"))

        def hit(t: Column) -> Column:
            at = F.regexp_replace(t, r"(?is)<i>.*?</i>", " ")
            if self.loanwords:
                at = F.regexp_replace(at, bounded(self.loanwords, literal=True), " ")
            if allowed is not None:
                at = F.aggregate(F.coalesce(allowed, F.array().cast("array<string>")), at, lambda a, p: F.regexp_replace(a, quoted(p), F.lit(" ")))
            return F.when(may_hold(t, self.leftover), once(at, lambda x: _hit(x, bounded(self.leftover, literal=True))))

        return once(text, hit)

    def exempt_violation(self, text: Column) -> Column:
        """The first occurrence of the first term that no context excuses; null without."""
        def first(t: Column) -> Column:
            each = []
            for term, sense in self.exempt:
                wrong = F.get(F.filter(occurrences(t, term), sense.condemns), F.lit(0))["hit"]
                each.append(F.when(may_hold(t, [term]), wrong) if is_plain(term) else wrong)
            return F.coalesce(*each, F.lit(None).cast("string"))

        return once(text, first)

    def exempt_violations(self, text: Column) -> Column:
        """For each term, in order, its first occurrence that no context excuses."""
        return F.filter(F.array(*(Pack(exempt=(e,)).exempt_violation(text) for e in self.exempt)), lambda x: x.isNotNull())


def _hit(text: Column, pattern: str, literals: Iterable[str] | None = None) -> Column:
    got = F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))
    return F.when(may_hold(text, literals), got) if literals is not None else got


def contains_term(text: Column, term: str) -> Column:
    """Whether a literal stands in the text between word borders, white space alike."""
    pattern = bounded([" ".join(term.split())], literal=True)
    return once(text, lambda t: may_hold(t, [term]) & F.regexp_replace(t, r"\s+", " ").rlike(pattern))


# A credit names someone or a site.
_CREDIT = (r"(?-i:(?:[A-Z0-9À-Ü][\w.\-']*|\S*\.(?:org|com|net|tv)\S*)"
           r"(?:\s+(?:[A-Z0-9À-Ü][\w.\-']*|and|&|de|van|der|la|el)){0,4})")

# Shapes of lines that decoders and uploaders add; each must be the whole cue.
BOILERPLATE = (
    r"thanks?(?:\s+you)?(?:\s+(?:so|very)\s+much)?\s+for\s+watching(?:\s+(?:this|the|my|our)(?:\s+\w+)?\s*(?:video|episode|channel))?",
    r"thanks?(?:\s+you)?\s+for\s+(?:watching|listening)[,\s]+(?:and\s+)?(?:i'?ll\s+)?see\s+you\s+(?:all\s+|guys\s+)?(?:in\s+the\s+next\s+(?:one|video|episode)|next\s+(?:video|episode))",
    r"(?:and\s+)?(?:i'?ll\s+)?see\s+you\s+(?:all\s+|guys\s+)?(?:in\s+the\s+next\s+(?:one|video|episode)|next\s+(?:video|episode))",
    r"(?:please\s+subscribe\s+to\s+(?:my|our|the)\s+channel|(?:don'?t\s+forget\s+to\s+)?subscribe\s+to\s+(?:my|our|the)\s+channel"
    r"|don'?t\s+forget\s+to\s+(?:like\s+and\s+)?subscribe|like[,\s]+(?:comment[,\s]+)?(?:and\s+)?subscribe)",
    r"(?:sub(?:titles?|titling)|captions?|transcription|translation)\s*(?::|\bby\b|\bfrom\b)\s*" + _CREDIT,
    r"(?:(?:sub(?:titles?|titling)|captions?)\b.{0,40}\bamara\.org\b.{0,30}|(?:https?://)?(?:www\.)?amara\.org\S*)",
    r"(?:(?:please\s+)?(?:visit|see|go\s+to|check\s+out)\s+)?(?:https?://)?www\.\S+",
    r"(?:©|\(c\)|copyright)\s*(?:©\s*)?\d{4}(?:\s*[-–]\s*\d{4})?(?:\s+" + _CREDIT + r")?(?:[.,]?\s*all\s+rights\s+reserved)?",
    r"(?:(?:©|\(c\)|copyright)\s*(?:\d{4})?\s*.{0,30}?[.,]?\s*)?all\s+rights\s+reserved",
)


#: What a line must hold for the built-in pattern of the same place to match.
STEMS = (("watching",), ("watching", "listening"), ("see",), ("subscribe",), ("sub", "caption", "transcription", "translation"), ("amara",), ("www.",), ("©", "(c)", "copyright"), ("rights",))


def boilerplate_stems(pattern: str) -> tuple[str, ...] | None:
    return STEMS[BOILERPLATE.index(pattern)] if pattern in BOILERPLATE else None


def boilerplate_patterns(extra: object = None, replace: bool = False) -> list[str]:
    """Built-in patterns with a project's own, or only those; each must compile and be text."""
    if extra is None:
        own: list[str] = []
    elif isinstance(extra, (list, tuple)) and all(isinstance(x, str) and x.strip() for x in extra):
        own = list(extra)
    else:
        raise ValueError("extra patterns must be a list of non-empty strings")
    for i, p in enumerate(own):
        try:
            re.compile(p)
        except re.error as e:
            raise ValueError(f"extra pattern {i} ({p!r}): {e}") from e
    return own if replace else [*BOILERPLATE, *own]
