"""Text of cues: normal forms, readability, layout, markup, classes.  Columns in, columns out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = r"(?i)</?[ib]>"
# Fixed value: characters a line may be dressed in, as a set to strip.
EDGE = "\"'“”‘’()[]{}<>-–—.,!?;:…¡¿* \t"
# Words that alone make an annotation of sound.
SOUND_WORDS = (
    "music", "cheer", "cheering", "applause", "applauding", "laugh", "laughs", "laughing", "laughter", "buzzer", "buzzing", "grunt", "grunting", "groan", "groaning", "sigh", "sighs",
    "gasp", "gasps", "screaming", "scream", "yelling", "indistinct", "chatter", "sizzling", "clattering", "beep", "bleep", "whoosh")
# A speaker's label, and a closed bracket group.
_SPEAKER = r"^\s*([A-Z][A-Z'’.\-]{1,20}(?:\s[A-Z][A-Z'’.\-]{1,20})?):\s*"
#: A label anywhere in a file, at a line's start.
LABEL = r"(?m)^\s*[A-Z][A-Z'’.\- ]{1,20}:\s"
_CLOSED = r"[\[(][^\])]*[\])]"


def untagged(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "")


def plain(text: Column) -> Column:
    """One line, no tags, single spaces."""
    return F.btrim(F.regexp_replace(untagged(text), r"\s+", " "))


def norm_key(text: Column) -> Column:
    """Case- and punctuation-blind identity."""
    return F.btrim(F.regexp_replace(F.lower(untagged(text)), r"[^\p{L}\p{N}]+", " "))


def token_key(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}]+", "")


def n_spoken(text: Column) -> Column:
    """Characters read: tags and U+0020 don't count, line breaks do not either."""
    return F.length(F.regexp_replace(untagged(text), "[ \n]", "")).cast("long")


def cps(text: Column, duration_ms: Column, floor_ms: int = 1) -> Column:
    """Characters a second; ``floor_ms`` 1 for statistics, 100 for target checks."""
    return n_spoken(text) * 1000.0 / F.greatest(duration_ms, F.lit(floor_ms))


def lines(text: Column) -> Column:
    return F.split(untagged(text), "\n")


def said_lines(text: Column) -> Column:
    """Lines that are not blank, without tags."""
    return F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\S")), untagged)


def widest(text: Column) -> Column:
    return F.array_max(F.transform(lines(text), F.length)).cast("long")


def is_punctuation(text: Column) -> Column:
    return text.rlike(r"^[^\p{L}\p{N}]+$")


def is_all_caps(text: Column) -> Column:
    """At least twelve letters, all of them upper case; letters without case are not."""
    letters = F.regexp_replace(untagged(text), r"\P{L}", "")
    return (F.length(letters) >= 12) & letters.rlike(r"^\p{Lu}+$")


def content_hash(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 12)


def head(lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, lo.cast("string")).otherwise(F.concat(lo.cast("string"), F.lit(".."), hi.cast("string")))


def tag_counts(text: Column, tag: str) -> tuple[Column, Column]:
    return F.regexp_count(text, F.lit(rf"(?i)<{tag}>")).cast("long"), F.regexp_count(text, F.lit(rf"(?i)</{tag}>")).cast("long")


def tag_multiset(text: Column) -> Column:
    """Names of all i and b tags, opening and closing alike, sorted."""
    return F.array_sort(F.transform(F.regexp_extract_all(text, F.lit(r"</?([ibIB])>"), F.lit(1)), F.lower))


def wrap(text: Column, width: int = 42) -> Column:
    """At most two balanced lines.

    Among splits whose halves both fit, else among all, the one with the
    smallest difference, the first on ties.  Dialogue (lines that start with
    "- ") and single words stay as they are.
    """
    dialogue = text.rlike(r"(?m)^\s*- ")
    flat = F.btrim(F.regexp_replace(text, r"\s+", " "))
    return F.when(dialogue, text).otherwise(once(flat, lambda f: F.when((F.length(f) <= width) | ~F.contains(f, F.lit(" ")), f).otherwise(_two_lines(f))))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _two_lines(flat: Column) -> Column:
    """A split at space p differs by |2p - 1 - n|: only the spaces on both sides of the middle can be best, and if any
    split fits, the best one does."""
    n = F.length(flat)
    middle = F.floor((n + 1) / 2).cast("int")
    back = F.position(F.lit(" "), F.reverse(F.substring(flat, F.lit(1), middle)))
    spots = F.struct(F.when(back > 0, middle - back + 1).alias("before"), F.position(F.lit(" "), flat, middle + 1).alias("after"))

    def cut(s: Column) -> Column:
        first = s["before"].isNotNull() & ((s["after"] == 0) | (n + 1 - 2 * s["before"] <= 2 * s["after"] - 1 - n))
        return once(F.when(first, s["before"]).otherwise(s["after"]), lambda p: F.concat(F.substring(flat, F.lit(1), p - 1), F.lit("\n"), F.substring(flat, p + 1, n)))

    return once(spots, cut)


def speaker(text: Column) -> Column:
    """Label of the first line that has one; null without."""
    found = F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_extract(x, _SPEAKER, 1)), lambda x: x != "")
    return F.get(found, F.lit(0))


def is_sound(text: Column, sound_words: Sequence[str] = SOUND_WORDS) -> Column:
    """Only annotations of sound: closed brackets, or an open one at the end that holds sound words alone."""
    body = F.filter(F.split(text, "\n"), lambda x: F.btrim(x) != "")
    joined = F.array_join(F.transform(body, lambda x: F.btrim(F.regexp_replace(x, _SPEAKER, ""))), " ")
    joined = F.regexp_replace(joined, r"^[-\s]+", "")

    def bare(x: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(x, _CLOSED, ""), r"[-\s.,!?]+", "")

    tail = F.regexp_extract(joined, r"[\[(]([^\])]*)$", 1)
    before = F.regexp_replace(joined, r"[\[(][^\])]*$", "")
    words = F.regexp_extract_all(F.lower(tail), F.lit("([a-záéíóúñ]+)"), F.lit(1))
    known = F.array(*map(F.lit, sound_words))
    unclosed = (F.size(words) > 0) & (bare(before) == "") & F.forall(words, lambda w: F.array_contains(known, w))
    return (F.size(body) > 0) & ((bare(joined) == "") | unclosed)


INAUDIBLE = r"(?i)\[(?:inaudible|indistinct)\]"


def is_inaudible(text: Column) -> Column:
    return text.rlike(INAUDIBLE)


def is_bleep(text: Column) -> Column:
    return text.rlike(r"(?i)[\[(](?:bleep|bleeped|censored)[\])]")


def n_numbers(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\d+")).cast("long")


# What UTF-8 read as a code page leaves behind, and line breaks written out.
MOJIBAKE = "[ÃÂ][\u0080-\u00bf\u2018-\u2030€]"
ESCAPES = r"\\n|`n|`r"


def has_mojibake(text: Column) -> Column:
    return text.rlike(MOJIBAKE)


def has_literal_escape(text: Column) -> Column:
    return text.rlike(ESCAPES)


def has_bom(text: Column) -> Column:
    return text.startswith("\ufeff")


def budget(start_ms: Column, end_ms: Column, max_cps: float) -> Column:
    """Characters a cue may hold at the target speed."""
    return F.floor((end_ms - start_ms) * max_cps / 1000).cast("long")
