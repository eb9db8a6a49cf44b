"""Timestamp text as milliseconds and back; columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = r"(\d{1,3}):(\d{2}):(\d{2})[,.](\d{1,3})"


def ts_millis(ts: Column, group: int = 0) -> Column:
    """Milliseconds of the first (or, with ``group`` 1, the second) timestamp in a line; null without one.

    The fraction is left-aligned: ``,5`` is half a second.
    """
    pattern = STAMP if group == 0 else rf"{STAMP}.*?{STAMP}"
    off = 4 * group
    part = [F.regexp_extract(ts, pattern, off + i) for i in (1, 2, 3, 4)]
    h, m, s, frac = (p.try_cast("long") for p in (*part[:3], F.rpad(part[3], 3, "0")))
    return F.when(part[3] != "", ((h * 60 + m) * 60 + s) * 1000 + frac)


def span_bounds(ts: Column) -> tuple[Column, Column]:
    """(start, end) in milliseconds of a timestamp line; trailing coordinates don't matter, null means unreadable."""
    end = ts_millis(ts, 1)
    return F.when(end.isNotNull(), ts_millis(ts, 0)), end


def format_millis(ms: Column) -> Column:
    """``HH:MM:SS,mmm``, never negative; carries run over all fields."""
    t = F.greatest(ms.cast("long"), F.lit(0).cast("long"))

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    hours = F.floor(t / 3600000).cast("long")
    hour = F.when(hours > 99, hours.cast("string")).otherwise(two(hours))
    return F.concat(hour, F.lit(":"), two(F.floor(t / 60000) % 60), F.lit(":"), two(F.floor(t / 1000) % 60), F.lit(","), F.lpad((t % 1000).cast("string"), 3, "0"))


def format_span(start_ms: Column, end_ms: Column) -> Column:
    return F.when(start_ms.isNotNull() & end_ms.isNotNull(), F.concat(format_millis(start_ms), F.lit(" --> "), format_millis(end_ms)))


def millis(seconds: Column) -> Column:
    """Seconds as whole milliseconds, halves to even."""
    return F.rint(seconds * 1000).cast("long")


def merged_span(first: Column, last: Column) -> Column:
    """Left half of one timestamp line with the right half of another, verbatim."""
    return F.concat(F.get(F.split(first, r"\s*-->\s*"), F.lit(0)), F.lit(" --> "), F.get(F.split(last, r"\s*-->\s*"), F.lit(1)))
