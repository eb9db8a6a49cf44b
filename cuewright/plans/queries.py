"""Every operator as a query on the star-schema tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import timing
from ..functions.rules import Options, Pack, Rewrite, Sense, rewritten
from ..operators import batches, cues, tracks, validate, words
from ..sources import views
from . import views_sql as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Rules that the invented prose of the test tables can meet.
PACK = Pack(banned=("thatand", r"\p{L}+heit", "blehe"), phrases=(r"of\s+the",), caution=("nicht", "pour"), leftover=("the", "this", "here", "right"), loanwords=("right",),
            exempt=(("with(?:out)?", Sense(before=("and",), after=("the",), capital=True)), ("las?", Sense(before=("de", "a")))), entities=(("the", "der"),))
FIXES = (Rewrite("the", "das"), Rewrite("and", "und"), Rewrite(r"([a-z])ing\b", r"\1ung", "regex"))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


# ---- statistics and findings of one track -----------------------------------------------------------------------

_PREV = r""", v0 AS (
  SELECT *, trim(regexp_replace(regexp_replace(text, '(?i)</?[ib]>', '', 'g'), '\s+', ' ', 'g')) = '' AS empty,
    list_transform(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')), lambda x: regexp_replace(x, '(?i)</?[ib]>', '', 'g')) AS ls
  FROM cues WHERE end_ms > start_ms),
v1 AS (
  SELECT *, lag(end_ms) OVER w AS prev_end, lag(start_ms) OVER w AS prev_start,
    last_value(CASE WHEN NOT empty THEN text END IGNORE NULLS) OVER (PARTITION BY title ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_text
  FROM v0 WINDOW w AS (PARTITION BY title ORDER BY pos)),
v AS (SELECT *, list_max(list_transform(ls, lambda x: length(x))) AS wide, count(*) FILTER (start_ms - prev_end > 120000) OVER (PARTITION BY title ORDER BY pos) AS silences FROM v1)"""


def _ranked(rows: str, value: str, percent: int) -> str:
    return f"CAST(list_sort(list({value}))[CAST(round_even({percent} * (count(*) - 1) / 100.0, 0) AS INTEGER) + 1] AS BIGINT)"


@query(f"""WITH {V.CUES}{_PREV}, q AS (
  SELECT title, pos, end_ms - start_ms AS dur, CASE WHEN NOT empty THEN {V.spoken('text')} * 1000000 // (end_ms - start_ms) END AS speed, {V.spoken('text')} * 1000.0 / (end_ms - start_ms) AS cps, empty, ls,
    start_ms < prev_end AS late FROM v),
k AS (SELECT title, CAST(max(speed) AS BIGINT) AS cps_max, count(*) FILTER (NOT empty AND cps > 17 AND cps <= 26) AS over_target, count(*) FILTER (NOT empty AND cps > 26) AS over_hard,
  count(*) FILTER (NOT empty AND len(ls) > 2) AS many_lines, count(*) FILTER (dur < 700) AS short, count(*) FILTER (late) AS "overlaps", CAST(min(dur) AS BIGINT) AS shortest_ms, {_ranked('q', 'dur', 50)} AS dur_p50
  FROM q GROUP BY title),
p AS (SELECT title, {_ranked('q', 'speed', 50)} AS cps_p50, {_ranked('q', 'speed', 90)} AS cps_p90 FROM q WHERE NOT empty GROUP BY title),
w AS (SELECT title, length(unnest(ls)) AS wide FROM q WHERE NOT empty),
l AS (SELECT title, {_ranked('w', 'wide', 50)} AS cpl_p50, {_ranked('w', 'wide', 90)} AS cpl_p90, CAST(max(wide) AS BIGINT) AS cpl_max, count(*) FILTER (wide > 42) AS long_lines FROM w GROUP BY title),
a AS (SELECT title, count(*) AS n, arg_max(end_ms, pos) AS runtime_ms FROM cues GROUP BY title)
SELECT a.title, a.n, a.runtime_ms, cps_p50, cps_p90, cps_max, cpl_p50, cpl_p90, cpl_max, dur_p50, shortest_ms, coalesce(over_target, 0) AS over_target, coalesce(over_hard, 0) AS over_hard,
  coalesce(long_lines, 0) AS long_lines, coalesce(many_lines, 0) AS many_lines, coalesce(short, 0) AS short, coalesce("overlaps", 0) AS "overlaps", CAST(0 AS BIGINT) AS boilerplate, CAST(0 AS BIGINT) AS removable
FROM a LEFT JOIN k USING (title) LEFT JOIN p USING (title) LEFT JOIN l USING (title)""")
def qa_summary(spark, d):
    return cues.qa_summary(views.cues(spark, d))


@query(f"""WITH {V.CUES}, a AS (SELECT title, num, row_number() OVER (PARTITION BY title ORDER BY pos) AS place FROM cues)
SELECT title, CAST(min(place) AS INTEGER) AS place, CAST(min_by(num, place) AS INTEGER) AS num FROM a WHERE num <> place GROUP BY title""")
def qa_numbering(spark, d):
    return cues.first_misnumbered(views.cues(spark, d))


def _finding(rule: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return cues.qa_findings(views.cues(spark, d)).where(F.col("rule") == rule).select("title", "num", "detail")
    return run


def _add_finding(name: str, rule: str, when: str, detail: str = "''") -> None:
    QUERIES[name] = _finding(rule)
    SQL[name] = f"WITH {V.CUES}{_PREV} SELECT title, num, CAST({detail} AS VARCHAR) AS detail FROM v WHERE {when}"


_add_finding("qa_overlap", "overlap", "start_ms < prev_end", "prev_end - start_ms")
_add_finding("qa_nonmono", "non-monotonic", "start_ms < prev_start")
_add_finding("qa_short", "short", "end_ms - start_ms < 700", "end_ms - start_ms")
_add_finding("qa_cps", "cps-hard", f"NOT empty AND {V.spoken('text')} * 1000.0 / greatest(end_ms - start_ms, 1) > 26")
_add_finding("qa_cps_target", "cps-target", f"NOT empty AND {V.spoken('text')} * 1000.0 / greatest(end_ms - start_ms, 1) > 17 AND {V.spoken('text')} * 1000.0 / greatest(end_ms - start_ms, 1) <= 26")
_add_finding("qa_cpl", "long-line", "NOT empty AND wide > 42", "wide")
_add_finding("qa_lines", "lines", "NOT empty AND len(ls) > 2", "len(ls)")
_add_finding("qa_silence", "gap", "start_ms - prev_end > 120000 AND silences <= 5", "start_ms - prev_end")


@query(f"""WITH {V.CUES}{_PREV}, g AS (SELECT title, pos, start_ms - prev_end AS gap_ms FROM v WHERE start_ms - prev_end > 120000)
SELECT * FROM (SELECT title, pos, gap_ms, CAST(row_number() OVER (PARTITION BY title ORDER BY pos) AS INTEGER) AS rank FROM g) WHERE rank <= 5""")
def qa_gaps(spark, d):
    return cues.long_gaps(views.cues(spark, d))


@query(f"""WITH {V.LINES}, k AS (SELECT title, pos, {V.norm('text')} AS key FROM lines)
SELECT title, pos, key FROM (SELECT *, lag(key) OVER (PARTITION BY title ORDER BY pos) AS before FROM k) WHERE key <> '' AND key = before""")
def qa_dup_adjacent(spark, d):
    x = views.lines(spark, d).withColumns({"start_ms": F.col("pos").cast("long") * 2000, "end_ms": F.col("pos").cast("long") * 2000 + 1000})
    again = cues.qa_findings(x).where("rule = 'dup-adjacent'").select("title", F.col("num").alias("pos"))
    return x.join(again, ["title", "pos"]).select("title", "pos", X.norm_key(F.col("text")).alias("key"))


@query(rf"""WITH {V.LINES} SELECT title, pos FROM lines
WHERE length(regexp_replace(text, '\P{{L}}', '', 'g')) >= 12 AND regexp_matches(regexp_replace(text, '\P{{L}}', '', 'g'), '^\p{{Lu}}+$')""")
def qa_allcaps(spark, d):
    return views.lines(spark, d).where(X.is_all_caps(F.col("text"))).select("title", "pos")


@query(f"""WITH {V.CUES}{_PREV}, q AS (SELECT title, {V.spoken('text')} AS n FROM v)
SELECT title, {', '.join(f"CAST(list_sort(list(n))[CAST(round_even({p} * (count(*) - 1) / 100.0, 0) AS INTEGER) + 1] AS BIGINT) AS p{p}" for p in (25, 50, 75, 95))} FROM q GROUP BY title""")
def qa_percentiles(spark, d):
    rows = views.cues(spark, d).where("end_ms > start_ms").select("title", X.n_spoken(F.col("text")).alias("n"))
    return cues.nearest_ranks(rows, "n", (25, 50, 75, 95))


def _each(rows: str, *rules: tuple[str, str, str, str]) -> str:
    """Findings (title, num, severity, rule, detail) of rules (severity, rule, condition, detail) on rows."""
    return " UNION ALL ".join(f"SELECT title, CAST(num AS INTEGER) AS num, '{s}' AS severity, '{r}' AS rule, CAST({detail} AS VARCHAR) AS detail FROM {rows} WHERE {when}" for s, r, when, detail in rules)


_BARE = "regexp_replace(text, '(?i)</?[ib]>', '', 'g')"
_UNBALANCED = " OR ".join(f"len(regexp_extract_all(text, '(?i)<{t}>')) <> len(regexp_extract_all(text, '(?i)</{t}>'))" for t in "ib")
_MOJIBAKE = r"regexp_matches(text, '[ÃÂ][\x{80}-\x{bf}\x{2018}-\x{2030}€]')"
_ESCAPED = r"regexp_matches(text, '\\n|`n|`r')"
_N_LINES = r"len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')))"
_SPEED = f"{V.spoken('text')} * 1000.0 / greatest(end_ms - start_ms, {{0}})"
_PLACED = f"""SELECT title, CAST(min_by(num, place) AS INTEGER) AS num, 'HARD' AS severity, 'numbering' AS rule, CAST(min(place) AS VARCHAR) AS detail
  FROM (SELECT title, num, row_number() OVER (PARTITION BY title ORDER BY pos) AS place FROM cues) WHERE num <> place GROUP BY title"""


_QA_SQL = _each(
    "v", ("HARD", "non-monotonic", "start_ms < prev_start", "''"), ("HARD", "empty", "empty", "''"), ("HARD", "unbalanced", f"NOT empty AND ({_UNBALANCED})", "''"), ("HARD", "mojibake", _MOJIBAKE, "''"),
    ("HARD", "literal-escape", _ESCAPED, "''"), ("SOFT", "overlap", "start_ms < prev_end", "prev_end - start_ms"), ("SOFT", "short", "end_ms - start_ms < 700", "end_ms - start_ms"),
    ("SOFT", "punct-only", rf"NOT empty AND regexp_matches({_BARE}, '^[^\p{{L}}\p{{N}}]+$')", "''"), ("SOFT", "lines", "NOT empty AND len(ls) > 2", "len(ls)"), ("SOFT", "long-line", "NOT empty AND wide > 42", "wide"),
    ("SOFT", "cps-hard", f"NOT empty AND {_SPEED.format(1)} > 26", "''"), ("SOFT", "cps-target", f"NOT empty AND {_SPEED.format(1)} > 17 AND {_SPEED.format(1)} <= 26", "''"),
    ("SOFT", "dup-adjacent", f"{V.norm('text')} <> '' AND {V.norm('text')} = {V.norm('prev_text')}", "''"),
    ("SOFT", "all-caps", r"length(regexp_replace(text, '\P{L}', '', 'g')) >= 12 AND regexp_matches(regexp_replace(text, '\P{L}', '', 'g'), '^\p{Lu}+$')", "''"),
    ("SOFT", "gap", "start_ms - prev_end > 120000 AND silences <= 5", "start_ms - prev_end")) + " UNION ALL " + _each("cues", ("HARD", "inverted", "end_ms <= start_ms", "''")) + f" UNION ALL {_PLACED}"
#: Cues of which every sixth ends before it starts.
_TURNED = V.CUES.replace("\ncues AS (", "\nstraight AS (") + """,
cues AS (SELECT title, pos, num, speaker, text, CASE WHEN pos % 6 = 2 THEN end_ms ELSE start_ms END AS start_ms, CASE WHEN pos % 6 = 2 THEN start_ms ELSE end_ms END AS end_ms, ts FROM straight)"""


@query(f"WITH {_TURNED}{_PREV} {_QA_SQL}")
def qa_inverted(spark, d):
    """All findings of tracks with cues that end before they start: these are said, and take no part in anything else."""
    turned = F.col("pos") % 6 == 2
    c = views.cues(spark, d).withColumns({"start_ms": F.when(turned, F.col("end_ms")).otherwise(F.col("start_ms")), "end_ms": F.when(turned, F.col("start_ms")).otherwise(F.col("end_ms"))})
    return cues.qa_findings(c)


@query(f"WITH {V.CUES}{_PREV} {_QA_SQL}")
def qa_findings(spark, d):
    return cues.qa_findings(views.cues(spark, d))


@query(f"""WITH {V.CUES}{_PREV}
SELECT title, CAST(count(*) FILTER (start_ms < prev_start) + max(CASE WHEN title % 7 = 0 AND total > 2 THEN 1 ELSE 0 END)
  + count(*) FILTER (trim(text) = '') AS BIGINT) AS hard
FROM (SELECT *, count(*) OVER (PARTITION BY title) AS total FROM v) GROUP BY title HAVING hard > 0""")
def qa_hard_totals(spark, d):
    return cues.totals(cues.qa_findings(views.cues(spark, d))).where("hard > 0").select("title", "hard")


# ---- time and text ----------------------------------------------------------------------------------------------


@query(f"WITH {V.CUES} SELECT title, pos, start_ms AS a, end_ms AS b FROM cues WHERE start_ms >= 0")
def span_bounds(spark, d):
    a, b = timing.span_bounds(F.concat("ts", F.lit("  X1:10 X2:20")))
    return views.cues(spark, d).where("start_ms >= 0").select("title", "pos", a.alias("a"), b.alias("b"))


@query("SELECT event_id AS id, CAST(event_id % 100 * 3600000 + event_id % 60 * 60000 + event_id % 59 * 1000 + rpad(CAST(event_id % 7 AS VARCHAR), 3, '0')::INTEGER AS BIGINT) AS ms FROM events")
def parse_ts(spark, d):
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    e = F.col("event_id")
    line = F.concat(two(e % 100), F.lit(":"), two(e % 60), F.lit(":"), two(e % 59), F.lit(","), e % 7)
    return views.read(spark, d, "events").select(e.alias("id"), timing.ts_millis(line).alias("ms"))


@query(f"SELECT event_id AS id, {V.stamp('CAST(event_id * 7919 - 50000 AS BIGINT)')} AS ts FROM events")
def format_ts(spark, d):
    return views.read(spark, d, "events").select(F.col("event_id").alias("id"), timing.format_millis(F.col("event_id") * 7919 - 50000).alias("ts"))


@query("SELECT event_id AS id, CAST(round_even(value * 1000, 0) AS BIGINT) AS ms FROM events")
def to_millis(spark, d):
    return views.read(spark, d, "events").select(F.col("event_id").alias("id"), timing.millis(F.col("value")).alias("ms"))


@query(f"WITH {V.LINES} SELECT title, pos, {V.norm('text')} AS key, substr(sha1(text), 1, 12) AS hash FROM lines")
def norm_key(spark, d):
    return views.lines(spark, d).select("title", "pos", X.norm_key(F.col("text")).alias("key"), X.content_hash(F.col("text")).alias("hash"))


@query(rf"""WITH {V.LINES}, f AS (SELECT title, pos, text, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat FROM lines),
w AS (SELECT *, string_split(flat, ' ') AS ws FROM f), s AS (
  SELECT title, pos, i, array_to_string(ws[1:i], ' ') AS a, array_to_string(ws[i + 1:], ' ') AS b FROM (SELECT *, unnest(range(1, greatest(2, len(ws)))) AS i FROM w) WHERE len(ws) > 1),
r AS (SELECT title, pos, a || chr(10) || b AS two, row_number() OVER (PARTITION BY title, pos ORDER BY CASE WHEN length(a) <= 42 AND length(b) <= 42 THEN 0 ELSE 1 END, abs(length(a) - length(b)), i) AS k FROM s)
SELECT w.title, w.pos, CASE WHEN regexp_matches(text, '^\s*- ') THEN text WHEN length(flat) <= 42 OR len(ws) < 2 THEN flat ELSE two END AS wrapped
FROM w LEFT JOIN r ON w.title = r.title AND w.pos = r.pos AND k = 1""")
def wrap_two_lines(spark, d):
    return views.lines(spark, d).select("title", "pos", X.wrap(F.col("text")).alias("wrapped"))


@query(rf"""WITH {V.LINES}, t AS (SELECT title, pos, CASE pos % 6 WHEN 0 THEN '[music]' WHEN 1 THEN 'JOHN: ' || text WHEN 2 THEN text || ' [inaudible]' WHEN 3 THEN '(bleep)' WHEN 4 THEN '- [applause' ELSE text END AS text FROM lines)
SELECT title, pos, nullif(regexp_extract(text, '^\s*([A-Z][A-Z''’.\-]{{1,20}}(?:\s[A-Z][A-Z''’.\-]{{1,20}})?):\s*', 1), '') AS speaker,
  trim(text) <> '' AND (regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(text, '^\s*([A-Z][A-Z''’.\-]{{1,20}}(?:\s[A-Z][A-Z''’.\-]{{1,20}})?):\s*', '')), '^[-\s]+', ''), '[\[(][^\])]*[\])]', '', 'g'), '[-\s.,!?]+', '', 'g') = '' OR text = '- [applause') AS sound,
  regexp_matches(text, '(?i)\[(?:inaudible|indistinct)\]') AS inaudible, regexp_matches(text, '(?i)[\[(](?:bleep|bleeped|censored)[\])]') AS bleep FROM t""")
def classify(spark, d):
    k = F.col("pos") % 6
    t = F.when(k == 0, "[music]").when(k == 1, F.concat(F.lit("JOHN: "), "text")).when(k == 2, F.concat("text", F.lit(" [inaudible]"))).when(k == 3, "(bleep)").when(k == 4, "- [applause").otherwise(F.col("text"))
    return cues.classified(views.lines(spark, d).withColumn("text", t)).select("title", "pos", "speaker", "sound", "inaudible", "bleep")


@query(r"""SELECT page_id AS title, CAST(len(regexp_extract_all(html, '(?i)<i>')) AS BIGINT) AS i_open, CAST(len(regexp_extract_all(html, '(?i)</i>')) AS BIGINT) AS i_close,
CAST(len(regexp_extract_all(html, '(?i)<b>')) AS BIGINT) AS b_open, CAST(len(regexp_extract_all(html, '(?i)</b>')) AS BIGINT) AS b_close FROM pages""")
def tag_balance(spark, d):
    t = F.col("text")
    (a, b), (x, y) = X.tag_counts(t, "i"), X.tag_counts(t, "b")
    return views.pages(spark, d).select("title", a.alias("i_open"), b.alias("i_close"), x.alias("b_open"), y.alias("b_close"))


@query(r"SELECT page_id AS title, array_to_string(list_sort(list_transform(regexp_extract_all(html, '</?([ibIB])>', 1), lambda x: lower(x))), '') AS tags FROM pages")
def tag_multiset(spark, d):
    return views.pages(spark, d).select("title", F.array_join(X.tag_multiset(F.col("text")), "").alias("tags"))


@query(f"WITH {V.CUES} SELECT title, pos, CAST((end_ms - start_ms) * 17 // 1000 AS BIGINT) AS budget FROM cues")
def char_budget(spark, d):
    return views.cues(spark, d).select("title", "pos", X.budget(F.col("start_ms"), F.col("end_ms"), 17.0).alias("budget"))


@query(f"""WITH {V.LINES}, p AS (SELECT a.title, a.pos, len(regexp_extract_all(a.text, '\\d+')) AS x, len(regexp_extract_all(b.text, '\\d+')) AS y FROM lines a JOIN lines b ON a.title = b.title AND b.pos = a.pos + 1)
SELECT title, pos, CAST(x AS BIGINT) AS source, CAST(y AS BIGINT) AS target FROM p WHERE x > 0 AND abs(x - y) >= 2""")
def digit_drift(spark, d):
    a = views.lines(spark, d).select("title", "pos", X.n_numbers(F.col("text")).alias("source"))
    b = views.lines(spark, d).select("title", (F.col("pos") - 1).alias("pos"), X.n_numbers(F.col("text")).alias("target"))
    return a.join(b, ["title", "pos"]).where("source > 0 and abs(source - target) >= 2")


# ---- rules ------------------------------------------------------------------------------------------------------


def _flat(text: str = "text") -> str:
    return rf"trim(regexp_replace(regexp_replace({text}, '(?i)</?[ib]>', '', 'g'), '\s+', ' ', 'g'))"


#: Terms between borders, or phrases without: group 1 or group 2.
_BANNED = V.bounded(r"thatand|[\p{L}]+heit|blehe") + r"|(of\s+the)"


def _banned(text: str) -> str:
    return f"coalesce(nullif(regexp_extract({text}, '{_BANNED}', 1), ''), nullif(regexp_extract({text}, '{_BANNED}', 2), ''))"


@query(rf"""WITH {V.LINES}, h AS (SELECT title, pos, {_banned(_flat())} AS hit FROM lines) SELECT * FROM h WHERE hit IS NOT NULL""")
def banned_terms(spark, d):
    return views.lines(spark, d).select("title", "pos", PACK.banned_hit(X.plain(F.col("text"))).alias("hit")).where("hit is not null")


@query(rf"""WITH {V.LINES} SELECT title, pos, regexp_extract({_flat()}, '{V.bounded("nicht|pour")}', 1) AS hit FROM lines WHERE regexp_matches({_flat()}, '{V.bounded("nicht|pour")}')""")
def caution(spark, d):
    return views.lines(spark, d).select("title", "pos", PACK.caution_hit(X.plain(F.col("text"))).alias("hit")).where("hit is not null")


@query(rf"""WITH {V.LINES}, k AS (SELECT title, pos, regexp_replace(text, '(?is)<i>.*?</i>', ' ', 'g') AS t FROM lines)
SELECT title, pos, regexp_extract(t, '{V.bounded("the|this|here")}', 1) AS hit FROM k WHERE regexp_matches(t, '{V.bounded("the|this|here")}')""")
def leftover(spark, d):
    return views.lines(spark, d).select("title", "pos", PACK.leftover_hit(F.col("text")).alias("hit")).where("hit is not null")


@query(rf"""WITH {V.LINES}, f AS (SELECT title, pos, {_flat()} AS t FROM lines),
c AS (SELECT title, pos, t, unnest(range(1, length(t) + 1)) AS i FROM f WHERE regexp_matches(t, '(?i)with|la')),
m AS (SELECT *, regexp_extract(substr(t, i), '(?i)^(without|with|las|la)(?:$|[^\p{{L}}\p{{N}}_])', 1) AS hit FROM c WHERE lower(substr(t, i, 1)) IN ('w', 'l') AND (i = 1 OR NOT regexp_matches(substr(t, i - 1, 1), '[\p{{L}}\p{{N}}_]'))),
o AS (SELECT title, pos, i, hit, lower(hit[1]) AS k, trim(lower(string_split(rtrim(substr(t, 1, i - 1)), ' ')[-1]), ',.¡!¿?') AS before,
  trim(lower(string_split(ltrim(substr(t, i + length(hit))), ' ')[1]), ',.¡!¿?') AS after, regexp_matches(ltrim(substr(t, i + length(hit))), '^\p{{Lu}}') AS capital FROM m WHERE hit <> ''),
x AS (SELECT *, row_number() OVER (PARTITION BY title, pos, k ORDER BY i) AS nth FROM o
  WHERE CASE k WHEN 'w' THEN coalesce(before, '') <> 'and' AND coalesce(after, '') <> 'the' AND NOT capital ELSE coalesce(before, '') NOT IN ('de', 'a') END)
SELECT title, pos, hit FROM x WHERE nth = 1""")
def context_exempt(spark, d):
    """The first wrong occurrence of each term in a line."""
    hits = views.lines(spark, d).select("title", "pos", F.explode(PACK.exempt_violations(X.plain(F.col("text")))).alias("hit"))
    return hits.select("title", "pos", "hit")


@query(rf"""WITH {V.LINES}, f AS (SELECT title, pos, regexp_replace(text, '\s+', ' ', 'g') AS t FROM lines)
SELECT a.title, a.pos AS num FROM f a JOIN f b ON a.title = b.title AND b.pos = a.pos + 1 WHERE regexp_matches(a.t, '{V.bounded("the")}') AND NOT regexp_matches(b.t, '{V.bounded("of")}')""")
def entity_anchor(spark, d):
    """Each line built from the line before it; a name said there has to come again under its other form."""
    x = views.lines(spark, d)
    target = x.where("pos > 1").select("title", (F.col("pos") - 1).alias("num"), F.lit("").alias("ts"), "text")
    made = target.select("title", F.col("num").alias("out"), F.array("num").alias("src"), "ts", F.lit(False).alias("drop"))
    source = x.select("title", "num", "text", F.lit(False).alias("droppable"), F.lit(False).alias("inaudible"))
    return validate.manifest_findings(target, made, source, Pack(entities=(("the", "of"),))).where("rule = 'entity-missing'").select("title", "num")


@query(r"""WITH """ + V.LINES + r""", w AS (SELECT title, pos, i, ws[i] AS x FROM (SELECT title, pos, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT title, pos, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS ws FROM lines))),
r AS (SELECT title, pos, i, CASE x WHEN 'the' THEN 'das' WHEN 'The' THEN 'Das' WHEN 'THE' THEN 'Das' WHEN 'and' THEN 'und' WHEN 'And' THEN 'Und' WHEN 'AND' THEN 'Und' ELSE regexp_replace(x, '([a-z])ing$', '\1ung') END AS y FROM w),
g AS (SELECT title, pos, string_agg(y, '' ORDER BY i) AS fixed FROM r GROUP BY ALL)
SELECT l.title, l.pos, coalesce(g.fixed, '') AS fixed FROM lines l LEFT JOIN g USING (title, pos)""")
def autofix_apply(spark, d):
    return views.lines(spark, d).select("title", "pos", rewritten(F.col("text"), FIXES).alias("fixed"))


# ---- slices, batches, builds ------------------------------------------------------------------------------------

_SLICES = """, n AS (SELECT *, CAST((row_number() OVER (PARTITION BY title ORDER BY pos) - 1) // CAST(ceil(count(*) OVER (PARTITION BY title) / 4.0) AS BIGINT) + 1 AS INTEGER) AS part FROM {0})"""


@query(f"WITH {V.LINES}{_SLICES.format('lines')} SELECT title, part, min(num) AS lo, max(num) AS hi, count(*) AS n FROM n GROUP BY title, part")
def slice_contract(spark, d):
    return cues.slice_contract(views.lines(spark, d), 4)


@query(f"WITH {V.LINES}{_SLICES.format('lines')}, c AS (SELECT title, part, min(num) AS lo, max(num) AS hi FROM n WHERE part <> 2 GROUP BY ALL) SELECT title, num, CAST(0 AS BIGINT) AS times FROM lines l WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.title = l.title AND l.num BETWEEN lo AND hi)")
def slice_coverage(spark, d):
    x = views.lines(spark, d)
    return cues.slice_gaps(x, cues.slice_contract(x, 4).where("part <> 2")).select("title", "num", F.col("times").cast("long").alias("times"))


@query("""WITH c AS (SELECT l_orderkey AS title, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INTEGER) AS pos FROM lineitem),
n AS (SELECT title, pos, CAST((pos - 1) // CAST(ceil(count(*) OVER (PARTITION BY title) / 3.0) AS BIGINT) + 1 AS INTEGER) AS part FROM c)
SELECT title, part, min(pos) AS lo, max(pos) AS hi, count(*) AS n FROM n GROUP BY title, part""")
def slice_contract_large(spark, d):
    c = views.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("title"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("pos"))
    # parts of a number that is given are not joined again, so a task's rows don't grow with its share of the cores
    c = c.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "title").withColumn("num", F.row_number().over(cues.by_title()))
    return cues.slice_contract(c, 3)


@query(f"WITH {V.BATCHES} SELECT title, lo AS num, CASE WHEN count(DISTINCT file) > 1 THEN 'two-files' ELSE 'same-file' END AS kind, count(DISTINCT file) AS files FROM entries GROUP BY title, lo HAVING count(*) > 1")
def batch_overlap(spark, d):
    return batches.overlaps(views.batches(spark, d)).select("title", "num", "kind", "files")


@query(f"WITH {V.BATCHES} SELECT title, num, 'missing' AS kind FROM lines l WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e.title = l.title AND e.lo = l.num)")
def batch_coverage(spark, d):
    return batches.coverage(views.lines(spark, d), views.batches(spark, d)).select("title", "num", "kind")


@query(f"WITH {V.LINES} SELECT title, lang AS num, count(*) AS n FROM lines GROUP BY title, lang HAVING count(*) > 1")
def dup_guard(spark, d):
    return cues.duplicate_numbers(views.lines(spark, d).select("title", F.col("lang").alias("num")))


def _built(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Cues as source, with every fifth dropped and the third merged with the fourth; entries have the whole text with its lines."""
    src = views.cues(spark, d).withColumn("num", F.col("pos")).withColumn("droppable", F.col("pos") % 5 == 0).withColumn("drop_reason", F.when(F.col("droppable"), "allowed")).withColumn("inaudible", F.lit(False))
    n = F.count("*").over(Window.partitionBy("title"))
    e = src.withColumn("total", n).where("pos <> 4").select(
        "title", F.lit("w").alias("file"), F.col("pos").alias("first_line"), F.col("num").alias("lo"), F.when((F.col("pos") == 3) & (F.col("total") >= 4), 4).otherwise(F.col("num")).alias("hi"),
        F.when(F.col("pos") % 5 == 0, batches.DROP).otherwise(F.concat(F.lit("T "), F.col("text"))).alias("text"))
    return src, e


_BUILT = V.CUES + r""", s AS (SELECT title, pos, pos AS num, text, ts, count(*) OVER (PARTITION BY title) AS total FROM cues),
e0 AS (SELECT title, pos AS lo, CASE WHEN pos = 3 AND total >= 4 THEN 4 ELSE pos END AS hi, pos % 5 = 0 AS "drop", string_split(trim(regexp_replace('T ' || text, '\s+', ' ', 'g')), ' ') AS ws FROM s WHERE pos <> 4),
e1 AS (SELECT *, array_to_string(ws, ' ') AS flat, list_sort(list_transform(range(1, len(ws)), lambda i: {'over': CASE WHEN length(array_to_string(ws[1:i], ' ')) <= 42 AND length(array_to_string(ws[i + 1:], ' ')) <= 42 THEN 0 ELSE 1 END,
  'apart': abs(length(array_to_string(ws[1:i], ' ')) - length(array_to_string(ws[i + 1:], ' '))), 'i': i}))[1].i AS i FROM e0),
e AS (SELECT title, lo, hi, "drop", CASE WHEN length(flat) <= 42 OR len(ws) < 2 THEN flat ELSE array_to_string(ws[1:i], ' ') || chr(10) || array_to_string(ws[i + 1:], ' ') END AS body FROM e1),
j AS (SELECT e.*, a.ts AS ts_lo, b.ts AS ts_hi, replace(a.text, chr(10), ' ') || CASE WHEN e.hi > e.lo THEN ' ' || replace(b.text, chr(10), ' ') ELSE '' END AS said
  FROM e JOIN s a ON a.title = e.title AND a.num = e.lo JOIN s b ON b.title = e.title AND b.num = e.hi),
m AS (SELECT title, CASE WHEN NOT "drop" THEN CAST(sum(CASE WHEN "drop" THEN 0 ELSE 1 END) OVER (PARTITION BY title ORDER BY lo) AS INTEGER) END AS "out", lo, hi, "drop",
  CASE WHEN NOT "drop" THEN CASE WHEN lo = hi THEN ts_lo ELSE string_split(ts_lo, ' --> ')[1] || ' --> ' || string_split(ts_hi, ' --> ')[2] END END AS ts,
  CASE WHEN NOT "drop" THEN substr(sha1(said), 1, 12) END AS src_hash, CASE WHEN NOT "drop" THEN substr(sha1(body), 1, 12) END AS tgt_hash FROM j)
"""


@query(f"""WITH {_BUILT} SELECT title, coalesce("out", 0) AS "out", lo, hi, "drop", ts, src_hash, tgt_hash FROM m""")
def manifest_build(spark, d):
    src, e = _built(spark, d)
    m = batches.manifest(src, e, Options(allow_merge=True))
    return m.select("title", F.coalesce("out", F.lit(0)).alias("out"), F.array_min("src").alias("lo"), F.array_max("src").alias("hi"), "drop", "ts", "src_hash", "tgt_hash")


@query(f"""WITH {_BUILT}, t AS (SELECT title, "out" AS num, CASE WHEN "out" % 7 = 6 THEN 'x' ELSE ts END AS ts FROM m WHERE NOT "drop" AND "out" % 9 <> 8)
SELECT title, CAST("out" AS INTEGER) AS num, 'lost-cue' AS rule FROM m WHERE NOT "drop" AND "out" % 9 = 8
UNION ALL SELECT title, CAST(num AS INTEGER), 'ts-differs' FROM t WHERE ts = 'x'
UNION ALL SELECT title, CAST(pos AS INTEGER), 'unaccounted' FROM s WHERE pos % 2 = 1 AND pos % 10 = 7 AND title % 2 = 0
UNION ALL SELECT title, CAST(pos AS INTEGER), 'dropped-not-droppable' FROM s WHERE pos % 10 = 0""")
def manifest_cross(spark, d):
    src, e = _built(spark, d)
    m = batches.manifest(src, e, Options(allow_merge=True))
    target = batches.built(m).where("num % 9 <> 8").withColumn("ts", F.when(F.col("num") % 7 == 6, "x").otherwise(F.col("ts")))
    lost = m.where("not (src[0] % 10 = 7 and title % 2 = 0)")
    full = validate.manifest_findings(target, m, src.withColumn("droppable", F.col("pos") % 10 == 5)).where("rule in ('lost-cue', 'ts-differs', 'dropped-not-droppable')")
    part = validate.manifest_findings(target, lost, src).where("rule = 'unaccounted'")
    return full.unionByName(part).select("title", "num", "rule")


_TAGS = "list_sort(list_transform(regexp_extract_all({0}, '</?([ibIB])>', 1), lambda x: lower(x)))"
_FOUND = "SELECT title, CAST({0} AS INTEGER) AS num, '{1}' AS severity, '{2}' AS rule, {3} AS detail FROM {4}"


@query(rf"""WITH {_BUILT}, b AS (SELECT m.*, e.body FROM m JOIN e USING (title, lo)),
known AS (SELECT * FROM b WHERE NOT (lo % 10 = 7 AND title % 2 = 0) UNION ALL SELECT * FROM b WHERE "drop" AND lo % 10 = 5),
target AS (SELECT title, "out" AS num, CASE WHEN "out" % 7 = 6 THEN 'x' ELSE ts END AS ts, body AS text FROM b WHERE NOT "drop" AND "out" % 9 <> 8),
kept AS (SELECT * FROM known WHERE NOT "drop"),
n AS (SELECT title, "out", "drop", unnest(range(lo, hi + 1)) AS n FROM known),
seen AS (SELECT title, n, count(*) AS times, bool_or("drop") AS dropped FROM n GROUP BY title, n),
cover AS (SELECT s.title, s.num AS n, s.pos, times, dropped FROM s LEFT JOIN seen ON seen.title = s.title AND seen.n = s.num),
src AS (SELECT n.title, n."out" AS num, string_agg(s.text, chr(10) ORDER BY s.num) AS said, bool_or(s.pos % 6 = 0) AS inaudible FROM n JOIN s ON s.title = n.title AND s.num = n.n WHERE NOT n."drop" GROUP BY n.title, n."out"),
pairs AS (SELECT *, len(regexp_extract_all(said, '\d+')) AS a, len(regexp_extract_all(text, '\d+')) AS z FROM src JOIN target USING (title, num))
""" + " UNION ALL ".join((
    _FOUND.format('"out"', "HARD", "lost-cue", "''", 'kept WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.title = kept.title AND t.num = kept."out")'),
    _FOUND.format("num", "HARD", "manifest-count", "''", 'target WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.title = target.title AND k."out" = target.num)'),
    _FOUND.format("num", "HARD", "ts-differs", "want", '(SELECT target.title, num, kept.ts AS want, target.ts FROM target JOIN kept ON kept.title = target.title AND kept."out" = num) WHERE ts <> want'),
    _FOUND.format("n", "HARD", "covered-twice", "''", "cover WHERE times > 1"), _FOUND.format("n", "HARD", "unaccounted", "''", "cover WHERE times IS NULL"),
    _FOUND.format("n", "HARD", "dropped-not-droppable", "''", "cover WHERE dropped AND pos % 10 <> 5"), _FOUND.format("num", "HARD", "tag-set-differs", "''", f"pairs WHERE {_TAGS.format('said')} <> {_TAGS.format('text')}"),
    _FOUND.format("num", "SOFT", "digit-drift", "a || '/' || z", "pairs WHERE a > 0 AND abs(a - z) >= 2"), _FOUND.format("num", "SOFT", "inaudible-marker", "'[inaudible]'", "pairs WHERE inaudible AND NOT contains(text, '[inaudible]')"))))
def manifest_findings(spark, d):
    """All rules, on whole texts: lost and changed target cues, missing and repeated manifest rows, inaudible source cues."""
    src, e = _built(spark, d)
    m = batches.manifest(src, e, Options(allow_merge=True))
    target = batches.built(m).where("num % 9 <> 8").withColumn("ts", F.when(F.col("num") % 7 == 6, "x").otherwise(F.col("ts")))
    known = m.where("not (src[0] % 10 = 7 and title % 2 = 0)").unionByName(m.where("drop and src[0] % 10 = 5"))
    return validate.manifest_findings(target, known, src.withColumns({"droppable": F.col("pos") % 10 == 5, "inaudible": F.col("pos") % 6 == 0}))


@query(f"""WITH {V.CUES}, t AS (SELECT title, pos, num, CASE WHEN pos = 5 THEN 'x' ELSE ts END AS ts FROM cues WHERE pos % 3 <> 0)
SELECT title, CAST(min(num) AS INTEGER) AS num FROM t WHERE ts = 'x' GROUP BY title""")
def subsequence_unique(spark, d):
    c = views.cues(spark, d)
    t = c.where("pos % 3 <> 0").withColumn("ts", F.when(F.col("pos") == 5, "x").otherwise(F.col("ts")))
    return validate.ordered_timestamps(t, c).select("title", "num")


_LEFT = r"regexp_replace(text, '(?is)<i>.*?</i>', ' ', 'g')"


@query(f"WITH {V.CUES}, f AS (SELECT *, lag(end_ms) OVER (PARTITION BY title ORDER BY pos) AS prev_end FROM cues) " + _each(
    "f", ("HARD", "mojibake", _MOJIBAKE, "''"), ("HARD", "literal-escape", _ESCAPED, "''"), ("HARD", "unbalanced-tag", _UNBALANCED, "''"), ("SOFT", "overlap", "start_ms < prev_end - 50", "''"),
    ("SOFT", "short", "end_ms - start_ms < 700", "''"), ("SOFT", "lines", f"{_N_LINES} > 2", "''"), ("SOFT", "long-line", f"{V.widest('text')} > 45", "''"), ("SOFT", "cps-hard", f"{_SPEED.format(100)} > 26", "''"),
    ("SOFT", "cps-target", f"{_SPEED.format(100)} > 17 AND {_SPEED.format(100)} <= 26", "''"),
    *(("HARD" if rule != "caution" else "SOFT", rule, f"regexp_matches({t}, '{V.bounded(p)}')", f"regexp_extract({t}, '{V.bounded(p)}', 1)")
      for rule, t, p in (("leftover", _LEFT, "the|this|here"), ("caution", _flat(), "nicht|pour"))), ("HARD", "banned", f"{_banned(_flat())} IS NOT NULL", _banned(_flat()))) + f" UNION ALL {_PLACED}")
def target_findings(spark, d):
    """All rules but those of context, which have a query of their own."""
    return validate.target_findings(views.cues(spark, d), replace(PACK, exempt=()))


_WRONG = V.CUES + r""", s AS (SELECT title, pos, pos % 10 = 5 AS droppable, speaker, text, count(*) OVER (PARTITION BY title) AS total FROM cues),
e0 AS (SELECT title, 'w' AS file, pos AS lo, CASE WHEN pos = 3 AND total >= 4 THEN 4 ELSE pos END AS hi, CASE WHEN pos % 5 = 0 THEN '<DROP>' ELSE 'T ' || text END AS text FROM s WHERE pos <> 4),
t AS (SELECT DISTINCT title, total FROM s),
e AS (
  SELECT * FROM e0 WHERE lo % 11 <> 6 UNION ALL SELECT title, 'v', lo, hi, text FROM e0 WHERE lo % 7 = 1 UNION ALL SELECT title, 'r', 2, 1, 'x' FROM t WHERE title % 3 = 0 AND total >= 2
  UNION ALL SELECT title, 'u', total + 5, total + 5, ' ' FROM t WHERE title % 4 = 0 UNION ALL SELECT title, 'd', 1, total, '<DROP>' FROM t WHERE title % 5 = 0 UNION ALL SELECT title, 'z', 2, 2000000000, 'y' FROM t WHERE title % 6 = 1),
x AS (SELECT *, lo <= total AND hi <= total AS known, trim(text) AS body FROM e JOIN t USING (title)),
n AS (SELECT x.title, lo, hi, body, s.pos AS num, droppable, speaker FROM x JOIN s ON s.title = x.title AND s.pos BETWEEN lo AND hi),
b AS (SELECT title, lo AS a FROM e WHERE hi >= lo UNION SELECT title, hi + 1 FROM e WHERE hi >= lo)"""


@query(rf"""WITH {_WRONG}
SELECT title, CAST(lo AS INTEGER) AS num, 'merge-not-allowed' AS rule FROM x WHERE lo <> hi
UNION ALL SELECT title, CAST(lo AS INTEGER), 'unknown-cue' FROM x WHERE NOT known
UNION ALL SELECT title, CAST(lo AS INTEGER), 'reversed' FROM x WHERE hi < lo
UNION ALL SELECT title, CAST(lo AS INTEGER), 'drop-merged' FROM x WHERE lo <> hi AND body = '<DROP>'
UNION ALL SELECT title, CAST(lo AS INTEGER), 'empty' FROM x WHERE body = ''
UNION ALL SELECT title, CAST(lo AS INTEGER), 'blank-line' FROM x WHERE body <> '<DROP>' AND regexp_matches(trim(text, chr(10)), '\n[ \t]*\n')
UNION ALL SELECT title, CAST(lo AS INTEGER), 'too-many-lines' FROM x WHERE body <> '<DROP>' AND regexp_matches(text, '(?m)^\s*- ') AND len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) > 2
UNION ALL SELECT title, CAST(lo AS INTEGER), 'two-speakers' FROM n WHERE lo <> hi GROUP BY title, lo HAVING count(DISTINCT coalesce(speaker, '')) > 1
UNION ALL SELECT title, CAST(num AS INTEGER), 'drop-not-allowed' FROM n WHERE body = '<DROP>' AND NOT droppable
UNION ALL SELECT b.title, CAST(a AS INTEGER), 'covered-twice' FROM b JOIN e ON e.title = b.title AND a BETWEEN lo AND hi GROUP BY b.title, a HAVING count(*) > 1
UNION ALL SELECT title, CAST(pos AS INTEGER), 'unaccounted' FROM s WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.title = s.title AND s.pos BETWEEN lo AND hi)""")
def build_problems(spark, d):
    """Every rule of a build: entries twice, left out, reversed, unknown, dropped as a whole, and far too wide."""
    src, e = _built(spark, d)
    src = src.withColumn("droppable", F.col("pos") % 10 == 5)
    t = src.groupBy("title").agg(F.count("*").cast("int").alias("total"))
    e = e.select("title", "file", "lo", "hi", "text")
    more = lambda when, file, lo, hi, text: t.where(when).select("title", F.lit(file).alias("file"), F.expr(lo).cast("int").alias("lo"), F.expr(hi).cast("int").alias("hi"), F.lit(text).alias("text"))
    parts = [e.where("lo % 11 <> 6"), e.where("lo % 7 = 1").withColumn("file", F.lit("v")), more("title % 3 = 0 and total >= 2", "r", "2", "1", "x"), more("title % 4 = 0", "u", "total + 5", "total + 5", " "),
             more("title % 5 = 0", "d", "1", "total", batches.DROP), more("title % 6 = 1", "z", "2", "2000000000", "y")]
    return batches.build_problems(src, cues.union_all(parts))


@query(f"WITH {_BUILT} SELECT title, CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '..' || hi END AS head, CASE WHEN \"drop\" THEN '<DROP>' ELSE tgt_hash END AS mark FROM m")
def reconstruct(spark, d):
    src, e = _built(spark, d)
    m = batches.manifest(src, e, Options(allow_merge=True))
    entries, _ = batches.reconstructed(batches.built(m), m)
    return entries.select("title", "head", F.when(F.col("text") == batches.DROP, F.col("text")).otherwise(X.content_hash(F.col("text"))).alias("mark"))


@query(f"WITH {V.LINES} SELECT title, pos::VARCHAR AS head, CASE WHEN pos % 3 = 0 THEN 'patched ' || pos ELSE text END AS text FROM lines")
def patch_update(spark, d):
    x = views.lines(spark, d).select("title", F.col("pos").cast("string").alias("head"), "text", "pos")
    patch = x.where("pos % 3 = 0").select("title", "head", F.concat(F.lit("patched "), "head").alias("text"))
    return batches.patched(x.drop("pos"), patch)[0].select("title", "head", "text")


# ---- boilerplate, loops, timing ---------------------------------------------------------------------------------


@query(f"""WITH {V.LINES}, m AS (SELECT lang AS title, title * 100000 + pos AS pos, {V.norm('text')} AS key FROM lines WHERE {V.norm('text')} = 'all rights reserved')
SELECT title, pos, key, count(*) OVER (PARTITION BY title, key) AS times, count(*) OVER (PARTITION BY title, key) >= 3 AS removable FROM m""")
def boilerplate_recur(spark, d):
    x = views.lines(spark, d).select(F.col("lang").alias("title"), (F.col("title") * 100000 + F.col("pos")).alias("pos"), "text")
    return tracks.boilerplate(x).select("title", "pos", "key", "times", "removable")


@query(f"""WITH {V.LINES}, k AS (SELECT title, pos, {V.norm('text')} AS key FROM lines), c AS (SELECT *, CASE WHEN key = lag(key) OVER (PARTITION BY title ORDER BY pos) THEN 0 ELSE 1 END AS fresh FROM k),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY title ORDER BY pos) AS run FROM c), q AS (SELECT title, pos, run, CASE WHEN pos % 10 = 0 AND fresh = 0 THEN 1 ELSE fresh END AS cut FROM r),
z AS (SELECT *, sum(cut) OVER (PARTITION BY title ORDER BY pos) AS island FROM q)
SELECT title, min(pos) AS pos, CAST(max(pos) * 2000 + 1000 + max(CASE WHEN pos % 10 = 9 THEN 0 ELSE 0 END) AS BIGINT) AS end_ms, count(*) AS merged FROM z GROUP BY title, island""")
def loop_collapse(spark, d):
    x = views.lines(spark, d).withColumn("halluc", F.lit(False))
    start = F.col("pos") * 2000 + F.when(F.col("pos") % 10 == 0, 600).otherwise(0)
    # gaps of 1000 ms join, those before every tenth line, of 1600 ms, do not
    x = x.withColumns({"start_ms": start.cast("long"), "end_ms": (F.col("pos") * 2000 + 1000).cast("long")})
    return tracks.loops_collapsed(x).select("title", "pos", "end_ms", "merged")


@query(f"""WITH {V.CUES}, o AS (SELECT *, row_number() OVER w - 1 AS i, lead(start_ms) OVER w AS following FROM cues WINDOW w AS (PARTITION BY title ORDER BY start_ms, end_ms, pos)),
p AS (SELECT *, 90 * i + max(CASE WHEN i = 0 THEN greatest(start_ms, 40) ELSE start_ms END - 90 * i) OVER (PARTITION BY title ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM o),
r AS (SELECT *, greatest(coalesce(following, end_ms + 10000) - 40, s + 50) AS room FROM p),
e AS (SELECT *, greatest(least(end_ms, room), least(s + 700, room)) AS e FROM r)
SELECT title, pos, text, CAST(s AS BIGINT) AS start_ms, CAST(round_even(greatest(CAST(e AS DOUBLE), least(s + {V.spoken('text')} * 1000.0 / 17.0, CAST(room AS DOUBLE))), 0) AS BIGINT) AS end_ms FROM e""")
def polish_timing(spark, d):
    return tracks.retimed(views.cues(spark, d))


_POLISHED = rf"""WITH {V.CUES}, k AS (
  SELECT title, text, start_ms, end_ms, row_number() OVER (PARTITION BY title ORDER BY start_ms, end_ms, pos) AS pos, {V.norm('text')} AS key FROM cues
  WHERE regexp_matches(regexp_replace(text, '(?i)</?[ib]>', '', 'g'), '[\p{{L}}\p{{N}}]')),
c AS (SELECT *, CASE WHEN key = lag(key) OVER (PARTITION BY title ORDER BY pos) THEN 0 ELSE 1 END AS change FROM k),
d AS (SELECT *, sum(change) OVER (PARTITION BY title ORDER BY pos) AS same FROM c),
f AS (SELECT *, CASE WHEN start_ms - max(end_ms) OVER (PARTITION BY title, same ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 1500 THEN 0 ELSE 1 END AS far FROM d),
r AS (SELECT *, sum(far) OVER (PARTITION BY title ORDER BY pos) AS run FROM f),
g AS (SELECT title, min(pos) AS pos, arg_min(text, pos) AS text, arg_min(start_ms, pos) AS start_ms, max(end_ms) AS end_ms FROM r GROUP BY title, run),
w AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat FROM g),
h AS (SELECT title, pos, i, array_to_string(ws[1:i], ' ') AS a, array_to_string(ws[i + 1:], ' ') AS b FROM (SELECT title, pos, string_split(flat, ' ') AS ws, unnest(range(1, greatest(2, len(string_split(flat, ' '))))) AS i FROM w) WHERE len(ws) > 1),
two AS (SELECT title, pos, a || chr(10) || b AS halves, row_number() OVER (PARTITION BY title, pos ORDER BY CASE WHEN length(a) <= 42 AND length(b) <= 42 THEN 0 ELSE 1 END, abs(length(a) - length(b)), i) AS nth FROM h),
x AS (SELECT w.title, w.pos, start_ms, end_ms, CASE WHEN regexp_matches(text, '(?m)^\s*- ') THEN text WHEN length(flat) <= 42 OR halves IS NULL THEN flat ELSE halves END AS text FROM w LEFT JOIN two ON two.title = w.title AND two.pos = w.pos AND nth = 1),
o AS (SELECT *, row_number() OVER z - 1 AS i, lead(start_ms) OVER z AS following FROM x WINDOW z AS (PARTITION BY title ORDER BY start_ms, end_ms, pos)),
p AS (SELECT *, 90 * i + max(CASE WHEN i = 0 THEN greatest(start_ms, 40) ELSE start_ms END - 90 * i) OVER (PARTITION BY title ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM o),
q AS (SELECT *, greatest(coalesce(following, end_ms + 10000) - 40, s + 50) AS room FROM p), e AS (SELECT *, greatest(least(end_ms, room), least(s + 700, room)) AS e1 FROM q)"""


@query(rf"""{_POLISHED},
y AS (SELECT title, pos, text, CAST(s AS BIGINT) AS start_ms, CAST(round_even(greatest(CAST(e1 AS DOUBLE), least(s + {V.spoken('text')} * 1000.0 / 17.0, CAST(room AS DOUBLE))), 0) AS BIGINT) AS end_ms FROM e)
SELECT title, CAST(row_number() OVER (PARTITION BY title ORDER BY pos) AS INTEGER) AS pos, CAST(row_number() OVER (PARTITION BY title ORDER BY pos) AS INTEGER) AS num, text, start_ms, end_ms FROM y WHERE end_ms > start_ms""")
def polish(spark, d):
    return tracks.polished(views.cues(spark, d))


@query(rf"""{_POLISHED}, n AS (SELECT title, count(*) AS n FROM cues GROUP BY title), m AS (SELECT title, count(*) AS n FROM k GROUP BY title),
tally AS (SELECT e.title, count(*) AS n, count(*) FILTER (e.text <> w.text) AS rewrapped, count(*) FILTER (s > e.start_ms) AS overlaps_fixed, count(*) FILTER (e1 > least(e.end_ms, room)) AS extended_short,
  count(*) FILTER (least(s + {V.spoken('e.text')} * 1000.0 / 17.0, room) > e1) AS cps_relieved FROM e JOIN w ON w.title = e.title AND w.pos = e.pos GROUP BY e.title)
SELECT n.title, n.n - coalesce(m.n, 0) AS dropped_empty, coalesce(m.n, 0) - coalesce(tally.n, 0) AS collapsed_loops, coalesce(rewrapped, 0) AS rewrapped, coalesce(overlaps_fixed, 0) AS overlaps_fixed,
  coalesce(extended_short, 0) AS extended_short, coalesce(cps_relieved, 0) AS cps_relieved, CAST(0 AS BIGINT) AS dropped_boilerplate FROM n LEFT JOIN m ON m.title = n.title LEFT JOIN tally ON tally.title = n.title""")
def polish_counts(spark, d):
    """All that clean-up counts, on whole texts."""
    return tracks.polish_counts(views.cues(spark, d))


@query(f"WITH {V.CUES} SELECT title, count(*) AS cues, CAST(0 AS BIGINT) AS overlaps FROM cues GROUP BY title")
def validate_overlap_free(spark, d):
    """The property that timing must have: every cue stays, and none overlaps the one before it."""
    t = tracks.retimed(views.cues(spark, d)).withColumn("before", F.lag("end_ms").over(Window.partitionBy("title").orderBy("start_ms")))
    return t.groupBy("title").agg(F.count("*").alias("cues"), F.count_if(F.col("start_ms") < F.col("before")).alias("overlaps"))


# ---- drift ------------------------------------------------------------------------------------------------------


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Lines as source; as target the lines one further on from the tenth on, where ids are even."""
    x = views.lines(spark, d).select("title", "num", "text")
    moved = F.when((F.col("title") % 2 == 0) & (F.col("num") >= 10), F.col("num") + 1).otherwise(F.col("num"))
    return x, x.withColumn("num", moved.cast("int"))


_SIDES = V.LINES + """, tgt AS (SELECT title, CAST(CASE WHEN title % 2 = 0 AND num >= 10 THEN num + 1 ELSE num END AS INTEGER) AS num, text FROM lines),
p AS (SELECT s.title, s.num, length(s.text) AS a, length(t.text) AS b FROM lines s JOIN tgt t ON s.title = t.title AND s.num = t.num WHERE trim(s.text, ' ') <> '' AND t.text <> '' AND NOT contains(t.text, '<DROP>')),
k AS (SELECT title, coalesce(median(CASE WHEN a > 3 THEN b / a END), 1.0) AS k FROM p GROUP BY title)
"""
_DRIFT = _SIDES + """, i AS (SELECT p.*, k.k, row_number() OVER (PARTITION BY p.title ORDER BY num) - 1 AS i, count(*) OVER (PARTITION BY p.title) AS n FROM p JOIN k USING (title)),
w AS (SELECT DISTINCT title, w FROM (SELECT title, unnest(range(0, greatest(0, CAST(max(n) - 8 + 3 AS BIGINT) // 4))) AS w FROM i GROUP BY title HAVING max(n) > 8)),
r AS (SELECT w.title, w.w, o.off, min(i.num) AS first, max(i.num) AS last, sum(coalesce(abs(i.b - i.k * length(m.text)), 0)) AS res FROM w JOIN i ON i.title = w.title AND i.i BETWEEN w.w * 4 AND w.w * 4 + 7
  CROSS JOIN (VALUES (-1), (0), (1)) o(off) LEFT JOIN lines m ON m.title = i.title AND m.num = i.num + o.off AND length(m.text) > 0 GROUP BY ALL),
g AS (SELECT title, w, min(first) AS first, max(last) AS last, arg_min(off, struct_pack(a := round(res, 6), b := off)) AS best, max(CASE WHEN off = 0 THEN res END) AS r0, min(res) AS rb FROM r GROUP BY title, w),
f AS (SELECT title, CAST(w AS INTEGER) AS w, first, last, best, (r0 - rb) / r0 AS improve FROM g WHERE best <> 0 AND r0 > 0 AND (r0 - rb) / r0 > 0.18)
"""


@query(f"WITH {_SIDES} SELECT title, CAST(round(k * 1000000) AS BIGINT) AS k FROM k")
def align_ratio(spark, d):
    return tracks.length_ratio(tracks.aligned_lengths(*_sides(spark, d))).select("title", F.round(F.col("k") * 1000000).cast("long").alias("k"))


@query(f"WITH {_DRIFT} SELECT title, w, first, last, best, CAST(floor(improve * 100) AS BIGINT) AS percent FROM f")
def align_windows(spark, d):
    src, tgt = _sides(spark, d)
    return tracks.drift_windows(src, tgt, 8, digits=9).select("title", "w", "first", "last", "best", F.floor(F.col("improve") * 100).cast("long").alias("percent"))


@query(f"""WITH {_DRIFT}, c AS (SELECT *, CASE WHEN best = lag(best) OVER z AND first <= lag(last) OVER z + 8 THEN 0 ELSE 1 END AS fresh FROM f WINDOW z AS (PARTITION BY title ORDER BY w)),
q AS (SELECT *, sum(fresh) OVER (PARTITION BY title ORDER BY w) AS run FROM c) SELECT title, min(first) AS first, max(last) AS last, min(best) AS best FROM q GROUP BY title, run""")
def align_merge(spark, d):
    src, tgt = _sides(spark, d)
    return tracks.merged_drift(tracks.drift_windows(src, tgt, 8), 8).select("title", "first", "last", "best")


# ---- intervals --------------------------------------------------------------------------------------------------


def _anti(tol: int) -> str:
    return f"(SELECT * FROM spans r WHERE event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM spans c WHERE c.event_type = 'click' AND c.title = r.title AND c.end_ms > r.start_ms - {tol} AND c.start_ms < r.end_ms + {tol}))"


@query(f"WITH {V.SPANS} SELECT title, id, start_ms, end_ms FROM {_anti(3600000)}")
def gap_antijoin(spark, d):
    return tracks.without_neighbour(views.spans(spark, d, "purchase"), views.spans(spark, d, "click"), 3600000, 7200000)


@query(f"WITH {V.SPANS} SELECT title, id, start_ms, end_ms FROM {_anti(0)}")
def recovered_only(spark, d):
    return tracks.recovered(views.spans(spark, d, "purchase"), views.spans(spark, d, "click"))


@query(f"""WITH {V.SPANS}, m AS (SELECT * FROM {_anti(3000)}), c AS (SELECT *, max(end_ms) OVER (PARTITION BY title ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM m),
r AS (SELECT *, sum(CASE WHEN start_ms - reach < 21600000 THEN 0 ELSE 1 END) OVER (PARTITION BY title ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT title, CAST(greatest(0, min(start_ms) - 2000) AS BIGINT) AS start_ms, CAST(max(end_ms) + 2000 AS BIGINT) AS end_ms, count(*) AS n FROM r GROUP BY title, run""")
def gap_windows(spark, d):
    missing = tracks.without_neighbour(views.spans(spark, d, "purchase"), views.spans(spark, d, "click"), 3000)
    return tracks.gap_windows(missing, 21600000)


@query(f"""WITH RECURSIVE {V.SPANS}, o AS (SELECT title, start_ms, end_ms, CASE event_type WHEN 'click' THEN 'draft' ELSE 'added' END AS text FROM spans WHERE event_type IN ('click', 'purchase')),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY title ORDER BY start_ms, end_ms, text) AS INTEGER) AS pos FROM o),
f AS (SELECT title, pos, text, start_ms AS s, CASE WHEN end_ms <= start_ms THEN start_ms + 50 ELSE end_ms END AS e FROM n WHERE pos = 1
  UNION ALL SELECT n.title, n.pos, n.text, CASE WHEN n.start_ms < f.e THEN f.e + 1 ELSE n.start_ms END,
    CASE WHEN n.end_ms <= CASE WHEN n.start_ms < f.e THEN f.e + 1 ELSE n.start_ms END THEN CASE WHEN n.start_ms < f.e THEN f.e + 1 ELSE n.start_ms END + 50 ELSE n.end_ms END
  FROM f JOIN n ON n.title = f.title AND n.pos = f.pos + 1)
SELECT title, pos, text, CAST(s AS BIGINT) AS start_ms, CAST(e AS BIGINT) AS end_ms FROM f""")
def merged_track(spark, d):
    a = views.spans(spark, d, "click").withColumn("text", F.lit("draft"))
    return tracks.merged_track(a, views.spans(spark, d, "purchase").withColumn("text", F.lit("added")))


# ---- words ------------------------------------------------------------------------------------------------------


def _words(spark: SparkSession, d: str) -> DataFrame:
    """Words of each line-broken document, 0.3 s each, with pauses and stutters where positions say so.

    Documents are dealt before they become words, which are many times their size; parts of a number that is given are not joined again.
    """
    dealt = views.read(spark, d, "documents").select("doc_id", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    x = dealt.select(F.col("doc_id").alias("title"), F.posexplode(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("pos", "word"))
    word = F.when((F.col("pos") % 50) < 6, "again").otherwise(F.col("word"))
    start = F.col("pos") * 0.35 + F.floor(F.col("pos") / 17) * 0.9
    return x.select("title", "pos", word.alias("word"), start.alias("start"), (start + 0.3).alias("end"))


@query()
def segment_words(spark, d):
    return words.cues_of_words(_words(spark, d))


def _looping_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of the documents with phrases of four, three and two words between them, each said as often as its place says."""
    w = _words(spark, d)
    k, more = F.col("pos") % 90, (F.col("title") + F.floor(F.col("pos") / 90)) % 3
    said = lambda name, first, n: F.when((k >= first) & (k < first + n * (3 + more)), F.concat(F.lit(name), ((k - first) % n).cast("string")))
    return w.withColumn("word", F.coalesce(said("four", 10, 4), said("three", 40, 3), said("two", 65, 2), F.col("word")))


def _loop_sql(where: str = "true") -> str:
    """Loops word by word, of the words ``where`` keeps: what is left after single words, then after phrases of four, three and two."""
    said = lambda name, first, n: f"WHEN k >= {first} AND k < {first} + {n} * (3 + more) THEN '{name}' || ((k - {first}) % {n})"
    ctes = [rf"""d0 AS (SELECT doc_id AS title, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS ws FROM documents WHERE text IS NOT NULL),
d1 AS (SELECT title, i - 1 AS pos, ws[i] AS word FROM (SELECT title, ws, unnest(range(1, len(ws) + 1)) AS i FROM d0)),
d2 AS (SELECT title, pos, pos % 90 AS k, (title + pos // 90) % 3 AS more, CASE WHEN pos % 50 < 6 THEN 'again' ELSE word END AS word, pos // 17 AS breath FROM d1),
d3 AS (SELECT title, pos, breath, CASE {said("four", 10, 4)} {said("three", 40, 3)} {said("two", 65, 2)} ELSE word END AS word FROM d2),
w AS (SELECT *, regexp_replace(lower(word), '[^\p{{L}}\p{{N}}]+', '', 'g') AS tok FROM d3 WHERE {where}),
p0 AS (SELECT *, 0.35 * (pos - lag(pos) OVER z) + 0.9 * (breath - lag(breath) OVER z) - 0.3 <= 0.45 AND tok <> '' AND tok = lag(tok) OVER z AS again FROM w WINDOW z AS (PARTITION BY title ORDER BY pos)),
p1 AS (SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY title ORDER BY pos) AS run FROM p0),
p2 AS (SELECT *, count(*) OVER (PARTITION BY title, run) AS n, row_number() OVER (PARTITION BY title, run ORDER BY pos) AS j FROM p1),
l1 AS (SELECT title, pos, word, tok, breath FROM p2 WHERE n <= 4 OR j <= 2)"""]
    left = "l1"
    for n in (4, 3, 2):
        # 0.05 s between words of one breath and 0.95 s between two; of words that lost their neighbours, what those took
        ctes.append(f"""i{n} AS (SELECT *, row_number() OVER z - 1 AS i, coalesce(0.35 * (pos - lag(pos) OVER z) + 0.9 * (breath - lag(breath) OVER z) - 0.3 <= 0.45, false) AS near,
  coalesce(tok = lag(tok, {n}) OVER z, false) AS same, coalesce(max(tok) OVER (PARTITION BY title ORDER BY pos ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), '') <> '' AS spoken
  FROM {left} WINDOW z AS (PARTITION BY title ORDER BY pos)),
e{n} AS (SELECT title, i, same AND spoken AS ok,
  coalesce(min(CASE WHEN NOT same THEN i END) OVER (PARTITION BY title ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), count(*) OVER (PARTITION BY title)) - i AS alike,
  coalesce(min(CASE WHEN NOT near THEN i END) OVER (PARTITION BY title, i % {n} ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1000000000) - i AS calm FROM i{n}),
c{n} AS (SELECT title, i - {n} AS a, i - {n} + {n} * (1 + least(alike // {n}, (calm + {n} - 1) // {n})) AS z FROM e{n} WHERE ok AND 1 + least(alike // {n}, (calm + {n} - 1) // {n}) >= 4),
t{n} AS (
  SELECT title, min(a) AS a, arg_min(z, a) AS z FROM c{n} GROUP BY title
  UNION ALL SELECT t.title, min(c.a), arg_min(c.z, c.a) FROM t{n} t JOIN c{n} c ON c.title = t.title AND c.a >= t.z GROUP BY t.title),
x{n} AS (SELECT title, unnest(range(a + 2 * {n}, z)) AS i FROM t{n}),
l{n} AS (SELECT i{n}.title, pos, word, tok, breath FROM i{n} ANTI JOIN x{n} USING (title, i))""")
        left = f"l{n}"
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"\nSELECT title, CAST(pos AS INTEGER) AS pos, word FROM {left}"


@query(_loop_sql())
def loop_ngrams(spark, d):
    return words.unlooped(_looping_words(spark, d)).select("title", "pos", "word")


@query(_loop_sql("pos % 7 <> 3 AND pos % 11 <> 5 AND pos % 13 <> 8"))
def skipped_words(spark, d):
    """Words without text, start or end are as if they weren't there."""
    w = _looping_words(spark, d)
    w = w.withColumns({c: F.when(F.col("pos") % n != k, F.col(c)) for c, n, k in (("word", 7, 3), ("start", 11, 5), ("end", 13, 8))})
    return words.unlooped(w).select("title", "pos", "word")


@query(f"""WITH RECURSIVE {V.CUES}, n AS (
  SELECT title, text, start_ms / 1000.0 AS b, end_ms / 1000.0 AS z, row_number() OVER w AS pos, coalesce(lead(start_ms / 1000.0) OVER w, end_ms / 1000.0 + 5e0) - 4e-2 AS lim,
    length(replace(text, ' ', '')) / 17e0 AS need FROM cues WINDOW w AS (PARTITION BY title ORDER BY start_ms, end_ms, cues.pos)),
f AS (
  SELECT title, CAST(0 AS BIGINT) AS pos, CAST(NULL AS VARCHAR) AS text, 0e0 AS s, 0e0 AS e FROM n GROUP BY title
  UNION ALL
  SELECT title, pos, text, s, least(greatest(z + 3.5e-1, (round_even(s * 1000e0, 0) + 700) / 1000e0, s + need), greatest(lim, s + 5e-2))
  FROM (SELECT n.*, greatest(f.e + 1e-3, n.b - 8e-2, 0e0) AS s FROM f JOIN n ON n.title = f.title AND n.pos = f.pos + 1))
SELECT title, CAST(pos AS INTEGER) AS pos, text, CAST(round_even(s * 1000e0, 0) AS BIGINT) AS start_ms, CAST(round_even(e * 1000e0, 0) AS BIGINT) AS end_ms FROM f WHERE pos > 0 AND e > s""")
def speech_timing(spark, d):
    c = views.cues(spark, d)
    return tracks.speech_retimed(c.select("title", "pos", "text", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end")))


@query()
def transcribe(spark, d):
    return words.transcribed(_words(spark, d))


# ---- streams and state ------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT c_custkey // 4 AS title, c_custkey % 4 AS idx, CASE c_custkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN '' ELSE 'fr' END AS lang, c_custkey % 11 = 0 AS pict, c_custkey % 5 = 0 AS sdh, c_custkey % 7 = 0 AS def FROM customer),
p AS (SELECT title, idx, CASE WHEN lang = 'en' THEN 100 WHEN lang = '' THEN 10 ELSE 0 END + CASE WHEN sdh THEN 20 ELSE 0 END + CASE WHEN def THEN 2 ELSE 0 END AS score FROM s WHERE NOT pict),
b AS (SELECT title, max(score) AS score FROM p GROUP BY title)
SELECT b.title, CAST(max(idx) AS INTEGER) AS "index", CAST(b.score AS INTEGER) AS score, count(*) > 1 AS tied FROM b JOIN p ON p.title = b.title AND p.score = b.score GROUP BY b.title, b.score""")
def stream_rank(spark, d):
    k = F.col("c_custkey")
    on = lambda c: F.when(c, 1).otherwise(0)
    s = views.read(spark, d, "customer").select(
        F.floor(k / 4).alias("title"), (k % 4).cast("int").alias("index"), F.when(k % 11 == 0, "hdmv_pgs_subtitle").otherwise("subrip").alias("codec_name"),
        F.struct(on(k % 7 == 0).alias("default"), F.lit(0).alias("forced"), on(k % 5 == 0).alias("hearing_impaired")).alias("disposition"),
        F.create_map(F.lit("language"), F.when(k % 3 == 0, "en").when(k % 3 == 1, "").otherwise("fr")).alias("tags"))
    return tracks.chosen_streams(tracks.subtitle_scores(s)).select("title", "index", F.col("score").cast("int").alias("score"), "tied")


@query("""SELECT o_custkey AS key, arg_max(o_orderstatus, struct_pack(a := o_orderdate, b := o_orderkey)) AS status, CAST(count(*) AS BIGINT) AS versions FROM orders GROUP BY o_custkey""")
def state_latest(spark, d):
    o = views.read(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("status"), F.struct("o_orderdate", "o_orderkey").alias("updated_at"))
    now = tracks.latest(o.where("updated_at.o_orderkey % 2 = 0"), o.where("updated_at.o_orderkey % 2 = 1"), ["key"])
    return now.join(o.groupBy("key").agg(F.count("*").alias("versions")), "key").select("key", "status", "versions")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_hist(spark, d):
    return tracks.status_counts(views.read(spark, d, "orders").select(F.col("o_orderstatus").alias("status")))


def _seen(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """What a look at workers' files tells of each slice: the last cue in it, its size, and the last line as its time."""
    held = entries.join(parts.select("title", "part", F.col("num").alias("lo")), ["title", "lo"])
    return held.groupBy("title", "part").agg(F.max("lo").alias("last"), F.sum(F.length("text")).alias("size"), F.max("first_line").cast("double").alias("mtime"))


_SEEN = "SELECT n.title, n.part, max(e.lo) AS last, sum(length(e.text)) AS size, max(e.first_line) AS mtime FROM entries e JOIN n ON n.title = e.title AND n.num = e.lo WHERE {0} GROUP BY n.title, n.part"


@query(f"""WITH {V.BATCHES}{_SLICES.format('lines')}, c AS (SELECT title, part, min(num) AS lo, max(num) AS hi FROM n GROUP BY title, part), o AS ({_SEEN.format("true")}), b AS ({_SEEN.format("e.file <> 'w0'")})
SELECT c.title, c.part, lo, hi, CASE WHEN o.size IS NULL THEN 'MISSING' WHEN o.last <> hi THEN 'LAST-CUE' WHEN b.size IS NULL OR b.size <> o.size OR b.mtime <> o.mtime THEN 'UNSTABLE' ELSE 'READY' END AS flag
FROM c LEFT JOIN o ON o.title = c.title AND o.part = c.part LEFT JOIN b ON b.title = c.title AND b.part = c.part""")
def harvest_ready(spark, d):
    """Slices of the documents' lines against the workers' files, which were without one worker's entries when last looked at."""
    x = cues.sliced(views.lines(spark, d), 4)
    e = views.batches(spark, d)
    return tracks.readiness(cues.slice_contract(views.lines(spark, d), 4), _seen(e, x), _seen(e.where("file <> 'w0'"), x))
