"""DuckDB forms of the views in ``sources.views``."""

STAMP = "lpad(CAST({0} // 3600000 AS VARCHAR), CAST(greatest(2, length(CAST({0} // 3600000 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST({0} // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({0} // 1000 % 60 AS VARCHAR), 2, '0') || ',' || lpad(CAST({0} % 1000 AS VARCHAR), 3, '0')"


def stamp(ms: str) -> str:
    return STAMP.format(f"greatest(0, {ms})")


CUES = f"""
c0 AS (SELECT conv_id AS title, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS pos, role AS speaker, coalesce(text, '') AS text FROM conversations),
c1 AS (
  SELECT *, CASE (title + pos) % 4 WHEN 0 THEN 500 WHEN 1 THEN 100 + 20 * length(text) WHEN 2 THEN 200 + 40 * length(text) ELSE 200 + 80 * length(text) END AS dur,
         CASE (3 * title + pos) % 5 WHEN 0 THEN -700 WHEN 1 THEN 0 WHEN 2 THEN 40 WHEN 3 THEN 2000 ELSE 130000 END AS gap FROM c0),
c2 AS (
  SELECT *, CAST(5000 + coalesce(sum(dur + gap) OVER (PARTITION BY title ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms FROM c1),
c3 AS (SELECT *, CAST(start_ms + dur AS BIGINT) AS end_ms FROM c2),
cues AS (
  SELECT title, pos, CAST(pos + CASE WHEN title % 7 = 0 AND pos > 2 THEN 1 ELSE 0 END AS INTEGER) AS num, speaker, text, start_ms, end_ms,
         {stamp('start_ms')} || ' --> ' || {stamp('end_ms')} AS ts FROM c3)
"""

LINES = """
l0 AS (SELECT doc_id AS title, lang, source, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT title, CAST(i AS INTEGER) AS pos, CAST(i AS INTEGER) AS num, ls[i] AS text, lang, source FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM l0))
"""

SPANS = """
s0 AS (SELECT user_id AS title, event_id AS id, event_type, epoch_us(ts) // 1000 AS start_ms, value FROM events),
spans AS (SELECT title, id, event_type, start_ms, CAST(start_ms + floor(value * 1000) AS BIGINT) AS end_ms FROM s0)
"""

BATCHES = LINES + """,
e0 AS (SELECT title, pos, num AS lo, num AS hi, text FROM lines WHERE (title + pos) % 11 <> 0),
entries AS (
  SELECT title, 'w' || (pos % 4) AS file, pos AS first_line, lo, hi, text FROM e0
  UNION ALL SELECT title, 'w' || ((lo + 1) % 4), pos, lo, hi, text FROM e0 WHERE (title + lo) % 13 = 0)
"""


def norm(text: str) -> str:
    r"""``functions.text.norm_key`` in SQL."""
    return rf"trim(regexp_replace(lower(regexp_replace({text}, '(?i)</?[ib]>', '', 'g')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def spoken(text: str) -> str:
    return rf"length(regexp_replace(regexp_replace({text}, '(?i)</?[ib]>', '', 'g'), '[ \n]', '', 'g'))"


def widest(text: str) -> str:
    return rf"list_max(list_transform(string_split(regexp_replace({text}, '(?i)</?[ib]>', '', 'g'), chr(10)), lambda x: length(x)))"


def bounded(words: str) -> str:
    return rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])({words})(?:$|[^\p{{L}}\p{{N}}_])"
