"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audio, decontam, html_text, langid, licenses, lines, merkle, minhash, packing, periodic, pii, substring, suffixes
from .common import table


def op1_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.audio_features(audio.audio_of_texts(table(spark, sf_dir, "documents")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.removed_words(table(spark, sf_dir, "documents")))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.digest(minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.digest(docs, langid.learn(docs))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.by_document(docs, licenses.findings(docs, licenses.learn(docs)))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.removed_bytes(table(spark, sf_dir, "documents")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.deduplicated_lines(table(spark, sf_dir, "documents")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.with_planted_tails(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mpeg_audio, op2_decontaminate, op3_substring_dedup, op4_near_duplicates, op5_language_id, op6_pack, op7_license_scan, op8_html_text, op9_suffix_dedup, op10_pii,
        op11_line_dedup, op12_merkle_manifest, op13_periodic_runs)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(8, len(w)) AS n, array_to_string(w[i : i + least(8, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 6))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(1, len(w) - n + 2))) AS i FROM d, sizes)),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(items.n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 12], chr(10))) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 11))) AS i FROM d)),
m AS (SELECT h, min(doc_id) AS lowest FROM g GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM g JOIN m USING (h) WHERE m.lowest < g.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1),
e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM e ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
g AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, 800)) AS h
  FROM (SELECT doc_id, x, unnest(range(0, greatest(0, length(x) // 2 - 399))) AS i FROM d)),
m AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
s AS (SELECT g.doc_id, g.i FROM g JOIN m USING (h)),
b AS (
  SELECT doc_id, i, CASE WHEN lag(i) OVER (PARTITION BY doc_id ORDER BY i) >= i - 400 THEN 0 ELSE 1 END AS fresh FROM s),
r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS z FROM r GROUP BY 1, 2),
n AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY 1),
gaps AS (
  SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS k0, a AS k1 FROM runs
  UNION ALL
  SELECT d.doc_id, 1000000000000, max(z), max(length(x) // 2) FROM runs JOIN d USING (doc_id) GROUP BY d.doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * k0 + 1, 2 * (k1 - k0)), '' ORDER BY a) AS k
  FROM gaps JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


OP4_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || chr(10) || w[i + 1]))) END AS x FROM d),
c AS (SELECT x, min(doc_id) AS rep, len(x) AS n FROM s WHERE len(x) > 0 GROUP BY x),
e AS (SELECT rep, n, unnest(x) AS g FROM c),
o AS (
  SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS i
  FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * i >= 80 * (na + nb - i)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, both_ways.b FROM r JOIN both_ways ON r.b = both_ways.a),
k AS (SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.x) AS BIGINT) AS n_shingles, coalesce(k.least, s.doc_id) AS component_id,
       coalesce(k.least, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON s.x = c.x LEFT JOIN k ON k.a = c.rep
"""


OP11_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM e),
f AS (SELECT k, min(doc_id) AS lowest FROM k WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, coalesce(f.lowest < k.doc_id, false) AS gone FROM k LEFT JOIN f ON k.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

#: CRC-32 of the decimal digits of doc_id, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda s, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(s, b)), CAST(4294967295 AS BIGINT)))"""

_SIZED = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
_LEAF = " || ".join(_SIZED.format(c) for c in ("doc_id", "source", "lang", "{0}", "text"))

OP12_SQL = rf"""
WITH RECURSIVE l AS (
  SELECT doc_id, lang, sha256({_LEAF.format("n_chars")}) AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN sha256({_LEAF.format("(n_chars + 1)")}) END AS hurt
  FROM documents),
k AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS digest FROM k
  UNION ALL
  SELECT lang, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS level, pos, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2),
folds AS (
  SELECT lang, pos AS leaf_pos, 0 AS level, pos, n, coalesce(hurt, leaf) AS acc, '' AS proof FROM k
  UNION ALL
  SELECT f.lang, leaf_pos, f.level + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(CASE WHEN f.pos % 2 = 1 THEN coalesce(s.digest, '') || acc ELSE acc || coalesce(s.digest, '') END),
         proof || coalesce(s.digest, '')
  FROM folds f LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level AND s.pos = xor(f.pos, 1)
  WHERE f.n > 1),
upper_folds AS (
  SELECT f.lang, leaf_pos, 0 AS level, s.pos, s.n, acc, proof, s.digest AS subroot
  FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL
  SELECT f.lang, leaf_pos, f.level + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(CASE WHEN f.pos % 2 = 1 THEN coalesce(s.digest, '') || acc ELSE acc || coalesce(s.digest, '') END),
         proof || coalesce(s.digest, ''), subroot
  FROM upper_folds f LEFT JOIN upper_nodes s ON s.level = f.level AND s.pos = xor(f.pos, 1)
  WHERE f.n > 1)
SELECT k.doc_id, k.leaf, f.subroot, r.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = r.digest AS verified
FROM k JOIN upper_folds f ON f.lang IS NOT DISTINCT FROM k.lang AND f.leaf_pos = k.pos AND f.n = 1
CROSS JOIN (SELECT digest FROM upper_nodes WHERE n = 1) r
"""

OP13_SQL = rf"""
WITH t AS (
  SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM t),
b AS (
  SELECT *, CASE WHEN n > 0 THEN g % n END AS a,
         CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM s),
i AS (SELECT *, unnest(range(n)) AS i FROM b WHERE n > 0),
x AS (SELECT doc_id, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS x FROM i),
often AS (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS c FROM x),
pairs AS (
  SELECT l.doc_id, l.i, r.i - l.i AS q
  FROM often l JOIN often r ON l.doc_id = r.doc_id AND l.x = r.x AND l.i < r.i AND 4 * (r.i - l.i) <= l.n
  WHERE l.c >= 4),
stretches AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
spans AS (
  SELECT doc_id, min(i) AS s, max(i) + 1 + q AS e, q FROM stretches
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s AS "start", e - s AS "length", min(q) AS period FROM spans GROUP BY doc_id, s, e),
best AS (
  SELECT * FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST("length" AS DOUBLE) / period DESC, "start", period) = 1),
lines AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg("start" || ',' || "length" || ',' || period || chr(10), '' ORDER BY "start", period) AS t
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range("start" + period, "start" + "length")) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST("start" AS BIGINT) AS "start",
       CAST("length" AS BIGINT) AS "length", CAST(period AS BIGINT) AS period,
       CAST(1000 * "length" // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op4_near_duplicates": OP4_SQL, "op9_suffix_dedup": OP9_SQL,
            "op11_line_dedup": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_periodic_runs": OP13_SQL}
