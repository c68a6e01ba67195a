"""The queries of this subpackage over the given tables, and SQL for those that have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import (
    decontaminate,
    language,
    licenses,
    line_dedup,
    lm,
    manifest,
    packing,
    quality_rules,
    runs,
    secret_scan,
    sharding,
    simhash,
    warc,
)
from larkspur.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL by query.
SQL: dict[str, str] = {}


def _query(function):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


#: CRC-32 of ``doc_id`` as text, bit by bit.
CRCS = """crcs AS (
  SELECT doc_id, xor(list_reduce(
    [CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                   lambda c: CAST(ord(c) AS BIGINT)),
    lambda a, b: list_reduce([xor(a, b)] || [CAST(i AS BIGINT) FOR i IN range(8)],
                             lambda u, v: xor(u >> 1, 3988292384 * (u & 1)))), 4294967295) AS h
  FROM (SELECT DISTINCT doc_id FROM documents))"""


@_query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, folder, "documents"))


@_query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_digest(table(spark, folder, "documents"))


@_query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_digest(table(spark, folder, "documents"))


@_query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@_query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_digest(table(spark, folder, "documents"))


SQL["op6_quality_rules"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, unnest(range(len(w) - 7)) AS i, w FROM docs WHERE len(w) >= 8),
grams AS (SELECT r, i, array_to_string(w[i + 1:i + 8], ' ') AS gram FROM windows),
twice AS (SELECT r, i FROM grams
          QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
covered AS (
  SELECT r, count(DISTINCT i + j) AS n_repeat_words
  FROM twice, (SELECT unnest(range(8)) AS j) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines,
         sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') AND nth > 1 THEN 1 ELSE 0 END)
           AS n_dup_lines
  FROM (SELECT r, line, row_number() OVER (PARTITION BY r, line) AS nth
        FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)) GROUP BY r),
measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines
  FROM docs JOIN lines USING (r) LEFT JOIN covered USING (r)),
failures AS (
  SELECT *, [n_words < 20, 100 * n_repeat_words > 30 * n_words, 10 * n_symbols > 3 * n_words,
             n_dup_lines > 3 AND 2 * n_dup_lines > n_lines] AS f FROM measured),
hosts AS (
  SELECT source, unnest(range(4)) AS k, count(*) AS n,
         unnest([sum(CAST(f[1] AS INT)), sum(CAST(f[2] AS INT)), sum(CAST(f[3] AS INT)),
                 sum(CAST(f[4] AS INT))]) AS bad
  FROM failures GROUP BY source),
moments AS (
  SELECT k, sum(bad) / sum(n) AS m, var_pop(bad / n) - sum(bad) / sum(n) * (1 - sum(bad) / sum(n))
         * avg(1 / n) AS v FROM hosts GROUP BY k),
weights AS (
  SELECT k, m, greatest(CASE WHEN v > m * (1 - m) / 1001 THEN m * (1 - m) / v - 1
                             ELSE 1000 END, 1) AS a FROM moments),
verdicts AS (
  SELECT source, max((bad + m * a) / (n + a)) > 0.6 AS host_failed
  FROM hosts JOIN weights USING (k) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f[1] OR f[2] AS base_failed, NOT (f[1] OR f[2]) AND NOT host_failed AS kept, host_failed
FROM failures JOIN verdicts ON failures.source IS NOT DISTINCT FROM verdicts.source
"""


@_query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, folder, "documents"))


SQL["op7_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
              FROM documents))),
repeats AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS dropped
  FROM lines LEFT JOIN repeats USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""


@_query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.record_digest(spark, table(spark, folder, "pages"))


SQL["op8_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
kept AS (SELECT payload, max(page_id) AS response FROM payloads GROUP BY payload)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT)
               >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM payloads JOIN kept USING (payload)
"""


@_query
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_digest(table(spark, folder, "documents"))


@_query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


@_query
def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest_digest(table(spark, folder, "documents"))


SQL["op11_manifest"] = f"""
WITH RECURSIVE {CRCS},
own AS (
  SELECT doc_id, lang, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS f,
         [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars + 1 AS VARCHAR), text] AS g
  FROM documents),
leaves AS (
  SELECT doc_id, lang,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
         sha256(array_to_string(list_transform(f, lambda x:
           coalesce(strlen(x) || ':' || x, '-')), '')) AS leaf,
         sha256(array_to_string(list_transform(g, lambda x:
           coalesce(strlen(x) || ':' || x, '-')), '')) AS other
  FROM own),
nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n),
subroots AS (SELECT lang, hash, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos
             FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, hash, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
  FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT l.lang, l.pos, a.level, a.pos % 2 AS slot, b.hash AS sibling
  FROM leaves l JOIN nodes a ON a.lang IS NOT DISTINCT FROM l.lang AND a.n > 1
       AND a.pos = l.pos >> a.level
  LEFT JOIN nodes b ON b.lang IS NOT DISTINCT FROM l.lang AND b.level = a.level
       AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT l.lang, l.pos, 100 + a.level, a.pos % 2, b.hash
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  JOIN tops a ON a.n > 1 AND a.pos = s.pos >> a.level
  LEFT JOIN tops b ON b.level = a.level AND b.pos = xor(a.pos, 1)),
ways AS (
  SELECT lang, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof,
         list(CASE WHEN sibling IS NULL THEN 'N' WHEN slot = 1 THEN 'L' || sibling
                   ELSE 'R' || sibling END ORDER BY level) AS way
  FROM steps GROUP BY lang, pos),
folded AS (
  SELECT l.doc_id, l.leaf, s.hash AS subroot, (SELECT hash FROM tops WHERE n = 1) AS root,
         coalesce(w.proof, sha256('')) AS proof_sha256,
         list_reduce([CASE WHEN p.h % 7 = 0 THEN l.other ELSE l.leaf END] || coalesce(w.way, []),
           lambda a, x: CASE x[1] WHEN 'L' THEN sha256(x[2:] || a) WHEN 'R' THEN sha256(a || x[2:])
                                  ELSE sha256(a) END) AS folded_root
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  JOIN crcs p ON p.doc_id = l.doc_id
  LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM l.lang AND w.pos = l.pos)
SELECT *, folded_root = root AS verified FROM folded
"""


@_query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.run_digest(table(spark, folder, "documents"))


#: Islands of places whose word comes again q words later, for every q that any word repeats at.
SQL["op12_periodic_runs"] = rf"""
WITH {CRCS},
original AS (
  SELECT d.doc_id, h, h // 10 AS g,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents d JOIN crcs USING (doc_id)),
planted AS (
  SELECT *, g % len(w) AS a, 1 + (len(w) - g % len(w)) // (3 + g % 8) AS p
  FROM original WHERE h % 10 = 0 AND len(w) > 0),
docs AS (
  SELECT doc_id, w FROM original WHERE h % 10 <> 0 OR len(w) = 0
  UNION ALL
  SELECT doc_id, [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(len(w))]
  FROM planted),
words AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word, len(w) AS n FROM docs),
again AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y USING (doc_id, word)
  WHERE y.i > x.i AND 2 * (y.i - x.i) <= x.n),
-- A run takes at least so many places with its period.
kept AS (
  SELECT doc_id, i, q FROM again
  QUALIFY count(*) OVER (PARTITION BY doc_id, q) >= greatest(q, 12 - q)),
islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM kept)
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM islands GROUP BY ALL),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept_words AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_runs,
         min(struct_pack(x := -length, s := start, q := period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), ''
                    ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.x AS length,
       best.q AS period, 1000 * -best.x // best.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN found USING (doc_id) LEFT JOIN kept_words USING (doc_id)
"""


@_query
def op13_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.lm_digest(table(spark, folder, "documents"))
