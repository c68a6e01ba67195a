"""SQL for the queries of :mod:`larkspur.plans.registry`, written against the tables.

The log queries aggregate the events themselves, without writing or parsing lines; the
matching queries score all pairs by brute force.
"""

from __future__ import annotations

from larkspur.functions.text import STRIP_CHARACTERS
from larkspur.plans import registry as r
from larkspur.plans import tables as t

SQL: dict[str, str] = {}


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


DOC_LINES = """doc_lines AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS line_no, unnest(l) AS value
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""
CLEANED = (f"cleaned AS (SELECT doc_id, line_no, regexp_replace(lower(trim(value, "
           f"'{STRIP_CHARACTERS}')), '[^A-Za-z0-9\\s\\x0B+]', '', 'g') AS value FROM doc_lines)")
PIECES = "pieces AS (SELECT doc_id, unnest(string_split(value, ' ')) AS word FROM cleaned)"
WORDS = "words AS (SELECT doc_id, word FROM pieces WHERE word <> '')"
TEXT = _with(DOC_LINES, CLEANED, PIECES, WORDS)

SQL["key_sums"] = """
SELECT 'all' AS which, CAST(sum(l_orderkey) AS BIGINT) AS total FROM lineitem
UNION ALL SELECT 'sevens', CAST(sum(l_orderkey) AS BIGINT) FROM lineitem WHERE l_orderkey % 7 = 0"""
SQL["log_value_series"] = """
SELECT p_partkey + 1 AS x, round(2 * ln(p_partkey + 1), 6) AS y FROM part"""
SQL["value_digests"] = """
SELECT p_partkey, sha1(CAST(p_partkey AS VARCHAR)) AS digest FROM part"""
SQL["line_count"] = _with(DOC_LINES) + "SELECT count(*) AS lines FROM doc_lines"
SQL["line_index"] = _with(DOC_LINES) + """
SELECT index, doc_id, index || ': ' || value AS line FROM (
  SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS index, doc_id, value FROM doc_lines)"""
SQL["clean_lines"] = _with(DOC_LINES, CLEANED) + (
    "SELECT doc_id, line_no, value AS cleaned FROM cleaned")
SQL["unquoted_text"] = """SELECT page_id, replace(html, '"', '') AS unquoted FROM pages"""
SQL["word_totals"] = TEXT + """
SELECT (SELECT count(*) FROM pieces) AS pieces, (SELECT count(*) FROM words) AS words"""
SQL["word_counts"] = TEXT + "SELECT word, count(*) AS n FROM words GROUP BY word"
SQL["top_words"] = TEXT + """
SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rank
FROM (SELECT word, count(*) AS n FROM words GROUP BY word) ORDER BY n DESC, word LIMIT 15"""
SQL["last_words"] = TEXT + """
SELECT word, CAST(row_number() OVER (ORDER BY word DESC) AS INTEGER) AS rank
FROM (SELECT word FROM pieces ORDER BY word DESC LIMIT 5)"""
SQL["plural_words"] = TEXT + """
SELECT DISTINCT word, word || 's' AS plural, CAST(length(word) + 1 AS INTEGER) AS plural_length
FROM words"""
SQL["unique_words"] = TEXT + "SELECT count(DISTINCT word) AS unique_words FROM words"
SQL["mean_count_per_word"] = TEXT + """
SELECT count(*) AS words, count(DISTINCT word) AS unique_words,
       round(count(*) / count(DISTINCT word), 2) AS mean_count FROM words"""
SQL["words_grouped"] = TEXT + """
SELECT word, doc_id, string_agg('1', ',') AS ones FROM words GROUP BY word, doc_id"""
SQL["word_group_sums"] = TEXT + "SELECT word, count(*) AS total FROM words GROUP BY word"

LOGS = f"""logs AS (
  SELECT {t.HOST} AS host, '-' AS client_identd, '-' AS user_id,
    date_trunc('second', ts) AS date_time, {t.METHOD} AS method, {t.ENDPOINT} AS endpoint,
    CASE WHEN {t.WITHOUT_PROTOCOL} THEN NULL ELSE 'HTTP/1.0' END AS protocol,
    {t.CODE} AS response_code,
    CASE WHEN {t.CODE} = 304 THEN 0 ELSE {t.BYTES} END AS content_size
  FROM events WHERE NOT ({t.BROKEN}))"""
LINES = f"""log_lines AS (
  SELECT {t.HOST} || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] '
    || CASE WHEN {t.BROKEN} THEN '' ELSE '"' END || {t.METHOD} || ' ' || {t.ENDPOINT}
    || CASE WHEN {t.WITHOUT_PROTOCOL} THEN '' ELSE ' HTTP/1.0' END || '" ' || {t.CODE} || ' '
    || CASE WHEN {t.CODE} = 304 THEN '-' ELSE CAST({t.BYTES} AS VARCHAR) END AS value,
    ({t.BROKEN}) AS broken, ({t.WITHOUT_PROTOCOL}) AS short
  FROM events)"""


def _logs(select: str) -> str:
    return _with(LOGS) + select


def _top(key: str, k: int, where: str = "TRUE", source: str = "logs") -> str:
    return _logs(f"""
SELECT {key}, n, CAST(row_number() OVER (ORDER BY n DESC, {key}) AS INTEGER) AS rank
FROM (SELECT {key}, count(*) AS n FROM {source} WHERE {where} GROUP BY {key})
ORDER BY n DESC, {key} LIMIT {k}""")


DAY = "CAST(day(date_time) AS INTEGER)"
SQL["log_parse"] = _logs("SELECT * FROM logs")
SQL["log_rejects"] = _with(LINES) + "SELECT value FROM log_lines WHERE broken"
SQL["log_reject_sample"] = _with(LINES) + (
    "SELECT value FROM log_lines WHERE broken ORDER BY value LIMIT 20")
SQL["log_strict_rejects"] = _with(LINES) + "SELECT value FROM log_lines WHERE broken OR short"
SQL["log_status_counts"] = f"""
SELECT count(*) AS lines_read, count(*) FILTER (NOT ({t.BROKEN})) AS lines_parsed,
       CAST(0 AS BIGINT) AS header_lines, count(*) FILTER ({t.BROKEN}) AS lines_failed
FROM events"""
SQL["log_ingest_metrics"] = f"""
SELECT count(*) FILTER (NOT ({t.BROKEN})) AS rows_kept, count(*) AS lines_read,
       count(*) FILTER (NOT ({t.BROKEN})) AS lines_parsed, CAST(0 AS BIGINT) AS header_lines,
       count(*) FILTER ({t.BROKEN}) AS lines_failed
FROM events"""
SQL["content_size_stats"] = _logs("""
SELECT CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size,
       min(content_size) AS min_size, max(content_size) AS max_size FROM logs""")
SHARES = """shares AS (SELECT response_code, count(*) AS n,
  count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM logs) AS share FROM logs GROUP BY 1)"""
SQL["response_code_share"] = _with(LOGS, SHARES) + (
    "SELECT response_code, n, round(share, 6) AS share FROM shares")
SQL["response_code_labels"] = _with(LOGS, SHARES) + """
SELECT response_code, share * 100 >= 7 AS labelled,
       CASE WHEN share * 100 >= 7 THEN round(share * 100, 6) END AS percent FROM shares"""
SQL["frequent_hosts"] = _logs("""
SELECT host, count(*) AS n FROM logs GROUP BY host HAVING count(*) > 10 ORDER BY host LIMIT 20""")
SQL["endpoint_hits"] = _logs("SELECT endpoint, count(*) AS n FROM logs GROUP BY endpoint")
SQL["endpoint_series_bounds"] = _logs("""
SELECT min(endpoint) AS first_key, max(endpoint) AS last_key, max(n) AS max_value
FROM (SELECT endpoint, count(*) AS n FROM logs GROUP BY endpoint)""")
SQL["top_endpoints"] = _top("endpoint", 10)
SQL["top_failed_endpoints"] = _top("endpoint", 10, "response_code <> 200")
SQL["failed_endpoint_count"] = _logs(
    "SELECT count(DISTINCT endpoint) AS endpoints FROM logs WHERE response_code <> 200")
SQL["unique_hosts"] = _logs("SELECT count(DISTINCT host) AS hosts FROM logs")
SQL["daily_unique_hosts"] = _logs(f"""
SELECT {DAY} AS day, count(DISTINCT host) AS hosts FROM logs GROUP BY 1""")
SQL["avg_requests_per_host"] = _logs(f"""
SELECT {DAY} AS day, count(*) // count(DISTINCT host) AS requests_per_host
FROM logs GROUP BY 1""")
SQL["daily_hosts_by_date"] = _logs("""
SELECT CAST(date_time AS DATE) AS day, count(*) AS requests, count(DISTINCT host) AS hosts,
       count(*) // count(DISTINCT host) AS requests_per_host FROM logs GROUP BY 1""")
SQL["not_found_count"] = _logs("SELECT count(*) AS requests FROM logs WHERE response_code = 404")
SQL["not_found_endpoints"] = _logs("""
SELECT DISTINCT endpoint FROM logs WHERE response_code = 404 ORDER BY endpoint LIMIT 40""")
SQL["top_not_found_endpoints"] = _top("endpoint", 20, "response_code = 404")
SQL["top_not_found_hosts"] = _top("host", 25, "response_code = 404")
SQL["not_found_by_day"] = _logs(f"""
SELECT {DAY} AS day, count(*) AS n FROM logs WHERE response_code = 404 GROUP BY 1""")
SQL["top_not_found_days"] = _top(
    "day", 5, "response_code = 404", f"(SELECT *, {DAY} AS day FROM logs)")
SQL["not_found_by_hour"] = _logs("""
SELECT CAST(hour(date_time) AS INTEGER) AS hour, count(*) AS n
FROM logs WHERE response_code = 404 GROUP BY 1""")

SQL["product_ingest"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS id,
       p_name || ', size ' || p_size || ' ' || p_type || ' "' || p_brand || '"' AS product
FROM part WHERE NOT ({t.BROKEN_PART})"""
SQL["product_status_counts"] = f"""
SELECT count(*) + 1 AS lines_read, count(*) FILTER (NOT ({t.BROKEN_PART})) AS lines_parsed,
       CAST(1 AS BIGINT) AS header_lines, count(*) FILTER ({t.BROKEN_PART}) AS lines_failed
FROM part"""
SQL["product_rejects"] = f"""
SELECT '"' || p_partkey || '",' || p_name || ', size ' || p_size || ',' || p_type || ',"'
       || p_brand || '",' || p_retailprice AS value FROM part WHERE {t.BROKEN_PART}"""

GOLD = """gold AS (
  SELECT DISTINCT l.id AS left_id, d.id AS right_id
  FROM (SELECT line, min(id) AS id FROM (
          SELECT item_id AS id, unnest(string_split(text, chr(10))) AS line FROM benchmark)
        GROUP BY line) l
  JOIN (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line FROM documents) d
    ON l.line = d.line WHERE l.line <> '')"""
SQL["gold_ingest"] = _with(GOLD) + """
SELECT CAST(left_id AS VARCHAR) AS left_id, CAST(right_id AS VARCHAR) AS right_id FROM gold"""
SQL["gold_status_counts"] = _with(GOLD) + """
SELECT count(*) + 1 AS lines_read, count(*) AS lines_parsed, CAST(1 AS BIGINT) AS header_lines,
       CAST(0 AS BIGINT) AS lines_failed FROM gold"""

# Tokens keep their place, so that token texts can be put together again.
STOP = ", ".join(f"'{w}'" for w in t.STOPWORDS)
RAW_TOKENS = r"""raw_tokens AS (
  SELECT side, id, generate_subscripts(l, 1) AS place, unnest(l) AS token FROM (
    SELECT 'left' AS side, item_id AS id, regexp_split_to_array(lower(text), '\W+') AS l
    FROM benchmark
    UNION ALL
    SELECT 'right', doc_id, regexp_split_to_array(lower(text), '\W+') FROM documents))"""
TOKENS = f"tokens AS (SELECT * FROM raw_tokens WHERE token <> '' AND token NOT IN ({STOP}))"
TF = """counted AS (SELECT side, id, token, count(*) AS n FROM tokens GROUP BY ALL),
tf AS (SELECT side, id, token, n / sum(n) OVER (PARTITION BY side, id) AS tf FROM counted),
idf AS (SELECT token, count(*) AS df, ((SELECT count(*) FROM benchmark)
  + (SELECT count(*) FROM documents)) / CAST(count(*) AS DOUBLE) AS idf FROM tf GROUP BY token),
weights AS (SELECT side, id, token, tf * idf AS weight FROM tf JOIN idf USING (token))"""
UNITS = """units AS (SELECT side, id, token,
  weight / sqrt(sum(weight * weight) OVER (PARTITION BY side, id)) AS unit FROM weights)"""
SCORES = """scores AS (SELECT a.id AS left_id, b.id AS right_id,
    round(sum(a.unit * b.unit), 12) AS score
  FROM (SELECT * FROM units WHERE side = 'left') a
  JOIN (SELECT * FROM units WHERE side = 'right') b USING (token) GROUP BY 1, 2)"""
TOKEN_SQL = _with(RAW_TOKENS, TOKENS, TF)


def _texts(source: str) -> str:
    return f"""
SELECT d.doc_id AS id, coalesce(x.tokens, '') AS tokens FROM documents d LEFT JOIN (
  SELECT id, string_agg(token, ' ' ORDER BY place) AS tokens FROM {source}
  WHERE side = 'right' AND token <> '' GROUP BY id) x ON x.id = d.doc_id"""


SQL["simple_tokens"] = _with(RAW_TOKENS) + _texts("raw_tokens")
SQL["tokens_no_stop"] = _with(RAW_TOKENS, TOKENS) + _texts("tokens")
SQL["words_not_listed"] = _with(RAW_TOKENS) + r"""
SELECT token, count(*) AS n FROM raw_tokens WHERE token <> '' AND token NOT IN (
  SELECT w FROM (SELECT unnest(regexp_split_to_array(lower(p_name), '\W+')) AS w FROM part))
GROUP BY token"""
SQL["token_total"] = _with(RAW_TOKENS, TOKENS) + "SELECT count(*) AS tokens FROM tokens"
SQL["biggest_record"] = _with(RAW_TOKENS, TOKENS) + """
SELECT id, count(*) AS n_tokens FROM tokens WHERE side = 'right' GROUP BY id
ORDER BY 2 DESC, 1 LIMIT 1"""
SQL["term_frequency"] = TOKEN_SQL + (
    "SELECT id, token, round(tf, 6) AS tf FROM tf WHERE side = 'right'")
SQL["idf"] = TOKEN_SQL + "SELECT token, df, round(idf, 6) AS idf FROM idf"
SQL["lowest_idf"] = TOKEN_SQL + """
SELECT token, round(idf, 6) AS idf,
       CAST(row_number() OVER (ORDER BY idf, token) AS INTEGER) AS rank
FROM idf ORDER BY idf.idf, token LIMIT 11"""
SQL["idf_histogram"] = TOKEN_SQL + """
SELECT CAST(least(floor((idf - low) / (high - low) * 50), 49) AS INTEGER) AS bin, count(*) AS n
FROM idf, (SELECT min(idf) AS low, max(idf) AS high FROM idf) GROUP BY 1"""
SQL["tfidf_weights"] = TOKEN_SQL + (
    "SELECT id, token, round(weight, 6) AS weight FROM weights WHERE side = 'right'")
SQL["vector_norms"] = TOKEN_SQL + """
SELECT id, round(sqrt(sum(weight * weight)), 6) AS norm FROM weights WHERE side = 'right'
GROUP BY id"""
SQL["vector_maps"] = TOKEN_SQL + """
SELECT id, CAST(count(*) AS INTEGER) AS tokens, round(sqrt(sum(weight * weight)), 6) AS norm
FROM weights WHERE side = 'right' GROUP BY id"""
SQL["posting_counts"] = TOKEN_SQL + (
    "SELECT token, count(*) AS n FROM weights WHERE side = 'right' GROUP BY token")

MATCHING = _with(RAW_TOKENS, TOKENS, TF, UNITS, SCORES, GOLD)
COPIES = """left_copies AS (SELECT min(item_id) AS id, count(*) AS n FROM benchmark GROUP BY text),
right_copies AS (SELECT min(doc_id) AS id, count(*) AS n FROM documents GROUP BY text)"""
ALL_PAIRS = "(SELECT count(*) FROM benchmark) * (SELECT count(*) FROM documents)"
GOLD_SCORES = """gold_scores AS (SELECT left_id, right_id, coalesce(score, 0) AS score
  FROM gold LEFT JOIN scores USING (left_id, right_id))"""
ASSIGNED = """assigned AS (
  SELECT doc_id % (SELECT count(*) FROM benchmark) AS left_id, doc_id AS right_id FROM documents),
assigned_scores AS (SELECT a.left_id, a.right_id, coalesce(score, 0) AS score
  FROM assigned a JOIN benchmark b ON b.item_id = a.left_id LEFT JOIN scores s
    ON s.left_id = a.left_id AND s.right_id = a.right_id)"""
SQL["inverted_similarity"] = MATCHING + "," + COPIES + """
SELECT left_id, right_id, round(score, 6) AS score, l.n AS left_copies, r.n AS right_copies
FROM scores JOIN left_copies l ON l.id = left_id JOIN right_copies r ON r.id = right_id
WHERE score >= 0.01"""
SQL["record_copies"] = """
SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY text) AS vector_id FROM documents"""
SQL["candidate_pairs"] = MATCHING + "SELECT count(*) AS candidate_pairs FROM scores"
SQL["cartesian_summary"] = MATCHING + f"""
SELECT {ALL_PAIRS} AS pairs, round(sum(score), 6) AS sum_score,
       round(sum(score) / ({ALL_PAIRS}), 6) AS mean_score FROM scores"""
SQL["pair_similarity"] = MATCHING + "," + ASSIGNED + (
    "SELECT left_id, right_id, round(score, 6) AS score FROM assigned_scores")
SQL["pair_lookup"] = MATCHING + "," + ASSIGNED + """
SELECT round(score, 6) AS score FROM assigned_scores WHERE left_id = 0 AND right_id = 0"""
SQL["text_pair_similarity"] = MATCHING + """
SELECT g.left_id || ' ' || g.right_id AS key, round(CASE
    WHEN g.left_id IN (SELECT id FROM units WHERE side = 'left')
     AND g.right_id IN (SELECT id FROM units WHERE side = 'right') THEN coalesce(score, 0) END, 6)
  AS score
FROM gold g LEFT JOIN scores s ON s.left_id = g.left_id AND s.right_id = g.right_id"""
SQL["gold_scores"] = MATCHING + "," + GOLD_SCORES + (
    "SELECT left_id, right_id, round(score, 6) AS score FROM gold_scores")
SQL["dup_similarity_avg"] = MATCHING + "," + GOLD_SCORES + f"""
SELECT TRUE AS is_match, count(*) AS pairs, round(avg(score), 6) AS mean_score FROM gold_scores
UNION ALL
SELECT FALSE, {ALL_PAIRS} - (SELECT count(*) FROM gold_scores),
  round(((SELECT sum(score) FROM scores) - (SELECT coalesce(sum(score), 0) FROM gold_scores))
        / ({ALL_PAIRS} - (SELECT count(*) FROM gold_scores)), 6)"""
HISTOGRAM = """histogram AS (SELECT bin, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CAST(trunc(score * 100) AS INTEGER) AS bin, 1 AS n FROM scores
    UNION ALL SELECT CAST(trunc(score * 100) AS INTEGER), -1 FROM gold_scores)
  WHERE bin BETWEEN 0 AND 100 GROUP BY bin HAVING sum(n) <> 0)"""
SQL["score_histogram"] = MATCHING + "," + GOLD_SCORES + "," + HISTOGRAM + (
    "SELECT bin, n FROM histogram")
SQL["quality_curve"] = MATCHING + "," + GOLD_SCORES + "," + HISTOGRAM + """,
steps AS (SELECT range AS step, CAST(range AS DOUBLE) / 100 AS threshold FROM range(100)),
counts AS (SELECT threshold,
    (SELECT count(*) FROM gold_scores g WHERE g.score < threshold) AS fn,
    (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM histogram h WHERE h.bin >= step) AS fp
  FROM steps),
rates AS (SELECT *, (SELECT count(*) FROM gold_scores) - fn AS tp FROM counts),
shares AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS rc FROM rates)
SELECT round(threshold, 6) AS threshold, tp, fp, fn, round(p, 6) AS "precision",
       round(rc, 6) AS recall, round(2 * p * rc / nullif(p + rc, 0), 6) AS f FROM shares"""

RATINGS = f"""ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS movie,
         CAST(CAST(l_quantity AS BIGINT) % 5 + 1 AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT ({t.BROKEN_RATING}))"""
MOVIES = "movies AS (SELECT CAST(p_partkey AS INTEGER) AS movie, p_name AS title FROM part)"
STATS = """stats AS (SELECT movie, count(*) AS n, avg(rating) AS avg_rating
  FROM ratings GROUP BY movie),
titled AS (SELECT movie, avg_rating, title, n FROM stats JOIN movies USING (movie))"""
SPLIT = """parts AS (SELECT "user", movie, rating, CASE WHEN place < 0.6 THEN 0
    WHEN place < 0.8 THEN 1 ELSE 2 END AS part FROM (
  SELECT *, CAST('0x' || substr(md5('0::' || "user" || '::' || movie), 1, 8) AS BIGINT)
    / 4294967296.0::DOUBLE AS place FROM ratings))"""
RATED = _with(RATINGS, MOVIES, STATS, SPLIT)
SQL["ratings_ingest"] = RATED + 'SELECT "user", movie, rating FROM ratings'
SQL["rating_status_counts"] = f"""
SELECT count(*) AS lines_read, count(*) FILTER (NOT ({t.BROKEN_RATING})) AS lines_parsed,
       CAST(0 AS BIGINT) AS header_lines, count(*) FILTER ({t.BROKEN_RATING}) AS lines_failed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
SQL["movies_ingest"] = RATED + "SELECT movie, title FROM movies"
SQL["movies_with_title"] = "SELECT count(*) AS n FROM part WHERE p_name = 'red widget'"
SQL["first_rating"] = RATED + """
SELECT "user", movie, rating FROM ratings ORDER BY movie, "user", rating LIMIT 1"""
SQL["sort_by_key"] = """
SELECT p_size, p_name, p_partkey,
       row_number() OVER (ORDER BY p_size, p_name, p_partkey) - 1 AS position FROM part"""
SQL["sort_by_text_key"] = """
SELECT p_partkey, p_size || ' ' || p_name AS sort_key,
       row_number() OVER (ORDER BY p_size || ' ' || p_name, p_partkey) - 1 AS position FROM part"""
SQL["movie_stats"] = RATED + "SELECT movie, n, round(avg_rating, 6) AS avg_rating FROM stats"
SQL["titled_movie_stats"] = RATED + (
    "SELECT movie, round(avg_rating, 6) AS avg_rating, title, n FROM titled")
SQL["lowest_rated"] = RATED + """
SELECT movie, round(avg_rating, 6) AS avg_rating, title, n,
  CAST(row_number() OVER (ORDER BY avg_rating, title, n, movie) AS INTEGER) AS rank
FROM titled ORDER BY titled.avg_rating, title, n, movie LIMIT 3"""
SQL["popular_movies"] = RATED + f"""
SELECT movie, round(avg_rating, 6) AS avg_rating, title, n,
  CAST(row_number() OVER (ORDER BY avg_rating DESC, title DESC, movie DESC) AS INTEGER) AS rank
FROM titled WHERE n > {r.POPULAR_ABOVE}
ORDER BY titled.avg_rating DESC, title DESC, movie DESC LIMIT 20"""
SQL["popular_by_text_key"] = RATED + f"""
SELECT CAST(row_number() OVER (ORDER BY sort_key DESC, movie DESC) AS INTEGER) AS rank, movie, n
FROM (SELECT *, CAST(round(avg_rating, 11) AS VARCHAR) || ' ' || title AS sort_key
      FROM titled WHERE n > {r.POPULAR_ABOVE}) ORDER BY sort_key DESC, movie DESC LIMIT 20"""
SQL["rating_split"] = RATED + 'SELECT "user", movie, rating, part FROM parts'
SQL["rating_split_sizes"] = RATED + "SELECT part, count(*) AS n FROM parts GROUP BY part"
SQL["rmse"] = RATED + """
SELECT count(*) AS n, round(sqrt(avg((a.rating - p.rating) * (a.rating - p.rating))), 6) AS rmse
FROM (SELECT "user", movie, m.rating FROM parts JOIN (
        SELECT movie, avg(rating) AS rating FROM parts WHERE part = 0 GROUP BY movie) m
        USING (movie) WHERE part = 2) p
JOIN (SELECT * FROM parts WHERE part = 2) a USING ("user", movie)"""
SQL["mean_baseline_rmse"] = RATED + """
SELECT count(*) AS n, round(sqrt(avg((rating - m) * (rating - m))), 6) AS rmse,
       round(any_value(m), 6) AS mean
FROM parts, (SELECT avg(rating) AS m FROM parts WHERE part = 0) WHERE part = 2"""
NEW_USER = f"""new_user AS (
  SELECT CAST({r.NEW_USER} AS INTEGER) AS "user", movie,
         CAST(movie % 5 + 1 AS DOUBLE) AS rating FROM (
    SELECT movie FROM ratings GROUP BY movie ORDER BY count(*) DESC, movie LIMIT 10)),
candidates AS (SELECT movie, title, n FROM titled
  WHERE n > {r.RECOMMENDED_ABOVE} AND movie NOT IN (SELECT movie FROM new_user))"""
WITH_NEW_USER = _with(RATINGS, MOVIES, STATS, SPLIT, NEW_USER)
SQL["als_predicted_counts"] = RATED + """
SELECT rank, count(*) AS n FROM parts, (SELECT unnest([4, 8, 12]) AS rank)
WHERE part = 1 AND "user" IN (SELECT "user" FROM parts WHERE part = 0)
  AND movie IN (SELECT movie FROM parts WHERE part = 0) GROUP BY rank"""
SQL["new_user_ratings"] = WITH_NEW_USER + 'SELECT "user", movie, rating FROM new_user'
SQL["training_with_new_user"] = WITH_NEW_USER + """
SELECT "user", count(*) AS n FROM (
  SELECT "user" FROM parts WHERE part = 0 UNION ALL SELECT "user" FROM new_user) GROUP BY "user\""""
SQL["recommendable_movies"] = WITH_NEW_USER + "SELECT movie, title, n FROM candidates"
SQL["new_user_list_check"] = WITH_NEW_USER + """
SELECT least(20, count(*)) AS movies, CAST(0 AS BIGINT) AS out_of_order,
       CAST(0 AS BIGINT) AS rated, CAST(0 AS BIGINT) AS seldom
FROM candidates WHERE movie IN (SELECT movie FROM parts WHERE part = 0)"""
SQL["als_planted_recovery"] = RATED + """,
planted AS (
  SELECT "user", movie, part, known,
         known + (("user" * 131::BIGINT + movie * 17) % 21 - 10) / 50.0::DOUBLE AS rating FROM (
    SELECT DISTINCT "user", movie, part,
           1.0::DOUBLE + 2 * ("user" * 37::BIGINT % 101 / 100.0::DOUBLE)
             * (movie * 29::BIGINT % 97 / 96.0::DOUBLE)
           + 2 * ("user" * 53::BIGINT % 89 / 88.0::DOUBLE)
             * (movie * 71::BIGINT % 83 / 82.0::DOUBLE) AS known FROM parts))
SELECT count(*) AS n, TRUE AS smallest_chosen, TRUE AS recovered,
       round(sqrt(avg(((SELECT avg(rating) FROM planted WHERE part = 0) - known) ** 2)), 6)
         AS mean_rmse
FROM planted WHERE part = 2 AND "user" IN (SELECT "user" FROM planted WHERE part = 0)
  AND movie IN (SELECT movie FROM planted WHERE part = 0)"""
SQL["result_set_difference"] = """
SELECT k, v, CAST(sum(s) AS BIGINT) AS surplus FROM (
  SELECT CAST(p_size AS BIGINT) AS k, p_type AS v, 1 AS s FROM part
  UNION ALL SELECT CAST(c_nationkey AS BIGINT), 'ECONOMY', -1 FROM customer)
GROUP BY k, v HAVING sum(s) <> 0"""
