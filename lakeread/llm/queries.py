"""The queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embeddings, language_model, licenses, mixing, quality, revisits, simhash, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is a full response, and is visited again, with another spelling of its URL, up to 1,500 ticks later or
    500 earlier (by a digest of its URL); validators come from the page's content."""
    pages = _table(spark, sf_dir, "pages")
    digest, drift = F.md5("html"), F.conv(F.substring(F.md5("url"), 1, 6), 16, 10).cast("long") % 2001 - 500
    common = [F.when(F.substring(digest, 1, 1) < "c", digest).alias("etag"), F.lit(None).cast("string").alias("last_modified")]
    field = lambda k, v: (F.lit(k), v)
    response = pages.select(
        (F.col("page_id") * 2).alias("id"), "url", F.col("page_id").alias("ts"), F.lit("response").alias("kind"), *common,
        digest.alias("digest"), F.length("html").cast("long").alias("payload_length"),
        F.create_map(*field("Content-Type", F.lit("text/html")), *field("Date", F.col("page_id").cast("string")), *field("ETag", digest)).alias("headers"),
    )
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("id"), F.concat("url", F.lit("#again")).alias("url"), (F.col("page_id") + drift).alias("ts"),
        F.lit("revisit").alias("kind"), *common, F.when(F.substring(digest, 2, 1) < "c", digest).alias("digest"),
        F.lit(None).cast("long").alias("payload_length"),
        F.create_map(*field("date", (F.col("page_id") + drift).cast("string")), *field("Content-Type", F.lit("none")), *field("Server", F.lit("s"))).alias("headers"),
    )
    found = revisits.resolve(response.union(revisit))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.withColumn("headers", F.array_join(entries, ";"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.detect(_table(spark, sf_dir, "documents"), rules=licenses.RULES)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.scores(_table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


def op7_trigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with trigrams; op7_language_model_scores is held to bigrams (figures in README)."""
    found = language_model.scores(_table(spark, sf_dir, "documents"), order=3)
    return found.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_license_scan": op5_license_scan,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_language_model_scores": op7_language_model_scores,
    "op7_trigram_scores": op7_trigram_scores,
    "op8_url_filter": op8_url_filter,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS width,
    unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM b WHERE len(w) > 0
), dw AS (
  SELECT doc_id, width, unnest(range(1, len(w) - width + 2)) AS pos,
    unnest([array_to_string(w[i : i + width - 1], ' ') FOR i IN range(1, len(w) - width + 2)]) AS win
  FROM d CROSS JOIN (SELECT DISTINCT width FROM bw) WHERE len(w) >= width
), h AS (SELECT doc_id, pos, bw.width, item_id FROM dw JOIN bw ON dw.width = bw.width AND dw.win = bw.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + width)) AS p FROM h) GROUP BY 1),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM h GROUP BY 1
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SCORES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), t AS (SELECT k, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, unnest(list_prepend(NULL, w[:-2])) AS prior FROM d WHERE len(w) > 0),
one AS (SELECT word, count(*) AS n FROM t GROUP BY 1),
two AS (SELECT prior, word, count(*) AS n, count(DISTINCT k) AS holders FROM t WHERE i > 1 GROUP BY 1, 2),
s AS (
  SELECT k, sum(CASE WHEN i = 1 THEN ln(a.n / total) WHEN two.holders >= 2 THEN ln(two.n / b.n) ELSE ln(0.4) + ln(a.n / total) END) AS score
  FROM t JOIN one a USING (word) LEFT JOIN one b ON t.prior = b.word LEFT JOIN two ON t.prior = two.prior AND t.word = two.word,
    (SELECT count(*)::DOUBLE AS total FROM t)
  GROUP BY 1
)
SELECT doc_id, len(w) AS n_tokens, round(coalesce(score, 0), 4) AS log_score, round(score / len(w), 4) AS mean_log_score
FROM d LEFT JOIN s USING (k)
"""

_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5('42:' || doc_id) AS o FROM documents
), s AS (
  SELECT source, sum(size) AS source_size, 3.0::DOUBLE * sum(size) AS cap,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM d GROUP BY 1
), p AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS free,
    sum(source_size) OVER () AS total
  FROM s WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, round(least(cap, weight * max((total - capped) / free) OVER ()), 6) AS target FROM p
), r AS (
  SELECT doc_id, size, source_size, target, floor(target / source_size) AS whole,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      + size / 2 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (SELECT *, least(whole + (middle <= target - whole * source_size)::INT, 3)::BIGINT AS repetitions FROM r)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, (repetitions * size)::BIGINT AS taken, repetitions FROM c
"""

_REVISITS = rf"""
WITH p AS (
  SELECT page_id, url, html, md5(html) AS digest, (('0x' || substr(md5(url), 1, 6))::BIGINT % 2001) - 500 AS drift,
    split_part(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#', 1) AS rest
  FROM pages
), q AS (
  SELECT *, split_part(rest, '?', 1) AS address, split_part(split_part(rest, '?', 1), '/', 1) AS host,
    list_sort(list_filter(string_split(substr(rest, length(split_part(rest, '?', 1)) + 2), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '{revisits.TRACKING}'))) AS params
  FROM p
), c AS (
  SELECT *, regexp_replace(regexp_replace(lower(host), ':(80|443)$', ''), '^www\.', '')
      || regexp_replace(substr(address, length(host) + 1), '/+$', '')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical_url,
    CASE WHEN substr(digest, 1, 1) < 'c' THEN digest END AS etag
  FROM q
), r AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY canonical_url, page_id ORDER BY page_id DESC) = 1),
j AS (
  SELECT v.page_id * 2 + 1 AS id, v.canonical_url, r.page_id AS old, length(r.html) AS payload_length, r.digest AS old_digest,
    v.page_id + v.drift AS at_time,
    coalesce(r.etag = v.etag, r.digest = CASE WHEN substr(v.digest, 2, 1) < 'c' THEN v.digest END) AS agree
  FROM c v ASOF LEFT JOIN r ON v.canonical_url = r.canonical_url AND v.page_id + v.drift > r.page_id
)
SELECT id, canonical_url, old * 2 AS refers_to, payload_length,
  CASE WHEN old IS NULL THEN 'missing' WHEN agree IS NULL THEN 'unverifiable' WHEN agree THEN 'resolved' ELSE 'mismatch' END AS status,
  CASE WHEN agree THEN 'content-type=text/html;date=' || at_time || ';etag=' || old_digest || ';server=s' END AS headers
FROM j
"""


def _values(rows: list[tuple]) -> str:
    quoted = lambda x: "[" + ", ".join(map(quoted, x)) + "]" if isinstance(x, list) else "'" + x + "'"
    return ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)


#: A sentence may be wrapped over pieces; sixteen are more than any in the tables is wrapped over.
_LICENSES = rf"""
WITH known(id, sentence) AS (VALUES {_values(list(licenses.SENTENCES.items()))}),
rules(rule, license, ids) AS (VALUES {_values([(k, *v) for k, v in licenses.RULES.items()])}),
l AS (
  SELECT DISTINCT doc_id, text, [trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) FOR x IN string_split(regexp_replace(text, '([^ \t\r\n][.!?:;])[ \t\r]+', '\1' || chr(10), 'g'), chr(10))] AS pieces
  FROM documents
), s AS (SELECT doc_id, text, pieces, unnest(range(len(pieces))) AS place FROM l),
likely AS (SELECT s.* FROM s WHERE pieces[place + 1] <> '' AND EXISTS (SELECT 1 FROM known WHERE starts_with(sentence, pieces[place + 1]))),
joined AS (SELECT doc_id, text, place, array_to_string(pieces[place + 1 : place + n], ' ') AS sentence FROM likely, range(1, 17) AS r(n) WHERE place + n <= len(pieces)),
found AS (SELECT doc_id, text, place, arg_max(id, length(sentence)) AS id FROM joined JOIN known USING (sentence) GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY place) AS turn FROM found WHERE id <> 'rights-reserved'
  UNION ALL SELECT *, -row_number() OVER (PARTITION BY doc_id, text ORDER BY place) * 100 FROM found WHERE id = 'rights-reserved'),
m AS (
  SELECT a.doc_id, a.text, a.turn, rule, license, len(ids) AS n, min(b.place)::INT AS first_sentence, max(b.place)::INT AS last_sentence,
    list(b.id ORDER BY b.turn) AS found, list(b.place ORDER BY b.turn) AS places, any_value(ids) AS ids
  FROM k a JOIN rules ON a.id = ids[1] JOIN k b ON a.doc_id = b.doc_id AND a.text = b.text AND b.turn BETWEEN a.turn AND a.turn + len(ids) - 1
  GROUP BY ALL
)
SELECT doc_id, rule, license, first_sentence, last_sentence FROM m
WHERE found = ids AND len([1 FOR i IN range(2, len(places) + 1) IF places[i] - places[i - 1] > {licenses.APART}]) = 0
QUALIFY n = max(n) OVER (PARTITION BY doc_id, text, turn)
"""

ORACLE_SQL: dict[str, str] = {
    "op4_warc_revisits": _REVISITS,
    "op5_license_scan": _LICENSES,
    "op3_benchmark_decontamination": _CONTAMINATION,
    "op7_language_model_scores": _SCORES,
    "op9_mixing": _MIXING,
}
