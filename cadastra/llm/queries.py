"""The registered queries of the text operators, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import bpe, exact, infilling, language, licenses, packing, phrases, sharding, simhash, spots, substrings, toxicity, urls
from cadastra.llm.common import hex16

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
SHARDS = 40


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.predict(docs, language.fit(docs))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), RANKS, PATTERN)


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.dedup(table(spark, folder, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex(exact.DIGEST))).drop(exact.DIGEST)


OP5_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = """
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), SHARDS)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.report(table(spark, folder, "documents"))


OP8_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
k AS (SELECT doc_id, j, count(*) OVER x AS size, md5(string_agg(word, ' ') OVER x) AS h FROM t
      WINDOW x AS (PARTITION BY doc_id ORDER BY j ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
f AS (SELECT h, min(doc_id) AS low FROM k WHERE size = 50 GROUP BY h),
c AS (SELECT DISTINCT doc_id, unnest(range(j, j + 50)) AS p FROM k JOIN f USING (h) WHERE size = 50 AND low < doc_id),
r AS (SELECT t.doc_id, count(p) AS gone, string_agg(word, ' ' ORDER BY j) FILTER (WHERE p IS NULL) AS kept
      FROM t LEFT JOIN c ON c.doc_id = t.doc_id AND p = j GROUP BY t.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN r ON r.doc_id = w.doc_id
"""


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op10_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    # A search: every hundredth document is looked up against all.
    asked = F.col("doc_id") % 100 == 0
    return spots.compare_and_link(docs, spots.frequent_words(docs), run=spots.RUN, asked=asked)


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d),
g AS (
  SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) FROM w
  UNION ALL SELECT lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) FROM w),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
o AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
s AS (SELECT c.* FROM c LEFT JOIN o USING (lang, phrase) WHERE NOT coalesce(c.k = 2 AND 100 * o.f >= 50 * c.f, false)),
u AS (SELECT *, unnest(range(1, k)) AS cut FROM s),
p AS MATERIALIZED (SELECT *, lang || '|' || array_to_string(ws[1:cut], ' ') AS one, lang || '|' || array_to_string(ws[cut + 1:], ' ') AS two FROM u),
e AS MATERIALIZED (SELECT lang || '|' || phrase AS key, f FROM f WHERE f >= 10),
x AS (
  SELECT p.*, l.f AS l, r.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * p.f * p.f // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM p JOIN e l ON l.key = one JOIN e r ON r.key = two),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(phrase)) AS rank, phrase, f AS a, l, r,
       CAST(n AS BIGINT) AS n, score
FROM b JOIN n USING (lang)
QUALIFY rank <= 2000
"""


def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op13_infilling(spark: SparkSession, folder: str) -> DataFrame:
    moved = infilling.transform(table(spark, folder, "documents"))
    whole = infilling.restore(F.col("form"), F.col("output"))
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(whole.cast("binary"), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
r AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM r)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_language, op3_byte_bpe, op4_simhash, op5_exact_dedup, op6_url_filter,
        op7_sharding, op8_substring_dedup, op9_toxicity, op10_spot_signatures, op11_phrases, op12_licenses, op13_infilling,
    )
}
ORACLES: dict[str, str] = {
    "op5_exact_dedup": OP5_SQL.strip(), "op6_url_filter": OP6_SQL.strip(), "op8_substring_dedup": OP8_SQL.strip(),
    "op11_phrases": OP11_SQL.strip(), "op13_infilling": OP13_SQL.strip(),
}
