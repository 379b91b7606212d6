"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprints, interaction, language, lines, middle, order, packing, quality, simhash, suffixes, tools, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary that the queries use, an installed public file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.components(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op2_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(_table(spark, sf_dir, "documents"))


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.materialised(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(_table(spark, sf_dir, "documents"))


def op7_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op9_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.linked(*tools.calls_of(_table(spark, sf_dir, "conversations")), tools.SCHEMAS)


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.resolved(warc.records_of(_table(spark, sf_dir, "pages")))
    return rows.withColumn("headers", F.to_json("headers"))


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = language.fit(docs.where(~held_out & F.col("lang").isNotNull()).select("text", "lang"))
    return language.identified(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digests(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_near_dedup": op1_simhash_near_dedup,
        "op2_multiset_fingerprint": op2_multiset_fingerprint,
        "op3_training_order": op3_training_order,
        "op4_bpe_round_trip": op4_bpe_round_trip,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_suffix_array_dedup": op6_suffix_array_dedup,
        "op7_fuzzy_line_dedup": op7_fuzzy_line_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_tool_call_linking": op9_tool_call_linking,
        "op10_warc_revisits": op10_warc_revisits,
        "op11_filter_interaction": op11_filter_interaction,
        "op12_language_id": op12_language_id,
        "op13_fill_in_middle": op13_fill_in_middle,
        "pipeline": pipeline,
    }


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 99, 0))) AS p FROM d)),
f AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w),
g AS (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, true)::INT AS new FROM f WHERE k > 1),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
r AS (SELECT doc_id, run, min(p) AS lo, max(p) + 100 AS hi FROM i GROUP BY doc_id, run),
gaps AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS upto FROM r),
k AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
             string_agg(substr(h, 2 * upto + 1, 2 * (lo - upto)), '' ORDER BY lo) AS kept FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP9_SQL = """
WITH u AS (SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM conversations WHERE role = 'user'),
c AS (SELECT conv_id, turn, text, 'call_' || conv_id || '_' || turn AS call_id,
             row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS layer,
             CASE WHEN conv_id % 7 = 0 THEN 'draw' WHEN turn % 4 = 0 THEN 'search' ELSE 'lookup' END AS name,
             (conv_id + turn) % 3 <> 0 AS has_strict, turn % 2 = 0 AS strict FROM u),
r AS (SELECT conv_id, turn - 1 AS turn, text AS content FROM conversations WHERE role = 'assistant'),
p AS (SELECT c.*, r.content, CASE WHEN name = 'draw' THEN 'unknown_tool' WHEN name = 'search' AND NOT has_strict THEN 'missing:strict'
             WHEN name = 'lookup' AND has_strict THEN 'unexpected' END AS problem FROM c LEFT JOIN r USING (conv_id, turn))
SELECT conv_id, call_id, layer, turn AS position, CASE WHEN content IS NULL THEN 0 ELSE 1 END AS n_results, problem IS NULL AS valid, problem,
       '{"arguments":{"limit":' || turn || ',"query":' || CAST(to_json(text) AS VARCHAR) || CASE WHEN has_strict THEN ',"strict":' || CAST(strict AS VARCHAR) ELSE '' END
       || '},"id":"' || call_id || '","name":"' || name || '","result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS json
FROM p
"""

OP10_SQL = """
WITH b AS (SELECT page_id, html, sha256(html) AS digest, regexp_replace(trim(url), '#.*$', '') AS url FROM pages),
s AS (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
             lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)) AS host,
             regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest FROM b),
q AS (SELECT *, regexp_extract(rest, '^([^?]*)', 1) AS path,
             list_sort(list_filter(string_split(regexp_extract(rest, '\\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_'))) AS parts FROM s),
c AS (SELECT page_id, html, digest, CASE WHEN scheme = '' THEN url ELSE scheme || '://' ||
             CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '') WHEN 'https' THEN regexp_replace(host, ':443$', '') ELSE host END ||
             CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END END AS url FROM q),
m AS (SELECT v.page_id, v.url, v.digest, max(f.page_id) AS best FROM c v JOIN c f ON f.url = v.url AND 60 * f.page_id < 60 * v.page_id + 7000 GROUP BY ALL),
j AS (SELECT m.*, f.digest AS theirs, f.html, CASE WHEN m.page_id % 5 = 0 THEN m.page_id = best ELSE substr(m.digest, 1, 16) = substr(f.digest, 1, 16) END AS same
      FROM m JOIN c f ON f.page_id = best)
SELECT 2 * page_id + 1 AS record_id, url, CASE WHEN same THEN 'resolved' ELSE 'validator_mismatch' END AS status,
       CASE WHEN same THEN 2 * best END AS response_id, CASE WHEN same THEN theirs END AS payload_digest,
       CASE WHEN same THEN '{"cache-control":"max-age=60","content-length":"' || strlen(html) || '","content-type":"text/html","date":"t' || (60 * page_id + 7000)
            || '","etag":"' || CASE WHEN page_id % 5 = 0 THEN '' ELSE 'W/' END || '\\"' || substr(theirs, 1, 16) || '\\"","last-modified":"t' || (60 * best) || '"}' END AS headers
FROM j
"""


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, CASE WHEN t = '' THEN [] ELSE regexp_extract_all(t, '[^\n]*\n|[^\n]+') END AS u,
             CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
n AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    own = {"op6_suffix_array_dedup": OP6_SQL, "op9_tool_call_linking": OP9_SQL, "op10_warc_revisits": OP10_SQL,
           "op11_filter_interaction": interaction.SQL, "op13_fill_in_middle": OP13_SQL}
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
