"""The registered query of each operator: it applies the operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import spread
from .decontaminate import contaminated
from .embedding_dup import link_embeddings
from .langid import predict_language
from .line_dedup import dedup_lines
from .mix import mix
from .near_dup import near_duplicates
from .pii import find_pii
from .secrets import find_secrets
from .toxicity import score_toxicity
from .warc import page_records, resolve_revisits


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents to the source targets."""
    return mix(_docs(spark, sf_dir)).withColumn("target", F.round("target", 6))


OP1_SQL = r"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  ('0x' || substr(md5('20|' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))), 1, 15))::BIGINT AS key FROM documents),
w AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w, sum(size)::DOUBLE * 2 AS cap FROM s GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * w) AS target FROM l),
b AS (SELECT s.*, source_size, target, floor(target)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
  coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken FROM b
"""


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_pii(_docs(spark, sf_dir))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items found in all documents."""
    return contaminated(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return predict_language(_docs(spark, sf_dir))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of all pages; see warc.page_records for the crawl they stand for."""
    out = resolve_revisits(page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select("record_id", "canon", "response_id", "resolved", "reason", F.array_join(entries, "; ").alias("headers"))


OP5_SQL = r"""
WITH cut AS (SELECT page_id, md5(coalesce(html, '')) AS md5, regexp_replace(regexp_replace(trim(url, ' '), '#.*$', ''), '^(?i)https?://', '') AS bare FROM pages),
split AS (SELECT *, CASE WHEN strpos(bare, '?') > 0 THEN left(bare, strpos(bare, '?') - 1) ELSE bare END AS place,
  CASE WHEN strpos(bare, '?') > 0 THEN substr(bare, strpos(bare, '?') + 1) ELSE '' END AS q FROM cut),
parts AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(place, '^[^/]*')), '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
  regexp_replace(regexp_extract(place, '/.*$'), '/+$', '') AS path,
  array_to_string(list_sort(list_filter(string_split(q, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?i)(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid)(=|$)'))), '&') AS query FROM split),
p AS (SELECT page_id, md5, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canon,
  CASE WHEN page_id % 7 <> 3 THEN '"' || md5 || '"' END AS etag, CASE WHEN page_id % 7 <> 3 THEN page_id // 10 END AS modified, CASE WHEN page_id % 5 <> 4 THEN md5 END AS digest FROM parts),
joined AS (SELECT v.*, r.page_id AS rid, r.etag AS r_etag, r.modified AS r_modified, r.digest AS r_digest FROM p v
  ASOF LEFT JOIN p r ON v.canon = r.canon AND v.page_id + 100000 >= r.page_id),
verdict AS (SELECT *, CASE WHEN coalesce(canon, '') = '' THEN 'no url' WHEN rid IS NULL THEN 'no earlier response'
  WHEN etag IS NOT NULL AND r_etag IS NOT NULL THEN CASE WHEN etag <> r_etag THEN 'validators differ' END
  WHEN modified IS NOT NULL AND r_modified IS NOT NULL THEN CASE WHEN modified <> r_modified THEN 'validators differ' END
  WHEN digest IS NOT NULL AND r_digest IS NOT NULL THEN CASE WHEN digest <> r_digest THEN 'validators differ' END
  ELSE 'no validator' END AS reason FROM joined)
SELECT page_id * 2 + 1 AS record_id, canon, CASE WHEN reason IS DISTINCT FROM 'no url' THEN rid * 2 END AS response_id, reason IS NULL AS resolved, reason,
  CASE WHEN reason IS NULL THEN 'content-type=text/html; date=again' || page_id || '; x-cache=full' ELSE 'date=again' || page_id END AS headers
FROM verdict
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return score_toxicity(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(_docs(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their later repeated runs; the text as its length and MD5."""
    out = dedup_lines(_docs(spark, sf_dir))
    return out.select("doc_id", "n_runs", "n_deleted", F.length("text").cast("long").alias("n_chars_left"), F.md5("text").alias("text_md5"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return find_secrets(_docs(spark, sf_dir))


def queries() -> dict:
    return {f.__name__: f for f in (op1_mix_sources, op2_pii, op3_decontaminate, op4_language, op5_warc_revisits, op6_toxicity, op7_minhash_near_dedup, op8_line_dedup, op9_embedding_near_dedup, op10_secrets)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": OP1_SQL, "op5_warc_revisits": OP5_SQL}
