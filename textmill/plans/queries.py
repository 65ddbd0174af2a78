"""Registered queries of the corpus rules, each over its whole tables, and the DuckDB SQL they are held against."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import prompts, vocab
from textmill.functions import text as T
from textmill.operators import dedup, filters, generators, qa, rewrite, scoring
from textmill.operators._store import shared_dir, spread, stored
from textmill.plans import fixtures, pipeline
from textmill.sources import jsonl


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/documents.parquet"))


def _clean(spark: SparkSession, d: str, inline: bool = True) -> DataFrame:
    """(id, text, stripped, cleaned_text) of documents and, mostly, the inline texts."""
    rows = _docs(spark, d).select(F.col("doc_id").alias("id"), "text")
    return filters.clean(rows.unionByName(spark.sql(fixtures.TEXTS_SQL).select(F.col("id").cast("long"), "text")) if inline else rows)


# ---- the rules in DuckDB's SQL ----
def _sql_any(t: str, words) -> str:
    return "(" + " OR ".join(f"contains({t}, {fixtures.literal(w)})" for w in dict.fromkeys(words)) + ")"


def _sql_count(t: str, word: str) -> str:
    return f"((length({t}) - length(replace({t}, {fixtures.literal(word)}, ''))) // {len(word)})"


def _sql_unit(key: str, seed: int, salt: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {key}, '{salt}')), 1, 8))::BIGINT / 4294967296.0)"


def _strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '{T.EDGES}', '', 'g')"


def _normal(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{T.BLANKS}', ' ', 'g'), '^ +| +$', '', 'g')"


def _sql_clean(inline: bool = True) -> str:
    more = f" UNION ALL SELECT id, text, NULL FROM ({fixtures.TEXTS_SQL})" if inline else ""
    return (
        f"WITH base AS (SELECT doc_id AS id, text, lang FROM documents{more}), "
        f"stripped AS (SELECT *, {_strip('text')} AS s FROM base), c AS (SELECT *, {_normal('s')} AS t FROM stripped)"
    )


_SENSITIVE = "(" + _sql_any("t", [w for g in vocab.SENSITIVE.values() for w in g]) + " OR " + " OR ".join(f"regexp_matches(t, '(?i){p}')" for p in vocab.SENSITIVE_PATTERNS) + ")"
_COLLOQUIAL = "(" + _sql_any("t", vocab.COLLOQUIAL) + " OR " + " OR ".join(f"regexp_matches(t, '{p}')" for p in (vocab.PUNCTUATION_RUN, *vocab.COLLOQUIAL_PATTERNS)) + ")"
_ACADEMIC = "regexp_matches(t, '" + "|".join(vocab.ACADEMIC_PATTERNS) + "')"
_REASON = f"CASE WHEN length(s) < 8 OR length(s) > 12000 THEN 'length' WHEN t = '' THEN 'empty' WHEN {_SENSITIVE} THEN 'sensitive' WHEN {_COLLOQUIAL} THEN 'colloquial' END"
_CLASSIC_N = "(" + " + ".join(_sql_count("t", w) for w in vocab.CLASSIC) + ")"
_CLASSIC = f"CASE WHEN {_sql_any('t', vocab.MODERN)} OR t = '' THEN false ELSE {_CLASSIC_N} / length(t) > 0.02 OR regexp_matches(t, '{vocab.CLASSIC_PATTERN}') END"


def _redundancy(t: str) -> str:
    return f"CASE WHEN length({t}) > 0 THEN (length({t}) - length(regexp_replace({t}, '[{vocab.REDUNDANT_CHARS}]', '', 'g'))) / length({t}) ELSE 0.0 END"


def _qtype(t: str) -> str:
    cases = " ".join(f"WHEN {_sql_any(t, w)} THEN '{k}'" for k, w in vocab.QUESTION_TYPES.items())
    return f"CASE {cases} WHEN {_sql_any(t, vocab.CALCULATE_SIGNS)} AND regexp_matches({t}, '{T.DIGIT}') THEN 'calculate' ELSE 'fallback' END"


_SCORES = f"""{_sql_clean()},
chars AS (SELECT id, regexp_extract_all(t, '(?s).') AS x FROM c),
grams AS (SELECT id, x[i] AS c1, x[i + 1] AS c2, count(*) AS n FROM (SELECT id, x, unnest(range(1, len(x))) AS i FROM chars) GROUP BY ALL),
pairs AS (SELECT c1, c2, sum(n)::BIGINT AS n12 FROM grams GROUP BY ALL), heads AS (SELECT c1, sum(n12)::BIGINT AS n1 FROM pairs GROUP BY ALL), voc AS (SELECT count(DISTINCT c2) AS v FROM pairs),
lnp AS (SELECT c1, c2, ln((n12 + 0.5::DOUBLE) / (n1 + 0.5::DOUBLE * v)) AS p FROM pairs JOIN heads USING (c1), voc),
score AS (SELECT id, exp(-sum(n * p) / sum(n)) AS ppl FROM grams JOIN lnp USING (c1, c2) GROUP BY id),
scored AS (SELECT c.id, text, s, t, round(coalesce(ppl, 'inf'::DOUBLE), 6) AS ppl, CASE WHEN {_CLASSIC} THEN 'classic_chinese' ELSE 'modern_chinese' END AS kind FROM c LEFT JOIN score USING (id)),
lim AS (SELECT coalesce(quantile_cont(ppl, 0.9) FILTER (kind = 'modern_chinese' AND ppl < 15000 AND length(t) >= 8), 100.0) AS tm,
  coalesce(quantile_cont(ppl, 0.1) FILTER (kind = 'classic_chinese' AND ppl < 15000 AND length(t) >= 8), 30.0) AS tc FROM scored)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    # rounded, so that a threshold that is a text's own score compares alike in any order of summation
    df = scoring.bigram_perplexity(_clean(spark, d), key="id").withColumn("perplexity", F.round("perplexity", 6))
    return stored(df.withColumn("text_type", T.text_type(F.col("cleaned_text"))), "scored")


def clean_length_profile(spark, d):
    df = filters.clean(_docs(spark, d)).withColumn("drop_reason", filters.drop_reason())
    n = F.length("cleaned_text")
    return df.groupBy("lang", F.when(F.col("drop_reason").isin("length", "empty"), F.col("drop_reason")).otherwise("kept").alias("drop_reason")).agg(
        F.count(F.lit(1)).alias("records"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.sum(n).alias("chars")
    )


def exact_dedup(spark, d):
    df = _clean(spark, d, False).withColumn("md5", F.md5("cleaned_text"))
    return dedup.exact_dedup(df.select("id", "md5"), "id")


def keyword_flags(spark, d):
    t = F.col("cleaned_text")
    return _clean(spark, d).select("id", T.is_sensitive(t).alias("sensitive"), T.is_colloquial(t).alias("colloquial"), T.has_academic_features(t).alias("academic"))


def drop_reason_counts(spark, d):
    df = filters.filter_records(_clean(spark, d).drop("stripped", "cleaned_text"))
    return filters.drop_counts(dedup.mark_duplicates(df.select("id", "md5", "drop_reason"), "id"))


def retention(spark, d):
    df = filters.filter_records(_clean(spark, d).drop("stripped", "cleaned_text"))
    return filters.retention(dedup.mark_duplicates(df.select("id", "md5", "drop_reason"), "id"))


def type_counts(spark, d):
    df = filters.filter_records(_clean(spark, d).drop("stripped", "cleaned_text")).withColumn("text_type", T.text_type(F.col("cleaned_text")))
    return filters.tallies(dedup.mark_duplicates(df.select("id", "md5", "drop_reason", "text_type"), "id").where("drop_reason is null"), "text_type")


def text_type(spark, d):
    t = F.col("cleaned_text")
    return _clean(spark, d).select("id", T.classic_count(t).cast("long").alias("classic_count"), T.text_type(t).alias("text_type"))


def redundancy_ratio(spark, d):
    return _clean(spark, d).select("id", F.round(T.redundancy(F.col("cleaned_text")), 9).alias("redundancy"))


def _signed(spark, d):
    return dedup.signatures(_clean(spark, d), key="id")


def bigram_signature(spark, d):
    return _signed(spark, d).select("id", F.md5(F.array_join(F.transform("signature", lambda v: v.cast("string")), ",")).alias("signature_md5"))


def lsh_buckets(spark, d):
    return dedup.buckets(_signed(spark, d), key="id")


def near_dedup(spark, d):
    return dedup.near_dedup(_clean(spark, d), key="id").select("id")


def char_bigram_perplexity(spark, d):
    return scoring.bigram_perplexity(_clean(spark, d), key="id").select("id", F.round("perplexity", 6).alias("perplexity"))


def perplexity_thresholds(spark, d):
    return scoring.thresholds(_scored(spark, d)).select(*[F.round(c, 6).alias(c) for c in ("modern_threshold", "classic_threshold")])


def perplexity_percentiles(spark, d):
    df = scoring.percentiles(_scored(spark, d))
    return df.select("text_type", F.posexplode("p").alias("point", "value")).select("text_type", "point", F.round("value", 6).alias("value"))


def perplexity_histogram(spark, d):
    return scoring.histogram(_scored(spark, d))


def perplexity_keep(spark, d):
    df = _scored(spark, d)
    return scoring.layered_keep(df, scoring.thresholds(df)).select("id", "text_type", "keep")


def rewrite_routing(spark, d):
    df = _scored(spark, d)
    return rewrite.route(df, rewrite.threshold(df), key="id").select("id", "needs_rewrite", "rewrite_reason")


def rewrite_prompts(spark, d):
    df = _scored(spark, d)
    df = rewrite.route(df, rewrite.threshold(df), key="id").where("needs_rewrite")
    return df.select("id", F.md5(rewrite.prompt()).alias("prompt_md5"))


def _rewrites(spark, d):
    """Stated rewrites and one of every document, written by rule."""
    return spark.sql(fixtures.REWRITES_SQL).unionByName(_docs(spark, d).selectExpr(*fixtures.REWRITES_OF_DOCS))


def rewrite_quality(spark, d):
    return rewrite.judged(_rewrites(spark, d)).select(F.col("id").cast("long"), "status", "reason", "orig_perplexity", "rew_perplexity")


def rewrite_tallies(spark, d):
    return filters.tallies(rewrite.judged(_rewrites(spark, d)), "rewrite_reason", "status")


def question_type(spark, d):
    return _clean(spark, d).select("id", T.question_type(F.col("cleaned_text")).alias("question_type"))


def qa_prompts(spark, d):
    out = qa.requests(qa.source(_clean(spark, d)))
    return out.select("id", "attempt", "question_type", "prompt_key", "template", F.md5("prompt").alias("prompt_md5"))


def _parsed(spark, d):
    """Stated outputs and two of every document, written by rule."""
    made = _docs(spark, d).withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1)))).selectExpr(*fixtures.OUTPUTS_OF_DOCS)
    df = spark.sql(fixtures.OUTPUTS_SQL).unionByName(made).withColumn("p", qa.parsed(F.col("output"))).select("id", "attempt", "batch_id", "p.question", "p.answer")
    return df.withColumn("fail_reason", qa.fail_reason())


def qa_parse_validate(spark, d):
    return _parsed(spark, d).select(F.col("id").cast("long"), F.col("attempt").cast("long"), F.md5("question").alias("question"), F.md5("answer").alias("answer"), F.md5("fail_reason").alias("fail_reason"))


def qa_batch_dedup(spark, d):
    return qa.deduped(_parsed(spark, d)).select(F.col("id").cast("long"), F.col("attempt").cast("long"), F.md5("fail_reason").alias("fail_reason"))


def qa_global_dedup(spark, d):
    return qa.deduped(_parsed(spark, d), qa.QaConfig(dedup="global")).select(F.col("id").cast("long"), F.col("attempt").cast("long"), F.md5("fail_reason").alias("fail_reason"))


def qa_tallies(spark, d):
    kind = F.when(F.col("fail_reason").isNull(), "success").otherwise(F.regexp_extract("fail_reason", "^[^(:：]*", 0))
    return filters.tallies(qa.deduped(_parsed(spark, d)).withColumn("status", kind), "status")


def qa_batches(spark, d):
    out = qa.batches(qa.requests(qa.source(_clean(spark, d))))
    return out.select("id", "attempt", F.col("batch_id").cast("long"), F.col("seq").cast("long"))


def hash_sample(spark, d):
    return filters.hash_sample(_docs(spark, d).select("doc_id"), "doc_id", 0.3, seed=7)


def embedding_cosine(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(T.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


def jsonl_round_trip(spark, d):
    path = f"{shared_dir(spark)}/textmill/{uuid.uuid4().hex}-jsonl"
    lines = _docs(spark, d).select(F.to_json(F.struct("doc_id", "text", "lang"), {"ignoreNullFields": "false"}).alias("value"))
    lines.select("value").write.text(path)
    folder = spark.read.text(path)
    good = jsonl.parse_lines(folder.withColumn("source_file", F.lit("documents.jsonl")))
    return good.where("not malformed").groupBy(F.md5("text").alias("text_md5")).agg(F.count(F.lit(1)).alias("records"))


def jsonl_accounting(spark, d):
    """Documents as JSON lines, some of them spoilt by rule, counted by whether they are well formed."""
    whole = F.to_json(F.struct("doc_id", "text"), {"ignoreNullFields": "false"})
    line = F.expr("CASE pmod(doc_id, 13) WHEN 0 THEN left(w, length(w) - 1) WHEN 1 THEN '[' || w || ']' WHEN 2 THEN '   ' WHEN 3 THEN '{\"doc_id\":1}' WHEN 4 THEN '{\"text\":7}' WHEN 5 THEN '\"text\"' ELSE w END")
    lines = _docs(spark, d).withColumn("w", whole).select(line.alias("value"), F.concat(F.lit("part-"), F.pmod("doc_id", F.lit(3)), F.lit(".jsonl")).alias("source_file"))
    return jsonl.accounting(jsonl.parse_lines(lines))


def _rounded_scorer(df, key="doc_id"):
    # rounded, so that a threshold that is a text's own score compares alike in any order of summation
    return scoring.bigram_perplexity(df, key=key).withColumn("perplexity", F.round("perplexity", 6))


def stage1_decisions(spark, d):
    docs = _clean(spark, d).select(F.col("id").alias("doc_id"), "text")
    out = pipeline.decide(docs, scorer=_rounded_scorer)
    return out.select("doc_id", F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason"), "text_type", "perplexity")


def all_stages(spark, d):
    """The three stages with the test generators."""
    say = generators.template(F.concat(F.lit("问题：文中说了什么？答案："), F.col("source_text")))
    new = generators.template(F.concat(F.lit("因为"), F.translate("original_text", vocab.REDUNDANT_CHARS, "")))
    docs = _clean(spark, d).select(F.col("id").alias("doc_id"), "text")
    return pipeline.run(docs, new, say)["qa"]


_SIGNATURE = f"""{_sql_clean()},
coef AS (SELECT k, ('0x' || substr(md5('a' || k), 1, 7))::BIGINT + 1 AS a, ('0x' || substr(md5('b' || k), 1, 7))::BIGINT AS b FROM (SELECT unnest(range(0, 128)) AS k)),
chars AS (SELECT id, t, regexp_extract_all(t, '(?s).') AS x FROM c),
grams AS (SELECT DISTINCT id, x[i] || x[i + 1] AS g FROM (SELECT id, x, unnest(range(1, len(x))) AS i FROM chars) UNION ALL SELECT id, t FROM chars WHERE length(t) = 1),
sig AS (SELECT id, k, min((a * h + b) % 2147483647) AS v FROM (SELECT id, ('0x' || substr(md5(g), 1, 7))::BIGINT AS h FROM grams), coef GROUP BY id, k)"""
_KEEP = "CASE WHEN kind = 'classic_chinese' THEN ppl >= tc AND ppl < 10000 ELSE ppl <= tm AND ppl < 5000 END"
_ROUTED = f"""{_SCORES},
rl AS (SELECT coalesce(quantile_cont(ppl, 0.8) FILTER (kind = 'modern_chinese' AND ppl > 0), 800.0) AS rt FROM scored),
o AS (SELECT *, {_strip("substr(coalesce(text, ''), 1, 11800)")} AS ot FROM scored, rl),
routed AS (SELECT *, CASE WHEN ot = '' THEN NULL WHEN kind = 'classic_chinese' THEN '古文' WHEN ppl > rt THEN 'high_perplexity' WHEN {_redundancy('ot')} > 0.2 THEN 'redundant'
  WHEN kind = 'modern_chinese' AND length(ot) < 150 AND NOT {_sql_any('ot', vocab.LOGIC)} AND {_sql_unit('id', 0, 'logic')} < 0.1 THEN 'add_logic_chain' ELSE '无需改写' END AS reason FROM o)"""
_FORMS = "CASE " + " ".join(f"WHEN prompt_key = '{k}' AND template = {i} THEN {fixtures.literal(p)}" for k, v in prompts.QA.items() for i, p in enumerate(v)) + " END"
_SIZES = "CASE prompt_key " + " ".join(f"WHEN '{k}' THEN {len(v)}" for k, v in prompts.QA.items()) + " END"
_KEYS = "CASE question_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.TEMPLATE_OF.items()) + " END"
_REQUESTS = f"""{_sql_clean()}, src AS (SELECT id, substr({_strip("nullif(text, '')")}, 1, 1600) AS st FROM base),
req AS (SELECT *, {_KEYS} AS prompt_key FROM (SELECT id, st, unnest(range(0, 3)) AS attempt, {_qtype('st')} AS question_type FROM src WHERE st <> '')),
pick AS (SELECT *, floor({_sql_unit("concat_ws(':', id, attempt)", 0, 'template')} * ({_SIZES}))::INT AS template FROM req)"""
_JUDGED = f"""CASE WHEN coalesce(rewritten_text, '') = '' OR contains(rewritten_text, '改写失败') THEN '生成空结果或失败'
  WHEN rewrite_reason = 'add_logic_chain' AND NOT {_sql_any('rewritten_text', vocab.LOGIC)} THEN '未注入逻辑链'
  WHEN rewrite_reason = 'add_logic_chain' AND similarity < 0.7 THEN printf('相似度过低(%.2f)', similarity)
  WHEN similarity < 0.7 THEN printf('相似度低(%.2f)', similarity)
  WHEN rewrite_reason = 'high_perplexity' AND rew_ppl >= perplexity * 0.9 THEN printf('困惑度未降(%.0f)', rew_ppl)
  WHEN rewrite_reason = 'redundant' AND {_redundancy('rewritten_text')} >= {_redundancy('original_text')} THEN printf('冗余未降(%.2f)', {_redundancy('rewritten_text')}) END"""
def _greedy(rows: str, order: str) -> str:
    """CTEs that go through the texts of `rows` (id, t) one after the other: kept holds the ids of those that share no
    bucket with one kept before. A step carries the buckets taken and the ids kept so far."""
    return f"""coef AS (SELECT k, ('0x' || substr(md5('a' || k), 1, 7))::BIGINT + 1 AS a, ('0x' || substr(md5('b' || k), 1, 7))::BIGINT AS b FROM (SELECT unnest(range(0, 128)) AS k)),
gc AS (SELECT id, t, regexp_extract_all(t, '(?s).') AS x FROM {rows}),
gg AS (SELECT DISTINCT id, x[i] || x[i + 1] AS g FROM (SELECT id, x, unnest(range(1, len(x))) AS i FROM gc) UNION ALL SELECT id, t FROM gc WHERE length(t) = 1),
gs AS (SELECT id, k, min((a * h + b) % 2147483647) AS v FROM (SELECT id, ('0x' || substr(md5(g), 1, 7))::BIGINT AS h FROM gg), coef GROUP BY id, k),
gb AS (SELECT id, k // 5 AS band, md5(string_agg(v::VARCHAR, ',' ORDER BY k)) AS bucket FROM gs WHERE k < 125 GROUP BY id, k // 5),
go AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY {order}) AS n, list(hash(band, bucket)) AS own FROM gb GROUP BY id),
walk AS (SELECT 0::BIGINT AS n, []::UBIGINT[] AS taken, NULL::BIGINT AS keeps UNION ALL
  SELECT w.n + 1, CASE WHEN list_has_any(w.taken, o.own) THEN w.taken ELSE list_concat(w.taken, o.own) END, CASE WHEN list_has_any(w.taken, o.own) THEN NULL ELSE o.id END FROM walk w JOIN go o ON o.n = w.n + 1),
greedy AS MATERIALIZED (SELECT keeps AS id FROM walk WHERE keeps IS NOT NULL UNION ALL SELECT id FROM {rows} WHERE t = '')"""


_PAIR = """WITH o AS (SELECT *, strpos(output, '问题：') AS q, strpos(output, '答案：') AS a FROM (%s)),
x AS (SELECT *, %s AS qt, %s AS ans FROM o),
p AS (SELECT id, attempt, batch_id,
  CASE WHEN length(output) - length(replace(output, '问题：', '')) > 3 OR output IS NULL OR q = 0 OR a <= q THEN NULL ELSE qt END AS question,
  CASE WHEN length(output) - length(replace(output, '问题：', '')) > 3 THEN '解析失败: 输出包含多个QA对' WHEN output IS NULL OR q = 0 OR a <= q THEN '解析失败: 结构不符'
    WHEN ans = '' OR contains(ans, '...') THEN '解析失败: 答案为空或未完成' ELSE ans END AS answer FROM x),
v AS (SELECT *, CASE WHEN coalesce(question, '') = '' THEN coalesce(nullif(answer, ''), '解析失败: 未找到问题') WHEN contains(answer, '解析失败:') THEN answer WHEN NOT contains(question, '？') THEN '问题缺少问号'
  WHEN length(question) NOT BETWEEN 5 AND 400 THEN '问题长度异常(' || length(question) || ')' WHEN length(answer) NOT BETWEEN 4 AND 2000 THEN '答案长度异常(' || length(answer) || ')' END AS fail_reason FROM p)""" % (
    f"{fixtures.OUTPUTS_SQL} UNION ALL SELECT {', '.join(fixtures.OUTPUTS_OF_DOCS)} FROM documents, (SELECT unnest([0, 1]) AS attempt)", _strip("substr(output, q + 3, a - q - 3)"), _strip("substr(output, a + 3)"))
_MARKED = f"""{_sql_clean()}, r AS (SELECT id, md5(t) AS md5, {_REASON} AS reason FROM c),
m AS (SELECT id, md5, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY md5, reason IS NULL ORDER BY id) > 1 THEN 'md5_duplicate' ELSE reason END AS reason FROM r)"""

def _DEDUPED(group: str) -> str:
    return f", dd AS (SELECT id, attempt, CASE WHEN fail_reason IS NULL AND row_number() OVER (PARTITION BY fail_reason IS NULL, {group} ORDER BY id, attempt) > 1 THEN '批次内重复' ELSE fail_reason END AS why FROM v)"


_REWRITTEN = f"WITH r0 AS (SELECT * FROM ({fixtures.REWRITES_SQL}) UNION ALL SELECT {', '.join(fixtures.REWRITES_OF_DOCS)} FROM documents), r AS (SELECT *, {_JUDGED} AS why FROM r0)"
_STAGE1 = f"""{_sql_clean().replace('WITH ', 'WITH RECURSIVE ', 1)}, r AS (SELECT id, t, md5(t) AS md5, {_REASON} AS reason FROM c),
m AS MATERIALIZED (SELECT id, t, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY md5, reason IS NULL ORDER BY id) > 1 THEN 'md5_duplicate' ELSE reason END AS reason FROM r),
passed AS MATERIALIZED (SELECT id, t FROM m WHERE reason IS NULL), {_greedy('passed', 'id')},
left_ AS MATERIALIZED (SELECT id, t, CASE WHEN {_CLASSIC} THEN 'classic_chinese' ELSE 'modern_chinese' END AS kind FROM passed JOIN greedy USING (id)),
chars AS (SELECT id, regexp_extract_all(t, '(?s).') AS x FROM left_),
grams AS (SELECT id, x[i] AS c1, x[i + 1] AS c2, count(*) AS n FROM (SELECT id, x, unnest(range(1, len(x))) AS i FROM chars) GROUP BY ALL),
pairs AS (SELECT c1, c2, sum(n)::BIGINT AS n12 FROM grams GROUP BY ALL), heads AS (SELECT c1, sum(n12)::BIGINT AS n1 FROM pairs GROUP BY ALL), voc AS (SELECT count(DISTINCT c2) AS v FROM pairs),
lnp AS (SELECT c1, c2, ln((n12 + 0.5::DOUBLE) / (n1 + 0.5::DOUBLE * v)) AS p FROM pairs JOIN heads USING (c1), voc),
score AS (SELECT id, exp(-sum(n * p) / sum(n)) AS ppl FROM grams JOIN lnp USING (c1, c2) GROUP BY id),
scored AS MATERIALIZED (SELECT id, t, kind, round(coalesce(ppl, 'inf'::DOUBLE), 6) AS ppl FROM left_ LEFT JOIN score USING (id)),
lim AS (SELECT coalesce(quantile_cont(ppl, 0.9) FILTER (kind = 'modern_chinese' AND ppl < 15000 AND length(t) >= 8), 100.0) AS tm,
  coalesce(quantile_cont(ppl, 0.1) FILTER (kind = 'classic_chinese' AND ppl < 15000 AND length(t) >= 8), 30.0) AS tc FROM scored)"""

SQL = {
    "clean_length_profile": f"{_sql_clean(False)} SELECT lang, CASE WHEN length(s) < 8 OR length(s) > 12000 THEN 'length' WHEN t = '' THEN 'empty' ELSE 'kept' END AS drop_reason, count(*) AS records, min(length(t)) AS shortest, max(length(t)) AS longest, sum(length(t))::BIGINT AS chars FROM c GROUP BY ALL",
    "exact_dedup": f"{_sql_clean(False)} SELECT min(id) AS id, md5(t) AS md5 FROM c GROUP BY md5(t)",
    "keyword_flags": f"{_sql_clean()} SELECT id, {_SENSITIVE} AS sensitive, {_COLLOQUIAL} AS colloquial, {_ACADEMIC} AS academic FROM c",
    "drop_reason_counts": f"{_MARKED} SELECT coalesce(reason, 'kept') AS drop_reason, count(*) AS records FROM m GROUP BY 1",
    "retention": f"{_MARKED}, n AS (SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS kept FROM m) SELECT total, kept, kept / total AS ratio, CASE WHEN kept / total < 0.45 THEN 'loosen' WHEN kept / total > 0.55 THEN 'tighten' ELSE 'in band' END AS advice FROM n",
    "text_type": f"{_sql_clean()} SELECT id, {_CLASSIC_N}::BIGINT AS classic_count, CASE WHEN {_CLASSIC} THEN 'classic_chinese' ELSE 'modern_chinese' END AS text_type FROM c",
    "redundancy_ratio": f"{_sql_clean()} SELECT id, round({_redundancy('t')}, 9) AS redundancy FROM c",
    "bigram_signature": f"{_SIGNATURE} SELECT id, md5(string_agg(v::VARCHAR, ',' ORDER BY k)) AS signature_md5 FROM c LEFT JOIN sig USING (id) GROUP BY id",
    "lsh_buckets": f"{_SIGNATURE} SELECT id, (k // 5)::INT AS band, md5(string_agg(v::VARCHAR, ',' ORDER BY k)) AS bucket FROM sig WHERE k < 125 GROUP BY id, k // 5",
    "char_bigram_perplexity": f"{_SCORES} SELECT id, round(ppl, 6) AS perplexity FROM scored",
    "perplexity_thresholds": f"{_SCORES} SELECT round(tm, 6) AS modern_threshold, round(tc, 6) AS classic_threshold FROM lim",
    "perplexity_percentiles": f"{_SCORES}, q AS (SELECT kind, quantile_cont(ppl, [{', '.join(map(str, scoring.POINTS))}]) AS p FROM scored WHERE ppl < 15000 AND length(t) >= 8 GROUP BY kind) SELECT kind AS text_type, (unnest(range(1, 11)) - 1)::INT AS point, round(unnest(p), 6) AS value FROM q",
    "perplexity_histogram": f"{_SCORES}, top AS (SELECT max(ppl) AS m FROM scored WHERE ppl < 15000) SELECT kind AS text_type, least(floor(ppl / m * 50), 49)::INT AS bin, count(*) AS records FROM scored, top WHERE ppl < 15000 GROUP BY ALL",
    "perplexity_keep": f"{_SCORES} SELECT id, kind AS text_type, {_KEEP} AS keep FROM scored, lim",
    "rewrite_routing": f"{_ROUTED} SELECT id, coalesce(reason IN ('high_perplexity', 'redundant', 'add_logic_chain'), false) AS needs_rewrite, reason AS rewrite_reason FROM routed",
    "rewrite_prompts": f"{_ROUTED} SELECT id, md5(replace(CASE reason " + " ".join(f"WHEN '{k}' THEN {fixtures.literal(p)}" for k, p in prompts.REWRITE.items()) + " END, '{text}', ot)) AS prompt_md5 FROM routed WHERE reason IN ('high_perplexity', 'redundant', 'add_logic_chain')",
    "rewrite_quality": f"{_REWRITTEN} SELECT id::BIGINT AS id, CASE WHEN why IS NULL THEN 'success' ELSE 'failed' END AS status, coalesce(why, CASE WHEN rewrite_reason = 'add_logic_chain' THEN 'logic_injected' ELSE '合格' END) AS reason, CASE WHEN rewrite_reason = 'high_perplexity' THEN perplexity END AS orig_perplexity, CASE WHEN (rewrite_reason = 'high_perplexity' OR rewrite_reason = 'add_logic_chain' AND why IS NULL) AND coalesce(rewritten_text, '') <> '' AND rew_ppl <> 0 AND coalesce(why, '') NOT LIKE '相似度%' THEN rew_ppl END AS rew_perplexity FROM r",
    "rewrite_tallies": f"{_REWRITTEN} SELECT rewrite_reason, CASE WHEN why IS NULL THEN 'success' ELSE 'failed' END AS status, count(*) AS records FROM r GROUP BY ALL",
    "type_counts": f"{_MARKED} SELECT CASE WHEN {_CLASSIC} THEN 'classic_chinese' ELSE 'modern_chinese' END AS text_type, count(*) AS records FROM m JOIN c USING (id) WHERE reason IS NULL GROUP BY 1",
    "near_dedup": f"{_sql_clean().replace('WITH ', 'WITH RECURSIVE ', 1)}, {_greedy('c', 'id')} SELECT id FROM greedy",
    "jsonl_accounting": "SELECT 'part-' || doc_id % 3 || '.jsonl' AS source_file, doc_id % 13 IN (0, 1, 4, 5) OR doc_id % 13 > 5 AND text IS NULL AS malformed, count(*) AS lines FROM documents WHERE doc_id % 13 <> 2 GROUP BY ALL",
    "stage1_decisions": f"{_STAGE1} SELECT m.id AS doc_id, CASE WHEN reason IS NOT NULL THEN reason WHEN scored.id IS NULL THEN 'near_duplicate' WHEN NOT ({_KEEP}) THEN 'perplexity' ELSE 'kept' END AS drop_reason, kind AS text_type, ppl AS perplexity FROM m LEFT JOIN scored ON m.id = scored.id, lim",
    "question_type": f"{_sql_clean()} SELECT id, {_qtype('t')} AS question_type FROM c",
    "qa_prompts": f"{_REQUESTS} SELECT id, attempt::INT AS attempt, question_type, prompt_key, template, md5(replace({_FORMS}, '{{text}}', st)) AS prompt_md5 FROM pick",
    "qa_parse_validate": f"{_PAIR} SELECT id::BIGINT AS id, attempt::BIGINT AS attempt, md5(question) AS question, md5(answer) AS answer, md5(fail_reason) AS fail_reason FROM v",
    "qa_batch_dedup": f"{_PAIR}{_DEDUPED('question, answer, batch_id')} SELECT id::BIGINT AS id, attempt::BIGINT AS attempt, md5(why) AS fail_reason FROM dd",
    "qa_global_dedup": f"{_PAIR}{_DEDUPED('question, answer')} SELECT id::BIGINT AS id, attempt::BIGINT AS attempt, md5(why) AS fail_reason FROM dd",
    "qa_tallies": f"{_PAIR}{_DEDUPED('question, answer, batch_id')} SELECT CASE WHEN why IS NULL THEN 'success' ELSE regexp_extract(why, '^[^(:：]*') END AS status, count(*) AS records FROM dd GROUP BY 1",
    "qa_batches": f"{_REQUESTS} SELECT id, attempt::INT AS attempt, (dense_rank() OVER (ORDER BY id) - 1) // 11 AS batch_id, (dense_rank() OVER (ORDER BY id) - 1) * 3 + attempt AS seq FROM req",
    "hash_sample": f"SELECT doc_id FROM documents WHERE {_sql_unit('doc_id', 7, 'sample')} <= 0.3",
    "embedding_cosine": "SELECT a.vec_id, round(coalesce(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 0), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "jsonl_round_trip": "SELECT md5(text) AS text_md5, count(*) AS records FROM documents WHERE text IS NOT NULL GROUP BY 1",
}

QUERIES = {
    f.__name__: f
    for f in (
        clean_length_profile, exact_dedup, keyword_flags, drop_reason_counts, retention, type_counts, text_type, redundancy_ratio, bigram_signature, lsh_buckets, near_dedup, char_bigram_perplexity, perplexity_thresholds,
        perplexity_percentiles, perplexity_histogram, perplexity_keep, rewrite_routing, rewrite_prompts, rewrite_quality, rewrite_tallies, question_type, qa_prompts, qa_parse_validate, qa_batch_dedup, qa_global_dedup, qa_tallies, qa_batches, hash_sample,
        embedding_cosine, jsonl_round_trip, jsonl_accounting, stage1_decisions, all_stages,
    )
}
