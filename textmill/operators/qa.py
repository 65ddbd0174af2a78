"""Stage 3: question-answer requests, parsing, validation and deduplication."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import prompts, vocab
from textmill.functions import text as T

from ._store import numbered, stored


@dataclass(frozen=True)
class QaConfig:
    attempts: int = 3
    max_source: int = 1600
    question: tuple[int, int] = (5, 400)
    answer: tuple[int, int] = (4, 2000)
    similarity: float = 0.55
    relevance: str = "off"  # or 'cosine'
    batch: int = 32
    dedup: str = "batch"  # or 'global'
    require_success: bool = False
    seed: int = 0


Q_MARK, A_MARK = "问题：", "答案："


def source(df: DataFrame, cfg: QaConfig = QaConfig()) -> DataFrame:
    """Adds source_text: the first non-empty of rewritten_text, original_text and text, stripped and cut."""
    have = [c for c in ("rewritten_text", "original_text", "text") if c in df.columns]
    ok = F.col("status") == "success" if cfg.require_success and "status" in df.columns else F.lit(True)
    parts = [F.when(ok, F.nullif(F.col(c), F.lit(""))) if c == "rewritten_text" else F.nullif(F.col(c), F.lit("")) for c in have]
    return df.withColumn("source_text", F.substring(T.strip(F.coalesce(*parts, F.lit(""))), 1, cfg.max_source))


def requests(df: DataFrame, cfg: QaConfig = QaConfig(), key: str = "id") -> DataFrame:
    """(id, attempt, source_text, question_type, prompt_key, prompt) for non-empty sources, a row an attempt."""
    kind = T.question_type(F.col("source_text"))
    table = F.create_map(*[x for k, v in vocab.TEMPLATE_OF.items() for x in (F.lit(k), F.lit(v))])
    forms = F.create_map(*[x for k, v in prompts.QA.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]))])
    out = df.where(F.length("source_text") > 0).select(F.col(key).alias("id"), "source_text", F.explode(F.sequence(F.lit(0), F.lit(cfg.attempts - 1))).alias("attempt"))
    out = out.withColumn("question_type", kind).withColumn("prompt_key", F.coalesce(F.try_element_at(table, F.col("question_type")), F.lit("generic_q")))
    choice = F.col("_forms")
    pick = F.floor(T.hash_unit(F.concat_ws(":", F.col("id").cast("string"), F.col("attempt")), cfg.seed, "template") * F.size(choice)).cast("int")
    out = out.withColumn("_forms", F.try_element_at(forms, F.col("prompt_key"))).withColumn("template", pick)
    return out.withColumn("prompt", F.replace(F.get("_forms", F.col("template")), F.lit("{text}"), F.col("source_text"))).drop("_forms")


def parsed(output: Column) -> Column:
    """Struct (question, answer): the single pair of an output; where parsing fails the answer is the reason."""
    q, a = F.locate(Q_MARK, output), F.locate(A_MARK, output)
    pair = F.struct(T.strip(F.substring(output, q + len(Q_MARK), a - q - len(Q_MARK))).alias("question"), T.strip(F.substring(output, a + len(A_MARK), F.length(output))).alias("answer"))
    none = F.lit(None).cast("string")
    bad = lambda question, why: F.struct(question.alias("question"), F.lit(why).alias("answer"))
    many = F.coalesce(T.count_of(output, Q_MARK), F.lit(0)) > 1
    return (
        F.when(many, bad(none, "解析失败: 输出包含多个QA对"))
        .when(output.isNull() | (q == 0) | (a <= q), bad(none, "解析失败: 结构不符"))
        .when((F.length(pair["answer"]) == 0) | F.contains(pair["answer"], F.lit("...")), bad(pair["question"], "解析失败: 答案为空或未完成"))
        .otherwise(pair)
    )


def fail_reason(cfg: QaConfig = QaConfig()) -> Column:
    """Why a parsed pair (question, answer) is refused, null if it is not."""
    q, a = F.col("question"), F.col("answer")
    out = (
        F.when(F.coalesce(F.length(q), F.lit(0)) == 0, F.coalesce(F.nullif(a, F.lit("")), F.lit("解析失败: 未找到问题")))
        .when(F.contains(a, F.lit("解析失败:")), a)
        .when(~F.contains(q, F.lit("？")), "问题缺少问号")
        .when(~F.length(q).between(*cfg.question), F.concat(F.lit("问题长度异常("), F.length(q).cast("string"), F.lit(")")))
        .when(~F.length(a).between(*cfg.answer), F.concat(F.lit("答案长度异常("), F.length(a).cast("string"), F.lit(")")))
    )
    if cfg.relevance == "cosine":
        sim = T.cosine(T.hashed_bigrams(F.col("source_text")), T.hashed_bigrams(F.concat_ws(" ", q, a)))
        out = out.when(sim < cfg.similarity, F.format_string("与原文相关度低(%.2f)", T.rounded(sim, 2)))
    return out


def batches(df: DataFrame, cfg: QaConfig = QaConfig()) -> DataFrame:
    """Adds batch_id and seq: texts in order of id, as many to a batch as first reach cfg.batch requests."""
    per = -(-cfg.batch // cfg.attempts)
    return df.join(numbered(df, "id", "seq_text"), "id").withColumn("batch_id", F.floor(F.col("seq_text") / per)).withColumn("seq", F.col("seq_text") * cfg.attempts + F.col("attempt")).drop("seq_text")


def deduped(df: DataFrame, cfg: QaConfig = QaConfig()) -> DataFrame:
    """Marks later equal pairs among the accepted ones: within a batch (needs batch_id), or anywhere.

    The first of each pair is a minimum with map-side combine, joined back by its place and text, so a pair that very many
    texts yield is no hot task. df is written once."""
    group = ["question", "answer"] + (["batch_id"] if cfg.dedup == "batch" else [])
    order = ["seq"] if "seq" in df.columns else ["id", "attempt"]
    df = stored(df, "pairs")
    good = F.col("fail_reason").isNull()
    first = df.where(good).groupBy(*group).agg(F.min(F.struct(*order)).alias("o")).select(*[F.col("o")[c].alias(f"_o_{c}") for c in order], *[F.col(c).alias(f"_g_{c}") for c in group], F.lit(True).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in order] + [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
    out = df.join(first, reduce(and_, same), "left")
    return out.withColumn("fail_reason", F.when(good & F.col("_first").isNull(), "批次内重复").otherwise(F.col("fail_reason"))).drop(*first.columns)


RECORD = ("id", "question", "answer", "status", "fail_reason", "question_type", "prompt_key")


def generate_qa(df: DataFrame, generator: Callable[[DataFrame], DataFrame], cfg: QaConfig = QaConfig(), key: str = "id") -> DataFrame:
    """QA records of rewrite results, successful and failed (status), empty sources among the failed."""
    src = source(df, cfg).withColumn("id", F.col(key).cast("string"))
    none = F.lit(None).cast("string")
    empty = src.where(F.length("source_text") == 0).select("id", none.alias("question"), none.alias("answer"), F.lit("failed").alias("status"), F.lit("空源文本").alias("fail_reason"), none.alias("question_type"), none.alias("prompt_key"))
    out = generator(requests(src, cfg, "id"))
    out = out.withColumn("_p", parsed(F.col("output"))).withColumn("question", F.col("_p.question")).withColumn("answer", F.col("_p.answer")).drop("_p")
    out = out.withColumn("fail_reason", fail_reason(cfg))
    out = deduped(batches(out, cfg) if cfg.dedup == "batch" else out, cfg)
    out = out.withColumn("status", F.when(F.col("fail_reason").isNull(), "success").otherwise("failed"))
    return out.select(*RECORD).unionByName(empty)
