"""Stage 2: which texts are rewritten and why, prompts, and the gates a rewrite must pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import prompts, vocab
from textmill.functions import text as T

from .scoring import quantiles


@dataclass(frozen=True)
class RewriteConfig:
    max_chars: int = 11800
    perplexity_pct: float = 0.80
    perplexity_default: float = 800.0
    redundancy: float = 0.2
    short: int = 150
    logic_share: float = 0.1
    similarity: float = 0.7
    reduction: float = 0.9
    seed: int = 0


def threshold(df: DataFrame, cfg: RewriteConfig = RewriteConfig()) -> DataFrame:
    """One row (rewrite_threshold): percentile of the positive perplexities of modern texts."""
    modern = df.where((F.col("text_type") == "modern_chinese") & (F.col("perplexity") > 0)).select("text_type", "perplexity")
    p = quantiles(modern, "perplexity", (cfg.perplexity_pct,), "text_type")
    return p.agg(F.coalesce(F.max(F.col("p")[0]), F.lit(cfg.perplexity_default)).alias("rewrite_threshold"))


def route(df: DataFrame, limit: DataFrame, cfg: RewriteConfig = RewriteConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds original_text (cut to max_chars), needs_rewrite and rewrite_reason."""
    t = F.col("original_text")
    modern = F.coalesce(F.col("text_type") == "modern_chinese", F.lit(False))
    df = df.crossJoin(F.broadcast(limit)).withColumn("original_text", T.strip(F.substring(F.coalesce(F.col(text), F.lit("")), 1, cfg.max_chars)))  # one row
    reason = (
        F.when(F.length(t) == 0, F.lit(None))
        .when(F.col("text_type") == "classic_chinese", "古文")
        .when(F.coalesce("perplexity", F.lit(0.0)) > F.col("rewrite_threshold"), "high_perplexity")
        .when(T.redundancy(t) > cfg.redundancy, "redundant")
        .when(modern & (F.length(t) < cfg.short) & ~T.any_of(t, vocab.LOGIC) & (T.hash_unit(F.col(key), cfg.seed, "logic") < cfg.logic_share), "add_logic_chain")
        .otherwise("无需改写")
    )
    df = df.withColumn("rewrite_reason", reason).drop("rewrite_threshold")
    return df.withColumn("needs_rewrite", F.coalesce(F.col("rewrite_reason").isin(*prompts.REWRITE), F.lit(False)))


def prompt() -> Column:
    """The template of the reason with the text in its place."""
    out = F
    for reason, form in prompts.REWRITE.items():
        out = out.when(F.col("rewrite_reason") == reason, F.replace(F.lit(form), F.lit("{text}"), T.strip(F.col("original_text"))))
    return out


def quality(cfg: RewriteConfig = RewriteConfig()) -> Column:
    """Why a rewrite fails, null if it passes. Reads rewritten_text, rewrite_reason, similarity, perplexity,
    rew_ppl (of the rewrite) and original_text."""
    new, sim, reason = F.col("rewritten_text"), F.col("similarity"), F.col("rewrite_reason")
    logic = reason == "add_logic_chain"
    return (
        F.when((F.coalesce(F.length(new), F.lit(0)) == 0) | F.contains(new, F.lit("改写失败")), "生成空结果或失败")
        .when(logic & ~T.any_of(new, vocab.LOGIC), "未注入逻辑链")
        .when(logic & (sim < cfg.similarity), F.format_string("相似度过低(%.2f)", T.rounded(sim, 2)))
        .when(sim < cfg.similarity, F.format_string("相似度低(%.2f)", T.rounded(sim, 2)))
        .when((reason == "high_perplexity") & (F.col("rew_ppl") >= F.col("perplexity") * cfg.reduction), F.format_string("困惑度未降(%.0f)", T.rounded(F.col("rew_ppl"), 0)))
        .when((reason == "redundant") & (T.redundancy(new) >= T.redundancy(F.col("original_text"))), F.format_string("冗余未降(%.2f)", T.rounded(T.redundancy(new), 2)))
    )


def judged(df: DataFrame, cfg: RewriteConfig = RewriteConfig()) -> DataFrame:
    """Adds status, reason, orig_perplexity and rew_perplexity to generated rewrites."""
    why = quality(cfg)
    hard = F.col("rewrite_reason") == "high_perplexity"
    scored = hard | ((F.col("rewrite_reason") == "add_logic_chain") & why.isNull())
    df = df.withColumn("_why", why)
    return df.withColumns({
        "status": F.when(F.col("_why").isNull(), "success").otherwise("failed"),
        "reason": F.coalesce("_why", F.when(F.col("rewrite_reason") == "add_logic_chain", "logic_injected").otherwise("合格")),
        "orig_perplexity": F.when(hard, F.col("perplexity")),
        "rew_perplexity": F.when(scored & (F.coalesce(F.length("rewritten_text"), F.lit(0)) > 0) & (F.col("rew_ppl") != 0) & (~F.coalesce(F.col("_why").startswith("相似度"), F.lit(False))), F.col("rew_ppl")),
    }).drop("_why")


COLUMNS = ("id", "original_text", "rewritten_text", "status", "reason", "orig_perplexity", "rew_perplexity")


def rewrite(df: DataFrame, generator: Callable[[DataFrame], DataFrame], scorer: Callable[[DataFrame], DataFrame], cfg: RewriteConfig = RewriteConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rewrite results of kept records (text_type, perplexity): skipped ones pass through, the others are generated,
    scored by `scorer` (adds perplexity to key, cleaned_text) and judged. Similarity is the cosine of hashed bigrams."""
    routed = route(df, threshold(df, cfg), cfg, key, text).withColumn("id", F.col(key).cast("string"))
    empty = F.lit(None).cast("double")
    skipped = routed.where(~F.col("needs_rewrite")).select(
        "id", "original_text", F.lit(None).cast("string").alias("rewritten_text"), F.lit("skipped").alias("status"), F.col("rewrite_reason").alias("reason"), empty.alias("orig_perplexity"), empty.alias("rew_perplexity")
    )
    work = generator(routed.where("needs_rewrite").withColumn("prompt", prompt()))
    work = work.withColumn("rewritten_text", T.strip(F.coalesce("output", F.lit("")))).select("id", "original_text", "rewritten_text", "rewrite_reason", "perplexity")
    scored = scorer(work.select("id", F.col("rewritten_text").alias("cleaned_text"))).select("id", F.col("perplexity").alias("rew_ppl"))
    work = work.join(scored, "id").withColumn("similarity", T.cosine(T.hashed_bigrams(F.col("original_text")), T.hashed_bigrams(F.col("rewritten_text"))))
    return skipped.unionByName(judged(work, cfg).select(*COLUMNS))
