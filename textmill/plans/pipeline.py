"""The three stages put together: filter, rewrite, question-answer generation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import dedup, filters, qa, rewrite, scoring
from textmill.operators._store import discard, stored
from textmill.plans import monitor


@dataclass(frozen=True)
class Config:
    filters: filters.FilterConfig = field(default_factory=filters.FilterConfig)
    minhash: dedup.MinHashConfig | None = field(default_factory=dedup.MinHashConfig)
    perplexity: scoring.PerplexityConfig = field(default_factory=scoring.PerplexityConfig)
    rewrite: rewrite.RewriteConfig = field(default_factory=rewrite.RewriteConfig)
    qa: qa.QaConfig = field(default_factory=qa.QaConfig)


def _judged(docs: DataFrame, cfg: Config = Config(), scorer: Callable[[DataFrame], DataFrame] = scoring.bigram_perplexity, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every record with the reason of its filters, written, and (key, text_type, perplexity, keep) of the scored ones.

    Texts are written once, as they came: cleaning them again on reading is cheap next to the rules. A later copy of a
    text has all buckets of the first, which is kept or dropped by a kept one before either, so copies need not be taken
    out before near-duplicates are."""
    all_ = stored(filters.filter_records(docs, cfg.filters, text).drop("cleaned_text"), "filtered")
    all_ = _cleaned(all_, text)
    left = all_.where("drop_reason is null")
    if cfg.minhash:
        left = dedup.near_dedup(left, cfg.minhash, key=key)
    else:
        again = dedup.marked(all_.select(key, "md5", "drop_reason"), key).where("drop_reason = 'md5_duplicate'").select(F.col(key).alias("_k"), F.col("md5").alias("_d"))
        left = left.join(again, F.col(key).eqNullSafe(F.col("_k")) & (F.col("md5") == F.col("_d")), "left_anti")
    # scorers read it more than once
    left = stored(left.withColumn("text_type", T.text_type(F.col("cleaned_text"))), "left")
    start = F.substring("cleaned_text", 1, cfg.perplexity.min_length).alias("cleaned_text")  # thresholds ask whether it is long enough
    scored = stored(scorer(left).select(key, "text_type", "perplexity", start), "scored")
    discard(left)
    return all_, scoring.layered_keep(scored, scoring.thresholds(scored, cfg.perplexity), cfg.perplexity).select(key, "text_type", "perplexity", "keep")


def _cleaned(df: DataFrame, text: str) -> DataFrame:
    return filters.clean(df, text).drop("stripped")


def decide(docs: DataFrame, cfg: Config = Config(), scorer: Callable[[DataFrame], DataFrame] = scoring.bigram_perplexity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every record with its drop_reason (null: kept) over all stage 1 steps, and for the scored ones text_type and
    perplexity. Keys must be unique."""
    all_, kept = _judged(docs, cfg, scorer, key, text)
    out = dedup.marked(all_, key).join(kept, key, "left")
    reason = F.when(F.col("drop_reason").isNotNull(), F.col("drop_reason")).when(F.col("keep").isNull(), "near_duplicate").when(~F.col("keep"), "perplexity")
    return out.withColumn("drop_reason", reason).drop("keep")


def refine(docs: DataFrame, cfg: Config = Config(), scorer: Callable[[DataFrame], DataFrame] = scoring.bigram_perplexity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stage 1: the kept records with cleaned_text, md5, text_type, perplexity (two decimals), has_academic_features."""
    all_, kept = _judged(docs, cfg, scorer, key, text)
    kept = stored(kept.where("keep").drop("keep"), "kept-keys")  # few, mostly: then the texts are not shuffled
    out = all_.where("drop_reason is null").drop("drop_reason").join(kept, key)
    return out.withColumn("perplexity", T.rounded(F.col("perplexity"), 2))


def run(docs: DataFrame, rewriter: Callable[[DataFrame], DataFrame], questioner: Callable[[DataFrame], DataFrame], cfg: Config = Config(), scorer: Callable[[DataFrame], DataFrame] = scoring.bigram_perplexity, key: str = "doc_id", text: str = "text", timer: monitor.Stages | None = None) -> dict[str, DataFrame]:
    """All stages: kept, rewritten and qa records. Each is written once and read by the next; the timer is told how long
    the first two took."""
    timer = timer or monitor.Stages()
    with timer.stage("filter"):
        kept = stored(refine(docs, cfg, scorer, key, text), "kept")
    with timer.stage("rewrite"):
        new = stored(rewrite.rewrite(kept, rewriter, lambda d: scorer_by_id(scorer, d), cfg.rewrite, key, text), "rewritten")
    return {"kept": kept, "rewritten": new, "qa": qa.generate_qa(new, questioner, cfg.qa)}


def scorer_by_id(scorer: Callable[..., DataFrame], df: DataFrame) -> DataFrame:
    """The scorer over (id, cleaned_text)."""
    return scorer(df, key="id") if scorer is scoring.bigram_perplexity else scorer(df)
