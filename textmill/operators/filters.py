"""Stage 1 filters: cleaning, one drop reason a record, text type, counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T


@dataclass(frozen=True)
class FilterConfig:
    min_length: int = 8
    max_length: int = 12000
    require_academic: bool = False


#: In the order they are applied; a record counts under the first that drops it.
REASONS = ("length", "empty", "sensitive", "colloquial", "non_academic", "md5_duplicate", "near_duplicate", "perplexity")


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds stripped (what length is measured on; null counts as empty) and cleaned_text (white space normalised)."""
    df = df.withColumn("stripped", T.strip(F.coalesce(F.col(text), F.lit(""))))
    return df.withColumn("cleaned_text", T.normalise(F.col("stripped")))


def drop_reason(cfg: FilterConfig = FilterConfig()) -> Column:
    """First rule that drops a cleaned record, null if none does."""
    stripped, t = F.col("stripped"), F.col("cleaned_text")
    reason = (
        F.when(~F.length(stripped).between(cfg.min_length, cfg.max_length), "length")
        .when(F.length(t) == 0, "empty")
        .when(T.is_sensitive(t), "sensitive")
        .when(T.is_colloquial(t), "colloquial")
    )
    return reason.when(~T.has_academic_features(t), "non_academic") if cfg.require_academic else reason


def filter_records(df: DataFrame, cfg: FilterConfig = FilterConfig(), text: str = "text") -> DataFrame:
    """Adds cleaned_text, drop_reason, md5 and has_academic_features to every record; none is removed."""
    df = clean(df, text).withColumn("drop_reason", drop_reason(cfg)).drop("stripped")
    return df.withColumn("md5", F.md5("cleaned_text")).withColumn("has_academic_features", T.has_academic_features(F.col("cleaned_text")))


def drop_counts(df: DataFrame, *by: str) -> DataFrame:
    """Records by drop reason ('kept' where there is none): one partial aggregation, a row a reason."""
    return df.groupBy(*by, F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("records"))


def tallies(df: DataFrame, *by: str) -> DataFrame:
    """Records by the given columns (text types, status of rewrites and pairs)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))


def retention(df: DataFrame, low: float = 0.45, high: float = 0.55) -> DataFrame:
    """(total, kept, ratio, advice): the share kept and whether it leaves the target band."""
    out = df.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("drop_reason").isNull(), 1)).alias("kept"))
    out = out.withColumn("ratio", F.try_divide("kept", "total"))
    return out.withColumn("advice", F.when(F.col("ratio") < low, "loosen").when(F.col("ratio") > high, "tighten").otherwise("in band"))


def hash_sample(df: DataFrame, key: str, ratio: float, seed: int = 0, most: int | None = None) -> DataFrame:
    """A deterministic Bernoulli sample by hash of the key; with `most`, the first so many by hash."""
    unit = T.hash_unit(F.col(key), seed, "sample")
    out = df.withColumn("_unit", unit).where(F.col("_unit") <= ratio)
    return (out.orderBy("_unit", key).limit(most) if most is not None else out).drop("_unit")
