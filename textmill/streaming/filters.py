"""The stateless rules and exact deduplication over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators.filters import FilterConfig, filter_records


def filter_stream(df: DataFrame, cfg: FilterConfig = FilterConfig(), text: str = "text") -> DataFrame:
    """Kept records of a stream with text_type; every rule looks at one record, so no state is held."""
    out = filter_records(df, cfg, text).where("drop_reason is null").drop("drop_reason")
    return out.withColumn("text_type", T.text_type(F.col("cleaned_text")))


def dedup_stream(df: DataFrame, event_time: str, delay: str = "1 hour") -> DataFrame:
    """The first record of each digest within the watermark; state older than the delay is dropped."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["md5"])
