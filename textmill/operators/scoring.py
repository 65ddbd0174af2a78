"""Perplexity scorers and the layered keep rule.

A scorer is a function DataFrame -> DataFrame that adds perplexity. The built-in one is a character-bigram model
counted over the corpus itself; a neural model plugs in as a pandas_udf through `with_model`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmill.functions import grams

from ._store import discard, ship, stored


#: Character pairs up to which the model is sent to the executors (16 bytes each); beyond it, texts' counts are joined.
TABLE_ROWS = 1_000_000


def _counted(batches: Iterator[pa.RecordBatch], name: str | None) -> Iterator[pa.RecordBatch]:
    """(key,) pair, n: the character pairs of each text, or without `name` of each batch, as (c1 << 32) + c2."""
    for batch in batches:
        for i, _, codes, bounds in grams.pieces(batch.column(batch.num_columns - 1)):
            row, gram, n, example = grams.counted(codes, bounds, 2)
            pair = (codes[example].astype(np.int64) << 32) + codes[example + 1] if len(example) else np.zeros(0, np.int64)
            if name is None:
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.bincount(gram, n, len(pair)).astype(np.int64))], names=["pair", "n"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i + row)), pa.array(pair[gram]), pa.array(n)], names=[name, "pair", "n"])


def bigram_model(df: DataFrame, text: str, add: float) -> DataFrame:
    """(pair, lnp): ln p(c2 | c1) with add-k smoothing over all texts. Texts are counted whole before anything is
    shuffled, so a row is a pair of a piece of texts, not an occurrence."""
    ship(df.sparkSession)
    pairs = df.select(text).mapInArrow(lambda b: _counted(b, None), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n12"))
    pairs = stored(pairs, "pairs")
    heads = pairs.groupBy(F.shiftright("pair", 32).alias("c1")).agg(F.sum("n12").alias("n1"))
    size = pairs.select(F.col("pair").bitwiseAND(2**32 - 1).alias("c2")).distinct().agg(F.count(F.lit(1)).alias("v"))
    p = pairs.withColumn("c1", F.shiftright("pair", 32)).join(heads, "c1").crossJoin(F.broadcast(size))  # one row
    p = stored(p.select("pair", F.ln((F.col("n12") + add) / (F.col("n1") + add * F.col("v"))).alias("lnp")), "model")
    discard(pairs)
    return p


def bigram_perplexity(df: DataFrame, text: str = "cleaned_text", key: str = "doc_id", add: float = 0.5, max_tokens: int | None = None) -> DataFrame:
    """Adds perplexity = exp(-mean ln p(c2 | c1)) with add-k smoothing; Infinity for texts of fewer than two characters
    (null texts too). max_tokens scores only so many leading characters; by default all count.

    A model of at most TABLE_ROWS pairs, which is counted, goes to the executors and texts are scored where they are;
    a larger one is joined to the texts' pair counts, and then keys must be unique."""
    t = F.col(text) if max_tokens is None else F.substring(text, 1, max_tokens)
    if max_tokens is not None:
        df = df.withColumn("_scored", t)
    col = text if max_tokens is None else "_scored"
    model = bigram_model(df, col, add)
    if model.count() <= TABLE_ROWS:
        got = model.toPandas().sort_values("pair")
        discard(model)
        table = df.sparkSession.sparkContext.broadcast((got["pair"].to_numpy(np.int64), got["lnp"].to_numpy(np.float64)))

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            pairs, lnp = table.value
            for texts in batches:
                out = np.full(len(texts), np.inf)
                for i, j, codes, bounds in grams.pieces(pa.array(texts, pa.string())):
                    row, gram, n, example = grams.counted(codes, bounds, 2)
                    if len(row):
                        of = lnp[np.searchsorted(pairs, (codes[example].astype(np.int64) << 32) + codes[example + 1])][gram]
                        total, many = np.bincount(row, n * of, j - i), np.bincount(row, n, j - i)
                        out[i:j] = np.where(many > 0, np.exp(-total / np.maximum(many, 1)), np.inf)
                yield pd.Series(out)

        out = df.withColumn("perplexity", F.pandas_udf(score, "double")(F.col(col)))
    else:
        schema = StructType([df.schema[key], *StructType.fromDDL("pair long, n long").fields])
        own = df.select(key, col).mapInArrow(lambda b: _counted(b, key), schema)
        sums = own.join(model, "pair").groupBy(key).agg(F.exp(-F.sum(F.col("n") * F.col("lnp")) / F.sum("n")).alias("perplexity"))
        out = df.join(sums, key, "left").withColumn("perplexity", F.coalesce("perplexity", F.lit(float("inf"))))
    return out.drop("_scored") if max_tokens is not None else out


def with_model(df: DataFrame, load: Callable[[], Callable[[list[str]], list[float]]], text: str = "cleaned_text", batch: int = 32) -> DataFrame:
    """Adds perplexity from a model that `load` builds once a worker; a batch that runs out of memory is halved down to
    single rows, and a row that still fails scores Infinity."""

    def rows(model: Callable, texts: list[str]) -> list[float]:
        try:
            return list(model(texts))
        except Exception:  # noqa: BLE001 - a failing row must not end the stage
            if len(texts) <= 1:
                return [float("inf")] * len(texts)
            half = len(texts) // 2
            return rows(model, texts[:half]) + rows(model, texts[half:])

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for s in batches:
            texts = [t or "" for t in s]
            yield pd.Series([p for i in range(0, len(texts), batch) for p in rows(model, texts[i : i + batch])], dtype="float64")

    return df.withColumn("perplexity", F.pandas_udf(score, "double")(F.col(text)))


@dataclass(frozen=True)
class PerplexityConfig:
    modern_pct: float = 0.90
    classic_pct: float = 0.10
    sane: float = 15000.0
    modern_limit: float = 5000.0
    classic_limit: float = 10000.0
    modern_default: float = 100.0
    classic_default: float = 30.0
    min_length: int = 8


POINTS = (0.0, 0.1, 0.2, 0.25, 0.3, 0.5, 0.75, 0.9, 0.95, 1.0)


def quantiles(df: DataFrame, value: str, points: tuple[float, ...], by: str) -> DataFrame:
    """(by, p): exact percentiles of each group at the points, by linear interpolation.

    Equal values are counted first; the distinct ones are dealt by ranges and summed up within a range, offset by the
    totals of the ranges before (a row a range), so neither a group nor a common value is one task's."""
    at = df.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("g"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    at = stored(at.repartitionByRange("g", "v").withColumn("r", F.spark_partition_id()), "distinct-values")
    sums = at.groupBy("g", "r").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("g", "r", before.alias("before"), F.sum("n").over(Window.partitionBy("g")).alias("total"))
    inside = F.sum("n").over(Window.partitionBy("g", "r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    at = at.withColumn("inside", inside).join(sums, ["g", "r"])
    upto = F.col("inside") + F.col("before")
    rank = lambda p: (F.col("total") - 1) * F.lit(p)
    bounds = [F.min(F.when(upto > cut(rank(p)), F.col("v"))).alias(f"{side}{i}") for i, p in enumerate(points) for side, cut in (("lo", F.floor), ("hi", F.ceil))]
    at = at.groupBy("g").agg(F.max("total").alias("total"), *bounds)
    between = lambda i, p: F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.col(f"lo{i}")).otherwise(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (rank(p) - F.floor(rank(p))))
    return at.select(F.col("g").alias(by), F.array(*[between(i, p) for i, p in enumerate(points)]).alias("p"))


def _sane(df: DataFrame, cfg: PerplexityConfig) -> DataFrame:
    return df.where((F.col("perplexity") < cfg.sane) & (F.length("cleaned_text") >= cfg.min_length))


def percentiles(df: DataFrame, cfg: PerplexityConfig = PerplexityConfig()) -> DataFrame:
    """(text_type, p): perplexities at POINTS by linear interpolation, sane values only."""
    return quantiles(_sane(df, cfg), "perplexity", POINTS, "text_type")


def thresholds(df: DataFrame, cfg: PerplexityConfig = PerplexityConfig()) -> DataFrame:
    """One row (modern_threshold, classic_threshold) over all sane scores of texts long enough."""
    p = quantiles(_sane(df, cfg), "perplexity", (cfg.modern_pct, cfg.classic_pct), "text_type")
    of = lambda kind, i, default: F.coalesce(F.max(F.when(F.col("text_type") == kind, F.col("p")[i])), F.lit(default))
    return p.agg(of("modern_chinese", 0, cfg.modern_default).alias("modern_threshold"), of("classic_chinese", 1, cfg.classic_default).alias("classic_threshold"))


def layered_keep(df: DataFrame, limits: DataFrame, cfg: PerplexityConfig = PerplexityConfig()) -> DataFrame:
    """Adds keep: classical texts need a high enough perplexity, modern ones a low enough one."""
    p = F.col("perplexity")
    rule = F.when(F.col("text_type") == "classic_chinese", (p >= F.col("classic_threshold")) & (p < cfg.classic_limit)).otherwise((p <= F.col("modern_threshold")) & (p < cfg.modern_limit))
    return df.crossJoin(F.broadcast(limits)).withColumn("keep", rule).drop("modern_threshold", "classic_threshold")  # one row


def histogram(df: DataFrame, cfg: PerplexityConfig = PerplexityConfig(), bins: int = 50) -> DataFrame:
    """(text_type, bin, records): sane perplexities in equal bins up to the largest one."""
    sane = df.where(F.col("perplexity") < cfg.sane)
    top = sane.agg(F.max("perplexity").alias("top"))
    width = F.least(F.floor(F.col("perplexity") / F.col("top") * bins), F.lit(bins - 1)).cast("int")
    return sane.crossJoin(F.broadcast(top)).groupBy("text_type", width.alias("bin")).agg(F.count(F.lit(1)).alias("records"))  # one row
