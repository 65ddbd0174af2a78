"""Mixing sources to target weights, in DataFrame operations only.

Hash-random keys order the documents of a source; the key range of a source is cut into as many equal slices as its
row count asks for, slice totals are prefix-summed on their own small table, and a window within each slice finishes
the prefix sums. A source that holds a third of all rows is therefore many slices, never one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import WORD, written

WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, source_rows, target) from (source, size).

    Sources in code-point order, null last, take the weights in turn. Targets share `share` times all words by weight;
    a target stops at `most` times its source's words and the excess is shared again by weight. That is water-filling:
    with sources sorted by the level at which they stop, the level left for the rest rises while a source stops below it
    and falls afterwards, so the common level is the largest of them.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    src = src.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int")))
    src = src.withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("stop", F.col("cap") / F.col("w"))
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(1)).orderBy("stop", F.col("source").asc_nulls_last())
    src = (
        src.withColumn("spent", F.coalesce(F.sum("cap").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(whole.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") * F.lit(share) - F.col("spent")) / F.col("left_w"))
    )
    level = F.max("level").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return src.withColumn("lambda", level).select(
        "source", "source_size", "source_rows", F.coalesce(F.least("cap", F.col("lambda") * F.col("w")), F.col("cap")).alias("target")
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 20, slice_rows: int = 256, keep_source: bool = False) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, and source with keep_source.

    size: number of words (null or blank text: 0). taken: words the mix takes from the document, repeats counted: whole
    epochs of the source first, then documents in hash-key order up to the exact budget, where the last one is cut.
    A row of a source without words has target 0 and taken 0. Null doc_id or source are values like any other (rows
    without doc_id are keyed by their text); equal rows share a key and are ordered by size, so reruns agree. Texts are counted
    whole, however long. Other columns of the input are not read. An empty
    table gives an empty result.
    """
    # a key by hash of the doc_id, or of the text where there is none
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), name)), 1, 15), 16, 10).cast("long").alias("key")
    sizes = docs.select("doc_id", key, "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sizes = written(sizes, "sizes")
    targets = written(source_targets(sizes, weights, share, most), "targets")
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rows = rows.withColumn("slice", F.floor(F.col("key").cast("double") / F.lit(float(2**60)) * F.ceil(F.col("source_rows") / F.lit(slice_rows))))
    part = Window.partitionBy("source", "slice")
    rows = rows.withColumn("inside", F.sum("size").over(part.orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)))
    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    # slice totals: one row per slice_rows documents; groups of slices keep even this table out of one task
    sums = sums.withColumn("block", F.floor(F.col("slice") / F.lit(slice_rows)))
    blocks = sums.groupBy("source", "block").agg(F.sum("slice_size").alias("block_size"))
    blocks = blocks.select(
        F.col("source").alias("s2"), F.col("block").alias("b2"), F.coalesce(F.sum("block_size").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("block_before")
    )
    sums = sums.withColumn("in_block", F.coalesce(F.sum("slice_size").over(Window.partitionBy("source", "block").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sums = sums.join(blocks, F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2"))).select(
        F.col("source").alias("s3"), F.col("slice").alias("l3"), (F.col("in_block") + F.col("block_before")).alias("slice_before")
    )
    rows = rows.join(written(sums, "slices"), F.col("source").eqNullSafe(F.col("s3")) & (F.col("slice") == F.col("l3")))
    before = F.coalesce("inside", F.lit(0)) + F.col("slice_before")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return rows.select("doc_id", *["source"] * keep_source, "size", "source_size", "target", taken.cast("long").alias("taken"))
