"""What operators share: tables written in the shared folder, the package on the executors, spreading of few files."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Bytes of rows that Spark gathers before it hands them to a Python worker; a row beyond that is a batch of its own.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder every machine sees: spark.checkpoint.dir. Where it is unset, a local master may use its own folder;
    on a cluster each machine would write to its own disk, so that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        at = "file:///tmp/textmill-checkpoints"
    return at


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends, a lost executor costs nothing.

    The schema is given on reading, so empty results keep their columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textmill/{uuid.uuid4().hex}-{name}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more. Call it only when all that was derived from them is stored or
    collected."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, if a scan yields fewer (a small table in one file)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session: they need not have it installed. Where the session sets no bytes
    of an Arrow batch, it gets BATCH_BYTES: Spark's own 10,000 rows of text are held on both sides of each worker, outside
    the heap."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)
    sc = spark.sparkContext
    if any("textmill-" in str(f) for f in sc.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(), f"textmill-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("textmill", os.path.relpath(path, root)))
    sc.addPyFile(out)


def numbered(df: DataFrame, key: str, name: str = "number") -> DataFrame:
    """(key, number): distinct keys numbered from 0 in their order, without bringing them into one task: ranges of keys
    are numbered within and offset by the counts of the ranges before (one row a range)."""
    at = stored(df.select(key).distinct().repartitionByRange(key).sortWithinPartitions(key).withColumn("_m", F.monotonically_increasing_id()), "numbered")
    at = at.select(key, F.shiftright("_m", 33).alias("_range"), F.col("_m").bitwiseAND(2**33 - 1).alias("_i"))
    ranges = at.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return at.join(ranges.select("_range", before.alias("_before")), "_range").select(key, (F.col("_before") + F.col("_i")).alias(name))
