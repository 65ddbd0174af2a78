"""Five stages that clean documents and mix them, each a DataFrame to a DataFrame.

Each stage's result is written as Parquet in the shared folder and read again as the next stage's documents. All but
the last return the columns of documents; the last returns what the mix takes of each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm._common import discard, written
from textmill.llm.decontaminate import contaminated
from textmill.llm.line_dedup import dedup_lines
from textmill.llm.mix import mix
from textmill.llm.near_dup import near_duplicates
from textmill.llm.toxicity import score_toxicity

#: Jaccard similarity of shingle sets at which near-duplicate removal links two texts; line dedup leaves the later ones
#: for it to drop.
COPY_SHARE = 0.75


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the doc_ids of gone; rows with a null doc_id stay."""
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, score_toxicity(docs, labels).where("predicted = 1"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs; what the next stage drops is left to it."""
    new = dedup_lines(docs, spare=COPY_SHARE, carry=True)
    now = {c: F.col("row").getField(c) for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in now:
        now["n_chars"] = F.when(F.col("n_runs") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(now["n_chars"])
    return new.select(*(now[c].alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id; of rows equal in doc_id and text one."""
    gone = near_duplicates(docs).where("not kept")
    left = _without(docs, gone)
    named = left.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return named.unionByName(left.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, taken."""
    return mix(docs, keep_source=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix_sources),
]

#: Scores, winnowing and sketches are not SQL: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
