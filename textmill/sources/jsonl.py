"""JSONL sources and sinks with accounting of malformed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators.filters import hash_sample


class NoInput(ValueError):
    """No file matches."""


def read_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    """(line_md5, text, original, source_file, malformed) of every non-blank line of the *.jsonl files of a folder.

    malformed: not JSON, not an object, or text null or no string; such lines have a null text. An object without text
    has the empty text. original is the line as VARIANT; source_file the file's base name.
    """
    try:
        lines = spark.read.option("pathGlobFilter", "*.jsonl").text(folder)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise NoInput(f"no .jsonl file in {folder}") from e
        raise
    if not lines.inputFiles():
        raise NoInput(f"no .jsonl file in {folder}")
    return parse_lines(lines.select("value", F.col("_metadata.file_name").alias("source_file")))


def parse_lines(lines: DataFrame) -> DataFrame:
    """The same of lines (value, source_file) that are already a DataFrame."""
    lines = lines.select("value", "source_file").where(T.strip(F.col("value")) != "").withColumn("v", F.try_parse_json("value"))
    kind = F.schema_of_variant("v")
    inner = F.try_variant_get("v", "$.text", "variant")
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    absent = is_object & inner.isNull()
    well = is_object & (absent | F.coalesce(F.schema_of_variant(inner) == "STRING", F.lit(False)))
    return lines.select(
        F.md5("value").alias("line_md5"), F.when(well, F.coalesce(F.try_variant_get("v", "$.text", "string"), F.lit(""))).alias("text"), F.col("v").alias("original"), "source_file", (~well).alias("malformed")
    )


def accounting(parsed: DataFrame) -> DataFrame:
    """(source_file, malformed, lines): what each file holds, blank lines left out."""
    return parsed.groupBy("source_file", "malformed").agg(F.count(F.lit(1)).alias("lines"))


def load(spark: SparkSession, folder: str, sample_ratio: float | None = None, max_samples: int | None = None, seed: int = 0) -> DataFrame:
    """Well-formed records, a deterministic sample of them if a ratio is given."""
    good = read_jsonl(spark, folder).where(~F.col("malformed")).drop("malformed")
    return good if sample_ratio is None else hash_sample(good, "line_md5", sample_ratio, seed, max_samples)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, not escaped beyond what JSON asks for; overwrites."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def overlay(df: DataFrame, fields: tuple[str, ...] = ("cleaned_text", "md5", "perplexity", "source_file", "text_type", "has_academic_features")) -> DataFrame:
    """One JSON string a record: the original object with the given fields laid over it."""
    old = F.from_json(F.to_json("original"), "map<string,variant>")
    old = F.map_filter(F.coalesce(old, F.create_map().cast("map<string,variant>")), lambda k, _: ~k.isin(*fields))
    # a scalar becomes a variant by way of its JSON, cut out of {"v":...}; a null field is left null
    as_json = lambda f: F.to_json(F.struct(F.col(f).alias("v")), {"ignoreNullFields": "false"})
    new = F.create_map(*[x for f in fields for x in (F.lit(f), F.try_parse_json(F.substring(as_json(f), F.lit(6), F.length(as_json(f)) - 6)))])
    return df.select(F.to_json(F.map_concat(old, new)).alias("value"))


def _gate(spark: SparkSession, path: str) -> None:
    """A stage whose input is missing or holds no file does not start."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    if not found or not any(x.isFile() or len(x.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(x.getPath())) for x in found):
        raise NoInput(f"nothing at {path}")


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """Stage 1's records from JSONL, for stage 2; lines that are not of that form are dropped."""
    _gate(spark, path)
    schema = "text string, cleaned_text string, md5 string, perplexity double, source_file string, text_type string, has_academic_features boolean"
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_rewrites(spark: SparkSession, path: str) -> DataFrame:
    """Rewrite results from JSONL, for stage 3; lines that are not of that form are dropped."""
    _gate(spark, path)
    schema = "id string, original_text string, rewritten_text string, status string, reason string, orig_perplexity double, rew_perplexity double"
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_qa(records: DataFrame, folder: str) -> None:
    """QA records by status: folder/status=success and folder/status=failed, in one pass."""
    records.write.mode("overwrite").partitionBy("status").json(folder)
