"""Generators: functions of a DataFrame with prompt that add output."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replay(recorded: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Recorded outputs (prompt_md5, output); a prompt that is not recorded yields an empty output."""
    known = recorded.select("prompt_md5", "output").dropDuplicates(["prompt_md5"])

    def run(df: DataFrame) -> DataFrame:
        out = df.withColumn("prompt_md5", F.md5("prompt")).join(known, "prompt_md5", "left").drop("prompt_md5")
        return out.withColumn("output", F.coalesce("output", F.lit("")))

    return run


def template(output) -> Callable[[DataFrame], DataFrame]:
    """For tests only: the output is a column expression of the row."""
    return lambda df: df.withColumn("output", output)


def engine(load: Callable[[], Callable[[list[str]], list[str]]], batch: int = 32) -> Callable[[DataFrame], DataFrame]:
    """An external model that `load` builds once a worker; a batch that fails yields empty outputs."""

    def run(df: DataFrame) -> DataFrame:
        schema = T.StructType([*df.schema.fields, T.StructField("output", T.StringType())])

        def generate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = load()
            for frame in frames:
                prompts, out = frame["prompt"].tolist(), []
                for i in range(0, len(prompts), batch):
                    part = prompts[i : i + batch]
                    try:
                        out += list(model(part))
                    except Exception:  # noqa: BLE001 - the batch counts as failed
                        out += [""] * len(part)
                yield frame.assign(output=out)

        return df.mapInPandas(generate, schema)

    return run


def embedder(df: DataFrame, load: Callable[[], Callable[[list[str]], list[tuple]]], text: str, name: str = "embedding", batch: int = 32) -> DataFrame:
    """Adds the mean-pooled embedding of a text. The model that `load` builds once a worker gives, for each text, the
    vectors of its tokens (tokens x size) and their mask; the mean is over the masked ones, its divisor 1e-9 at least."""

    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for s in batches:
            texts, out = [t or "" for t in s], []
            for i in range(0, len(texts), batch):
                for vectors, mask in model(texts[i : i + batch]):
                    m = np.asarray(mask, float)[:, None]
                    out.append(((np.asarray(vectors, float) * m).sum(0) / max(m.sum(), 1e-9)).tolist())
            yield pd.Series(out)

    return df.withColumn(name, F.pandas_udf(embed, "array<double>")(F.col(text)))
