"""Queries against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from textmill.plans import queries as rules

FAST = ["clean_length_profile", "exact_dedup", "keyword_flags", "text_type", "redundancy_ratio", "bigram_signature", "char_bigram_perplexity", "rewrite_quality", "question_type", "qa_prompts", "qa_parse_validate", "qa_batch_dedup", "qa_batches", "hash_sample", "jsonl_round_trip", "jsonl_accounting", "qa_global_dedup", "qa_tallies", "rewrite_tallies", "near_dedup", "stage1_decisions"]


def rows(frame):
    def value(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return v.item() if hasattr(v, "item") else v

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(value, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_equal(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    want = con.execute(rules.SQL[name]).df()
    got = rules.QUERIES[name](spark, sf).toPandas()
    assert rows(got) == rows(want)
