"""The stages: on the smallest tables against each decision, and on a small table with odd rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textmill.llm import decontaminate, near_dup, toxicity


def stages(spark, docs, sf):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf), name)
        out[name] = docs
    return out


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = stages(spark, docs, sf)
    assert all(out[n].columns == docs.columns for n in list(out)[:-1])
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert ids(out["toxicity"]) == ids(toxicity.score_toxicity(docs, labels).where("predicted = 0"))
    assert ids(out["line_dedup"]) == ids(out["toxicity"])
    assert ids(out["near_dedup"]) == ids(near_dup.near_duplicates(out["line_dedup"]).where("kept"))
    found = decontaminate.contaminated(out["near_dedup"], spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert found.count() > 0 and ids(out["decontaminate"]) == ids(out["near_dedup"].join(found, "doc_id", "left_anti"))
    assert ids(out["mix"]) == ids(out["decontaminate"])
    r = out["mix"].agg(F.sum("taken"), F.sum("size")).first()
    assert abs(r[0] - 1.5 * r[1]) < 30


@pytest.fixture
def small(spark, tmp_path):
    new = lambda k, n: [f"{k}{i}" for i in range(n)]
    a = new("a", 120)
    item = new("q", 20)
    rows = [
        (1, " ".join(a), "web", 5, "x"), (2, " ".join(a), "web", 5, "x"), (3, " ".join([*a[:-1], "z"]), "web", 5, "x"), (4, "you idiot you moron " + " ".join(new("t", 30)), "web", 5, "x"),
        (5, " ".join(new("c", 30) + item + new("d", 30)), "web", 5, "x"), (6, " ".join(new("e", 90) + a[30:90] + new("f", 90)), None, 5, None), (7, None, "web", None, "x"), (8, "", "b", 0, "x"),
        (9, " ".join(new("g", 12)), "b", 1, "x"), (9, " ".join(new("g", 12)), "b", 1, "x"), (None, " ".join(new("h", 12)), "b", 1, "x"), (10, "he said \"idiot\" and left " + " ".join(new("k", 30)), "b", 1, "x"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, taken string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_on_odd_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = stages(spark, docs, small)
    assert ids(out["toxicity"]) == ids(docs.where("doc_id <> 4 or doc_id is null"))
    assert ids(out["line_dedup"]) == ids(out["toxicity"])
    six = out["line_dedup"].where("doc_id = 6").first()
    assert six.text.split() == [f"e{i}" for i in range(90)] + [f"f{i}" for i in range(90)] and (six.n_chars, six.taken) == (len(six.text), None)
    assert ids(out["near_dedup"]) == sorted([1, 5, 6, 7, 8, 9, 10, None], key=str)
    assert ids(out["decontaminate"]) == sorted([1, 6, 7, 8, 9, 10, None], key=str)
    mixed = {r.doc_id: r for r in out["mix"].collect()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect()), key=str) == sorted(map(tuple, out["mix"].collect()), key=str)
    assert mixed[1].size == 120 and mixed[7].size == mixed[8].taken == 0 and all(r.taken <= 2 * r.size for r in mixed.values())


def test_stages_on_empty_tables(spark, small):
    empty = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, empty, small)
        assert got.collect() == [] and (name == "mix" or got.columns == empty.columns)
