"""Goldens of the rules on inline texts, greedy near-dedup against a sequential loop, JSONL accounting, streaming."""

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import _store, dedup, filters, generators, qa, rewrite, scoring
from textmill.plans import monitor, pipeline
from textmill.sources import jsonl
from textmill.streaming import filters as streaming


def frame(spark, texts, name="text"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"doc_id long, {name} string")


def test_drop_reasons(spark):
    want = {
        "牛顿第二定律": "length", "光合作用产生氧气": None, "水       火": None, "本文讨论计算机病毒的传播机制": "sensitive", "讲解 JAVA 编程基础": "sensitive", "出售二手av线材若干": "sensitive",
        "卧槽计算机病毒真多啊": "sensitive", "这个结论真是绝绝子呀": "colloquial", "memory hierarchy design": "colloquial", "结论如下。。。请参考附录": "colloquial", "wait... what is this": None,
        "哈尔滨位于黑龙江省": "colloquial", "我（们）不同意这一观点": "colloquial", "我们不同意这一观点": None, "水" * 12000: None, "水" * 12001: "length",
    }
    got = {r.text: r.drop_reason for r in filters.filter_records(frame(spark, want)).collect()}
    assert got == want


def test_null_and_empty_tables(spark):
    assert filters.filter_records(frame(spark, [None, ""])).where("drop_reason = 'length'").count() == 2
    assert filters.filter_records(frame(spark, [])).count() == 0
    assert dedup.near_dedup(filters.clean(frame(spark, [])), key="doc_id").count() == 0


def test_classifier_and_redundancy(spark):
    want = {"学而时习之，不亦说乎": True, "所以": True, "我用手机读《论语》": False, "光合作用产生氧气": False, "之" + "水" * 49: False, "之" + "水" * 48: True, "": False}
    got = {r.text: r.c for r in frame(spark, want).select("text", T.is_classic(F.col("text")).alias("c")).collect()}
    assert got == want
    red = {r.text: r.r for r in frame(spark, ["的的" + "水" * 8, "其实非常特别水水水水", ""]).select("text", T.redundancy(F.col("text")).alias("r")).collect()}
    assert red == {"的的" + "水" * 8: 0.2, "其实非常特别水水水水": 0.0, "": 0.0}


def test_question_types(spark):
    want = {"光的折射是指光线偏折": "definition", "为什么叫做光": "definition", "请说明原因": "reason", "二者的区别": "compare", "如何安装": "apply", "要求提交报告": "calculate", "x² = y": "calculate", "x = y": "fallback"}
    got = {r.text: r.q for r in frame(spark, want).select("text", T.question_type(F.col("text")).alias("q")).collect()}
    assert got == want


def test_greedy_near_dedup_is_sequential_greedy(spark, sf):
    docs = filters.clean(spark.read.parquet(f"{sf}/documents.parquet"))
    buckets = dedup.buckets(dedup.signatures(docs))
    inc = buckets.toPandas()
    kept, taken = set(), set()
    for k, g in sorted(inc.groupby("doc_id")):
        own = set(zip(g.band, g.bucket))
        if not own & taken:
            kept.add(k)
            taken |= own
    got = {r.doc_id for r in dedup.near_dedup(docs).select("doc_id").collect()}
    bare = {r.doc_id for r in docs.where("length(cleaned_text) = 0").select("doc_id").collect()}
    assert got == kept | bare
    assert {r.doc_id for r in dedup.greedy_near_dedup(buckets, last=0).collect()} == kept


def test_signatures_are_minima_of_hashed_grams(spark):
    texts = ["光合作用", "aab", "a", "", None, "ab" * 3000, "\U0001f600é"]
    for n in (1, 2, 5):
        cfg = dedup.MinHashConfig(num_perm=8, shingle=n)
        a, b = (x.tolist() for x in dedup.coefficients(8))
        got = {r.doc_id: r.signature for r in dedup.signatures(frame(spark, texts, "cleaned_text"), cfg).collect()}
        for i, t in enumerate(texts):
            grams = {t[j : j + n] for j in range(len(t) - n + 1)} or {t} if t else set()
            h = [int(hashlib.md5(g.encode()).hexdigest()[:7], 16) for g in grams]
            assert got[i] == ([min((x * p + q) % dedup.PRIME for x in h) for p, q in zip(a, b)] if h else None)


def test_exact_duplicates(spark):
    rows = [(1, "a"), (2, "a"), (2, "b"), (1, "b"), (3, "c"), (3, "c"), (None, "d"), (4, "d"), (5, None), (6, None)]
    df = spark.createDataFrame(rows, "doc_id int, md5 string")
    assert sorted(map(tuple, dedup.exact_dedup(df).collect()), key=str) == sorted([(1, "a"), (1, "b"), (3, "c"), (3, "c"), (None, "d"), (5, None)], key=str)
    marked = df.withColumn("drop_reason", F.when(F.expr("doc_id = 1 and md5 = 'a'"), "length"))
    got = {(r.doc_id, r.md5): r.drop_reason for r in dedup.mark_duplicates(marked).collect()}
    assert (got[1, "a"], got[2, "a"], got[2, "b"], got[1, "b"], got[3, "c"], got[4, "d"]) == ("length", None, "md5_duplicate", None, None, "md5_duplicate")


def test_quantiles(spark):
    rnd = np.random.default_rng(2)
    rows = [("a", float(v)) for v in rnd.integers(0, 40, 501)] + [("b", float(v)) for v in rnd.random(100)] + [("c", 1.5), ("d", None)]
    df = spark.createDataFrame(rows, "kind string, v double")
    points = (0.0, 0.1, 0.33, 0.5, 0.9, 1.0)
    got = {r.kind: r.p for r in scoring.quantiles(df, "v", points, "kind").collect()}
    for kind in "abc":
        assert got[kind] == pytest.approx(np.quantile([v for k, v in rows if k == kind], points).tolist())
    assert set(got) == set("abc")


def test_perplexity_by_table_and_by_join(spark, monkeypatch):
    df = frame(spark, ["abab", "a", None, "", "ba" * 400, "光合作用光合"], "cleaned_text")
    by_table = {r.doc_id: r.perplexity for r in scoring.bigram_perplexity(df).collect()}
    monkeypatch.setattr(scoring, "TABLE_ROWS", 0)
    by_join = {r.doc_id: r.perplexity for r in scoring.bigram_perplexity(df).collect()}
    assert by_table == pytest.approx(by_join) and [by_table[i] for i in (1, 2, 3)] == [float("inf")] * 3
    pairs = [t[i : i + 2] for t in ("abab", "ba" * 400, "光合作用光合") for i in range(len(t) - 1)]
    p = lambda c: (pairs.count(c) + 0.5) / (sum(x[0] == c[0] for x in pairs) + 0.5 * len({x[1] for x in pairs}))
    assert by_table[0] == pytest.approx(math.exp(-sum(math.log(p(c)) for c in ("ab", "ba", "ab")) / 3))


def test_thresholds(spark):
    rows = [(float(v), "modern_chinese", "x" * 8) for v in (1, 2, 4, 8)] + [(float("inf"), "modern_chinese", "x" * 8), (float("nan"), "modern_chinese", "x" * 8)]
    r = scoring.thresholds(spark.createDataFrame(rows, "perplexity double, text_type string, cleaned_text string")).first()
    assert r.modern_threshold == pytest.approx(6.8) and r.classic_threshold == 30.0


def test_rewrite_and_qa(spark):
    kept = spark.createDataFrame([("a", "的的" + "水" * 7, "modern_chinese", 10.0), ("b", "学而时习之", "classic_chinese", 500.0), ("c", "", "modern_chinese", 1.0)], "doc_id string, text string, text_type string, perplexity double")
    out = rewrite.rewrite(kept, generators.template(F.regexp_replace("original_text", "的", "火")), lambda d: scoring.bigram_perplexity(d, key="id"), rewrite.RewriteConfig(perplexity_pct=1.0, similarity=0.0))
    got = {r.id: r for r in out.collect()}
    assert (got["a"].status, got["a"].rewritten_text) == ("success", "火火" + "水" * 7)
    assert (got["b"].status, got["b"].reason) == ("skipped", "古文") and got["c"].reason is None
    said = generators.template(F.lit("问题：什么是惯性？\n答案：物体保持运动状态的性质。"))
    records = qa.generate_qa(out, said).collect()
    assert sum(r.status == "success" for r in records) == 1
    assert sorted(r.fail_reason for r in records if r.status == "failed") == ["批次内重复"] * 5 + ["空源文本"]


def test_jsonl(spark, tmp_path):
    lines = ['{"text":"光合作用产生氧气","k":1}', "", "{bad", "[1]", '"str"', '{"text":null}', '{"text":5}', '{"k":1}']
    (tmp_path / "raw.jsonl").write_text("\n".join(lines), encoding="utf-8")
    got = jsonl.read_jsonl(spark, str(tmp_path)).collect()
    assert len(got) == 7 and sum(r.malformed for r in got) == 5
    assert sorted(r.text for r in got if not r.malformed) == ["", "光合作用产生氧气"] and {r.source_file for r in got} == {"raw.jsonl"}
    with pytest.raises(jsonl.NoInput):
        jsonl.read_jsonl(spark, str(tmp_path / "none"))


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"doc_id":1,"text":"光合作用产生氧气"}\n{"doc_id":2,"text":"短"}\n', encoding="utf-8")
    stream = streaming.filter_stream(spark.readStream.schema("doc_id long, text string").json(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.doc_id for r in spark.table("kept").collect()] == [1]


def test_stage1_counts_add_up(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = pipeline.decide(docs)
    assert out.count() == docs.count() and out.where("drop_reason is null and perplexity is null").count() == 0


def test_sinks(spark, tmp_path):
    line = '{"text":" 光合作用  产生氧气 ","n":{"a":[1,null]},"md5":"old"}'
    (tmp_path / "raw.jsonl").write_text(line + "\n\n" + '{"text":"x","text_type":1}' + "\n", encoding="utf-8")
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "bad.jsonl").write_bytes(b'{"text":"a\xffb"}\n')
    good = jsonl.load(spark, str(tmp_path))
    assert good.count() == 3 and jsonl.load(spark, str(tmp_path), 1.0, 2, seed=3).count() == 2 and jsonl.load(spark, str(tmp_path), 0.0).count() == 0
    first = [r.line_md5 for r in jsonl.load(spark, str(tmp_path), 1.0, 2, seed=3).collect()]
    assert first == [r.line_md5 for r in jsonl.load(spark, str(tmp_path), 1.0, 2, seed=3).collect()]
    kept = filters.filter_records(good.withColumn("doc_id", F.lit(1))).withColumn("perplexity", F.lit(2.5)).withColumn("text_type", T.text_type(F.col("cleaned_text")))
    out = {json.loads(r.value)["cleaned_text"]: json.loads(r.value) for r in jsonl.overlay(kept).collect()}
    top = out["光合作用 产生氧气"]
    assert top["n"] == {"a": [1, None]} and top["md5"] == hashlib.md5("光合作用 产生氧气".encode()).hexdigest() and top["perplexity"] == 2.5 and top["has_academic_features"] is False
    assert out["x"]["text_type"] == "modern_chinese" and top["text"] == " 光合作用  产生氧气 "
    path = str(tmp_path / "kept")
    for _ in range(2):
        jsonl.write_jsonl(kept.select("text", "cleaned_text", "md5", "perplexity", "source_file", "text_type", "has_academic_features"), path)
    assert jsonl.read_kept(spark, path).count() == 3
    assert "光合作用" in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "kept").glob("part-*"))


def test_rewrite_and_qa_files(spark, tmp_path):
    rows = [("1", "原文", "改写", "success", "合格", None, 2.0), ("2", "原文", None, "skipped", "古文", None, None)]
    path = str(tmp_path / "rewrites")
    jsonl.write_jsonl(spark.createDataFrame(rows, "id string, original_text string, rewritten_text string, status string, reason string, orig_perplexity double, rew_perplexity double"), path)
    (tmp_path / "rewrites" / "part-x.json").write_text("{broken\n")
    assert sorted(map(tuple, jsonl.read_rewrites(spark, path).collect()), key=str) == sorted(rows, key=str)
    for gone in (str(tmp_path / "none"), str(tmp_path / "no*ne")):
        with pytest.raises(jsonl.NoInput):
            jsonl.read_rewrites(spark, gone)
    records = spark.createDataFrame([("1", "问？", "success"), ("2", None, "failed"), ("3", None, "failed")], "id string, question string, status string")
    jsonl.write_qa(records, str(tmp_path / "qa"))
    assert [spark.read.json(str(tmp_path / "qa" / f"status={s}")).count() for s in ("success", "failed")] == [1, 2]


def test_generators(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(5)], "id int, prompt string")
    known = spark.createDataFrame([(hashlib.md5(b"p1").hexdigest(), "one"), (hashlib.md5(b"p1").hexdigest(), "one")], "prompt_md5 string, output string")
    assert [r.output for r in generators.replay(known)(df).orderBy("id").collect()] == ["", "one", "", "", ""]

    def load():
        def model(prompts):
            if "p3" in prompts:
                raise RuntimeError("out of memory")
            return [p.upper() for p in prompts]

        return model

    assert [r.output for r in generators.engine(load, batch=1)(df).orderBy("id").collect()] == ["P0", "P1", "P2", "", "P4"]
    assert sum(r.output == "" for r in generators.engine(load, batch=100)(df.coalesce(1)).collect()) == 5


def test_model_scorer_halves_batches(spark):
    def load():
        def model(texts):
            if len(texts) > 2 or "bad" in texts:
                raise MemoryError
            return [float(len(t)) for t in texts]

        return model

    df = frame(spark, ["a", "bb", "bad", None, "dddd", "eeeee", "f"], "cleaned_text").coalesce(1)
    got = [r.perplexity for r in scoring.with_model(df, load, batch=7).orderBy("doc_id").collect()]
    assert got == [1.0, 2.0, float("inf"), 0.0, 4.0, 5.0, 1.0]


def test_mean_pooling(spark):
    def load():
        return lambda texts: [([[1.0 * len(t), 2.0], [3.0, 4.0], [100.0, 100.0]], [1, 1, 0]) if t else ([[5.0, 5.0]], [0]) for t in texts]

    got = [r.embedding for r in generators.embedder(frame(spark, ["a", "", None, "aaa"]), load, "text").orderBy("doc_id").collect()]
    assert got == [[2.0, 3.0], [0.0, 0.0], [0.0, 0.0], [3.0, 3.0]]


def test_relevance_and_global_dedup(spark):
    rows = [("a", 0, 0, "光的折射是光线偏折", "光的折射是什么？", "光的折射是光线偏折"), ("b", 0, 0, "光的折射是光线偏折", "今天吃什么呢？", "吃米饭和青菜汤"), ("c", 0, 5, "光的折射是光线偏折", "光的折射是什么？", "光的折射是光线偏折"), ("c", 1, 5, "x", "光的折射是什么？", "光的折射是光线偏折")]
    df = spark.createDataFrame(rows, "id string, attempt int, batch_id long, source_text string, question string, answer string")
    why = {(r.id, r.attempt): r.w for r in df.withColumn("w", qa.fail_reason(qa.QaConfig(relevance="cosine"))).collect()}
    assert why["a", 0] is None and why["b", 0].startswith("与原文相关度低(") and why["c", 1].startswith("与原文相关度低(")
    good = df.withColumn("fail_reason", F.when(F.col("id") == "b", "x"))
    marked = lambda mode: sorted((r.id, r.attempt, r.fail_reason) for r in qa.deduped(good, qa.QaConfig(dedup=mode)).collect() if r.fail_reason)
    assert marked("global") == [("b", 0, "x"), ("c", 0, "批次内重复"), ("c", 1, "批次内重复")]
    assert marked("batch") == [("b", 0, "x"), ("c", 1, "批次内重复")]


def test_monitor(spark, tmp_path):
    monitor.log_to(str(tmp_path / "log.txt"))
    stages = monitor.Stages()
    with monitor.gauges(spark, 0.05) as readings, stages.stage("count"):
        spark.range(10**7).selectExpr("sum(id % 7)").collect()
        while not readings:
            pass
    assert readings[0]["rss_mb"] > 0 and [r.stage for r in stages.table(spark).collect()] == ["count"]
    assert "count:" in (tmp_path / "log.txt").read_text()


def test_cluster_needs_a_shared_folder(spark):
    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

        class sparkContext:  # noqa: N801
            master = "spark://x:7077"
            getConf = staticmethod(lambda: {})

    with pytest.raises(ValueError):
        _store.shared_dir(Bare)


def test_rounding_goes_by_the_exact_value(spark):
    """As Python's format and round do: 0.085 and 0.155 are no ties, 0.125 and 0.375 are."""
    values = [n / 1000 for n in range(1001)] + [0.125, 0.375, -0.085, 0.0, 1 / 3, 89.5, 2.675, 1234.565, 14999.995] + [a / b for b in (7, 40, 200, 1000) for a in range(b)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", T.rounded(F.col("v"), 2).alias("two"), F.format_string("%.2f", T.rounded(F.col("v"), 2)).alias("said"), T.rounded(F.col("v"), 0).alias("none")).collect()
    assert [(r.two, r.said, r.none) for r in got] == [(round(r.v, 2), f"{r.v:.2f}", float(round(r.v))) for r in got]
    odd = spark.createDataFrame([(None,), (math.inf,), (math.nan,), (1e300,)], "v double").select(T.rounded(F.col("v"), 2).alias("x"))
    assert [str(r.x) for r in odd.collect()] == ["None", "inf", "nan", "1e+300"]
    row = ("的" * 17 + "水" * 183, "水" * 200, "redundant", 1.0, 10.0, 5.0)
    said = rewrite.judged(spark.createDataFrame([row], "rewritten_text string, original_text string, rewrite_reason string, similarity double, perplexity double, rew_ppl double")).first()
    assert said.reason == "冗余未降(0.09)"


def test_greedy_by_first_keys_is_sequential_greedy(spark, sf, monkeypatch):
    """Few first keys at a time: texts that are dropped by those kept, and then the rounds."""
    docs = filters.clean(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "cleaned_text")
    signed = _store.stored(dedup.signatures(docs), "signatures")
    inc = dedup.buckets(signed).toPandas()
    kept, taken = set(), set()
    for k, g in sorted(inc.groupby("doc_id")):
        own = set(zip(g.band, g.bucket))
        if not own & taken:
            kept.add(k)
            taken |= own
    rounds = []
    plain = dedup.greedy_near_dedup
    monkeypatch.setattr(dedup, "greedy_near_dedup", lambda df, key, last: (rounds.append(df.select(key).distinct().count()), plain(df, key, last))[1])
    for texts in (1, 40, 10_000):
        got = [r.doc_id for r in dedup.greedy_signed(signed, last=25 * texts).collect()]
        assert sorted(got) == sorted(kept)
    assert len(rounds) == 1  # at one text a time too little is dropped, and rounds go on
    ordered = signed.withColumn("doc_id", F.concat(F.lit("k"), F.lpad("doc_id", 9, "0")))
    assert {r.doc_id for r in dedup.greedy_signed(_store.stored(ordered, "signatures"), last=25 * 20).collect()} == {f"k{k:09d}" for k in kept}


def test_taken_buckets_are_compared_whole(monkeypatch):
    """Buckets of one hash are told apart by their minima."""
    own = np.random.default_rng(1).integers(0, 2**31 - 1, (50, 5, 6)).astype(np.int32)
    other = own[:20].copy()
    other[:10] += 1
    for hashed in (dedup._Taken._codes, lambda x: (x[..., 0] % 3).astype(np.uint64)):
        monkeypatch.setattr(dedup._Taken, "_codes", staticmethod(hashed))
        assert dedup._Taken(own).hit(other).tolist() == [False] * 10 + [True] * 10
        assert not dedup._Taken(own[:0]).hit(other).any()


def test_stage1_writes_texts_once(spark, tmp_path, monkeypatch):
    """Copies and near copies: all records' texts are written once, and again only those that are left."""
    said = "".join(chr(0x4E00 + i * 7 % 9000) for i in range(3000))
    docs = spark.createDataFrame([(i, said[i % 3 :] + " " * (i % 2)) for i in range(60)], "doc_id long, text string")
    rows = {}
    put = _store.stored
    for module in (pipeline, dedup, scoring):
        monkeypatch.setattr(module, "stored", lambda df, name: (out := put(df, name), rows.setdefault(name, (out.count(), out.columns)))[0])
    got = {r.doc_id: r.drop_reason for r in pipeline.decide(docs).select("doc_id", "drop_reason").collect()}
    assert [got[i] for i in range(6)] == [None, "near_duplicate", "near_duplicate"] + ["md5_duplicate"] * 3
    wide = {name: n for name, (n, columns) in rows.items() if {"text", "cleaned_text"} & set(columns) and name != "scored"}
    assert wide == {"filtered": 60, "left": 1} and not {"text", "cleaned_text"} <= set(rows["filtered"][1])
    plain = {r.doc_id: r.drop_reason for r in pipeline.decide(docs, pipeline.Config(minhash=None)).select("doc_id", "drop_reason").collect()}
    assert sum(v == "md5_duplicate" for v in plain.values()) == 57 and all(plain[i] != "md5_duplicate" for i in range(3))


def test_all_stages_write_only_kept_texts_again(spark, monkeypatch):
    """The records that stage 1 keeps are those it decides to keep, and the later stages write no other text."""
    said = "".join(chr(0x4E00 + i * 7 % 9000) for i in range(3000))
    docs = spark.createDataFrame([(i, said[i % 3 :] + " " * (i % 2)) for i in range(60)], "doc_id long, text string")
    wide = {}
    put = _store.stored
    for module in (pipeline, dedup, scoring):
        monkeypatch.setattr(module, "stored", lambda df, name: (out := put(df, name), "text" in df.columns and wide.setdefault(name, out.count()))[0])
    out = pipeline.run(docs, generators.template(F.col("original_text")), generators.template(F.lit("问题：什么是惯性？答案：物体的性质。")))
    kept = out["kept"].collect()
    assert {"doc_id", "text", "cleaned_text", "md5", "has_academic_features", "text_type", "perplexity"} == set(out["kept"].columns)
    assert [(r.doc_id, r.text, r.cleaned_text, r.md5) for r in kept] == [(0, said, said, hashlib.md5(said.encode()).hexdigest())]
    assert wide == {"filtered": 60, "left": 1, "kept": 1}
