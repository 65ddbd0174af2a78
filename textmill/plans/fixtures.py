"""Small inline tables with ideographs, as VALUES both engines read; the driver's tables have none."""

TEXTS = [
    "牛顿第二定律", "光合作用产氧气", "光合作用产生氧气", "水       火", "勾股定理是几何定理", "本文讨论计算机病毒的传播机制", "讲解 JAVA 编程基础",
    "出售二手av线材若干", "卧槽计算机病毒真多啊", "这个结论真是绝绝子呀", "memory hierarchy design", "结论如下。。。请参考附录", "wait... what is this", "哈尔滨位于黑龙江省",
    "我（们）不同意这一观点", "我们不同意这一观点", "光合作用 产生氧气", "光合作用  产生氧气", "学而时习之，不亦说乎", "所以", "我用手机读《论语》", "之" + "水" * 49, "之" + "水" * 48, "",
    "的的" + "水" * 8, "的的" + "水" * 7, "其实非常特别水水水水", "光的折射是指光线偏折", "为什么叫做光", "请说明原因", "二者的区别", "如何安装", "要求提交报告", "3 + 5", "x² = y", "x = y", "hello world",
    "曰若稽古", "昔者庄周梦为胡蝶", "x=1 则 y=2", "水" * 12000, "水" * 12001, "因为下雨所以地湿了一大片", "　​ 氧气是一种常见的气体 ​　",
]
OUTPUTS = [
    "问题：什么是惯性？\n答案：物体保持运动状态的性质。", "问题：A？答案：甲乙丙丁 问题：B？", "答案：x 问题：y", "", "问题：什么是力？答案：待续...", "问题：答案：力是相互作用",
    "问题：什么是力?答案：力是相互作用", "问题：力是？答案：力是相互作用", "问题：什么是力呢？答案：相互", "问题：什么是惯性？\n答案：物体保持运动状态的性质。", None,
]
# id, rewritten_text, original_text, rewrite_reason, similarity, perplexity, rew_ppl
REWRITES = [
    (0, "", "原文", "redundant", 1.0, 10.0, 5.0), (1, "改写失败了", "原文", "redundant", 1.0, 10.0, 5.0), (2, "没有逻辑", "原文", "add_logic_chain", 0.9, 10.0, 5.0),
    (3, "因为有逻辑", "原文", "add_logic_chain", 0.699, 10.0, 5.0), (4, "因为有逻辑", "原文", "add_logic_chain", 0.7, 10.0, 0.0), (5, "改写", "原文", "high_perplexity", 0.699, 10.0, 5.0),
    (6, "改写", "原文", "high_perplexity", 0.7, 100.0, 90.0), (7, "改写", "原文", "high_perplexity", 0.7, 100.0, 89.5), (8, "的水水", "的火火", "redundant", 0.8, 10.0, 5.0), (9, "水水水", "的火火", "redundant", 0.8, 10.0, 5.0),
    (10, None, "原文", "high_perplexity", 1.0, 10.0, 5.0), (11, "因为有逻辑", "原文", "add_logic_chain", 0.9, 10.0, 7.5),
]


def literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)


def values(rows: list[tuple], columns: str) -> str:
    """SELECT over VALUES; in a CASE of long repeats the text is spelled out."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(literal(v) for v in r) + ')' for r in rows)}) AS v({columns})"


#: Ids below those of documents.
TEXT_ROWS = [(-1 - i, t) for i, t in enumerate(TEXTS)]
TEXTS_SQL = values(TEXT_ROWS, "id, text")
OUTPUTS_SQL = values([(-1 - i // 2, i % 2, o, i // 6) for i, o in enumerate(OUTPUTS)], "id, attempt, output, batch_id")
REWRITES_SQL = values(REWRITES, "id, rewritten_text, original_text, rewrite_reason, similarity, perplexity, rew_ppl")

#: Model outputs and rewrites of the documents, written by rule in SQL that both engines read.
OUTPUTS_OF_DOCS = (
    "doc_id AS id", "attempt", "CASE doc_id % 6 WHEN 0 THEN '问题：' || left(text, 40) || '？答案：' || substr(text, 41, 80) WHEN 1 THEN '问题：' || left(text, 40) || '答案：' || left(text, 9)"
    " WHEN 2 THEN '答案：' || left(text, 20) || '问题：真的？' WHEN 3 THEN '问题：' || left(text, 500) || '？答案：' || left(text, 3) WHEN 4 THEN '问题：甲是什么？答案：' || text ELSE '问题：文中用的是什么语言？答案：语言是' || lang END AS output",
    "CAST(floor(doc_id / 11) AS BIGINT) AS batch_id",
)
REWRITES_OF_DOCS = (
    "doc_id AS id", "CASE doc_id % 5 WHEN 0 THEN '因为' || left(text, 60) WHEN 1 THEN replace(text, 'e', '的') WHEN 2 THEN '' ELSE text END AS rewritten_text", "text AS original_text",
    "CASE doc_id % 3 WHEN 0 THEN 'add_logic_chain' WHEN 1 THEN 'high_perplexity' ELSE 'redundant' END AS rewrite_reason", "CAST(doc_id % 10 AS DOUBLE) / 8 AS similarity",
    "CAST(doc_id % 7 AS DOUBLE) * 16 AS perplexity", "CAST(doc_id % 4 AS DOUBLE) * 12 AS rew_ppl",
)
