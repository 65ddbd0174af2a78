"""Prompt templates; {text} is replaced by the text."""

# Prompts as sent to a generator.
REWRITE = {
    "high_perplexity": """任务：将以下文本改写成规范、简洁的学术表述，符合考试题目风格。
要求：
1. 修正口语化、不规范表达，保持原意不变；
2. 语言严谨、流畅，避免歧义；
3. 不添加额外信息，只优化表达。

原文本：{text}
改写后（学术考题风格）：""",
    "redundant": """任务：精简以下文本，保留核心知识点，符合考试题目风格。
要求：
1. 删除重复、无关信息和冗余虚词（如“的”“了”“其实”等）；
2. 保留定义、公式、结论等关键内容；
3. 语言简洁、严谨，适合作为考题题干或知识点描述。

原文本：{text}
精简后（学术考题风格）：""",
    "add_logic_chain": """你是一个严谨的知识阐述专家。
任务：以下文本陈述了一个事实或观点，但缺少必要的背景、原因或结果作为支撑。请对其进行扩充改写，在不改变核心事实的前提下，为其补充一个清晰、合理的因果关系或逻辑链条，使其成为一个更完整、更具说服力的句子。
要求：
1. 改写后的文本必须包含明确的因果关系，例如使用“因为...所以...”、“之所以...是因为...”等连接词。
2. 补充的内容必须符合常识或基本的科学/领域知识。
3. 保持客观、中立的陈述风格。
原始文本：
{text}
扩充改写后的文本：""",
}
QA = {
    "generic_q": [
        "你是一名教研专家，请根据提供的文本内容生成一个高质量的中文考题：\n要求：\n1. 只输出一道题的 问题 和 对应的 标准答案。\n2. 问题应与原文核心知识点高度相关，不要引入原文没有的事实。\n3. 问题末尾使用中文问号。\n4. 答案要简洁准确。\n\n原文：{text}\n\n输出格式：\n问题：...\n答案：...\n",
        "请仔细阅读以下段落，并就其核心信息点，构建一个高质量的问答对。\n\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
    ],
    "definition_q": [
        "根据以下文本，为其中的一个核心概念生成一条‘是什么’或‘定义’类考题，并给出准确答案：\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
        "如果让你对以下文本的主题进行定义式提问，你会如何问？请同时提供一个精准的答案。\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
        "请将以下文本的核心内容，改写为一个定义清晰的问答对。\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
    ],
    "reason_q": [
        "根据以下文本，生成一条‘原因/原理/为什么’类问题，并给出简洁准确的解释：\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
        "请深入分析以下文本，并提出一个关于其内在因果关系或逻辑推理的“为什么”类型的问题，并给出解释性的回答。\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
    ],
    "compare_q": [
        "根据以下文本，生成一条比较或区别类考题（例如 X 与 Y 的区别），并给出明确对比答案：\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
        "请分析以下文本中提到的两个或多个概念，并提出一个关于它们异同点的问题。\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
    ],
    "apply_q": [
        "根据以下文本，生成一条应用或方法步骤类考题，问题描述应要求说明‘如何/怎样/步骤/方法’，并给出结构化答案：\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
        "假设你需要应用以下文本中描述的方法来解决一个问题，请设计一个相关的问题，并给出操作步骤作为答案。\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
    ],
    "calculate_q": [
        "如果原文中存在公式、数值或推导背景，则生成一条计算或推导类考题（不虚构数据），并给出正确答案；否则回退到概念理解题：\n原文：{text}\n\n输出格式：\n问题：...？\n答案：...\n",
    ],
}
