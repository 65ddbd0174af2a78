"""Vocabularies and patterns of the corpus rules, as data."""

# Word lists and patterns that results depend on.
COLLOQUIAL = (
    "卧槽 牛逼 哈哈哈 嘻嘻 嘿嘿 老铁 懂吧 给力 666 yyds 绝绝子 家人们 谁懂啊 救命 哭死 笑不活 栓Q 拿捏 破防 躺平 "
    "绝了 无语 服了 凑活 咋整 唠嗑 侃大山 扯犊子 瞎逼逼 逼逼赖赖 磨磨唧唧 叽叽歪歪 碎碎念 吐槽 怼人 杠精 内卷 躺平 摆烂 摸鱼 "
    "划水 打工人 干饭人 尾款人 工具人 冤种 显眼包 社恐 社牛 社死 emo 佛系 卷王 摆烂式 摸鱼式 划水式 躺平式 敷衍式 糊弄学 PUA "
    "CPU KTV yyds awsl 绝绝子 YYDS 绝绝子 栓Q 拿捏了 破防了"
).split()
SENSITIVE = {
    "色情相关": (
        "色情 黄色 裸聊 性交易 嫖娼 卖淫 淫荡 色情视频 色情图片 AV 三级片 春宫 艳照 露骨 性行为 性器官 手淫 嫖娼 包养 小三 "
        "二奶 情夫 情妇 不正当关系 一夜情 约炮 性服务 色情直播 色情小说"
    ).split(),
    "暴力相关": (
        "杀人 抢劫 强奸 绑架 斗殴 斗殴 故意伤害 杀人放火 爆炸 投毒 凶器 枪支 弹药 管制刀具 暴力 血腥 恐怖 虐杀 虐待 施暴 "
        "殴打 群殴 互殴 寻衅滋事 聚众斗殴 故意伤害 故意杀人 抢劫财物"
    ).split(),
    "毒品相关": "毒品 大麻 海洛因 冰毒 可卡因 摇头丸 K粉 鸦片 吗啡 杜冷丁 吸毒 贩毒 制毒 吸毒者 毒贩 毒品交易 毒品运输 毒品走私".split(),
    "政治敏感": "敏感政治人物 政治敏感事件 颠覆 分裂 叛国 暴动 骚乱 非法集会 反动 反政府 反社会 极端主义 恐怖主义 邪教 法轮功 台独 港独 疆独".split(),
    "其他敏感": "赌博 诈骗 传销 非法集资 洗钱 偷税漏税 贪污腐败 行贿受贿 假币 非法交易 黑客 入侵 病毒 盗号 诈骗短信 诈骗电话".split(),
}
SENSITIVE_PATTERNS = (
    "出售.*(色情|AV|三级片)",
    "(嫖娼|卖淫|性交易).*(价格|联系方式|地点)",
    "(杀人|抢劫|绑架).*(方法|教程|工具)",
    "(毒品|大麻|冰毒).*(购买|出售|运输)",
    "(台独|港独|疆独).*(支持|宣传|分裂)",
)
PUNCTUATION_RUN = "[！？。,，；;：:]{3,}"
COLLOQUIAL_PATTERNS = (
    "[我你他她它]（们）?[也都还就才又再]?[不没没什么没什么大不了]",
    "[这那哪]（个些）?[也都还就才又再]?[不没没什么没什么大不了]",
    "^[哈哈嘿嘿嘻嘻呵呵]+",
)
ACADEMIC_PATTERNS = ("[A-Za-z0-9]=.*[A-Za-z0-9]", "定义[:：]", "定理", "公理", "命题", "推论", "原理", "方法", "实验", "分析", "结论")
CLASSIC = (
    "之 乎 者 也 曰 吾 汝 尔 乃 兮 矣 哉 耶 欤 焉 乎 其 而 以 于 夫 盖 则 且 若 何 孰 安 孰与 所以 所 可 能 必 当 应 "
    "夏 商 周 秦 汉 魏 蜀 吴 晋 隋 唐 宋 元 明 清 "
    "黄帝 炎帝 尧 舜 禹 汤 文王 武王 周公 孔子 孟子 老子 庄子 墨子 荀子 韩非子 "
    "《论语》 《孟子》 《大学》 《中庸》 《诗经》 《尚书》 《礼记》 《周易》 《春秋》 "
    "《道德经》 《庄子》 《墨子》 《荀子》 《韩非子》 《史记》 《汉书》 《后汉书》 《三国志》 "
    "呜呼 嗟夫 盖闻 窃以为 臣闻 圣王 贤君 忠臣 义士 孝子 烈女"
).split()
MODERN = "手机 互联网 电脑 微信 支付宝 快递 高铁 空调 电视 网络 APP 微博 抖音 快手 直播 电商 网购 外卖 打车 共享单车 5G WiFi".split()
CLASSIC_PATTERN = r"^([\x{4e00}-\x{9fff}]{1,5}曰|昔者|初|当是时|于是|呜呼|嗟夫|盖闻|窃以为|臣闻|圣王|贤君|忠臣|义士)"
REDUNDANT_CHARS = "的了在是啊吧呢"
LOGIC = "因为 所以 因此 由于 导致 原因是 之所以 从而 故 以致于 结果是 关键在于".split()
QUESTION_TYPES = {
    "definition": "定义 是指 称为 叫做 是什么".split(),
    "reason": "为什么 原因 原理 依据".split(),
    "compare": "区别 不同 比较 差异".split(),
    "apply": "如何 怎样 怎么 步骤 方法".split(),
    "calculate": "计算 求 推导 公式".split(),
}
CALCULATE_SIGNS = "= + - → %".split()
TEMPLATE_OF = {"definition": "definition_q", "reason": "reason_q", "compare": "compare_q", "apply": "apply_q", "calculate": "calculate_q", "fallback": "generic_q"}
