"""Word lists, topic rules and thresholds that decide results, as data."""

from __future__ import annotations

from dataclasses import dataclass

# Function words that tokens are never made of.
FUNCTION_WORDS = tuple(
    """了 是 這 那 的 個 月 前 跟 到 會 有 很 和 也 們 並 嗎 呢 吧 啊 地 得 著 过 過 么 什麼 什么 為 为 因 而 于 於 与 與 或 但 若 虽 雖
    则 則 且 仍 还 還 就 都 又 再 已 被 把 让 讓 给 給 向 从 從 以 及 其 之 所 我 你 他 她 它 我們 你们 你們 他们 他們 這個 那个 那個 不是
    沒有 没有 可以 就是 还是 還是 一个 一個 一些 一下 真的 觉得 覺得 先生 ： ， 。 、 ( ) - + img png html the a b c x ok aer""".split()
)
# Phrases kept whole, and scraps of recognition dropped, while cleaning.
KEPT_PHRASES = ("line pay", "fine pay", "uber eat")
SCRAPS = ("bare", "see", "img", "png", "html", "the", "ok", "aei", "ei", "aer")

# Domain stop words by dataset.
DOMAIN_STOPWORDS = {
    "drinks": tuple(
        """好喝 很好喝 超好喝 推薦 大推 不錯 還不錯 可以 喜歡 喜欢 愛 满意 滿意 回購 回购 珍珠 奶茶 茶 飲料 饮料 咖啡 果汁 紅茶 绿茶 綠茶
        乌龙 烏龍 拿鐵 latte 波霸 甜度 半糖 全糖 微糖 少冰 多冰 去冰 正常冰 溫 热 熱 冰 大杯 中杯 小杯 一杯 杯 今天 今天下午 下午 第一次
        覺得 感觉 感覺 真的 好好 會不會 會 不會 根本 電話 打電話 反應 星星 一星 二星 三星 四星 五星 評論 评论 google maps 消費者 客人 顧客
        教育 訓練""".split()
    )
}
# Further stop words for keyword exploration, by dataset.
EXPLORATION_STOPWORDS = {
    "drinks": tuple(
        dict.fromkeys(
            """自己 不用 知道 結果 不要 一下 真的 覺得 感觉 感覺 認為 认为 已经 已經 還是 还是 可以 應該 应该 他們 他们 我們 我们 這樣 这样
            那樣 那样 什麼 什么 沒有 没有 就是 因為 因为 所以 如果 但是 但 而且 再 都 也 很 太 更 最 才 只 給 给 讓 让 被 把 對 对 向 從 从
            跟 和 與 与 或 而 且 又 嗎 吗 呢 吧 啊 一定 完全 非常 超級 超级 有點 有点 一些 一點 一点 怎麼 怎么 為什麼 为什么 還要 还要 還會
            还会 人家 大家 東西 东西 事情 希望 可能 本身 店員 店员 服務人員 服务人员 服務員 服务员 員工 员工 櫃台 柜台 收銀 收银 杯 訂單
            订单 點餐 口感 味道 態度 态度 等待 排隊 排队 出餐 速度 製作 制作 等候 分鐘 分钟 時間 时间 今天 明天 昨天 現在 现在 以後 以后
            之前 之後 之后 第一次 第二次 第三次 只是 另外 到底 兩次 確認 店家 店裡 店里 品項 品项 送到 竟然 然後 然后 最後 最后 直接 馬上
            马上 立刻 關於 关于 其實 其实 當然 当然 雖然 虽然 不過 不过 並且 并且 還有 还有 以及 或是 這次 这次 每次 任何 其他 其它 全部 所有
            整個 整个 部分 有些 沒什麼 没什么 沒啥 没啥""".split()
        )
    )
}
# Words a segmenter keeps whole, (word, weight), and words recognition is told of.
SEGMENTER_WORDS = {
    "drinks": (
        ("服務態度", 10), ("店員態度", 10), ("出餐速度", 10), ("等待時間", 10), ("電子發票", 10), ("行動支付", 10), ("50嵐", 100), ("清心", 100),
        ("可不可", 100), ("迷客夏", 100), ("一芳", 100), ("CoCo", 100), ("五十嵐", 100), ("Line Pay", 100), ("LinePay", 100), ("Uber Eats", 100),
        ("foodpanda", 100), ("微冰", 50), ("微糖", 50), ("一分糖", 50), ("半糖", 50), ("全糖", 50), ("少冰", 50), ("去冰", 50), ("波霸", 50), ("珍珠奶茶", 50),
    )
}
RECOGNISER_WORDS = {
    "drinks": (
        "50嵐", "五十嵐", "清心", "可不可", "迷客夏", "一芳", "CoCo", "清心福全", "茶湯會", "大苑子", "麻古", "珍煮丹", "波霸", "珍珠", "微冰",
        "微糖", "一分糖", "半糖", "全糖", "少冰", "去冰", "正常冰", "LinePay", "Line Pay", "LINE Pay", "line pay", "UberEats", "foodpanda", "載具", "發票",
        "電子發票", "服務態度", "店員態度",
    )
}


@dataclass(frozen=True)
class Topic:
    """A complaint topic: phrases that state it, and anchors that state it near a negative."""

    name: str
    phrases: tuple[str, ...]
    anchors: tuple[str, ...] = ()
    negatives: tuple[str, ...] = ()
    word_gap: int = 3
    char_gap: int = 8
    recall_by_polarity: bool = True


@dataclass(frozen=True)
class TopicRules:
    version: str
    topics: tuple[Topic, ...]
    good_bad: tuple[str, ...] = ()
    positives: tuple[str, ...] = ()
    negatives: tuple[str, ...] = ()
    negations: tuple[str, ...] = ()
    weak: frozenset[str] = frozenset()
    negation_aware: frozenset[str] = frozenset()


# The topic rules of the drinks dataset.
DRINKS = TopicRules(
    version="v1.4.1-drinks-funnel-invoice",
    topics=(
        Topic(
            "等待時間",
            tuple("等很久 等超久 久等 排隊 等待太久 出餐慢 等半天 時間管理 等太久 好慢 好久".split()),
            tuple("等 等待 排隊 出餐 速度 等候 製作".split()), tuple("久 慢 太久 很久 超久 超慢 過久 半天".split()), 4, 10,
        ),
        Topic(
            "服務態度",
            tuple("態度差 不耐煩 兇 服務差 白眼 口氣差 沒禮貌 愛理不理 翻白眼 兇巴巴 態度惡劣 很不耐煩".split()),
            tuple("服務態度 態度 店員 服務人員 服務員 員工 櫃台 收銀".split()), tuple("差 不好 爛 糟 差勁 不耐煩 兇 口氣差 白眼 惡劣".split()), 4, 10,
        ),
        Topic(
            "出錯重做",
            tuple("做錯 弄錯 漏單 少做 重做 漏做 沒做 點錯 做不出來 忘記 給錯 飲料做錯 做錯飲料 少給".split()),
            tuple("飲料 杯 訂單 做 給 點 餐".split()), tuple("錯 漏 忘 少 重 給錯 做錯".split()), 4, 10,
        ),
        Topic(
            "品質口感",
            tuple("太甜 太淡 沒味道 難喝 走味 稀 不新鮮 不好喝 太苦 太澀 硬邦邦 珍珠硬".split()),
            tuple("珍珠 奶茶 茶 口感 味道 飲料".split()), tuple("硬 難喝 淡 甜 苦 澀 稀 走味".split()), 3, 8,
        ),
        Topic("安全衛生", tuple("不安全 危險 衛生 髒 脏 地板黏 蟲 異物 不乾淨 不干净".split())),
        Topic(
            "載具發票",
            tuple("沒綁載具 没绑载具 載具沒綁 载具没绑 沒綁发具 發票打錯 发票打错 發票開錯 没开发票 沒開發票 漏開發票 漏开发票".split()),
            tuple("載具 发具 發票 发票 電子發票 电子发票 收據 收据 小票 統編".split()),
            tuple("沒綁 没绑 沒開 没开 漏開 漏开 開錯 开错 打錯 打错 失敗 失败 無法 无法 綁定 绑定".split()), 3, 8, False,
        ),
        Topic(
            "結帳支付",
            ("結帳", "结账", "付錢", "付钱", "付款", "支付", "line pay", "linepay", "信用卡", "行動支付", "行动支付", "找零", "收銀", "收银", "結帳慢", "付款問題"),
            tuple("結帳 结账 付 付款 支付 收銀 收银 line pay".split()), tuple("慢 錯 爛 久 問題 麻烦 麻煩 搞 卡".split()), 4, 12,
        ),
    ),
    good_bad=tuple("好慢 好爛 好差 好難喝 好失望 好扯 好離譜 好糟 好兇 好不耐煩 好臭 好髒 好脏 好苦 好澀 好硬".split()),
    positives=tuple("好喝 很好喝 超好喝 很好 超好 推薦 大推 喜歡 满意 滿意 親切 貼心 讚 赞 棒 優秀 优秀 回購 回购".split()),
    negatives=tuple("差 爛 糟 慢 久 難喝 不好喝 不耐煩 兇 凶 惡劣 失望 問題 糟糕 差勁 白眼 髒 脏 漏 錯 错 忘 少給 少给".split()),
    negations=tuple("不 没 沒 無 无 別 别 未".split()),
    weak=frozenset("排隊 衛生 脏 髒 載具 发具 發票 发票 電子發票 电子发票 收據 收据 小票 統編 统编 結帳 结账 付款 支付 等待 出餐 速度 製作 等候".split()),
    negation_aware=frozenset("難喝 不好喝 沒味道 走味 慢 久 太久 差 爛 糟 甜 淡 苦 澀 硬 稀 髒 脏 不安全 危險".split()),
)
TOPIC_RULES = {"drinks": DRINKS}

# Thresholds of the gates.
SOFT_REJECT, HARD_REJECT, MIN_TEXT = 0.10, 0.30, 4
QUALITY = {
    "noise_ratio": 0.001, "len1_ratio": 0.01, "long_ratio": 0.005, "empty_cleaned_ratio": 0.5, "nonempty_tokens_ratio": 0.3, "char_retention": 0.15,
}
FUZZY_RATIO, FUZZY_ANCHOR_RATIO, FUZZY_MIN_CHARS = 0.78, 0.88, 3
