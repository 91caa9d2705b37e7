"""Domain constants shared by every layer."""

# Order states, and the states that make an order valid.
ORDER_STATUSES = ("paid", "shipped", "received", "refunded", "cancelled")
VALID_STATUSES = ("paid", "shipped", "received")
STATUS_WEIGHTS = (0.65, 0.15, 0.10, 0.05, 0.05)

# User attributes and their weights.
GENDERS = ("M", "F")
USER_LEVELS = ("Bronze", "Silver", "Gold", "Platinum", "Diamond")
USER_LEVEL_WEIGHTS = (0.5, 0.25, 0.15, 0.07, 0.03)
AGE_CENTRES = (18, 25, 35, 45, 55, 65)
AGE_WEIGHTS = (5, 35, 30, 18, 9, 3)
CITIES = (
    "北京", "上海", "广州", "深圳", "杭州", "成都", "武汉", "西安",
    "南京", "苏州", "天津", "重庆", "长沙", "青岛", "宁波", "无锡",
    "佛山", "东莞", "郑州", "厦门", "福州", "济南", "合肥", "昆明",
)

# Items per order and quantity per item, with their weights.
ITEM_COUNTS = (1, 2, 3, 4, 5)
ITEM_COUNT_WEIGHTS = (40, 30, 15, 10, 5)
QUANTITIES = (1, 2, 3, 4, 5)
QUANTITY_WEIGHTS = (60, 20, 10, 5, 5)
ITEM_PRICE_LOG_MEAN, ITEM_PRICE_LOG_SD = 5.0, 1.0
ITEM_PRICE_MIN, ITEM_PRICE_MAX = 5.0, 5000.0

# Category -> (sub-categories, brands, lowest and highest price).
PRODUCT_CATEGORIES = {
    "服装": (
        ("男装", "女装", "童装", "运动装", "内衣"),
        ("优衣库", "ZARA", "H&M", "Nike", "Adidas", "李宁", "安踏"),
        (50, 2000),
    ),
    "3C数码": (
        ("手机", "电脑", "平板", "耳机", "智能手表", "相机"),
        ("Apple", "华为", "小米", "OPPO", "vivo", "联想", "戴尔"),
        (200, 15000),
    ),
    "美妆": (
        ("护肤", "彩妆", "香水", "面膜", "洗护"),
        ("兰蔻", "雅诗兰黛", "SK-II", "资生堂", "完美日记", "花西子"),
        (30, 3000),
    ),
    "食品": (
        ("零食", "饮料", "生鲜", "茶叶", "酒水", "调味品"),
        ("三只松鼠", "良品铺子", "百草味", "农夫山泉", "可口可乐"),
        (10, 500),
    ),
    "家居": (
        ("床上用品", "厨房用品", "收纳", "清洁", "灯具"),
        ("宜家", "罗莱", "水星家纺", "双立人", "苏泊尔"),
        (20, 5000),
    ),
}

# RFM segments as (code, label, marketing strategy).
SEGMENTS = (
    ("A_Important_Value", "重要价值客户", "VIP 专属服务 + 新品优先体验"),
    ("B_Important_Develop", "重要发展客户", "推送新客优惠券,刺激复购"),
    ("C_Important_Keep", "重要保持客户", "定期唤醒邮件,防流失"),
    ("D_Important_Recover", "重要挽留客户", "大额优惠券 + 客服主动联系"),
    ("E_General_Value", "一般价值客户", "保持现状,偶尔推送"),
    ("F_General_Develop", "一般发展客户", "新客礼包 + 引导探索"),
    ("G_General_Keep", "一般保持客户", "标准推送"),
    ("H_Churned", "流失客户", "不投入营销资源"),
)

# Threshold bins used in reports.
LEVEL_NAMES = ("高", "中", "低")
RECENCY_DAYS = (30, 90)
FREQUENCY_ORDERS = (5, 2)
MONETARY_AMOUNTS = (5000, 1000)
REPURCHASE_BINS = ((7, "0-7天"), (30, "8-30天"), (90, "31-90天"), (180, "91-180天"))
REPURCHASE_REST = "180天以上"
REPURCHASE_BINS_SHORT = ((7, "0-7天"), (30, "8-30天"), (90, "31-90天"))
REPURCHASE_REST_SHORT = "90天以上"

# Accepted row counts of the summary tables in the published run.
PUBLISHED_ROW_BANDS = {
    "dws_user_summary": (90_000, 110_000),
    "dws_product_summary": (4_500, 5_500),
    "dws_date_summary": (300, 400),
}
SUSPICIOUS_AMOUNT = 100_000
