"""Word lists, patterns, thresholds and labels that results depend on."""

URL_PATTERNS = (
    r"https?://[^\s，。；、\"'<>()]+",
    r"(?:^|\s)www\.[\w\-]+(?:\.[\w\-]+)+",
    r"(?:^|[^a-z0-9@])[\w\-]+\.(?:com\.cn|com|cn|net|org|io|co|cc|biz|info|shop|store|online|xyz|top|vip|club|site|me|us)(?:\b|[/\s])",
)
COMPANY_LABELS = ("mfg", "inc", "ltd", "llc", "corp", "co", "intl", "etc", "org")
EMAIL_PATTERNS = (r"\b[\w.+-]+@[\w-]+(?:\.[\w-]+)+\b",)
PHONE_PATTERNS = (r"\+\d{1,3}[- ]?\d{5,14}\b", r"(?:tel|phone|mobile|电话|手机|contact)[:：\s]*[\d\- .]{7,18}")
PHONE_WEAK_PATTERNS = (r"\b1[3-9]\d{9}\b", r"\b1[-.]\d{3}[-.]\d{3}[-.]\d{4}\b", r"\b\d{3}[-.]\d{3}[-.]\d{4}\b")
US_PHONE_PATTERNS = (r"\b1[-.]\d{3}[-.]\d{3}[-.]\d{4}\b", r"\b\d{3}[-.]\d{3}[-.]\d{4}\b")
PLACEHOLDER_DIGITS = ("1234567890", "0123456789", "9876543210", "0987654321")
QQ_PATTERNS = (r"(?:qq|扣扣)[:：\s]*[1-9]\d{4,11}\b",)
PRICE_PATTERNS = (
    r"[$￥¥]\s?\d[\d,]*(?:\.\d+)?",
    r"\bUSD\s?\d[\d,.]*",
    r"\b\d[\d,.]*\s?(?:USD|EUR|GBP|RMB|CNY)\b",
    r"\bprice\s*[:：]?\s*[$￥¥]?\s?\d",
    r"\b(?:only|just)\s*[:：]?\s*[$￥¥]\s?\d",
)
#: Each stands between characters that are neither letters nor digits.
PROMO_PHRASES = (
    r"free\s*shipping", r"free\s*delivery", r"free\s*sample", r"free\s*design",
    r"free\s*gift", r"special\s*price", r"hot\s*sale", r"best\s*price",
)
OVERLAY_PATTERNS = (
    r"faster\s*shipping", r"fastershipping", r"faster\s*delivery", r"fastdelivery", r"two\s*warehouses", r"u\.?\s*s\.?\s*seller",
    r"us\s*seller", r"authorized\s*dealer", r"official\s*stockist", r"\bstockist\b", r"contact\s*seller", r"contactseller",
    r"picture will be uploaded", r"uploaded shortly", r"uploaded soon", r"\bdealer\b", r"genuine\s*parts", r"questions\?", r"fitment\s*chart",
)
OVERLAY_WEAK_PATTERNS = (r"\bwarehouse\b", r"\bcatalog\b")
CONTACT_KEYWORDS = ("微信", "微信号", "wechat", "weixin", "qq号", "电话", "手机", "联系电话", "邮箱", "toll free")
CONTACT_WEAK_KEYWORDS = ("contact us", "联系我们", "qq", "whatsapp", "whats app", "telegram", "facebook", "instagram", "twitter", "youtube")
PROMO_KEYWORDS = (
    "free shipping", "free design", "free sample", "free delivery", "special price", "hot sale", "best price",
    "促销", "优惠", "特价", "包邮", "免运费", "免费", "打折",
)
PROMO_WEAK_KEYWORDS = (
    "shipping", "seller", "worldwide", "ships from", "we ship", "ships to", "us seller", "save big", "buy now", "order now", "click here",
    "limited offer", "act now", "don't miss", "ukseller", "uk seller", "shipment", "ships worldwide", "ship from", "selling", "welcome to",
    "visit our", "our store", "clearance", "limited time",
)
PROMO_IGNORE_PHRASES = ("fast shipping", "fast delivery", "same day shipping", "quick shipping", "expedited shipping", "fast stock shipping")
PLATFORM_KEYWORDS = (
    "ebay", "amazon", "alibaba", "aliexpress", "dhgate", "1688", "taobao", "淘宝", "天猫", "tmall", "京东", "jd.com", "拼多多", "pinduoduo",
    "shopify", "wish", "etsy", "positive feedback", "top-rated seller", "member since", "add to cart", "buy it now", "customer reviews",
)
MARK_KEYWORDS = (
    "厂家直销", "质量保证", "现货供应", "样张", "样图", "水印", "版权", "原创", "禁止转载", "未经允许", "盗图必究", "摄影", "供图", "视觉中国", "图虫",
    "站酷", "lofter", "小红书", "微博", "抖音", "快手", "bilibili", "知乎", "网易", "腾讯", "新浪", "搜狐", "图虫创意", "东方ic", "全景", "摄图网",
    "千图网", "昵图网", "包图网", "watermark", "gettyimages", "shutterstock", "adobe stock", "istock", "dreamstime", "alamy", "depositphotos",
    "draft", "preview", "bigstock", "canstock", "fotolia", "pond5", "123rf", "pixabay", "unsplash", "pexels", "freepik",
)
MARK_WEAK_KEYWORDS = ("copyright", "sample")
KEEP_LEXICON = (
    "product parameters", "technical specification", "specification sheet", "specifications", "parameters", "parameter", "length", "width",
    "height", "dimension", "dimensions", "size", "part no", "part number", "model no", "model number", "reference number", "material", "color",
    "colour", "weight", "capacity", "voltage", "power", "installation", "assembly", "exploded view", "drawing", "cad", "blueprint", "fitment",
    "compatible", "oem", "partsnumber", "parts number", "parts list", "qty", "bill of materials", "diameter", "shaft length", "available in",
    "availablein", "参数", "规格", "尺寸", "型号", "图纸", "结构图", "爆炸图", "零件图", "装配图", "工程图", "技术图",
)

LINES, CONFIDENCE = 60, 0.55
TINY_SIDE, SMALL_SIDE, TINY_AREA = 80, 150, 8000
BLANK_STD, NEAR_STD, BLANK_UNIFORM, NEAR_UNIFORM = 5.0, 7.0, 0.97, 0.90
LOGO_COLOURS, LOGO_LENGTH = 4, 60
BLUR_SEVERE, BLUR_SLIGHT = 8.0, 15.0
MODEL_MOVE, MODEL_REVIEW = 0.3, 0.15
LIBRARY_SIMILARITY = 0.98

#: Labels of the rules. Fixed: results depend on these values.
RULES = {
    "corrupt": "4-无效图片(损坏/无法解码)",
    "tiny": "4-无效图片(过小缩略图)",
    "blank": "4-无效图片(空白/纯色)",
    "blur": "4-无效图片(严重模糊)",
    "failed": "4-无效图片(未捕获异常)",
    "url": "2-包含网址信息",
    "contact": "3-包含联系方式",
    "qr": "3-联系方式(二维码)",
    "promo": "5-促销/免费配送信息",
    "price": "6-包含价格信息",
    "logo": "7-纯LOGO/商标图片",
    "watermark": "9-水印图片",
    "ecommerce": "10-电商网站标识",
    "overlay": "11-营销水印/卖家横幅",
    "model": "9-水印图片(模型高置信)",
    "library": "参照库相似图(>=95%)",
    "review": "待审核",
    "unsure": "待确认(不确定即移动)",
    "duplicate": "重复图片(指纹联动)",
    "user_move": "用户审核确认(移动)",
    "user_keep": "用户审核确认(保留)",
    "none": "-",
}

#: What evidence says before its value. Fixed: reports are read by these words.
EVIDENCE = {
    "corrupt": "无法解码: ", "tiny": "尺寸过小 ", "small": "尺寸偏小 ", "qr": "检测到二维码(按用户口径待确认): ", "blank": "纯色/空白图 ",
    "near_blank": "疑似纯色/空白 ", "severe_blur": "严重模糊 lap_var=", "slight_blur": "疑似模糊 lap_var=", "watermark_weak": "疑似水印(弱信号): ",
    "marketing_weak": "疑似营销横幅(弱信号): ", "url": "营销类网址/域名: ", "contact": "联系方式: ", "price": "价格信息: ", "promo": "促销宣传: ",
    "ecommerce": "电商平台: ", "watermark": "水印关键词: ", "overlay": "营销水印/卖家横幅: ", "logo": "纯LOGO/品牌图（文字简短、色彩少 ncolors=",
    "model_high": "水印模型高置信(概率", "model_some": "水印模型候选(概率", "library": "与参照库相似度", "duplicate": "与同指纹图片联动（MD5 ",
    "user": "套用用户审核结论", "failed": "异常: ",
}
#: Types of disagreement in the mismatch report.
MISMATCH = {"FP": "我们移动/参考保留", "FN": "参考移动/我们保留"}

IMAGE_EXTENSIONS = (".webp", ".jpg", ".jpeg", ".png", ".bmp", ".gif", ".avif")
PHOTO_EXTENSIONS = (".webp", ".jpg", ".jpeg", ".png")
SKIPPED_FOLDERS = (".cache_thumbs", "err", "err(1)", "watermark_output", "clean_report", "output", "visualized", "review")

#: Columns of the report file and the fields they show.
REPORT_COLUMNS = {
    "filename": "文件名", "orig_path": "原始路径", "decision": "决策", "rule": "规则", "evidence": "证据", "score": "得分", "w": "宽", "h": "高",
    "bytes": "字节", "lum_mean": "亮度均值", "lum_std": "亮度标准差", "edge_mean": "边缘密度", "ncolors16": "色彩数", "uniform_pct": "均匀度",
    "blur_var": "模糊分", "transparent_score": "半透明水印分", "logo_score": "图形水印分", "qr": "二维码", "fingerprint": "指纹",
    "wm_prob": "水印模型分", "ocr_text": "OCR文本", "ocr_low": "OCR低置信中文", "run_ts": "时间",
}
