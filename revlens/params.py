"""Rule tables and thresholds.

Everything here is a *parameter*: operators take these as arguments and the
values below are only the defaults.  The first block holds fixed values that
must stay exactly as written for results to match on Korean review data.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the original rule set for identical results.
# Listed plainly, in their natural order.
# ---------------------------------------------------------------------------

# Brand spellings -> standard brand (lookup after lower + strip; unknown passes through).
BRAND_MAP = {
    "토코보": "tocobo",
    "tocobo": "tocobo",
    "라네즈": "laneige",
    "laneige": "laneige",
    "이니스프리": "innisfree",
    "innisfree": "innisfree",
}

# Category groups: standard name -> variants of the leaf of the category path.
CATEGORY_GROUPS = {
    "스킨": ["스킨", "토너", "skin", "toner"],
    "로션": ["로션", "lotion", "emulsion", "에멀전"],
    "에센스": ["에센스", "essence"],
    "세럼": ["세럼", "serum"],
    "크림": ["크림", "cream"],
    "선스틱": ["선스틱", "sun stick", "sunstick"],
    "선크림": ["선크림", "썬크림", "sun cream", "sunscreen"],
    "클렌저": ["클렌저", "cleanser"],
}

# Ordered synonym rules (pattern, replacement), applied one after another.
SYNONYM_RULES = [
    (r"machine\s*learning|머신\s*learning|머신\s*러닝|ml", "머신러닝"),
    (r"skin\s*care|스킨\s*케어", "스킨케어"),
    (r"skin|toner|토너", "스킨"),
    (r"lotion|emulsion|에멀전", "로션"),
    (r"essence|에센스", "에센스"),
    (r"serum|세럼", "세럼"),
    (r"cream|크림", "크림"),
    (r"sun\s*stick|sunstick|선\s*스틱", "선스틱"),
    (r"sun\s*cream|sunscreen|썬\s*크림|선\s*크림", "선크림"),
    (r"cleanser|cleansing\s*foam|폼\s*클렌저", "클렌저"),
]

# Noise patterns removed (replaced by a space) from product names, in order.
NOISE_RULES = [
    r"\[.*?\]",
    r"\d+\s?(ml|g)",
    r"\d+\s?개(입)?",
    r"spf\s?\d+\+?",
    r"pa\+{1,4}",
    r"[★☆■◆▶️,]",
]

# Product-name token map and dropped tokens.
TOKEN_MAP = {
    "썬스틱": "선스틱",
    "스틱": "선스틱",
    "유브이": "선케어",
    "선": "선케어",
}
DROP_TOKENS = ["퍼펙션", "프레쉬", "마스터즈", "내추럴"]

# Keyword groups (skin types) and their keywords, in order.
GROUP_KEYWORDS = {
    "건성": ["건성"],
    "지성": ["지성", "지성인"],
    "복합성": ["복합", "복합성"],
    "민감성": ["민감", "민감성"],
    "여드름성": ["여드름", "여드름성"],
}
MIXED_PREFIX = "복합/혼합("
MIXED_SUFFIX = ")"
UNCLASSIFIED = "미분류"

# Review-text whitelist (everything else is removed) and token-text class.
REVIEW_TEXT_KEEP = r"가-힣a-zA-Z0-9\s.,!?~❤️"
TOKEN_TEXT_KEEP = r"가-힣0-9\s"
JAMO_CLASS = r"ㄱ-ㅎㅏ-ㅣ"

# Sentiment label from star score: >= 4 positive (1), <= 2 negative (0), else NULL.
POSITIVE_MIN_SCORE = 4
NEGATIVE_MAX_SCORE = 2

# Keyword thresholds: (top_n, min_doc_freq) per level.
KEYWORD_TOP_N = 30
MIN_DOC_FREQ_GLOBAL = 20
MIN_DOC_FREQ_CATEGORY = 20
MIN_DOC_FREQ_PRODUCT = 5
WEIGHTED_TOP_N = 50
GROUP_WORD_TOP_N = 20
NAME_TOKEN_TOP_N = 30
LABEL_WORD_TOP_N = 100

# Products need this many collected (text side) / declared (no-text side) reviews.
MIN_REVIEWS_PER_PRODUCT = 30

# Lower edges of the review-count histogram bins (last bin open-ended).
REVIEW_COUNT_BINS = (1, 2, 3, 5, 10, 20, 50, 100, 200, 500, 1000)
VALID_SCORES = (1, 2, 3, 4, 5)

# Fixed keys of the statistics document -> result table.  The per-product table
# (`product_review_descending`) grows with the data and stays a table of its own.
STATS_KEYS = {
    "category_count": "category_product",
    "category_score_part_count": "category_score_distribution",
    "category_mean_score": "category_score_summary",
    "total_review_bins_count": "product_review_count_bins",
    "summary": "product_review_count_summary",
    "score_count": "score_distribution",
}

# Star-label words -> score, used when reading rating counts from page text.
STAR_LABELS = [("최고", 5), ("좋음", 4), ("보통", 3), ("별로", 2), ("나쁨", 1)]

# Delivery type from the badge image URL: (substring, type) in order, then default.
DELIVERY_RULES = [
    ("rocket-fresh", "로켓프레시"),
    ("badge_1998ab96bf7", "로켓배송(쿠팡)"),
    ("badge_1998ab98cb6", "로켓배송(파트너사)"),
    ("badge_199559e56f7", "판매자 로켓"),
    ("global_b", "로켓 직구"),
]
DELIVERY_DEFAULT = "일반배송"

# Fixed values of the shop pages: where a field stands, as steps of (tag, class, ...) from the
# outside in; the first place with text wins.
PRODUCT_PLACES = {
    "product_name": [[("h1", "product-title"), ("span", "twc-font-bold")], [("h2", "prod-buy-header__title")]],
    "price": [[("div", "price-amount", "final-price-amount")],
              [("div", "option-table-list__option--selected"), ("div", "option-table-list__option-price")]],
    "total_reviews": [[("span", "rating-count-txt")]],
    "brand": [[("div", "twc-font-bold", "twc-text-[14px]", "twc-text-[#111]", "twc-leading-[17px]")],
              [("div", "twc-mb-[12px]", "twc-text-[14px]", "twc-leading-[17px]", "twc-text-[#346AFF]")],
              [("div", "twc-text-sm", "twc-text-blue-600")]],
    "badge": [[("span", "twc-ml-[3px]")]],
}
DELIVERY_IMAGE = r'(?s)<div[^>]*price-badge[^>]*>.*?<img[^>]*src="([^"]*)"'
UNKNOWN_NAME = "Unknown"
OFFICIAL_BADGE = "로켓배송 · 브랜드 본사 정품"

# Fixed values of a review on the shop pages.
REVIEW_BLOCK = r'(?s)<article[^>]*twc-border-bluegray-200[^>]*>(.*?)</article>'
REVIEW_PLACES = {
    "date": [[("div", "twc-text-bluegray-700")]],
    "nickname": [[("span", "twc-text-[16px]/[19px]", "twc-font-bold", "twc-text-bluegray-900")]],
    "title": [[("div", "twc-font-bold", "twc-text-bluegray-900")]],
    "content": [[("span", "twc-bg-white")]],
}
REVIEW_STAR = "twc-bg-full-star"
REVIEW_IMAGE = r'(?s)twc-overflow-x-auto[^>]*twc-scrollbar-hidden[^>]*>.*?<img'
REVIEW_HELPFUL = r"([0-9]+)명에게"

# Collection quotas: reviews per (product, star) and the per-category review cap.
STAR_QUOTA_TARGET = 200
STAR_QUOTA_SHARE = 0.25
CATEGORY_REVIEW_CAP = 50_000

# Word vectors.
W2V_DIM = 100
W2V_WINDOW = 5
W2V_MIN_COUNT = 3
EMBED_BATCH = 32
EMBED_MAX_TOKENS = 512

UNKNOWN_CATEGORY = "UNKNOWN_CATEGORY"

# ---------------------------------------------------------------------------
# Our own parameter sets for the Latin-script bindings on the driver tables.
# ---------------------------------------------------------------------------

# A short English function-word list (ours) for the `documents` binding.
ENGLISH_STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he",
    "in", "is", "it", "its", "of", "on", "or", "that", "the", "this", "to",
    "was", "were", "will", "with",
]

# ASCII rule lists used by the product-name bindings on `part`.
ASCII_SYNONYM_RULES = [
    (r"small\s*ring|tiny\s*ring", "minering"),
    (r"widget", "gadget"),
    (r"red|crimson", "rouge"),
    (r"gadget", "device"),
]
ASCII_NOISE_RULES = [
    r"\[.*?\]",
    r"\d+\s?(ml|g)",
    r"\d+\s?pcs",
    r"[*#,]",
]
ASCII_TOKEN_MAP = {"device": "tool", "bolt": "fastener"}
ASCII_DROP_TOKENS = ["hot", "cold"]
ASCII_GROUP_KEYWORDS = {
    "g_blue": ["blue"],
    "g_red": ["red", "rouge"],
    "g_small": ["small", "tiny"],
    "g_metal": ["bolt", "gear"],
}
