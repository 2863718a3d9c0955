"""Default dictionaries and settings.

Every operator takes its dictionary as a parameter; the values below are only
the defaults a news-monitoring user starts from.
"""

# --- fixed values: must equal the published defaults for equal results -------

ENTITY_ALIASES = {
    "Сбербанк": ["сбербанк", "сбер", "сбера"],
    "ВТБ": ["втб", "банк втб"],
    "Газпромбанк": ["газпромбанк"],
    "Альфа-Банк": ["альфа-банк", "альфа банк", "альфа"],
    "Т-Банк": ["т-банк", "тинькофф", "тинькофф банк"],
    "Россельхозбанк": ["россельхозбанк", "рсхб"],
    "Росбанк": ["росбанк"],
}
UNKNOWN_ENTITY = "Не определено"

RISK_TERM_WEIGHTS = {
    "санкц": 0.28,
    "суд": 0.20,
    "иск": 0.17,
    "мошен": 0.25,
    "хак": 0.24,
    "уголов": 0.24,
    "штраф": 0.20,
    "банкрот": 0.22,
    "отзыв": 0.26,
    "провер": 0.12,
    "наруш": 0.18,
}
BASE_SCORE = 0.12
MAX_SCORE = 0.99

ALERT_THRESHOLD = 0.5
KEYWORD_MODEL = "fallback_keyword_model"
LINEAR_MODEL = "tfidf_student_v2b"

REQUIRED_COLUMNS = ["title", "text_fragment"]
OPTIONAL_COLUMNS = ["source", "url", "published_at", "entity_norm"]
RESULT_COLUMNS = [
    "title", "entity_norm", "text_fragment", "risk_score", "alert_flag", "model_name", "threshold",
]
TEACHER_COLUMNS = ["sample_id", "teacher_label", "teacher_confidence"]

# Text values a CSV reader with default missing-value handling reads as null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

NO_RISK = "no_risk"
SOFT_LABEL_FLOOR = 1e-4
CARD_PREVIEW_CHARS = 350

SWEEP_GRID = (0.30, 0.05, 13)        # start, step, points: 0.30 .. 0.90
WIDE_SWEEP_GRID = (0.10, 0.05, 17)   # 0.10 .. 0.90
REVIEW_GRID = [0.55, 0.60, 0.65, 0.70, 0.75, 0.80]
ALPHA_GRID = [0.2, 0.3, 0.5]
C_GRID = [0.5, 1.0, 2.0, 5.0]
NEAR_DUPLICATE_THRESHOLDS = (0.80, 0.85)

PLAN_NAME = "Базовый"
SUBSCRIPTION_DAYS = 30
SUBSCRIPTION_PRICE = 100.0
TOP_UP_AMOUNT = 100.0
TOP_UP = "top_up"
PURCHASE = "subscription_purchase"

# --- end of fixed values ------------------------------------------------------
