"""Fixed values shared by the whole library.

Labels, anchors and character classes below are data, not choices: results are
only right when they keep exactly these values.
"""

# ---- special labels -------------------------------------------------------
FALLBACK_LABEL = "Прочее / Требует доработки"
EMPTY_LABEL = "Пустое наименование"
JUNK_PREFIX = "МУСОР"
LEVEL_SEPARATOR = " → "
DRAFT_CATEGORY = "???"

# ---- anchors: pattern, category; the first that matches wins --------------
ANCHORS = [
    ("сопровождение.*сап|1с|функциональн", "Услуги → Сопровождение ИС"),
    ("принтер", "Оргтехника → Принтеры"),
    ("бумага.*офис", "Канцелярия → Бумага"),
    ("молоко|кефир|йогурт|нектар|буренкино|palma", "Продукты питания"),
]

# ---- text cleaning --------------------------------------------------------
# Dash runs folded to "-": U+2010..U+2013, U+2014, U+2212. ASCII "-" is not in.
DASH_CLASS = "[‐-–—−]"
# Slashes folded to "/": U+2044, U+2215.
SLASHES = "⁄∕"
# Leading article code: upper-case Latin letters and digits.
ARTICLE_CODE = "[A-Z0-9]{4,}|[0-9]{3,}|[A-Z]{2,}[0-9]{2,}|[0-9]{2,}[A-Z]{2,}"
# A trailing date starts with one of these prepositions ...
DATE_PREPOSITIONS = "за|от|по|на"
DATE_PERIOD_WORD = "период"
# ... and goes on with a month in the nominative, a year or a dotted date.
DATE_MONTHS = (
    "январь|февраль|март|апрель|май|июнь|июль|август|сентябрь|октябрь|ноябрь|декабрь"
)
DATE_DIGITS = r"\d{4}|\d{2}\.\d{2}\.\d{4}"
# Letters, digits and signs that survive cleaning (white space survives too).
KEPT_CHARS = r"a-zA-Zа-яА-Я0-9.,%\-+/()"

# ---- text tokens read as "no value" by the raw CSV readers ----------------
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# ---- defaults of the operators --------------------------------------------
TOP_WORDS, MIN_WORD_COUNT = 3000, 25
TOP_NGRAMS, MIN_NGRAM_COUNT = 500, 80
TOP_UNMATCHED = 400
TOP_CATEGORIES = 20
DRAFT_PRIORITY = 10
QA_SAMPLE_ROWS = 1000
SEED = 42
TRAIN_MIN_PER_CLASS, TRAIN_MAX_PER_CLASS = 50, 100_000
FINETUNE_MIN_PER_CLASS, FINETUNE_MAX_PER_CLASS = 200, 50_000
VALIDATION_SHARE = 0.1
ORDERED_TRAIN_SHARE = 0.95
TFIDF_MIN_DF, TFIDF_MAX_DF, TFIDF_MAX_FEATURES = 5, 0.9, 200_000
SVM_C = 1.0
SVM_MAX_ITER, SVM_TOL = 10_000, 1e-4
