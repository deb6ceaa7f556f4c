"""Golden cases, and a differential test against Python's own regex engine."""

from __future__ import annotations

import random
import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions import cleaning as C
from nomina.functions import tokens as T

GOLDEN = {
    "1234 5678 болт М10": "5678 болт м10",
    "5W40 масло моторное": "масло моторное",
    "TOYOTA Camry 70": "camry 70",
    "ABC123-XYZ подшипник": "xyz подшипник",
    "1234_5 винт": "1234 5 винт",
    "А4 бумага": "а4 бумага",
    "перелёт Алматы": "перел т алматы",
    "Қазақстан ғимарат": "аза стан имарат",
    "услуга по майонезу": "услуга",
    "болт на 1000 шт": "болт",
    "услуги связи за период январь 2024": "услуги связи",
    "аренда авто за 01.02.2024 г": "аренда авто",
    "★★★": "",
    "": "",
    "майонез": "майонез",  # decomposed й in the middle
    "A – B — C ⁄ D": "a - b - c / d",
}


def cleaned(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", C.clean(F.col("t"), **options).alias("c")).orderBy("i").collect()
    return [r.c for r in rows]


def test_golden_cases(spark):
    assert cleaned(spark, list(GOLDEN)) == list(GOLDEN.values())


def test_null_and_options(spark):
    assert cleaned(spark, [None]) == [""]
    assert cleaned(spark, ["1234 5678 болт М10"], passes=2) == ["болт м10"]
    assert cleaned(spark, ["TOYOTA Camry 70"], keep_codes=True) == ["toyota camry 70"]
    assert cleaned(spark, ["Перелёт"], extra_letters="ёЁ") == ["перелёт"]


def in_python(text: str) -> str:
    """The same chain written for Python's re."""
    text = unicodedata.normalize("NFC", text)
    for old, new in ((fixed.DASH_CLASS + "+", "-"), (f"[{fixed.SLASHES}]", "/")):
        text = re.sub(old, new, text)
    text = re.sub(rf"^\s*(?:{fixed.ARTICLE_CODE})\b[-_/]?\b", " ", text.strip())
    tail = (
        rf"\s+(?:{fixed.DATE_PREPOSITIONS})\s+(?:{fixed.DATE_PERIOD_WORD}\s+)?"
        rf"(?:{fixed.DATE_MONTHS}|{fixed.DATE_DIGITS}).*$"
    )
    text = re.sub(tail, "", text, flags=re.IGNORECASE)
    return " ".join(re.sub(rf"[^\s{fixed.KEPT_CHARS}]", " ", text).split()).lower()


def test_random_texts_agree_with_python(spark):
    pieces = [
        "АБ-17", "ABC1234", "1234", "5W40", "-", "_", "/", "–", "⁄", " ", "  ", "\t", "\n",
        "\x1c", "\x85", "\xa0", "\u2003", "\u3000", " за ", " ПО ", "от", "период ", "январь",
        "МАЙ", "2024", "01.02.2024", "١٢٣٤", "болт", "Ёлка", "е\u0308", "и\u0306", "e\u0301",
        "a\u0323\u0302", "\u212a", "\u1100\u1161", "☺", "𝔘", "қ", "ß", "İ", "%", "(", ")", "+", ".", ",",
        "x", "AB12", "²", "½", "ⅷ", "_x",
    ]
    draw = random.Random(7)
    texts = ["".join(draw.choices(pieces, k=draw.randint(1, 9))) for _ in range(20_000)]
    for text, ours in zip(texts, cleaned(spark, texts)):
        assert ours == in_python(text), ascii(text)


def test_stable_code_points_are_never_recomposed():
    """No character of the JVM-only class may change or combine under NFC."""
    stable = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), C._STABLE) + "]")
    second = set()
    for code in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(code))
        if parts and not parts.startswith("<"):
            second.update(chr(int(p, 16)) for p in parts.split()[1:])
    for code in range(0x3000):
        ch = chr(code)
        if stable.match(ch):
            assert unicodedata.normalize("NFC", ch) == ch, hex(code)
            assert unicodedata.combining(ch) == 0 and ch not in second, hex(code)


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("аб 12 болт м10 гайка",), ("",), ("один",)], "c string")
    words = T.tokenize(F.col("c"))
    rows = df.select(
        words.alias("w"),
        T.informative_tokens(words).alias("i"),
        T.word_ngrams(words).alias("g"),
        T.tfidf_terms(F.lit("a болт м10 b гайка")).alias("t"),
    ).collect()
    assert rows[0].w == ["аб", "12", "болт", "м10", "гайка"]
    assert rows[0].i == ["болт", "м10", "гайка"]
    assert rows[0].g[:2] == ["аб 12", "12 болт"] and rows[0].g[-1] == "болт м10 гайка"
    assert len(rows[0].g) == 7
    assert rows[1].w == [] and rows[1].g == [] and rows[2].g == []
    # One-letter words vanish before bigrams are formed.
    assert rows[0].t == ["болт", "м10", "гайка", "болт м10", "м10 гайка"]


@pytest.mark.parametrize("escape, pattern", [(False, "3.2%.*(к"), (True, r"3\.2%.*\(к")])
def test_draft_rule(spark, escape, pattern):
    row = spark.range(1).select(T.draft_rule(F.lit("3.2% (к"), escape).alias("r")).first().r
    assert (row.pattern, row.category, row.priority) == (pattern, "???", 10)
    assert row.apply_if == ["3.2%"] and row.exclude_if == []
