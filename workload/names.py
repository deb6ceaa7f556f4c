"""Short Russian/English names derived from ``lineitem``.

The given tables hold no Cyrillic text. Every lineitem row gives one name: a
prefix by order key, a phrase by part key and a suffix by supplier key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina.sources.tables import read_table

# Fixed values of the test data.
PREFIXES = ["", "АБ-17 ", "ABC1234 ", "1234 ", "5W40 ", "AB12-", "  ", "1234 5678 "]
PHRASES = [
    "Подшипник шариковый 6205", "Масло моторное синтетическое", "Аренда офиса",
    "Болт М10 оцинкованный", "Услуги по охране объекта", "Ноутбук Lenovo 15",
    "Товар неизвестный", "Сборник стихов", "Сбор за обслуживание", "Обои виниловые",
    "Кофе молотый", "Питание персонала", "Билет на парковку", "Авиабилет Алматы – Астана",
    "Бумага А4 офисная", "Картридж HP", "Принтер лазерный", "Перелёт Актау",
    "Кабель ВВГ 3х2.5", "Труба ПНД", "Краска акриловая", "Молоко 3,2%",
    "Сопровождение 1С", "Страхование груза", "Ремонт принтера", "Монтаж окон",
    "тест", "Алматы", "ТОО", "★★★", "", "Чай «Жұлдыз»", "USB кабель",
    "Hotel Astana room", "Шина R17", "Лампа LED", "Юридическая консультация",
    "Обучение персонала", "Услуга", "Услуга по майонезу",
]
SUFFIXES = [
    "", " за период январь 2024", " за 01.02.2024 г", " на 1000 шт", " №5", " ⁄ шт",
    " (комплект)", " от 2024 года",
]


def _pick(values: list[str], key: str) -> Column:
    at = (F.col(key) % len(values)).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{table}.parquet")


def name_column() -> Column:
    return F.concat(
        _pick(PREFIXES, "l_orderkey"), _pick(PHRASES, "l_partkey"), _pick(SUFFIXES, "l_suppkey")
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, name), one row per lineitem row."""
    rows = read(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", name_column().alias("name"))


def decomposed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same names with the letter й of every odd line written as и plus a
    combining breve."""
    odd = F.col("l_linenumber") % 2 == 1
    split = F.replace(F.col("name"), F.lit("й"), F.lit("й"))
    return names(spark, sf_dir).withColumn("name", F.when(odd, split).otherwise(F.col("name")))
