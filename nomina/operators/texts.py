"""Costly work on texts: spread over tasks, and done once for equal texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.functions.cleaning import cast_text, clean
from nomina.scratch import attach_by_weight, materialise

# Stored bytes of a table per task of costly work, and the most tasks. Cleaning takes
# about a second for two megabytes of stored prose.
TASK_BYTES, MOST_TASKS = 1 << 20, 100_000
# Distinct short texts per task of costly work.
TEXTS_PER_TASK = 2000
# Statistics from here on say that the size is not known.
UNKNOWN = 1 << 60


def spread(df: DataFrame) -> DataFrame:
    """Rows of a stored table, dealt over enough tasks for costly work on them.

    A file with one row group is one task however large it is. A task shall have
    TASK_BYTES of the table, as the scan's statistics tell its size, but there are
    MOST_TASKS at most. Rows of a scan that has as many tasks by itself, as that of
    any large table has, stay where they are.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= UNKNOWN:
        return df
    wanted = min(MOST_TASKS, 1 + size // TASK_BYTES)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def clean_rows(df: DataFrame, text: str, out: str = "clean", **options) -> DataFrame:
    """Add the cleaned text to the rows of a stored table of long or unique texts."""
    return spread(df).withColumn(out, clean(F.col(text), **options))


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """Each text once, as text, with its number of rows ``n``. Equal texts are
    combined before the shuffle, so a text with very many copies is no burden."""
    value = cast_text(F.col(text)).alias(text)
    return df.select(value).groupBy(text).agg(F.count("*").alias("n"))


def digest(text: Column) -> Column:
    """128 bits that stand for a text where carrying it would cost more."""
    return F.unhex(F.md5(text))


def clean_distinct(
    df: DataFrame, text: str, out: str = "clean", digest_as: str | None = None, **options
) -> DataFrame:
    """(text, n, out): each text once, with its rows and cleaned, as a written table.
    ``digest_as`` names a column with its digest, which then takes the text's place."""
    texts = materialise(distinct_texts(df, text), "distinct")
    dealt = texts.repartition(1 + texts.count() // TEXTS_PER_TASK)
    known = F.col(text) if digest_as is None else digest(F.col(text)).alias(digest_as)
    return materialise(dealt.select(known, "n", clean(F.col(text), **options).alias(out)), "texts")


def clean_by_text(df: DataFrame, text: str, out: str = "clean", **options) -> DataFrame:
    """Add the cleaned text to rows of short texts that repeat: each is cleaned once
    and joined back."""
    memo = clean_distinct(df, text, out, **options).withColumnRenamed(text, "_text")
    rows = df.withColumn("_text", cast_text(F.col(text)))
    return attach_by_weight(rows, memo, "_text", "n").select(*df.columns, out)
