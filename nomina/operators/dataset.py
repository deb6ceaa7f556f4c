"""Row filters and duplicates for data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.labels import has_text, is_junk, is_labeled
from nomina.scratch import attach, materialise


def drop_nulls(df: DataFrame, text: str = "text", category: str = "category") -> DataFrame:
    return df.dropna(subset=[text, category])


def drop_junk(
    df: DataFrame, category: str = "category", prefix: str = fixed.JUNK_PREFIX
) -> DataFrame:
    return df.where(~is_junk(F.col(category), prefix))


def drop_empty_clean(df: DataFrame, clean: str = "clean") -> DataFrame:
    return df.where(has_text(F.col(clean)))


def dedupe_prefer_labeled(
    df: DataFrame, text: str = "text", category: str = "category", source: str = "source"
) -> DataFrame:
    """One row per text, a labelled one if there is any.

    A minimum per text, combined before the shuffle: copies of one text are not
    gathered in one task.
    """
    rank = F.struct(
        (~is_labeled(F.col(category))).alias("open"), F.col(category), F.col(source)
    )
    best = df.groupBy(text).agg(F.min(rank).alias("_best"))
    return best.select(text, f"_best.{category}", f"_best.{source}")


def frequent_classes(df: DataFrame, minimum: int, category: str = "category") -> DataFrame:
    """Classes with at least ``minimum`` rows: (category, cnt)."""
    counts = df.groupBy(category).agg(F.count("*").alias("cnt"))
    return counts.where(F.col("cnt") >= minimum)


def keep_frequent_classes(df: DataFrame, minimum: int, category: str = "category") -> DataFrame:
    """Rows of the classes with at least ``minimum`` rows. ``df`` is read twice."""
    good = materialise(frequent_classes(df, minimum, category).select(category), "classes")
    return attach(df, good, [category], "left_semi").select(*df.columns)
