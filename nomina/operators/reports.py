"""Reports: coverage, category and source counts, classification quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.labels import category_levels, is_labeled


def category_counts(df: DataFrame, category: str = "category") -> DataFrame:
    """Rows per category, nulls left out, most frequent first."""
    counts = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), category)


def top_categories(
    df: DataFrame, k: int = fixed.TOP_CATEGORIES, category: str = "category"
) -> DataFrame:
    return category_counts(df, category).limit(k)


def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    return category_counts(df, source)


def distinct_categories(df: DataFrame, category: str = "category") -> DataFrame:
    return df.agg(F.countDistinct(category).alias("categories"))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100)


def coverage(df: DataFrame, category: str = "category") -> DataFrame:
    """Total, labelled and unmatched rows and the share that is labelled."""
    counts = df.agg(
        F.count("*").alias("total"), F.count_if(is_labeled(F.col(category))).alias("labeled")
    )
    return counts.select(
        "total",
        "labeled",
        _percent(F.col("labeled"), F.col("total")).alias("coverage"),
        (F.col("total") - F.col("labeled")).alias("unmatched"),
    )


def coverage_delta(before: DataFrame, after: DataFrame, category: str = "category") -> DataFrame:
    """Coverage before and after a step, and the gain in points."""
    late = F.col("late")
    tagged = before.select(category, F.lit(False).alias("late")).unionAll(
        after.select(category, F.lit(True).alias("late"))
    )
    left_over = F.col(category) == fixed.FALLBACK_LABEL
    counts = tagged.agg(
        F.count_if(~late).alias("total"),
        F.count_if(~late & left_over).alias("fallback_before"),
        F.count_if(late & left_over).alias("fallback_after"),
    )
    total = F.col("total")
    early = _percent(total - F.col("fallback_before"), total)
    final = _percent(total - F.col("fallback_after"), total)
    return counts.select(
        "*",
        early.alias("coverage_before"),
        final.alias("coverage_after"),
        (final - early).alias("gain"),
    )


def level_rollup(
    df: DataFrame, category: str = "category", source: str = "source"
) -> DataFrame:
    """Rows per top level, second level and source, with subtotals. Rows are
    counted per category first; only that small table is rolled up."""
    counts = df.groupBy(category, source).agg(F.count("*").alias("_rows"))
    levels = category_levels(F.col(category))
    parts = counts.select(
        F.get(levels, 0).alias("level1"),
        F.coalesce(F.get(levels, 1), F.lit("")).alias("level2"),
        F.col(source).alias("source"),
        "_rows",
    )
    return parts.rollup("level1", "level2", "source").agg(
        F.sum("_rows").alias("cnt"),
        F.grouping_id().cast("int").alias("depth"),
    )


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows per (truth, predicted)."""
    pair = [F.col(truth).alias("truth"), F.col(predicted).alias("predicted")]
    return df.select(*pair).groupBy("truth", "predicted").agg(F.count("*").alias("cnt"))


def class_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as truth or as
    prediction, from a confusion table."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("cnt")).otherwise(0)
    as_truth = matrix.select(
        F.col("truth").alias("category"),
        F.col("cnt").alias("s"),
        F.lit(0).cast("long").alias("p"),
        hit.alias("tp"),
    )
    as_prediction = matrix.select(
        F.col("predicted").alias("category"),
        F.lit(0).cast("long").alias("s"),
        F.col("cnt").alias("p"),
        F.lit(0).cast("long").alias("tp"),
    )
    sums = as_truth.unionByName(as_prediction).groupBy("category").agg(
        F.sum("s").alias("support"), F.sum("p").alias("called"), F.sum("tp").alias("tp")
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    return sums.select(
        "category",
        ratio(F.col("tp"), F.col("called")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("called") + F.col("support")).alias("f1"),
        "support",
        F.col("tp").alias("hits"),
    )


def scores(report: DataFrame) -> DataFrame:
    """Accuracy and averaged precision, recall and F1 from a class report."""
    rows = F.sum("support")

    def weighted(name: str) -> Column:
        return (F.sum(F.col(name) * F.col("support")) / rows).alias(f"{name}_weighted")

    return report.agg(
        rows.alias("support"),
        (F.sum("hits") / rows).alias("accuracy"),
        *[F.avg(name).alias(f"{name}_macro") for name in ("precision", "recall", "f1")],
        *[weighted(name) for name in ("precision", "recall", "f1")],
    )


def class_weights(df: DataFrame, category: str = "category") -> DataFrame:
    """Balanced class weights n / (k * n_c)."""
    counts = df.groupBy(category).agg(F.count("*").alias("cnt"))
    # One row per class from here on.
    everything = Window.partitionBy()
    weight = F.sum("cnt").over(everything) / (F.count("*").over(everything) * F.col("cnt"))
    return counts.select(category, "cnt", weight.alias("weight"))
