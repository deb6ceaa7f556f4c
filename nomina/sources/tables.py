"""Parquet tables, count lists and review samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_REVIEW_ROWS, MAX_LIST_ROWS = 100_000, 1_000_000


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table; how it is split follows Spark's file settings."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def count_line(item: str, separator: str = ": ", count: str = "cnt") -> Column:
    """One line of a count list: the item, a separator, the count."""
    return F.concat(F.col(item), F.lit(separator), F.col(count).cast("string"))


def write_count_list(top: DataFrame, item: str, path: str, separator: str = ": ") -> None:
    """Write a top-k list as text lines in rank order, as one file, by one task: at
    most MAX_LIST_ROWS rows are accepted."""
    if top.limit(MAX_LIST_ROWS + 1).count() > MAX_LIST_ROWS:
        raise ValueError(f"a count list has at most {MAX_LIST_ROWS} rows")
    ordered = top.orderBy(F.desc("cnt"), item).coalesce(1)
    ordered.select(count_line(item, separator).alias("value")).write.mode("overwrite").text(path)


def write_review_sample(sample: DataFrame, path: str) -> None:
    """Write a review sample as one CSV file with a header. It is read by a
    person, so at most MAX_REVIEW_ROWS rows are accepted."""
    if sample.limit(MAX_REVIEW_ROWS + 1).count() > MAX_REVIEW_ROWS:
        raise ValueError(f"a review sample has at most {MAX_REVIEW_ROWS} rows")
    sample.coalesce(1).write.mode("overwrite").options(header=True, escape='"').csv(path)
