"""CSV readers for raw name lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina import fixed


# Encodings Spark reads as is; for any other one the JVM knows, the session needs
# spark.sql.legacy.javaCharsets=true.
_SPARK_ENCODINGS = {
    "iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8",
}


def _missing_to_null(name: str) -> Column:
    column = F.col(f"`{name}`")
    return F.when(~column.isin(fixed.MISSING_TOKENS), column).alias(name)


def read_raw_csv(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    encoding: str = "UTF-8",
    names: list[str] | None = None,
) -> DataFrame:
    """All-text CSV without quoting, with a header or with given column ``names``.

    A line with too many fields is skipped; one with too few is filled with
    nulls. Tokens that stand for a missing value are null. Encodings other than
    Latin-1, ASCII and UTF need the setting spark.sql.legacy.javaCharsets.
    """
    allowed = spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "true"
    if encoding.lower() not in _SPARK_ENCODINGS and not allowed:
        raise ValueError(f"reading {encoding} needs spark.sql.legacy.javaCharsets=true")
    options = {"header": names is None, "sep": sep, "encoding": encoding, "quote": ""}
    names = names or spark.read.options(**options).csv(path).columns
    bad = "_bad_line"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
    # Bad lines must be found whatever columns a query reads: no pruning here.
    checks = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "columnPruning": False}
    lines = spark.read.schema(schema).options(**options, **checks).csv(path)
    # Without quoting, the number of separators is the number of fields. A good
    # line counts as its first field, which also keeps the bad-line column from
    # being the only one a query reads (Spark refuses that).
    line = F.coalesce(F.col(bad), F.col(f"`{names[0]}`"), F.lit(""))
    fields = F.size(F.split(line, F.concat(F.lit(r"\Q"), F.lit(sep), F.lit(r"\E"))))
    kept = lines.where(fields <= len(names))
    return kept.select(*[_missing_to_null(n) for n in names])


def read_text_column(
    spark: SparkSession, path: str, column: str = "DESCRIPTION", *, line_breaks: bool
) -> DataFrame:
    """One text column of a CSV with quoting; the scan reads only that column.

    ``line_breaks`` tells whether quoted fields may hold line breaks. If so, each
    file is read by one task; without them, files are split.
    """
    lines = spark.read.options(header=True, sep=",", quote='"', escape='"', multiLine=line_breaks)
    return lines.csv(path).select(_missing_to_null(column))
