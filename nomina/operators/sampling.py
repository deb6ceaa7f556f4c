"""Repeatable sampling, splits and row numbers without hot tasks.

"Random" choices follow the md5 of a row key and a seed, so they are the same
in every run and on every cluster. The key must identify a row. A group's first
k rows are found by a hash threshold: rows are only counted per hash bucket, the
one bucket where the quota ends is ranked, and the rows themselves are filtered
where they lie. No group is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.labels import hash_order
from nomina.scratch import attach, materialise

# Hex digits of a hash bucket: 65,536 buckets per group.
BUCKET_DIGITS = 4
# Bounds around every md5 text.
_BELOW_ALL, _ABOVE_ALL = "", "g"


def _running(counts: DataFrame, group: list[str], quota: Callable[[Column], Column]) -> DataFrame:
    """Add the rows up to and with each bucket and the quota of the group."""
    whole = Window.partitionBy(*group)
    upto = F.sum("_rows").over(whole.orderBy("_bucket"))
    total = F.sum("_rows").over(whole)
    summed = counts.select(*counts.columns, upto.alias("_upto"), total.alias("_total"))
    return summed.withColumn("_quota", quota(F.col("_total")).cast("long"))


def flag_first(
    df: DataFrame,
    key: list[str],
    quota: Callable[[Column], Column],
    seed: int,
    by: str,
    out: str = "first",
) -> DataFrame:
    """Add a flag that is true for the first ``quota(group size)`` rows of each
    group, in hash order; null is a group like any other. ``df`` is read several
    times: pass a written table."""
    columns = df.columns
    # A struct around the group makes null equal to null in joins.
    group = ["_group"]
    df = df.withColumn("_group", F.struct(by))
    order = hash_order(*key, seed=seed)
    bucket = F.substring(order, 1, BUCKET_DIGITS)
    counts = df.groupBy(*group, bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    running = materialise(_running(counts, group, quota), "buckets")

    inside = (F.col("_quota") > 0) & (F.col("_quota") < F.col("_total"))
    ends_here = (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_rows") < F.col("_quota"))
    take = (F.col("_quota") - F.col("_upto") + F.col("_rows")).alias("_take")
    cut = running.where(inside & ends_here).select(*group, "_bucket", take)

    cut = materialise(cut, "cut")
    rows = df.select("_group", order.alias("_order"), bucket.alias("_bucket"))
    ranked = attach(rows, cut, ["_group", "_bucket"]).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy("_order"))
    )
    exact = ranked.where(F.col("_rank") == F.col("_take")).select("_group", F.col("_order").alias("_limit"))
    plain = (
        running.where(~inside)
        .select("_group", F.when(F.col("_quota") > 0, _ABOVE_ALL).otherwise(_BELOW_ALL).alias("_limit"))
        .distinct()
    )
    limits = materialise(exact.unionByName(plain), "limits")
    return attach(df, limits, ["_group"]).select(*columns, (order <= F.col("_limit")).alias(out))


def cap_per_class(
    df: DataFrame, cap: int, key: list[str], seed: int = fixed.SEED, by: str = "category"
) -> DataFrame:
    """At most ``cap`` rows of every class, chosen in hash order. Rows without a
    class belong to none and are left out."""
    flagged = flag_first(df.where(F.col(by).isNotNull()), key, lambda n: F.least(n, F.lit(cap)), seed, by, "_kept")
    return flagged.where("_kept").drop("_kept")


def sample_n(df: DataFrame, n: int, key: list[str], seed: int = fixed.SEED) -> DataFrame:
    """``min(n, rows)`` rows without replacement: every task keeps its first n
    in hash order, and the first n of those are taken."""
    return df.orderBy(hash_order(*key, seed=seed)).limit(n)


def stratified_split(
    df: DataFrame,
    key: list[str],
    share: float = fixed.VALIDATION_SHARE,
    seed: int = fixed.SEED,
    by: str = "category",
    out: str = "is_val",
) -> DataFrame:
    """Flag ``share`` of every class (rounded) as validation rows; rows without
    a class are split like a class of their own."""
    return flag_first(df, key, lambda n: F.round(n * F.lit(share)), seed, by, out)


def shuffle_rows(df: DataFrame, key: list[str], seed: int = fixed.SEED) -> DataFrame:
    """All rows in a repeatable random order."""
    return df.orderBy(hash_order(*key, seed=seed))


def global_index(df: DataFrame, order: list[Column | str], out: str = "row_index") -> DataFrame:
    """Add the zero-based position of each row in the given order.

    Rows are sorted by range partition and numbered within it; only the number
    of rows per partition is summed up globally. Rows of equal order go by a hash
    of all their columns, so many of them are no hot range.
    """
    # The id holds the partition in its upper and the position in its lower 33 bits.
    numbered = df.orderBy(*order, F.xxhash64(*df.columns)).withColumn("_id", F.monotonically_increasing_id())
    written = materialise(numbered, "sorted").withColumn("_part", F.shiftright("_id", 33))
    sizes = written.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = materialise(sizes.select("_part", before.alias("_before")), "offsets")
    position = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return attach(written, offsets, ["_part"]).select(*df.columns, position.alias(out))


def ordered_holdout(
    df: DataFrame, order: list[Column | str], share: float = fixed.ORDERED_TRAIN_SHARE
) -> DataFrame:
    """Flag the first ``int(share * rows)`` rows in the given order as training rows."""
    indexed = materialise(global_index(df, order), "indexed")
    train = int(share * indexed.count())
    return indexed.withColumn("is_train", F.col("row_index") < F.lit(train))


def label_index(df: DataFrame, category: str = "category") -> DataFrame:
    """Labels numbered from 0 in code-point order."""
    labels = df.where(F.col(category).isNotNull()).select(category).distinct()
    return global_index(labels, [category], "label_id")
