"""Written intermediate tables and joins against them.

An intermediate result that several later steps read is written once, as
Parquet, to the shared folder of the cluster (``spark.checkpoint.dir``). It
survives the loss of executors, cuts the lineage, prunes columns on the way
back and has a known size.
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds of what is ever broadcast; both are measured, never assumed.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
# A key is hot when it holds more than 1/HOT_KEYS of all rows, so there are
# always fewer than HOT_KEYS hot keys, whatever the data looks like.
HOT_KEYS = 1000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir``, or
    a folder in the warehouse, which executors share as well, where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


_in_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("in_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    path = f"{scratch_dir(spark)}/nomina/{app}/{name}-{uuid.uuid4().hex}"
    noted = _in_scope.get()
    if noted is not None:
        noted.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediates made inside, at the end. Results that read them
    must be written or collected before that."""
    outer = _in_scope.set([])
    try:
        yield
    finally:
        for path in _in_scope.get() or []:
            delete_path(spark, path)
        _in_scope.reset(outer)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediates of this application, once no result needs them."""
    app = spark.sparkContext.applicationId
    delete_path(spark, f"{scratch_dir(spark)}/nomina/{app}")


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and go on from the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(table: DataFrame) -> bool:
    """Measure a written table against the broadcast bounds."""
    width = F.lit(0)
    for field in table.schema.fields:
        size = F.octet_length(F.col(f"`{field.name}`").cast("string"))
        width = width + F.coalesce(size, F.lit(0)) + F.lit(16)
    found = table.agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
    return found["n"] <= BROADCAST_ROWS and (found["b"] or 0) <= BROADCAST_BYTES


def attach(left: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a written table that is usually small: broadcast when it measures
    small, else a shuffle join, whose skewed partitions AQE splits."""
    return left.join(F.broadcast(table) if fits_broadcast(table) else table, on, how)


def attach_by_weight(left: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join to a written table with one row per key of ``left``.

    ``weight`` holds the number of left rows per key. A small table is
    broadcast. Otherwise a hot key's rows are dealt over as many parts as it
    takes for a part to be no larger than 1/HOT_KEYS of all rows, and its row of
    the table is repeated for each. Which keys are hot is sent to every task as
    pairs of numbers, fewer than HOT_KEYS by definition, whatever the keys hold.
    """
    slim = table.drop(weight)
    if fits_broadcast(slim):
        return left.join(F.broadcast(slim), key)
    limit = max(1.0, (table.agg(F.sum(weight)).first()[0] or 0) / HOT_KEYS)
    hot = table.where(F.col(weight) > limit).groupBy(F.xxhash64(key).alias("__hash"))
    hot = materialise(hot.agg(F.ceil(F.sum(weight) / limit).cast("int").alias("__parts")), "hot")

    def with_parts(rows: DataFrame) -> DataFrame:
        hashed = rows.withColumn("__hash", F.xxhash64(key))
        return hashed.join(F.broadcast(hot), "__hash", "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))

    # Any part is right, as each has the key's row.
    part = F.pmod(F.monotonically_increasing_id(), F.col("__parts")).cast("int")
    dealt = with_parts(left).withColumn("__part", part)
    repeated = with_parts(slim).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    joined = dealt.drop("__hash", "__parts").join(repeated.drop("__hash", "__parts"), [key, "__part"])
    return joined.drop("__part")
