"""Mixing sources to target weights by proportionate-fair scheduling.

Rows of a source go in blocks. Block j of a source with weight w may not come
before slot floor(j / w) and must come before slot ceil((j + 1) / w); among the
blocks that are due, the one with the earliest deadline takes the next slot. All
deadlines are met, so in every prefix each source is less than one block away
from its weight.

When a source runs out, a new phase begins with the next slot: the weights of the
others are divided by the sum of theirs, and releases and deadlines count from
there. So no slot is empty, and within a phase each source is less than one block
away from its weight of the phase. All rows are kept.

Weights are exact fractions (a decimal number is what it says, and all are divided
by their sum), so nothing adds up over a long mix. Slots are planned one by one in
the driver, a step per block. A block has BLOCK_ROWS rows, or as many more as it
takes for the whole plan to have PLAN_BLOCKS blocks (and one a source at most
beside), so the plan does not grow with the data.

Rows are numbered within a source in hash order by a range sort and partition
offsets, so a source with a third of all rows is no special case; only the number
of rows per source comes to the driver, at most MAX_SOURCES.

Edge cases: a null source counts as the source with an empty name; a source
without a target weight above zero is an error, as are more than MAX_SOURCES; rows
that repeat key and source share one place; null keys are keys like others; an empty
table gives an empty table. Columns of the input may have any names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomina.functions.labels import hash_order
from nomina.llm.columns import text_bytes
from nomina.operators.sampling import global_index
from nomina.scratch import attach, fits_broadcast, materialise, scratch_path

BLOCK_ROWS, PLAN_BLOCKS = 64, 1 << 19
# Slots sent from the driver at a time.
PERIOD = 200_000
MAX_SOURCES = 10_000
# Text bytes of a file of mixed rows.
FILE_BYTES = 32 << 20
PLACE = ["block", "release", "deadline", "slot", "position"]


def tempered_weights(rows: dict[str, int], power: float = 0.5) -> dict[str, float]:
    """Weights in proportion to a power of the number of rows."""
    raised = {s: n**power for s, n in rows.items()}
    return {s: v / sum(raised.values()) for s, v in raised.items()}


def exact_shares(weights: dict[str, float]) -> tuple[dict[str, int], int]:
    """Whole numbers in exact proportion to the weights, and their sum."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if min(exact.values()) <= 0:
        raise ValueError("a weight is not above zero")
    scale = math.lcm(*(e.denominator for e in exact.values()))
    whole = {s: int(e * scale) for s, e in exact.items()}
    common = math.gcd(*whole.values())
    shares = {s: w // common for s, w in whole.items()}
    return shares, sum(shares.values())


def plan(shares: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of all blocks, slot by slot; the
    weight of a source is its part of the shares of the sources that have blocks left."""
    done = dict.fromkeys(blocks, 0)
    left = {s for s, n in blocks.items() if n}
    slot = 0
    while left:
        start, period = slot, sum(shares[s] for s in left)
        coming = [(start, s, 0) for s in sorted(left)]
        due: list[tuple[int, str, int, int]] = []
        phase = len(left)
        while len(left) == phase:
            while coming and coming[0][0] <= slot:
                release, source, j = heapq.heappop(coming)
                heapq.heappush(due, (start - (-(j + 1) * period // shares[source]), source, j, release))
            deadline, source, j, release = heapq.heappop(due)
            if slot >= deadline:
                raise RuntimeError("a deadline was missed")
            yield source, done[source], release, deadline, slot
            slot += 1
            done[source] += 1
            if done[source] == blocks[source]:
                left.remove(source)
            else:
                heapq.heappush(coming, (start + (j + 1) * period // shares[source], source, j + 1))


def mix(
    df: DataFrame,
    key: str,
    source: str,
    weights: dict[str, float] | None = None,
    block_rows: int | None = None,
    period: int = PERIOD,
) -> DataFrame:
    """Place every (key, source): (mix_key, source, block, release, deadline, slot, position).

    ``weights`` are the targets by source; by default they grow with the square
    root of a source's rows. ``mix_key`` is the key, ``position`` the place in
    the mixed order. ``period`` slots are sent at a time; it changes no place.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("mix_key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"))
    rows = rows.distinct()
    # The key is the last tie-break, so the order is total.
    indexed = materialise(
        global_index(rows, ["source", hash_order("mix_key", seed=42), "mix_key"], "_row"), "rows"
    )
    counts = {r["source"]: r["n"] for r in _counts(indexed)}
    if not counts:
        return indexed.select("mix_key", "source", *[F.lit(0).cast("long").alias(c) for c in PLACE])
    targets = tempered_weights(counts) if weights is None else {s: weights[s] for s in counts}
    shares, _ = exact_shares(targets)
    block_rows = block_rows or max(BLOCK_ROWS, -(-sum(counts.values()) // PLAN_BLOCKS))
    first, starts = 0, {}
    for s in sorted(counts, key=lambda s: s.encode()):
        starts[s], first = first, first + counts[s]
    # At most MAX_SOURCES rows, so these may be sent to every task.
    sources = F.broadcast(spark.createDataFrame(list(starts.items()), "source string, _first long"))
    slots = _written(spark, plan(shares, {s: -(-n // block_rows) for s, n in counts.items()}), period)
    block = F.floor((F.col("_row") - F.col("_first")) / block_rows).cast("long")
    placed = attach(indexed.join(sources, "source").withColumn("block", block), slots, ["source", "block"])
    lots = placed.select("mix_key", "source", "block", "release", "deadline", "slot", "_row")
    return global_index(lots, ["slot", "_row"], "position").drop("_row")


def _written(spark: SparkSession, planned: Iterator[tuple], period: int) -> DataFrame:
    """A plan as a written table, never more than ``period`` blocks in memory."""
    path, schema = scratch_path(spark, "plan"), "source string, block long, release long, deadline long, slot long"
    names = ["source", "block", "release", "deadline", "slot"]
    types = [pa.string(), *[pa.int64()] * 4]
    while some := list(islice(planned, period)):
        columns = [pa.array(c, t) for c, t in zip(zip(*some), types)]
        part = spark.createDataFrame(pa.Table.from_arrays(columns, names=names))
        part.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _counts(indexed: DataFrame) -> list:
    found = indexed.groupBy("source").agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return found


def in_mixed_order(df: DataFrame, key: str, source: str, text: str, placed: DataFrame) -> DataFrame:
    """All rows of ``df``, laid out by their place in the mix: the partitions, and so
    the files that are written from them, follow each other in the mixed order, and
    so do the rows in each."""
    places = materialise(placed.select("mix_key", "source", "position"), "places")
    total = places.agg(F.max("position")).first()[0]
    if total is None:
        return df.limit(0)
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
    )
    same = (F.col("key").eqNullSafe(F.col("mix_key"))) & (F.col("source") == F.col("of"))
    places = places.withColumnRenamed("source", "of")
    joined = rows.join(F.broadcast(places) if fits_broadcast(places) else places, same)
    files = max(1, -(-text_bytes(df, text) // FILE_BYTES))
    part = F.floor(F.col("position") * files / (total + 1)).cast("int")
    laid = joined.select("row", "position").repartitionById(files, part)
    return laid.sortWithinPartitions("position").select("row.*")


def in_stored_order(df: DataFrame, position: str) -> DataFrame:
    """Add the place of every row of files that were written in order: the files in
    the order of their names, the rows as they stand in each. Only the number of rows
    of each file is counted."""
    meta = df.metadataColumn("_metadata")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        meta["file_path"].alias("file"),
        meta["row_index"].alias("at"),
    )
    files = materialise(rows.groupBy("file").agg(F.count("*").alias("n")), "files")
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = attach(rows, materialise(files, "offsets"), ["file"])
    return placed.select("row.*", (F.col("first") + F.col("at")).alias(position))
