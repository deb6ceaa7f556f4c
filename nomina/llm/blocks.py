"""Groups of rows inside a task, hot groups dealt out as pairs of blocks, and queries
that visit the blocks of an index."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.scratch import attach, materialise

# Rows of an index block, and queries that visit a block in one unit of work.
BLOCK_ROWS, QUERY_ROWS = 16_384, 16_384


def paired_blocks(rows: DataFrame, sizes: DataFrame, key: str, item: str, limit: int) -> DataFrame:
    """Add ``block``, ``low`` and ``high`` to rows of groups (column ``key``).

    A group of at most ``limit`` rows is one unit (0, 0). A larger one is cut into
    blocks by the hash of ``item``, and every row goes to the units of its block
    with each block, so that all pairs of a group meet in a unit and no unit holds
    more than about two blocks. ``sizes`` has (key, n).
    """
    blocks = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    cut = rows.join(sizes.select(key, blocks.alias("_blocks")), key)
    cut = cut.withColumn("block", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
    dealt = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return dealt.withColumns(
        {"low": F.least("block", "_other"), "high": F.greatest("block", "_other")}
    ).drop("_other", "_blocks")


def by_unit(rows: DataFrame, key: str) -> DataFrame:
    """Bring the rows of each unit together, next to each other."""
    return rows.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high")


def units(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The runs of equal values of ``names`` in sorted batches, as tables."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for name in names:
            values = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        first = tuple(batch.column(batch.schema.get_field_index(n))[0].as_py() for n in names)
        new[0] = first != last
        cuts = np.append(np.flatnonzero(new), batch.num_rows).tolist()
        if cuts[0] > 0:  # goes on from the last batch
            waiting.append(batch.slice(0, cuts[0]))
        for a, b in zip(cuts, cuts[1:]):
            if waiting:
                yield pa.Table.from_batches(waiting)
            waiting = [batch.slice(a, b - a)]
        end = batch.num_rows - 1
        last = tuple(batch.column(batch.schema.get_field_index(n))[end].as_py() for n in names)
    if waiting:
        yield pa.Table.from_batches(waiting)


class Forest:
    """Union-find over 0..n-1 with the smallest member as root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, members: np.ndarray) -> None:
        """Make one set of the sets of ``members``."""
        roots = np.unique(self.root[members])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots[1:])] = roots[0]


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the shortest type that holds them."""
    most = max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def widen(raw: bytes, count: int) -> np.ndarray:
    """What ``narrow`` made, given the number of values."""
    return np.frombuffer(raw, {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[len(raw) // count])


def flat_vectors(table: pa.Table) -> np.ndarray:
    """The column ``vector`` of rows of one length as a matrix."""
    if not len(table):
        return np.zeros((0, 0), np.int64)
    return table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows of equal vector length, ``limit`` at a time where there are as many."""
    waiting: dict[int, list[pa.RecordBatch]] = {}

    def flush(dim: int, all_rows: bool) -> Iterator[tuple[int, pa.Table]]:
        table = pa.Table.from_batches(waiting.pop(dim))
        while len(table) >= limit or (all_rows and len(table)):
            yield dim, table.slice(0, limit)
            table = table.slice(limit)
        if len(table):
            waiting[dim] = table.to_batches()

    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index("vector")).value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes).tolist():
            rows = batch.take(pa.array(np.flatnonzero(sizes == dim)))
            waiting.setdefault(dim, []).append(rows)
            if sum(b.num_rows for b in waiting[dim]) >= limit:
                yield from flush(dim, False)
        if sum(b.num_rows for held in waiting.values() for b in held) > 4 * limit:
            for dim in list(waiting):
                yield from flush(dim, True)
    for dim in list(waiting):
        yield from flush(dim, True)


def block_index(rows: DataFrame, make: Callable[[pa.Table], dict[str, bytes]], columns: list[str]) -> DataFrame:
    """A written index (dim, block, *columns): ``make`` packs up to BLOCK_ROWS rows
    (with a column ``vector``) where they lie, so building moves no row. Columns
    are binary; there are at most twice as many blocks as full ones would be."""
    limit = BLOCK_ROWS
    rows = materialise(rows, "vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for block, (dim, table) in enumerate(_gathered(batches, limit)):
            packed = {"dim": [dim], "block": [first + block]} | {n: [v] for n, v in make(table).items()}
            schema = [("dim", pa.int32()), ("block", pa.int64()), *[(c, pa.binary()) for c in columns]]
            yield pa.RecordBatch.from_pydict(packed, schema=pa.schema(schema))

    few = rows.coalesce(max(1, -(-rows.count() // limit)))
    schema = ", ".join(["dim int", "block long", *[f"{c} binary" for c in columns]])
    return materialise(few.mapInArrow(run, schema), "index")


def visit(index: DataFrame, queries: DataFrame, search: Callable[[dict, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``search`` of every index block with all queries (id, dim, ...) of its length.

    Queries travel, a row to every block; a block is sent once for every QUERY_ROWS
    queries, and a unit of work holds one block and about as many queries.
    """
    queries = materialise(queries, "queries")
    parts = queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
    places = index.groupBy("dim").agg(F.sort_array(F.collect_list("block")).alias("blocks")).join(parts, "dim")
    places = materialise(places, "places")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    asked = attach(queries, places, ["dim"]).withColumn("part", part)
    asked = asked.withColumn("block", F.explode("blocks")).drop("blocks", "parts")
    blocks = attach(index, places.drop("blocks"), ["dim"])
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    unit = ["dim", "block", "part"]

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        # A part of the queries may be empty; a block never is.
        return search(block.to_pylist()[0], found)

    return blocks.groupBy(*unit).cogroup(asked.groupBy(*unit)).applyInArrow(run, schema)
