"""Exact top-k inner products from an impact-ordered index.

Vectors are integers. The index cuts the rows into blocks of bounded size; of
every block and dimension it keeps the rows in order of their component, cut into
segments by quantised component. A query visits the segments of all dimensions
in descending order of their quantised impact - the query's component times the
segment's bound - and adds impacts to accumulators, score at a time. A row that
has been met in some dimensions can reach at most what it has gathered, plus the
impact of the next segment for every dimension in which it was not met. The visit
stops only once few rows can still reach the k-th best exact score seen so far;
every row that can is scored exactly, so the result is exact wherever it stops.

Queries are a stated set and visit the blocks of the index: a query travels to every
block, a block is sent once for every ``blocks.QUERY_ROWS`` queries, and a visit
gives at most k rows per query. Components are stored in the shortest whole-number
type that holds a block's.

Edge cases: vectors that are null, empty or hold null or non-finite components take
no part on either side; a query's own key is no candidate; vectors of different
lengths do not meet; equal scores go to the smaller key; a query key with several
vectors asks with the smallest one; candidates are rows, repeated ones included;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.llm.blocks import block_index, flat_vectors, narrow, visit, widen
from nomina.llm.columns import arrow_schema
from nomina.llm.words import concat_ranges

# Segments per dimension.
SEGMENTS = 32
# Share of all postings visited between two looks at the bounds, and the number
# of rows that may still be in the running when a visit stops.
STEP, FEW = 0.08, 256


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or null if one is null or not finite."""
    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    good = ~F.exists(vector, odd) & (F.size(vector) > 0)
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


COLUMNS = ["ids", "vectors", "rows", "starts", "bounds"]


def _index_block(table: pa.Table) -> dict[str, bytes]:
    ids, vectors = table["id"].to_numpy(), flat_vectors(table)
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    rows = np.argsort(-vectors, axis=0, kind="stable").T.astype(np.int32)
    ranked = np.take_along_axis(vectors.T, rows, axis=1)
    low, high = ranked[:, -1:], ranked[:, :1]
    width = np.maximum(1, -(-(high - low + 1) // SEGMENTS))
    level = (high - ranked) // width
    starts = np.stack([np.searchsorted(line, np.arange(SEGMENTS + 1)) for line in level])
    # Largest and smallest component of each segment.
    first = np.minimum(starts[:, :-1], len(ids) - 1)
    last = np.maximum(starts[:, 1:] - 1, 0)
    bounds = np.stack([np.take_along_axis(ranked, first, 1), np.take_along_axis(ranked, last, 1)])
    return {
        "ids": ids.tobytes(),
        "vectors": narrow(vectors).tobytes(),
        # Blocks are small enough for short row numbers.
        "rows": rows.astype(np.uint16).tobytes(),
        "starts": starts.astype(np.int32).tobytes(),
        "bounds": bounds.astype(np.int64).tobytes(),
    }


def build_index(rows: DataFrame) -> DataFrame:
    """The written index over (id, vector) with whole-number vectors."""
    return block_index(rows.select("id", "vector"), _index_block, COLUMNS)


class Block:
    """An index block."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = widen(row["vectors"], len(self.ids) * dim).reshape(-1, dim).astype(np.int64)
        self.rows = np.frombuffer(row["rows"], np.uint16)
        starts = np.frombuffer(row["starts"], np.int32).reshape(dim, SEGMENTS + 1).astype(np.int64)
        self.sizes = np.diff(starts)
        self.starts = starts[:, :-1] + np.arange(dim)[:, None] * len(self.ids)
        self.high, self.low = np.frombuffer(row["bounds"], np.int64).reshape(2, dim, SEGMENTS)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``."""
        n = len(self.ids)
        impact = np.where(query[:, None] > 0, query[:, None] * self.high, query[:, None] * self.low)
        visited = (self.sizes > 0) & (query != 0)[:, None]
        impact, starts, sizes = impact[visited], self.starts[visited], self.sizes[visited]
        order = np.argsort(-impact, kind="stable")
        impact, starts, sizes = impact[order], starts[order], sizes[order]
        dims = int((query != 0).sum())
        gathered, met = np.zeros(n), np.zeros(n)
        running = np.flatnonzero(self.ids != own)
        least, at = -np.inf, 0
        done = np.cumsum(sizes)
        while at < len(impact):
            quota = (done[at - 1] if at else 0) + STEP * n * dims
            stop = max(at + 1, int(np.searchsorted(done, quota)))
            rows = self.rows[concat_ranges(starts[at:stop], sizes[at:stop])]
            gathered += np.bincount(rows, weights=np.repeat(impact[at:stop].astype(float), sizes[at:stop]), minlength=n)
            met += np.bincount(rows, minlength=n)
            at = stop
            following = float(impact[at]) if at < len(impact) else 0.0
            reach = gathered[running] + (dims - met[running]) * following
            if len(running) > k:
                top = running[np.argpartition(-reach, k)[: 4 * k]]
                exact = self.vectors[top] @ query
                if len(exact) >= k:
                    least = max(least, np.partition(exact, len(exact) - k)[len(exact) - k])
                # The proof: a row that cannot reach the k-th best score is out.
                running = running[reach >= least]
            if len(running) <= FEW:
                break
        exact = self.vectors[running] @ query
        best = np.lexsort((self.ids[running], -exact))[:k]
        return self.ids[running][best], exact[best]


FOUND = "query_id long, id long, score long"


def _search(k: int):
    def run(row: dict, queries: pa.Table) -> pa.Table:
        block = Block(row)
        query_ids, ids, scores = ([np.zeros(0, np.int64)] for _ in range(3))
        for own, query in zip(queries["id"].to_pylist(), flat_vectors(queries)):
            found, score = block.search(own, query, k)
            query_ids.append(np.full(len(found), own))
            ids.append(found)
            scores.append(score)
        columns = zip(arrow_schema(FOUND).names, (query_ids, ids, scores))
        return pa.table({n: np.concatenate(c).astype(np.int64) for n, c in columns}, schema=arrow_schema(FOUND))

    return run


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) of the k best rows for every query (id, vector)."""
    single = queries.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    found = visit(index, single, _search(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
