"""Hard negatives by an inverted multi-index over two half spaces.

For an anchor, its positives are its best rows of the same label, and the hard
negatives of a positive are the best rows of other labels whose score lies in a
window below the positive's score: near enough to be hard, far enough not to be a
positive that was labelled wrongly. Scores are inner products of whole numbers.

The index cuts the rows into blocks of bounded size. In each block the components
are cut in two halves, each half has a codebook of its own (k-means over all rows
of the block, so nothing is sampled), and a pair of codewords is a cell with a list
of rows. For a query, a half scores at most (query . codeword) + |query| * radius,
where the radius is that of the codeword's farthest member. Cells are visited in
descending order of the sum of both bounds, by a heap over the two sorted lists of
bounds (multi-sequence), and the rows of a cell are scored exactly. So whatever has
not been visited scores at most the next sum, and a search stops once that proves
the answer: the wanted positives all score more, or, for every window, the wanted
negatives do or the window's lower end does. Cells that are wholly above all
windows are passed over by the matching lower bound.

Anchors visit all blocks twice, first for the positives, then, with the windows that
follow from these, for the negatives; a block returns a few rows an anchor, which
are merged. Anchors travel to the blocks, a unit of work holds one block and a
bounded number of anchors, whatever the labels are.

Edge cases: rows whose key, label or vector is null, and vectors that are empty or
hold null or non-finite components take no part; vectors of different lengths do
not meet; an anchor's own key is no positive and no negative; a key that is
repeated is several rows, and as an anchor asks once, with its smallest label and
vector; equal scores go to the smaller key; an anchor without positives, or a
positive whose window is empty, has no negatives; an empty table gives an empty
table; other columns are not looked at. Scores have to fit in 64 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.llm.blocks import block_index, flat_vectors, narrow, visit, widen
from nomina.llm.columns import arrow_schema
from nomina.llm.words import concat_ranges
from nomina.scratch import materialise

# Rows of a cell on average, steps of k-means, rows scored at a time.
CELL_ROWS, STEPS, SCORED = 32, 6, 2048
# Bounds are widened by this share, far above what rounding takes from them.
SLACK = 1e-9
COLUMNS = ["ids", "labels", "vectors", "books", "radii", "cells"]


def codebook(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords of ``points`` and the codeword of each, by k-means."""
    words = points[np.linspace(0, len(points) - 1, size).astype(int)].copy()
    for step in range(STEPS + 1):
        near = np.argmin((words * words).sum(axis=1) - 2 * (points @ words.T), axis=1)
        if step == STEPS:
            return words, near
        members = np.bincount(near, minlength=size)
        sums = np.stack([np.bincount(near, points[:, d], size) for d in range(points.shape[1])], axis=1) if points.shape[1] else words
        words = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], words)
    raise AssertionError


def _halves(dim: int) -> tuple[slice, slice]:
    return slice(0, dim // 2), slice(dim // 2, dim)


def _index_block(table: pa.Table) -> dict[str, bytes]:
    ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
    vectors = flat_vectors(table)
    order = np.argsort(ids, kind="stable")
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    size = max(1, int(np.sqrt(len(ids) / CELL_ROWS)))
    books, radii, places = [], [], []
    for half in _halves(vectors.shape[1]):
        points = vectors[:, half].astype(np.float64)
        words, near = codebook(points, size)
        away = np.sqrt(((points - words[near]) ** 2).sum(axis=1))
        # A codeword without members has radius -1.
        radius = np.full(size, -1.0)
        np.maximum.at(radius, near, away)
        books.append(words)
        radii.append(radius)
        places.append(near)
    cell = places[0] * size + places[1]
    order = np.argsort(cell, kind="stable")
    return {
        "ids": ids[order].tobytes(),
        "labels": labels[order].tobytes(),
        "vectors": narrow(vectors[order]).tobytes(),
        "books": np.concatenate(books, axis=1).tobytes(),
        "radii": np.stack(radii).tobytes(),
        "cells": np.searchsorted(cell[order], np.arange(size * size + 1)).astype(np.int64).tobytes(),
    }


class Block:
    """An index block."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        vectors = widen(row["vectors"], len(self.ids) * row["dim"]).reshape(len(self.ids), -1)
        self.most = float(np.abs(vectors.astype(np.float64)).max())
        self.vectors = vectors
        self.radii = np.frombuffer(row["radii"]).reshape(2, -1)
        self.size = self.radii.shape[1]
        self.books = np.frombuffer(row["books"]).reshape(self.size, -1)
        self.lengths = np.stack([np.sqrt((self.books[:, h] ** 2).sum(axis=1)) for h in _halves(row["dim"])])
        self.cells = np.frombuffer(row["cells"], np.int64)
        # Doubles hold these scores exactly, and multiply faster.
        self.doubles = vectors.astype(np.float64)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(query.astype(np.float64)).sum()) < 2**53:
            return (self.doubles[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows].astype(np.int64) @ query

    def bounds(self, query: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each half its codewords, best first, with the most and the least that
        their members can score."""
        found = []
        for half, radius, length in zip(_halves(len(query)), self.radii, self.lengths):
            own = query[half].astype(np.float64)
            norm = np.sqrt(own @ own)
            middle, away = self.books[:, half] @ own, norm * radius
            slack = SLACK * (1 + norm * (length + np.maximum(radius, 0)))
            used = np.flatnonzero(radius >= 0)
            order = used[np.argsort(-(middle + away + slack)[used], kind="stable")]
            found.append((order, (middle + away + slack)[order], (middle - away - slack)[order]))
        return found

    def visit(self, query: np.ndarray, ceiling: float = np.inf) -> Iterator[tuple[np.ndarray, float]]:
        """(rows, bound): rows cell by cell in descending order of the cells' bounds,
        and the most that any row still to come can score. Cells whose rows all
        score more than ``ceiling`` are passed over."""
        (first, high1, low1), (second, high2, low2) = self.bounds(query)
        heap = [(-(high1[0] + high2[0]), 0, 0)]
        starts: list[int] = []
        sizes: list[int] = []
        held = 0
        high1, high2, low1, low2 = (x.tolist() for x in (high1, high2, low1, low2))
        first, second, cells = (first * self.size).tolist(), second.tolist(), self.cells
        while heap:
            _, a, b = heapq.heappop(heap)
            # The heap holds one cell of each line; the next line opens with its first.
            if b + 1 < len(high2):
                heapq.heappush(heap, (-(high1[a] + high2[b + 1]), a, b + 1))
            if b == 0 and a + 1 < len(high1):
                heapq.heappush(heap, (-(high1[a + 1] + high2[0]), a + 1, 0))
            at = first[a] + second[b]
            start, end = int(cells[at]), int(cells[at + 1])
            if start < end and low1[a] + low2[b] <= ceiling:
                starts.append(start)
                sizes.append(end - start)
                held += end - start
            if held >= SCORED or not heap:
                rows = concat_ranges(np.array(starts, np.int64), np.array(sizes, np.int64)) if held else np.zeros(0, np.int64)
                yield rows, -heap[0][0] if heap else -np.inf
                starts, sizes, held = [], [], 0

    def best(self, own: int, label: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best other rows of the label."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for rows, bound in self.visit(query):
            rows = rows[(self.labels[rows] == label) & (self.ids[rows] != own)]
            ids = np.concatenate((ids, self.ids[rows]))
            scores = np.concatenate((scores, self.scores(rows, query)))
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
            if len(ids) == k and scores[-1] > bound:
                break
        return ids, scores

    def in_windows(
        self, own: int, label: int, query: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the k best rows of other labels in each window."""
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(low)
        open_windows = [i for i in range(len(low)) if low[i] <= high[i]]
        if not open_windows:
            return best
        for rows, bound in self.visit(query, float(max(high[i] for i in open_windows))):
            rows = rows[(self.labels[rows] != label) & (self.ids[rows] != own)]
            scores = self.scores(rows, query)
            for i in list(open_windows):
                inside = (scores >= low[i]) & (scores <= high[i])
                ids, found = (np.concatenate((b, n[inside])) for b, n in zip(best[i], (self.ids[rows], scores)))
                order = np.lexsort((ids, -found))[:k]
                best[i] = ids[order], found[order]
                # The certificate: nothing to come is in the window and better.
                if bound < low[i] or (len(order) == k and best[i][1][-1] > bound):
                    open_windows.remove(i)
            if not open_windows:
                break
        return best


def _gather(parts: list[dict[str, np.ndarray]], schema: str) -> pa.Table:
    names = arrow_schema(schema).names
    columns = {n: np.concatenate([np.zeros(0, np.int64), *[p[n] for p in parts]]).astype(np.int64) for n in names}
    return pa.table(columns, schema=arrow_schema(schema))


POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, place long, negative_id long, negative_score long"


def _positives(k: int):
    def run(row: dict, queries: pa.Table) -> pa.Table:
        block, parts = Block(row), []
        vectors = flat_vectors(queries)
        for own, label, query in zip(queries["id"].to_pylist(), queries["label"].to_pylist(), vectors):
            ids, scores = block.best(own, label, query, k)
            parts.append({"anchor_id": np.full(len(ids), own), "positive_id": ids, "positive_score": scores})
        return _gather(parts, POSITIVES)

    return run


def _negatives(k: int):
    def run(row: dict, queries: pa.Table) -> pa.Table:
        block, parts = Block(row), []
        vectors = flat_vectors(queries)
        asked = zip(*[queries[c].to_pylist() for c in ("id", "label", "low", "high")], vectors)
        for own, label, low, high, query in asked:
            for place, (ids, scores) in enumerate(block.in_windows(own, label, query, low, high, k)):
                same = np.full(len(ids), own)
                parts.append({"anchor_id": same, "place": np.full(len(ids), place), "negative_id": ids, "negative_score": scores})
        return _gather(parts, NEGATIVES)

    return run


def build_index(rows: DataFrame) -> DataFrame:
    """The written index over (id, label, vector) with whole numbers and no nulls."""
    return block_index(rows.select("id", "label", "vector"), _index_block, COLUMNS)


def mine(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` are (id, label, vector) with vectors of whole numbers; ``anchors`` is a
    condition on them. A negative of a positive scores from ``low`` to ``high``
    percent of it.
    """
    rows = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), "vector")
    usable = ~F.exists("vector", lambda x: x.isNull()) & (F.size("vector") > 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable)
    index = build_index(rows)
    asked = rows.where(anchors).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r"))
    asked = materialise(asked.select("id", "r.label", "r.vector", F.size("r.vector").alias("dim")), "anchors")

    found = visit(index, asked, _positives(positives), POSITIVES)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < positives)
    best = materialise(best, "positives")

    # Whole-number ends: the least at low percent or more, the most at high percent or less.
    score = F.col("positive_score")
    wide = score.cast("decimal(20,0)")
    ends = best.withColumns(
        {"low": F.ceil(wide * low / 100).cast("long"), "high": F.floor(wide * high / 100).cast("long")}
    )
    lists = ends.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "low", "high"))).alias("w"))
    windows = lists.select(F.col("anchor_id").alias("id"), F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    some = F.exists(F.arrays_zip("low", "high"), lambda w: w["low"] <= w["high"])
    found = visit(index, asked.join(windows.where(some), "id"), _negatives(negatives), NEGATIVES)
    first = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    joined = found.join(best, ["anchor_id", "place"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
