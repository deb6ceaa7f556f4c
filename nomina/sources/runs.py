"""Tables that grow by numbered batches, kept as a few written runs.

A run is a Parquet folder that covers some batches in a row. Batch ``n`` writes one
run: its own rows merged with as many of the runs before it as ``n + 1`` can be
halved. So batches ``0..n`` are always covered by at most ``log2(n + 1) + 1`` runs, a
row is written again at most that often however many batches follow, and every other
batch writes no more than its own rows. Nothing of the table is held in memory.

A run takes its place by its number alone, so a batch that is run again after a
failure writes the same run from the same ones; those are deleted a batch later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nomina.scratch import delete_path


def covering(last: int) -> list[int]:
    """The runs that together cover batches 0..last, the latest first."""
    runs = []
    while last >= 0:
        runs.append(last)
        last -= _length(last)
    return runs


def _length(number: int) -> int:
    """How many batches run ``number`` covers: the power of two in ``number + 1``."""
    return (number + 1) & -(number + 1)


def merged_into(number: int) -> list[int]:
    """The earlier runs that run ``number`` takes in."""
    return [run for run in covering(number - 1) if run > number - _length(number)]


class Runs:
    """A table of ``schema`` below ``path``; ``merge`` combines rows of several runs."""

    def __init__(
        self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame] | None = None
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.merge = merge or (lambda rows: rows)

    def _place(self, number: int) -> str:
        return f"{self.path}/run={number}"

    def numbers(self) -> list[int]:
        """The runs that were written to their end. There are few folders at any time."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        found = [f.getPath() for f in files.listStatus(place) if f.getPath().getName().startswith("run=")]
        done = [p for p in found if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().removeprefix("run=")) for p in done)

    def latest(self) -> int:
        """The number of the last batch, -1 if there is none."""
        return max(self.numbers(), default=-1)

    def _read(self, runs: list[int]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._place(n) for n in runs])

    def table(self, last: int | None = None) -> DataFrame:
        """All rows of batches 0..last (by default: of all), merged."""
        return self.merge(self._read(covering(self.latest() if last is None else last)))

    def check(self, number: int) -> None:
        """Refuse a batch that is neither the next one nor the last one once more."""
        there = self.numbers()
        latest = max(there, default=-1)
        if number not in (latest, latest + 1) or not set(covering(number - 1)) <= set(there):
            raise ValueError(f"{self.path} ends with batch {latest}: batch {number} belongs to another table")

    def write(self, rows: DataFrame, number: int) -> None:
        """Add batch ``number``: the next one, or the last one once more."""
        self.check(number)
        earlier = merged_into(number)
        merged = self.merge(rows.unionByName(self._read(earlier)) if earlier else rows)
        merged.write.mode("overwrite").parquet(self._place(number))
        needed = set(covering(number)) | set(covering(number - 1))
        for run in set(self.numbers()) - needed:
            delete_path(self.spark, self._place(run))
