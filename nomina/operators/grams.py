"""N-grams of texts, counted in Arrow tasks by hash bucket and, of some buckets, exactly.

A task numbers the words of a load and hashes each distinct one once; an n-gram is hashed
from its words' hashes and made a string only where it is counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.operators.terms import _loads, _numbered, _runs, split_words

# Odd factors of the hash of an n-gram.
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _gram_loads(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """Rows a word stands for, its row and number, and the distinct words, of every load."""
    rows, texts = batch.columns
    for load in _loads(pa.RecordBatch.from_arrays([rows, split_words(texts)], names=["rows", "words"])):
        row, word, words = _numbered(load.columns[1], least=1)
        yield pc.fill_null(load.columns[0], 0).to_numpy(zero_copy_only=False)[row], row, word, words


def _starts(row: np.ndarray, n: int) -> np.ndarray:
    """Where the n-grams begin: n words of one text follow each other."""
    return np.flatnonzero(row[n - 1 :] == row[: max(0, len(row) - n + 1)])


def _buckets(hashes: np.ndarray, word: np.ndarray, at: np.ndarray, n: int, many: int) -> np.ndarray:
    found = np.full(len(at), n, np.uint64)
    for k in range(n):
        found = (found ^ hashes[word[at + k]]) * _STEP
        found ^= found >> np.uint64(29)
    return ((found * _MIX >> np.uint64(32)) % np.uint64(many)).astype(np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    # The same in every task: its key is fixed.
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def bucket_counts(df: DataFrame, low: int, high: int, many: int) -> DataFrame:
    """(_bucket, full): occurrences of all n-grams by hash bucket, of (rows, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(many, np.int64)
        for batch in batches:
            for rows, row, word, words in _gram_loads(batch):
                hashes = _hashes(words)
                for n in range(low, high + 1):
                    at = _starts(row, n)
                    bucket = _buckets(hashes, word, at, n, many)
                    order = np.argsort(bucket) if (rows != 1).any() else None
                    if order is None:
                        full += np.bincount(bucket, minlength=many)
                    elif len(order):
                        starts = _runs(bucket[order])
                        full[bucket[order][starts]] += np.add.reduceat(rows[at][order], starts)
        met = np.flatnonzero(full)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(full[met])], names=["_bucket", "full"])

    counted = df.mapInArrow(run, "_bucket int, full long")
    return counted.groupBy("_bucket").agg(F.sum("full").alias("full"))


def grams_of(df: DataFrame, low: int, high: int, many: int, chosen: list[int], name: str) -> DataFrame:
    """(name, cnt): exact counts of the n-grams of the chosen of ``many`` buckets."""
    wanted = np.zeros(many, bool)
    wanted[chosen] = True
    shared = df.sparkSession.sparkContext.broadcast(wanted)

    def counted(rows: np.ndarray, word: np.ndarray, at: np.ndarray, n: int, words: pa.Array) -> pa.RecordBatch:
        # Dense numbers of the first words, one word longer each time.
        gram = word[at]
        for k in range(1, n):
            gram = np.unique(gram, return_inverse=True)[1] * len(words) + word[at + k]
        order = np.argsort(gram, kind="stable")
        starts = _runs(gram[order])
        cnt = np.add.reduceat(rows[at][order], starts)
        first = at[order][starts]
        parts = [words.take(pa.array(word[first + k])) for k in range(n)]
        grams = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
        return pa.RecordBatch.from_arrays([grams, pa.array(cnt.astype(np.int64))], names=[name, "cnt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, row, word, words in _gram_loads(batch):
                hashes = _hashes(words)
                for n in range(low, high + 1):
                    at = _starts(row, n)
                    at = at[shared.value[_buckets(hashes, word, at, n, many)]]
                    if len(at):
                        yield counted(rows, word, at, n, words)

    return df.mapInArrow(run, f"`{name}` string, cnt long").groupBy(name).agg(F.sum("cnt").alias("cnt"))
