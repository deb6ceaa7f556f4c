"""Uni- and bigrams of texts, counted in Arrow tasks.

Texts of ASCII and Cyrillic letters are cut into words by their bytes, others by Spark. A
task tells the words of a load apart once and counts pairs of their numbers, so a term is
made a string only where it is counted, not where it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina.functions.cleaning import is_ascii
from nomina.functions.tokens import tfidf_words

# Words of a load, or one longer text; rows of a batch of results, or of lists.
LOAD_WORDS, OUT_ROWS, OUT_LISTS = 1 << 20, 1 << 17, 1 << 10
# A space for every ASCII character that no word has, in upper or lower case.
_SPACED = np.array([b if b >= 128 or chr(b).isalnum() or b == 95 else 32 for b in range(256)], np.uint8)


def word_columns(clean: str) -> list[Column]:
    """What ``word_lists`` needs of a text: the text itself in lower case if all its
    characters are ASCII or of U+0400 to U+047F, which are letters, else its words."""
    text = F.lower(clean)
    plain = is_ascii(text) | text.rlike(r"^[\x{0}-\x{7f}\x{400}-\x{47f}]*+$")
    return [F.when(plain, text).alias("__text"), F.when(~plain, tfidf_words(F.col(clean))).alias("__words")]


def split_words(texts: pa.Array) -> pa.Array:
    """Lists of what is between spaces; of a null, null."""
    return pc.split_pattern(texts, " ")


def word_lists(texts: pa.Array, words: pa.Array) -> pa.Array:
    """The words of both columns of ``word_columns``, with shorter ones and empty ones."""
    valid, offsets, data = pa.concat_arrays([texts]).buffers() if len(texts) else (None, None, None)
    if data is not None:
        spaced = pa.py_buffer(_SPACED[np.frombuffer(data, np.uint8)])
        texts = pa.Array.from_buffers(pa.string(), len(texts), [valid, offsets, spaced], offset=texts.offset)
    lists = split_words(texts)
    if words.null_count == len(words):
        return lists
    at = np.arange(len(words)) + len(words) * words.is_valid().to_numpy(zero_copy_only=False)
    return pa.concat_arrays([lists, words.cast(lists.type)]).take(pa.array(at))


def _loads(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of LOAD_WORDS; its last column holds lists of words."""
    sizes = pc.fill_null(pc.list_value_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False)
    upto, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + LOAD_WORDS, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _numbered(lists: pa.Array, least: int = 2) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of every word of ``least`` characters, and the distinct words."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    row, word = np.repeat(np.arange(len(sizes)), sizes), coded.indices.to_numpy().astype(np.int64)
    kept = pc.greater_equal(pc.utf8_length(coded.dictionary), least).to_numpy(zero_copy_only=False)[word]
    return row[kept], word[kept], coded.dictionary


def _runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))


def count_terms(lists: pa.Array) -> pa.RecordBatch:
    """(term, df, total) of the uni- and bigrams of lists of words."""
    row, word, words = _numbered(lists)
    many = len(words)
    pair = np.flatnonzero(row[1:] == row[:-1])
    term = np.concatenate([word, many + word[pair] * many + word[pair + 1]])
    row = np.concatenate([row, row[pair]])
    if many * (many + 1) < (1 << 62) // max(1, len(lists)):
        both = term * len(lists) + row
        both.sort()
        term, row = np.divmod(both, max(1, len(lists)))
    else:
        order = np.lexsort((row, term))
        term, row = term[order], row[order]
    starts = _runs(term)
    first = np.ones(len(term), np.int64)
    first[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
    rows = np.add.reduceat(first, starts) if len(starts) else first
    total = np.diff(starts, append=len(term))
    found = term[starts]
    single = int(np.searchsorted(found, many))
    left, right = np.divmod(found[single:] - many, max(1, many))
    pairs = pc.binary_join_element_wise(words.take(pa.array(left)), words.take(pa.array(right)), " ")
    terms = pa.concat_arrays([words.take(pa.array(found[:single])), pairs])
    return pa.RecordBatch.from_arrays([terms, pa.array(rows), pa.array(total)], names=["term", "df", "total"])


def load_counts(df: DataFrame, clean: str) -> DataFrame:
    """(term, df, total), a row for each load that has the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lists = word_lists(*batch.columns)
            for load in _loads(pa.RecordBatch.from_arrays([lists], names=["words"])):
                words = len(load.columns[0].flatten())
                if held and size + words > LOAD_WORDS:
                    yield count_terms(pa.concat_arrays(held))
                    held, size = [], 0
                held.append(load.columns[0])
                size += words
        if held:
            yield count_terms(pa.concat_arrays(held))

    return df.select(*word_columns(clean)).mapInArrow(run, "term string, df long, total long")


def distinct_words(df: DataFrame, clean: str, by: str | None = None) -> DataFrame:
    """(word) once each, or (by, word): what is between the spaces of texts. A load's
    words are told apart where it lies. Values of ``by`` are numbers from 0 on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = split_words(batch.columns[1])
            for load in _loads(pa.RecordBatch.from_arrays([batch.columns[0], lists], names=["by", "words"])):
                row, word, words = _numbered(load.columns[1], least=1)
                both = np.unique(load.columns[0].to_numpy()[row] * len(words) + word)
                group, word = np.divmod(both, max(1, len(words)))
                yield pa.RecordBatch.from_arrays([pa.array(group), words.take(pa.array(word))], names=["by", "word"])

    number = F.lit(0) if by is None else F.col(by)
    found = df.select(number.cast("long").alias("by"), clean).mapInArrow(run, "by long, word string")
    return found.select("word").distinct() if by is None else found.select(F.col("by").alias(by), "word").distinct()


class KnownTerms:
    """The terms of a vocabulary, found by the numbers of their words."""

    def __init__(self, terms: pa.Array, idx: np.ndarray):
        parts = pc.split_pattern(terms, " ")
        sizes = pc.list_value_length(parts).to_numpy()
        coded = parts.flatten().dictionary_encode()
        self.words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        at = np.cumsum(sizes) - sizes
        self.single = np.full(len(self.words) + 1, -1, np.int64)
        self.single[code[at[sizes == 1]]] = idx[sizes == 1]
        pair = code[at[sizes == 2]] * len(self.words) + code[at[sizes == 2] + 1]
        order = np.argsort(pair)
        self.pairs, self.pair_idx = pair[order], idx[sizes == 2][order]

    def counts(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, idx, tf) of the known terms of lists of words."""
        row, word, words = _numbered(lists)
        known = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        code = known.astype(np.int64)[word]
        single = self.single[code]
        pair = np.flatnonzero((row[1:] == row[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0))
        wanted = code[pair] * len(self.words) + code[pair + 1]
        met = np.zeros(len(pair), bool)
        at = np.searchsorted(self.pairs, wanted)
        inside = at < len(self.pairs)
        met[inside] = self.pairs[at[inside]] == wanted[inside]
        size = 1 + max(self.single.max(initial=0), self.pair_idx.max(initial=0))
        both = np.concatenate(
            [row[single >= 0] * size + single[single >= 0], row[pair[met]] * size + self.pair_idx[at[met]]]
        )
        both.sort()
        starts = _runs(both)
        found, idx = np.divmod(both[starts], size)
        return found, idx, np.diff(starts, append=len(both))


def known_frequencies(df: DataFrame, key: str, clean: str, vocabulary: DataFrame) -> DataFrame:
    """(key, idx, tf), two lists, of the terms of a vocabulary (term, idx) that was measured
    small, a row for each row of ``df`` with such a term."""
    table = vocabulary.select("term", "idx").toArrow().combine_chunks()
    terms = table["term"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    known = KnownTerms(terms, table["idx"].to_numpy().astype(np.int64))
    shared = df.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = word_lists(*batch.columns[1:])
            for load in _loads(pa.RecordBatch.from_arrays([batch.columns[0], lists], names=["key", "words"])):
                row, idx, tf = shared.value.counts(load.columns[1])
                starts = _runs(row)
                ends = pa.array(np.append(starts, len(row)).astype(np.int32))
                numbers, times = pa.array(idx.astype(np.int32)), pa.array(tf.astype(np.int64))
                columns = [load.columns[0].take(pa.array(row[starts]))]
                columns += [pa.ListArray.from_arrays(ends, values) for values in (numbers, times)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField(key, df.schema[key].dataType)]
    fields += [T.StructField("idx", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.LongType()))]
    names = [f.name for f in fields]
    return df.select(key, *word_columns(clean)).mapInArrow(run, T.StructType(fields))


def _new_keys(keys: pa.Array) -> np.ndarray:
    """Which keys differ from the one before; nulls are equal, and so are NaNs."""
    left, right = keys[:-1], keys[1:]
    same = pc.or_(pc.fill_null(pc.equal(left, right), False), pc.and_(left.is_null(), right.is_null()))
    if pa.types.is_floating(keys.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(left), pc.is_nan(right)), False))
    return np.concatenate([np.ones(min(1, len(keys)), bool), ~same.to_numpy(zero_copy_only=False)])


def unit_weights(counted: DataFrame, key: str, idf: DataFrame, lists: bool = False) -> DataFrame:
    """(key, idx, weight) with unit length per key, from ``known_frequencies`` and (idx, idf).
    With ``lists`` it is a row for each key, with two lists in the order of idx.

    Rows are brought together by key and sorted, so a task holds the counts of one key,
    of each term once however many rows the key has, besides the batch it works on.
    """
    table = idf.select("idx", "idf").toArrow()
    idx = table["idx"].to_numpy()
    values = np.zeros(1 + idx.max(initial=-1))
    values[idx] = table["idf"].to_numpy()
    shared = counted.sparkSession.sparkContext.broadcast(values)

    def summed(rows: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        keys, lists, times = rows.columns
        new, size = _new_keys(keys), len(shared.value)
        group = np.repeat(np.cumsum(new) - 1, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        both = group * size + lists.flatten().to_numpy()
        order = np.argsort(both, kind="stable")
        both = both[order]
        starts = _runs(both)
        tf = np.add.reduceat(times.flatten().to_numpy()[order], starts)
        return keys.take(pa.array(np.flatnonzero(new))), *np.divmod(both[starts], size), tf

    def weighed(keys: pa.Array, group: np.ndarray, idx: np.ndarray, tf: np.ndarray) -> Iterator[pa.RecordBatch]:
        weight = (1.0 + np.log(tf)) * shared.value[idx]
        norm = np.sqrt(np.bincount(group, weight * weight))
        columns = [pa.array(idx.astype(np.int32)), pa.array(weight / norm[group])]
        if lists:
            ends = pa.array(np.append(_runs(group), len(group)).astype(np.int32))
            columns, group = [pa.ListArray.from_arrays(ends, c) for c in columns], group[_runs(group)]
        done = pa.RecordBatch.from_arrays([keys.take(pa.array(group)), *columns], names=names)
        step = OUT_LISTS if lists else OUT_ROWS
        for at in range(0, done.num_rows, step):
            yield done.slice(at, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last key of a batch may go on in the next one.
            rows = batch if held is None else pa.concat_batches([held, batch])
            keys, group, idx, tf = summed(rows)
            last = int(np.searchsorted(group, len(keys) - 1))
            ends = pa.array([0, len(group) - last], pa.int32())
            numbers, times = pa.array(idx[last:].astype(np.int32)), pa.array(tf[last:])
            lists = [pa.ListArray.from_arrays(ends, v) for v in (numbers, times)]
            held = pa.RecordBatch.from_arrays([keys[-1:], *lists], schema=batch.schema)
            if last:
                yield from weighed(keys, group[:last], idx[:last], tf[:last])
        if held is not None:
            yield from weighed(*summed(held))

    fields = [T.StructField(key, counted.schema[key].dataType)]
    kinds = [T.ArrayType(k) if lists else k for k in (T.IntegerType(), T.DoubleType())]
    fields += [T.StructField(name, kind) for name, kind in zip(("idx", "weight"), kinds)]
    names = [f.name for f in fields]
    gathered = counted.repartition(key).sortWithinPartitions(key)
    return gathered.mapInArrow(run, T.StructType(fields))
