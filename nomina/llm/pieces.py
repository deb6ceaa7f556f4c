"""SentencePiece encoding and decoding through a table of distinct chunks.

A model whose pieces hold the space marker only at their front can never join
symbols across the start of a marked word. A text then splits into marked words
(the markers before a word and the word), every distinct one is segmented once
per table, and the ids of the text are the ids of its chunks in order. Decoding
works the same way round on runs of ids. The tables are local to a Python worker, hold TABLE_BYTES
at most, and are emptied when they are full and at the end of a task, which costs
time but no result.

No row is moved: encoding has no shuffle and any lost task is simply run again.

Edge cases: a null text is an empty text with no ids and an empty decoding;
white space only, repeated spaces and literal markers encode as in the library;
texts of any length are worked on whole; all columns of the input are kept, an
output replaces a column of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from nomina.llm.columns import without
from nomina.llm.words import list_column

MARK = "▁"
# Bytes of distinct chunks kept per worker, each way, and what an entry of a table
# takes beside its text and ids.
TABLE_BYTES, ENTRY_BYTES = 12 << 20, 220


class ChunkCoder:
    """Encodes and decodes whole texts, segmenting each distinct chunk once."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(len(self.model))]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross the space marker")
        if self.model.encode("  a b ") != self._plain(["  a b "])[0]:
            raise ValueError("this model normalises white space")
        self.lone_mark = np.array([self.model.piece_to_id(MARK)], np.int32).tobytes()
        self.opens = np.array([p.startswith(MARK) for p in pieces])
        self.pure = np.array([set(p) == {MARK} for p in pieces])
        self.release()

    def release(self) -> None:
        """Empty the tables."""
        self.ids_of: dict[str, bytes] = {}
        self.text_of: dict[bytes, str] = {}
        self.ids_bytes = self.text_bytes = 0

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The chunks of a text, without the marker each begins with."""
        if not text:
            return []
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return parts
        found, spaces = [], 0
        for part in parts:
            if part:
                found.append(" " * spaces + part)
                spaces = 0
            else:
                spaces += 1
        if spaces:  # markers that no word follows
            found.append(" " * (spaces - 1))
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        if self.ids_bytes > TABLE_BYTES:
            self.ids_of, self.ids_bytes = {}, 0
        split = [self.chunks(t) for t in texts]
        new = list({c for chunks in split for c in chunks if c not in self.ids_of})
        for chunk, ids in zip(new, self._plain(new)):
            self.ids_of[chunk] = np.array(ids, np.int32).tobytes()
            self.ids_bytes += ENTRY_BYTES + 4 * len(chunk) + 4 * len(ids)
        self.ids_of[""] = self.lone_mark
        look = self.ids_of.__getitem__
        blobs = [b"".join(map(look, chunks)) for chunks in split]
        lengths = np.array([len(b) // 4 for b in blobs], np.int64)
        return np.frombuffer(b"".join(blobs), np.int32), lengths

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        if self.text_bytes > TABLE_BYTES:
            self.text_of, self.text_bytes = {}, 0
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        # A chunk begins at a piece with a marker, unless only markers stand before it.
        begins = self.opens[ids]
        begins[1:] &= ~self.pure[ids[:-1]]
        begins[bounds[:-1][lengths > 0]] = True
        cuts = np.append(np.flatnonzero(begins), len(ids))
        raw, at = ids.astype(np.int32, copy=False).tobytes(), (cuts * 4).tolist()
        keys = [raw[a:b] for a, b in zip(at, at[1:])]
        new = list({k for k in keys if k not in self.text_of})
        decoded = self.model.decode([np.frombuffer(k, np.int32).tolist() for k in new], num_threads=1) if new else []
        for key, text in zip(new, decoded):
            self.text_of[key] = (" " + text) if self.opens[int.from_bytes(key[:4], "little")] else text
            self.text_bytes += ENTRY_BYTES + 4 * len(text) + len(key)
        parts = list(map(self.text_of.__getitem__, keys))
        first = np.searchsorted(cuts, bounds).tolist()
        whole = ["".join(parts[a:b]) for a, b in zip(first, first[1:])]
        # The library drops the marker it has put in front of the text.
        return [t[1:] if t.startswith(" ") else t for t in whole]


@cache
def _coder(model_path: str) -> ChunkCoder:
    return ChunkCoder(model_path)


# Texts of a slice, and ids of a slice, in bytes.
SLICE = 1 << 20


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > SLICE:
            yield first, i
            first, total = i, 0
        total += size
    if sizes:
        yield first, len(sizes)


def encode(df: DataFrame, text: str, model_path: str, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add the piece ids of ``text``; with ``decoded`` also their decoding.

    ``model_path`` must be readable on every executor, as an installed package
    or a shared file is.
    """
    df = without(df, [ids] + [decoded] * (decoded is not None), [text])
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    if decoded is not None:
        fields.append(T.StructField(decoded, T.StringType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model_path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            sizes = pc.binary_length(texts).fill_null(0).to_pylist()
            for a, b in _runs(sizes):
                part = batch.slice(a, b - a)
                values, lengths = coder.encode([t or "" for t in texts.slice(a, b - a).to_pylist()])
                columns = [list_column(values, lengths)]
                if decoded is not None:
                    columns.append(pa.array(coder.decode(values, lengths), pa.string()))
                yield _widened(part, [f.name for f in fields], columns)
        coder.release()

    return df.mapInArrow(run, T.StructType(df.schema.fields + fields))


def decode(df: DataFrame, ids: str, model_path: str, out: str = "decoded") -> DataFrame:
    """Add the text of the piece ids in the array column ``ids`` (null: no ids)."""
    df = without(df, [out], [ids])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model_path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            sizes = [4 * n for n in column.value_lengths().fill_null(0).to_pylist()]
            for a, b in _runs(sizes):
                rows = column.slice(a, b - a)
                lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                values = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                texts = coder.decode(values, lengths)
                yield _widened(batch.slice(a, b - a), [out], [pa.array(texts, pa.string())])
        coder.release()

    return df.mapInArrow(run, T.StructType(df.schema.fields + [T.StructField(out, T.StringType(), False)]))



def _widened(batch: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])
