"""Repeated passages: windows of words that an earlier document also has.

Every window of ``width`` words gets a Rabin-Karp hash: a polynomial over the
64-bit hashes of its words modulo 2**64. The windows of all documents are dealt
out by hash range, so that each task sees all equal windows, and those of a
document with a larger key than the smallest one are reported. Repeated windows
merge into maximal intervals, which are cut.

Windows are as many as words, so they travel packed: a task sorts the hashes
of a bounded number of windows (a *load*), and sends one row per load and
bucket, with differences of sorted hashes and the windows' numbers as byte
planes, about nine bytes a window. The keys go along per text or per window,
whichever are fewer, so a row grows with its windows only. What else is known of
a load's texts is sent once, in a row that only passes through a bucket.

Of equal windows of a load only one travels to its bucket, with the least key among
them: those of larger keys are repeats whatever other loads hold, and those of the
same key share its fate. So a window that a third of all documents share has one
entry per load in its bucket, not one per document, and it is compared with a minimum,
never paired.

Two windows count as equal when their 64-bit hashes are; n windows hold about
n * n / 2**65 chance pairs (0.0005 for 135 million windows).

Edge cases: null and empty texts have no words; texts shorter than a window lose
nothing; rows without a key are compared with nothing and stay whole; rows with
the same key do not cut each other, whether equal or not; an empty table gives
an empty table. All columns stay; an output replaces a column of the same name.
``df`` should be read from storage, so that a task that is run again sees its
rows in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from nomina.llm.columns import arrow_schema, text_bytes, without
from nomina.llm.words import (
    U64,
    Texts,
    hash_words,
    mix,
    pack_planes,
    pack_small,
    split_words,
    text_slices,
    unpack_planes,
    unpack_small,
)
from nomina.scratch import attach, materialise

WIDTH = 13
# Windows sorted at a time in a task, and text bytes per bucket.
LOAD_WINDOWS = 500_000
BUCKET_BYTES = 4 << 20
OUTPUTS = ["n_words", "n_removed", "spans", "kept_text"]
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
# ``late``: windows that are repeats within their load; ``others``: windows that equal
# the one sent to a bucket (``sent``) and are of the same key.
HEAD = "keys binary, tags binary, firsts binary, late binary, others binary, sent binary"
PACKED = f"load string, bucket int, hashes binary, numbers binary, {HEAD}"


def window_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every window inside a text, and the windows of each text."""
    lengths = np.diff(bounds)
    counts = np.maximum(lengths - width + 1, 0)
    total = len(words) - width + 1
    if total <= 0:
        return np.zeros(0, U64), counts
    base = U64(0xD6E8FEB86659FD93)
    rolling = np.zeros(total, U64)
    for i in range(width):
        rolling *= base
        rolling += words[i : i + total]
    inside = np.zeros(total + 1, np.int64)
    full = counts > 0
    np.add.at(inside, bounds[:-1][full], 1)
    np.add.at(inside, bounds[:-1][full] + counts[full], -1)
    return mix(rolling[np.cumsum(inside[:-1]) > 0]), counts


def bucket_cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the equal ranges of the hash space cut sorted hashes."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], U64)
    return np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))


def one_of_each(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct hashes of windows in order and for each the number of one window of
    its least key; then the numbers of windows of larger keys, and those of the other
    windows of the least key, each with that of the window that stands for it."""
    order = np.argsort(hashes)
    hashes, keys = hashes[order], keys[order]
    new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    run = np.cumsum(new) - 1
    least = np.minimum.reduceat(keys, np.flatnonzero(new))[run]
    late = order[keys > least]
    even = np.flatnonzero(keys == least)
    first = np.concatenate(([True], run[even[1:]] != run[even[:-1]]))
    sent = order[even[first]]
    others = even[~first]
    return hashes[new], sent, late, order[others], sent[run[others]]


class _Load:
    """The windows of some documents, waiting to be sorted and sent."""

    def __init__(self) -> None:
        self.hashes: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.tags: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, hashes: np.ndarray, keys: np.ndarray, tags: np.ndarray, counts: np.ndarray) -> None:
        some = counts > 0
        self.hashes.append(hashes)
        self.keys.append(keys[some])
        self.tags.append(tags[some])
        self.counts.append(counts[some])
        self.size += len(hashes)

    def rows(self, name: str, buckets: int) -> pa.RecordBatch:
        hashes, keys = np.concatenate(self.hashes), np.concatenate(self.keys)
        tags, counts = np.concatenate(self.tags), np.concatenate(self.counts)
        # The order of the rows is part of the name: parts of two different
        # runs of a task can never be put together.
        seen = mix(keys.view(U64) * (2 * np.arange(len(keys), dtype=U64) + U64(1)) + tags.astype(U64))
        name = f"{name}-{int(seen.sum(dtype=U64)):x}"
        firsts = np.cumsum(counts) - counts
        by_text, first_of = pack_planes(keys.view(U64)), pack_small(firsts)
        hashes, numbers, *rest = one_of_each(hashes, np.repeat(keys, counts))
        cuts = bucket_cuts(hashes, buckets)
        full = np.flatnonzero(np.diff(cuts)).tolist()
        rows = {c.split()[0]: [] for c in PACKED.split(", ")}

        def add(*values) -> None:
            for column, value in zip(rows.values(), [*values, *[None] * (len(rows) - len(values))]):
                column.append(value)

        head = by_text, pack_small(tags.view(np.uint32)), first_of, *map(pack_small, rest)
        add(name, -1 - int(seen[0] % U64(buckets)), None, None, *head)
        for bucket in full:
            some = numbers[cuts[bucket] : cuts[bucket + 1]]
            packed = pack_planes(hashes[cuts[bucket] : cuts[bucket + 1]]), pack_small(some)
            if len(some) < len(keys):
                own = keys[np.searchsorted(firsts, some, "right") - 1]
                add(name, bucket, *packed, pack_planes(own.view(U64)))
            else:
                add(name, bucket, *packed, by_text, None, first_of)
        return pa.RecordBatch.from_pydict(rows, schema=arrow_schema(PACKED))


def _pack_windows(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, sent, load = TaskContext.get().partitionId(), 0, _Load()
        for batch in batches:
            keys, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for texts in text_slices(batch.column(2)):
                words = split_words(texts)
                hashes, counts = window_hashes(hash_words(texts.data, words), words.bounds, width)
                load.add(hashes, keys[texts.first : texts.last], tags[texts.first : texts.last], counts)
                if load.size >= LOAD_WINDOWS:
                    yield load.rows(f"{partition}-{sent}", buckets)
                    sent, load = sent + 1, _Load()
        if load.size:
            yield load.rows(f"{partition}-{sent}", buckets)

    return run


REPEATS = f"load string, numbers binary, {HEAD}"


def _keys_of(numbers: np.ndarray, keys: bytes, firsts: bytes | None) -> np.ndarray:
    own = unpack_planes(keys).view(np.int64)
    return own if firsts is None else own[np.searchsorted(unpack_small(firsts), numbers, "right") - 1]


def _repeated(table: pa.Table) -> pa.Table:
    """Of one bucket: per load the windows that a smaller key has as well. Rows
    that describe loads pass through."""
    if table["bucket"][0].as_py() < 0:
        return table.select(arrow_schema(REPEATS).names)
    hashes = [unpack_planes(b) for b in table["hashes"].to_pylist()]
    numbers = [unpack_small(b) for b in table["numbers"].to_pylist()]
    texts = zip(numbers, table["keys"].to_pylist(), table["firsts"].to_pylist())
    keys = np.concatenate([_keys_of(*t) for t in texts])
    bounds = np.cumsum([0, *map(len, hashes)])
    merged = np.concatenate(hashes)
    order = np.argsort(merged)
    merged = merged[order]
    new = np.concatenate(([True], merged[1:] != merged[:-1]))
    del merged
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(order)))
    least = np.repeat(np.minimum.reduceat(keys[order], starts), sizes)
    late = np.zeros(len(order), bool)
    late[order] = keys[order] > least
    chosen = [np.sort(n[late[a:z]]) for n, a, z in zip(numbers, bounds, bounds[1:])]
    kept = [i for i, c in enumerate(chosen) if len(c)]
    rows = dict.fromkeys(arrow_schema(REPEATS).names, [None] * len(kept))
    rows["load"] = table["load"].take(pa.array(kept, pa.int64())).to_pylist()
    rows["numbers"] = [pack_planes(chosen[i].astype(U64)) for i in kept]
    return pa.table(rows, schema=arrow_schema(REPEATS))


SPANS = T.StructType(
    [T.StructField("__key", T.LongType()), T.StructField("__tag", T.IntegerType()), T.StructField("spans", SPAN)]
)


def merge_windows(owner: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals (owner, start, end) of windows sorted by owner and start."""
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + width)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], start[last] + width


def _spans_of_load(width: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        # Fails where the parts of a load come from different runs of a task.
        head = next(r for r in rows if r["keys"] is not None)
        found = [unpack_planes(r["numbers"]) for r in rows if r["numbers"] is not None]
        repeats = np.concatenate(found).astype(np.uint32) if found else np.zeros(0, np.uint32)
        others = unpack_small(head["others"])[np.isin(unpack_small(head["sent"]), repeats)]
        numbers = np.sort(np.concatenate((repeats, others, unpack_small(head["late"]))).astype(np.int64))
        if not len(numbers):
            return pa.table({n: [] for n in SPANS.names}, schema=to_arrow_schema(SPANS))
        keys = unpack_planes(head["keys"]).view(np.int64)
        tags = unpack_small(head["tags"]).view(np.int32)
        firsts = unpack_small(head["firsts"]).astype(np.int64)
        owner = np.searchsorted(firsts, numbers, "right") - 1
        owner, start, end = merge_windows(owner, numbers - firsts[owner], width)
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        items = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"])
        bounds = pa.array(np.append(first, len(owner)), pa.int32())
        lists = pa.ListArray.from_arrays(bounds, items)
        return pa.table({"__key": keys[owner[first]], "__tag": tags[owner[first]], "spans": lists})

    return run


def repeated_spans(df: DataFrame, key: str, text: str, width: int = WIDTH) -> DataFrame:
    """(__key, __tag, spans): word intervals of each text that windows of a text
    with a smaller key cover. ``__tag`` tells texts with the same key apart."""
    buckets = max(1, -(-text_bytes(df, text) // BUCKET_BYTES))
    rows = df.where(F.col(key).isNotNull() & (F.length(F.col(text)) > 0)).select(
        F.col(key).cast("long"), F.hash(F.col(text)), F.col(text)
    )
    packed = rows.mapInArrow(_pack_windows(width, buckets), PACKED)
    repeats = packed.groupBy("bucket").applyInArrow(_repeated, REPEATS)
    return repeats.groupBy("load").applyInArrow(_spans_of_load(width), SPANS)


def _cut(texts: Texts, raw: bytes, spans: pa.Array) -> tuple[list[int], list[int], list[bytes]]:
    n_words, n_removed, kept = [], [], []
    offsets = texts.offsets.tolist()
    for i, cuts in enumerate(spans):
        words = raw[offsets[i] : offsets[i + 1]].split()
        n_words.append(len(words))
        if cuts.is_valid:
            for cut in reversed(cuts.as_py()):
                del words[cut["start"] : cut["end"]]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words))
    return n_words, n_removed, kept


def cut_repeats(df: DataFrame, key: str, text: str, width: int = WIDTH) -> DataFrame:
    """Add n_words, n_removed, spans (removed word intervals; null: none) and
    kept_text, the words that stay, joined by one space."""
    plain = without(df, OUTPUTS, [key, text])
    # Repeated rows have equal spans, of which one is enough.
    spans = repeated_spans(df, key, text, width).dropDuplicates(["__key", "__tag"])
    spans = materialise(spans, "spans")
    # The input's columns are one struct while columns of our own are about.
    tagged = plain.select(
        F.struct(*[F.col(f"`{c}`") for c in plain.columns if c != text]).alias("row"),
        F.col(f"`{text}`").alias("text"),
        F.col(f"`{key}`").cast("long").alias("__key"),
        F.hash(F.col(f"`{text}`")).alias("__tag"),
    )
    joined = attach(tagged, spans, ["__key", "__tag"], "left").select("row", "text", "spans")
    schema = T.StructType(
        joined.drop("spans").schema.fields
        + [
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", SPAN),
            T.StructField("kept_text", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column(1)):
                part = batch.slice(texts.first, texts.last - texts.first)
                spans = part.column(part.num_columns - 1)
                n_words, n_removed, kept = _cut(texts, texts.data.tobytes(), spans)
                columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), spans]
                columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=schema.names)

    own = [F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in plain.columns]
    return joined.mapInArrow(run, schema).select(*own, *OUTPUTS)
