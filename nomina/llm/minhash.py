"""Near-duplicate documents by b-bit MinHash.

Each document becomes a set of word shingles. Its minima under HASHES random
permutations are banded into candidate keys, and the low BITS bits of every
minimum are packed into a signature, from which the similarity of two documents
is estimated: of the minima whose bits agree, a share of 2**-BITS agrees by
chance. Candidates whose estimate may reach the threshold are confirmed on the
whole sets.

Steps: documents with equal sets become one class. In every band bucket each
class is compared with the smallest class (a star, never all pairs), links are
confirmed and joined to components. Only buckets that then still hold several
components are opened: there, classes of different components are compared with
each other inside a task, hot buckets as pairs of blocks, and what is sent on is a
spanning set of the links, not the links.

Two documents at similarity s meet in a bucket with probability
1 - (1 - s**ROWS)**BANDS: 0.999997 at 0.8, more above. The estimate's standard
error at 0.8 is 0.038; SLACK is more than five of it.

Edge cases: null and empty texts have no shingles and link with nothing; a text
with fewer words than a shingle is one shingle; rows without a key link with
nothing and have no component; rows with one key are one node; an empty table
gives an empty table; texts of any length are read whole. Other columns of the
input, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.llm.blocks import Forest, by_unit, paired_blocks, units
from nomina.llm.components import components
from nomina.llm.words import U64, hash_words, list_column, mix, pack_planes, split_words, text_slices, unpack_planes
from nomina.scratch import attach, materialise

BANDS, ROWS, BITS = 32, 5, 2
HASHES = BANDS * ROWS
SLACK = 0.2
# Classes in a block of a hot bucket.
BLOCK = 1000
# Bits of a shingle's hash that sets are compared by.
SET_BITS = 48


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, and their number per text."""
    lengths = np.diff(bounds)
    counts = np.where(lengths > 0, np.maximum(lengths - width + 1, 1), 0)
    first = np.cumsum(counts) - counts
    at = np.repeat(bounds[:-1] - first, counts) + np.arange(int(counts.sum()))
    end = np.repeat(bounds[1:], counts)
    found = np.zeros(len(at), U64)
    for i in range(width):
        here = at + i
        inside = here < end
        found = found * U64(0xD6E8FEB86659FD93)
        found[inside] += words[here[inside]]
    return mix(found), counts


def _constants() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_241)
    odd = random.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, random.integers(0, 2**32, HASHES, dtype=np.uint32)


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The minima (texts x HASHES) of runs of shingle hashes that begin at ``starts``."""
    odd, shift = _constants()
    short = (hashes >> U64(32)).astype(np.uint32)
    found = np.empty((len(starts), HASHES), np.uint32)
    for k in range(HASHES):
        found[:, k] = np.minimum.reduceat(short * odd[k] + shift[k], starts)
    return found


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key per band (texts x BANDS), different for every band."""
    parts = found.reshape(len(found), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), parts.shape[:2]).copy()
    for i in range(ROWS):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def signatures(found: np.ndarray) -> np.ndarray:
    """The low BITS bits of every (mixed) minimum, packed into longs."""
    per_long = 64 // BITS
    low = ((found * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(U64)
    low = low.reshape(len(found), HASHES // per_long, per_long)
    return (low << (np.arange(per_long, dtype=U64) * U64(BITS))).sum(axis=2, dtype=U64).view(np.int64)


_PAIRS = 0x5555555555555555


def corrected(disagreeing):
    """Similarity from the number of minima whose bits differ."""
    chance = 0.5**BITS
    return (1.0 - disagreeing / HASHES - chance) / (1.0 - chance)


def estimate(left: Column, right: Column) -> Column:
    """The estimate for two signatures, inside the JVM."""
    def differing(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_PAIRS)))

    counts = F.zip_with(left, right, differing)
    return corrected(F.aggregate(counts, F.lit(0), lambda s, x: s + x).cast("double"))


def estimate_rows(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The estimates of one signature against many."""
    x = one ^ many
    return corrected(np.bitwise_count((x | (x >> 1)) & np.int64(_PAIRS)).sum(axis=1))


SKETCH = "row_key long, tag long, n_shingles long, d1 long, d2 long, bands array<long>, signature array<long>"


def sketches(df: DataFrame, width: int) -> DataFrame:
    """Set size, 128-bit set digest, band keys and signature of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column(2)):
                words = split_words(texts)
                hashes, counts = shingle_hashes(hash_words(texts.data, words, fold=True), words.bounds, width)
                full = counts > 0
                ends = np.cumsum(counts)
                n, d1, d2 = (np.zeros(len(counts), kind) for kind in (np.int64, U64, U64))
                for i in np.flatnonzero(full):
                    own = np.sort(hashes[ends[i] - counts[i] : ends[i]])
                    own = own[np.concatenate(([True], own[1:] != own[:-1]))]
                    n[i], d1[i] = len(own), mix(own ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)
                    d2[i] = mix(own + U64(0x1234567812345678)).sum(dtype=U64)
                bands = np.zeros((len(counts), BANDS), np.int64)
                packed = np.zeros((len(counts), HASHES * BITS // 64), np.int64)
                if full.any():
                    found = minima(hashes, (ends - counts)[full])
                    bands[full], packed[full] = band_keys(found), signatures(found)
                rows = len(counts)
                columns = [
                    batch.column(0).slice(texts.first, rows), batch.column(1).slice(texts.first, rows),
                    pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), list_column(bands.ravel(), np.full(rows, BANDS)),
                    list_column(packed.ravel(), np.full(rows, packed.shape[1])),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["row_key", "tag", "n_shingles", "d1", "d2", "bands", "signature"]
                )

    return df.select("row_key", "tag", "text").mapInArrow(run, SKETCH)


def shingle_sets(df: DataFrame, width: int) -> DataFrame:
    """(rep, members): the set of every text, packed as sorted short hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column(1)):
                words = split_words(texts)
                hashes, counts = shingle_hashes(hash_words(texts.data, words, fold=True), words.bounds, width)
                short = hashes >> U64(64 - SET_BITS)
                ends = np.cumsum(counts)
                packed = [pack_planes(np.unique(short[e - c : e])) for e, c in zip(ends, counts)]
                rows = batch.column(0).slice(texts.first, len(counts))
                yield pa.RecordBatch.from_arrays([rows, pa.array(packed, pa.binary())], names=["rep", "members"])

    return df.select("rep", "text").mapInArrow(run, "rep long, members binary")


def _linked(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (a, b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                left, right = unpack_planes(a), unpack_planes(b)
                at = np.minimum(np.searchsorted(left, right), len(left) - 1)
                common = int((left[at] == right).sum())
                if _linked(common, len(left), len(right), percent):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return run


def _open_buckets(percent: int, least: float):
    """Compare classes of different components within each unit of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in units(batches, ["bucket", "low", "high"]):
            found = _unit_links(table.combine_chunks(), percent, least)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def _unit_links(table: pa.Table, percent: int, least: float) -> np.ndarray:
    reps, block = table["rep"].to_numpy(), table["block"].to_numpy()
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    signature = table["signature"].combine_chunks().flatten().to_numpy().reshape(len(reps), -1)
    band = int(np.flatnonzero(bands[0] == table["bucket"][0].as_py())[0])
    sets = [unpack_planes(m) for m in table["members"].to_pylist()]
    sizes = np.array(list(map(len, sets)))
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1].ravel()
    first = np.cumsum(sizes) - sizes
    forest = Forest(len(reps))
    component = table["component"].to_numpy()
    order = np.argsort(component, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
        forest.join(group)
    marks = np.zeros(int(ids.max()) + 1, np.int32)
    links = []
    for x in range(len(reps)):
        other = np.arange(x + 1, len(reps))
        other = other[forest.root[other] != forest.root[x]]
        if low != high:
            other = other[block[other] != block[x]]
        # A pair belongs to the first band it shares.
        other = other[(bands[other, :band] != bands[x, :band]).all(axis=1)]
        other = other[estimate_rows(signature[x], signature[other]) >= least]
        if not len(other):
            continue
        own = ids[first[x] : first[x] + sizes[x]]
        marks[own] = 1
        at = np.repeat(first[other] - (np.cumsum(sizes[other]) - sizes[other]), sizes[other])
        hits = marks[ids[at + np.arange(len(at))]]
        common = np.add.reduceat(hits, np.cumsum(sizes[other]) - sizes[other])
        marks[own] = 0
        for y in other[_linked(common, sizes[x], sizes[other], percent)]:
            if forest.root[x] != forest.root[y]:
                links.append((reps[x], reps[y]))
                forest.join(np.array([x, y]))
    return np.array(links, np.int64).reshape(-1, 2)


def near_duplicates(
    df: DataFrame, key: str, text: str, width: int = 5, percent: int = 80, tag: str | None = None
) -> DataFrame:
    """(key, n_shingles, component_id, kept), a row per row of ``df``.

    ``component_id`` is the smallest key reachable over links of at least
    ``percent`` per cent similarity, ``kept`` tells whether it is the row's own.
    With ``tag`` there is a column of that name with xxhash64 of the text, which
    tells rows that share a key apart.
    """
    plain = df.select(F.col(key).cast("long").alias("row_key"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    least = percent / 100 - SLACK
    sketch = materialise(sketches(plain, width), "sketches")
    full = sketch.where("n_shingles > 0 AND row_key IS NOT NULL")
    # Classes of equal sets go by a number of their own: keys may have several texts.
    classes = full.groupBy("d1", "d2").agg(F.min(F.struct("row_key", "tag")).alias("first"))
    classes = materialise(classes.select("d1", "d2", F.xxhash64("d1", "d2").alias("rep"), "first.*"), "classes")
    heads = full.join(classes, ["d1", "d2", "row_key", "tag"]).select("rep", "bands", "signature").dropDuplicates(["rep"])

    banded = heads.select("rep", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1")
    met = materialise(banded.join(shared, "bucket"), "met")
    stars = met.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    short = materialise(heads.select("rep", "signature"), "signatures")
    with_a = attach(stars, short.toDF("a", "sa"), ["a"])
    stars = attach(with_a, short.toDF("b", "sb"), ["b"]).where(estimate(F.col("sa"), F.col("sb")) >= least)

    wanted = classes.select("rep", "row_key", "tag").join(met.select("rep").distinct(), "rep", "left_semi")
    wanted = materialise(wanted, "wanted")
    sets = materialise(shingle_sets(attach(plain, wanted, ["row_key", "tag"]), width), "sets")
    pairs = stars.select("a", "b").join(sets.toDF("a", "ma"), "a").join(sets.toDF("b", "mb"), "b")
    confirmed = materialise(
        pairs.select("a", "b", "ma", "mb").mapInArrow(_confirm(percent), "a long, b long").distinct(), "stars"
    )

    joined = materialise(components(confirmed, "a", "b"), "joined")
    placed = attach(met.select("bucket", "rep", "n"), joined.toDF("rep", "component"), ["rep"], "left")
    placed = materialise(placed.withColumn("component", F.coalesce("component", "rep")), "placed")
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.max("n").alias("n")
    )
    mixed = materialise(mixed.where("_low <> _high").select("bucket", "n"), "mixed")
    rows = paired_blocks(placed.drop("n"), mixed, "bucket", "rep", BLOCK)
    rows = rows.join(heads, "rep").join(sets, "rep")
    opened = by_unit(rows, "bucket").mapInArrow(_open_buckets(percent, least), "a long, b long")

    # Components of the first round come in as links of each class to its root.
    links = confirmed.unionByName(materialise(opened.distinct(), "opened"))
    found = materialise(components(links, "a", "b"), "components").toDF("rep", "component")
    reached = attach(classes.select("d1", "d2", "rep", "row_key"), found, ["rep"], "left")
    reached = reached.withColumn("component", F.coalesce("component", "rep"))
    smallest = materialise(reached.groupBy("component").agg(F.min("row_key").alias("component_id")), "smallest")
    reached = materialise(attach(reached, smallest, ["component"]).select("d1", "d2", "component_id"), "reached")
    known = attach(sketch.select("row_key", "tag", "n_shingles", "d1", "d2"), reached, ["d1", "d2"], "left")
    has_set = (F.col("n_shingles") > 0) & F.col("row_key").isNotNull()
    known = known.select(
        F.col("row_key").alias(key),
        *([F.col("tag").alias(tag)] if tag else []),
        "n_shingles",
        F.when(has_set, F.col("component_id")).otherwise(F.col("row_key")).alias("component_id"),
    )
    return known.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
