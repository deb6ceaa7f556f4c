"""Near-duplicate vectors by spherical-cap filters with random product codes.

A filter is a direction; a vector belongs to it when its projection exceeds a
threshold. Directions are products of random codes: the space, randomly rotated,
is cut into blocks of dimensions, each block has a list of random unit codewords,
and every choice of one codeword per block is a direction. So a vector's filters
are found by list decoding - block by block, dropping prefixes that the best rest
could not lift over the threshold - without looking at most of the directions.
Vectors that share a filter are compared exactly.

The threshold makes a filter hold BUCKET random vectors on average, however many
there are, and the number of directions gives two vectors at the wanted cosine
SHARED common filters per code on average, more above it. There are two blocks at
every size, as shorter ones cut vectors worse and lose pairs; so a list has about
the square root of the directions, and the work of scoring it grows with the root
of the number of vectors, while the filters per vector stay about the same. A
vector that one code's blocks cut badly has few filters there, so there are
independent ones, CODES or as many as it takes until RECALL of random pairs at the
very threshold meet in a trial of the code itself (a test repeats it with other
pairs for 500 to 100 million vectors). For vectors of less than FEW_COMPONENTS, and
wherever MOST_CODES do not reach it, there are boxes, which lose no pair: two unit
vectors at the wanted cosine differ by at most a fixed length in every component, so
the space is cut into boxes twice as long that overlap by that length, and some box
holds both. A vector is in two boxes per component at most.
A link is counted in the first filter a pair shares.
Equal vectors are one class with a multiplicity. Filters with many classes are
worked on as pairs of blocks; what leaves a task are counts and a spanning set.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a key, link with nothing; vectors of different
lengths never link; every row is a vector, repeated keys included; an empty
table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.llm.blocks import paired_blocks, units
from nomina.llm.components import components
from nomina.llm.words import list_column
from nomina.scratch import attach, materialise

BUCKET = 32
SHARED = 6.0
CODES, MOST_CODES, FEW_COMPONENTS = 3, 12, 8
# Share of pairs at the wanted cosine that shall meet, and pairs and vectors of a trial.
RECALL, TRIALS = 0.98, 1000
# Scores held at a time, and prefixes grown together in list decoding.
SCORES, GROWN = 2_000_000, 2_000_000
# Vectors decoded at a time, classes in a block of a hot filter, and pairs and
# filters looked at together in the search for common filters.
CHUNK, BLOCK, PAIRS, BITS = 256, 1000, 20_000, 1024


@dataclass(frozen=True)
class Code:
    """Sizes of a product code for vectors of ``dim`` components."""

    dim: int
    blocks: int
    words: int
    threshold: float
    codes: int = CODES


def conditional_hit(z: float, cosine: float) -> float:
    """P(Y > z | X > z) for standard normal X, Y with correlation ``cosine``."""
    normal = NormalDist()
    x = np.linspace(z, z + 8, 4000)
    density = np.exp(-x * x / 2)
    spread = np.sqrt(1 - cosine**2)
    over = np.array([1 - normal.cdf((z - cosine * v) / spread) for v in x])
    return float((density * over).sum() / density.sum())


@dataclass(frozen=True)
class Boxes:
    """Overlapping boxes of unit vectors of ``dim`` components: of two vectors that
    differ by at most ``reach`` in every component, some box holds both."""

    dim: int
    reach: float

    def filters(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, box) of every box a vector is in, by vector."""
        # Box c of a component is from 2c to 2c + 3 times the reach.
        place = (vectors + 1) / self.reach
        last = np.floor(place / 2).astype(np.int64)
        count = int(np.floor(2 / self.reach / 2)) + 2
        both = (last > 0) & (place - 2 * last <= 1)
        owner, box = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        for d in range(self.dim):
            one = last[owner, d]
            again = np.flatnonzero(both[owner, d])
            owner, box = np.concatenate((owner, owner[again])), np.concatenate((box * count + one, box[again] * count + one[again] - 1))
        order = np.lexsort((box, owner))
        return owner[order], box[order]


def boxes_for(dim: int, cosine: float) -> Boxes:
    # A little longer than the distance, for what rounding does to it.
    return Boxes(dim, float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9)


@lru_cache
def code_for(n: int, dim: int, cosine: float) -> Code | Boxes:
    """The code for ``n`` vectors, or boxes where no code finds enough pairs."""
    if dim < FEW_COMPONENTS:
        return boxes_for(dim, cosine)
    share = min(0.02, BUCKET / max(n, 1))
    z = NormalDist().inv_cdf(1 - share)
    directions = SHARED / conditional_hit(z, cosine) / share
    blocks = 2
    words = int(np.ceil(directions ** (1 / blocks)))
    code = Code(dim, blocks, words, _threshold(dim, blocks, words, share))
    # Codes until enough pairs meet, by trial.
    one, two = random_pairs(dim, cosine, TRIALS, 12)
    met = np.zeros(TRIALS, bool)
    for codes in range(1, MOST_CODES + 1):
        met |= _meet(one, two, code, codes - 1)
        if codes >= CODES and met.mean() >= RECALL:
            return replace(code, codes=codes)
        # Where not even MOST_CODES that miss independently would do.
        if 1 - (1 - met.mean()) ** (MOST_CODES / codes) < RECALL:
            break
    return boxes_for(dim, cosine)


def _threshold(dim: int, blocks: int, words: int, share: float) -> float:
    """The score that ``share`` of all directions exceed, over random vectors.

    All directions of a vector count: its ``most`` best sums of one word a block are
    among those whose ranks in the blocks have a product of at most ``most``. So
    there are about as many samples in the tail at any share.
    """
    each = share * words**blocks
    most = int(min(words**blocks, np.ceil(64 * each)))
    ranks = np.arange(1, min(words, most) + 1)
    first, second = np.nonzero(ranks[:, None] * ranks[None, : len(ranks) if blocks > 1 else 1] <= most)
    vectors = np.random.default_rng(11).standard_normal((TRIALS, dim))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    sums = []
    step = max(1, min(100, SCORES // words))
    for start in range(0, TRIALS, step):
        scores = _scores(vectors[start : start + step], dim, blocks, words, 0)
        tops = [-np.sort(-s, axis=1)[:, :most] for s in scores]
        total = tops[0][:, first] + tops[1][:, second] if blocks > 1 else tops[0]
        sums.append(-np.sort(-total, axis=1)[:, :most].ravel())
    total = np.concatenate(sums)
    kept = min(len(total), max(1, int(each * TRIALS)))
    return float(np.partition(total, len(total) - kept)[len(total) - kept])


def random_pairs(dim: int, cosine: float, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and partners at ``cosine``."""
    random = np.random.default_rng(seed)
    one, side = random.standard_normal((2, n, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    if dim == 1:
        return one, one
    side -= (side * one).sum(axis=1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return one, cosine * one + np.sqrt(1 - cosine**2) * side


def _meet(one: np.ndarray, two: np.ndarray, code: Code, number: int) -> np.ndarray:
    """Which pairs have a filter of one code in common."""
    met = np.zeros(len(one), bool)
    step = _step(code)
    for start in range(0, len(one), step):
        found = [_decode_one(v[start : start + step], code, number) for v in (one, two)]
        common = np.intersect1d(*(owner * code.words**code.blocks + prefix for owner, prefix in found))
        met[start + common // code.words**code.blocks] = True
    return met


@lru_cache
def _code_words(dim: int, blocks: int, words: int, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
    random = np.random.default_rng([dim, blocks, number])
    rotation = np.linalg.qr(random.standard_normal((dim, dim)))[0]
    lists = []
    for part in np.array_split(np.arange(dim), blocks):
        own = random.standard_normal((words, len(part)))
        lists.append(own / np.linalg.norm(own, axis=1, keepdims=True))
    return rotation, lists


def _step(code: Code) -> int:
    """Vectors decoded at a time."""
    return max(1, min(CHUNK, SCORES // code.words))


def _scores(vectors: np.ndarray, dim: int, blocks: int, words: int, number: int) -> list[np.ndarray]:
    rotation, lists = _code_words(dim, blocks, words, number)
    turned = vectors @ rotation
    return [turned[:, p] @ own.T for p, own in zip(np.array_split(np.arange(dim), blocks), lists)]


def decode(vectors: np.ndarray, code: Code | Boxes) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter) of every filter each unit vector exceeds, by vector."""
    if isinstance(code, Boxes):
        return code.filters(vectors)
    owners, filters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = _step(code)
    for start in range(0, len(vectors), step):
        for number in range(code.codes):
            owner, found = _decode_one(vectors[start : start + step], code, number)
            owners.append(start + owner)
            filters.append(found * code.codes + number)
    owner, found = np.concatenate(owners), np.concatenate(filters)
    order = np.lexsort((found, owner))
    return owner[order], found[order]


def _decode_one(vectors: np.ndarray, code: Code, number: int) -> tuple[np.ndarray, np.ndarray]:
    scores = _scores(vectors, code.dim, code.blocks, code.words, number)
    best = np.array([s.max(axis=1) for s in scores])
    rest = best[::-1].cumsum(axis=0)[::-1]
    owner, prefix = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    total = np.zeros(len(vectors))
    for i, own in enumerate(scores):
        # Only words that the best of all other blocks lift over the threshold.
        row, word = np.nonzero(own >= (code.threshold - (rest[0] - best[i]) - 1e-9)[:, None])
        value, sizes = own[row, word], np.bincount(row, minlength=len(vectors))
        firsts = np.cumsum(sizes) - sizes
        need = np.full(len(vectors), code.threshold)
        if i + 1 < len(scores):
            need -= rest[i + 1] + 1e-9
        ends = np.cumsum(sizes[owner])
        cuts = np.flatnonzero(np.diff(ends // GROWN)) + 1
        grown = []
        for part in np.split(np.arange(len(owner)), cuts):
            times = sizes[owner[part]]
            which = np.repeat(part, times)
            at = np.arange(len(which)) + np.repeat(firsts[owner[part]] - (np.cumsum(times) - times), times)
            sums = total[which] + value[at]
            over = sums >= need[owner[which]]
            which, at = which[over], at[over]
            grown.append((sums[over], prefix[which] * code.words + word[at], owner[which]))
        total, prefix, owner = (np.concatenate(g) for g in zip(*grown))
    return owner, prefix


def usable(vector: Column) -> Column:
    """The vector is there, not zero and wholly finite."""
    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce(~F.exists(vector, odd) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _filters(codes: dict[int, Code | Boxes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                vectors = part.column(1)
                sizes = vectors.value_lengths().to_numpy()
                for dim in np.unique(sizes):
                    rows = part.take(pa.array(np.flatnonzero(sizes == dim)))
                    flat = rows.column(1).flatten().to_numpy().astype(np.float64).reshape(-1, dim)
                    flat /= np.linalg.norm(flat, axis=1, keepdims=True)
                    owner, found = decode(flat, codes[int(dim)])
                    lists = list_column(found, np.bincount(owner, minlength=len(flat)))
                    yield pa.RecordBatch.from_arrays([rows.column(0), lists], names=["rep", "filters"])

    return run


def _share_earlier(filters: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, own: int) -> np.ndarray:
    """Whether the rows a and b have a filter smaller than ``own`` in common."""
    linked = np.zeros(len(sizes), bool)
    linked[a] = linked[b] = True
    owner = np.repeat(np.arange(len(sizes)), sizes)
    early = (filters < own) & linked[owner]
    ids, which, uses = np.unique(filters[early], return_inverse=True, return_counts=True)
    # Only filters that two rows have can be common; they become bits.
    bit = np.cumsum(uses > 1) - 1
    common = (uses > 1)[which.ravel()]
    row, bit = owner[early][common], bit[which.ravel()][common]
    found = np.zeros(len(a), bool)
    for start in range(0, int(bit.max()) + 1 if len(bit) else 0, BITS):
        here = (bit >= start) & (bit < start + BITS)
        flags = np.zeros((len(sizes), BITS), bool)
        flags[row[here], bit[here] - start] = True
        packed = np.packbits(flags, axis=1).view(np.uint64)
        for at in range(0, len(a), PAIRS):
            part = slice(at, at + PAIRS)
            found[part] |= (packed[a[part]] & packed[b[part]]).any(axis=1)
    return found


def _compare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in units(batches, ["dim", "bucket", "low", "high"]):
            out = _unit(table, cosine)
            if out is not None:
                yield out

    return run


def _unit(table: pa.Table, cosine: float) -> pa.RecordBatch | None:
    n, own = len(table), table["bucket"][0].as_py()
    if n < 2:
        return None
    reps, copies, block = (table[c].to_numpy() for c in ("rep", "copies", "block"))
    vectors = table["vector"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(n, -1)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    near = np.triu(vectors @ vectors.T >= cosine, 1)
    if table["low"][0].as_py() != table["high"][0].as_py():
        near &= block[:, None] != block[None, :]
    a, b = np.nonzero(near)
    if not len(a):
        return None
    lists = table["filters"].combine_chunks()
    first = ~_share_earlier(lists.flatten().to_numpy(), lists.value_lengths().to_numpy(), a, b, own)
    a, b = a[first], b[first]
    if not len(a):
        return None
    links = np.bincount(a, weights=copies[b], minlength=n) + np.bincount(b, weights=copies[a], minlength=n)
    root = reps.copy()
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    some = np.flatnonzero(links > 0)
    return pa.RecordBatch.from_pydict(
        {"rep": reps[some], "links": links[some].astype(np.int64), "root": root[some]}
    )


def near_vectors(df: DataFrame, key: str, vector: str, cosine: float = 0.9) -> DataFrame:
    """(key, n_links, component_id, kept), a row per row of ``df``.

    ``n_links`` counts the other vectors found at ``cosine`` or more,
    ``component_id`` is the smallest key reachable over links, the own included,
    and ``kept`` tells whether it is the row's own.
    """
    rows = df.select(F.col(key).cast("long").alias("row_key"), F.col(vector).alias("vector"))
    good = rows.where(F.col("row_key").isNotNull() & usable(F.col("vector")))
    marks = [F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2"), F.size("vector").alias("dim")]
    marked = good.select("row_key", "vector", *marks)
    # Equal vectors have equal marks (96 bits), so any of them may stand for the class.
    classes = marked.groupBy("h1", "h2", "dim").agg(
        F.min("row_key").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    classes = materialise(classes, "classes")
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    codes = {dim: code_for(n, dim, cosine) for dim, n in sizes.items()}

    # Classes with one key (rows that repeat a key with another vector) stay apart by their marks.
    named = classes.withColumn("class", F.xxhash64("h1", "h2", "dim"))
    found = named.select("class", "vector").mapInArrow(_filters(codes), "rep long, filters array<long>")
    filters = materialise(found.withColumnRenamed("rep", "class"), "filters")
    slim = named.select("class", "dim", "copies", "vector")
    members = filters.select("class", F.explode("filters").alias("bucket")).join(slim.select("class", "dim"), "class")
    members = materialise(members, "members")
    shared = members.groupBy("dim", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    keyed = members.withColumn("group", F.struct("dim", "bucket"))
    shared = shared.select(F.struct("dim", "bucket").alias("group"), "n")
    dealt = paired_blocks(keyed, shared, "group", "class", BLOCK).drop("group", "n", "dim")
    dealt = dealt.join(slim, "class").join(filters, "class").withColumnRenamed("class", "rep")
    sorted_units = dealt.repartition("dim", "bucket", "low", "high").sortWithinPartitions("dim", "bucket", "low", "high")
    linked = materialise(
        sorted_units.mapInArrow(_compare(cosine), "rep long, links long, root long"), "linked"
    )

    counts = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = linked.select("rep", "root").where("rep <> root").distinct()
    joined = components(edges, "rep", "root")
    # Components of classes, then the smallest key in each.
    placed = named.select("class", "rep", "copies", "h1", "h2", "dim")
    placed = placed.join(joined.toDF("class", "component"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    placed = placed.join(least, "component").join(counts.withColumnRenamed("rep", "class"), "class", "left")
    answers = placed.select(
        "h1", "h2", "dim", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    answers = materialise(answers, "answers")
    usable_rows = rows.withColumn("ok", F.col("row_key").isNotNull() & usable(F.col("vector")))
    asked = usable_rows.select("row_key", *[F.when(F.col("ok"), m).alias(n) for m, n in zip(
        (F.xxhash64("vector"), F.hash("vector"), F.size("vector")), ("h1", "h2", "dim"))])
    whole = attach(asked, answers, ["h1", "h2", "dim"], "left")
    component = F.coalesce("component_id", "row_key")
    return whole.select(
        F.col("row_key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("row_key").eqNullSafe(component).alias("kept"),
    )
