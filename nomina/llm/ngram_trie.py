"""Word-pair language model in Elias-Fano tries, and scores of whole texts.

The model is a trie of words and the words before them, dealt out by the hash of
the word: a bucket has all that is known about its words. Level one holds the
sorted word hashes, their running counts and the pointers to their ranges in
level two, level two the sorted context prints of each word and a one-byte code
of each pair's smoothed weight. All four sequences are monotone - the prints of
the i-th word are shifted by i * 2**40 - and travel and are stored in Elias-Fano form
as flat arrays. A task unpacks the levels of the bucket it works on to plain numbers;
nothing is mapped from a file. A pair is found by the successor of its shifted print
in the whole level, which lies in the range of its word where the word has the pair.

    p(w | c) = (n(c, w) + k * (n(w) + A)) / (n(c) + k * D),   D = N + A * (V + 1)

is a proper distribution over the V known words and one unknown: Dirichlet
smoothing towards the add-A unigram, whose strength k * D is about PRIOR
counts. The logarithm of the numerator needs nothing outside the bucket of w
and is what the codes stand for; the denominator only needs n(c), so it is
looked up where c is itself a word (the end of a text stands in for the start).
A text's score is therefore a sum of parts from several buckets.

Both passes over the texts send packed rows: a task sorts a bounded number of
tokens (a *load*), and sends each bucket its words, prints and counts once per
load. Words that very many texts use are thus combined before the shuffle. In
scoring, a bucket with more than twice the mean number of tokens (or, with very
many buckets, more than 1/HOT_BUCKETS of all) is worked on in several parts, each
with a copy of its trie.

Edge cases: null and empty texts consist of the end alone; a row without a key
is scored but not learnt from; repeated keys are scored row by row; with no
training texts the model is uniform over nothing (N = V = 0) and scores remain
finite; texts of any length are read whole. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.llm.columns import arrow_schema, text_bytes
from nomina.llm.substrings import bucket_cuts
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
from nomina.scratch import materialise

A = 0.1
PRIOR = 1000.0
# Mean bytes of a token, to turn PRIOR counts into a weight before N is known.
TOKEN_BYTES = 6
LOAD_TOKENS = 500_000
BUCKET_BYTES = 16 << 20
# More than this many buckets are never hot.
HOT_BUCKETS = 1000
PRINT_BITS = U64(40)
CODES = 256
# Hashes of the end and the start of a text.
END, START = U64(0xE3779B97F4A7C15E), U64(0x57A27A27A27A2757)


class EliasFano:
    """A monotone sequence of 64-bit numbers in one flat array of bytes.

    Layout: n, bytes per low part and length of the upper bits (three longs), the
    low parts as byte planes, the upper bits in unary. Low parts are rounded up to
    whole bytes, so the upper bits are at most 2 n.
    """

    def __init__(self, blob: bytes):
        n, low, upper = np.frombuffer(blob, np.int64, 3)
        planes = np.frombuffer(blob, np.uint8, int(n * low), 24).reshape(int(low), int(n))
        bits = np.unpackbits(np.frombuffer(blob, np.uint8, -1, int(24 + n * low)), count=int(upper))
        values = (np.flatnonzero(bits) - np.arange(n)).astype(U64)
        for plane in planes[::-1]:
            values = (values << U64(8)) | plane
        self.values = values

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = values.astype(U64)
        n = len(values)
        room = (int(values[-1]) // n).bit_length() if n else 0
        low = min(-(-room // 8), 7)
        head = values >> U64(8 * low)
        bits = np.zeros(int(head[-1]) + n if n else 0, np.uint8)
        bits[(head.astype(np.int64) + np.arange(n))] = 1
        planes = [((values >> U64(8 * i)) & U64(255)).astype(np.uint8).tobytes() for i in range(low)]
        return np.array([n, low, len(bits)], np.int64).tobytes() + b"".join(planes) + np.packbits(bits).tobytes()

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The position of the successor of each x and whether it is x itself."""
        if not len(self.values):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        at = np.searchsorted(self.values, x)
        at = np.minimum(at, len(self.values) - 1)
        return at, self.values[at] == x


class Tokens:
    """Words and end of some texts, as (word, print of the word before, text)."""

    def __init__(self) -> None:
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: Texts) -> None:
        split = split_words(texts)
        hashes = hash_words(texts.data, split, fold=True)
        lengths = np.diff(split.bounds) + 1
        ends = np.cumsum(lengths) - 1
        words = np.empty(int(lengths.sum()), U64)
        inner = np.ones(len(words), bool)
        inner[ends] = False
        words[inner], words[ends] = hashes, END
        before = np.empty(len(words), U64)
        before[1:] = words[:-1]
        before[ends - lengths + 1] = START
        self.words.append(words)
        self.before.append(mix(before) >> (U64(64) - PRINT_BITS))
        self.lengths.append(lengths)
        self.size += len(words)

    def sorted(self) -> dict[str, np.ndarray]:
        """Distinct words, their pairs, and the texts of each pair, in order."""
        lengths = np.concatenate(self.lengths)
        words, which = np.unique(np.concatenate(self.words), return_inverse=True)
        pair = (which.ravel().astype(U64) << PRINT_BITS) | np.concatenate(self.before)
        order = np.argsort(pair)
        pair = pair[order]
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        owner = (pair[first] >> PRINT_BITS).astype(np.int64)
        return {
            "lengths": lengths,
            "words": words,
            "pairs": np.bincount(owner, minlength=len(words)),
            "prints": pair[first] & ((U64(1) << PRINT_BITS) - U64(1)),
            "counts": np.diff(np.append(first, len(pair))),
            "texts": np.repeat(np.arange(len(lengths)), lengths)[order],
        }


def pack_prints(prints: np.ndarray) -> bytes:
    """Prints as five byte planes."""
    return np.ascontiguousarray(prints.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes()


def unpack_prints(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(5, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :5] = planes.T
    return whole.view(U64).ravel()


def _by_bucket(load: dict[str, np.ndarray], buckets: int) -> Iterator[tuple[int, dict[str, bytes], np.ndarray]]:
    """Per bucket: the packed words, pairs, prints and counts, and the texts."""
    cuts = bucket_cuts(load["words"], buckets)
    pair_at = np.concatenate(([0], np.cumsum(load["pairs"])))
    text_at = np.concatenate(([0], np.cumsum(load["counts"])))
    for bucket in range(buckets):
        a, b = cuts[bucket], cuts[bucket + 1]
        if a < b:
            p, q = pair_at[a], pair_at[b]
            packed = {
                "words": pack_planes(load["words"][a:b]),
                "pairs": pack_small(load["pairs"][a:b]),
                "prints": pack_prints(load["prints"][p:q]),
                "counts": pack_small(load["counts"][p:q]),
            }
            yield bucket, packed, load["texts"][text_at[p] : text_at[q]]


PAIRS = "bucket int, words binary, pairs binary, prints binary, counts binary"


def _pack_pairs(buckets: int):
    def rows(tokens: Tokens) -> Iterator[pa.RecordBatch]:
        for bucket, packed, _ in _by_bucket(tokens.sorted(), buckets):
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array([bucket], pa.int32()), **{k: [v] for k, v in packed.items()}}
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            for texts in text_slices(batch.column(0)):
                tokens.add(texts)
                if tokens.size >= LOAD_TOKENS:
                    yield from rows(tokens)
                    tokens = Tokens()
        if tokens.size:
            yield from rows(tokens)

    return run


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-byte codes and their codebook: equal steps of the logarithm, each
    standing for the mean of its values."""
    low, high = values.min(), values.max()
    codes = np.minimum((values - low) * (CODES / max(high - low, 1e-9)), CODES - 1).astype(np.int64)
    filled = np.bincount(codes, minlength=CODES)
    means = np.bincount(codes, weights=values, minlength=CODES) / np.maximum(filled, 1)
    return codes.astype(np.uint8), means.astype(np.float32)


LEVELS = (
    "bucket int, tokens long, known long, words binary, totals binary, "
    "pointers binary, prints binary, codes binary, codebook binary"
)


def _build(weight: float):
    """The trie of one bucket from the pairs of all loads."""

    def run(table: pa.Table) -> pa.Table:
        words = [unpack_planes(b) for b in table["words"].to_pylist()]
        pairs = [unpack_small(b) for b in table["pairs"].to_pylist()]
        distinct, which = np.unique(np.concatenate(words), return_inverse=True)
        owner = np.repeat(which.ravel().astype(U64), np.concatenate(pairs))
        keys = (owner << PRINT_BITS) | np.concatenate([unpack_prints(b) for b in table["prints"].to_pylist()])
        counts = np.concatenate([unpack_small(b) for b in table["counts"].to_pylist()]).astype(np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts, keys = np.add.reduceat(counts[order], first), keys[first]
        owner = (keys >> PRINT_BITS).astype(np.int64)
        starts = np.searchsorted(owner, np.arange(len(distinct) + 1))
        totals = np.add.reduceat(counts, starts[:-1])
        codes, book = quantise(np.log10(counts + weight * (totals[owner] + A)))
        return pa.table(
            {
                "bucket": table["bucket"].slice(0, 1),
                "tokens": [int(totals.sum())],
                "known": [len(distinct)],
                "words": [EliasFano.encode(distinct)],
                "totals": [EliasFano.encode(np.cumsum(totals))],
                "pointers": [EliasFano.encode(starts)],
                "prints": [EliasFano.encode(keys)],
                "codes": [codes.tobytes()],
                "codebook": [book.tobytes()],
            }
        )

    return run


class Trie:
    """The levels of one bucket, used from the bytes they are stored in."""

    def __init__(self, row: dict):
        self.words, self.prints = EliasFano(row["words"]), EliasFano(row["prints"])
        self.totals = np.diff(EliasFano(row["totals"]).values.astype(np.int64), prepend=0)
        self.pointers = EliasFano(row["pointers"]).values.astype(np.int64)
        self.codes = np.frombuffer(row["codes"], np.uint8)
        self.book = np.frombuffer(row["codebook"], np.float32).astype(np.float64)

    def look_up(self, words: np.ndarray, pairs: np.ndarray, prints: np.ndarray, weight: float):
        """Count of each word, and the log10 weight of each of its pairs."""
        at, known = self.words.find(words)
        counts = np.where(known, self.totals[at], 0)
        owner = np.repeat(np.arange(len(words)), pairs)
        place, found = self.prints.find((at[owner].astype(U64) << PRINT_BITS) | prints)
        found &= known[owner] & (place >= self.pointers[at[owner]]) & (place < self.pointers[at[owner] + 1])
        unseen = np.log10(weight * (counts[owner] + A))
        return counts, np.where(found, self.book[self.codes[place]], unseen)


class Model:
    """A trained model: the written table of tries and its global counts."""

    def __init__(self, tries: DataFrame, buckets: int, weight: float):
        self.tries, self.buckets, self.weight = tries, buckets, weight
        row = tries.agg(F.sum("tokens"), F.sum("known")).first()
        self.n, self.v = row[0] or 0, row[1] or 0

    @property
    def mass(self) -> float:
        return self.n + A * (self.v + 1)

    def hot_parts(self) -> dict[int, int]:
        """The number of parts of each hot bucket; fewer than HOT_BUCKETS."""
        fair = max(2 * self.n / self.buckets, self.n / HOT_BUCKETS, 1)
        hot = self.tries.where(F.col("tokens") > fair).select("bucket", "tokens")
        return {r["bucket"]: -(-r["tokens"] // int(fair)) for r in hot.collect()}


def train(df: DataFrame, text: str, prior: float = PRIOR) -> Model:
    """Count the word pairs of all texts and write them as tries."""
    size = text_bytes(df, text)
    buckets = max(1, -(-size // BUCKET_BYTES))
    weight = prior / max(1.0, size / TOKEN_BYTES)
    pairs = df.select(text).mapInArrow(_pack_pairs(buckets), PAIRS)
    tries = pairs.groupBy("bucket").applyInArrow(_build(weight), LEVELS)
    return Model(materialise(tries, "tries"), buckets, weight)


QUERIES = PAIRS + ", part int, load string, texts binary, keys binary, keyless binary, lengths binary"
# Columns of the row that describes a load's texts.
HEAD = ["keys", "keyless", "lengths"]


class _Asked:
    """A load of texts to be scored."""

    def __init__(self) -> None:
        self.tokens = Tokens()
        self.keys: list[np.ndarray] = []
        self.keyless: list[np.ndarray] = []

    def rows(self, name: str, buckets: int, parts: dict[int, int]) -> Iterator[pa.RecordBatch]:
        load = self.tokens.sorted()
        keys, keyless = np.concatenate(self.keys), np.concatenate(self.keyless)
        # The order of the rows is part of the name, see substrings.
        seen = mix(keys.view(U64) + np.arange(1, len(keys) + 1, dtype=U64) * U64(END)) ^ load["lengths"].astype(U64)
        fields = arrow_schema(QUERIES)
        name = f"{name}-{int(seen.sum(dtype=U64)):x}"
        head = [pack_planes(keys.view(U64)), np.packbits(keyless).tobytes(), pack_small(load["lengths"])]
        # Passes through a bucket below zero.
        first = {"bucket": -1 - int(seen[0] % U64(buckets)), "part": 0, "load": name, **dict(zip(HEAD, head))}
        yield pa.RecordBatch.from_pylist([first], schema=fields)
        for bucket, packed, texts in _by_bucket(load, buckets):
            part = int(seen[-1] % U64(parts.get(bucket, 1)))
            own = {"bucket": bucket, "part": part, **packed, "load": name, "texts": pack_small(texts)}
            yield pa.RecordBatch.from_pylist([own], schema=fields)


def _pack_queries(buckets: int, parts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, sent, load = TaskContext.get().partitionId(), 0, _Asked()
        for batch in batches:
            keyless = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            keys = batch.column(0).fill_null(0).to_numpy()
            for texts in text_slices(batch.column(1)):
                load.tokens.add(texts)
                load.keys.append(keys[texts.first : texts.last])
                load.keyless.append(keyless[texts.first : texts.last])
                if load.tokens.size >= LOAD_TOKENS:
                    yield from load.rows(f"{partition}-{sent}", buckets, parts)
                    sent, load = sent + 1, _Asked()
        if load.tokens.size:
            yield from load.rows(f"{partition}-{sent}", buckets, parts)

    return run


PARTS = (
    "bucket int, load string, keys binary, keyless binary, lengths binary, "
    "texts binary, known binary, base binary, score binary"
)

_PART_FIELDS = arrow_schema(PARTS)
# The levels of a bucket without training words.
_NO_WORDS = {
    **{k: EliasFano.encode(np.zeros(n)) for k, n in (("words", 0), ("prints", 0), ("totals", 1), ("pointers", 2))},
    "codes": b"\0",
    "codebook": np.zeros(1, np.float32).tobytes(),
}


def _answer(weight: float, mass: float):
    """What one bucket adds to the scores of each load's texts."""

    def run(tries: pa.Table, asked: pa.Table) -> pa.Table:
        if len(asked) and asked["bucket"][0].as_py() < 0:
            rows = asked.select(["bucket", "load", *HEAD]).to_pylist()
            return pa.Table.from_pylist(rows, schema=_PART_FIELDS)
        trie = Trie(tries.to_pylist()[0] if len(tries) else _NO_WORDS)
        out = {name: [] for name in _PART_FIELDS.names}
        for row in asked.to_batches(max_chunksize=1):
            row = row.to_pylist()[0]
            words, pairs, counts = unpack_planes(row["words"]), unpack_small(row["pairs"]), unpack_small(row["counts"])
            texts = unpack_small(row["texts"])
            totals, numerator = trie.look_up(words, pairs, unpack_prints(row["prints"]), weight)
            owner = np.repeat(np.repeat(np.arange(len(words)), pairs), counts)
            score = np.repeat(numerator, counts) - np.log10(totals + weight * mass)[owner]
            used, at = np.unique(texts, return_inverse=True)
            at = at.ravel()
            for name in ("bucket", "load", *HEAD):
                out[name].append(row[name])
            out["texts"].append(pack_planes(used.astype(U64)))
            out["known"].append(pack_small(np.bincount(at, weights=(totals > 0)[owner])))
            out["base"].append(np.bincount(at, weights=np.log10(totals + A)[owner]).tobytes())
            out["score"].append(np.bincount(at, weights=score).tobytes())
        return pa.table(out, schema=_PART_FIELDS)

    return run


SCORES = "row_key long, n_tokens long, n_known long, base_score double, score double"


def _sum_parts(mass: float):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        head = rows.pop(0)
        lengths = unpack_small(head["lengths"]).astype(np.int64)
        keys = unpack_planes(head["keys"]).view(np.int64)
        missing = np.unpackbits(np.frombuffer(head["keyless"], np.uint8), count=len(keys)).astype(bool)
        known, base, score = np.zeros(len(keys), np.int64), np.zeros(len(keys)), np.zeros(len(keys))
        for row in rows:
            at = unpack_planes(row["texts"]).astype(np.int64)
            known[at] += unpack_small(row["known"])
            base[at] += np.frombuffer(row["base"])
            score[at] += np.frombuffer(row["score"])
        return pa.table(
            {
                "row_key": pa.array(keys, mask=missing),
                "n_tokens": lengths,
                "n_known": known,
                "base_score": base - lengths * np.log10(mass),
                "score": score,
            }
        )

    return run


def score(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) for every row of ``df``:
    tokens, tokens the model knows, and the log10 probabilities of the text under
    the add-A unigram and under the model."""
    rows = df.select(F.col(key).cast("long"), F.col(text))
    hot = model.hot_parts()
    asked = rows.mapInArrow(_pack_queries(model.buckets, hot), QUERIES)
    copies = F.lit(1)
    if hot:
        known = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
        copies = F.coalesce(known[F.col("bucket")], copies)
    tries = model.tries.withColumn("part", F.explode(F.sequence(F.lit(0), copies - 1)))
    parts = tries.groupBy("bucket", "part").cogroup(asked.groupBy("bucket", "part")).applyInArrow(
        _answer(model.weight, model.mass), PARTS
    )
    summed = parts.groupBy("load").applyInArrow(_sum_parts(model.mass), SCORES)
    return summed.withColumnRenamed("row_key", key)
