"""Text quality by naive Bayes support vectors.

Features are indicators of a text's byte n-grams (case kept, across words), and
of one mark for a word that follows itself, hashed into FEATURES places. Every
indicator is scaled by the logarithm of its smoothed share in good texts over
that in bad ones, the scaled vector has length one, and a linear hinge-loss model
is fitted to it by dual coordinate descent. A logistic curve through the margins
of rows that were kept out of the fit, weighted to the classes' true shares, turns
margins into probabilities.

The fit uses at most ``sample`` labelled rows of each class, the first ones in the
order of a hash of their ids (a documented bound: the model has a fixed size and
more rows hardly change it). The classes' shares are counted over all labels.
Scoring is one pass over whole texts without a shuffle; the model is two vectors
of FEATURES floats, two megabytes whatever the data.

Edge cases: null and empty texts have no features and get the score of the bias
alone; with labels of fewer than two classes every text gets the smoothed share
of label 1; labels other than 0 and 1, null labels and rows without a key are not
learnt from; a key with both labels counts as 0; a key with several texts gives
its last one in text order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina.llm.words import U64, Texts, hash_words, list_column, mix, split_words, text_slices

FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
NGRAMS = (2, 3)
SAMPLE = 3000
# Of the sampled rows, every so many is kept out of the fit to set the curve.
CURVE_SHARE = 4


def indicators(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every distinct feature of each text, by text."""
    data, offsets = texts.data, texts.offsets
    keys = []
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)
    for n in NGRAMS:
        if len(data) < n:
            continue
        gram = np.full(len(data) - n + 1, n, np.uint32)
        for i in range(n):
            gram = (gram << np.uint32(8)) | data[i : i + len(gram)]
        inside = owner[n - 1 :] == owner[: len(gram)]
        place = (gram[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)
        keys.append((owner[: len(gram)][inside].astype(U64) << U64(FEATURE_BITS)) | place)
    words = split_words(texts)
    hashes = hash_words(data, words)
    again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
    text = np.searchsorted(words.bounds, again, "right") - 1
    text = text[again > words.bounds[text]]
    keys.append((text.astype(U64) << U64(FEATURE_BITS)) | U64(0))
    found = np.sort(np.concatenate(keys))
    if len(found):
        found = found[np.concatenate(([True], found[1:] != found[:-1]))]
    return (found >> U64(FEATURE_BITS)).astype(np.int64), (found & U64(FEATURES - 1)).astype(np.int32)


@dataclass
class QualityModel:
    """Weights and squared scales of the features, bias and logistic curve."""

    weights: np.ndarray  # float32, fitted weight times scale
    squares: np.ndarray  # float32, scale * scale
    bias: float
    slope: float
    shift: float

    def margins(self, texts: Texts) -> np.ndarray:
        text, feature = indicators(texts)
        n = len(texts.offsets) - 1
        norm = np.sqrt(np.bincount(text, weights=self.squares[feature], minlength=n))
        total = np.bincount(text, weights=self.weights[feature], minlength=n)
        return total / np.maximum(norm, 1e-12) + self.bias

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -60, 60)))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Logarithm of each feature's smoothed share in good rows over that in bad ones."""
    counts = np.ones((2, FEATURES))
    for features, label in zip(rows, good):
        counts[int(label), features] += 1
    shares = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return (shares[1] - shares[0]).astype(np.float32)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, c: float = 1.0, rounds: int = 200, tol: float = 0.01
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model.

    Goes through the rows in random order and solves for one dual variable at a
    time; stops when no projected gradient of a round exceeds ``tol``.
    """
    weights, bias = np.zeros(FEATURES), 0.0
    dual = np.zeros(len(rows))
    diagonal = np.array([float(v @ v) + 1.0 for v in values])
    random = np.random.default_rng(7)
    for _ in range(rounds):
        worst = 0.0
        for i in random.permutation(len(rows)):
            features, scaled, sign = rows[i], values[i], signs[i]
            gradient = sign * (weights[features] @ scaled + bias) - 1.0
            projected = gradient
            if dual[i] == 0.0:
                projected = min(gradient, 0.0)
            elif dual[i] == c:
                projected = max(gradient, 0.0)
            if projected != 0.0:
                worst = max(worst, abs(projected))
                new = min(max(dual[i] - gradient / diagonal[i], 0.0), c)
                step = (new - dual[i]) * sign
                dual[i] = new
                weights[features] += step * scaled
                bias += step
        if worst < tol:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, good: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of the probability of label 1, with smoothed targets and
    rows weighted so that label 1 has its share of all rows."""
    n1, n0 = max(good.sum(), 1), max((~good).sum(), 1)
    target = np.where(good, (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0))
    weight = np.where(good, share / n1, (1 - share) / n0) * len(good)
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        error, curve = weight * (p - target), weight * p * (1 - p) + 1e-9
        gradient = np.array([error @ margins, error.sum()])
        hessian = np.array([[curve @ margins**2 + 1e-6, curve @ margins], [curve @ margins, curve.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def labelled_sample(docs: DataFrame, key: str, text: str, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(good, text) of at most ``sample`` rows of each class."""
    sure = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    one = sure.groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_good"))
    order = [F.xxhash64("_key"), F.col("_key")]
    chosen = one.where("_good = 1").orderBy(*order).limit(sample)
    chosen = chosen.unionByName(one.where("_good = 0").orderBy(*order).limit(sample))
    # At most 2 * sample ids, so they may be sent to every task.
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    single = rows.groupBy("_key").agg(F.max("_text").alias("text"), F.min("_good").alias("good"))
    return single.orderBy("_key").select("good", "text")


def fit(docs: DataFrame, key: str, text: str, labels: DataFrame, label: str, sample: int = SAMPLE) -> QualityModel:
    """Fit the model to the labels of ``docs``; pass only rows to learn from."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column(1)):
                owner, feature = indicators(texts)
                n = len(texts.offsets) - 1
                lists = list_column(feature, np.bincount(owner, minlength=n))
                good = batch.column(0).slice(texts.first, n).cast(pa.int32())
                yield pa.RecordBatch.from_arrays([good, lists], names=["good", "features"])

    shares = {r[label]: r["n"] for r in labels.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count("*").alias("n")).collect()}
    share = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
    drawn = labelled_sample(docs, key, text, labels, label, sample)
    table = drawn.mapInArrow(features, "good int, features array<int>").toArrow()
    good = table["good"].to_numpy().astype(bool)
    if good.all() or not good.any():
        zero = np.zeros(FEATURES, np.float32)
        return QualityModel(zero, zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    rows = [f.values.to_numpy() for f in table["features"]]
    curve = np.arange(len(rows)) % CURVE_SHARE == 0
    if len(set(good[curve])) < 2 or len(set(good[~curve])) < 2:
        curve = np.zeros(len(rows), bool)  # too few rows to keep any out
    chosen = np.flatnonzero(~curve)
    ratios = log_count_ratios([rows[i] for i in chosen], good[chosen])

    def scaled(features: np.ndarray) -> np.ndarray:
        values = ratios[features].astype(np.float64)
        return values / max(np.sqrt(values @ values), 1e-12)

    values = [scaled(f) for f in rows]
    weights, bias = dual_coordinate_descent(
        [rows[i] for i in chosen], [values[i] for i in chosen], np.where(good[chosen], 1.0, -1.0)
    )
    margins = np.array([weights[f] @ v + bias for f, v in zip(rows, values)])
    held = curve if curve.any() else ~curve
    slope, shift = logistic_curve(margins[held], good[held], share)
    return QualityModel((weights * ratios).astype(np.float32), ratios * ratios, bias, slope, shift)


def quality_score(df: DataFrame, text: str, model: QualityModel) -> Column:
    """The probability of label 1 for the text column of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        parts = [shared.value.probability(shared.value.margins(t)) for t in text_slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(score, T.DoubleType())(F.col(text))
