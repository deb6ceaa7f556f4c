"""Quality rules judged by host: a host that mostly fails a rule loses its documents.

Every text is measured whole. A document fails a rule by its own measures; of every
host and rule the documents and the failures are counted. A host with few documents
says little by itself, so its failure rate is shrunk towards the rate of all hosts:
the rates of the hosts are taken as draws from a beta distribution, whose two
parameters are estimated from the counts (moments of the beta-binomial, which take
out the spread that counting alone makes), and the shrunk rate is the mean of the
posterior, (failures + alpha) / (documents + alpha + beta). A host with a shrunk rate
above HOST_LIMIT for any rule is rejected, and the verdict is joined back.

Measuring moves no text; what is written and shuffled are a few numbers a document.
Hosts are counted with a combine before the shuffle, so a host with a third of all
documents is a row a task. Only rejected hosts are joined back, broadcast while they
measure small, else by a shuffle join whose skewed partitions are split. Six numbers
a rule come to the driver.

Edge cases: null and empty texts have no words, so they fail ``few_words``; rows
without a host (null) are judged by their own measures only and belong to no host;
repeated rows are documents each; with one host, or hosts that fail alike, the
spread between hosts is zero and every rate is shrunk to the rate of all; where no
document or every document fails a rule, that rate stands; an empty table gives an
empty table. All columns stay; an output replaces a column of the same name. Equal
lines and windows are told by 64-bit hashes within one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina.llm.columns import without
from nomina.llm.substrings import window_hashes
from nomina.llm.words import Texts, Words, concat_ranges, hash_words, split_words, text_slices
from nomina.scratch import attach, materialise

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# The shrunk rate above which a host is rejected, and the least and largest spread
# between hosts, as a correlation of two documents of one host.
HOST_LIMIT = 0.5
LEAST_SPREAD, MOST_SPREAD = 1e-9, 1 - 1e-9

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(SYMBOLS.encode(), np.uint8)] = True


def rules() -> dict[str, Column]:
    """Whether a measured document fails, by rule."""
    n_words = F.col("n_words")
    return {
        "few_words": n_words < 10,
        "repeat_words": 100 * F.col("n_repeat_words") > 20 * n_words,
        "symbols": 10 * F.col("n_symbols") > n_words,
        "dup_lines": 10 * F.col("n_dup_lines") > n_words,
        "long_words": F.col("word_chars") > 20 * n_words,
    }


# The rules that reject a document by itself.
OWN_RULES = ["few_words", "repeat_words"]


def _sums(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marks are set between consecutive bounds."""
    running = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return np.diff(running[bounds])


def _first_seen(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By place: whether (owner, value) was there before, and how often it is there."""
    order = np.lexsort((values, owner))
    a, b = owner[order], values[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
    before, uses = np.zeros(len(order), bool), np.zeros(len(order), np.int64)
    before[order] = ~new
    uses[order] = np.repeat(sizes, sizes)
    return before, uses


def _lines(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and hash of every line with a word, by text, in their order."""
    feeds = np.flatnonzero(texts.data == 0x0A)
    starts = np.union1d(texts.offsets[:-1], feeds + 1)
    starts = starts[starts < len(texts.data)]
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    feeds = np.append(feeds, len(texts.data))
    ends = np.minimum(feeds[np.searchsorted(feeds, starts)], texts.offsets[owner + 1])
    some = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    lines = Words(starts[some], ends[some], words.bounds)
    return owner[some], hash_words(texts.data, lines)


def measure(texts: Texts) -> list[np.ndarray]:
    """The measures of each text of a slice."""
    words, n = split_words(texts), len(texts.offsets) - 1
    lengths = np.diff(words.bounds)
    if not len(texts.data):
        return [np.zeros(n, np.int64) for _ in MEASURES]
    inside = np.zeros(len(texts.data) + 1, np.int8)
    inside[words.starts] += 1
    # Words of neighbouring texts may touch, so ends are taken off on their own.
    np.subtract.at(inside, words.ends, 1)
    in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
    heads = (texts.data & 0xC0) != 0x80
    owner, hashes = _lines(texts, words)
    duplicate, _ = _first_seen(owner, hashes)
    dup_lines = np.bincount(owner[duplicate], minlength=n)

    windows, counts = window_hashes(hash_words(texts.data, words), words.bounds, WINDOW)
    of = np.repeat(np.arange(n), counts)
    _, uses = _first_seen(of, windows)
    starts = concat_ranges(words.bounds[:-1], counts)[uses > 1]
    covered = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.subtract.at(covered, starts + WINDOW, 1)
    covered = np.cumsum(covered)[:-1] > 0
    return [
        lengths,
        _sums(in_word & heads, texts.offsets),
        _sums(_SYMBOL[texts.data], texts.offsets),
        dup_lines,
        _sums(covered, words.bounds),
    ]


def measured(df: DataFrame, text: str) -> DataFrame:
    """Replace the text by its measures; the other columns stay."""
    plain = without(df, MEASURES, [text])
    kept = [c for c in plain.columns if c != text]
    rows = plain.select(*kept, text)
    schema = T.StructType([*rows.drop(text).schema.fields, *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.num_columns - 1
            for texts in text_slices(batch.column(at)):
                part = batch.slice(texts.first, texts.last - texts.first)
                found = [pa.array(m.astype(np.int64)) for m in measure(texts)]
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *found], names=schema.names)

    return rows.mapInArrow(run, schema)


class Prior(NamedTuple):
    """A beta distribution."""

    alpha: float
    beta: float


def beta_prior(hosts: int, documents: float, squares: float, failures: float, ratio: float) -> Prior | None:
    """The beta distribution of failure rates over hosts.

    ``documents`` and ``failures`` are sums over hosts, ``squares`` the sum of squared
    document counts, ``ratio`` the sum of failures**2 / documents. None where all or
    none fail: then there is nothing to shrink.
    """
    rate = failures / documents
    if rate in (0, 1):
        return None
    single = rate * (1 - rate)
    between = ratio - failures**2 / documents - single * (hosts - 1)
    weight = single * (documents - squares / documents - (hosts - 1))
    spread = between / weight if weight > 0 else 0.0
    strength = 1 / min(max(spread, LEAST_SPREAD), MOST_SPREAD) - 1
    return Prior(rate * strength, (1 - rate) * strength)


def host_rates(rows: DataFrame, host: str, failed: dict[str, Column]) -> tuple[DataFrame, dict[str, Prior | None]]:
    """(host, documents, one shrunk failure rate per rule) and the prior per rule."""
    counts = rows.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("documents"), *[F.count_if(c).alias(f"failures_{r}") for r, c in failed.items()]
    )
    counts = materialise(counts, "hosts")
    size = F.col("documents").cast("double")
    wanted = [F.count("*").alias("hosts"), F.sum(size).alias("documents"), F.sum(size * size).alias("squares")]
    for r in failed:
        k = F.col(f"failures_{r}").cast("double")
        wanted += [F.sum(k).alias(f"k_{r}"), F.sum(k * k / size).alias(f"ratio_{r}")]
    sums = counts.agg(*wanted).first()
    priors = {}
    for r in failed:
        some = sums["hosts"]
        priors[r] = beta_prior(
            some, sums["documents"], sums["squares"], sums[f"k_{r}"], sums[f"ratio_{r}"]
        ) if some else None

    def shrunk(rule: str) -> Column:
        k, prior = F.col(f"failures_{rule}"), priors[rule] or Prior(0.0, 0.0)
        return (k + F.lit(prior.alpha)) / (size + F.lit(prior.alpha + prior.beta))

    return counts.select("host", "documents", *[shrunk(r).alias(f"rate_{r}") for r in failed]), priors


def judge(df: DataFrame, text: str, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """Every row without its text, with its measures, ``base_failed`` (its own
    measures reject it), ``host_failed`` (its host is rejected) and ``kept``."""
    outputs = ["base_failed", "host_failed", "kept"]
    plain = without(df, outputs, [text, host])
    # The columns of the input are one struct while columns of our own are about.
    packed = plain.select(
        F.struct(*[F.col(f"`{c}`") for c in plain.columns if c not in (text, *MEASURES)]).alias("row"),
        F.col(f"`{host}`").cast("string").alias("host"),
        F.col(f"`{text}`").alias("text"),
    )
    rows = materialise(measured(packed, "text"), "measured")
    failed = rules()
    rates, _ = host_rates(rows, "host", failed)
    rejected = materialise(
        rates.where(F.greatest(*[F.col(f"rate_{r}") for r in failed], F.lit(0.0)) > limit).select(
            "host", F.lit(True).alias("host_failed")
        ),
        "rejected",
    )
    joined = attach(rows, rejected, ["host"], "left")
    base = failed[OWN_RULES[0]]
    for r in OWN_RULES[1:]:
        base = base | failed[r]
    host_failed = F.coalesce("host_failed", F.lit(False))
    return joined.select(
        "row.*", *MEASURES, base.alias("base_failed"), host_failed.alias("host_failed"), (~base & ~host_failed).alias("kept")
    )
