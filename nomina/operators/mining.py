"""Corpus mining: token and n-gram counts, top-k lists, rule drafts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.labels import is_unmatched
from nomina.functions.tokens import draft_rule, tokenize, word_ngrams
from nomina.operators.grams import bucket_counts, grams_of
from nomina.operators.lemmas import lemma_normalize  # noqa: F401
from nomina.operators.texts import clean_distinct
from nomina.scratch import materialise

# Hash buckets of a pruned count.
BUCKETS = 1 << 16


def item_counts(df: DataFrame, items: Column, name: str, weight: str | None = None) -> DataFrame:
    """Occurrences of the items of an array column: (name, cnt).

    ``weight`` names a column with the number of rows each row stands for.
    Counts are combined before the shuffle, so frequent items are no burden.
    """
    rows = F.col(weight) if weight else F.lit(1)
    exploded = df.select(rows.cast("long").alias("_rows"), F.explode(items).alias(name))
    return exploded.groupBy(name).agg(F.sum("_rows").alias("cnt"))


def token_counts(df: DataFrame, clean: str, weight: str | None = None) -> DataFrame:
    return item_counts(df, tokenize(F.col(clean)), "token", weight)


def ngram_counts(
    df: DataFrame, clean: str, low: int = 2, high: int = 3, weight: str | None = None
) -> DataFrame:
    return item_counts(df, word_ngrams(tokenize(F.col(clean)), low, high), "ngram", weight)


def mining_texts(df: DataFrame, text: str) -> DataFrame:
    """Distinct raw texts with their row count ``n``, cleaned twice as mining does."""
    present = df.where(F.col(text).isNotNull())
    return clean_distinct(present, text, passes=2)


def vocabulary_size(tokens: DataFrame, ngrams: DataFrame) -> DataFrame:
    """Number of distinct tokens and of distinct n-grams, as one row."""
    kinds = tokens.select(F.lit(1).alias("t"), F.lit(0).alias("g")).unionAll(
        ngrams.select(F.lit(0).alias("t"), F.lit(1).alias("g"))
    )
    return kinds.agg(
        F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("g"), F.lit(0)).alias("ngrams"),
    )


def top_k(counts: DataFrame, item: str, k: int, min_count: int = 0) -> DataFrame:
    """The k most frequent items, equal counts in item order; the minimum count
    applies after the cut."""
    return counts.orderBy(F.desc("cnt"), item).limit(k).where(F.col("cnt") >= min_count)


def pruned_counts(df: DataFrame, items: Column, name: str, k: int, weight: str | None = None) -> DataFrame:
    """Exact counts of all items that can be among the ``k`` most frequent: (name, cnt).

    Occurrences are first counted per hash bucket; an item counts no more than its
    bucket. The items of the fullest buckets are counted exactly; the k-th of them is a
    lower bound for the k-th of all, so items of buckets below it are never shuffled,
    and those of the other buckets are counted exactly as well. Whatever collides,
    nothing is lost. ``df`` is read three times: pass a written table.
    """
    rows = F.col(weight) if weight else F.lit(1)
    exploded = df.select(rows.cast("long").alias("_rows"), F.explode(items).alias(name))
    keyed = exploded.select("_rows", name, F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int").alias("_bucket"))

    def counted(buckets: DataFrame) -> DataFrame:
        # Buckets are bounded in number, so they may be sent to every task.
        met = keyed.join(F.broadcast(buckets.select("_bucket")), "_bucket", "left_semi")
        return met.groupBy(name).agg(F.sum("_rows").alias("cnt"))

    return _pruned(keyed.groupBy("_bucket").agg(F.sum("_rows").alias("full")), counted, k)


def _pruned(full: DataFrame, counted: Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """The pruning of ``pruned_counts``, given the buckets and how to count those of a table."""
    full = materialise(full, "buckets")
    fullest = materialise(full.orderBy(F.desc("full"), "_bucket").limit(2 * k), "fullest")
    known = materialise(counted(fullest), "known")
    kth = known.orderBy(F.desc("cnt")).limit(k).agg(F.count("*"), F.min("cnt")).first()
    least = kth[1] if kth[0] == k else 0
    rest = full.where(F.col("full") >= least).join(fullest.select("_bucket"), "_bucket", "left_anti")
    return known.unionByName(counted(materialise(rest, "rest")))


def pruned_ngrams(df: DataFrame, clean: str, k: int, low: int, high: int, weight: str | None = None) -> DataFrame:
    """``pruned_counts`` of the n-grams of cleaned texts: (ngram, cnt). They are hashed and
    counted where the texts lie; only counts by bucket and by n-gram move."""
    rows = F.col(weight) if weight else F.lit(1)
    texts = df.select(rows.cast("long").alias("_rows"), F.col(clean).alias("_clean"))

    def counted(buckets: DataFrame) -> DataFrame:
        # At most BUCKETS numbers.
        chosen = [r["_bucket"] for r in buckets.select("_bucket").collect()]
        return grams_of(texts, low, high, BUCKETS, chosen, "ngram")

    return _pruned(bucket_counts(texts, low, high, BUCKETS), counted, k)


def top_ngrams(df: DataFrame, clean: str, k: int, low: int = 2, high: int = 3, weight: str | None = None) -> DataFrame:
    """The k most frequent n-grams of a written table of cleaned texts."""
    return top_k(pruned_ngrams(df, clean, k, low, high, weight), "ngram", k)


def top_keywords(
    counts: DataFrame, k: int = fixed.TOP_WORDS, min_count: int = fixed.MIN_WORD_COUNT
) -> DataFrame:
    return top_k(counts, "token", k, min_count)


def draft_rules(
    counts: DataFrame,
    k: int = fixed.TOP_NGRAMS,
    min_count: int = fixed.MIN_NGRAM_COUNT,
    escape: bool = False,
) -> DataFrame:
    """Rule drafts from the most frequent n-grams."""
    frequent = top_k(counts, "ngram", k, min_count)
    return frequent.select("ngram", "cnt", draft_rule(F.col("ngram"), escape).alias("_r")).select(
        "ngram", "cnt", "_r.*"
    )


def unmatched_token_counts(
    df: DataFrame, text: str, category: str = "category"
) -> DataFrame:
    """Words of the rows no layer could label; the text is cleaned here."""
    rows = df.where(is_unmatched(F.col(category)) & F.col(text).isNotNull())
    return token_counts(clean_distinct(rows, text), "clean", "n")


def top_unmatched(counts: DataFrame, k: int = fixed.TOP_UNMATCHED) -> DataFrame:
    return top_k(counts, "token", k)
