"""Corpus mining from raw texts to keyword lists and rule drafts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.operators.mining import (
    item_counts,
    lemma_normalize,
    mining_texts,
    ngram_counts,
    token_counts,
)
from nomina.functions.tokens import tokenize, word_ngrams
from nomina.scratch import materialise


@dataclass
class Mined:
    tokens: DataFrame  # token, cnt
    ngrams: DataFrame  # ngram, cnt


def mine(df: DataFrame, text: str, dictionary: DataFrame | None = None) -> Mined:
    """Token and n-gram counts of a corpus, over dictionary forms if a
    dictionary is given. Counts are weighted by copies, so every distinct text
    is cleaned and unfolded once."""
    texts = mining_texts(df, text)
    if dictionary is None:
        cleaned = materialise(texts.select("clean", "n"), "mined")
        return Mined(token_counts(cleaned, "clean", "n"), ngram_counts(cleaned, "clean", weight="n"))
    single = texts.groupBy("clean").agg(F.sum("n").alias("n"))
    # A short number stands for a text while its words are apart from it.
    cleans = materialise(single.withColumn("_row", F.monotonically_increasing_id()), "mined")
    lemmas = lemma_normalize(cleans, "_row", "clean", dictionary)
    words = materialise(cleans.select("_row", "n").join(lemmas, "_row").select("lemmas", "n"), "lemmas")
    tokens = tokenize(F.col("lemmas"))
    return Mined(
        item_counts(words, tokens, "token", "n"),
        item_counts(words, word_ngrams(tokens), "ngram", "n"),
    )
