"""Tokens and n-grams as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.cleaning import bound, is_ascii

# Characters with a meaning in regular expressions that cleaned text can hold.
_REGEX_SIGNS = r"([.+()])"


def tokenize(clean: Column) -> Column:
    """Words of a cleaned text; the empty text has none."""
    return F.filter(F.split(clean, " "), lambda t: t != "")


def informative_tokens(tokens: Column) -> Column:
    """Tokens longer than two characters that are not just digits."""
    return F.filter(tokens, lambda t: (F.length(t) > 2) & ~t.rlike("^[0-9]+$"))


def _ngrams_of(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    grams = F.transform(
        starts,
        lambda i: F.concat_ws(" ", *[F.get(tokens, i + (k - 1)) for k in range(n)]),
    )
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def word_ngrams(tokens: Column, low: int = 2, high: int = 3) -> Column:
    """All contiguous n-grams with low <= n <= high, words joined by a space."""

    def all_grams(bound: Column) -> Column:
        return F.concat(*[_ngrams_of(bound, n) for n in range(low, high + 1)])

    # As a lambda variable the token array is computed once per row, not once
    # per n-gram.
    return F.get(F.transform(F.array(tokens), all_grams), 0)


def tfidf_words(clean: Column) -> Column:
    """Words of two or more characters, in lower case."""

    def cut(text: Column) -> Column:
        plain, unicode = (F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in (r"\w{2,}", r"(?U)\w{2,}"))
        return F.when(is_ascii(text), plain).otherwise(unicode)

    return bound(F.lower(clean), cut)


def tfidf_terms(clean: Column) -> Column:
    """Uni- and bigrams over words of two or more characters; shorter words are
    dropped before bigrams are formed."""
    return word_ngrams(tfidf_words(clean), 1, 2)


def draft_rule(ngram: Column, escape: bool = False) -> Column:
    """A rule draft for a frequent n-gram, to be finished by hand."""
    words = F.split(ngram, " ")
    parts = words
    if escape:
        parts = F.transform(words, lambda w: F.regexp_replace(w, _REGEX_SIGNS, r"\\$1"))
    return F.struct(
        F.array_join(parts, ".*").alias("pattern"),
        F.lit(fixed.DRAFT_CATEGORY).alias("category"),
        F.lit(fixed.DRAFT_PRIORITY).alias("priority"),
        F.slice(words, 1, 1).alias("apply_if"),
        F.array().cast("array<string>").alias("exclude_if"),
    )
