"""TF-IDF over uni- and bigrams, in long form and as sparse vectors.

weight = (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), then unit length per row.
Spark's own IDF has neither the "+ 1" nor the sublinear tf, hence this module.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina import fixed
from nomina.functions.tokens import tfidf_terms
from nomina.operators.sampling import global_index
from nomina.operators.terms import known_frequencies, load_counts, unit_weights
from nomina.scratch import attach_by_weight, fits_broadcast, materialise, scratch_path


def term_frequencies(df: DataFrame, key: str, clean: str) -> DataFrame:
    """(key, term, tf). ``key`` identifies a row.

    The short texts are spread by key before they are unfolded into terms, so
    the counts here and the row norms later need no further shuffle.
    """
    spread = df.select(key, clean).repartition(key)
    terms = spread.select(key, F.explode(tfidf_terms(F.col(clean))).alias("term"))
    return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))


def document_frequency(df: DataFrame, clean: str) -> DataFrame:
    """(term, df, total): rows with the term and its occurrences.

    Terms are counted where the texts lie, load by load; only counts are shuffled.
    """
    # Most terms are in one load: counting them again before they move gains nothing.
    counts = load_counts(df, clean).repartition("term")
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


@dataclass
class Vocabulary:
    """Terms with their column number and inverse document frequency."""

    table: DataFrame  # term, idx, df, idf
    size: int


def tfidf_vocabulary(
    df: DataFrame,
    clean: str,
    min_df: int = fixed.TFIDF_MIN_DF,
    max_df: float = fixed.TFIDF_MAX_DF,
    max_features: int = fixed.TFIDF_MAX_FEATURES,
) -> Vocabulary:
    """Terms within the document-frequency bounds, the most frequent
    ``max_features`` of them (equal totals in term order), numbered by term."""
    return vocabulary_of(document_frequency(df, clean), df.count(), min_df, max_df, max_features)


def vocabulary_of(
    frequencies: DataFrame, n: int, min_df: int, max_df: float, max_features: int
) -> Vocabulary:
    """The vocabulary of ``n`` texts from their (term, df, total)."""
    bounded = frequencies.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n))
    # The sort reads its input twice, and most terms are in too few texts.
    ranked = global_index(materialise(bounded, "bounded"), [F.desc("total"), F.asc("term")], "_rank")
    bounded = ranked.where(F.col("_rank") < max_features).drop("_rank")
    # At most max_features rows are left, few enough for one window.
    indexed = bounded.select(
        "term",
        (F.row_number().over(Window.orderBy("term")) - 1).alias("idx"),
        "df",
        (F.log(F.lit(1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf"),
    )
    table = materialise(indexed, "vocabulary")
    return Vocabulary(table, table.count())


def tfidf_weights(df: DataFrame, key: str, clean: str, vocabulary: Vocabulary) -> DataFrame:
    """(key, term, idx, weight), with unit length per row."""
    terms = vocabulary.table.select("term", "idx", "idf", "df")
    if fits_broadcast(terms):
        # Only known terms move, once, as numbers, a row for each text.
        weights = unit_weights(known_frequencies(df, key, clean, terms), key, terms)
        return weights.join(F.broadcast(terms.select("idx", "term")), "idx").select(key, "term", "idx", "weight")
    # The most frequent terms are the hottest keys there are.
    known = attach_by_weight(term_frequencies(df, key, clean), terms, "term", "df")
    raw = known.withColumn("_w", (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "idx", (F.col("_w") / norm).alias("weight"))


def gather_weights(weights: DataFrame, key: str) -> DataFrame:
    """(key, idx, weight), two lists in the order of idx, from a row for each term."""
    pairs = F.array_sort(F.collect_list(F.struct("idx", "weight")))
    gathered = weights.groupBy(key).agg(pairs.alias("_pairs"))
    return gathered.select(key, F.col("_pairs.idx").alias("idx"), F.col("_pairs.weight").alias("weight"))


def weight_lists(df: DataFrame, key: str, clean: str, vocabulary: Vocabulary) -> DataFrame:
    """What ``tfidf_weights`` gives as ``gather_weights`` gives it."""
    terms = vocabulary.table.select("term", "idx", "idf", "df")
    if fits_broadcast(terms):
        # A row's weights come from one task as they are, and need no gathering.
        return unit_weights(known_frequencies(df, key, clean, terms), key, terms, lists=True)
    return gather_weights(tfidf_weights(df, key, clean, vocabulary), key)


def to_sparse_vector(
    df: DataFrame, key: str, weights: DataFrame, size: int, out: str = "features"
) -> DataFrame:
    """Add the weights of each row of ``df`` as a sparse vector; rows without a
    known term get the zero vector."""
    return lists_to_vector(df, key, gather_weights(weights, key), size, out)


def lists_to_vector(
    df: DataFrame, key: str, lists: DataFrame, size: int, out: str = "features"
) -> DataFrame:
    """``to_sparse_vector`` from lists of weights."""
    lists = lists.select(key, F.struct("idx", "weight").alias("_pairs"))
    joined = df.join(lists, key, "left")
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"),  # 0 marks a sparse vector
        F.lit(size).alias("size"),
        F.coalesce(F.col("_pairs.idx"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("_pairs.weight"), F.array().cast("array<double>")).alias("values"),
    )
    # A struct cannot be cast to a vector, but a written one reads as one.
    path = scratch_path(df.sparkSession, "vectors")
    joined.select(*df.columns, vector.alias(out)).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(out, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)
