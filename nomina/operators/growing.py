"""Document frequencies of a corpus that grows and shrinks by batches of texts.

The counts are kept as runs of written tables, so the vocabulary of old and new texts
is had without reading the old ones. Texts that leave the corpus are counted with a
minus. The row with a null term holds the number of texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina import fixed
from nomina.operators.tfidf import Vocabulary, document_frequency, vocabulary_of
from nomina.sources.runs import Runs


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


class GrowingFrequencies:
    """What ``document_frequency`` gives for all texts added and not removed."""

    def __init__(self, spark: SparkSession, path: str):
        self.runs = Runs(spark, path, "term string, df long, total long", _summed)

    def _change(self, df: DataFrame, clean: str, sign: int, batch: int | None) -> int:
        texts = df.select(F.lit(None).cast("string").alias("term"), F.lit(1).alias("one"))
        size = texts.groupBy("term").agg(F.count("one").alias("df"), F.lit(0).cast("long").alias("total"))
        counts = document_frequency(df, clean).unionByName(size)
        signed = counts.select("term", (F.col("df") * sign).alias("df"), (F.col("total") * sign).alias("total"))
        number = self.runs.latest() + 1 if batch is None else batch
        self.runs.write(signed, number)
        return number

    def add(self, df: DataFrame, clean: str, batch: int | None = None) -> int:
        """Count the texts of a batch and return its number. A caller that does not know
        whether its last batch got there gives the number and repeats it."""
        return self._change(df, clean, 1, batch)

    def remove(self, df: DataFrame, clean: str, batch: int | None = None) -> int:
        """Take out texts that were added before."""
        return self._change(df, clean, -1, batch)

    def texts(self) -> int:
        """The number of texts, also of those without a term."""
        return self.runs.table().where("term IS NULL").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]

    def table(self) -> DataFrame:
        """(term, df, total); terms whose texts are all gone are left out."""
        return self.runs.table().where("term IS NOT NULL AND df > 0")

    def vocabulary(
        self,
        min_df: int = fixed.TFIDF_MIN_DF,
        max_df: float = fixed.TFIDF_MAX_DF,
        max_features: int = fixed.TFIDF_MAX_FEATURES,
    ) -> Vocabulary:
        return vocabulary_of(self.table(), self.texts(), min_df, max_df, max_features)
