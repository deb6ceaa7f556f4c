"""The text model: TF-IDF features and one linear SVM per class (see ``svm``)."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from nomina import fixed, scratch
from nomina.functions.labels import has_text
from nomina.operators.reports import class_weights
from nomina.operators.sampling import label_index
from nomina.operators.svm import train_linear_svms
from nomina.operators.tfidf import (
    Vocabulary,
    lists_to_vector,
    tfidf_vocabulary,
    tfidf_weights,
    weight_lists,
)
from nomina.scratch import attach, attach_by_weight, materialise

# Products of weights and coefficients held at a time by a task.
BLOCK_PRODUCTS = 4_000_000
CLASS_COLUMNS = ["label_id", "category", "intercept", "coefficients"]


@dataclass
class TextModel:
    """Vocabulary and one linear function per class.

    ``classes`` has a row per class: label_id, category, intercept and
    coefficients (one per vocabulary term).
    """

    vocabulary: Vocabulary
    classes: DataFrame

    def predict(
        self, df: DataFrame, clean: str, out: str = "ml_label", by_join: bool | None = None
    ) -> DataFrame:
        """Add the category with the highest score.

        The coefficients are sent to every task if they measure small, else they
        are joined; ``by_join`` decides it otherwise.

        Rows without a known term are decided by the intercepts. Rows are known by
        a short number while their terms are apart from them.
        """
        numbered = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        if by_join is None:
            by_join = 8 * self.vocabulary.size * self.classes.count() > scratch.BROADCAST_BYTES
        weigh, best = (tfidf_weights, self._by_join) if by_join else (weight_lists, self._by_broadcast)
        best = best(numbered, weigh(numbered, "_row", clean, self.vocabulary))
        names = self.classes.select("label_id", F.col("category").alias(out))
        return attach(best, names, ["label_id"]).select(*df.columns, out)

    def _by_broadcast(self, numbered: DataFrame, lists: DataFrame) -> DataFrame:
        """Add label_id, with all coefficients in every task: they were measured."""
        lists = lists.select("_row", F.struct("idx", "weight").alias("_pairs"))
        gathered = numbered.join(lists, "_row", "left")
        idx = F.coalesce(F.col("_pairs.idx"), F.array().cast("array<int>"))
        weight = F.coalesce(F.col("_pairs.weight"), F.array().cast("array<double>"))
        return gathered.select(*numbered.columns, self._best_class()(idx, weight).alias("label_id"))

    def _by_join(self, numbered: DataFrame, weights: DataFrame) -> DataFrame:
        """Add label_id, with the coefficients of a term joined to its weights."""
        long = self.classes.select("label_id", F.posexplode("coefficients").alias("idx", "coef"))
        columns = long.groupBy("idx").agg(F.collect_list(F.struct("label_id", "coef")).alias("_terms"))
        uses = self.vocabulary.table.select("idx", "df")
        by_term = materialise(columns.join(uses, "idx"), "coefficients")
        met = attach_by_weight(weights.select("_row", "idx", "weight"), by_term, "idx", "df")
        parts = met.select("_row", "weight", F.explode("_terms").alias("_t"))
        sums = parts.groupBy("_row", F.col("_t.label_id").alias("label_id")).agg(
            F.sum(F.col("weight") * F.col("_t.coef")).alias("_sum")
        )
        scored = attach(sums, self.classes.select("label_id", "intercept"), ["label_id"])
        order = F.struct((F.col("_sum") + F.col("intercept")).alias("score"), (-F.col("label_id")).alias("label"))
        best = scored.groupBy("_row").agg(F.max(order).alias("_best"))
        first = F.struct(F.col("intercept").alias("score"), (-F.col("label_id")).alias("label"))
        default = -self.classes.agg(F.max(first).alias("b")).first()["b"]["label"]
        label = F.coalesce(-F.col("_best.label"), F.lit(default)).alias("label_id")
        return numbered.join(best, "_row", "left").select(*numbered.columns, label)

    def _best_class(self):
        # One row per class, as long as the vocabulary; their size was measured.
        rows = self.classes.orderBy("label_id").toArrow().combine_chunks()
        flat = rows["coefficients"].combine_chunks().flatten().to_numpy()
        shared = self.classes.sparkSession.sparkContext.broadcast(
            (
                flat.reshape(len(rows), -1).T.copy(),
                rows["intercept"].to_numpy(),
                rows["label_id"].to_numpy(),
            )
        )

        # Products of some terms of a batch at a time; nested, so sent by value.
        def best_class(idx: pd.Series, weight: pd.Series) -> pd.Series:
            coefficients, intercepts, ids = shared.value
            scores = np.tile(intercepts, (len(idx), 1))
            row = np.repeat(np.arange(len(idx)), idx.str.len())
            if len(row):
                terms, weights = np.concatenate(idx.to_numpy()), np.concatenate(weight.to_numpy())
                step = max(1, BLOCK_PRODUCTS // len(ids))
                for at in range(0, len(row), step):
                    part = slice(at, at + step)
                    products = coefficients[terms[part]] * weights[part, None]
                    filled, starts = np.unique(row[part], return_index=True)
                    scores[filled] += np.add.reduceat(products, starts, axis=0)
            return pd.Series(ids[scores.argmax(axis=1)])

        return F.pandas_udf(best_class, LongType())

    def predict_clean(self, cleans: DataFrame) -> DataFrame:
        """Model tier of the cascade: unique texts ``clean`` to (clean, ml_label);
        blank texts get none."""
        return self.predict(cleans.select("clean").where(has_text(F.col("clean"))), "clean")

    def save(self, path: str) -> None:
        self.vocabulary.table.write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")


def load_model(spark: SparkSession, path: str) -> TextModel | None:
    """Load a saved model. A missing or damaged one gives None, which switches
    the model tier off."""
    try:
        table = spark.read.parquet(f"{path}/vocabulary").select("term", "idx", "df", "idf")
        classes = spark.read.parquet(f"{path}/classes").select(*CLASS_COLUMNS)
        return TextModel(Vocabulary(table, table.count()), classes)
    except Exception as problem:  # whatever is wrong with it, the tier is off
        warnings.warn(f"no usable text model at {path}: {problem}", stacklevel=2)
        return None


def train_text_model(
    train: DataFrame,
    clean: str,
    category: str = "category",
    c: float = fixed.SVM_C,
    max_iter: int = fixed.SVM_MAX_ITER,
    tol: float = fixed.SVM_TOL,
    min_df: int = fixed.TFIDF_MIN_DF,
    max_df: float = fixed.TFIDF_MAX_DF,
    max_features: int = fixed.TFIDF_MAX_FEATURES,
) -> TextModel:
    """Fit vocabulary and classifier to rows with a text and a class.

    The balanced class weight applies to the positive side of each class's problem
    only. The solver runs until it converges; a warning tells when ``max_iter`` passes
    ended it.
    """
    rows = train.select(F.monotonically_increasing_id().alias("_row"), F.col(clean), F.col(category))
    train, key = materialise(rows, "rows"), "_row"
    vocabulary = tfidf_vocabulary(train, clean, min_df, max_df, max_features)
    labels = materialise(label_index(train, category), "labels")
    ids = labels.select(F.col(category).alias("category"), "label_id")
    features = lists_to_vector(
        train.select(key, F.col(category).alias("category")),
        key,
        weight_lists(train, key, clean, vocabulary),
        vocabulary.size,
    )
    vectors = materialise(
        attach(features, ids, ["category"]).select("label_id", "features"), "vectors"
    )
    solved = train_linear_svms(
        vectors, class_weights(vectors, "label_id"), vocabulary.size, c, max_iter, tol
    )
    classes = materialise(ids.join(solved, "label_id").select(*CLASS_COLUMNS), "classes")
    return TextModel(vocabulary, classes)
