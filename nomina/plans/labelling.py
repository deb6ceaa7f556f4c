"""Pseudo-labels, review samples and model back-fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.cleaning import clean
from nomina.functions.labels import has_text, is_labeled, normalize_label
from nomina.operators.cascade import ModelTier, label_clean_texts, label_distinct
from nomina.operators.matching import best_rule_match
from nomina.operators.rules import RuleSet
from nomina.operators.sampling import sample_n
from nomina.scratch import attach_by_weight, materialise


def pseudo_labels(df: DataFrame, text: str, rules: RuleSet, anchors: RuleSet) -> DataFrame:
    """(text, category, source): every distinct text with its rule label.

    Labels depend on nothing but the text, so one row per distinct text is what
    labelling all rows and dropping duplicates would leave.
    """
    labelled = label_distinct(df, text, rules, anchors)
    return labelled.select(
        F.col(text).alias("text"),
        normalize_label(F.col("label")).alias("category"),
        F.lit("rules").alias("source"),
    )


def qa_sample(
    labels: DataFrame,
    rules: RuleSet,
    anchors: RuleSet,
    n: int = fixed.QA_SAMPLE_ROWS,
    seed: int = fixed.SEED,
) -> DataFrame:
    """A random sample of labelled rows with the strongest rule of each.

    The rule column ignores anchors, so it can differ from the category;
    ``reason`` tells which layer gave the label.
    """
    drawn = sample_n(labels.where(is_labeled(F.col("category"))), n, ["text"], seed)
    cleaned = materialise(drawn, "sample").withColumn("clean_text", clean(F.col("text")))
    triggered = best_rule_match(cleaned, "clean_text", rules)
    tiers = label_clean_texts(triggered.withColumn("clean", F.col("clean_text")), rules, anchors)
    return tiers.select(*triggered.columns, "reason")


def backfill_with_ml(labels: DataFrame, model: ModelTier | None) -> DataFrame:
    """Give fallback rows with some text the model's label and source "ml".

    The model's answer counts even if it is the fallback itself; a row it does
    not answer keeps its label and source. Without rows
    to fill the table stays as it is; with such rows a model is required.
    ``labels`` is read twice: pass a written table.
    """
    open_row = F.col("category").eqNullSafe(F.lit(fixed.FALLBACK_LABEL))
    cleaned = materialise(labels.where(open_row).withColumn("clean", clean(F.col("text"))), "open")
    candidates = cleaned.where(has_text(F.col("clean")))
    if candidates.isEmpty():
        return labels
    if model is None:
        raise RuntimeError("there are rows to fill but no text model")
    cleans = materialise(candidates.groupBy("clean").agg(F.count("*").alias("_texts")), "cleans")
    predicted = model(cleans.select("clean"))
    answers = materialise(cleans.join(predicted, "clean", "left"), "answers")
    answered = F.col("ml_label").isNotNull()
    filled = attach_by_weight(candidates, answers, "clean", "_texts").select(
        *[c for c in labels.columns if c not in ("category", "source")],
        F.coalesce("ml_label", "category").alias("category"),
        F.when(answered, F.lit("ml")).otherwise(F.col("source")).alias("source"),
    )
    untouched = cleaned.where(~has_text(F.col("clean"))).drop("clean")
    return labels.where(~open_row).unionByName(untouched).unionByName(filled)
