"""The label cascade: anchor, then rule, then model, then fallback."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.cleaning import cast_text, strip_space
from nomina.operators.rule_index import match_indexed
from nomina.operators.rules import RuleSet
from nomina.operators.texts import clean_distinct, digest
from nomina.scratch import attach, attach_by_weight, materialise

# Takes a table with column ``clean`` (unique texts) and returns (clean, ml_label).
ModelTier = Callable[[DataFrame], DataFrame]

# A text costs a good quarter of a millisecond of regular expressions, so the
# tasks that label texts are kept far smaller than the usual ones.
TEXTS_PER_TASK = 1000


def label_clean_texts(
    cleans: DataFrame,
    rules: RuleSet,
    anchors: RuleSet,
    model: ModelTier | None = None,
    indexed: bool = False,
) -> DataFrame:
    """Add anchor_id, rule_id, label, reason and rule to a table of unique
    cleaned texts (column ``clean``).

    ``rule`` holds the category an anchor or rule gave, as explanation. A
    missing model simply leaves its tier out. ``indexed`` matches the rules by an
    index of their literals, for sets of many hundreds.
    """
    text = F.col("clean")
    ranked = cleans.withColumn("anchor_id", anchors.first_match(text))
    # Rules run only where no anchor matched.
    free = F.col("anchor_id").isNull()
    if indexed:
        table = rules.table(cleans.sparkSession).select("rule_id", F.col("category").alias("_category"))
        ranked = materialise(ranked, "anchored")
        met = match_indexed(ranked.where(free), "clean", rules)
        ranked = met.unionByName(ranked.where(~free).withColumn("rule_id", F.lit(None).cast("int")))
        ranked = attach(ranked, materialise(table, "rules"), ["rule_id"], "left")
        category = F.col("_category")
    else:
        ranked = ranked.withColumn("rule_id", F.when(free, rules.first_match(text)))
        category = rules.pick(F.col("rule_id"), "category")
    if model is not None:
        ranked = materialise(ranked, "ranked")
        open_rows = ranked.where(
            F.col("anchor_id").isNull() & F.col("rule_id").isNull() & (F.trim(text) != "")
        )
        predicted = materialise(model(open_rows.select("clean")), "ml")
        ranked = attach(ranked, predicted, ["clean"], "left")
    else:
        ranked = ranked.withColumn("ml_label", F.lit(None).cast("string"))
    known = F.coalesce(anchors.pick(F.col("anchor_id"), "category"), category)
    return ranked.select(
        *cleans.columns,
        "anchor_id",
        "rule_id",
        F.coalesce(known, F.col("ml_label"), F.lit(fixed.FALLBACK_LABEL)).alias("label"),
        reason(F.col("anchor_id"), F.col("rule_id"), F.col("ml_label")).alias("reason"),
        known.alias("rule"),
    )


def reason(anchor_id: Column, rule_id: Column, ml_label: Column) -> Column:
    return (
        F.when(anchor_id.isNotNull(), "anchor_match")
        .when(rule_id.isNotNull(), "rule_match")
        .when(ml_label.isNotNull(), "ml_model")
        .otherwise("fallback_other")
    )


def apply_empty_policy(df: DataFrame, text: str, empty_on: str = "clean") -> DataFrame:
    """Give empty names their own label and no explanation.

    ``empty_on="clean"`` looks at the cleaned text (batch labelling), ``"raw"``
    at the text as given (a raw text that cleans to nothing then goes through
    the rules like any other).
    """
    looked_at = F.col("clean") if empty_on == "clean" else strip_space(cast_text(F.col(text)))
    empty = looked_at == ""

    def unless_empty(name: str, value: Column | None = None) -> Column:
        return F.when(~empty, F.col(name)).otherwise(value).alias(name)

    changed = {
        "label": unless_empty("label", F.lit(fixed.EMPTY_LABEL)),
        **{name: unless_empty(name) for name in ("anchor_id", "rule_id", "reason", "rule")},
    }
    return df.select(*[changed.get(c, F.col(c)) for c in df.columns])


def label_distinct(
    df: DataFrame,
    text: str,
    rules: RuleSet,
    anchors: RuleSet,
    model: ModelTier | None = None,
    empty_on: str = "clean",
    indexed: bool = False,
) -> DataFrame:
    """Label every distinct text once: (text, n, clean, label, reason, ...).

    Regular expressions are by far the dearest step, so they run once per
    distinct cleaned text; the results are written and joined back.
    """
    labelled = _label_texts(clean_distinct(df, text), rules, anchors, model, indexed)
    return apply_empty_policy(labelled, text, empty_on)


def _label_texts(
    texts: DataFrame, rules: RuleSet, anchors: RuleSet, model: ModelTier | None, indexed: bool = False
) -> DataFrame:
    """Add the labels of the column ``clean``, each clean text labelled once. They come
    back by its digest, so the labels are written and moved without the text."""
    cleans = texts.groupBy("clean").agg(F.count("*").alias("_texts"))
    cleans = cleans.repartition(1 + texts.count() // TEXTS_PER_TASK)
    given = label_clean_texts(cleans, rules, anchors, model, indexed)
    labels = materialise(given.withColumn("clean", digest(F.col("clean"))).withColumnRenamed("clean", "_digest"), "labels")
    keyed = texts.withColumn("_digest", digest(F.col("clean")))
    others = [c for c in texts.columns if c != "clean"]
    met = attach_by_weight(keyed, labels, "_digest", "_texts")
    return met.select("clean", *others, "anchor_id", "rule_id", "label", "reason", "rule")


def label_rows(
    df: DataFrame,
    text: str,
    rules: RuleSet,
    anchors: RuleSet,
    model: ModelTier | None = None,
    empty_on: str = "clean",
) -> DataFrame:
    """Every row of ``df`` with clean, label, reason and rule."""
    texts = clean_distinct(df, text, digest_as="_key")
    labelled = _label_texts(texts, rules, anchors, model)
    memo = materialise(labelled.select("_key", "n", "clean", "label", "reason", "rule"), "memo")
    value = cast_text(F.col(text))
    rows = df.withColumn("_key", digest(value)).withColumn(text, value)
    met = attach_by_weight(rows, memo, "_key", "n")
    others = [c for c in df.columns if c != text]
    return apply_empty_policy(met.select(text, *others, "clean", "label", "reason", "rule"), text, empty_on)


def with_prediction(df: DataFrame, text: str) -> DataFrame:
    """Pack a labelled table into (input, clean, label, explanation)."""
    return df.select(
        F.col(text).alias("input"),
        "clean",
        "label",
        F.struct("reason", "rule").alias("explanation"),
    )
