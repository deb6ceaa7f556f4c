"""Rule matching: anchors, first match, best match, hit statistics, audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.operators.rules import RuleSet
from nomina.scratch import materialise


def match_anchors(text: Column, anchors: RuleSet) -> Column:
    """Category of the first matching anchor, else null."""
    return anchors.pick(anchors.first_match(text), "category")


def is_anchor_example(text: Column, anchors: RuleSet) -> Column:
    return anchors.first_match(text).isNotNull()


def match_rules(text: Column, rules: RuleSet) -> Column:
    """Category of the first matching rule, else null."""
    return rules.pick(rules.first_match(text), "category")


def match_rules_explain(df: DataFrame, text: str, rules: RuleSet) -> DataFrame:
    """Add the first matching rule with all its fields as struct ``match``."""
    table = rules.table(df.sparkSession).select(
        F.col("rule_id").alias("_rule_id"),
        F.struct("category", "pattern", "priority", "apply_if", "exclude_if").alias("match"),
    )
    ranked = df.withColumn("_rule_id", rules.first_match(F.col(text)))
    # One row per configured rule: the table is driver-side and tiny.
    return ranked.join(F.broadcast(table), "_rule_id", "left").drop("_rule_id")


def all_rule_matches(df: DataFrame, text: str, rules: RuleSet) -> DataFrame:
    """One row per (row, matching rule); anchors play no part."""
    ranks = rules.all_matches(F.col(text))
    return df.withColumn("rule_id", F.explode(ranks))


def best_rule_match(df: DataFrame, text: str, rules: RuleSet) -> DataFrame:
    """Add pattern and category of the strongest matching rule, ignoring
    anchors. The order of the rule set makes the first match the strongest."""
    ranked = df.withColumn("_rank", rules.first_match(F.col(text)))
    return ranked.select(
        *df.columns,
        rules.pick(F.col("_rank"), "pattern").alias("triggered_pattern"),
        rules.pick(F.col("_rank"), "category").alias("triggered_rule_category"),
    )


def rule_hit_stats(labelled: DataFrame, rules: RuleSet, rows: str = "n") -> DataFrame:
    """Hits per winning rule from a label table with one row per clean text.

    ``rows`` names the column with the number of rows per clean text.
    """
    hits = (
        labelled.where(F.col("rule_id").isNotNull())
        .groupBy("rule_id")
        .agg(F.sum(rows).alias("hits"), F.count("*").alias("distinct_texts"))
    )
    table = rules.table(labelled.sparkSession).select("rule_id", "pattern", "category")
    return hits.join(F.broadcast(table), "rule_id").orderBy(F.desc("hits"), "rule_id")


def _each(rules: RuleSet, text: str, of: Callable[[Column], Column]) -> Column:
    """``of`` the ranks of the rules that match a text, strongest first. As a lambda
    variable the ranks are found once per row."""
    return F.get(F.transform(F.array(rules.all_matches(F.col(text))), of), 0)


def rule_cover(cleans: DataFrame, text: str, rules: RuleSet, rows: str = "n") -> DataFrame:
    """Which stronger rules take the texts of each rule: (rule_id, cover_id, rows, texts,
    share), ``share`` of the rows the rule matches. A rule is its own cover where it
    wins; one that never wins is explained by its other covers.

    ``text`` is distinct. A pair is counted per match, not per pair of matching rules,
    and combined before the shuffle: there are at most as many as pairs of rules.
    """

    def covered(ranks: Column) -> Column:
        return F.transform(ranks, lambda r: F.struct(r.alias("rule_id"), F.get(ranks, F.lit(0)).alias("cover_id")))

    pairs = cleans.select(F.col(rows).alias("_rows"), F.explode(_each(rules, text, covered)).alias("_p"))
    pairs = pairs.select("_rows", "_p.*")
    counted = pairs.groupBy("rule_id", "cover_id").agg(F.sum("_rows").alias("rows"), F.count("*").alias("texts"))
    matched = F.sum("rows").over(Window.partitionBy("rule_id"))
    return counted.select("rule_id", "cover_id", "rows", "texts", (F.col("rows") / matched).alias("share"))


def rule_overlap(cleans: DataFrame, text: str, rules: RuleSet) -> DataFrame:
    """Pairs of rules that match texts in common: (rule_a, rule_b, common, only_a,
    only_b), in distinct texts, ``rule_a`` the stronger. ``only_b`` = 0 says that
    ``rule_b`` cannot win while ``rule_a`` stands before it.

    Pairs come from the few rules that match one text and are combined before the
    shuffle; a rule paired with itself gives the size of the rule.
    """

    def paired(ranks: Column) -> Column:
        def with_later(a: Column) -> Column:
            return F.transform(
                F.filter(ranks, lambda b: b >= a), lambda b: F.struct(a.alias("rule_a"), b.alias("rule_b"))
            )

        return F.flatten(F.transform(ranks, with_later))

    pairs = cleans.select(F.explode(_each(rules, text, paired)).alias("_p")).select("_p.*")
    counted = materialise(pairs.groupBy("rule_a", "rule_b").agg(F.count("*").alias("common")), "pairs")
    # At most a row per rule and per pair of rules.
    sizes = counted.where("rule_a = rule_b")
    found = counted.where("rule_a < rule_b")
    for side in ("a", "b"):
        size = sizes.select(f"rule_{side}", F.col("common").alias(f"_{side}"))
        found = found.join(size, f"rule_{side}")
    only = [(F.col(f"_{side}") - F.col("common")).alias(f"only_{side}") for side in ("a", "b")]
    return found.select("rule_a", "rule_b", "common", *only)


def rule_audit(cleans: DataFrame, text: str, rules: RuleSet, rows: str = "n") -> DataFrame:
    """Matches and wins of every rule, also of those that never match.

    A rule with matches but no wins is shadowed by stronger ones.
    """
    ranks = rules.all_matches(F.col(text))
    seen = (
        cleans.select(F.col(rows).alias("_rows"), ranks.alias("_ranks"))
        .select("_rows", F.posexplode("_ranks").alias("_at", "rule_id"))
        .groupBy("rule_id")
        .agg(
            F.sum("_rows").alias("matches"),
            F.sum(F.when(F.col("_at") == 0, F.col("_rows")).otherwise(0)).alias("wins"),
        )
    )
    table = rules.table(cleans.sparkSession).select("rule_id", "pattern", "category")
    return table.join(seen, "rule_id", "left").select(
        "rule_id",
        "pattern",
        "category",
        F.coalesce("matches", F.lit(0)).alias("matches"),
        F.coalesce("wins", F.lit(0)).alias("wins"),
    )
