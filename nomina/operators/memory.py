"""Labels kept between runs: only unseen texts are labelled, and only texts that a
change of the rules can touch are labelled again.

The memory is a Parquet table in a shared folder, a folder per rule set, named by a
digest of its anchors and rules. A text goes by 128 bits of hash; the text itself is
not kept. A run joins its distinct texts to the memory by an anti join, labels the
rest and appends it. What a failed run has appended is used by the next one; texts
that two runs append at once are there twice and are read once.
"""

from __future__ import annotations

import hashlib
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina.functions.cleaning import clean
from nomina.operators.cascade import apply_empty_policy, label_clean_texts
from nomina.operators.rule_index import match_indexed
from nomina.operators.rules import Rule, RuleSet
from nomina.operators.texts import TEXTS_PER_TASK, distinct_texts
from nomina.scratch import attach, attach_by_weight, materialise

DIGEST = ["h1", "h2"]
KEPT = "h1 long, h2 long, clean string, anchor_id int, rule_id int, label string, reason string, rule string"


def text_digest(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("text"), text).alias("h2")]


def rule_key(rule: Rule) -> tuple:
    """What makes a rule the same rule in two sets."""
    return rule.pattern, rule.category, rule.priority, tuple(rule.apply_if), tuple(rule.exclude_if)


def set_digest(rules: RuleSet, anchors: RuleSet) -> str:
    content = repr([[rule_key(r) for r in s.rules] for s in (anchors, rules)])
    return hashlib.sha256(content.encode()).hexdigest()[:32]


class LabelMemory:
    """Labels of all texts that were ever labelled with a rule set."""

    def __init__(self, spark: SparkSession, path: str, rules: RuleSet, anchors: RuleSet):
        self.spark, self.rules, self.anchors = spark, rules, anchors
        self.path = f"{path.rstrip('/')}/{set_digest(rules, anchors)}"

    def table(self) -> DataFrame:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return self.spark.createDataFrame([], KEPT)
        return self.spark.read.schema(KEPT).parquet(self.path)

    def label(self, df: DataFrame, text: str, indexed: bool = False) -> tuple[DataFrame, int]:
        """Every distinct text with its label, (text, n, clean, label, reason, ...), and
        how many texts had to be labelled."""
        texts = materialise(distinct_texts(df, text).select(text, "n", *text_digest(F.col(text))), "texts")
        new = texts.join(self.table().select(*DIGEST), DIGEST, "left_anti")
        new = materialise(new.select(text, *DIGEST), "new")
        found = new.count()
        if found:
            dealt = new.repartition(1 + found // TEXTS_PER_TASK)
            cleaned = materialise(dealt.select(*DIGEST, clean(F.col(text)).alias("clean")), "cleaned")
            uses = cleaned.groupBy("clean").agg(F.count("*").alias("_texts"))
            labels = label_clean_texts(
                uses.repartition(1 + found // TEXTS_PER_TASK), self.rules, self.anchors, indexed=indexed
            )
            labelled = attach_by_weight(cleaned, materialise(labels, "labels"), "clean", "_texts")
            labelled.select(*[c.split()[0] for c in KEPT.split(", ")]).write.mode("append").parquet(self.path)
        known = self.table().join(texts.select(*DIGEST), DIGEST, "left_semi").dropDuplicates(DIGEST)
        joined = texts.join(known, DIGEST).drop(*DIGEST)
        return apply_empty_policy(joined, text), found


def changed_rules(old: RuleSet, new: RuleSet) -> tuple[dict[int, int], list[int]]:
    """Old ranks and the new ranks of the rules that stay in order, and the ranks of
    the other rules of the new set: changed, added and moved ones."""
    one, two = ([rule_key(r) for r in s.rules] for s in (old, new))
    kept = {}
    for a, b, size in SequenceMatcher(a=one, b=two, autojunk=False).get_matching_blocks():
        kept |= {a + i: b + i for i in range(size)}
    stay = set(kept.values())
    return kept, [rank for rank in range(len(two)) if rank not in stay]


def rematch(labels: DataFrame, text: str, old: RuleSet, new: RuleSet) -> DataFrame:
    """The winning rules of a table of distinct cleaned texts after a change of rules.

    ``labels`` has the column ``rule_id``, the rank of the winner in ``old`` (null:
    none); the result has the rank in ``new`` and ``touched``, whether a rule was run
    on the text again. A text whose winner stays can only lose it to a changed rule
    that ranks before it, so it meets just those, and only if it holds one of their
    strings; a text whose winner went or changed meets the whole set.
    """
    spark = labels.sparkSession
    kept, changed = changed_rules(old, new)
    moved = spark.createDataFrame(list(kept.items()), "rule_id int, kept int") if kept else None
    rows = labels.withColumn("_row", F.monotonically_increasing_id())
    if moved is None:
        rows = rows.withColumn("kept", F.lit(None).cast("int"))
    else:
        rows = attach(rows, materialise(moved, "kept"), ["rule_id"], "left")
    rows = materialise(rows, "rows")
    lost = F.col("rule_id").isNotNull() & F.col("kept").isNull()
    again = match_indexed(rows.where(lost).select("_row", text), text, new)
    answers = again.select("_row", F.col("rule_id").alias("now"))
    if changed:
        # Only texts that a changed rule ranks before are looked at.
        open_rows = rows.where(~lost & (F.col("kept").isNull() | (F.col("kept") > changed[0])))
        some = RuleSet([Rule(*rule_key(new.rules[r])[:2], 0, list(new.rules[r].apply_if), list(new.rules[r].exclude_if)) for r in changed])
        hits = match_indexed(open_rows.select("_row", "kept", text), text, some).where("rule_id IS NOT NULL")
        ranks = materialise(spark.createDataFrame(list(enumerate(changed)), "rule_id int, rank int"), "ranks")
        hits = attach(hits, ranks, ["rule_id"])
        # ``least`` passes over the null of a text without a winner.
        answers = answers.unionByName(hits.select("_row", F.least("rank", "kept").alias("now")))
    answers = materialise(answers.withColumn("touched", F.lit(True)), "answers")
    joined = attach(rows, answers, ["_row"], "left")
    touched = F.coalesce("touched", F.lit(False))
    return joined.select(
        *[c for c in labels.columns if c != "rule_id"],
        F.when(touched, F.col("now")).otherwise(F.col("kept")).alias("rule_id"),
        touched.alias("touched"),
    )
