"""Rule files: YAML (or JSON, which is YAML) lists of rules."""

from __future__ import annotations

import json
import warnings
from pathlib import Path

from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina.operators.rules import Rule, RuleSet, java_pattern

# A rule file is read by people.
MAX_DRAFTS = 10_000

try:
    import yaml
except ImportError:  # JSON rule files still load
    yaml = None


def load_rules(path: str | Path) -> RuleSet:
    """Read a rule file from any path that Spark reads.

    An entry is either a mapping with ``pattern`` and ``category`` (optionally
    ``priority``, ``apply_if``, ``exclude_if``) or a mapping with one
    ``pattern: category`` pair. Entries of another shape and patterns that do
    not compile (as Java patterns, which is how they will run) are left out with a
    warning. A missing file, a pattern without
    a category and a short entry with several pairs are errors.
    """
    spark = SparkSession.active()
    content = "".join(r["value"] for r in spark.read.text(str(path), wholetext=True).collect())
    if yaml is not None:
        entries = yaml.safe_load(content)
    else:
        entries = json.loads(content) if content.strip() else None
    rules = [rule for rule in map(_parse_entry, entries or []) if rule is not None]
    return RuleSet([rule for rule in rules if _compiles(spark, rule)])


def write_rules(spark: SparkSession, entries: list[dict], path: str) -> None:
    """Write rule entries (configuration, held by the driver) as one JSON file."""
    content = json.dumps(entries, ensure_ascii=False)
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_rule_drafts(drafts: DataFrame, path: str) -> None:
    """Write rule drafts, at most MAX_DRAFTS, as a file that ``load_rules`` reads."""
    columns = ["pattern", "category", "priority", "apply_if"]
    rows = drafts.orderBy(F.desc("cnt"), "ngram").select(*columns).limit(MAX_DRAFTS + 1).collect()
    if len(rows) > MAX_DRAFTS:
        raise ValueError(f"more than {MAX_DRAFTS} rule drafts")
    write_rules(drafts.sparkSession, [r.asDict() for r in rows], path)


def _compiles(spark: SparkSession, rule: Rule) -> bool:
    try:
        spark._jvm.java.util.regex.Pattern.compile(java_pattern(rule.pattern))
        return True
    except IllegalArgumentException as problem:
        reason = str(problem).splitlines()[0]
        warnings.warn(f"pattern left out, {reason}: {rule.pattern!r}", stacklevel=3)
        return False


def _parse_entry(entry: object) -> Rule | None:
    if not isinstance(entry, dict):
        warnings.warn(f"rule entry of unknown shape left out: {entry!r}", stacklevel=3)
        return None
    if "pattern" in entry:
        rule = Rule(
            entry["pattern"],
            entry["category"],
            entry.get("priority", 0),
            entry.get("apply_if") or [],
            entry.get("exclude_if") or [],
        )
    elif len(entry) == 1:
        rule = Rule(*next(iter(entry.items())))
    else:
        raise ValueError(f"expected one pattern: category pair, got {entry!r}")
    return rule
