"""Rules and rule sets.

A rule set is configuration: it is held by the driver, folded into one Column
expression for matching, and available as a table for explanations and reports.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina import fixed
from nomina.fixed_rules import SHIPPED_RULES
from nomina.functions.labels import contains_all, contains_none

RULE_SCHEMA = (
    "rule_id INT, seq INT, pattern STRING, category STRING, priority INT, "
    "apply_if ARRAY<STRING>, exclude_if ARRAY<STRING>"
)


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched anywhere in cleaned text, which is lower case; an
    upper-case letter in the pattern matches the lower-case one."""

    pattern: str
    category: str
    priority: int = 0
    apply_if: list[str] = field(default_factory=list)
    exclude_if: list[str] = field(default_factory=list)

    def matches(self, text: Column) -> Column:
        """Cheap substring tests first, the regular expression last."""
        test = text.rlike(java_pattern(self.pattern))
        if self.exclude_if:
            test = contains_none(text, self.exclude_if) & test
        if self.apply_if:
            test = contains_all(text, self.apply_if) & test
        return test


def java_pattern(pattern: str) -> str:
    """Java flags for a pattern that is searched in cleaned (lower-case) text.

    Ignoring case is costly for Cyrillic, so it is only switched on when the
    pattern itself holds an upper-case letter.
    """
    body = re.sub(r"^\(\?i\)", "", pattern)
    flags = "d"
    if re.search(r"\\[wsdb]", body, re.IGNORECASE):
        flags += "U"
    if any(ch.isupper() for ch in re.sub(r"\\.", "", body)):
        flags += "iu"
    return f"(?{flags}){body}"


class RuleSet:
    """Rules in effective order: priority descending, then given order."""

    def __init__(self, rules: Iterable[Rule]):
        given = list(enumerate(rules))
        self._ranked = sorted(given, key=lambda item: -item[1].priority)

    @property
    def rules(self) -> list[Rule]:
        return [rule for _, rule in self._ranked]

    def __len__(self) -> int:
        return len(self._ranked)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per rule; ``rule_id`` is the rank, ``seq`` the given order."""
        rows = [
            (rank, seq, r.pattern, r.category, r.priority, list(r.apply_if), list(r.exclude_if))
            for rank, (seq, r) in enumerate(self._ranked)
        ]
        return spark.createDataFrame(rows, RULE_SCHEMA)

    def first_match(self, text: Column) -> Column:
        """Rank of the first rule that matches, else null. One pass, with early
        exit: the whole set becomes a single CASE expression."""
        if not self._ranked:
            return F.lit(None).cast("int")
        hit = None
        for rank, rule in enumerate(self.rules):
            branch = F.lit(rank)
            test = rule.matches(text)
            hit = F.when(test, branch) if hit is None else hit.when(test, branch)
        return hit

    def all_matches(self, text: Column) -> Column:
        """Ranks of every matching rule, ascending."""
        if not self._ranked:
            return F.array().cast("array<int>")
        tests = [F.when(r.matches(text), F.lit(rank)) for rank, r in enumerate(self.rules)]
        return F.array_compact(F.array(*tests))

    def pick(self, rank: Column, attribute: str) -> Column:
        """Attribute of the rule with the given rank (null gives null)."""
        if not self._ranked:
            return F.lit(None).cast("string")
        values = F.array(*[F.lit(getattr(r, attribute)) for r in self.rules])
        return F.get(values, rank)


def shipped_rules() -> RuleSet:
    return RuleSet(Rule(*entry) for entry in SHIPPED_RULES)


def shipped_anchors() -> RuleSet:
    """Anchors are rules of equal priority, tried before all others."""
    return RuleSet(Rule(pattern, category) for pattern, category in fixed.ANCHORS)
