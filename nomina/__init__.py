"""nomina: labelling short, noisy product and service names on Spark."""

from nomina.operators.rules import Rule, RuleSet, shipped_anchors, shipped_rules

__all__ = ["Rule", "RuleSet", "shipped_anchors", "shipped_rules"]
