"""Rules, cascade and plans against small brute-force versions."""

from __future__ import annotations

import hashlib
import json
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from nomina import Rule, RuleSet, fixed, shipped_anchors, shipped_rules
from nomina.fixed_rules import SHIPPED_RULES
from nomina.operators import cascade, matching, mining
from nomina.operators.dataset import dedupe_prefer_labeled
from nomina.plans import labelling
from nomina.scratch import materialise
from nomina.sources.rules import load_rules

# Pins the rule table, which the SQL twins take from the library.
RULE_DIGEST = "9523f6ad3a2d18a4"

TEXTS = [
    "подшипник 6205", "сборник стихов", "сбор за въезд", "билет на концерт", "билет на парковку",
    "сопровождение 1с", "молоко 3,2%", "ремонт ноутбука", "ремонт крыши", "тест", "алматы",
    "питание персонала", "блок питания персонала", "hotel astana room", "standard room отель",
    "гель для душа", "бумага а4 офисная", "неизвестно что", "услуга", "", "тур отдых",
]


def by_hand(rules: RuleSet, text: str) -> list[Rule]:
    return [
        r
        for r in rules.rules
        if all(w in text for w in r.apply_if)
        and not any(w in text for w in r.exclude_if)
        and re.search(r.pattern, text, re.IGNORECASE)
    ]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "clean string")


def test_first_and_all_matches(spark, texts):
    rules = shipped_rules()
    rows = texts.select(
        "clean",
        rules.first_match(F.col("clean")).alias("first"),
        rules.all_matches(F.col("clean")).alias("every"),
    ).collect()
    for row in rows:
        expected = [rules.rules.index(r) for r in by_hand(rules, row.clean)]
        assert row.every == expected
        assert row.first == (expected[0] if expected else None)


def test_rule_set_shape():
    rules = shipped_rules()
    assert len(rules) == 131 and len({r.category for r in rules.rules}) == 111
    assert [r.priority for r in rules.rules] == sorted((r.priority for r in rules.rules), reverse=True)
    assert len(shipped_anchors()) == 4


def test_equal_priorities_keep_their_order(spark, texts):
    rules = RuleSet([Rule("т", "low", 1), Rule("те", "first", 5), Rule("тес", "second", 5)])
    row = texts.where("clean = 'тест'").select(matching.match_rules(F.col("clean"), rules).alias("c"))
    assert row.first().c == "first"


def test_case_is_ignored_for_upper_case_patterns(spark, texts):
    rules = RuleSet([Rule("(?i)ПОДШИПНИК\\s\\d+", "x")])
    assert texts.where(rules.first_match(F.col("clean")).isNotNull()).count() == 1
    assert texts.where(RuleSet([]).first_match(F.col("clean")).isNotNull()).count() == 0


def test_explain_and_best_match(spark, texts):
    # A rule applies only when all its apply_if words occur.
    found = {
        r.clean: r.match
        for r in matching.match_rules_explain(
            texts.unionByName(spark.createDataFrame([("поставка услуг",)], "clean string")),
            "clean",
            shipped_rules(),
        ).collect()
    }
    assert found["питание персонала"] is None
    match = found["поставка услуг"]
    assert match.category == "Услуги → Прочие услуги" and match.priority == 40
    assert match.apply_if == ["услуг"] and match.exclude_if == []
    best = matching.best_rule_match(texts, "clean", shipped_rules()).where("clean = 'молоко 3,2%'")
    assert best.first().triggered_rule_category == "Продукты → Молочная продукция"


def test_load_rules(spark, tmp_path):
    entries = [
        {"pattern": "a", "category": "A", "priority": 1},
        {"pattern": "b", "category": "B", "priority": 9, "apply_if": ["x"], "exclude_if": ["y"]},
        {"c": "C"},
        "not a rule",
        {"pattern": "(", "category": "broken"},
    ]
    path = tmp_path / "rules.yaml"
    path.write_text(json.dumps(entries), encoding="utf-8")
    with pytest.warns(UserWarning, match="left out") as caught:
        rules = load_rules(path)
    assert sum("left out" in str(w.message) for w in caught) == 2
    assert [(r.pattern, r.category, r.priority) for r in rules.rules] == [
        ("b", "B", 9), ("a", "A", 1), ("c", "C", 0),
    ]
    assert rules.rules[0].apply_if == ["x"] and rules.rules[0].exclude_if == ["y"]

    path.write_text("", encoding="utf-8")
    assert len(load_rules(path)) == 0
    for bad, error in (({"pattern": "a"}, KeyError), ({"a": "A", "b": "B"}, ValueError)):
        path.write_text(json.dumps([bad]), encoding="utf-8")
        with pytest.raises(error):
            load_rules(path)
    with pytest.raises(AnalysisException):
        load_rules(tmp_path / "none.yaml")


def test_patterns_only_python_knows_are_left_out(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps([{"pattern": r"(?P<a>bolt)\Z", "category": "A"}, {"b": "B"}]), encoding="utf-8")
    with pytest.warns(UserWarning, match="pattern left out"):
        rules = load_rules(path)
    assert [r.pattern for r in rules.rules] == ["b"]


def test_shipped_rules_are_the_published_ones():
    text = "\n".join(repr(entry) for entry in SHIPPED_RULES)
    assert len(SHIPPED_RULES) == 131
    assert hashlib.sha256(text.encode()).hexdigest()[:16] == RULE_DIGEST


def expected_label(clean: str) -> tuple[str, str | None, str | None]:
    if not clean:
        return fixed.EMPTY_LABEL, None, None
    for rules, reason in ((shipped_anchors(), "anchor_match"), (shipped_rules(), "rule_match")):
        hits = by_hand(rules, clean)
        if hits:
            return hits[0].category, reason, hits[0].category
    return fixed.FALLBACK_LABEL, "fallback_other", None


def check_rows(rows):
    for row in rows:
        assert (row.label, row.reason, row.rule) == expected_label(row.clean)


def test_cascade_on_rows(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, "  ", None, "тест"])], "i int, t string")
    rows = cascade.label_rows(df, "t", shipped_rules(), shipped_anchors())
    collected = rows.collect()
    assert sorted(r.i for r in collected) == list(range(len(TEXTS) + 3))
    check_rows(collected)
    assert cascade.with_prediction(rows, "t").columns == ["input", "clean", "label", "explanation"]


def test_cascade_without_broadcast_and_with_hot_text(spark, force_shuffle):
    many = ["болт м10"] * 300 + [f"гайка {i}" for i in range(100)] + ["★"] * 200
    df = spark.createDataFrame([(i, t) for i, t in enumerate(many)], "i int, t string")
    rows = cascade.label_rows(df, "t", shipped_rules(), shipped_anchors()).collect()
    assert sorted(r.i for r in rows) == list(range(600))
    check_rows(rows)


def test_empty_policy_on_raw(spark):
    df = spark.createDataFrame([("★★★",), ("  ",), (None,)], "t string")
    by_raw = cascade.label_distinct(df, "t", shipped_rules(), shipped_anchors(), empty_on="raw")
    found = {r.t: r.label for r in by_raw.collect()}
    assert found == {"★★★": "МУСОР → Пустые", "  ": fixed.EMPTY_LABEL, "": fixed.EMPTY_LABEL}


def fake_model(label):
    return lambda cleans: cleans.withColumn("ml_label", F.lit(label))


def test_model_tier_fills_only_open_rows(spark, texts):
    labelled = cascade.label_clean_texts(texts, shipped_rules(), shipped_anchors(), fake_model("ML"))
    for row in labelled.collect():
        without = expected_label(row.clean)
        if row.clean and without[1] == "fallback_other":
            assert (row.label, row.reason, row.rule) == ("ML", "ml_model", None)
        elif row.clean:
            assert (row.label, row.reason, row.rule) == without


def test_backfill(spark):
    fallback = fixed.FALLBACK_LABEL
    v1 = spark.createDataFrame(
        [("болт", "A", "rules"), ("нечто", fallback, "rules"), ("★", fallback, "rules"), ("x", None, "rules")],
        "text string, category string, source string",
    )
    v2 = {r.text: (r.category, r.source) for r in labelling.backfill_with_ml(v1, fake_model("ML")).collect()}
    assert v2 == {
        "болт": ("A", "rules"), "нечто": ("ML", "ml"), "★": (fallback, "rules"), "x": (None, "rules"),
    }
    with pytest.raises(RuntimeError):
        labelling.backfill_with_ml(v1, None)
    settled = v1.where("text in ('болт', '★')")
    assert labelling.backfill_with_ml(settled, None).count() == 2


def test_dedupe(spark):
    rows = [("a", fixed.FALLBACK_LABEL), ("a", "B"), ("b", fixed.FALLBACK_LABEL), ("b", fixed.FALLBACK_LABEL)]
    df = spark.createDataFrame([(*r, "rules") for r in rows], "text string, category string, source string")
    kept = {(r.text, r.category) for r in dedupe_prefer_labeled(df).collect()}
    assert kept == {("a", "B"), ("b", fixed.FALLBACK_LABEL)}


def test_lemma_join_keeps_order_with_and_without_broadcast(spark, force_shuffle):
    df = spark.createDataFrame([(1, "болты и гайки и болты"), (2, ""), (3, "и и и")], "k int, c string")
    words = spark.createDataFrame([("болты", "болт"), ("гайки", "гайка")], "word string, lemma string")
    found = {r.k: r.lemmas for r in mining.lemma_normalize(df, "k", "c", words).collect()}
    assert found == {1: "болт и гайка и болт", 2: "", 3: "и и и"}


def test_rule_audit_finds_shadowed_rules(spark):
    cleans = spark.createDataFrame([("болт м10", 3), ("гайка", 2)], "clean string, n long")
    rules = RuleSet([Rule("болт", "A", 5), Rule("болт|гайка", "B", 1), Rule("винт", "C")])
    audit = {r.category: (r.matches, r.wins) for r in matching.rule_audit(cleans, "clean", rules).collect()}
    assert audit == {"A": (3, 3), "B": (5, 2), "C": (0, 0)}
    stats = matching.rule_hit_stats(
        materialise(cascade.label_clean_texts(cleans, rules, RuleSet([]))), rules
    )
    assert [(r.category, r.hits, r.distinct_texts) for r in stats.collect()] == [("A", 3, 1), ("B", 2, 1)]


@pytest.mark.parametrize("empty_on", ["clean", "raw"])
def test_labels_come_back_by_digest_not_by_text(spark, monkeypatch, empty_on):
    """Raw and cleaned texts are moved where their rows are needed only."""
    written, write = {}, cascade.materialise
    monkeypatch.setattr(cascade, "materialise", lambda df, name: written.setdefault(name, df.columns) and write(df, name))
    texts = ["Болт", "болт ", None, "", "★", "Чай", "Чай", "Болт"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, name string")
    rules = RuleSet([Rule("болт", "крепёж")])
    found = cascade.label_rows(rows, "name", rules, RuleSet([]), empty_on=empty_on)
    assert found.columns == ["name", "id", "clean", "label", "reason", "rule"]
    labels = [r.label for r in found.orderBy("id").collect()]
    star = fixed.EMPTY_LABEL if empty_on == "clean" else fixed.FALLBACK_LABEL
    assert labels[:2] == ["крепёж"] * 2 and labels[7] == "крепёж"
    assert labels[2:4] == [fixed.EMPTY_LABEL] * 2 and labels[4] == star
    assert labels[5:7] == [fixed.FALLBACK_LABEL] * 2
    assert "clean" not in written["labels"] and "name" not in written["memo"]
