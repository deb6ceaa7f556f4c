"""Lemmas of known and unknown words, covers and overlaps of rules."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from nomina.operators import lemmas, matching, mining
from nomina.operators.rules import Rule, RuleSet
from nomina.operators.terms import distinct_words

STEMS = ["стол", "дом", "завод", "мотор", "насос", "кабел", "принтер", "картридж", "провод", "фонар", "замок", "шланг"]
CASES = {"ами": "", "ов": "", "ом": "", "у": "", "": ""}


@pytest.fixture(scope="module")
def dictionary(spark):
    rows = [(stem + case, stem) for stem in STEMS for case in CASES]
    rows += [(f"{s}ная", f"{s}ный") for s in STEMS] + [("люди", "человек")]
    return spark.createDataFrame(rows, "word string, lemma string")


def learnt_by_hand(pairs):
    votes = defaultdict(Counter)
    for word, lemma in pairs:
        same = 0
        while same < min(len(word), len(lemma)) and word[same] == lemma[same]:
            same += 1
        change = (len(word) - same, lemma[same:])
        for k in range(max(1, change[0]), min(lemmas.LONGEST, len(word) - lemmas.LEAST_STEM) + 1):
            votes[word[-k:]][change] += 1
    best = {e: min(v, key=lambda c: (-v[c], c)) for e, v in votes.items()}
    return {e: (*best[e], sum(v.values()), v[best[e]]) for e, v in votes.items()}


def test_endings_equal_those_by_hand(dictionary):
    pairs = [tuple(r) for r in dictionary.collect()]
    found = {r.ending: (r.cut, r.tail, r.words, r.agree) for r in lemmas.learn_endings(dictionary).collect()}
    assert found == learnt_by_hand(pairs)
    # The stem of a word that becomes another word altogether is no ending.
    assert "юди" not in found


def test_held_out_words_are_recovered(spark, dictionary):
    """Forms of stems the dictionary has never seen."""
    endings = lemmas.learn_endings(dictionary)
    unseen = ["станок", "вентилятор", "компрессор", "редуктор"]
    words = spark.createDataFrame([(s + c,) for s in unseen for c in ("ами", "ов", "ом", "ная")], "word string")
    found = {r.word: (r.lemma, r.ending) for r in lemmas.guess_lemmas(words, endings).collect()}
    for stem in unseen:
        for case in ("ами", "ов", "ом"):
            assert found[stem + case][0] == stem
        assert found[stem + "ная"][0] == stem + "ный"


def test_few_words_and_short_words_teach_nothing(spark):
    rare = spark.createDataFrame([("абвгды", "абвгд"), ("жзикы", "жзик"), (None, "а"), ("а", None)], "word string, lemma string")
    endings = lemmas.learn_endings(rare)
    words = spark.createDataFrame([("мнопы",), ("ы",), ("",), ("xy",)], "word string")
    assert {r.lemma for r in lemmas.guess_lemmas(words, endings).collect()} == {None}
    table = lemmas.lemma_table(words, rare, endings).collect()
    assert {(r.word, r.lemma, r.source) for r in table} == {(w, w, "unknown") for w in ("мнопы", "ы", "", "xy")}
    assert lemmas.learn_endings(rare.limit(0)).collect() == []


@pytest.mark.parametrize("shuffled", [False, True])
def test_texts_keep_their_order(spark, dictionary, shuffled, request, monkeypatch):
    if shuffled:
        request.getfixturevalue("force_shuffle")
        monkeypatch.setattr(lemmas, "BLOCK_BYTES", 10)
    texts = [(1, "люди домами редукторами"), (2, ""), (3, None), (4, "столу  столу qwerty столу"), (5, "насосная"), (5, "насосная"), (None, "дом")]
    rows = spark.createDataFrame(texts, "id int, clean string")
    found = {r.id: r.lemmas for r in lemmas.lemmatise(rows, "id", "clean", dictionary).collect()}
    assert found == {1: "человек дом редуктор", 2: "", 3: "", 4: "стол стол qwerty стол", 5: "насосный", None: "дом"}
    assert lemmas.lemmatise(rows, "id", "clean", dictionary).count() == len(texts)
    assert lemmas.lemmatise(rows.limit(0), "id", "clean", dictionary).collect() == []


@pytest.mark.parametrize("block", [5, 1 << 22])
def test_dictionary_forms_move_no_row_for_each_word(spark, monkeypatch, block):
    """Rows of one key, null too, become one: words by position, then by lemma."""
    monkeypatch.setattr(lemmas, "BLOCK_BYTES", block)
    texts = [(1, "бб  аа вв"), (1, "гг"), (2, ""), (2, "аа бб"), (None, "вв"), (None, None), (3, None), (4, " аа"), (5, "дд бб")]
    rows = spark.createDataFrame(texts, "k int, c string")
    forms = spark.createDataFrame([("бб", "я"), ("вв", None), ("аа", "аа"), ("дд", "")], "word string, lemma string")
    done = mining.lemma_normalize(rows, "k", "c", forms)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "ObjectHashAggregate" not in plan
    expected = {1: "гг я аа вв", 2: " аа я", None: " вв", 3: "", 4: "аа", 5: " я"}
    assert sorted(map(repr, done.collect())) == sorted(f"Row(k={k!r}, lemmas={v!r})" for k, v in expected.items())


@pytest.mark.parametrize("load", [1, 1 << 20])
def test_distinct_words_are_told_apart_where_they_lie(spark, monkeypatch, load):
    monkeypatch.setattr("nomina.operators.terms.LOAD_WORDS", load)
    texts = [("аа bb  аа", 0), (None, 1), ("", 0), (" x", 1), ("bb", 1)]
    df = spark.createDataFrame(texts, "c string, b int")
    found = distinct_words(df, "c")
    assert sorted(r.word for r in found.collect()) == ["bb", "x", "аа"]
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, distinct_words(df, "c", "b").collect())) == [(0, "bb"), (0, "аа"), (1, "bb"), (1, "x")]


RULES = RuleSet(
    [Rule("болт", "a", 9), Rule("болт м10", "b", 8), Rule("гайка|болт", "c", 7), Rule("шайба", "d", 6), Rule("никогда", "e")]
)
TEXTS = [("болт м10", 5), ("болт", 3), ("гайка", 2), ("гайка шайба", 1), ("шайба болт", 4), ("", 7), ("чай", 1), (None, 2)]


def matches(text):
    tests = [["болт"], ["болт м10"], ["гайка", "болт"], ["шайба"], ["никогда"]]
    return [i for i, words in enumerate(tests) if text and any(w in text for w in words)]


def test_cover_and_overlap_by_hand(spark):
    rows = spark.createDataFrame(TEXTS, "clean string, n long")
    cover, texts = Counter(), Counter()
    for text, n in TEXTS:
        for rule in matches(text):
            cover[rule, matches(text)[0]] += n
            texts[rule, matches(text)[0]] += 1
    found = matching.rule_cover(rows, "clean", RULES).collect()
    assert {(r.rule_id, r.cover_id): r.rows for r in found} == dict(cover)
    assert {(r.rule_id, r.cover_id): r.texts for r in found} == dict(texts)
    # Rule 1 never wins: all its rows go to rule 0.
    assert [(r.cover_id, r.share) for r in found if r.rule_id == 1] == [(0, 1.0)]
    sets = {i: {t for t, _ in TEXTS if i in matches(t)} for i in range(4)}
    expected = {
        (a, b, len(sets[a] & sets[b]), len(sets[a] - sets[b]), len(sets[b] - sets[a]))
        for a in sets for b in sets if a < b and sets[a] & sets[b]
    }
    overlap = matching.rule_overlap(rows, "clean", RULES)
    assert {tuple(r) for r in overlap.collect()} == expected
    assert matching.rule_overlap(rows.limit(0), "clean", RULES).collect() == []


def test_cover_finds_matches_once_per_text(spark):
    rows = spark.createDataFrame(TEXTS, "clean string, n long")
    plan = matching.rule_cover(rows, "clean", RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("никогда") == 1
    assert matching.rule_cover(rows.where(F.lit(False)), "clean", RULES).collect() == []
