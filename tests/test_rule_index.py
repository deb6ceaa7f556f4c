"""Large rule sets, label memory, relabelling after an edit, pruned counts, text spreading."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nomina.operators import mining, strings, texts
from nomina.operators.memory import LabelMemory, changed_rules, rematch, rule_key, set_digest
from nomina.operators.rule_index import RuleIndex, is_plain, match_indexed, required_strings, rule_strings
from nomina.operators.rules import Rule, RuleSet, shipped_anchors, shipped_rules
from nomina.scratch import materialise


@pytest.mark.parametrize(
    "pattern,expected",
    [
        ("(?i)сбор(?!ник)", ["сбор"]),
        ("abc.*defgh", ["defgh"]),
        ("abc|de", ["abc", "de"]),
        ("(abc|ab)x+y", ["ab"]),
        ("a?b*[cd]", None),
        ("x(foo|bar)?", ["x"]),
        ("(foo|bar){2,}", ["bar", "foo"]),
        ("^\\s*$", None),
        ("ABC", ["abc"]),
        ("a\\.b", ["a.b"]),
        ("[a[bc]]xyz", None),  # classes within classes are read otherwise by Java
        ("\\p{L}abc", None),
        ("(?:услуг[аи]|работ[аы])$", ["работ", "услуг"]),
    ],
)
def test_required_strings(pattern, expected):
    assert required_strings(pattern) == expected


def test_every_match_holds_a_required_string():
    rng = random.Random(5)
    parts = ["ab", "cd", ".", "(ab|bc)", "(a|bc|cd)", "b?", "(cd)*", "(ab)+", "[abc]", "d{2}", "(?=ab)", "(?!cd)", "a+?"]
    for _ in range(400):
        pattern = "".join(rng.choices(parts, k=rng.randrange(1, 6)))
        need = required_strings(pattern)
        for _ in range(30):
            text = "".join(rng.choices("abcd", k=rng.randrange(9)))
            if need is not None and re.search(pattern, text):
                assert any(s in text for s in need), (pattern, text, need)


def test_the_best_requirement_of_a_rule():
    assert rule_strings(Rule("ab.*cd", "x", 0, ["longer"])) == ["longer"]
    assert rule_strings(Rule("[0-9]+", "x", 0, ["a", "abc"])) == ["abc"]
    assert rule_strings(Rule("[0-9]+", "x")) is None


def small_sets():
    rng = random.Random(9)
    words = ["".join(rng.choices("абвгд", k=rng.randrange(1, 6))) for _ in range(40)]
    rules = []
    for i in range(300):
        a, b, c = rng.choices(words, k=3)
        pattern = rng.choice([a, f"{a}.*{b}", f"({a}|{b}){c}", f"^{a}", f"{a}$", f"{a}?{b}[абв]", "^.{%d}$" % (i % 7 + 2), f"(?i){a.upper()}"])
        rules.append(Rule(pattern, f"c{i}", rng.randrange(4), rng.sample(words, i % 3 == 0), rng.sample(words, i % 5 == 0)))
    rows = [" ".join(rng.choices(words, k=rng.randrange(5))) for _ in range(200)] + ["", "а", None, "а", "\U0001f642 а б"]
    return RuleSet(rules), rows


def test_indexed_matches_equal_the_case_expression(spark):
    rules, rows = small_sets()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "no int, text string, row string").repartition(3)
    found = match_indexed(df, "text", rules)
    assert found.columns == ["no", "text", "row", "rule_id"]
    expected = df.withColumn("rule_id", rules.first_match(F.col("text")))
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)
    assert found.where("rule_id IS NULL").count() < len(rows) / 2
    assert match_indexed(df.limit(0), "text", rules).count() == 0
    assert match_indexed(df, "text", RuleSet([])).where("rule_id IS NOT NULL").count() == 0
    assert match_indexed(df, "text", RuleSet([Rule("^$", "e")])).where("rule_id = 0").count() == rows.count("")


def test_indexed_matches_without_broadcast(spark, force_shuffle):
    rules, rows = small_sets()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "no int, text string")
    found = {r.no: r.rule_id for r in match_indexed(df, "text", rules).collect()}
    assert found == {r.no: r.r for r in df.select("no", rules.first_match(F.col("text")).alias("r")).collect()}


def test_no_text_meets_all_rules(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("text"))
    rules = RuleSet([Rule(f"word{i}x", "c") for i in range(3000)] + [Rule("^7$", "seven")])
    found = match_indexed(df, "text", rules)
    assert found.where("rule_id = 3000").count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert RuleIndex(rules).open == [] and len(RuleIndex(rules).strings) == 3001


def test_memory_labels_unseen_texts_only(spark, tmp_path):
    rules, anchors = shipped_rules(), shipped_anchors()
    memory = LabelMemory(spark, str(tmp_path), rules, anchors)
    one = spark.createDataFrame([("Билет",), ("Билет",), ("Офис",), (None,), ("",)], "name string")
    two = spark.createDataFrame([("Билет",), ("Кабель ВВГ",), ("Офис ",)], "name string")
    first, n = memory.label(one, "name")
    first = {r.name: (r.n, r.label) for r in first.collect()}
    assert n == 3 and first["Билет"][0] == 2 and first[""][0] == 2
    again, n = memory.label(one, "name")
    assert n == 0 and {r.name: (r.n, r.label) for r in again.collect()} == first
    other = LabelMemory(spark, str(tmp_path), rules, anchors)
    found, n = other.label(two, "name", indexed=True)
    assert n == 2 and {r.name for r in found.collect()} == {"Билет", "Кабель ВВГ", "Офис "}
    # What is there twice is read once.
    memory.table().write.mode("append").parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("append").parquet(memory.path)
    again, n = memory.label(one, "name")
    assert n == 0 and again.count() == 3
    changed = LabelMemory(spark, str(tmp_path), RuleSet([*rules.rules, Rule("x", "y")]), anchors)
    assert changed.label(two, "name")[1] == 3
    assert set_digest(rules, anchors) != set_digest(anchors, rules)


def test_relabelling_equals_labelling_after_random_edits(spark):
    rules, rows = small_sets()
    rng = random.Random(3)
    df = materialise(spark.createDataFrame([(t,) for t in sorted({r for r in rows if r})], "text string"))
    for edit in range(10):
        changed = list(rules.rules)
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(changed))
            kind = edit % 4
            if kind == 0:
                del changed[at]
            elif kind == 1:
                changed.insert(at, Rule(rng.choice(["аб", "вг.*д", "^.{3}$"]), "new", rng.randrange(4)))
            elif kind == 2:
                changed[at] = Rule(changed[at].pattern, "other", rng.randrange(5))
            else:
                changed.append(changed.pop(at))
        edited = RuleSet(changed)
        before = df.withColumn("rule_id", rules.first_match(F.col("text")))
        after = {r.text: r for r in rematch(before, "text", rules, edited).collect()}
        expected = {r.text: r.r for r in df.select("text", edited.first_match(F.col("text")).alias("r")).collect()}
        assert {t: r.rule_id for t, r in after.items()} == expected
        assert sum(r.touched for r in after.values()) < len(after) / 2
        rules = edited


def test_changed_rules_keep_their_order():
    old = RuleSet([Rule(p, "c") for p in "abcde"])
    new = RuleSet([Rule(p, "c") for p in "bxdae"])
    kept, changed = changed_rules(old, new)
    ranks = [kept[r] for r in sorted(kept)]
    assert ranks == sorted(ranks) and set(ranks) | set(changed) == set(range(5))
    assert all(rule_key(old.rules[a]) == rule_key(new.rules[b]) for a, b in kept.items())


@pytest.mark.parametrize("buckets", [1, 3, 256, 1 << 15])
def test_pruned_counts_lose_nothing(spark, monkeypatch, buckets):
    """Whatever collides."""
    monkeypatch.setattr(mining, "BUCKETS", buckets)
    rng = random.Random(2)
    rows = [(" ".join(f"w{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(12)), rng.randrange(1, 4)) for _ in range(300)]
    df = materialise(spark.createDataFrame(rows, "clean string, n long"))
    counts = Counter()
    for text, n in rows:
        w = text.split()
        for size in (2, 3):
            for i in range(len(w) - size + 1):
                counts[" ".join(w[i : i + size])] += n
    expected = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    for k in (1, 20, 10_000):
        found = mining.top_ngrams(df, "clean", k, weight="n").collect()
        assert [tuple(r) for r in found] == expected[:k]
    if buckets > 1000:
        grams = mining.word_ngrams(mining.tokenize(F.col("clean")))
        assert mining.pruned_counts(df, grams, "ngram", 20, "n").count() < len(counts) / 5
    assert mining.top_ngrams(df.limit(0), "clean", 5, weight="n").count() == 0


def test_rows_are_spread_by_stored_bytes(spark, tmp_path, monkeypatch):
    rows = spark.range(2000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    stored = spark.read.parquet(str(tmp_path / "one"))
    assert texts.spread(stored).rdd.getNumPartitions() == 1
    monkeypatch.setattr(texts, "TASK_BYTES", 10_000)
    dealt = texts.spread(stored)
    assert 3 < dealt.rdd.getNumPartitions() < 20 and dealt.count() == 2000
    monkeypatch.setattr(texts, "MOST_TASKS", 2)
    assert texts.spread(stored).rdd.getNumPartitions() == 2
    monkeypatch.setattr(texts, "MOST_TASKS", 1)
    assert texts.spread(stored) is stored


def test_cleaning_each_text_once(spark):
    df = spark.createDataFrame([(1, "Болт М10"), (2, "Болт М10"), (3, None), (4, "")], "k int, name string")
    found = {r.k: (r.name, r.clean) for r in texts.clean_by_text(df, "name").collect()}
    assert found == {1: ("Болт М10", "болт м10"), 2: ("Болт М10", "болт м10"), 3: (None, ""), 4: ("", "")}


def test_no_candidate_moves_while_the_index_is_small(spark):
    """Strings are looked for before anything is shuffled."""
    rules = RuleSet([Rule("alpha beta", "a"), Rule("gamma delta", "b"), Rule("alphabet", "c")])
    texts = [(0, "an alpha beta of gamma delta"), (1, "alphabet"), (2, ""), (3, "gamma"), (4, None)]
    table = materialise(spark.createDataFrame(texts, "k int, t string"))
    held = RuleIndex(rules).held(table, "k", "t")
    assert "Exchange hashpartitioning" not in held._jdf.queryExecution().executedPlan().toString()
    assert {(r["k"], r["rule_id"]) for r in held.collect()} == {(0, 0), (0, 1), (1, 2)}
    found = {r["k"]: r["rule_id"] for r in match_indexed(table, "t", rules).collect()}
    assert found == {0: 0, 1: 2, 2: None, 3: None, 4: None}


def test_top_ngrams_make_no_row_for_each_ngram(spark, monkeypatch):
    """Buckets are counted in Arrow tasks; weights, nulls, empty words and loads count alike."""
    monkeypatch.setattr("nomina.operators.terms.LOAD_WORDS", 3)
    texts = [("a b  a b", 2), (None, 5), ("", 1), ("a b c", None), ("ж a b", 3), ("c", 9), ("b a b c d", 1)]
    df = materialise(spark.createDataFrame(texts, "clean string, n long"))
    grams = mining.word_ngrams(mining.tokenize(F.col("clean")), 1, 3)
    counts = mining.item_counts(df, grams, "ngram", "n").where("cnt IS NOT NULL").collect()
    expected = sorted(((r.ngram, r.cnt) for r in counts), key=lambda x: (-x[1], x[0]))
    for k in (1, 4, 100):
        top = mining.top_ngrams(df, "clean", k, 1, 3, "n")
        assert "Generate" not in top._jdf.queryExecution().optimizedPlan().toString()
        assert [tuple(r) for r in top.where("cnt > 0").collect()] == expected[:k]


def test_strings_are_found_where_they_are(monkeypatch):
    """Whatever the steps, the lengths, nulls and slices; never across two texts."""
    rng = random.Random(1)
    for _ in range(200):
        monkeypatch.setattr(strings, "PLACES", rng.choice([3, 50, 1 << 18]))
        monkeypatch.setattr(strings, "PAIRS", rng.choice([1, 7, 1 << 20]))
        letters = rng.choice(["ab", "абв a", "a\U0001f642бc"])
        wanted = sorted({"".join(rng.choices(letters, k=rng.randrange(1, 22))) for _ in range(rng.randrange(30))})
        rows = [None if rng.random() < 0.1 else "".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(20)]
        rows = [r + rng.choice(wanted) if r and wanted and rng.random() < 0.5 else r for r in rows]
        found = strings.Strings(wanted).found(pa.array(rows, pa.string())[2:])
        expected = [(i, j) for i, r in enumerate(rows[2:]) for j, s in enumerate(wanted) if r is not None and s in r]
        assert list(zip(*(f.tolist() for f in found))) == expected


@pytest.mark.parametrize(
    "rule,expected",
    [
        (Rule("alpha\\ beta", "x"), True),
        (Rule("(?i)a\\.b", "x"), True),
        (Rule("a.b", "x"), False),
        (Rule("ABC", "x"), False),
        (Rule("abc$", "x"), False),
        (Rule("a\\d", "x"), False),
        (Rule("abc", "x", 0, ["abc"]), False),
        (Rule("abc", "x", 0, [], ["d"]), False),
        (Rule("ab|c", "x"), False),
    ],
)
def test_rules_that_are_plain_strings(rule, expected):
    assert is_plain(rule, rule_strings(rule)) == expected


def test_few_strings_are_found_without_ngrams(spark, monkeypatch):
    """No text is unfolded, and of the rules it may match only those up to the first
    plain one go on, without the text if there is no other."""
    monkeypatch.setattr("nomina.operators.rule_index.LOAD_BYTES", 20)
    monkeypatch.setattr("nomina.operators.rule_index._grams", None)
    rules = RuleSet([Rule("be.a", "r"), Rule("alpha beta", "a"), Rule("gamma", "g"), Rule("gamma d", "d"), Rule("beta", "b", 0, [], ["x"])])
    rows = [(0, "an alpha beta of gamma d"), (1, "gamma delta"), (2, "bea"), (3, "alpha beta"), (4, "beta x"), (5, None), (6, ""), (7, "be")]
    table = materialise(spark.createDataFrame(rows, "k int, t string"))
    index = RuleIndex(rules)
    assert index.few() and index.plain == [1, 2, 3]
    met = {r["k"]: (r["t"] is not None, r["plain"], r["rule_ids"]) for r in index._found(table, "k", "t", False).collect()}
    assert met == {0: (True, 1, [0, 1]), 1: (False, 2, [2]), 2: (True, None, [0]), 3: (True, 1, [0, 1]), 4: (True, None, [0, 4]), 7: (True, None, [0])}
    found = {r["k"]: r["rule_id"] for r in match_indexed(table, "t", rules).collect()}
    assert found == {0: 0, 1: 2, 2: None, 3: 0, 4: 0, 5: None, 6: None, 7: None}
