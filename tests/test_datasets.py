"""Sampling, splits, TF-IDF, the text model and quality measures."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from nomina import fixed
from nomina.operators import reports, sampling, svm, tfidf
from nomina.operators.textmodel import load_model, train_text_model
from nomina.plans import datasets, labelling
from nomina.scratch import materialise


def md5(text: str, seed: int = 42) -> str:
    return hashlib.md5(f"{text}:{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """A class with most rows, a few smaller ones and one of a single row."""
    sizes = {"big": 3000, "mid": 150, "small": 40, "one": 1}
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "text string, category string")


def first_by_hand(rows, quota):
    groups: dict[str, list[str]] = {}
    for text, category in rows:
        groups.setdefault(category, []).append(text)
    kept = set()
    for texts in groups.values():
        kept.update(sorted(texts, key=md5)[: quota(len(texts))])
    return kept


@pytest.mark.parametrize("digits", [1, 4])
def test_cap_and_split_are_exact(spark, skewed, monkeypatch, digits, force_shuffle):
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", digits)
    rows = [tuple(r) for r in skewed.collect()]
    for cap in (0, 1, 40, 100, 5000):
        kept = {r.text for r in sampling.cap_per_class(skewed, cap, ["text"]).collect()}
        assert kept == first_by_hand(rows, lambda n: min(n, cap))
    split = sampling.stratified_split(skewed, ["text"]).collect()
    assert len(split) == len(rows)
    val = {r.text for r in split if r.is_val}
    assert val == first_by_hand(rows, lambda n: math.floor(n * 0.1 + 0.5))


def test_sample_n(spark, skewed):
    texts = [r.text for r in skewed.collect()]
    for n in (0, 7, 3191, 10_000):
        drawn = {r.text for r in sampling.sample_n(skewed, n, ["text"]).collect()}
        assert drawn == set(sorted(texts, key=md5)[:n])
    order = [r.text for r in sampling.shuffle_rows(skewed, ["text"]).collect()]
    assert order == sorted(texts, key=md5)


def test_global_index_and_holdout(spark, skewed):
    indexed = sampling.global_index(skewed.repartition(7), [F.desc("category"), F.asc("text")])
    rows = sorted(indexed.collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in rows] == list(range(3191))
    expected = sorted(((r.category, r.text) for r in rows), key=lambda p: p[1])
    expected.sort(key=lambda p: p[0], reverse=True)
    assert [(r.category, r.text) for r in rows] == expected
    split = sampling.ordered_holdout(skewed, ["text"]).collect()
    assert sum(r.is_train for r in split) == int(0.95 * 3191)
    assert max(r.text for r in split if r.is_train) < min(r.text for r in split if not r.is_train)
    labels = sampling.label_index(skewed).collect()
    assert {r.category: r.label_id for r in labels} == {"big": 0, "mid": 1, "one": 2, "small": 3}


def labelled_texts(spark):
    rows = []
    for i in range(60):
        rows.append((f"болт стальной м{i}", "Метизы", "rules"))
        rows.append((f"молоко свежее {i} литра", "Продукты", "rules"))
        rows.append((f"аренда офиса {i} этаж", fixed.FALLBACK_LABEL, "rules"))
        rows.append((f"мусор {i}", "МУСОР → Шум", "rules"))
    rows += [("кран", "Редкое", "rules"), ("★", "Метизы", "rules"), (None, "Метизы", "rules")]
    return spark.createDataFrame(rows, "text string, category string, source string")


def test_training_set_and_finetune_dataset(spark):
    v1 = labelled_texts(spark)
    rows = datasets.training_set(v1, 50, 55).collect()
    counts = Counter(r.category for r in rows)
    # The class cap comes before cleaning, so an empty text may take a place.
    assert counts["Продукты"] == 55 and counts[fixed.FALLBACK_LABEL] == 55
    assert counts["Метизы"] in (54, 55) and set(counts) == {"Метизы", "Продукты", fixed.FALLBACK_LABEL}
    assert fixed.FALLBACK_LABEL not in {
        r.category for r in datasets.training_set(v1, 50, 55, drop_fallback=True).collect()
    }
    tuned = datasets.finetune_dataset(v1, 60, 60).collect()
    assert Counter(r.category for r in tuned) == {"Метизы": 60, "Продукты": 60, fixed.FALLBACK_LABEL: 60}
    assert Counter(r.category for r in tuned if r.is_val) == {
        "Метизы": 6, "Продукты": 6, fixed.FALLBACK_LABEL: 6,
    }


def test_finetune_tables(spark, tmp_path):
    tuned = datasets.finetune_dataset(labelled_texts(spark), 60, 60)
    train, val = str(tmp_path / "train"), str(tmp_path / "val")
    datasets.write_finetune_dataset(tuned, train, val)
    assert (spark.read.parquet(train).count(), spark.read.parquet(val).count()) == (162, 18)
    assert spark.read.parquet(val).columns == ["text", "category", "source", "clean"]


DOCS = {1: "aa bb aa cc", 2: "bb cc", 3: "aa x bb", 4: "", 5: "cc cc cc dd"}


def weights_by_hand(docs, min_df, max_df):
    def terms(text):
        words = [w for w in text.split() if len(w) > 1]
        return words + [" ".join(p) for p in zip(words, words[1:])]

    tf = {k: Counter(terms(t)) for k, t in docs.items()}
    df = Counter(t for c in tf.values() for t in c)
    n = len(docs)
    vocabulary = {t for t, d in df.items() if d >= min_df and d <= max_df * n}
    result = {}
    for k, counts in tf.items():
        raw = {
            t: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[t])) + 1)
            for t, c in counts.items()
            if t in vocabulary
        }
        norm = math.sqrt(sum(w * w for w in raw.values()))
        result.update({(k, t): w / norm for t, w in raw.items()})
    return vocabulary, result


def test_tfidf(spark):
    df = spark.createDataFrame(list(DOCS.items()), "k int, c string")
    vocabulary = tfidf.tfidf_vocabulary(df, "c", 2, 0.9)
    names, expected = weights_by_hand(DOCS, 2, 0.9)
    table = {r.term: r.idx for r in vocabulary.table.collect()}
    assert table == {t: i for i, t in enumerate(sorted(names))}
    weights = tfidf.tfidf_weights(df, "k", "c", vocabulary)
    found = {(r.k, r.term): r.weight for r in weights.collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[p], expected[p]) for p in found)

    vectors = tfidf.to_sparse_vector(df.select("k"), "k", weights, vocabulary.size)
    for row in vectors.select("k", vector_to_array("features").alias("v")).collect():
        assert row.v == [found.get((row.k, t), 0.0) for t in sorted(names)]

    few = tfidf.tfidf_vocabulary(df, "c", 1, 1.0, max_features=2)
    assert [r.term for r in few.table.orderBy("idx").collect()] == ["aa", "cc"]


def test_text_model(spark, tmp_path, monkeypatch):
    rows = datasets.training_set(labelled_texts(spark), 50, 60)
    model, report, scores = datasets.train_and_evaluate(rows)
    assert scores.first().accuracy == 1.0 and report.count() == 3
    path = str(tmp_path / "model")
    model.save(path)
    again = load_model(spark, path)
    cleans = spark.createDataFrame([("болт стальной",), ("молоко свежее",), (" ",), ("zz",)], "clean string")
    found = {r.clean: r.ml_label for r in again.predict_clean(cleans).collect()}
    assert found["болт стальной"] == "Метизы" and found["молоко свежее"] == "Продукты"
    assert set(found) == {"болт стальной", "молоко свежее", "zz"}
    assert found == {r.clean: r.ml_label for r in model.predict_clean(cleans).collect()}
    # Coefficients too large to send to every task are joined instead.
    monkeypatch.setattr("nomina.scratch.BROADCAST_BYTES", 100)
    assert found == {r.clean: r.ml_label for r in again.predict_clean(cleans).collect()}
    monkeypatch.setattr("nomina.operators.textmodel.BLOCK_PRODUCTS", 5)
    monkeypatch.undo()
    assert found == {r.clean: r.ml_label for r in again.predict_clean(cleans).collect()}


def dense_svms(x, labels, weights, c):
    """(coefficients with the intercept last, by class): Newton steps on dense matrices."""
    x = np.hstack([x, np.ones((len(x), 1))])
    found = {}
    for k, own in weights.items():
        y = np.where(labels == k, 1.0, -1.0)
        cost = c * np.where(y > 0, own, 1.0)

        def objective(w):
            return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

        w = np.zeros(x.shape[1])
        for _ in range(100):
            active = (1 - y * (x @ w) > 0) * cost
            gradient = w + 2 * x.T @ (active * (x @ w - y))
            if np.linalg.norm(gradient) < 1e-9:
                break
            step = np.linalg.solve(np.eye(len(w)) + 2 * (x.T * active) @ x, -gradient)
            length = 1.0
            while objective(w + length * step) > objective(w) and length > 1e-9:
                length /= 2
            w = w + length * step
        found[k] = w
    return found


@pytest.fixture(scope="module")
def noisy_vectors(spark):
    """Rows of five classes that cannot be told apart wholly, a third of one class."""
    rng = np.random.default_rng(3)
    labels = np.where(rng.random(240) < 1 / 3, 0, rng.integers(1, 5, 240))
    x = np.abs(rng.standard_normal((240, 30))) * (rng.random((240, 30)) < 0.25)
    x[np.arange(240), labels * 3] += 1.2
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    x[7] = 0
    rows = [(int(k), Vectors.sparse(30, {i: float(v) for i, v in enumerate(r) if v})) for k, r in zip(labels, x)]
    return spark.createDataFrame(rows, ["label_id", "features"]).repartition(5), x, labels


@pytest.mark.parametrize("group_bytes,products", [(32 << 20, 2_000_000), (2 * 31 * 8, 2_000_000), (32 << 20, 900)])
def test_classes_are_solved_to_their_optimum(noisy_vectors, monkeypatch, group_bytes, products):
    """Whether the classes go in one group or three, and whatever the sample."""
    monkeypatch.setattr(svm, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(svm, "SAMPLE_PRODUCTS", products)
    monkeypatch.setattr(svm, "PRODUCTS", 500)
    monkeypatch.setattr(svm, "SUM_TERMS", 8)
    vectors, x, labels = noisy_vectors
    weights = reports.class_weights(vectors, "label_id")
    found = svm.train_linear_svms(vectors, weights, 30, 2.0, 500, 1e-6).collect()
    expected = dense_svms(x, labels, {r.label_id: r.weight for r in weights.collect()}, 2.0)
    assert sorted(r.label_id for r in found) == sorted(expected)
    for r in found:
        w = expected[r.label_id]
        assert np.abs(np.append(r.coefficients, r.intercept) - w).max() < 1e-5 * max(1, np.linalg.norm(w))


def test_rare_terms_outside_the_sample_cost_few_passes(spark, monkeypatch):
    """A sample of some of the rows tells little of rare terms; blocks have few entries."""
    monkeypatch.setattr(svm, "SAMPLE_PRODUCTS", 3000)
    rng, passes = np.random.default_rng(5), []
    run = svm.Problem.run
    monkeypatch.setattr(svm.Problem, "run", lambda self, *a: passes.append(len(passes)) or run(self, *a))
    x = (rng.random((1500, 630)) < np.r_[np.full(30, 0.6), np.full(600, 0.02)]) * rng.uniform(0.5, 1.5, (1500, 630))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    labels = (x @ rng.standard_normal(630) > 0).astype(int)
    rows = [(int(k), Vectors.sparse(630, {i: float(r[i]) for i in np.flatnonzero(r)})) for k, r in zip(labels, x)]
    vectors = spark.createDataFrame(rows, ["label_id", "features"]).repartition(2)
    weights = reports.class_weights(vectors, "label_id")
    found = svm.train_linear_svms(vectors, weights, 630, 1.0, 500, 1e-6).collect()
    expected = dense_svms(x, labels, {r.label_id: r.weight for r in weights.collect()}, 1.0)
    for r in found:
        w = expected[r.label_id]
        assert np.abs(np.append(r.coefficients, r.intercept) - w).max() < 1e-5 * np.linalg.norm(w)
    assert len(passes) <= 140


def test_blocks_end_by_rows_and_entries(monkeypatch):
    monkeypatch.setattr(svm, "PRODUCTS", 10)
    monkeypatch.setattr(svm, "BLOCK_ROWS", 3)
    cut = [(b.start, b.stop) for b in svm._blocks(np.array([4, 6, 1, 25, 0, 0, 0, 0]))]
    assert cut == [(0, 2), (2, 3), (3, 4), (4, 7), (7, 8)]


def test_back_filled_labels_are_those_of_a_dense_model(spark):
    """The whole second layer, row by row."""
    rng = random.Random(6)
    words = {"a": ["болт", "гайка", "шайба"], "b": ["молоко", "сыр", "хлеб"], "c": ["бумага", "ручка", "болт"]}
    rows = [(" ".join([*rng.choices(words[k], k=3), f"слово{rng.choice('абвгд')}"]), k) for k in "abc" for _ in range(60)]
    rows = sorted(set(rows))
    texts = sorted({" ".join(rng.choices(sum(words.values(), []), k=rng.randrange(1, 5))) for _ in range(80)})
    train = spark.createDataFrame(rows, "clean string, category string")
    model = train_text_model(train, "clean", min_df=2)
    v1 = spark.createDataFrame([(t, fixed.FALLBACK_LABEL, "rules") for t in texts], "text string, category string, source string")
    v2 = {r.text: r for r in labelling.backfill_with_ml(v1, model.predict_clean).collect()}

    names = {r.term: r.idx for r in model.vocabulary.table.collect()}
    idf = {r.idx: r.idf for r in model.vocabulary.table.collect()}

    def vector(text):
        split = text.split()
        x = np.zeros(len(names))
        for term, n in Counter(split + [" ".join(p) for p in zip(split, split[1:])]).items():
            if term in names:
                x[names[term]] = (1 + math.log(n)) * idf[names[term]]
        return x / (np.linalg.norm(x) or 1)

    labels = np.array([k for _, k in rows])
    counts = Counter(labels.tolist())
    weights = {k: len(rows) / (len(counts) * n) for k, n in counts.items()}
    dense = dense_svms(np.array([vector(t) for t, _ in rows]), labels, weights, 1.0)
    order = {r.category: r.label_id for r in model.classes.collect()}
    for t in texts:
        scores = {k: float(np.append(vector(t), 1) @ w) for k, w in dense.items()}
        best = max(scores, key=lambda k: (scores[k], -order[k]))
        assert v2[t].source == "ml"
        assert v2[t].category == best or abs(scores[v2[t].category] - scores[best]) < 1e-3


def test_a_solver_that_is_stopped_says_so(spark):
    rows = datasets.training_set(labelled_texts(spark), 50, 60)
    with pytest.warns(UserWarning, match="no convergence"):
        train_text_model(rows, "clean", max_iter=1)


def test_null_classes_are_split_but_not_capped(spark):
    rows = [(f"t{i}", None if i % 4 == 0 else "a") for i in range(100)]
    df = spark.createDataFrame(rows, "text string, category string")
    split = sampling.stratified_split(df, ["text"]).collect()
    assert len(split) == 100
    assert Counter(r.category for r in split if r.is_val) == {"a": 8, None: 3}
    assert sampling.cap_per_class(df, 10, ["text"]).count() == 10


def test_rows_the_model_does_not_answer_stay(spark):
    v1 = spark.createDataFrame(
        [(f"болт {i}", fixed.FALLBACK_LABEL, "rules") for i in range(10)], "text string, category string, source string"
    )

    def half(cleans):
        return cleans.where("clean < 'болт 5'").select("clean", F.lit("Метизы").alias("ml_label"))

    v2 = labelling.backfill_with_ml(v1, half).collect()
    assert Counter((r.category, r.source) for r in v2) == {("Метизы", "ml"): 5, (fixed.FALLBACK_LABEL, "rules"): 5}


def test_missing_model_switches_the_tier_off(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert load_model(spark, str(tmp_path / "nowhere")) is None


def test_quality_measures(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [("b", "d")]
    df = spark.createDataFrame(pairs, "t string, p string")
    report = reports.class_report(reports.confusion(df, "t", "p"))
    rows = {r.category: r for r in report.collect()}
    assert rows["a"].precision == pytest.approx(5 / 6) and rows["a"].recall == pytest.approx(5 / 7)
    assert rows["c"].f1 == 0 and rows["d"].support == 0 and rows["d"].recall == 0
    found = reports.scores(report).first()
    f1 = {c: r.f1 for c, r in rows.items()}
    assert found.accuracy == pytest.approx(8 / 12)
    assert found.f1_macro == pytest.approx(sum(f1.values()) / 4)
    assert found.f1_weighted == pytest.approx((7 * f1["a"] + 4 * f1["b"] + f1["c"]) / 12)


def test_class_weights(spark, skewed):
    found = {r.category: r.weight for r in reports.class_weights(skewed).collect()}
    assert found["big"] == pytest.approx(3191 / (4 * 3000)) and found["one"] == pytest.approx(3191 / 4)


def test_terms_are_counted_by_loads(spark, monkeypatch):
    """Loads of a few words, null and blank texts, and a row of the plan for each load
    and term instead of one for each occurrence."""
    from nomina.operators import terms

    monkeypatch.setattr(terms, "LOAD_WORDS", 5)
    texts = ["aa bb aa bb aa", None, "", "x", "bb aa", "aa " * 40, "été bb aa"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, c string").coalesce(1)
    expected = {}
    for text in texts:
        words = [w for w in (text or "").split() if len(w) > 1]
        found = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        for term in set(found):
            old = expected.get(term, (0, 0))
            expected[term] = (old[0] + 1, old[1] + found.count(term))
    counted = {r["term"]: (r["df"], r["total"]) for r in tfidf.document_frequency(df, "c").collect()}
    assert counted == expected
    plan = tfidf.document_frequency(df, "c")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_weights_by_broadcast_and_by_join_agree(spark, monkeypatch):
    """Keys that repeat or are null are one row, on both ways."""
    rows = [(1, "aa bb aa"), (1, "bb cc"), (None, "aa bb"), (None, "cc"), (2, "zz"), (3, None), (4, "bb aa bb")]
    df = spark.createDataFrame(rows, "k int, c string")
    vocabulary = tfidf.tfidf_vocabulary(df, "c", min_df=1, max_df=1.0, max_features=6)

    def weights():
        found = tfidf.tfidf_weights(df, "k", "c", vocabulary).collect()
        return sorted(((r["k"] or 0, r["term"], r["idx"], round(r["weight"], 9)) for r in found))

    sent = weights()
    monkeypatch.setattr("nomina.scratch.BROADCAST_ROWS", -1)
    assert sent == weights() and sent


def test_weights_move_a_row_for_each_text(spark):
    """Not one for each of its terms; keys that go on in the next batch are one row, and
    words are cut alike by bytes and by Spark."""
    rows = [(1, "aa bb,aa b"), (1, "bb_1 cc"), (None, "aa bb"), (None, "cc"), (2, "ÀÉ aa қазақ x"), (3, None), (1, "жук AA"), (4, "bb aa-bb")]
    df = spark.createDataFrame(rows, "k int, c string")
    vocabulary = tfidf.tfidf_vocabulary(df, "c", min_df=1, max_df=1.0, max_features=50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        weights = tfidf.tfidf_weights(df, "k", "c", vocabulary)
        plan = weights._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "HashAggregate" not in plan
        found = {(r["k"], r["term"]): r["weight"] for r in weights.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    counted = tfidf.term_frequencies(df, "k", "c").join(vocabulary.table, "term").collect()
    raw = {(r["k"], r["term"]): (1 + math.log(r["tf"])) * r["idf"] for r in counted}
    norm = Counter()
    for (k, _), w in raw.items():
        norm[k] += w * w
    assert found == pytest.approx({(k, t): w / math.sqrt(norm[k]) for (k, t), w in raw.items()}) and len(found) > 15


def test_hessian_products_read_active_rows_only(spark, noisy_vectors, monkeypatch):
    """The rows inside the margin of a class are written apart, and only they are met."""
    monkeypatch.setattr(svm, "PRODUCTS", 300)
    vectors, x, labels = noisy_vectors
    rows = vectors.select("label_id", F.unwrap_udt("features").alias("v")).select("label_id", "v.indices", "v.values")
    packed = materialise(svm.pack_rows(rows), "problem")
    ids, weights, rng = np.arange(5), np.array([0.5, 1, 2, 1, 3.0]), np.random.default_rng(8)
    w, direction = (rng.standard_normal((31, 5)) * scale for scale in (2, 1))
    problem = svm.Problem(packed, 30, ids, weights, 1.5)
    problem.find_active(w)
    ones = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(labels[:, None] == ids, 1, -1)
    cost = 1.5 * np.where(sign > 0, weights, 1) * (1 - sign * (ones @ w) > 0)
    kept = [svm._Rows(r.asDict()) for r in problem.active.collect()]
    assert sum(len(b.labels) for b in kept) == (cost > 0).any(axis=1).sum() < len(x)
    assert sum(b.active[:, :5].sum() for b in kept) == (cost > 0).sum()
    some = np.array([1, 3, 4])
    problem.packed = None
    product = problem.run(w, some, direction[:, :])[1]
    assert np.allclose(product, (ones.T @ (2 * cost * (ones @ direction)))[:, some])
    diagonal = problem.run(w, some, np.zeros((0, 3)))[1]
    assert np.allclose(diagonal, (ones.T**2 @ (2 * cost))[:, some])
    assert problem.share == 1 and sum(len(b.labels) for b in problem.sample) == sum(len(b.labels) for b in kept)


def test_weights_of_a_row_need_no_gathering(spark, monkeypatch):
    """Lists of weights are those of the rows for each term, whatever the batches."""
    texts = [(1, "a1 b1 a1"), (2, None), (3, "b1 c1 zz"), (4, "qq"), (3, "c1 a1 b1"), (None, "a1"), (5, ""), (6, "c1 b1 a1")]
    df = materialise(spark.createDataFrame(texts, "k long, c string"))
    vocabulary = tfidf.tfidf_vocabulary(df, "c", 1, 1.0, 6)
    monkeypatch.setattr("nomina.operators.terms.OUT_LISTS", 2)
    found = tfidf.weight_lists(df, "k", "c", vocabulary)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    expected = tfidf.gather_weights(tfidf.tfidf_weights(df, "k", "c", vocabulary), "k")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    monkeypatch.setattr("nomina.scratch.BROADCAST_ROWS", -1)
    joined = {r["k"]: list(zip(r["idx"], r["weight"])) for r in tfidf.weight_lists(df, "k", "c", vocabulary).collect()}
    for r in expected.collect():
        assert [i for i, _ in joined[r["k"]]] == r["idx"]
        assert np.allclose([w for _, w in joined[r["k"]]], r["weight"])
