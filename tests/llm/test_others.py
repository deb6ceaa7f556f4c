"""Quality, vectors, mixing, conversations and the pipeline."""

from __future__ import annotations

import heapq
import math
import os
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nomina.llm import blocks, cap_filters, impact_index, mixing, quality, quote_links
from nomina.llm.queries import ORACLES, QUERIES, REPLIES_SQL
from tests.llm import helpers
from tests.llm.test_texts import brute_cut, brute_near
from workload import compare

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(helpers.odd_documents(), helpers.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], helpers.SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr("workload.ORACLES", ORACLES)
    assert compare.mismatch(QUERIES[name](spark, SF), SF, name) is None


# quality


def test_quality_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = QUERIES["op3_quality_scores"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 50
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found)
    assert np.mean([r["predicted"] == r["quality"] for r in found]) > 0.93
    assert np.mean([r["predicted"] for r in found if r["quality"] == 1]) > 0.96


def test_indicators_are_the_sets_of_ngrams():
    import pyarrow as pa
    from nomina.llm.words import text_slices

    texts = ["", "ab", "abab abab", "é", "x" * 50, None, "Und Und Und"]
    for part in text_slices(pa.array(texts)):
        owner, feature = quality.indicators(part)
        for i, text in enumerate(texts):
            raw = (text or "").encode()
            grams = {raw[j : j + n] for n in quality.NGRAMS for j in range(len(raw) - n + 1)}
            split = raw.split()
            repeats = any(a == b for a, b in zip(split, split[1:]))
            assert (owner == i).sum() == len(grams) + repeats
            assert len(set(feature[owner == i])) == (owner == i).sum()


def test_dual_coordinate_descent_meets_its_optimality_conditions():
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(40, 8, replace=False)).astype(np.int32) for _ in range(120)]
    values = [rng.standard_normal(8) for _ in rows]
    signs = np.where(rng.random(120) < 0.5, 1.0, -1.0)
    weights, bias = quality.dual_coordinate_descent(rows, values, signs, tol=1e-6, rounds=5000)

    def objective(w, b):
        loss = sum(max(0.0, 1 - s * (w[r] @ v + b)) for r, v, s in zip(rows, values, signs))
        return 0.5 * (w @ w + b * b) + loss

    best = objective(weights, bias)
    for _ in range(50):
        assert objective(weights + 0.01 * rng.standard_normal(len(weights)) * (weights != 0), bias) >= best - 1e-6


def test_quality_with_odd_labels(spark, docs, empty):
    labels = spark.createDataFrame([(10, 1), (11, 1), (None, 0), (12, None), (13, 7)], "doc_id long, quality int")
    model = quality.fit(docs, "doc_id", "text", labels, "quality")
    scores = {r[0] for r in docs.select(quality.quality_score(docs, "text", model)).collect()}
    assert len(scores) == 1 and 0.5 < scores.pop() < 1
    both = spark.createDataFrame([(16, 1), (17, 1), (18, 1), (24, 0), (24, 1), (16, 1)], "doc_id long, quality int")
    model = quality.fit(docs, "doc_id", "text", both, "quality")
    scored = docs.select("text", quality.quality_score(docs, "text", model).alias("s")).collect()
    by_text = {r["text"]: r["s"] for r in scored}
    assert len(scored) == len(helpers.odd_documents())
    assert by_text[None] == by_text[""] and by_text[helpers.prose(2, 120)] > by_text["Und Und Und Und " * 20]
    assert empty.select(quality.quality_score(empty, "text", model)).count() == 0
    assert quality.fit(empty, "doc_id", "text", labels.limit(0), "quality").slope == 0.0


# vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def odd_vectors(n: int = 300, dim: int = 16) -> list[tuple]:
    """Random ones, near and exact copies, multiples, and unusable ones."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(dim).tolist(), 0) for i in range(n)]
    for i in range(60):
        noise = rng.standard_normal(dim) * rng.choice([0.05, 0.3, 0.5])
        rows.append((n + i, (np.array(rows[i % 12][1]) + noise).tolist(), 1))
    rows += [(n + 100 + i, rows[3][1], 2) for i in range(40)]
    rows += [(1000, [2 * x for x in rows[5][1]], None), (1001, [0.0] * dim, 1), (1002, None, 1), (1003, [], 1)]
    rows += [(1004, [float("nan")] * dim, 1), (1005, [None] + [1.0] * (dim - 1), 1), (1006, [math.inf] * dim, 1)]
    rows += [(None, rows[3][1], 1), (1050, rows[0][1][:8], 1), (1051, rows[0][1][:8], 1), rows[7], rows[3]]
    return [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for k, v, c in rows]


def finite(vector) -> bool:
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


def brute_links(rows: list[tuple], cosine: float) -> tuple[list, list]:
    good = [(i, k, np.array(v)) for i, (k, v, _) in enumerate(rows) if k is not None and finite(v) and any(v)]
    links = []
    for n, (i, a, v) in enumerate(good):
        for j, b, w in good[:n]:
            if len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= cosine:
                links.append((i, j))
    return good, links


@pytest.mark.parametrize("block", [1000, 15])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    rows = odd_vectors()
    good, links = brute_links(rows, 0.9)
    found = cap_filters.near_vectors(spark.createDataFrame(rows, VECTORS).repartition(3), "vec_id", "embedding")
    counts = Counter(i for pair in links for i in pair)
    roots = helpers.reach([k for _, k, _ in good], [(rows[i][0], rows[j][0]) for i, j in links])
    expected = sorted(
        ((k, counts[i], roots.get(k, k), roots.get(k, k) == k) for i, (k, _, _) in enumerate(rows)), key=repr
    )
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert len(got) == len(expected)
    # Filters are random: most links must be found, none that is not there.
    pairs = [(g, e) for g, e in zip(got, expected)]
    assert all(g[0] == e[0] and g[1] <= e[1] for g, e in pairs)
    assert sum(g[1] for g in got) >= 0.97 * sum(e[1] for e in expected)
    assert sum(g == e for g, e in pairs) >= 0.9 * len(pairs)
    none = spark.createDataFrame([], VECTORS)
    assert cap_filters.near_vectors(none, "vec_id", "embedding").count() == 0


def test_recall_at_the_threshold():
    """Pairs at exactly the wanted cosine share a filter in most cases."""
    rng = np.random.default_rng(9)
    for n, dim in ((500, 64), (2_000, 32), (100_000, 64)):
        code = cap_filters.code_for(n, dim, 0.9)
        one = rng.standard_normal((400, dim))
        one /= np.linalg.norm(one, axis=1, keepdims=True)
        side = rng.standard_normal((400, dim))
        side -= (side * one).sum(axis=1, keepdims=True) * one
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        two = 0.9 * one + np.sqrt(1 - 0.81) * side
        found = [set(), set()]
        for out, vectors in zip(found, (one, two)):
            out.update(zip(*(a.tolist() for a in cap_filters.decode(vectors, code))))
        assert len({v for v, _ in found[0] & found[1]}) >= 0.93 * len(one)


@pytest.mark.parametrize("n", [3_000_000, 30_000_000, 100_000_000])
@pytest.mark.parametrize("dim", [64, 128])
def test_recall_of_the_codes_for_many_vectors(n, dim):
    """The code depends on the number of vectors only, so no such rows are needed."""
    rng = np.random.default_rng(21)
    code = cap_filters.code_for(n, dim, 0.9)
    one = rng.standard_normal((300, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = rng.standard_normal((300, dim))
    side -= (side * one).sum(axis=1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    for cosine, wanted in ((0.9, 0.95), (0.95, 0.98)):
        found = []
        for vectors in (one, cosine * one + np.sqrt(1 - cosine**2) * side):
            found.append(set(zip(*(a.tolist() for a in cap_filters.decode(vectors, code)))))
        assert len({v for v, _ in found[0] & found[1]}) >= wanted * len(one)


@pytest.mark.parametrize("n", [1_000, 50_000, 100_000_000])
@pytest.mark.parametrize("dim", [1, 2, 3, 4, 5, 6, 8, 64])
def test_recall_for_any_number_of_components(n, dim):
    """Pairs at the threshold and above it share a filter: nearly all by caps, all by boxes."""
    code = cap_filters.code_for(n, dim, 0.9)
    for cosine, seed in ((0.9, 31), (0.93, 32), (0.999, 33)):
        one, two = cap_filters.random_pairs(dim, cosine, 300, seed)
        found = [set(zip(*(a.tolist() for a in cap_filters.decode(v, code)))) for v in (one, two)]
        met = len({v for v, _ in found[0] & found[1]}) / len(one)
        assert met == 1 if isinstance(code, cap_filters.Boxes) else met >= 0.95
    assert dim >= 8 or isinstance(code, cap_filters.Boxes)


@pytest.mark.parametrize("dim", [1, 2, 3, 5])
def test_near_vectors_of_few_components_are_exact(spark, monkeypatch, dim):
    """Boxes lose no link, in the whole query as well."""
    monkeypatch.setattr(cap_filters, "code_for", lambda n, d, cosine: cap_filters.boxes_for(d, cosine))
    rng = np.random.default_rng(dim)
    rows = [(i, rng.standard_normal(dim).tolist(), 0) for i in range(250)] + [(300, [0.0] * dim, 1), (301, None, 1)]
    rows += [(i + 400, rows[i][1], 0) for i in range(20)] + [(500, [1.0] + [0.0] * (dim - 1), 0), (501, [-1.0] + [0.0] * (dim - 1), 0)]
    good, links = brute_links(rows, 0.9)
    found = cap_filters.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id", "embedding")
    counts = Counter(i for pair in links for i in pair)
    roots = helpers.reach([k for _, k, _ in good], [(rows[i][0], rows[j][0]) for i, j in links])
    expected = sorted((k, counts[i], roots.get(k, k), roots.get(k, k) == k) for i, (k, _, _) in enumerate(rows))
    assert sorted(map(tuple, found.collect())) == expected


def test_decoding_in_parts_finds_the_same(monkeypatch):
    code = cap_filters.code_for(20_000, 64, 0.9)
    vectors, _ = cap_filters.random_pairs(64, 0.9, 300, 5)
    whole = cap_filters.decode(vectors, code)
    monkeypatch.setattr(cap_filters, "GROWN", 50)
    monkeypatch.setattr(cap_filters, "SCORES", 7 * code.words)
    assert all((a == b).all() for a, b in zip(whole, cap_filters.decode(vectors, code)))


def test_list_decoding_finds_every_filter():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((20, 12))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    code = cap_filters.Code(12, 3, 5, 0.7)
    expected = set()
    for number in range(cap_filters.CODES):
        rotation, lists = cap_filters._code_words(12, 3, 5, number)
        parts = np.split(vectors @ rotation, 3, axis=1)
        total = (parts[0] @ lists[0].T)[:, :, None, None] + (parts[1] @ lists[1].T)[:, None, :, None]
        total = total + (parts[2] @ lists[2].T)[:, None, None, :]
        each = np.argwhere(total.reshape(20, -1) >= 0.7)
        expected |= {(v, f * cap_filters.CODES + number) for v, f in each.tolist()}
    owner, found = cap_filters.decode(vectors, code)
    assert list(zip(owner.tolist(), found.tolist())) == sorted(expected)


@pytest.mark.parametrize("rows_per_block,queries_per_block", [(16_384, 16_384), (50, 3)])
def test_exact_search(spark, monkeypatch, rows_per_block, queries_per_block):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", rows_per_block)
    monkeypatch.setattr(blocks, "QUERY_ROWS", queries_per_block)
    monkeypatch.setattr(impact_index, "FEW", 8)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, VECTORS)
    vectors = df.select(F.col("vec_id").alias("id"), impact_index.whole_numbers(F.col("embedding")).alias("vector"))
    usable = vectors.where("id IS NOT NULL AND vector IS NOT NULL")
    index = impact_index.build_index(usable)
    found = impact_index.search(index, usable.where("id % 9 = 0"), 5).collect()
    whole = [(k, np.floor(256 * np.array(v)).astype(np.int64)) for k, v, _ in rows if k is not None and finite(v)]
    expected = []
    for query in {k for k, _ in whole if k % 9 == 0}:
        own = min((v.tolist() for k, v in whole if k == query))
        scores = [(-int(v @ np.array(own)), k) for k, v in whole if k != query and len(v) == len(own)]
        best = heapq.nsmallest(5, scores)
        expected += [(query, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    assert sorted(map(tuple, found)) == sorted(expected)
    none = usable.limit(0)
    assert impact_index.search(impact_index.build_index(none), none, 5).count() == 0


def test_search_of_ties_and_zeros(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100, [0.0, 0.0]), (200, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    usable = df.select("id", impact_index.whole_numbers(F.col("v")).alias("vector"))
    found = impact_index.search(impact_index.build_index(usable), usable.where("id IN (0, 100, 200)"), 3).collect()
    got = sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found)
    assert got[:3] == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 3, 65536)]
    assert got[3:6] == [(100, 1, 0, 0), (100, 2, 1, 0), (100, 3, 2, 0)]
    assert got[6:] == [(200, 1, 100, 0), (200, 2, 0, -65536), (200, 3, 1, -65536)]


# mixing


def simulate(blocks: dict[str, int], shares: dict[str, int]) -> list[tuple[str, int]]:
    """Earliest deadline first, slot by slot; a new phase where a source runs out."""
    done, out = Counter(), []
    while left := {s for s in blocks if done[s] < blocks[s]}:
        start, at, period = len(out), Counter(), sum(shares[s] for s in left)
        while all(done[s] < blocks[s] for s in left):
            slot = len(out) - start
            due = [(-(-(at[s] + 1) * period // shares[s]), s) for s in left if at[s] * period // shares[s] <= slot]
            source = min(due)[1]
            out.append((source, done[source]))
            at[source] += 1
            done[source] += 1
    return out


def test_mixing_follows_the_schedule(spark, docs, empty):
    rng = random.Random(4)
    rows = [(i, rng.choices(["a", "b", "c"], [6, 3, 1])[0]) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, s string")
    weights = {"a": 0.37, "b": 0.37, "c": 0.26}
    placed = mixing.mix(df, "k", "s", weights, block_rows=7, period=100).orderBy("position").collect()
    assert [r["position"] for r in placed] == list(range(600))
    assert sorted(r["mix_key"] for r in placed) == list(range(600))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in placed)
    order = list(dict.fromkeys((r["source"], r["block"]) for r in placed))
    blocks = {s: max(b for t, b in order if t == s) + 1 for s in weights}
    assert order == simulate(blocks, {"a": 37, "b": 37, "c": 26})
    assert [r["slot"] for r in placed] == sorted(r["slot"] for r in placed)
    # No slot is empty, and in every phase each source is less than one block off
    # its weight among the sources that have blocks left.
    slots = {r["slot"]: r["source"] for r in placed}
    assert sorted(slots) == list(range(sum(blocks.values())))
    left, counts, start = dict(blocks), Counter(), 0
    for slot in sorted(slots):
        source = slots[slot]
        counts[source] += 1
        left[source] -= 1
        whole = sum(weights[s] for s in left)
        assert all(abs(counts[s] - weights[s] / whole * (slot + 1 - start)) < 1 + 1e-9 for s in left)
        if not left[source]:
            del left[source]
            counts, start = Counter(), slot + 1
    with pytest.raises(KeyError):
        mixing.mix(df, "k", "s", {"a": 1.0})
    assert mixing.mix(empty, "doc_id", "source").count() == 0


def test_mixing_keeps_to_weights_that_no_period_divides(spark):
    """Against the exact targets, over many thousands of slots."""
    weights = {"a": 1 / 3, "b": 0.2505, "c": 1 - 1 / 3 - 0.2505 - 0.0002, "d": 0.0002}
    slots = 12_000
    rows = {s: int(w * slots) + 1 for s, w in weights.items()}
    # One row a block, so a few rows are many periods of 1,000 slots.
    df = spark.range(sum(rows.values())).selectExpr("id AS k", f"CASE WHEN id < {rows['a']} THEN 'a' "
        f"WHEN id < {rows['a'] + rows['b']} THEN 'b' WHEN id < {rows['a'] + rows['b'] + rows['c']} THEN 'c' ELSE 'd' END AS s")  # fmt: skip
    placed = mixing.mix(df, "k", "s", weights, block_rows=1).orderBy("position").collect()
    assert len(placed) == sum(rows.values())
    counts = Counter()
    for at, r in enumerate(placed[: slots - 10]):
        assert r["slot"] == at
        counts[r["source"]] += 1
        assert all(abs(counts[s] - w * (at + 1)) < 1 + 1e-6 for s, w in weights.items())
        exact = r["block"] / weights[r["source"]], (r["block"] + 1) / weights[r["source"]]
        assert abs(r["release"] - exact[0]) < 1 + 1e-6 and abs(r["deadline"] - exact[1]) < 1 + 1e-6


def test_mixing_plans_a_tiny_weight(spark):
    df = spark.createDataFrame([(i, "a") for i in range(50)] + [(50, "b"), (51, "b")], "k long, s string")
    placed = mixing.mix(df, "k", "s", {"a": 1.0, "b": 1e-9}, block_rows=1, period=7).orderBy("position").collect()
    assert len(placed) == 52 and [r["mix_key"] for r in placed if r["source"] == "b"][0] in (50, 51)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in placed)
    with pytest.raises(ValueError):
        mixing.mix(df, "k", "s", {"a": 1.0, "b": 0.0})


def test_mixed_order_keeps_every_row(docs, empty):
    placed = mixing.mix(docs, "doc_id", "source")
    mixed = mixing.in_mixed_order(docs, "doc_id", "source", "text", placed)
    assert mixed.columns == docs.columns
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, docs.collect()))
    assert mixing.in_mixed_order(empty, "doc_id", "source", "text", mixing.mix(empty, "doc_id", "source")).count() == 0


def test_a_plan_has_a_bounded_number_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PLAN_BLOCKS", 10)
    df = spark.range(5000).selectExpr("id AS k", "IF(id % 5 = 0, 'a', 'b') AS s")
    placed = mixing.mix(df, "k", "s").collect()
    assert len(placed) == 5000 and len({(r["source"], r["block"]) for r in placed}) <= 12
    assert sorted(r["position"] for r in placed) == list(range(5000))


@pytest.mark.parametrize("blocks", [{"a": 1}, {"a": 3, "b": 0}, {"a": 50, "b": 1, "c": 7}, {str(i): i for i in range(1, 30)}])
def test_every_block_is_planned_within_its_window(blocks):
    shares = {s: 1 + (7 * i) % 11 for i, s in enumerate(blocks)}
    planned = list(mixing.plan(shares, blocks))
    assert [p[4] for p in planned] == list(range(sum(blocks.values())))
    assert all(release <= slot < deadline for _, _, release, deadline, slot in planned)
    assert [p[:2] for p in planned] == simulate(blocks, shares)


def test_files_tell_the_mixed_order(spark, docs, tmp_path, monkeypatch):
    """Whatever order they are read in, and with clashing names."""
    monkeypatch.setattr(mixing, "FILE_BYTES", 20_000)
    named = docs.withColumns({c: F.lit(1) for c in ("__place_of", "position", "row", "key", "of", "file", "at")})
    placed = mixing.mix(named, "doc_id", "source")
    mixing.in_mixed_order(named, "doc_id", "source", "text", placed).write.parquet(str(tmp_path / "mixed"))
    read = spark.read.parquet(str(tmp_path / "mixed"))
    assert read.columns == named.columns and read.count() == docs.count()
    assert len(list((tmp_path / "mixed").glob("*.parquet"))) > 3
    stored = mixing.in_stored_order(read, "place").collect()
    assert sorted(r["place"] for r in stored) == list(range(docs.count()))
    wanted = {(r["mix_key"], r["source"]): r["position"] for r in placed.collect()}
    ranked = [wanted[r["doc_id"], r["source"] or ""] for r in sorted(stored, key=lambda r: r["place"])]
    assert ranked == sorted(ranked)


# conversations


def talk(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    some = ["alpha", "Beta", "gamma  x", "delta", "ok"]
    rows, told = [], []
    for turn in range(rng.randrange(1, 14)):
        lines = [" ".join(rng.choices(some, k=rng.randrange(1, 4))) + "\n" * (rng.random() < 0.2) for _ in range(rng.randrange(4))]
        text = "\n".join(lines)
        if told and rng.random() < 0.6:
            quoted = rng.choice(told).split("\n")
            quoted = [rng.choice(quoted)] if rng.random() < 0.4 else quoted
            text = "\n".join(">" + " " * rng.randrange(2) + q.upper() for q in quoted) + "\n" + text
            text = text.replace("\n", "\r\n") if rng.random() < 0.2 else text
        told.append(text)
        rows.append((seed, turn * 3, rng.choice(["user", "assistant"]), text if rng.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("stretch", [4096, 5])
def test_replies_equal_sql(spark, tmp_path, monkeypatch, stretch):
    monkeypatch.setattr(quote_links, "STRETCH", stretch)
    rows = [r for seed in range(40) for r in talk(seed)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "rows"))
    os.link(next(Path(tmp_path / "rows").glob("part*")), tmp_path / "conversations.parquet")
    monkeypatch.setattr(compare, "TABLES", ("conversations",))
    monkeypatch.setattr("workload.ORACLES", {"replies": REPLIES_SQL})
    found = QUERIES["op6_reply_order"](spark, str(tmp_path))
    assert compare.mismatch(found, str(tmp_path), "replies") is None
    assert found.agg(F.max("depth"), F.sum("linked_passages")).first()[0] >= 2


def test_reply_order_of_a_small_thread(spark):
    rows = [
        (1, 0, "Shall we meet?\n\nBring cake."),
        (1, 1, "Yes."),
        (1, 2, "> Yes.\nGood."),
        (1, 3, "> shall  we MEET?\nNo."),
        (1, 4, "> > Shall we meet?\n> No.\nWhy?"),
        (1, 5, "> bring cake.\nWhich?"),
        (None, 0, "> x\ny"), (2, None, None), (1, 5, "> bring cake.\nWhich?"),
    ]
    df = spark.createDataFrame(rows, "c long, t long, x string").withColumn("DEPTH", F.lit("clash"))
    found = quote_links.reply_ordered(df, "c", "t", "x").collect()
    assert len(found) == len(rows)
    placed = sorted((r for r in found if r["c"] == 1 and r["t"] is not None), key=lambda r: r["reply_key"])
    assert [r["t"] for r in placed] == [0, 1, 2, 3, 4, 5, 5]
    answers = {r["t"]: r["answers_turn"] for r in placed}
    assert answers == {0: None, 1: 0, 2: 1, 3: 0, 4: 3, 5: 0}
    assert {r["t"]: r["content"] for r in placed}[4] == "Why?"
    odd = [r for r in found if r["c"] is None or r["t"] is None]
    assert {r["content"] for r in odd} == {"y", ""} and all(r["reply_key"] is None for r in odd)
    assert quote_links.reply_ordered(df.limit(0), "c", "t", "x").count() == 0


def test_no_python_in_the_conversation_plan(spark):
    plan = QUERIES["op6_reply_order"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# the pipeline


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(str(tmp_path / str(i)))
        frames.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(f.columns == docs.columns and f.dtypes == docs.dtypes for f in frames[1:5])
    good, single, cut, mixed = ([(r["doc_id"], r["text"]) for r in f.collect()] for f in frames[1:5])
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op3_quality_scores"](spark, SF).collect()}
    assert {k for k, _ in good} == {k for k, p in scores.items() if p}
    roots = brute_near(good, 5)
    assert sorted(k for k, _ in single) == sorted(k for k, r in roots.items() if k == r)
    brute = brute_cut(single)
    expected = {k: kept if removed else text for (k, text), (_, removed, kept) in brute.items()}
    assert dict(cut) == expected
    assert sorted(mixed) == sorted(cut)
    last = {r["doc_id"]: r["n_tokens"] for r in frames[5].collect()}
    assert set(last) == {k for k, _ in mixed}
    whole = {r["doc_id"]: tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {r["doc_id"]: tuple(r) for r in frames[5].collect()}


def test_the_last_stage_tells_the_mix(spark, docs, tmp_path):
    """Whatever order the files are read in."""
    corpus_pipeline.mix_sources(spark, docs, SF).write.parquet(str(tmp_path / "mixed"))
    found = corpus_pipeline.encode_pieces(spark, spark.read.parquet(str(tmp_path / "mixed")), SF).collect()
    assert sorted(r["position"] for r in found) == list(range(docs.count()))
    placed = {(r["mix_key"], r["source"]): r["position"] for r in mixing.mix(docs, "doc_id", "source").collect()}
    ranked = [placed[r["doc_id"], r["source"] or ""] for r in sorted(found, key=lambda r: r["position"])]
    assert ranked == sorted(ranked)


CLASHES = ["n_words", "n_removed", "spans", "kept_text", "__key", "__tag", "__score", "__place_of", "tag", "row", "position"]


@pytest.mark.parametrize("extra", [[], CLASHES])
def test_every_stage_takes_odd_rows(spark, docs, tmp_path, monkeypatch, extra):
    """Nulls, empty and long texts, repeated rows, an id with two texts, and columns
    of any names."""
    monkeypatch.setattr(corpus_pipeline, "QUALITY_THRESHOLD", -1.0)
    two = [(11, "a text of its own under an id that " + helpers.prose(30, 30), "en", "a", 5)]
    rows = docs.unionByName(spark.createDataFrame(two, helpers.SCHEMA))
    for i, name in enumerate(extra):
        rows = rows.withColumn(name, F.lit(f"x{i}"))
    frames = [rows]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], SF).write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    assert all(f.dtypes == rows.dtypes for f in frames[1:5])
    for f in frames[1:5]:
        assert all(r[name] == f"x{i}" for r in f.collect() for i, name in enumerate(extra))
    good, single, cut, mixed = (sorted(((r["doc_id"], r["text"]) for r in f.collect()), key=repr) for f in frames[1:5])
    assert good == sorted(((r["doc_id"], r["text"]) for r in rows.collect()), key=repr)
    # Rows without an id stay; of copies the one with the smallest id stays.
    assert (11, two[0][1]) in single and (11, "") in single
    assert [k for k, t in single if t == helpers.prose(2, 120) or t == helpers.prose(2, 120).upper()].count(17) == 2
    assert not {k for k, _ in single} & {18, 19, 20} and {None} < {k for k, _ in single}
    assert len(cut) == len(single) and sorted(k or 0 for k, _ in cut) == sorted(k or 0 for k, _ in mixed)
    assert frames[5].count() == len(mixed)


def test_an_empty_table_runs_through_every_stage(spark, empty, tmp_path):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_pipeline_keeps_a_text_that_shares_an_id_with_a_copy(spark, tmp_path):
    q, u = helpers.prose(40, 60), helpers.prose(41, 60)
    docs = spark.createDataFrame([(1, q), (5, q), (5, u), (6, u), (7, u + " x")], "doc_id long, text string")
    found = corpus_pipeline.keep_one_of_each(spark, docs, SF).collect()
    assert sorted(map(tuple, found)) == sorted([(1, q), (5, u)])


def test_held_out_fold_is_crc32(spark):
    found = QUERIES["op3_quality_scores"](spark, "/root/testdata/sf0.001").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
