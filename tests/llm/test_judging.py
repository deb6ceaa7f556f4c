"""Hard negatives, rules judged by host, and the source audit against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nomina.llm import blocks, host_rules, multi_index, source_audit, words as llm_words
from tests.llm import helpers

# Hard negatives


def vectors(n: int, dim: int = 8, seed: int = 1) -> list[tuple]:
    """Clustered whole-number vectors with ties, copies, zeros and odd rows."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.integers(-8, 9, dim)
        rows.append((i, int(rng.integers(0, 4)), [int(x) for x in v]))
    rows[3] = (3, 1, [0] * dim)
    rows[5] = (5, rows[10][1], rows[10][2])
    rows += [rows[20], (20, 2, rows[40][2]), (n, None, rows[1][2]), (n + 1, 2, None), (n + 2, 2, []), (None, 1, rows[1][2])]
    rows += [(n + 3, 1, [1, None] + [0] * (dim - 2)), (1000, 0, [1, 2, 3]), (1001, 0, [1, 2, 4]), (1002, 1, [1, 2, 2])]
    return rows


def brute_mine(rows, anchor, positives=5, negatives=3, low=50, high=95):
    rows = [r for r in rows if None not in r and r[2] and None not in r[2]]
    asked = {}
    for i, label, v in rows:
        if anchor(i):
            asked[i] = min(asked.get(i, (label, v)), (label, v))
    found = []
    for a, (label, q) in asked.items():
        scored = sorted(
            (-sum(x * y for x, y in zip(q, v)), i, other) for i, other, v in rows if i != a and len(v) == len(q)
        )
        own = [(i, -s) for s, i, other in scored if other == label][:positives]
        for p, score in own:
            inside = [(i, -s) for s, i, other in scored if other != label and low * score <= -100 * s <= high * score]
            found += [(a, p, rank, i, score, s) for rank, (i, s) in enumerate(inside[:negatives], 1)]
    return sorted(found)


ROWS = "id long, label long, vector array<long>"


def mined(spark, rows, parts=1, **options):
    df = spark.createDataFrame(rows, ROWS).repartition(parts)
    found = multi_index.mine(df, F.expr("id % 10 = 0"), **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("limit", [16_384, 64])
def test_hard_negatives_are_those_of_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", limit)
    monkeypatch.setattr(blocks, "QUERY_ROWS", limit // 4)
    rows = vectors(400)
    assert mined(spark, rows, 3) == brute_mine(rows, lambda i: i % 10 == 0)


def test_hard_negatives_with_other_windows_and_extra_columns(spark):
    rows = vectors(150, dim=3, seed=2)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", dim string, block int")
    found = multi_index.mine(df, F.expr("id % 10 = 0"), positives=2, negatives=4, low=10, high=100)
    expected = brute_mine(rows, lambda i: i % 10 == 0, 2, 4, 10, 100)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_hard_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [5, 5]), (20, 2, [4, 4])]) == []  # no positive
    assert mined(spark, [(10, 1, [5]), (20, 1, [4]), (30, 2, [3]), (7, 2, [-3])]) == [
        (10, 20, 1, 30, 20, 15),
        (20, 10, 1, 30, 20, 12),
    ]


def test_scores_beyond_doubles(spark):
    big = 2**28
    rows = [(10, 1, [big, 1]), (2, 1, [big, 3]), (3, 2, [big * 3 // 4, 5]), (4, 2, [big * 3 // 4, 6]), (5, 2, [big, 3])]
    assert mined(spark, rows) == brute_mine(rows, lambda i: i % 10 == 0)


def test_a_visit_stops_early():
    rows = [r for r in vectors(5000) if None not in r and len(r[2] or []) == 8 and None not in r[2]]
    ids, labels, many = zip(*rows)
    table = pa.table({"id": pa.array(ids), "label": pa.array(labels), "vector": pa.array(many)})
    packed = multi_index._index_block(table) | {"dim": 8}
    block = multi_index.Block(packed)
    query = np.array(many[0])
    seen, bound = 0, np.inf
    for chosen, following in block.visit(query):
        scores = block.scores(chosen, query)
        assert not len(scores) or scores.max() <= bound
        bound, seen = following, seen + len(chosen)
    assert seen == len(rows)
    needed = 0
    for chosen, following in block.visit(query):
        needed += len(chosen)
        if np.sort(np.array(many)[: len(rows)] @ query)[-5] > following:
            break
    assert needed < len(rows) / 2


# Rules judged by host


def brute_measures(text):
    text = text or ""
    raw = helpers.words(text)
    found = [w.decode() for w in raw]
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = {j for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if helpers.words(x)]
    return (
        len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


LINES = ["a b\na b\n\n \n \na b\r\na b", "\nx\nx", "x\n", "\n", "#*$%&|<> é💥 é\n#", "a a a a a a a", "a a a a a", "b\n" * 50]


@pytest.mark.parametrize("limit", [1 << 20, 64, 1])
def test_measures_of_slices(limit):
    texts = [t for _, t, *_ in helpers.odd_documents()] + LINES + ["", None] + LINES
    found = []
    for part in llm_words.text_slices(pa.array(texts), limit):
        found += zip(*[m.tolist() for m in host_rules.measure(part)])
    assert found == [brute_measures(t) for t in texts]


def judged_brute(rows):
    """rows of (id, host, text): verdicts by the formulas of the docstring."""
    counts = defaultdict(lambda: [0] * 6)
    measures = {}
    for i, host, text in rows:
        n, chars, symbols, dup, repeat = measures[i] = brute_measures(text)
        fails = [n < 10, 100 * repeat > 20 * n, 10 * symbols > n, 10 * dup > n, chars > 20 * n]
        if host is not None:
            counts[host] = [a + b for a, b in zip(counts[host], [1, *fails])]
    rejected = set()
    for r in range(1, 6):
        n = sum(c[0] for c in counts.values())
        k = sum(c[r] for c in counts.values())
        p, hosts = k / n, len(counts)
        strength = 0.0
        if 0 < p < 1:
            spread = sum(c[0] * (c[r] / c[0] - p) ** 2 for c in counts.values())
            weight = p * (1 - p) * (n - sum(c[0] ** 2 for c in counts.values()) / n - (hosts - 1))
            rho = (spread - p * (1 - p) * (hosts - 1)) / weight if weight > 0 else 0
            strength = 1 / min(max(rho, 1e-9), 1 - 1e-9) - 1
        rejected |= {h for h, c in counts.items() if (c[r] + p * strength) / (c[0] + strength) > 0.5}
    out = {}
    for i, host, text in rows:
        n, _, _, _, repeat = measures[i]
        base = n < 10 or 100 * repeat > 20 * n
        out[i] = (*measures[i], base, host in rejected, not base and host not in rejected)
    return out


def hosted(seed: int = 4) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        host = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "junk", "tiny", None])
        good = " ".join(f"w{rng.randrange(1000)}" for _ in range(rng.randrange(10, 40)))
        bad = rng.choice(["# # # # # # # # # # # #", "one two", "same line\n" * 12, "a b c d e " * 9])
        share = {"junk": 0.9, "hot": 0.1}.get(host, 0.2)
        rows.append((i, host, bad if rng.random() < share else good))
    rows += [(300, "lone", "too few"), (301, "lone2", None), (302, "a", "")]
    return rows


def test_verdicts_are_those_of_brute_force(spark):
    rows = hosted()
    df = spark.createDataFrame(rows, "id long, host string, text string").repartition(4)
    found = {r[0]: tuple(r)[2:] for r in host_rules.judge(df, "text", "host").collect()}
    expected = judged_brute(rows)
    assert found == expected
    hosts = {h: {expected[i][-2] for i, host, _ in rows if host == h} for h in ("junk", "hot", "lone", None)}
    # One short text says little about a host: it is shrunk to the rest.
    assert hosts == {"junk": {True}, "hot": {False}, "lone": {False}, None: {False}}


def test_host_join_without_broadcast(spark, force_shuffle):
    rows = hosted(5)
    df = spark.createDataFrame(rows, "id long, host string, text string")
    assert {r[0]: tuple(r)[2:] for r in host_rules.judge(df, "text", "host").collect()} == judged_brute(rows)


def test_prior_recovers_the_spread():
    rng = np.random.default_rng(5)
    n = rng.integers(1, 60, 20_000)
    k = rng.binomial(n, rng.beta(2, 6, 20_000))
    prior = host_rules.beta_prior(len(n), n.sum(), (n * n).sum(), k.sum(), (k * k / n).sum())
    assert abs(prior.alpha - 2) < 0.15 and abs(prior.beta - 6) < 0.45
    assert host_rules.beta_prior(2, 10, 50, 0, 0) is None
    assert host_rules.beta_prior(1, 10, 100, 5, 2.5).alpha > 1e6  # one host: the rate of all


def test_judge_keeps_odd_rows_and_columns(spark):
    rows = [(*r, 7, "x", True, 1.5) for r in helpers.odd_documents()]
    df = spark.createDataFrame(rows, helpers.SCHEMA + ", n_words int, host string, kept boolean, row double")
    found = host_rules.judge(df, "text", "source")
    assert found.columns == [
        "doc_id", "lang", "source", "n_chars", "host", "row", *host_rules.MEASURES, "base_failed", "host_failed", "kept",
    ]
    got = Counter((r["doc_id"], r["host"], r["row"], *[r[m] for m in host_rules.MEASURES]) for r in found.collect())
    assert got == Counter((r[0], "x", 1.5, *brute_measures(r[1])) for r in rows)
    empty = host_rules.judge(df.limit(0), "text", "source")
    assert empty.collect() == [] and empty.columns == found.columns


# The source audit

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def brute_audit(rows, least=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate(helpers.ASCII_LOWER) for t in TERM.findall(text.encode())]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in docs.items()}
    groups = sorted({(lang, source) for _, lang, source in rows})

    def shares(counts, terms):
        total = sum(counts[t] for t in terms)
        return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(terms)) for t in terms}

    found = []
    for lang, source in groups:
        terms = kept.get(lang, [])
        p = shares(counts[lang, source], terms)
        pairs = []
        for other in (s for g, s in groups if g == lang and s != source):
            q = shares(counts[lang, other], terms)
            pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in terms), other.encode()))
        whole = shares(sum((counts[g] for g in groups if g[0] == lang), Counter()), terms)
        own = [(-((p[t] - whole[t]) ** 2 // whole[t]), t) for t in terms if counts[lang, source][t] and p[t] > whole[t]]
        for part, values, limit in (("pair", pairs, None), ("term", own, top)):
            found += [(lang, source, part, item.decode(), -v, i) for i, (v, item) in enumerate(sorted(values)[:limit], 1)]
    return sorted(found)


def audit_rows():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcÉé日") for _ in range(rng.choice([1, 3, 8, 9, 16, 17, 40]))) for _ in range(120)]
    rows = [(t, lang, source) for _, t, lang, source, _ in helpers.odd_documents()]
    for i in range(200):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(4)}"
        some = words[: 60 if source == "hot" else 120]
        rows.append((rng.choice([" ", "1", "-_-"]).join(rng.choices(some, k=rng.randrange(40))), rng.choice(["x", "y"]), source))
    return rows + [("", "z", "s0"), (None, "z", "s1"), ("lone words", "z", "s2"), ("abc", None, None), ("ABC", None, "s")]


def audited(spark, rows, **options):
    df = spark.createDataFrame([(1, "p", *r) for r in rows], "no int, part string, text string, lang string, source string")
    found = source_audit.audit(df.repartition(3), "text", "lang", "source", **options)
    return sorted(tuple(r) for r in found.collect())


def test_audit_is_that_of_brute_force(spark):
    rows = audit_rows()
    found = audited(spark, rows)
    assert found == brute_audit(rows)
    assert ("z", "s0", "pair", "s1", 0, 1) in found  # no kept terms: pairs of value 0
    assert audited(spark, rows, min_documents=1, top_terms=4) == brute_audit(rows, 1, 4)


def test_audit_in_small_units(spark, monkeypatch, force_shuffle):
    """Small shards, ranges and units, long texts in slices, no broadcast: the same rows."""
    for name, value in {"SHARD_BYTES": 500, "LEAF": 20, "CELLS": 12}.items():
        monkeypatch.setattr(source_audit, name, value)
    rows = audit_rows()
    assert audited(spark, rows) == brute_audit(rows)


def test_audit_of_nothing(spark):
    assert audited(spark, []) == []
    assert audited(spark, [(None, None, None)]) == []
    assert audited(spark, [("a a", "x", "s"), (None, "x", "t")]) == [("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)]


def test_large_counts_are_exact(spark):
    count, total = 7 * 10**12 + 1, 9 * 10**14 + 7
    row = spark.range(1).select(source_audit.share(F.lit(count), F.lit(total), F.lit(10**6))).first()
    assert row[0] == 1 + 10**9 * (count + 1) // (total + 10**6)


@pytest.mark.parametrize("leaf", [1 << 15, 40, 9])
def test_pointers_are_sorted(monkeypatch, leaf):
    monkeypatch.setattr(source_audit, "LEAF", leaf)
    rng = random.Random(leaf)
    words = ["".join(rng.choice("abÿ") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 30]))) for _ in range(300)]
    texts = [rng.choice([" ", "-", ""]).join(rng.choices(words, k=rng.randrange(60))).encode() for _ in range(50)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    starts, ends = source_audit.term_pointers(data, offsets)
    raw = data.tobytes()
    found = [raw[a:b] for a, b in zip(starts, ends)]
    assert found == [w for t in texts for w in TERM.findall(t)]
    order, new = source_audit.sort_pointers(data, starts, ends)
    ranked = [found[i] for i in order]
    assert ranked == sorted(found)
    assert new.tolist() == [i == 0 or ranked[i] != ranked[i - 1] for i in range(len(ranked))]
