"""Token counts, pieces, substrings, near duplicates and language model."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from nomina.llm import columns, minhash, ngram_trie, pieces, substrings, token_counts, words as llm_words
from nomina.llm.queries import QUERIES, piece_digests
from tests.llm import helpers

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(helpers.odd_documents(), helpers.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], helpers.SCHEMA)


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# words


def test_words_and_hashes():
    texts = [t for _, t, *_ in helpers.odd_documents()]
    seen = {}
    for part in llm_words.text_slices(pa.array(texts), 500):
        split = llm_words.split_words(part)
        hashes = llm_words.hash_words(part.data, split, fold=True)
        raw = part.data.tobytes()
        for i, text in enumerate(texts[part.first : part.last]):
            a, b = split.bounds[i], split.bounds[i + 1]
            found = [raw[split.starts[j] : split.ends[j]] for j in range(a, b)]
            assert found == helpers.words(text)
            for word, h in zip(helpers.lower_words(text), hashes[a:b].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_outputs_replace_columns_but_not_inputs(docs):
    assert columns.without(docs, ["LANG"], ["text"]).columns == ["doc_id", "text", "source", "n_chars"]
    with pytest.raises(ValueError):
        columns.without(docs, ["Text"], ["text"])


# token counts


def greedy(word: str, pieces_: set[str]) -> int | None:
    at = n = 0
    while at < len(word):
        end = next((j for j in range(len(word), at, -1) if word[at:j] in pieces_), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


def test_automaton_counts_as_the_greedy_search_does():
    rng = random.Random(3)
    for _ in range(400):
        found = {"".join(rng.choice("ab_") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 9))}
        automaton = token_counts.Automaton(sorted(found))
        for _ in range(20):
            word = "".join(rng.choice("ab_c") for _ in range(rng.randrange(12)))
            assert automaton.length(word) == greedy(word, found)


def test_token_counts_of_documents(docs, empty):
    known = set(token_counts.vocabulary(MODEL))
    counted = docs.select("text", token_counts.token_counts(F.col("text"), MODEL).alias("c"))
    for row in counted.collect():
        each = [greedy("▁" + w.decode(), known) for w in helpers.words(row["text"])]
        expected = (len(each), sum(1 if n is None else n for n in each), sum(n is None for n in each))
        assert tuple(row["c"]) == expected
    assert empty.select(token_counts.token_counts(F.col("text"), MODEL)).count() == 0


# pieces


def test_pieces_equal_the_library(docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coded = pieces.encode(docs.withColumn("IDS", F.lit(1)), "text", MODEL, "ids", "decoded")
    again = pieces.decode(coded.select("text", "ids"), "ids", MODEL, "back")
    for row in coded.collect():
        ids = model.encode(row["text"] or "")
        assert row["ids"] == ids and row["decoded"] == model.decode(ids)
    assert rows_of(again, "text", "back") == rows_of(coded, "text", "decoded")
    for row in piece_digests(coded).collect():
        ids = model.encode(row["text"] or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert pieces.encode(empty, "text", MODEL).count() == 0
    assert pieces.decode(docs.select(F.lit(None).cast("array<int>").alias("i")), "i", MODEL).first()["decoded"] == ""


def test_random_texts_and_a_full_table(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_BYTES", 1000)
    coder = pieces.ChunkCoder(MODEL)
    rng = random.Random(1)
    for _ in range(300):
        texts = ["".join(rng.choice(" ▁ab\n🙂é\x00Ω") for _ in range(rng.randrange(12))) for _ in range(5)]
        ids, lengths = coder.encode(texts)
        cuts = np.concatenate(([0], np.cumsum(lengths)))
        assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == coder.model.encode(texts)
        assert coder.decode(ids, lengths) == [coder.model.decode(i) for i in coder.model.encode(texts)]


# substrings


def brute_cut(rows: list[tuple], width: int = 13) -> dict:
    least: dict = {}
    for key, text in rows:
        split = helpers.words(text)
        for i in range(len(split) - width + 1):
            if key is not None:
                window = tuple(split[i : i + width])
                least[window] = min(least.get(window, key), key)
    out = {}
    for key, text in rows:
        split = helpers.words(text)
        gone = set()
        for i in range(len(split) - width + 1):
            if key is not None and least[tuple(split[i : i + width])] < key:
                gone.update(range(i, i + width))
        kept = b" ".join(w for i, w in enumerate(split) if i not in gone).decode()
        out[key, text] = (len(split), len(gone), kept)
    return out


def test_repeats_are_cut(docs, empty, monkeypatch):
    expected = brute_cut([r[:2] for r in helpers.odd_documents()])
    assert any(v[1] for v in expected.values())
    for load, bucket in ((2_000_000, 16 << 20), (50, 2_000)):
        monkeypatch.setattr(substrings, "LOAD_WINDOWS", load)
        monkeypatch.setattr(substrings, "BUCKET_BYTES", bucket)
        cut = substrings.cut_repeats(docs.withColumn("spans", F.lit("x")), "doc_id", "text").collect()
        assert len(cut) == len(helpers.odd_documents())
        for row in cut:
            assert (row["n_words"], row["n_removed"], row["kept_text"]) == expected[row["doc_id"], row["text"]]
    assert substrings.cut_repeats(empty, "doc_id", "text").count() == 0


def test_windows_of_a_load_are_sent_once():
    """Against brute force, with many equal windows of the same and of other keys."""
    rng = np.random.default_rng(4)
    for size, kinds in ((1, 1), (300, 9), (300, 1), (300, 200)):
        hashes = rng.integers(0, kinds, size).astype(np.uint64)
        keys = np.sort(rng.integers(0, 20, size))
        found, sent, late, others, stand = substrings.one_of_each(hashes, keys)
        least = {h: keys[hashes == h].min() for h in set(hashes.tolist())}
        assert found.tolist() == sorted(least) and hashes[sent].tolist() == found.tolist()
        assert keys[sent].tolist() == [least[h] for h in sorted(least)]
        assert sorted(late) == [i for i in range(size) if keys[i] > least[hashes[i]]]
        assert sorted([*sent, *late, *others]) == list(range(size))
        assert (hashes[others] == hashes[stand]).all() and (keys[others] == keys[stand]).all()
        assert set(stand.tolist()) <= set(sent.tolist())


def test_a_hot_window_has_one_entry_per_load(spark, monkeypatch):
    """A passage in every document, several times in some, in many loads."""
    shared = helpers.prose(9, 15)
    rows = [(k, " ".join([helpers.prose(100 + k, k % 5), shared, "x", *([shared] if k % 3 else [])])) for k in range(3, 90)]
    expected = brute_cut(rows)
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    for load, bucket in ((100_000, 4 << 20), (200, 500), (1, 100)):
        monkeypatch.setattr(substrings, "LOAD_WINDOWS", load)
        monkeypatch.setattr(substrings, "BUCKET_BYTES", bucket)
        cut = substrings.cut_repeats(df, "k", "t").collect()
        assert {(r["k"], r["t"]): (r["n_words"], r["n_removed"], r["kept_text"]) for r in cut} == expected
    monkeypatch.setattr(substrings, "LOAD_WINDOWS", 200)
    rows_sent = df.select("k", F.hash("t"), "t").mapInArrow(substrings._pack_windows(13, 1), substrings.PACKED).collect()
    for row in rows_sent:
        if row["bucket"] >= 0:
            hashes = substrings.unpack_planes(row["hashes"])
            assert len(set(hashes.tolist())) == len(hashes)


def test_texts_with_one_key_do_not_mix(spark):
    shared = helpers.prose(9, 20)
    rows = [(1, shared), (5, shared + " a"), (5, "b " + shared), (5, helpers.prose(10, 50))]
    cut = substrings.cut_repeats(spark.createDataFrame(rows, "k long, t string"), "k", "t")
    expected = brute_cut(rows)
    assert {(r["k"], r["t"]): (r["n_words"], r["n_removed"], r["kept_text"]) for r in cut.collect()} == expected


def test_repeated_rows_of_a_later_copy_stay_as_they_are(spark, monkeypatch):
    shared = helpers.prose(9, 20)
    rows = [(1, shared), (5, shared + " a"), (5, shared + " a"), (5, shared + " a"), (6, shared)]
    expected = brute_cut(rows)
    for load in (500_000, 1):
        monkeypatch.setattr(substrings, "LOAD_WINDOWS", load)
        cut = substrings.cut_repeats(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()
        assert sorted((r["k"], r["t"]) for r in cut) == sorted(rows)
        assert all((r["n_words"], r["n_removed"], r["kept_text"]) == expected[r["k"], r["t"]] for r in cut)


# near duplicates


def shingles(text: str | None, width: int) -> frozenset:
    split = helpers.lower_words(text)
    if not split:
        return frozenset()
    return frozenset(tuple(split[i : i + width]) for i in range(max(1, len(split) - width + 1)))


def brute_near(rows: list[tuple], width: int) -> dict:
    sets = [(k, shingles(t, width)) for k, t in rows if k is not None]
    links = [
        (a, b)
        for i, (a, s) in enumerate(sets)
        for b, t in sets[:i]
        if s and t and 100 * len(s & t) >= 80 * len(s | t)
    ]
    return helpers.reach([k for k, _ in sets], links)


def test_near_duplicates(spark, docs, empty):
    rows = [r[:2] for r in helpers.odd_documents()]
    for width in (2, 5):
        roots = brute_near(rows, width)
        found = minhash.near_duplicates(docs, "doc_id", "text", width).collect()
        assert len(found) == len(rows)
        assert sorted((r["n_shingles"] for r in found)) == sorted(len(shingles(t, width)) for _, t in rows)
        for row in found:
            root = roots.get(row["doc_id"])
            assert row["component_id"] == root and row["kept"] == (root == row["doc_id"])
    assert minhash.near_duplicates(empty, "doc_id", "text").count() == 0


def near_copies(n: int, most: int) -> list[tuple]:
    """Copies of one text with up to ``most`` changed words, and of a half-similar one."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        split = helpers.prose(20 + i % 2, 110).split()
        if i % 2:
            split[:55] = helpers.prose(20, 110).split()[:55]
        for _ in range(rng.randrange(most)):
            split[rng.randrange(len(split))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(split)))
    return rows


@pytest.mark.parametrize("block", [1000, 20])
def test_a_hot_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_copies(160, 16)
    roots = brute_near(rows, 2)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "k long, t string"), "k", "t", 2)
    assert 3 < len(set(roots.values())) < 150
    assert {r["k"]: r["component_id"] for r in found.collect()} == roots


def test_estimates_are_close():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    errors = []
    for share in (0, 200, 600, 1000, 1500, 1900, 2000):
        one, two = hashes[:2000], hashes[2000 - share : 4000 - share]
        both = minhash.minima(np.concatenate([one, two]), np.array([0, 2000]))
        packed = minhash.signatures(both)
        true = share / (4000 - share)
        errors.append(minhash.estimate_rows(packed[0], packed[1:])[0] - true)
    assert np.abs(errors).max() < 0.15


def test_components_of_chains(spark):
    from nomina.llm.components import components

    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3)] + [(200, 300 + i) for i in range(50)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert {r["node"]: r["component"] for r in found} == helpers.reach(sorted({n for p in real for n in p}), real)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# language model


def test_elias_fano_keeps_any_monotone_sequence():
    rng = np.random.default_rng(5)
    for top in (1, 50, 2**20, 2**62):
        for n in (0, 1, 7, 500):
            values = np.sort(rng.integers(0, top, n).astype(np.uint64))
            stored = ngram_trie.EliasFano(ngram_trie.EliasFano.encode(values))
            assert (stored.values == values).all()
            if n:
                at, found = stored.find(values)
                assert found.all() and (stored.values[at] == values).all()
                missing = np.setdiff1d(rng.integers(0, top + 5, 50).astype(np.uint64), values)
                assert not stored.find(missing)[1].any()


def brute_lm(train: list, texts: list, size: int) -> list[tuple]:
    end, single, pairs, before = b"</s>\n", Counter(), Counter(), Counter()
    for text in train:
        split = helpers.lower_words(text) + [end]
        single.update(split)
        pairs.update(zip([b""] + split, split))
        before.update(([b""] + split)[:-1])
    n, v = sum(single.values()), len(single)
    mass = n + 0.1 * (v + 1)
    weight = 1000.0 / max(1, size / 6)
    out = []
    for text in texts:
        split = helpers.lower_words(text) + [end]
        base = sum(math.log10((single[w] + 0.1) / mass) for w in split)
        score = sum(
            math.log10((pairs[c, w] + weight * (single[w] + 0.1)) / (before[c] + weight * mass))
            for c, w in zip([b""] + split, split)
        )
        out.append((len(split), sum(single[w] > 0 for w in split), base, score))
    return out


@pytest.mark.parametrize("load,bucket", [(2_000_000, 32 << 20), (40, 3_000)])
def test_language_model(docs, empty, monkeypatch, load, bucket):
    monkeypatch.setattr(ngram_trie, "LOAD_TOKENS", load)
    monkeypatch.setattr(ngram_trie, "BUCKET_BYTES", bucket)
    rows = helpers.odd_documents()
    learnt = [t for k, t, *_ in rows if k is not None and k % 4]
    size = sum(len((t or "").encode()) for t in learnt)
    model = ngram_trie.train(docs.where("doc_id % 4 <> 0"), "text")
    found = ngram_trie.score(docs, "doc_id", "text", model)
    expected = sorted(zip([r[0] for r in rows], brute_lm(learnt, [r[1] for r in rows], size)), key=repr)
    got = sorted(((r["doc_id"], tuple(r)[1:]) for r in found.collect()), key=repr)
    assert len(got) == len(expected)
    for (key, mine), (other, theirs) in zip(got, expected):
        assert key == other and mine[:2] == theirs[:2]
        assert mine[2] == pytest.approx(theirs[2], rel=1e-9)
        assert abs(mine[3] - theirs[3]) <= 0.02 * mine[0]
    assert ngram_trie.score(empty, "doc_id", "text", model).count() == 0
    nothing = ngram_trie.train(empty, "text")
    assert all(math.isfinite(r["score"]) for r in ngram_trie.score(docs, "doc_id", "text", nothing).collect())


def test_the_model_is_a_distribution():
    """The weights of all continuations of a word add up to its denominator."""
    texts = ["a b a c", "b a", "c c c a"]
    split = [t.split() + ["end"] for t in texts]
    single = Counter(w for s in split for w in s)
    pairs = Counter(p for s in split for p in zip(s, s[1:]))
    weight, mass = 0.7, sum(single.values()) + ngram_trie.A * (len(single) + 1)
    for c in "abc":
        total = sum(pairs[c, w] + weight * (single[w] + ngram_trie.A) for w in [*single, "unknown"])
        assert total == pytest.approx(single[c] + weight * mass)


def test_held_out_texts_are_better_predicted_than_by_single_words(spark):
    scored = QUERIES["op10_lm_scores"](spark, "/root/testdata/sf0.01").where("held_out")
    row = scored.agg(F.sum("score"), F.sum("base_score"), F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()
    assert row[0] > row[1] and row[2] > 0.9
