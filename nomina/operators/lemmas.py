"""Dictionary forms of words the dictionary does not hold.

Endings are learnt from the dictionary: every word votes, for each of its last few
letters, for the change that leads to its lemma (letters to cut off, letters to add).
An unknown word follows its longest ending that enough words agree on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina.operators.terms import distinct_words
from nomina.operators.texts import MOST_TASKS
from nomina.scratch import attach, attach_by_weight, materialise

# Letters of the longest ending, words that must have it, letters left before it.
LONGEST, LEAST_WORDS, LEAST_STEM = 6, 3, 2
# Bytes of text whose words are looked up together.
BLOCK_BYTES = 4 << 20


def _common(a: Column, b: Column) -> Column:
    """Letters that both words begin with."""
    upto = F.least(F.length(a), F.length(b))
    places = F.filter(F.sequence(F.lit(0), upto), lambda i: F.substring(a, 1, i) == F.substring(b, 1, i))
    return F.array_max(places)


def _endings(word: Column, least: Column | int) -> Column:
    """The last ``least`` to LONGEST letters of a word that leave a stem before them."""
    longest = F.least(F.lit(LONGEST), F.length(word) - LEAST_STEM)
    first = F.lit(least) if isinstance(least, int) else least
    sizes = F.when(longest >= first, F.sequence(first, longest))
    return F.transform(sizes, lambda k: F.right(word, k))


def learn_endings(dictionary: DataFrame) -> DataFrame:
    """(ending, cut, tail, words, agree): what to do with words of an ending.

    ``dictionary`` has ``word`` and ``lemma``, both not null. ``words`` of it have the
    ending, ``agree`` of them the change given: the most frequent one, of equally
    frequent ones that with the shorter cut, then the first tail. Votes are combined
    before the shuffle, so an ending that most words have is no burden.
    """
    word, lemma = F.col("word"), F.col("lemma")
    known = dictionary.where("word IS NOT NULL AND lemma IS NOT NULL").select(
        "word", "lemma", _common(word, lemma).alias("_same")
    )
    changed = known.select(
        "word",
        (F.length("word") - F.col("_same")).alias("cut"),
        F.substring(lemma, F.col("_same") + 1, F.length("lemma")).alias("tail"),
    )
    votes = changed.select("cut", "tail", F.explode(_endings(word, F.greatest(F.col("cut"), F.lit(1)))).alias("ending"))
    counted = votes.groupBy("ending", "cut", "tail").agg(F.count("*").alias("agree"))
    best = F.min(F.struct(-F.col("agree"), "cut", "tail"))
    found = counted.groupBy("ending").agg(F.sum("agree").alias("words"), best.alias("_b"))
    return found.select("ending", "_b.cut", "_b.tail", "words", (-F.col("_b.col1")).alias("agree"))


def guess_lemmas(words: DataFrame, endings: DataFrame) -> DataFrame:
    """(word, lemma, ending) of distinct words by their longest ending that
    LEAST_WORDS words of the dictionary have; without one, lemma and ending are null."""
    usable = materialise(endings.where(F.col("words") >= LEAST_WORDS).select("ending", "cut", "tail"), "endings")
    parts = words.select("word", F.explode(_endings(F.col("word"), 1)).alias("ending"))
    met = attach(parts, usable, ["ending"])
    longest = met.groupBy("word").agg(F.max_by(F.struct("ending", "cut", "tail"), F.length("ending")).alias("_e"))
    stem = F.substring(F.col("word"), F.lit(1), F.length("word") - F.col("_e.cut"))
    guessed = longest.select("word", F.concat(stem, F.col("_e.tail")).alias("lemma"), F.col("_e.ending").alias("ending"))
    return words.select("word").join(guessed, "word", "left")


def lemma_table(words: DataFrame, dictionary: DataFrame, endings: DataFrame) -> DataFrame:
    """(word, lemma, source) of distinct words: ``dictionary``, ``ending`` or, with the
    word itself as lemma, ``unknown``. ``words`` is read twice."""
    known = words.select("word").join(dictionary.select("word", "lemma"), "word", "left")
    known = materialise(known, "known")
    guessed = guess_lemmas(known.where("lemma IS NULL"), endings).select(
        "word",
        F.coalesce("lemma", "word").alias("lemma"),
        F.when(F.col("lemma").isNull(), "unknown").otherwise("ending").alias("source"),
    )
    looked_up = known.where("lemma IS NOT NULL").select("word", "lemma", F.lit("dictionary").alias("source"))
    return looked_up.unionByName(guessed)


def _words_of(texts: pa.ChunkedArray) -> Iterator[list[str]]:
    return ([word for word in text.split(" ") if word] if text else [] for text in texts.to_pylist())


def _with_lemmas(names: list[str]):
    def run(texts: pa.Table, changed: pa.Table) -> pa.Table:
        lemma = dict(zip(changed["word"].to_pylist(), changed["lemma"].to_pylist()))
        done = [" ".join(lemma.get(word, word) for word in words) for words in _words_of(texts["_clean"])]
        return pa.table([texts["_key"], pa.array(done, pa.string())], names=names)

    return run


def _with_lemmas_by_key(names: list[str]):
    each_row = _with_lemmas(names)

    def run(texts: pa.Table, changed: pa.Table) -> pa.Table:
        keys = texts["_key"].combine_chunks().dictionary_encode(null_encoding="encode")
        if len(keys.dictionary) == len(keys):
            return each_row(texts, changed)
        # Rows of one key: all words by position, then in order of their lemmas.
        lemma = dict(zip(changed["word"].to_pylist(), changed["lemma"].to_pylist()))
        placed = [[] for _ in range(len(keys.dictionary))]
        for key, words in zip(keys.indices.to_pylist(), _words_of(texts["_clean"])):
            placed[key] += [(i, lemma.get(word, word)) for i, word in enumerate(words)] or [(0, "")]
        done = [" ".join(word for _, word in sorted(words)) for words in placed]
        return pa.table([keys.dictionary, pa.array(done, pa.string())], names=names)

    return run


def _blocks(df: DataFrame, key: str, clean: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts dealt by key into blocks of BLOCK_BYTES, as (_block, _key, _clean), the
    (_block, word) of their words and (word, _uses), the number of blocks."""
    size = df.agg(F.sum(F.octet_length(clean).cast("long"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block")
    dealt = df.select(block, F.col(key).alias("_key"), F.col(clean).alias("_clean"))
    # Written by block, so a task that reads a block combines its words before they move.
    texts = materialise(dealt.repartition(min(blocks, MOST_TASKS), "_block"), "texts")
    pairs = materialise(distinct_words(texts, "_clean", "_block"), "pairs")
    return texts, pairs, materialise(pairs.groupBy("word").agg(F.count("*").alias("_uses")), "uses")


def _replace(texts: DataFrame, pairs: DataFrame, lemmas: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """Words of the blocks replaced by ``run``, given (word, lemma, _uses) as a written
    table of the words that change: only they come back to the blocks."""
    changed = attach_by_weight(pairs, lemmas, "word", "_uses")
    both = texts.groupBy("_block").cogroup(changed.select("_block", "word", "lemma").groupBy("_block"))
    return both.applyInArrow(run(schema.names), schema)


def _schema(df: DataFrame, key: str, out: str) -> T.StructType:
    return T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(out, T.StringType())])


def lemma_normalize(df: DataFrame, key: str, clean: str, dictionary: DataFrame, out: str = "lemmas") -> DataFrame:
    """Replace each word by its dictionary form: (key, out).

    ``key`` identifies a row, ``dictionary`` has unique ``word`` and ``lemma``;
    unknown words stay. Texts are dealt and looked up as by ``lemmatise``. Rows that
    share a key become one: their words by position, then in order of their lemmas.
    """
    texts, pairs, uses = _blocks(df, key, clean)
    found = uses.join(dictionary.select("word", "lemma"), "word").where("lemma <> word")
    return _replace(texts, pairs, materialise(found, "lemmas"), _with_lemmas_by_key, _schema(df, key, out))


def lemmatise(
    df: DataFrame, key: str, clean: str, dictionary: DataFrame, endings: DataFrame | None = None, out: str = "lemmas"
) -> DataFrame:
    """Replace each word by its lemma, guessed where the dictionary lacks it: (key, out).

    ``dictionary`` has unique ``word`` and ``lemma``. Texts are dealt by key into blocks
    of BLOCK_BYTES; only the distinct words of a block are looked up, joined by weight,
    and only those that change come back to it, so a word has at most one row per block
    however often it occurs. Rows without words, and null texts, get the empty text.
    """
    dictionary = materialise(dictionary.select("word", "lemma"), "dictionary")
    texts, pairs, uses = _blocks(df, key, clean)
    table = lemma_table(uses, dictionary, learn_endings(dictionary) if endings is None else endings)
    found = table.select("word", "lemma").where("lemma <> word").join(uses, "word")
    return _replace(texts, pairs, materialise(found, "lemmas"), _with_lemmas, _schema(df, key, out))
