"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie whose nodes have failure links: where a node has no edge
for the next character, the longest pieces that its string is sure to begin with
are popped, and matching goes on from the node of what is left. How many pieces a
link pops is known beforehand, so a word's length in pieces is counted in one
pass over its characters, without building a piece and without stepping back.

A word begins with the vocabulary's space marker, pieces without it continue a
word. A word that pieces cannot cover counts as one unknown token.

Words that repeat are counted once per batch through a bounded table. No row is
moved. Edge cases: null and empty texts have no words and no tokens; words of any
length are read whole, each character once; input columns stay in place.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina.llm.words import text_slices

MARK = "▁"
# Distinct words kept.
TABLE_WORDS = 300_000
# An unknown word is one token, and one of these in the upper half of a sum.
_UNKNOWN = (1 << 32) + 1


class Automaton:
    """The trie of a vocabulary with failure links and popped-piece counts."""

    def __init__(self, pieces: list[str]):
        self.edges: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                following = self.edges[node].get(c)
                if following is None:
                    following = self.edges[node][c] = len(self.edges)
                    self.edges.append({})
                    whole.append(False)
                node = following
            whole[node] = node != 0
        # Failure -1: what has been read cannot be covered.
        self.failure, self.popped = [-1] * len(whole), [0] * len(whole)
        waiting = [0]
        for node in waiting:  # breadth first
            for c, child in self.edges[node].items():
                waiting.append(child)
                if whole[child]:
                    self.failure[child], self.popped[child] = 0, 1
                    continue
                back, count = self.failure[node], self.popped[node]
                while back >= 0 and c not in self.edges[back]:
                    count += self.popped[back]
                    back = self.failure[back]
                if back >= 0:
                    self.failure[child], self.popped[child] = self.edges[back][c], count

    def length(self, word: str) -> int | None:
        """Pieces of ``word`` (with its marker), or None where they do not cover it."""
        edges, failure, popped = self.edges, self.failure, self.popped
        node = count = 0
        for c in word:
            while (following := edges[node].get(c)) is None:
                count += popped[node]
                node = failure[node]
                if node < 0:
                    return None
            node = following
        while node > 0:
            count += popped[node]
            node = failure[node]
        return count if node == 0 else None


class _Counts(dict):
    """Token count of words, filled on demand and never larger than the bound."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        found = self.automaton.length(MARK + word.decode())
        count = _UNKNOWN if found is None else found
        if len(self) < TABLE_WORDS:
            self[word] = count
        return count


def vocabulary(model_path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(len(model))
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [model.id_to_piece(i) for i in ids if not any(test(i) for test in special)]


@cache
def _automaton(model_path: str) -> Automaton:
    return Automaton(vocabulary(model_path))


COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_tokens", "n_unknown")])


def token_counts(text: Column, model_path: str) -> Column:
    """A struct (n_words, n_tokens, n_unknown) for each text.

    ``model_path`` must be readable on every executor, as an installed package
    or a shared file is.
    """

    def count(texts: pa.Array) -> pa.Array:
        table = _Counts(_automaton(model_path))
        words, sums = [], []
        for part in text_slices(texts):
            raw, offsets = part.data.tobytes(), part.offsets.tolist()
            for a, b in zip(offsets, offsets[1:]):
                split = raw[a:b].split()
                words.append(len(split))
                sums.append(sum(map(table.__getitem__, split)))
        total = np.array(sums, np.int64)
        columns = [np.array(words, np.int64), total & ((1 << 32) - 1), total >> 32]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=[pa.field(n, pa.int64()) for n in COUNTS.names])

    return F.arrow_udf(count, COUNTS)(text)
