"""Small documents and brute-force versions that the tests compare with."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def lower_words(text: str | None) -> list[bytes]:
    return [w.translate(ASCII_LOWER) for w in words(text)]


def prose(seed: int, n: int, vocabulary: int = 300) -> str:
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)] + ["Ünder", "日本", "x▁y", "A,b."]
    return rng.choice([" ", "  ", "\n", "\t"]).join(rng.choice(names) for _ in range(n))


def odd_documents() -> list[tuple]:
    """Nulls, empty and blank texts, one word, a very long text, ties, copies,
    near copies, shared passages, repeated rows."""
    long = prose(1, 30_000, 5_000)
    base = prose(2, 120)
    near = base.split()
    near[50] = "changed"
    passage = prose(3, 60)
    texts = [
        None, "", "  \n\t ", "one", "One", "two words", long, base, base, " ".join(near), base.upper(),
        prose(4, 40) + " " + passage, passage + " " + prose(5, 30), prose(6, 20), "Und Und Und Und " * 20,
        "▁▁ a  b▁c \x00 é 💥 ", prose(7, 12), prose(7, 12), prose(8, 13),
    ]
    rows = [(i + 10, t, "en", ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    return rows + [(None, base, None, None, None), (None, None, "de", "", 0), rows[7], rows[2]]


def reach(nodes: list, links: list[tuple]) -> dict:
    """The smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
