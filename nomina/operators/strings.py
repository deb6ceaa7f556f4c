"""Many strings looked for in many texts at once, inside Arrow tasks.

Texts are searched as bytes. Of each string eight bytes are chosen, those that the fewest
strings share (all of it where it is shorter). The eight bytes at every place of a text are
one number, which is looked up among those; where it is found, the strings that it stands
for are compared as a whole. So a place costs the same however many strings there are, and
nothing is told by a hash alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of a window, places looked up and pairs of place and string compared at a time.
WIDTH, PLACES, PAIRS = 8, 1 << 18, 1 << 20
# Spreads windows over the slots of a table, of which there are so many for a window.
FACTOR, SLOTS = np.uint64(0x9E3779B97F4A7C15), 16


def _number(part: bytes) -> int:
    return int.from_bytes(part, "little")


class _Windows:
    """The windows of one width, and the strings that each stands for."""

    def __init__(self, width: int, windows: list[int], strings: list[int]):
        self.mask = np.uint64((1 << 8 * width) - 1)
        order = np.argsort(np.array(windows, np.uint64), kind="stable")
        self.keys, self.starts, self.counts = np.unique(
            np.array(windows, np.uint64)[order], return_index=True, return_counts=True
        )
        self.strings = np.array(strings)[order]
        bits = max(10, (SLOTS * len(self.keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self._slots(self.keys)] = True

    def _slots(self, numbers: np.ndarray) -> np.ndarray:
        return ((numbers * FACTOR) >> self.shift).view(np.int64)

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose window is one of these, and its position among them."""
        numbers = numbers & self.mask
        place = np.flatnonzero(self.table[self._slots(numbers)])
        key = np.minimum(np.searchsorted(self.keys, numbers[place]), len(self.keys) - 1)
        same = self.keys[key] == numbers[place]
        return place[same], key[same]

    def pairs(self, place: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each place with each string of its window, about PAIRS at a time."""
        many = self.counts[key]
        cuts = np.searchsorted(np.cumsum(many), np.arange(PAIRS, many.sum(), PAIRS))
        for some, its, n in zip(np.split(place, cuts), np.split(key, cuts), np.split(many, cuts)):
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(some, n), self.strings[np.repeat(self.starts[its], n) + within]


class Strings:
    """Distinct strings, none of them empty, that are looked for in texts."""

    def __init__(self, strings: list[str]):
        data = [s.encode() for s in strings]
        uses = Counter(w for b in data for w in {b[o : o + WIDTH] for o in range(len(b) - WIDTH + 1)})
        anchors, by_width, words, offsets, first = [], {}, [], [], [0]
        for i, b in enumerate(data):
            last = max(0, len(b) - WIDTH)
            anchors.append(min(range(last + 1), key=lambda o: uses[b[o : o + WIDTH]]))
            windows, owners = by_width.setdefault(min(WIDTH, len(b)), ([], []))
            windows.append(_number(b[anchors[-1] : anchors[-1] + WIDTH]))
            owners.append(i)
            places = [*range(0, last, WIDTH), last]
            offsets += places
            words += [_number(b[o : o + WIDTH]) for o in places]
            first.append(len(words))
        self.windows = [_Windows(width, *found) for width, found in sorted(by_width.items())]
        self.anchors, self.lengths = np.array(anchors, np.int64), np.array([len(b) for b in data], np.int64)
        self.masks = np.array([(1 << 8 * min(WIDTH, len(b))) - 1 for b in data], np.uint64)
        # Words of eight bytes that make up each string; the last two may overlap.
        self.words, self.offsets, self.first = np.array(words, np.uint64), np.array(offsets), np.array(first)

    def _confirmed(self, numbers: np.ndarray, ends: np.ndarray, place: np.ndarray, string: np.ndarray):
        """(text, string) of the pairs whose whole string is there, within one text."""
        start, text = place - self.anchors[string], np.searchsorted(ends, place, side="right") - 1
        good = (start >= ends[text]) & (start + self.lengths[string] <= ends[text + 1])
        start, text, string = start[good], text[good], string[good]
        most = np.diff(self.first).max(initial=0)
        for k in range(most):
            word = np.minimum(self.first[string] + k, self.first[string + 1] - 1)
            good = numbers[start + self.offsets[word]] & self.masks[string] == self.words[word]
            start, text, string = start[good], text[good], string[good]
        return text, string

    def found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, string), positions, each pair once and in order: which texts hold which
        strings. A null holds none."""
        texts = pc.fill_null(texts, "")
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
        size, pairs = int(ends[-1] - ends[0]), [np.empty(0, np.int64)]
        raw = np.zeros(size + WIDTH, np.uint8)
        if size:
            raw[:size] = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
        ends -= ends[0]
        numbers = np.ndarray((size + 1,), "<u8", raw, strides=(1,))
        for windows in self.windows:
            for at in range(0, size, PLACES):
                place, key = windows.places(numbers[at : min(size, at + PLACES)])
                for some in windows.pairs(place + at, key):
                    text, string = self._confirmed(numbers, ends, *some)
                    pairs.append(np.unique(text * len(self.anchors) + string))
        return np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.anchors)))
