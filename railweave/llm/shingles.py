"""Sets of word shingles of whole texts, as sorted 64-bit hashes, and their MinHash values.

Works on a column of texts at a time: bytes are classified by table, words and shingles are hashed by
running sums modulo 2 ** 64, and only the last step, the distinct values, goes text by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a longer text is hashed on its own.
CHUNK = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_numbers(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed << 32))


class Shingles:
    """Hashes texts into sets of shingles of ``size`` words. Words are runs of anything but ASCII white
    space, A-Z lower-cased."""

    def __init__(self, size: int = 5) -> None:
        self.size = size
        codes = np.arange(256)
        codes[65:91] += 32
        self.byte_values = random_numbers(256, 1)[codes]
        self.space = np.zeros(256, dtype=bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.byte_values[self.space] = 0
        self.base = int(random_numbers(1, 2)[0]) | 1
        self.weights = random_numbers(size, 3) | np.uint64(1)
        self.tags = random_numbers(size + 1, 4)
        self._room(1 << 16)

    def _room(self, n: int) -> None:
        """Powers of the base and of its inverse, up to ``n``."""

        def powers(x: int) -> np.ndarray:
            steps = np.full(n, x, dtype=np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        self.powers, self.inverse = powers(self.base), powers(pow(self.base, -1, 1 << 64))

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the number of words in each text."""
        inside = ~self.space[data]
        # A text's first byte begins a word unless it is blank, whatever stands before it.
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = starts[starts < ends]
        begins[first] = inside[first]
        word_starts = np.flatnonzero(begins)
        per_text = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
        if not len(word_starts):
            return np.empty(0, dtype=np.uint64), per_text
        if len(data) > len(self.powers):
            self._room(1 << len(data).bit_length())
        sums = np.add.reduceat(self.byte_values[data] * self.powers[: len(data)], word_starts)
        lengths = np.add.reduceat(inside.astype(np.uint64), word_starts)
        return mixed(sums * self.inverse[word_starts] + lengths), per_text

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Per text the sorted distinct hashes of its shingles; null counts as empty.

        A text with fewer words than a shingle has its whole sequence as one, without words none.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        size, at = self.size, 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
            low, high = int(offsets[at]), int(offsets[to])
            words, counts = self._words(data[low:high], offsets[at:to] - low, offsets[at + 1 : to + 1] - low)
            padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
            whole = np.full(len(words), self.tags[size])
            for k in range(size):
                whole += self.weights[k] * padded[k : k + len(words)]
            whole = mixed(whole)
            place = 0
            for count in counts.tolist():
                if count >= size:
                    yield np.unique(whole[place : place + count - size + 1])
                elif count:
                    parts = self.weights[:count] * words[place : place + count]
                    yield mixed(parts.sum(dtype=np.uint64, keepdims=True) + self.tags[count])
                else:
                    yield words[:0]
                place += count
            at = to


class MinHash:
    """``n`` MinHash values of 32 bits."""

    def __init__(self, n: int, seed: int = 11) -> None:
        self.factors, self.shifts = random_numbers(n, seed) | np.uint64(1), random_numbers(n, seed + 1)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(hashes), 4096):
            values = hashes[i : i + 4096, None] * self.factors + self.shifts
            np.minimum(least, values.min(axis=0), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)
