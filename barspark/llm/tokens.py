"""Words of text batches as numbers, for operators that work on Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of the splitmix generator)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hashes of words; equal words get equal hashes in every task."""
    if not words:
        return np.empty(0, _U)
    a = np.empty(len(words), object)
    a[:] = words
    return pd.util.hash_array(a, categorize=True)


def split(text) -> list[bytes]:
    """Words of a text (None has none): bytes.split cuts at U+0020 and U+0009 to U+000D, as the contract does."""
    return text.encode().split() if text else []


def lower_split(text) -> list[bytes]:
    """The same with A-Z lower-cased; bytes.lower leaves all other characters as they are."""
    return text.encode().lower().split() if text else []


class Ranges:
    """Hashes of any range of a number sequence, from one pass of prefix sums modulo 2**64."""

    def __init__(self, h: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        n = len(h)
        power = np.empty(n + 1, _U)
        power[0], power[1:] = 1, _U(base)
        self.power = np.multiply.accumulate(power)
        inverse = np.empty(n + 1, _U)
        inverse[0], inverse[1:] = 1, _U(pow(base, -1, 1 << 64))
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.concatenate([np.zeros(1, _U), np.add.accumulate(h * self.power[:n], dtype=_U)])

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [first, end), the length included."""
        return mix((self.sums[end] - self.sums[first]) * self.inverse[first] + (end - first).astype(_U) * _U(0xD6E8FEB86659FD93))


def stretches(texts, most: int, words=split):
    """Cut an Arrow column of texts into stretches of about ``most`` words: (first, end, word lists).

    Only the words of one stretch are held at a time, however many texts a batch has."""
    lists, first, n = [], 0, 0
    for i, t in enumerate(texts):
        x = words(t.as_py())
        if n and n + len(x) > most:
            yield first, i, lists
            lists, first, n = [], i, 0
        lists.append(x)
        n += len(x) + 1
    if lists:
        yield first, first + len(lists), lists
