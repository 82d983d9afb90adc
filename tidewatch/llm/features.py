"""Hashed word and character n-gram features of words, computed once per distinct word.

A document's features are those of its words together. Every sum over them is a sum over words of
a value that belongs to the word alone, so a word met again costs one lookup.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Words are runs of anything but the six ASCII white-space characters, which bytes.split() cuts at.
SIZES = (3, 4, 5)
CACHE_WORDS = 150_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The top bits of multiplied hashes; bucket 0 and 1 are kept for markers."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * _MIX
    found = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    return np.maximum(found, 2)


def word_features(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of each feature, grouped by nothing, and each word's own hash."""
    own = np.fromiter((zlib.crc32(w) for w in words), np.uint64, len(words))
    marked = "".join(["<" + w.decode("utf-8", "replace") + ">" for w in words])
    letters = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.fromiter((len(w.decode("utf-8", "replace")) + 2 for w in words), np.int64, len(words))
    of_word = np.repeat(np.arange(len(words)), lengths)
    numbers, buckets = [np.arange(len(words))], [_bucket(own * np.uint64(0x100000001B3) + np.uint64(7), bits)]
    with np.errstate(over="ignore"):
        for size in SIZES:
            n = len(letters) - size + 1
            if n <= 0:
                continue
            inside = np.flatnonzero(of_word[:n] == of_word[size - 1 : size - 1 + n])
            h = np.full(len(inside), size, np.uint64)
            for j in range(size):
                h = h * np.uint64(1000003) + letters[inside + j]
            numbers.append(of_word[inside])
            buckets.append(_bucket(h, bits))
    return np.concatenate(numbers), np.concatenate(buckets), own


class WordTable:
    """For each known word: the sum of its features' weights, their count, and the word's hash."""

    def __init__(self, weights: np.ndarray, bits: int, limit: int = CACHE_WORDS):
        self.weights, self.bits, self.limit = weights, bits, limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.sums = np.zeros(0)
        self.counts = np.zeros(0, np.int64)
        self.hashes = np.zeros(0, np.uint64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Rows of the words; earlier rows are void if the table was full and began anew."""
        if len(self.index) > self.limit:
            self._clear()
        new = list(set(words).difference(self.index))
        if new:
            new.sort()
            of, bucket, own = word_features(new, self.bits)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.sums = np.concatenate([self.sums, np.bincount(of, self.weights[bucket], len(new))])
            self.counts = np.concatenate([self.counts, np.bincount(of, minlength=len(new))])
            self.hashes = np.concatenate([self.hashes, own])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


def repeats(words: list[bytes], near: int = 8) -> int:
    """How many words equal one of the few words before them."""
    if len(words) < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    return int(near_repeats(a, near).sum())


def near_repeats(a: np.ndarray, near: int = 8) -> np.ndarray:
    hit = np.zeros(len(a), bool)
    for d in range(1, min(near, len(a) - 1) + 1):
        hit[d:] |= a[d:] == a[:-d]
    return hit


def pair_buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of the pairs of neighbouring words."""
    with np.errstate(over="ignore"):
        return _bucket(hashes[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[1:] * np.uint64(0x165667B19E3779F9), bits)


def document_features(words: list[bytes], bits: int, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and how often each occurs; marker 1 counts near repeats."""
    if not words:
        return np.array([0], np.int32), np.array([1], np.float32)
    table = sorted(set(words))
    row = {w: i for i, w in enumerate(table)}
    a = np.fromiter(map(row.__getitem__, words), np.int64, len(words))
    of, bucket, own = word_features(table, bits)
    often = np.bincount(a, minlength=len(table))
    all_buckets, all_counts = [bucket], [often[of].astype(np.float64)]
    repeated = int(near_repeats(a).sum())
    if repeated:
        all_buckets.append(np.array([1]))
        all_counts.append(np.array([REPEAT_WEIGHT * repeated], np.float64))
    if pairs and len(a) > 1:
        p = pair_buckets(own[a], bits)
        all_buckets.append(p)
        all_counts.append(np.ones(len(p)))
    found, inverse = np.unique(np.concatenate(all_buckets), return_inverse=True)
    return found.astype(np.int32), np.bincount(inverse, np.concatenate(all_counts)).astype(np.float32)


#: A repeated word counts as so many features, about as many as its character n-grams.
REPEAT_WEIGHT = 10
