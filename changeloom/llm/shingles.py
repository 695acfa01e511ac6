"""Sets of word shingles as 64-bit hashes, for many texts at once.

Words are hashed by keyed BLAKE2b, so no texts can be made up whose words collide; a shingle's hash is a mix of its words' hashes. Comparing sets is comparing these
64-bit hashes: two different shingles of one pair of texts agree by chance once in 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b
from itertools import chain

import numpy as np

#: Bytes of text that are hashed together; bounds the memory of the temporary arrays.
STRETCH = 1 << 20
#: Words whose hashes are kept, and the longest of them.
MEMO, LONGEST = 200_000, 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """word -> its hash, through a bounded memo."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(blake2b(word, digest_size=8, key=b"words of shingles").digest(), "little")
        if len(word) <= LONGEST:
            if len(self) >= MEMO:
                self.clear()
            self[word] = value
        return value


_hashes = _Hashes()


def portions(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Stretches [from, to) of items whose sizes add up to no more than ``most``, or that are one item."""
    at = 0
    while at < len(sizes):
        end, size = at + 1, sizes[at]
        while end < len(sizes) and size + sizes[end] <= most:
            size += sizes[end]
            end += 1
        yield at, end
        at = end


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingle hashes, sorted within each text, and where each text's begin (one more than texts)."""
    parts = [_stretch(texts[a:b], width) for a, b in portions([len(t) + 1 for t in texts], STRETCH)]
    starts = np.zeros(len(texts) + 1, np.int64)
    if texts:
        np.cumsum(np.concatenate([c for _, c in parts]), out=starts[1:])
    return np.concatenate([v for v, _ in parts]) if parts else np.zeros(0, np.uint64), starts


def _stretch(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    words = [t.lower().split() for t in texts]  # of bytes: A-Z alone, and ASCII white space
    word_at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=word_at[1:])
    hashes = np.fromiter(chain.from_iterable(map(_hashes.__getitem__, w) for w in words), np.uint64, int(word_at[-1]))
    n = max(len(hashes) - width + 1, 0)
    runs = np.zeros(n, np.uint64)
    for k in range(width):
        runs = mix(runs * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n])
    out, counts = [], np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        a, b = word_at[i], word_at[i + 1]
        if b - a >= width:
            v = np.sort(runs[a : b - width + 1])
            v = v[np.concatenate(([True], v[1:] != v[:-1]))]
        elif b > a:
            v = np.full(1, b - a, np.uint64)  # the whole sequence, and its length
            for h in hashes[a:b]:
                v = mix(v * np.uint64(0xD6E8FEB86659FD93) + h)
        else:
            continue
        out.append(v)
        counts[i] = len(v)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), counts
