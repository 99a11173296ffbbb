"""Words and five-word shingles of texts as hashes, for the near-duplicate operators."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from ledgerloom.llm.stage import utf8

SHINGLE = 5
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions in UTF-8 where the words of a text start and end."""
    white = _WHITE[np.frombuffer(text.encode(), np.uint8)]
    edge = np.flatnonzero(np.diff(white.astype(np.int8), prepend=1, append=1))
    return edge[::2], edge[1::2]


def word_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (lower case, between ASCII white space) of all texts, and
    the bounds of each text's words. Each distinct word is hashed once."""
    data, offsets = utf8(pc.utf8_lower(texts))
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    white = _WHITE[data]
    start = ~white
    start[1:] &= white[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    start[firsts] = ~white[firsts]
    cut = start.copy()
    cut[1:] |= white[1:] & ~white[:-1]  # where white space begins
    cut[firsts] = True
    at = np.flatnonzero(cut)
    bounds = np.append(at, len(data)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    words = pieces.filter(pa.array(start[at]))
    coded = words.dictionary_encode()
    table = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    hashes = table[coded.indices.to_numpy()] if len(table) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(np.flatnonzero(start), offsets)


@lru_cache(maxsize=1)
def _powers() -> list[np.uint64]:
    return [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(SHINGLE)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all five-word windows of a sequence of words."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, p in enumerate(_powers()):
        total += words[k : k + n] * p
    return mix(total)
