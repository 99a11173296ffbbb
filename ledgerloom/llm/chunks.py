"""Tables of distinct chunks: a text is cut where no token can cross, each distinct chunk is
encoded once, and the ids return to their places by position.

A table belongs to one Python worker and is kept from task to task, at most
twice ``TABLE_ENTRIES`` chunks of it; which chunks are kept costs time, not results.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

from ledgerloom.llm.stage import utf8

TABLE_ENTRIES = 1 << 18
LONG_CHUNK = 4096  # bytes; longer chunks are encoded but not kept

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True


def _unicode_space_before(data: np.ndarray) -> np.ndarray:
    """For each byte but the first two: may the character that ends before it be white space
    beyond ASCII? Never a false no; a false yes only makes a chunk longer."""
    last, second = data[1:-1], data[:-2]
    return (last >= 128) & ((second == 0xC2) | (second == 0x80) | (second == 0x81) | (second == 0x9A))


def cut_words(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Chunks for BPE with word-like pre-tokens, and the first chunk of each text.

    Cuts: before a run of ASCII white space that follows something else, and between an
    ASCII letter and one of ``.,;:!?``. No pre-token of the two BPE files reaches over
    such a place, and what follows it doesn't depend on what is before.
    """
    data, offsets = utf8(texts)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        space = _SPACE[data]
        cut[1:-1] = (space[1:] & ~space[:-1]) | (_STOP[data[1:]] & _LETTER[data[:-1]])
        cut[2:-1] &= ~_unicode_space_before(data)
    return _cut(data, offsets, cut)


def cut_spaces(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Chunks for pieces that only start with markers: cuts before each run of spaces.

    A text's own U+2581 is a marker like those that spaces become, so a run of spaces that
    follows one goes on with its run of markers and isn't cut off.
    """
    data, offsets = utf8(texts)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
        cut[3:-1] &= ~((data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81))
    return _cut(data, offsets, cut)


def _cut(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    cut[offsets] = True
    starts = np.flatnonzero(cut).astype(np.int32)
    chunks = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))
    return chunks, np.searchsorted(starts, offsets)


class ChunkTable:
    """Values (bytes) of distinct chunks in two generations of at most ``entries`` each: when
    the younger is full it becomes the older, and chunks seen again move to the younger."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], entries: int = TABLE_ENTRIES):
        self._encode, self._entries = encode, entries
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def values(self, chunks: list[str]) -> list[bytes]:
        """Values of distinct chunks."""
        young, old = self._young, self._old
        found = [young.get(c) or old.get(c) for c in chunks]
        missing = [c for c, v in zip(chunks, found, strict=True) if v is None]
        fresh = iter(self._encode(missing))
        out = [next(fresh) if v is None else v for v in found]
        if len(young) >= self._entries:
            self._old, self._young = young, {}
        if len(chunks) <= self._entries:
            self._young.update((c, v) for c, v in zip(chunks, out, strict=True) if len(c) <= LONG_CHUNK)
        return out

    def joined(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Values of all chunks one after the other, and the offset of each."""
        coded = chunks.dictionary_encode()
        values = pa.array(self.values(coded.dictionary.to_pylist()), pa.large_binary())
        taken = values.take(coded.indices)
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
        flat = taken.buffers()[2]
        return np.frombuffer(flat, np.uint8)[: offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8), offsets


# --- byte-pair encodings of the tokenizers library ---------------------------------------


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    stands for itself, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


_LATIN_WORD = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
_MARKS = re.compile(r"[.,;:!?]+")


def pre_tokens(path: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a chunk in the model's alphabet.

    A chunk that is one Latin word or a few marks is one pre-token by either file's
    pattern; the library's normalizer and pre-tokenizer take all others.
    """
    tok, table = tokenizer(path), _byte_alphabet()
    lower = tok.normalizer is not None
    normal = tok.normalizer.normalize_str if lower else str
    split = tok.pre_tokenizer.pre_tokenize_str

    def pieces(chunk: str) -> list[str]:
        if _LATIN_WORD.fullmatch(chunk):
            word = chunk.strip(" ").lower() if lower else chunk
            if word.isascii():
                return [word.replace(" ", "\u0120")]
            return [word.encode().decode("latin-1").translate(table)]
        if _MARKS.fullmatch(chunk):
            return [chunk]
        return [p for p, _ in split(normal(chunk))]

    return pieces


def special_strings(path: str) -> list[str]:
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


def bpe_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Little-endian unsigned 32-bit ids of chunks, as ``encode(chunk, add_special_tokens=False)``."""
    tok, pieces, specials = tokenizer(path), pre_tokens(path), special_strings(path)
    merge = tok.model.tokenize

    def one(chunk: str) -> bytes:
        if any(s in chunk for s in specials):
            ids = tok.encode(chunk, add_special_tokens=False).ids
        else:
            ids = [t.id for p in pieces(chunk) for t in merge(p)]
        return array("I", ids).tobytes()

    return lambda chunks: [one(c) for c in chunks]


@lru_cache(maxsize=4)
def _bpe_table(path: str, entries: int) -> ChunkTable:
    return ChunkTable(bpe_encoder(path), entries)


def forget_tables() -> None:
    """Drop the tables and tokenizers of stages before. A Python worker goes on to other stages and
    would keep them; tasks that don't tokenize call this first."""
    if _bpe_table.cache_info().currsize or tokenizer.cache_info().currsize:
        _bpe_table.cache_clear()
        tokenizer.cache_clear()
        pa.default_memory_pool().release_unused()


def bpe_ids(path: str, texts: pa.StringArray, entries: int = TABLE_ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the bounds of each text's ids."""
    chunks, first = cut_words(texts)
    flat, offsets = _bpe_table(path, entries).joined(chunks)
    return flat.view("<u4") if len(flat) else np.zeros(0, "<u4"), offsets[first] // 4


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text's ids."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))
