"""Token counts by a whole-token shortcut.

Offline, each vocabulary string is encoded alone; those that come back as their own single
token are proven. A pre-token among them counts one and is never merged; only the rest goes
through the merges, each distinct one once while the worker's table holds it.

Defined results: null and empty texts have 0 bytes and 0 tokens; rows are counted one by
one, so repeated rows repeat; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.chunks import TABLE_ENTRIES, ChunkTable, cut_words, pre_tokens, special_strings, tokenizer
from ledgerloom.llm.stage import mapped, texts_of


def prove_whole_tokens(path: str) -> frozenset[str]:
    """Pre-tokens (in the model's alphabet) that the merges turn into a single token."""
    tok = tokenizer(path)
    end = getattr(tok.model, "end_of_word_suffix", None) or ""
    known = set(tok.get_vocab(with_added_tokens=False))
    words = {v.removesuffix(end) for v in known if v.endswith(end)}
    return frozenset(w for w in words if w and len(tok.model.tokenize(w)) == 1)


def count_encoder(path: str, whole: frozenset[str]) -> Callable[[list[str]], list[bytes]]:
    """The token count of each chunk, as 4 bytes."""
    tok, pieces, specials = tokenizer(path), pre_tokens(path), special_strings(path)
    merge = tok.model.tokenize

    def one(chunk: str) -> bytes:
        if any(s in chunk for s in specials):
            n = len(tok.encode(chunk, add_special_tokens=False).ids)
        else:
            n = sum(1 if p in whole else len(merge(p)) for p in pieces(chunk))
        return struct.pack("<I", n)

    return lambda chunks: [one(c) for c in chunks]


@lru_cache(maxsize=2)
def _table(path: str, whole: frozenset[str]) -> ChunkTable:
    return ChunkTable(count_encoder(path, whole), TABLE_ENTRIES)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether n_tokens exceeds ``limit``.

    The proven strings are broadcast; the vocabulary bounds their number.
    """
    proven = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column(1))
        chunks, first = cut_words(texts)
        flat, _ = _table(path, proven.value).joined(chunks)
        total = np.concatenate([[0], np.cumsum(flat.view("<u4"), dtype=np.int64)])
        n = total[first[1:]] - total[first[:-1]]
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1])
        columns = [batch.column(0), pa.array(sizes.astype(np.int64)), pa.array(n), pa.array(n > limit)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)
