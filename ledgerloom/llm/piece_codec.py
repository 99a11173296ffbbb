"""SentencePiece encoding and decoding with a table of distinct chunks.

If no piece holds a space marker after another character, pieces can't cross the start of a
run of markers, be they spaces or U+2581 of the text itself. Each distinct marked word (a run
of markers that starts with a space, and what follows up to the next) is then segmented once,
and its ids are joined back by position. ``check_pieces`` proves this
from the model; any other model is refused.

Defined results: a null text is empty (the end id alone, decoded to the empty text); rows
are coded one by one, repeated rows repeat; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.chunks import TABLE_ENTRIES, ChunkTable, cut_spaces
from ledgerloom.llm.stage import binary, mapped, slices, texts_of

MARKER = "▁"


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_pieces(path: str) -> None:
    """Refuse a model whose pieces could cross a chunk's border or that rewrites texts.

    A border lies before a space that follows something other than a marker (``cut_spaces``),
    so a piece across it would hold a marker after another character.
    """
    from sentencepiece import sentencepiece_model_pb2 as format

    model = format.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    normal, trainer = model.normalizer_spec, model.trainer_spec
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
        raise ValueError(f"{path} rewrites texts before it segments them")
    if not normal.add_dummy_prefix or trainer.treat_whitespace_as_suffix or trainer.model_type != 2:
        raise ValueError(f"{path} is not a byte-pair model with a leading marker")
    crossing = re.compile(f"[^{MARKER}]{MARKER}")
    if any(crossing.search(p.piece) for p in model.pieces) or any(p.type == 4 for p in model.pieces):
        raise ValueError(f"{path} has pieces that cross a space")
    if MARKER not in {p.piece for p in model.pieces}:
        raise ValueError(f"{path} has no piece for the marker alone")


@lru_cache(maxsize=2)
def _table(path: str) -> ChunkTable:
    sp = processor(path)

    def encode(chunks: list[str]) -> list[bytes]:
        # the chunk's first space is the marker that the library puts before every text but the empty one
        alone = array("I", [sp.piece_to_id(MARKER)]).tobytes()
        rest = sp.encode([c[1:] for c in chunks], num_threads=1)
        return [alone if c == " " else array("I", ids).tobytes() for c, ids in zip(chunks, rest, strict=True)]

    return ChunkTable(encode, TABLE_ENTRIES)


@lru_cache(maxsize=2)
def _piece_bytes(path: str) -> pa.LargeBinaryArray:
    """What each id adds to a decoded text."""
    sp = processor(path)

    def text(i: int) -> bytes:
        if sp.is_control(i):
            return b""
        if sp.is_byte(i):
            return bytes([int(sp.id_to_piece(i)[3:-1], 16)])
        if sp.is_unknown(i):
            return b" \xe2\x81\x87 "
        return sp.id_to_piece(i).replace(MARKER, " ").encode()

    return pa.array([text(i) for i in range(sp.get_piece_size())], pa.large_binary())


@lru_cache(maxsize=2)
def _decimals(path: str) -> pa.LargeBinaryArray:
    return pa.array([b"%d " % i for i in range(processor(path).get_piece_size())], pa.large_binary())


def encode_texts(path: str, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, an end id after each, and the bounds of each text's ids."""
    marked = pc.binary_join_element_wise(pa.scalar(" "), texts, "") if len(texts) else texts
    # the library gives no marker to an empty text
    marked = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, marked)
    chunks, first = cut_spaces(marked)
    flat, offsets = _table(path).joined(chunks)
    ids = flat.view("<u4") if len(flat) else np.zeros(0, "<u4")
    bounds = offsets[first] // 4
    return np.insert(ids, bounds[1:], processor(path).eos_id()), bounds + np.arange(len(bounds))


def decode_ids(path: str, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """UTF-8 texts of the ids between the bounds, as the library's ``decode``."""
    flat, at = _gather(_piece_bytes(path), ids)
    texts = []
    for a, b, first, last in zip(at[bounds[:-1]], at[bounds[1:]], bounds[:-1], bounds[1:], strict=True):
        text = flat[a:b].tobytes()
        text = text[1:] if text[:1] == b" " else text
        try:
            text.decode()
        except UnicodeDecodeError:  # broken bytes: let the library mend them
            text = processor(path).decode(ids[first:last].tolist()).encode()
        texts.append(text)
    return texts


def _gather(values: pa.LargeBinaryArray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    taken = values.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
    return np.frombuffer(taken.buffers()[2], np.uint8) if offsets[-1] else np.zeros(0, np.uint8), offsets


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32 bits, with the end id)."""
    check_pieces(path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = encode_texts(path, texts_of(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), slices(ids, bounds).cast(pa.binary())], ["doc_id", "ids"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids binary")


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = binary(column)
    return data.view("<u4"), offsets // 4


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, text: the decoded texts of what ``encode`` returns."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = decode_ids(path, *_ids_of(batch.column(1)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "ids", "text"])

    return mapped(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the decimal ids and of the text decoded from them.

    Encoding and decoding run in one pass, so that a task keeps a single Python worker.
    """
    check_pieces(path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = encode_texts(path, texts_of(batch.column(1)))
        flat, at = _gather(_decimals(path), ids)
        spelled = zip(at[bounds[:-1]], at[bounds[1:]], strict=True)
        columns = [
            batch.column(0),
            pa.array(np.diff(bounds)),
            pa.array([hashlib.sha256(flat[a : b - 1]).hexdigest() for a, b in spelled]),
            pa.array([hashlib.sha256(t).hexdigest() for t in decode_ids(path, ids, bounds)]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)
