"""Token files, counts, pieces and packing against the libraries, text by text."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import bin_packing, chunks, piece_codec, token_counts, token_files
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.stage import table
from awkward import SF, awkward_texts

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def ids_of(path, texts):
    return [e.ids for e in chunks.tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def documents(spark):
    return table(spark, SF, "documents").select("doc_id", "text").collect()


text = st.text(alphabet=st.sampled_from("ab Z.,'!é́ \n\t  Σ日9▁<|>\x00"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(text, min_size=1, max_size=5))
def test_chunked_ids_equal_the_library(texts):
    for path in (BYTE, WORD):
        ids, bounds = chunks.bpe_ids(path, pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == ids_of(path, texts)
    ids, bounds = piece_codec.encode_texts(PIECE, pa.array(texts))
    sp = piece_codec.processor(PIECE)
    expected = [i + [sp.eos_id()] for i in sp.encode(texts)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == expected
    assert [t.decode() for t in piece_codec.decode_ids(PIECE, ids, bounds)] == [sp.decode(i) for i in expected]


def test_broken_bytes_decode_as_in_the_library():
    sp = piece_codec.processor(PIECE)
    ids = [sp.piece_to_id("<0xE2>"), sp.piece_to_id("▁a"), 0, 1, sp.piece_to_id("<0x41>"), 2]
    got = piece_codec.decode_ids(PIECE, np.array(ids, "<u4"), np.array([0, len(ids)]))
    assert got[0].decode() == sp.decode(ids)


def test_a_small_chunk_table_changes_nothing():
    texts = pa.array([" ".join(f"w{k}" for k in range(300)), "w1 w2 w3 w1"])
    ids, bounds = chunks.bpe_ids(BYTE, texts, 50)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == ids_of(BYTE, texts.to_pylist())


@given(st.lists(st.sampled_from([0, 255, 256, 65_535, 65_536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1]), max_size=30))
def test_codes_round_trip(ranks):
    control, codes = token_files.encode_ranks(np.array(ranks, "<u4"))
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.decode_ranks(control, codes, len(ranks)).tolist() == ranks


def test_token_files(spark):
    docs = sorted(documents(spark))
    got = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, SF).collect()}
    start = 0
    for doc, ids in zip(docs, ids_of(BYTE, [d["text"] for d in docs]), strict=True):
        ids = [*ids, 2]
        row = got.pop(doc["doc_id"])
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert not got


def test_token_files_of_awkward_and_no_documents(spark, scratch, awkward, nothing):
    s = scratch()
    token_files.write_token_files(awkward, s.path("a"), BYTE, 2, s)
    rows = token_files.read_token_files(spark, s.path("a")).orderBy("start").collect()
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert keys == sorted(-1 if i is None else i for i, _ in awkward_texts())
    expected = Counter((i, tuple([*x, 2])) for (i, t), x in zip(awkward_texts(), ids_of(BYTE, [t for _, t in awkward_texts()])))
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in rows) == expected
    assert [r["start"] for r in rows] == np.cumsum([0] + [len(r["ids"]) // 4 for r in rows])[:-1].tolist()
    s = scratch()
    token_files.write_token_files(nothing, s.path("b"), BYTE, 2, s)
    assert token_files.read_token_files(spark, s.path("b")).count() == 0


def test_token_counts(spark, awkward, nothing):
    whole = token_counts.prove_whole_tokens(WORD)
    tok = chunks.tokenizer(WORD)
    assert len(whole) > 30_000 and all(len(tok.model.tokenize(w)) == 1 for w in sorted(whole)[::500])
    rows = token_counts.count_tokens(awkward, WORD, limit=20).collect()
    expected = Counter(
        (i, len((t or "").encode()), len(x), len(x) > 20)
        for (i, t), x in zip(awkward_texts(), ids_of(WORD, [t for _, t in awkward_texts()]))
    )
    assert Counter(map(tuple, rows)) == expected
    assert token_counts.count_tokens(nothing, WORD).count() == 0
    docs = documents(spark)
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op4_token_counts"](spark, SF).collect()}
    assert got == {d["doc_id"]: len(x) for d, x in zip(docs, ids_of(WORD, [d["text"] for d in docs]))}


def test_piece_codec(spark, awkward, nothing):
    sp = piece_codec.processor(PIECE)

    def digests(pairs):
        out = Counter()
        for i, t in pairs:
            ids = [*sp.encode(t or ""), sp.eos_id()]
            spelled = " ".join(map(str, ids)).encode()
            out[i, len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
        return out

    assert Counter(map(tuple, piece_codec.digest(awkward, PIECE).collect())) == digests(awkward_texts())
    assert Counter(map(tuple, QUERIES["op5_piece_codec"](spark, SF).collect())) == digests(documents(spark))
    assert piece_codec.digest(nothing, PIECE).count() == 0
    back = piece_codec.decode(piece_codec.encode(awkward, PIECE), PIECE).select("doc_id", "text").collect()
    assert Counter(map(tuple, back)) == Counter((i, sp.decode(sp.encode(t or ""))) for i, t in awkward_texts())


def test_a_model_whose_pieces_cross_spaces_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as form

    model = form.ModelProto()
    model.ParseFromString(open(PIECE, "rb").read())
    model.pieces[500].piece = "a▁b"
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        piece_codec.check_pieces(str(tmp_path / "m.model"))


def fullest_by_trying(supply, capacity):
    largest, best = max(supply), 0
    items = [n for n, c in supply.items() for _ in range(c)]
    items.remove(largest)
    for mask in range(1 << len(items)):
        total = largest + sum(x for k, x in enumerate(items) if mask >> k & 1)
        best = total if best < total <= capacity else best
    return best


@settings(deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_fullest_combination(lengths):
    supply = Counter(lengths)
    chosen = bin_packing.fullest(dict(supply), 20)
    assert all(k <= supply[n] for n, k in chosen.items()) and chosen[max(supply)] >= 1
    assert sum(n * k for n, k in chosen.items()) == fullest_by_trying(supply, 20)
    bins = bin_packing.plan(dict(supply), 20)
    assert Counter({n: sum(t * c.get(n, 0) for t, c in bins) for n in supply}) == supply


def check_packing(rows, texts, capacity):
    pieces = Counter()
    for (i, _), ids in zip(texts, ids_of(WORD, [t for _, t in texts])):
        ids = [*ids, 1]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            pieces[i, k, start, len(part), crc(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) <= capacity
    return len(by_sequence)


def test_bin_packing(spark, scratch, awkward, nothing):
    docs = documents(spark)
    rows = QUERIES["op7_bin_packing"](spark, SF).collect()
    bins = check_packing(rows, docs, 4096)
    assert bins <= -(-sum(r["length"] for r in rows) // 4096) * 1.01 + 1
    pieces = scratch().save(bin_packing.token_pieces(awkward, WORD, 1, 64), "pieces")
    placed = bin_packing.assign(pieces, 64, salts=3)
    rows = [r.asDict() | {"ids_crc32": zlib.crc32(r["ids"])} for r in placed.collect()]
    check_packing(rows, awkward_texts(), 64)
    longest = max(len(r["ids"]) // 4 for r in bin_packing.sequences(placed).collect())
    assert longest <= 64
    pieces = scratch().save(bin_packing.token_pieces(nothing, WORD, 1, crc=True), "pieces")
    assert bin_packing.assign(pieces).count() == 0
    with pytest.raises(ValueError, match="clash"):
        bin_packing.assign(pieces.withColumnRenamed("start", "_rank"))


def test_tasks_that_do_not_tokenize_keep_no_tables():
    class Rows:
        def mapInArrow(self, function, schema):
            return list(function(iter([])))

    before = chunks.bpe_ids(BYTE, pa.array(["some words", "and more"]))
    assert chunks._bpe_table.cache_info().currsize
    assert token_files.code_blocks(Rows(), [0]) == []
    assert not chunks._bpe_table.cache_info().currsize and not chunks.tokenizer.cache_info().currsize
    after = chunks.bpe_ids(BYTE, pa.array(["some words", "and more"]))
    assert all((a == b).all() for a, b in zip(before, after, strict=True))


def test_a_digest_needs_no_python_worker_of_its_own(spark):
    tokens = spark.createDataFrame([(5, 3, np.array([7, 70_000], "<u4").tobytes()), (None, 0, b"")], "doc_id long, start long, ids binary")
    digest = token_files.digest(tokens)
    assert sorted(map(tuple, digest.collect()), key=str) == [(5, 3, 2, crc([7, 70_000])), (None, 0, 0, 0)]
    assert [f.dataType.simpleString() for f in digest.schema] == ["bigint"] * 4
    assert "MapInArrow" not in digest._jdf.queryExecution().toString()
