"""Near-duplicate documents by order min-hash.

A document's k-mers are its five-word shingles, each labelled with its occurrence number, so
repeats count. A table of the sketch takes the ``LENGTH`` smallest labelled k-mers under its
own hash and keeps them in text order; two documents agree in a table if they share these
k-mers in the same order, which rearranged texts don't. Documents that agree in a table are
candidates; a banded alignment of their words verifies an edit similarity of 0.8 or more.

Exact copies (equal words) are one class. Buckets of at most ``SMALL`` documents give all
their pairs; in larger ones every document is compared with the first. Then all pairs of a
large bucket that are still in different components are compared, in pairs of blocks of
``BLOCK`` documents, so no bucket is gathered. A bucket's
size is that of the whole bucket, of distinct texts.
Only the words of candidates are shuffled, and of large buckets that hold two components.

Defined results: words are lower case and end at ASCII white space; null, empty and blank
texts have no words and are copies of each other; texts of fewer than five words have one
k-mer, all their words; a null doc_id is a class of its own (class_id null, kept); rows that
repeat a doc_id share a class if their texts do and take the smallest class_id otherwise; an
empty table gives no rows; other columns are kept by ``keep_one`` and not read before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.alignment import similar
from ledgerloom.llm.components import components
from ledgerloom.llm.stage import Scratch, mapped, packed, slices, texts_of, unpacked
from ledgerloom.llm.vectors import units
from ledgerloom.llm.words import mix, shingle_hashes, word_hashes

TABLES = 24
LENGTH = 2  # k-mers a table keeps
SMALL = 12
BLOCK = 512  # documents of a large bucket that are compared with as many others in one unit
BINS = 256
_LOW = np.uint64((1 << 24) - 1)


def labelled_kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers with their occurrence numbers, in text order."""
    if not len(words):
        return np.zeros(0, np.uint64)
    kmers = shingle_hashes(words)
    if not len(kmers):
        kmers = np.array([hash_of_all(words)], np.uint64)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    at = np.arange(len(ranked))
    first = np.maximum.accumulate(np.where(np.append(True, ranked[1:] != ranked[:-1]), at, 0))
    occurrence = np.empty(len(ranked), np.uint64)
    occurrence[order] = at - first
    return mix(kmers + occurrence * np.uint64(0xA24BAED4963EE407))


def hash_of_all(words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little")


def sketch_keys(kmers: np.ndarray, bounds: np.ndarray, tables: int) -> np.ndarray:
    """A key for each (text, table): the smallest labelled k-mers in text order. ``kmers`` of
    all texts one after the other; every text has one at least."""
    position = np.arange(len(kmers), dtype=np.uint64)  # below 2^24 in a portion or a text
    starts, sizes = bounds[:-1], np.diff(bounds)
    keys = np.empty((len(starts), tables), np.uint64)
    for t in range(tables):
        hashed = (mix(kmers ^ np.uint64((t + 1) * 0x9FB21C651E98DF25 % (1 << 64))) & ~_LOW) | position
        places = np.empty((len(starts), LENGTH), np.int64)
        for k in range(LENGTH):
            places[:, k] = (np.minimum.reduceat(hashed, starts) & _LOW).astype(np.int64)
            more = sizes > k + 1
            places[~more, k + 1 :] = places[~more, k : k + 1]  # too few k-mers: the last again
            hashed[places[more, k]] |= ~_LOW
        places.sort(axis=1)
        key = np.full(len(starts), np.uint64(t + 1))
        for k in range(LENGTH):
            key = mix(key + kmers[places[:, k]])
        keys[:, t] = key
    return keys


def sketches(docs: DataFrame, tables: int) -> DataFrame:
    """doc_id, same (a digest of all words), keys (of each table; none without words)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, bounds = word_hashes(texts_of(batch.column(1)))
        each = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        same = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in each]
        kmers = [labelled_kmers(w) for w in each if len(w)]
        keys = np.zeros(0, np.int64)
        if kmers:
            at = np.concatenate([[0], np.cumsum([len(k) for k in kmers])])
            keys = sketch_keys(np.concatenate(kmers), at, tables).ravel().view(np.int64)
        offsets = np.concatenate([[0], np.cumsum([tables * (len(w) > 0) for w in each])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), lists], ["doc_id", "same", "keys"])

    rows = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return mapped(rows, run, "doc_id long, same binary, keys array<long>")


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the row where each row's group starts, and the group's size."""
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(key)))
    return np.repeat(starts, sizes), np.repeat(sizes, sizes)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows (larger, smaller doc), each once, without loops."""
    pairs = np.stack([np.maximum(a, b), np.minimum(a, b)])[:, a != b]
    order = np.lexsort(pairs)
    pairs = pairs[:, order]
    new = np.ones(pairs.shape[1], bool)
    new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in pairs[:, new]], ["a", "b"])


def pair_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of each bucket from (key, doc) rows sorted by key and doc. The last bucket of
    a batch waits for the next one; buckets are small."""
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for batch in batches:
        key, doc = (np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held))
        whole = np.searchsorted(key, key[-1]) if len(key) else 0
        held = (key[whole:], doc[whole:])
        yield _bucket_pairs(key[:whole], doc[:whole])
    yield _bucket_pairs(*held)


def _bucket_pairs(key: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    start, size = _groups(key)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, int(size.max(initial=1))):
        at = np.flatnonzero(np.arange(len(key)) - start >= d)
        a.append(doc[at])
        b.append(doc[at - d])
    return _pairs(np.concatenate(a), np.concatenate(b))


def distinct_texts(sketched: DataFrame) -> DataFrame:
    """same, rep (the smallest doc_id that has the words), keys: one row a text."""
    return sketched.groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"))


def buckets(texts: DataFrame) -> DataFrame:
    """key, doc, n, first: the documents of each bucket of more than one, the size and the
    smallest doc_id of the whole bucket. Counted before the shuffle; a hot key splits in the join."""
    rows = texts.select(F.explode("keys").alias("key"), F.col("rep").alias("doc"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first"))
    return rows.join(sizes.filter("n > 1").hint("merge"), "key").select("key", "doc", "n", "first")


def candidates(members: DataFrame) -> DataFrame:
    """a, b: pairs of documents (a > b) that agree in a table: all of small buckets, and those
    with the first of large ones."""
    small = members.filter(F.col("n") <= SMALL).select("key", "doc").repartition("key").sortWithinPartitions("key", "doc")
    pairs = small.mapInArrow(pair_buckets, "a long, b long")
    first = members.filter((F.col("n") > SMALL) & (F.col("doc") > F.col("first")))
    return pairs.unionByName(first.select(F.col("doc").alias("a"), F.col("first").alias("b"))).distinct()


def across_components(members: DataFrame, found: DataFrame, docs: DataFrame, scratch: Scratch, least: float) -> DataFrame | None:
    """Links (a, b) between documents of large buckets that ``found`` (node, component) has in
    different components: every such pair is compared, or linked through others. None if no
    bucket holds two components."""
    large = members.filter(F.col("n") > SMALL).select("key", "doc")
    large = large.join(found, F.col("doc") == F.col("node"), "left").select("key", "doc", F.coalesce("component", "doc").alias("component"))
    large = scratch.save(large, "large")
    sizes = large.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    sizes = sizes.filter("low <> high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    mixed = scratch.save(large.join(sizes.hint("merge"), "key"), "mixed")
    if mixed.isEmpty():
        return None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    texts = texts.join(mixed.select("doc").distinct().hint("merge"), "doc", "left_semi")
    words = scratch.save(words_of(texts).dropDuplicates(["doc"]), "large-words")
    part = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.struct(F.least(k, F.col("part")).alias("i"), F.greatest(k, F.col("part")).alias("j")),
    )
    spread = mixed.withColumn("part", part).withColumn("pair", F.explode(pairs)).join(words.hint("merge"), "doc")
    spread = spread.select("key", "pair.i", "pair.j", F.col("part").alias("side"), "doc", "component", "words")
    keys = ("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches, 3):
            cross = unit["i"][0].as_py() != unit["j"][0].as_py()
            words = [np.frombuffer(w, "<u4") for w in unit["words"].to_pylist()]
            side = unit["side"].to_numpy() if cross else None
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in linked(words, *(unit[c].to_numpy() for c in ("doc", "component")), side, least)], ["a", "b"])

    links = spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")
    return scratch.save(links.distinct(), "large-links")


def linked(words: list[np.ndarray], doc: np.ndarray, component: np.ndarray, side: np.ndarray | None, least: float) -> tuple[list[int], list[int]]:
    """Links (larger, smaller doc) that join components: the likeliest pairs first, pairs of one
    component not at all. Counts of words by hash bound the edits from below."""
    size = np.array([len(w) for w in words])
    counts = np.array([np.bincount(w % BINS, minlength=BINS) for w in words], np.int32).reshape(-1, BINS)
    todo = []
    for i in range(len(words)):
        longer = np.maximum(size[i], size)
        ok = (component != component[i]) & (np.minimum(size[i], size) >= least * longer - 1e-9)
        ok &= (np.arange(len(words)) > i) if side is None else (side > side[i])
        at = np.flatnonzero(ok)
        share = np.minimum(counts[at], counts[i]).sum(axis=1) / np.maximum(longer[at], 1)
        good = share >= least - 1e-9
        todo.append(np.stack([-share[good], np.full(good.sum(), i), at[good]]))
    todo = np.concatenate(todo, axis=1) if todo else np.zeros((3, 0))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = root.get(y, y)
            x = y
        return x

    a, b = [], []
    for i, j in todo[1:, np.argsort(todo[0], kind="stable")].astype(int).T.tolist():
        x, y = find(int(component[i])), find(int(component[j]))
        if x != y and _alike(words[i], words[j], least):
            root[max(x, y)] = min(x, y)
            a.append(max(int(doc[i]), int(doc[j])))
            b.append(min(int(doc[i]), int(doc[j])))
    return a, b


def words_of(docs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, bounds = word_hashes(texts_of(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), slices((words >> np.uint64(32)).astype("<u4"), bounds).cast(pa.binary())], ["doc", "words"])

    return mapped(docs.select("doc", "text"), run, "doc long, words binary")


def verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose edit similarity is at least ``least``."""
    joined = pairs.join(words.select(F.col("doc").alias("a"), F.col("words").alias("a_words")), "a")
    joined = joined.join(words.select(F.col("doc").alias("b"), F.col("words").alias("b_words")), "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        good = [_alike(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), least) for x, y in texts]
        return pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return mapped(joined.select("a", "b", "a_words", "b_words"), run, "a long, b long")


def _alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    longer = max(len(x), len(y))
    # words without a partner need an edit each
    shared = np.concatenate([x, y])
    _, inverse = np.unique(shared, return_inverse=True)
    n = inverse.max() + 1 if longer else 0
    common = np.minimum(np.bincount(inverse[: len(x)], minlength=n), np.bincount(inverse[len(x) :], minlength=n)).sum()
    return common >= least * longer - 1e-9 and similar(x, y, least) is not None


def near_documents(docs: DataFrame, scratch: Scratch, least: float = 0.8, tables: int = TABLES) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class), kept: one row a doc_id that isn't
    null, and one for each row with a null doc_id."""
    sketched = scratch.save(sketches(docs, tables), "sketches")
    by_words = scratch.save(distinct_texts(sketched), "texts")
    reps = sketched.select("doc_id", "same").join(by_words.select("same", "rep"), "same").groupBy("doc_id").agg(F.min("rep").alias("rep"))
    reps = scratch.save(reps, "reps")
    members = scratch.save(buckets(by_words), "members")
    pairs = scratch.save(candidates(members), "pairs")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    # the ids grow with the corpus: merged at every size, never broadcast
    texts = texts.join(involved.hint("merge"), "doc", "left_semi")
    words = scratch.save(words_of(texts).dropDuplicates(["doc"]), "words")
    links = scratch.save(verified(pairs, words, least), "links")
    found = scratch.save(components(links, scratch), "components")
    more = across_components(members, found, docs, scratch, least)
    if more is not None:
        found = scratch.save(components(links.unionByName(more), scratch, "all-stars"), "all-components")
    classes = reps.join(found, F.col("rep") == F.col("node"), "left")
    placed = classes.select("doc_id", F.coalesce("component", "rep").alias("class_id"))
    apart = docs.filter(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id"))
    return placed.unionByName(apart).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose class keeps them; rows of a null doc_id stay."""
    rows = packed(docs, "doc_id").withColumn("doc", F.col("doc_id").cast("long"))
    dropped = classes.filter(~F.col("kept")).select(F.col("doc_id").alias("doc"))
    return unpacked(rows.join(dropped, "doc", "left_anti"), "doc_id").select(*[f"`{c}`" for c in docs.columns])
