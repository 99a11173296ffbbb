"""Groups of spelling variants: words one edit apart, by neighbourhoods over a reduced alphabet.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased, of at least
``shortest`` code points and ``least`` occurrences. Each letter is hashed to one of ``SYMBOLS``
symbols. Two words one edit apart have reduced words at most one edit apart, so each word
goes to the keys of its reduced word's one-edit neighbourhood and meets there the words
whose reduced word is the key. The neighbourhood relation is symmetric, so of it only the
keys that are not behind the reduced word itself (shorter, or as long and not larger) are
generated: each pair meets exactly once. Pairs are verified on the original strings.

A word's form is its near word of the largest count, if that is ``ratio`` times its own or
more. Counts grow along forms, so following them ends; roots are found by pointer doubling,
in as many rounds as the logarithm of the longest chain. All of it is SQL functions; shuffled
are counts of words, then rows of the vocabulary: no row of documents.

Defined results: null and empty texts hold no words; a null doc_id counts as an empty one in
the planted deletions; a row that repeats counts again; a very long run is one word; ties go
to the smallest word in code-point order; an empty table gives no rows; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.stage import Scratch

SYMBOLS = 8
LETTERS = "A-Za-z\\u00C0-\\u00FF"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, shortest: int) -> DataFrame:
    """(doc_id as text, run) of all lower-cased runs of at least ``shortest`` code points."""
    found = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"([{LETTERS}]{{{shortest},}})"), F.lit(1))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(name.alias("name"), F.explode(found).alias("run"))


def with_deletions(found: DataFrame, every: int = 199) -> DataFrame:
    """The runs as ``word``, those whose hash ``every`` divides without one code point."""
    h = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.withColumn("h", h).select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, shortest: int, least: int) -> DataFrame:
    """(word, n) of words of the length and count."""
    counts = words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least)


def reduced(word: F.Column) -> F.Column:
    """The word with each letter as one of ``SYMBOLS`` symbols. Letters far apart in the
    alphabet share one, as a multiplicative hash of the code point gives."""
    letters = _LOWER + "".join(map(chr, range(0xC0, 0x100)))
    symbols = "".join("01234567"[(ord(c) * 2654435761 >> 7) % SYMBOLS] for c in letters)
    return F.translate(word, letters, symbols)


def neighbourhood(r: F.Column) -> F.Column:
    """Hashes of the words over the symbols at most one edit from ``r`` that are not behind it.

    Words with one symbol more are behind it: they generate ``r`` themselves as a deletion.
    """
    places = F.sequence(F.lit(1), F.length(r))
    before = lambda i: F.substring(r, F.lit(1), i - 1)
    after = lambda i: F.substring(r, i + 1, F.length(r))
    deleted = F.transform(places, lambda i: F.concat(before(i), after(i)))
    smaller = lambda i: F.transform(
        F.sequence(F.lit(0), F.substring(r, i, F.lit(1)).cast("int")), lambda s: F.concat(before(i), s.cast("string"), after(i))
    )
    replaced = F.flatten(F.transform(places, smaller))  # the symbol itself too: r
    return F.array_distinct(F.transform(F.concat(deleted, replaced), lambda k: F.xxhash64(k)))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of words exactly one edit apart, each pair in both directions."""
    r = reduced(F.col("word"))
    known = words.select(F.xxhash64(r).alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    asked = words.select("word", "n", r.alias("r"))
    asked = asked.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.xxhash64("r").alias("own"),
                         F.explode(neighbourhood(F.col("r"))).alias("key"))
    # words of one reduced word would meet twice and meet themselves
    met = asked.join(known, "key").filter((F.col("key") != F.col("own")) | (F.col("a") < F.col("b")))
    met = met.filter((F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1))
    both = F.array(*(F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n"))
                     for x, y in ("ab", "ba")))
    return met.select(F.explode(both).alias("p")).select("p.*")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the words with a form: the last of the chain of forms."""
    found, rounds = scratch.save(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if found.join(onward, "root", "left_semi").isEmpty():
            return found
        rounds += 1
        stepped = found.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        found = scratch.save(stepped, f"roots-{rounds}")
        scratch.drop(f"roots-{rounds - 1}")


def variants(words: DataFrame, scratch: Scratch, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n of a vocabulary (word, n)."""
    words = scratch.save(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.first("n").alias("n"), best.alias("best"))
    strong = -F.col("best.m") >= ratio * F.col("n")
    near = near.select("word", "n_near", F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.m")).alias("form_n"))
    near = scratch.save(near, "near")
    ends = roots(near.filter("form is not null"), scratch)
    rows = words.join(near, "word", "left").join(ends, "word", "left")
    return rows.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def spelling_variants(docs: DataFrame, scratch: Scratch, shortest: int = 6, least: int = 5, every: int | None = None) -> DataFrame:
    """Variants of all words of ``docs``; ``every`` plants misspellings (``with_deletions``)."""
    found = runs(docs, shortest)
    words = found.select(F.col("run").alias("word")) if every is None else with_deletions(found, every)
    return variants(vocabulary(words, shortest, least), scratch)


#: In this SQL two words are near if the same deletion in both, or one deletion in one, makes them equal.
ORACLE_SQL = """
with recursive steps as (
  select i as b, 0 as k, i as v from range(256) t(i)
  union all
  select b, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from steps where k < 8
),
crc as (select list(v order by b) as t from steps where k = 8),
runs as (
  select unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) as run,
         coalesce(doc_id::varchar, '') as name
  from {documents}
),
distinct_runs as (select name, run, count(*) as c from runs where length(run) >= 6 group by all),
coded as (select *, hex(encode(name || ':' || run)) as x from distinct_runs),
bytes as (select name, run, c, list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::bigint) as b from coded),
hashed as (
  select run, c, xor(list_reduce(b, lambda s, y: xor(s >> 8, t[(xor(s, y) & 255) + 1]), 4294967295), 4294967295) as h
  from bytes, crc
),
words as (
  select case when h % 199 = 0
              then substring(run, 1, (h % length(run))::bigint) || substring(run, (h % length(run))::bigint + 2) else run end as word, c
  from hashed
),
vocabulary as (select word, sum(c)::bigint as n from words where length(word) >= 6 group by word having sum(c) >= 5),
deletions as (
  select word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) as d
  from (select word, n, unnest(range(1, length(word) + 1)) as i from vocabulary)
),
pairs as (
  select a.word, a.n, b.word as near, b.n as near_n from deletions a join deletions b on a.d = b.d and a.i = b.i and a.word <> b.word
  union
  select a.word, a.n, b.word, b.n from deletions a join vocabulary b on a.d = b.word
  union
  select b.word, b.n, a.word, a.n from deletions a join vocabulary b on a.d = b.word
),
ranked as (
  select *, row_number() over (partition by word order by near_n desc, encode(near)) as r, count(*) over (partition by word) as n_near from pairs
),
formed as (
  select v.word, v.n, coalesce(n_near, 0)::bigint as n_near,
         case when near_n >= 5 * v.n then near end as form, case when near_n >= 5 * v.n then near_n end as form_n
  from vocabulary v left join ranked on ranked.word = v.word and r = 1
),
chains as (
  select word, word as at from formed
  union all
  select chains.word, formed.form from chains join formed on formed.word = chains.at where formed.form is not null
),
ends as (select chains.word, chains.at as root from chains join formed on formed.word = chains.at where formed.form is null)
select formed.word, form, root, n, n_near, form_n from formed join ends on ends.word = formed.word
"""
