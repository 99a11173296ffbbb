"""Small, large and skewed lookups give the rows of a plain join."""

import pytest
from pyspark.sql import functions as F

from check import rows
from ledgerloom.operators.lookup import Lookup, lookup_join


@pytest.fixture(scope="module")
def tables(spark):
    # A third of the facts share key 0, another part has no key, key 3 is twice in the lookup.
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(0)).when(n % 7 == 0, F.lit(None)).otherwise(n % 40)
    fact = spark.range(3000).select(n.alias("row"), key.cast("long").alias("k"))
    dim = spark.range(30).select(n.alias("d"), F.concat(F.lit("name-"), n).alias("name"))
    return fact, dim.unionByName(dim.filter("d = 3"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}])  # broadcast, shuffled
def test_lookup_join(tables, how, limits):
    fact, dim = tables
    expected = fact.join(dim, fact.k == dim.d, how).collect()
    got = lookup_join(fact, Lookup(dim, **limits), [(F.col("k"), F.col("d"))], how)
    assert rows(got.columns, got.collect()) == rows(["row", "k", "d", "name"], expected)


def test_the_shuffled_join_reads_its_input_once(spark, tables, tmp_path):
    """Four lookups one after the other, by keys that are missing or hot."""
    fact, dim = tables
    fact.write.parquet(str(tmp_path / "fact"))
    joined = spark.read.parquet(str(tmp_path / "fact"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for k in range(4):
        names = dim.select(F.col("d").alias(f"d{k}"), F.col("name").alias(f"name{k}")).filter("d%d <> 3" % k)
        joined = lookup_join(joined, Lookup(names, broadcast_bytes=0), [(F.col("k"), F.col(f"d{k}"))])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("__salt") > 8 and "hashpartitioning(__key_0" in plan
    assert plan.count("FileScan parquet") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "BroadcastHashJoin" not in plan
    assert joined.count() == fact.count()


def test_rows_without_a_key_spread(spark):
    rows_ = spark.range(5000).select(F.col("id"), F.lit(None).cast("long").alias("k"))
    joined = lookup_join(rows_, Lookup(spark.range(10).withColumnRenamed("id", "d"), broadcast_bytes=0), [(F.col("k"), F.col("d"))])
    salted = rows_.select(F.pmod(F.xxhash64("id", "k"), F.lit(4096)))
    assert joined.count() == 5000 and salted.distinct().count() > 2000


def test_where_keeps_the_size_of_a_small_lookup(tables):
    _, dim = tables
    small = Lookup(dim)
    assert 31 * 24 < small.bytes < 31 * 64
    assert small.where(F.col("d") < 3)._bytes == small.bytes
    large = Lookup(dim, broadcast_bytes=300)
    assert not large.is_small and large.where(F.col("d") < 3).is_small
