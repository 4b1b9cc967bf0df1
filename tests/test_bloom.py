"""Anti join by a Bloom filter: results of the exact join, size and error of the filter, the plan."""

import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.bloom import Filter, exclude_many
from martkit.operators.lookup import exclude_keys


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(4000), i) for i in range(20_000)] + [(None, -1), (None, -2)] + [(7, i) for i in range(5000)]
    keys = [(k,) for k in range(0, 4000, 40)] + [(7,), (7,), (None,)]
    return spark.createDataFrame(rows, "k long, v long"), spark.createDataFrame(keys, "k long")


@pytest.mark.parametrize("size", [Filter.for_keys(102), Filter(32, 1), Filter(64, 3), Filter(1 << 16, 16)])
def test_any_filter_gives_the_exact_result(sides, size):
    fact, keys = sides
    got = sorted(exclude_many(fact, keys, "k", size).collect(), key=str)
    assert got == sorted(exclude_keys(fact, keys, "k").collect(), key=str)
    assert sum(r.k is None for r in got) == 2 and not any(r.k == 7 for r in got)


def test_empty_sides_and_texts(spark, sides):
    fact, keys = sides
    size = Filter.for_keys(10)
    assert exclude_many(fact, keys.limit(0), "k", size).count() == fact.count()
    assert exclude_many(fact, keys.where("k IS NULL"), "k", size).count() == fact.count()
    assert exclude_many(fact.limit(0), keys, "k", size).count() == 0
    texts = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("é", 4)], "name string, k int")
    out = exclude_many(texts, texts.where("k IN (2, 4)"), "name", size)
    assert out.columns == ["name", "k"] and {r.k for r in out.collect()} == {1, 3}


def test_few_absent_keys_pass(spark):
    keys = spark.range(5000).select((F.col("id") * 3).alias("k"))
    absent = spark.range(20_000).select((F.col("id") * 3 + 1).alias("k"))
    size = Filter.for_keys(5000, 0.02)
    table = size.table(keys, "k")
    passed = absent.where(size.may_hold(table.scalar(), F.col("k"))).count()
    assert passed / 20_000 < 2 * size.error(5000) < 0.05
    assert keys.where(size.may_hold(table.scalar(), F.col("k"))).count() == 5000


def test_size_is_bounded():
    assert Filter.for_keys(10**12).bits == 1 << 26 and Filter.for_keys(0).bits == 32
    assert Filter.for_keys(10**6, 0.01).error(10**6) < 0.011
    for bad in ((0, 1), (32, 0), ((1 << 31) + 1, 1)):
        with pytest.raises(ValueError):
            Filter(*bad)


def test_rows_surely_absent_are_not_shuffled(spark, sides, tmp_path):
    """Of a fact without listed keys nearly no row reaches the exchange of the anti join."""
    fact, keys = sides
    fact.where("k % 40 != 0 AND k != 7").write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    size = Filter.for_keys(102)
    maybe = stored.where(size.may_hold(size.table(keys, "k").scalar(), F.col("k"))).count()
    assert maybe < 0.05 * stored.count() and exclude_many(stored, keys, "k", size).count() == stored.count()
