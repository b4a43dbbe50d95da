import random
from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from longhouse.operators.joins import contained_join, lookup_join


def frames(spark):
    rng = random.Random(3)
    big = [(None if rng.random() < 0.1 else ("hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}"), i) for i in range(2000)]
    small = [(f"k{i}", i) for i in range(30)] + [("hot", 100), ("hot", 101), (None, 5)]
    return (
        big,
        small,
        spark.createDataFrame(big, "k string, i int").repartition(4),
        spark.createDataFrame(small, "k string, s int"),
    )


def expected(big, small, how):
    out = Counter()
    for k, i in big:
        found = [s for kk, s in small if kk is not None and kk == k]
        if found:
            out.update((k, i, s) for s in found)
        elif how == "left":
            out[(k, i, None)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_equals_brute_force(spark, how):
    big, small, b, s = frames(spark)
    got = lookup_join(b, s, ["k"], how).select("k", "i", "s")
    assert Counter(map(tuple, got.collect())) == expected(big, small, how)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def test_a_hot_key_is_split_at_run_time(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 10 < 3, F.lit("hot")).otherwise(F.col("id").cast("string"))
        big = spark.range(0, 60_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        small = spark.range(60_000).select(F.col("id").cast("string").alias("k")).union(
            spark.createDataFrame([("hot",)], "k string")
        )
        joined = lookup_join(big, small, ["k"])
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 60_000
        rows_ = joined.select("k", F.length("x").alias("n"))
        assert len(rows_.collect()) == 60_000
        assert "skew=true" in rows_._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_only_inner_and_left(spark):
    _, _, b, s = frames(spark)
    with pytest.raises(ValueError):
        lookup_join(b, s, ["k"], "full")


TEXT = st.text(alphabet="ab_", max_size=7)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=1, max_size=6), st.lists(TEXT, min_size=1, max_size=5))
def test_contained_join_equals_all_pairs(spark, texts, codes):
    big = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    small = spark.createDataFrame(list(enumerate(codes)), "j int, c string")
    got = Counter(map(tuple, contained_join(big, "t", small, "c").select("i", "j").collect()))
    assert got == Counter((i, j) for i, t in enumerate(texts) for j, c in enumerate(codes) if c in t)


def test_contained_join_with_nulls(spark):
    big = spark.createDataFrame([(1, None), (2, "xay")], "i int, t string")
    small = spark.createDataFrame([(1, None), (2, "a")], "j int, c string")
    assert rows(contained_join(big, "t", small, "c"), "i", "j") == [(2, 2)]
