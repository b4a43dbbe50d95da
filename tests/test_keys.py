from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from longhouse.operators import numbering
from longhouse.operators.keys import assign_ids, last_id
from longhouse.operators.numbering import number_within, ordered_concat


def test_ids_are_dense_and_keep_every_row(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("v"))
    got = assign_ids(df, "n", base=50).collect()
    assert sorted(r.n for r in got) == list(range(51, 1051))
    assert sorted(r.v for r in got) == [3 * i for i in range(1000)]


def test_ids_follow_the_order_with_ties_and_nulls(spark):
    values = [None, 5, 5, 5, 1, None, 9, 5] * 40
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    got = [r.v for r in assign_ids(df, "n", order_by=["v"]).orderBy("n").collect()]
    assert got == sorted(values, key=lambda v: (v is not None, v))


def test_ids_of_identical_rows_spread_over_partitions(spark):
    df = spark.range(20_000).select(F.lit(1).alias("v"))
    got = assign_ids(df, "n", order_by=["v"])
    assert got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 20_000, 20_000)


def test_ids_of_no_rows(spark):
    empty = spark.createDataFrame([], "v int")
    assert assign_ids(empty, "n", order_by=["v"]).collect() == []
    assert last_id(empty, "v") == 0


def test_numbers_within_groups_of_any_size(spark):
    data = [("hot", i) for i in range(300)] + [("a", 7), ("b", 2), ("b", 1), (None, 4), (None, 3)]
    df = spark.createDataFrame(data, "k string, pos int").repartition(6)
    got = number_within(df, ["k"], ["pos"], "n")
    seen = Counter()
    want = []
    for k, pos in sorted(data, key=lambda r: r[1]):
        seen[k] += 1
        want.append((k, pos, seen[k]))
    assert Counter(map(tuple, got.select("k", "pos", "n").collect())) == Counter(want)


@pytest.mark.parametrize("pieces", [10, 10_000])
def test_concat_gives_one_text_in_order(spark, pieces):
    df = spark.createDataFrame([("x", i, f"v{i}") for i in range(25)] + [("y", 1, "only")], "k string, p int, v string")
    got = rows(ordered_concat(df.repartition(4), ["k"], ["p"], "v", "|", "t", pieces), "k", "t")
    assert got == [("x", "|".join(f"v{i}" for i in range(25))), ("y", "only")]


def test_a_text_beyond_a_cell_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(numbering, "CELL_CHARS", 20)
    df = spark.createDataFrame([("x", i, "four") for i in range(6)], "k string, p int, v string")
    with pytest.raises(Exception, match="too long for one cell"):
        ordered_concat(df, ["k"], ["p"], "v", "|", "t").collect()
