from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longhouse import schemas as S
from longhouse.functions import values as V
from longhouse.operators import reshape as R
from longhouse.operators.reshape import Variable


def one(spark, value, ddl, fn):
    df = spark.createDataFrame([(value,)], f"c {ddl}")
    return df.select(fn(F.col("c"), df.schema["c"].dataType)).first()[0]


@pytest.mark.parametrize(
    "value, ddl, kind, want",
    [
        (date(2018, 1, 5), "date", S.DATE, "2018-01-05"),
        (datetime(2018, 1, 5, 9, 8, 7, 123999), "timestamp_ntz", S.DATETIME, "2018-01-05T09:08:07.123"),
        (datetime(2018, 1, 5, 9, 8, 7), "timestamp_ntz", S.DATETIME, "2018-01-05T09:08:07.000"),
        (datetime(2018, 1, 5, 9, 8, 7, 500000), "timestamp_ntz", S.TIME, "09:08:07.500"),
        (datetime(2018, 1, 5, 9, 8, 7), "timestamp", S.DATE, "2018-01-05"),
        (date(2018, 1, 5), "date", S.DATETIME, "2018-01-05T00:00:00.000"),
        (None, "date", S.DATE, None),
        (7, "int", S.INTEGER, "7"),
        (1.0, "double", S.FLOAT, "1.0"),
        (0.05, "double", S.FLOAT, "0.05"),
        (12345678.5, "double", S.FLOAT, "12345678.5"),
        (1e10, "double", S.FLOAT, "10000000000.0"),
        (-1.25e9, "double", S.FLOAT, "-1250000000.0"),
        (0.0005, "double", S.FLOAT, "0.0005"),
        ("text", "string", S.STRING, "text"),
        (True, "boolean", S.STRING, "true"),
    ],
)
def test_cell_text(spark, value, ddl, kind, want):
    assert one(spark, value, ddl, lambda c, t: V.cell_text(c, t, kind)) == want


def test_date_column_needs_a_temporal_variable():
    with pytest.raises(ValueError):
        V.cell_text(F.lit(None), T.DateType(), S.STRING)


@pytest.mark.parametrize(
    "value, ddl, kind, slot, want",
    [
        (7, "int", S.INTEGER, "value_integer", 7),
        ("7", "string", S.INTEGER, "value_integer", 7),
        (7, "int", S.FLOAT, "value_float", 7.0),
        (7, "int", S.STRING, "value_string", "7"),
        (date(2018, 1, 5), "date", S.STRING, "value_string", "2018-01-05"),
        (date(2018, 1, 5), "date", S.DATE, "value_datetime", datetime(2018, 1, 5)),
        ("09:08:07.500", "string", S.TIME, "value_datetime", datetime(1900, 1, 1, 9, 8, 7, 500000)),
        (3, "int", S.CATEGORY, "value_integer", 3),
        ("male", "string", S.CATEGORY, "value_string", "male"),
    ],
)
def test_typed_cell_fills_one_column_and_reads_back(spark, value, ddl, kind, slot, want):
    cell = one(spark, value, ddl, lambda c, t: V.typed_cell(c, t, kind))
    assert {k: v for k, v in cell.asDict().items() if v is not None} == {slot: want}


def test_category_of_another_type_is_an_error():
    with pytest.raises(ValueError):
        V.typed_cell(F.lit(1.5), T.DoubleType(), S.CATEGORY)


def wide(spark):
    data = [(1, 10, "a", 1.5, date(2020, 1, 2)), (2, None, None, None, None), (3, 30, "c", -2.0, None)]
    df = spark.createDataFrame(data, "row_id long, n int, s string, f double, d date")
    variables = [Variable(12, "n", S.INTEGER), Variable(5, "s", S.STRING), Variable(9, "f", S.FLOAT), Variable(7, "d", S.DATE)]
    return data, df, variables


def test_null_cells_and_all_null_rows_are_kept(spark):
    data, df, variables = wide(spark)
    cells = R.unpivot_text(df, variables)
    assert cells.count() == 12
    assert cells.where("row_id = 2 AND value IS NULL").count() == 4
    assert rows(R.pivot_typed_text(cells, variables)) == data
    assert rows(R.pivot_typed(R.unpivot_typed(df, variables), variables)) == data


def test_absent_cells_are_null(spark):
    _, df, variables = wide(spark)
    cells = R.unpivot_text(df, variables).where("NOT (row_id = 3 AND variable_id = 9)")
    got = rows(R.pivot_text(cells, variables))
    assert got[2] == (3, "30", "c", None, None)
    assert got[0] == (1, "10", "a", "1.5", "2020-01-02")


def test_column_absent_from_the_dictionary(spark):
    _, df, variables = wide(spark)
    with pytest.raises(ValueError, match="f"):
        R.unpivot_text(df, [v for v in variables if v.name != "f"])


def test_own_row_id_column_is_data(spark):
    df = spark.createDataFrame([(100, 7)], "__row_id long, row_id int")
    cells = R.unpivot_text(df, [Variable(1, "row_id", S.INTEGER)], "__row_id")
    assert rows(cells) == [(100, 1, "7")]


def test_no_variables_give_an_empty_frame(spark):
    _, df, variables = wide(spark)
    assert R.pivot_text(R.unpivot_text(df, variables), []).count() == 0


def test_integer_that_holds_text(spark):
    cells = spark.createDataFrame([(1, 1, "12"), (2, 1, "x")], "row_id long, variable_id long, value string")
    variables = [Variable(1, "n", S.INTEGER)]
    assert rows(R.pivot_typed_text(cells, variables, strict=False)) == [(1, 12), (2, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        R.pivot_typed_text(cells, variables).collect()


def test_single_columns(spark):
    _, df, variables = wide(spark)
    assert rows(R.dataset_column(R.unpivot_text(df, variables), variables[1])) == [(1, "a"), (2, None), (3, "c")]
    assert rows(R.typed_dataset_column(R.unpivot_typed(df, variables), variables[3])) == [
        (1, date(2020, 1, 2)), (2, None), (3, None)
    ]


def test_row_bind_fills_and_widens(spark):
    a = spark.createDataFrame([(1, "x")], "i int, only_a string")
    b = spark.createDataFrame([("z", date(2020, 1, 1)), ("z", date(2020, 1, 1))], "i string, only_b date")
    c = spark.createDataFrame([(2.5,)], "i double")
    got = R.row_bind([a, b, c])
    assert got.columns == ["i", "only_a", "only_b"]
    assert sorted(map(str, rows(got))) == sorted(
        map(str, [("1", "x", None), ("z", None, date(2020, 1, 1)), ("z", None, date(2020, 1, 1)), ("2.5", None, None)])
    )
    numbers = R.row_bind([a.select("i"), c])
    assert rows(numbers) == [(1.0,), (2.5,)]


def test_pivot_shuffles_once_on_row_id(spark):
    _, df, variables = wide(spark)
    plan = R.pivot_text(R.unpivot_text(df, variables), variables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(row_id" in plan


def test_unpivot_is_narrow(spark):
    _, df, variables = wide(spark)
    plan = R.unpivot_text(df, variables)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
