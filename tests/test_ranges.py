"""Files cut into ranges against the reader that takes them whole."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from longhouse import schemas as S
from longhouse.config import CsvFormat
from longhouse.sources import delimited, ranges


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def some_file(seed: int, end: str, odd: bool) -> str:
    draw = random.Random(seed)
    cells = ["", "a", "12", "b b", '""', '"q"', '"a,b"', f'"two{end}lines"', f'"{end}{end}"', '"say ""x"""', "é", '"""',
             f'"long{"x" * 150}{end}y"', '"""a""' + end + '"', " lead", "tail "]
    strange = ['a"b', '"a"b', ' "x"', '"x" ', '5"', '"a""b"c', '""x']
    cells = [c for c in cells if c != '"""'] + (strange if odd else [])
    lines = [f'"h{end}1",h2,h3']
    lines += [",".join(draw.choice(cells) for _ in range(3)) for _ in range(draw.randrange(40, 90))]
    return end.join(lines) + draw.choice(["", end])


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_equal_the_whole_file(spark, tmp_path, small_splits, end, odd):
    for seed in range(4):
        path = tmp_path / f"{seed}.csv"
        path.write_bytes(some_file(seed, end, odd).encode())
        whole = delimited.read_csv(spark, str(path), types={}, whole_up_to=1 << 30)
        parts = delimited.read_csv(spark, str(path), types={}, whole_up_to=0)
        assert parts.schema == whole.schema
        # a row of nulls comes of a record that is not empty, such as commas
        assert rows(parts) == rows(whole)
    assert ranges._lines(spark, str(path)).select("start").distinct().count() > 10


def test_folder_of_files_and_other_marks(spark, tmp_path, small_splits):
    for k in range(3):
        lines = [f"{k}-{i}||'x{i}\n''y||z'||{i / 2}" for i in range(30)]
        (tmp_path / f"{k}.csv").write_text("id||t||x\n" + "\n".join(lines))
    fmt = CsvFormat(delim="||", quote="'")
    parts = delimited.read_csv(spark, str(tmp_path), fmt, whole_up_to=0)
    assert [f.dataType.simpleString() for f in parts.schema] == ["string", "string", "double"]
    want = [(f"{k}-{i}", f"x{i}\n'y||z", i / 2) for k in range(3) for i in range(30)]
    assert sorted(map(tuple, parts.collect())) == sorted(want)


def test_inferred_types_are_those_of_the_whole_file(spark, tmp_path, small_splits):
    path = tmp_path / "a.csv"
    lines = [f'{i},{i * 10**10},{i / 4},2020-01-{i % 28 + 1:02},2020-01-01 10:00:{i:02},true,"a\n{i}",' for i in range(50)]
    path.write_text("i,l,x,d,t,b,s,none\n" + "\n".join(lines) + "\n")
    zone = spark.conf.get(delimited.TIMESTAMP_TYPE)
    parts = delimited.read_csv(spark, str(path), whole_up_to=0)
    whole = delimited.read_csv(spark, str(path), whole_up_to=1 << 30)
    assert parts.dtypes == whole.dtypes
    assert [k for _, k in parts.dtypes][:7] == ["int", "bigint", "double", "date", "timestamp_ntz", "boolean", "string"]
    assert rows(parts) == rows(whole) and spark.conf.get(delimited.TIMESTAMP_TYPE) == zone


def test_declared_types_and_order(spark, tmp_path, small_splits):
    path = tmp_path / "a.csv"
    path.write_text("n,t\n" + "".join(f'{i},"x\ny"\n' for i in range(40)))
    parts = delimited.read_csv(spark, str(path), types={"n": S.INTEGER}, whole_up_to=0)
    assert rows(parts) == [(i, "x\ny") for i in range(40)]
    assert delimited.read_csv(spark, str(path), types={"n": S.INTEGER}).dtypes == parts.dtypes


@pytest.mark.parametrize("text", ["a,b\n", "a,b", 'a,b\n"open\n1\n2', '"a\nb",c\n' + '"' + "x\n" * 100 + '",1\n'])
def test_short_and_broken_files(spark, tmp_path, small_splits, text):
    path = tmp_path / "a.csv"
    path.write_text(text)
    parts = delimited.read_csv(spark, str(path), types={}, whole_up_to=0)
    assert rows(parts) == rows(delimited.read_csv(spark, str(path), types={}, whole_up_to=1 << 30))


def test_a_file_is_as_many_tasks_as_splits(spark, tmp_path):
    df = spark.range(20_000).select("id", F.concat(F.lit("line\nbreak "), F.repeat(F.lit('x"'), 20)).alias("t"))
    path = delimited.write_csv(df.coalesce(1), str(tmp_path / "big.csv"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000b")
    try:
        assert delimited._in_ranges(spark, path, CsvFormat(), None)
        parts = delimited.read_csv(spark, path, types={"id": S.INTEGER})
        tasks = parts.select("t").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) >= 8
        assert parts.exceptAll(df).isEmpty() and parts.count() == 20_000
        again = delimited.reexport(spark, path, str(tmp_path / "again"))
        back = delimited.read_csv(spark, again, CsvFormat(delim=";"), types={"id": S.INTEGER})
        assert back.exceptAll(df).isEmpty() and back.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
