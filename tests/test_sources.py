import base64
import datetime as dt
import gzip
from pathlib import Path

import pyarrow as pa
import pytest
from conftest import rows

from longhouse import schemas as S
from longhouse.config import CsvFormat
from longhouse.sources import arrow_ipc, delimited, documents


def test_types_dates_and_quotes_are_read(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id;d;t\n1;Jan 5, 2018;"a;""b"""\n2;Jan 05, 2018;\n')
    df = delimited.read_csv(spark, str(path), CsvFormat(";", '"', "MMM d, yyyy"))
    assert rows(df) == [(1, dt.date(2018, 1, 5), 'a;"b"'), (2, dt.date(2018, 1, 5), None)]


def test_decimal_mark(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("n;x;t\n1;1,5;a,b\n2;-0,25;1,5\n3;;\n")
    df = delimited.read_csv(spark, str(path), CsvFormat(delim=";", decimal=","))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "string"]
    assert rows(df, "x") == [(None,), (-0.25,), (1.5,)]
    declared = delimited.read_csv(spark, str(path), CsvFormat(delim=";", decimal=","), types={"x": S.FLOAT, "n": S.INTEGER})
    assert rows(declared, "x") == [(None,), (-0.25,), (1.5,)]


def test_declared_types_keep_text(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("code,d\n007,2018-01-05\n")
    df = delimited.read_csv(spark, str(path), types={"code": S.STRING, "d": S.DATE})
    assert rows(df) == [("007", dt.date(2018, 1, 5))]


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        delimited.read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError, match="there is no file"):
        documents.read_documents(spark, str(tmp_path), ["none.pdf"])


def test_dictionary_with_line_breaks_keeps_file_order(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('Column_Name;Key;Description;Note;DataType\nb;Yes;"title\n1,one\n2,two";n;7\na;;plain;;1\n')
    df = delimited.read_dictionary(spark, str(path))
    assert rows(df, "pos", "Column_Name", "Description", "DataType") == [
        (0, "b", "title\n1,one\n2,two", 7), (1, "a", "plain", 1)
    ]


def test_documents_are_one_line_of_base64(spark, tmp_path):
    content = bytes(range(256)) * 5
    names = ["plain.pdf", "with space, and (marks) [1].docx", "100% + more.pdf"]
    for n in names:
        (tmp_path / n).write_bytes(content + n.encode())
    (tmp_path / "other.pdf").write_bytes(b"other")
    got = {r.name: r.document for r in documents.read_documents(spark, str(tmp_path), names).collect()}
    assert got == {n: base64.b64encode(content + n.encode()).decode() for n in names}


def test_compressed_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "i int, t string")
    path = delimited.write_csv(df.coalesce(1), str(tmp_path / "out"), compress=True)
    part = next(Path(path).glob("part-*.gz"))
    assert gzip.open(part, "rt").read() == 'i,t\n1,"a,b"\n2,\n'


def test_reexport_with_another_delimiter(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,description\nx,"a;b, ""c""\nd"\n')
    path = delimited.reexport(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    part = next(Path(path).glob("part-*"))
    assert part.read_text() == 'name;description\nx;"a;b, ""c""\nd"\n'


def test_arrow_files_are_zstd_and_read_back(spark, tmp_path):
    df = spark.range(1000).repartition(3).selectExpr(
        "id", "CAST(id AS string) AS s", "IF(id % 2 = 0, NULL, id / 2.0D) AS f", "DATE'2020-01-01' AS d",
        "TIMESTAMP_NTZ'2020-01-01 01:02:03' AS t",
    )
    path = arrow_ipc.write_arrow(df, str(tmp_path / "x.arrow"))
    files = sorted(Path(path).iterdir())
    assert len(files) == 3 and all(f.suffix == ".arrow" for f in files)
    table = pa.ipc.open_file(str(files[0])).read_all()
    assert table.column_names == ["id", "s", "f", "d", "t"]
    back = arrow_ipc.read_arrow(spark, path)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert rows(back) == rows(df)


def test_failed_arrow_write_publishes_nothing(spark, tmp_path):
    df = spark.range(10).selectExpr("assert_true(id < 5) AS a", "id")
    with pytest.raises(Exception):
        arrow_ipc.write_arrow(df, str(tmp_path / "x.arrow"))
    assert not list(Path(tmp_path).rglob("part-*"))
