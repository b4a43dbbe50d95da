"""Delimited text in and out."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longhouse import schemas as S
from longhouse.config import CsvFormat
from longhouse.sources.ranges import range_states, records

TIMESTAMP_TYPE = "spark.sql.timestampType"
ZONED = r"(?i)\d\s*(Z|UTC|GMT|[a-z]+/[a-z_]+)\s*$|:\d\d(\.\d+)?\s*[+-]\d\d(:?\d\d)?\s*$"  # a time that ends with a zone


def _decimal_pattern(mark: str) -> str:
    return rf"^\s*[+-]?\d*\Q{mark}\E?\d+\s*$"


def _options(fmt: CsvFormat) -> dict[str, str]:
    return {"sep": fmt.delim, "quote": fmt.quote, "escape": fmt.quote, "dateFormat": fmt.date_format}


def _reader(spark: SparkSession, fmt: CsvFormat):
    return spark.read.options(**_options(fmt)).option("header", True)


def _in_ranges(spark: SparkSession, path: str, fmt: CsvFormat, whole_up_to: int | None) -> bool:
    """Whether cells may hold line breaks in files of several splits."""
    if not fmt.multiline or not fmt.quote:
        return False
    if whole_up_to is None:
        whole_up_to = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b"))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(target) or ()
    return sum(fs.getContentSummary(f.getPath()).getLength() for f in found) > whole_up_to


def _ddl(names: Sequence[str], kinds: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in zip(names, kinds))


def _inferred(spark: SparkSession, read: Callable[[SparkSession], DataFrame]) -> T.StructType:
    """The schema that ``read`` infers where times have no zone.

    That is a setting of a session, so a session of its own infers and this one keeps its setting.
    """
    own = spark.newSession()
    own.conf.set(TIMESTAMP_TYPE, "TIMESTAMP_NTZ")
    return read(own).schema


def _parsed(spark: SparkSession, path: str, fmt: CsvFormat, infer: bool) -> DataFrame:
    """A file that is read in ranges, cells as text or of the types inferred."""
    names = _reader(spark, fmt).option("multiLine", True).csv(path).columns  # reads one record
    texts = records(spark, path, fmt.delim, fmt.quote, range_states(spark, path, fmt.delim, fmt.quote))

    def cells(kinds: Sequence[str]) -> DataFrame:
        # a generator parses a record once, whatever becomes of its columns
        return texts.select(F.inline(F.array(F.from_csv("value", _ddl(names, kinds), _options(fmt)))))

    kinds = ["STRING"] * len(names)
    if infer:
        lines = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        reader = _reader(spark, fmt).option("header", False).option("inferSchema", True)
        found = T.StructType.fromJson(json.loads(reader._jreader.csv(lines).schema().json())).fields
        for k, field in enumerate(found[: len(names)]):
            kinds[k] = field.dataType.simpleString()
        times = [n for n, k in zip(names, kinds) if k.startswith("timestamp")]
        if times:
            # a time with a zone anywhere makes the column one of instants
            plain = ["TIMESTAMP_NTZ" if n in times else k for n, k in zip(names, kinds)]
            zoned = cells(["STRING"] * len(names)).select(
                *[F.bool_or(F.col(f"`{n}`").rlike(ZONED)).alias(str(k)) for k, n in enumerate(times)]
            ).first()
            kinds = [k if n in times and zoned[str(times.index(n))] else p for n, k, p in zip(names, kinds, plain)]
    return cells(kinds)


def read_csv(
    spark: SparkSession,
    path: str,
    fmt: CsvFormat = CsvFormat(),
    types: Mapping[str, int] | None = None,
    whole_up_to: int | None = None,
) -> DataFrame:
    """A file with a header row (operator A-1).

    Cells in quotes may hold line breaks unless the format says that every record is one line; then
    a row with another number of cells is an error. Files are read by as many tasks as they have splits; those
    with line breaks are cut into records in ranges (see ``ranges``) if they have more than
    ``whole_up_to`` bytes together, a split's by default, and by a task each below that. Times are taken as
    they stand, whatever the zone of the session.

    Types are inferred from the data, which costs a pass of its own. ``types`` (column name to
    declared value type) saves that pass on volume loads: cells are then converted as declared,
    and text that does not fit its type is an error.
    """
    ranged = _in_ranges(spark, path, fmt, whole_up_to)

    def reader(session: SparkSession):
        if fmt.multiline:
            return _reader(session, fmt).option("multiLine", True)
        return _reader(session, fmt).option("mode", "FAILFAST").option("enforceSchema", False)

    if types is not None:
        raw = _parsed(spark, path, fmt, infer=False) if ranged else reader(spark).csv(path)
        return raw.select(
            *[_declared(raw, c, types.get(c, S.STRING), fmt).alias(c) for c in raw.columns]
        )
    if ranged:
        df = _parsed(spark, path, fmt, infer=True)
    else:
        schema = _inferred(spark, lambda session: reader(session).option("inferSchema", True).csv(path))
        df = reader(spark).schema(schema).csv(path)
    return df if fmt.decimal == "." else _decimal_columns(df, fmt.decimal)


def _declared(df: DataFrame, name: str, value_type: int, fmt: CsvFormat):
    cell = F.col(f"`{name}`")
    if value_type == S.INTEGER:
        return cell.cast("long")
    if value_type == S.FLOAT:
        return F.replace(cell, F.lit(fmt.decimal), F.lit(".")).cast("double")
    if value_type == S.DATE:
        return F.to_date(cell, fmt.date_format)
    if value_type == S.DATETIME:
        return cell.cast("timestamp_ntz")
    return cell


def _decimal_columns(df: DataFrame, mark: str) -> DataFrame:
    """Text columns that hold only numbers with that decimal mark become doubles."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    pattern = _decimal_pattern(mark)
    numeric = df.agg(
        *[F.bool_and(F.col(f"`{c}`").rlike(pattern)).alias(str(i)) for i, c in enumerate(text)]
    ).first()
    for i, c in enumerate(text):
        if numeric[str(i)]:
            plain = F.replace(F.trim(F.col(f"`{c}`")), F.lit(mark), F.lit("."))
            df = df.withColumn(c, plain.cast("double"))
    return df


def read_dictionary(spark: SparkSession, path: str, fmt: CsvFormat | None = None) -> DataFrame:
    """A dictionary file with the position of each row in ``pos`` (operator A-3).

    Descriptions may hold line breaks, so one task reads the file and file order is row order.
    Dictionaries are one row per variable.
    """
    fmt = fmt or CsvFormat(delim=";")
    df = _reader(spark, fmt).option("multiLine", True).csv(path)
    if "DataType" in df.columns:
        df = df.withColumn("DataType", F.col("DataType").cast("int"))
    return df.withColumn("pos", F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str, fmt: CsvFormat = CsvFormat(), compress: bool = False) -> str:
    """A folder of delimited parts, each with a header (operators B-8, B-10).

    Cells keep their blanks. What was at ``path`` before is replaced.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("sep", fmt.delim)
        .option("quote", fmt.quote)
        .option("escape", fmt.quote)
        .option("compression", "gzip" if compress else "none")
        .csv(path)
    )
    return path


def reexport(
    spark: SparkSession, path: str, target: str, delim: str = ";", whole_up_to: int | None = None
) -> str:
    """A comma-separated file once more with another delimiter, as text (operator B-10).

    Cells, line breaks in quotes too, are passed on unchanged; files are read as by ``read_csv``.
    """
    return write_csv(read_csv(spark, path, types={}, whole_up_to=whole_up_to), target, CsvFormat(delim=delim))
