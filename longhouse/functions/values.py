"""How a cell becomes text or a typed value, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longhouse import schemas as S

DATE_FORMAT = "yyyy-MM-dd"
# A time of day is kept in a timestamp column on this day.
TIME_DAY = "1900-01-01"

_TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, _TEMPORAL_TYPES)


def _stamp_text(col: Column, dtype: T.DataType) -> Column:
    """Local date and time as ``yyyy-MM-dd HH:mm:ss[.ffffff]``; no zone shift for NTZ columns."""
    if isinstance(dtype, T.DateType):
        return F.concat(col.cast("string"), F.lit(" 00:00:00"))
    return col.cast("string")


def temporal_text(col: Column, dtype: T.DataType, value_type: int) -> Column:
    """Date ``yyyy-MM-dd``, time ``HH:mm:ss.SSS``, datetime with ``T`` between (operator H-5).

    Milliseconds are cut, not rounded; null stays null.
    """
    stamp = _stamp_text(col, dtype)
    day = F.substring_index(stamp, " ", 1)
    clock = F.substring_index(stamp, " ", -1)
    millis = F.rpad(F.substring(clock, 10, 3), 3, "0")
    time = F.concat(F.substring(clock, 1, 8), F.lit("."), millis)
    if value_type == S.DATE:
        return day
    if value_type == S.TIME:
        return time
    if value_type == S.DATETIME:
        return F.concat(day, F.lit("T"), time)
    raise ValueError(f"value type {value_type} does not take dates or times")


def number_text(col: Column, dtype: T.DataType) -> Column:
    """A number as text, in plain notation between 1e-4 and 1e15 as the archive stores it."""
    if not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.cast("string")
    if isinstance(dtype, T.FloatType):
        # the shortest digits that are this float, not those of its double
        col = col.cast("string").cast("double")
    size = F.abs(col)
    # Spark itself writes 1e-3 <= |x| < 1e7 in plain notation; the digits are the same.
    large = F.regexp_replace(
        col.cast("decimal(38,12)").cast("string"), r"(\.\d*[1-9]|\.0)0*$", "$1"
    )
    small = F.regexp_replace(col.cast("decimal(38,24)").cast("string"), r"0+$", "")
    return (
        F.when((size >= 1e7) & (size < 1e15), large)
        .when((size >= 1e-4) & (size < 1e-3), small)
        .otherwise(col.cast("string"))
    )


def cell_text(col: Column, dtype: T.DataType, value_type: int) -> Column:
    """Text form of a cell in the text store (operators H-5, H-6).

    A date or time column needs a variable of type date, datetime or time.
    """
    if is_temporal(dtype):
        return temporal_text(col, dtype, value_type)
    return number_text(col, dtype)


def plain_text(col: Column, dtype: T.DataType) -> Column:
    """Text of any cell where no variable type is declared."""
    if isinstance(dtype, T.DateType):
        return temporal_text(col, dtype, S.DATE)
    if is_temporal(dtype):
        return temporal_text(col, dtype, S.DATETIME)
    return number_text(col, dtype)


def whole_number(col: Column, dtype: T.DataType) -> Column:
    """A whole number; a fraction is an error, as it would be lost."""
    if not isinstance(dtype, _FRACTION_TYPES):
        return col.cast("long")
    lost = F.raise_error(F.concat(F.lit("not a whole number: "), col.cast("string")))
    return F.when(col.isNull() | (col == F.floor(col)), col.cast("long")).otherwise(lost.cast("long"))


def typed_cell(col: Column, dtype: T.DataType, value_type: int) -> Column:
    """Struct of the four typed value columns, one of them filled (operator H-7)."""
    integer = F.lit(None).cast("long")
    fraction = F.lit(None).cast("double")
    string = F.lit(None).cast("string")
    stamp = F.lit(None).cast("timestamp_ntz")
    if value_type == S.INTEGER:
        integer = whole_number(col, dtype)
    elif value_type == S.FLOAT:
        fraction = col.cast("double")
    elif value_type == S.STRING:
        string = (
            temporal_text(col, dtype, S.DATE) if is_temporal(dtype) else number_text(col, dtype)
        )
    elif value_type == S.TIME and isinstance(dtype, T.StringType):
        stamp = F.concat(F.lit(TIME_DAY + " "), col).cast("timestamp_ntz")
    elif value_type in S.TEMPORAL:
        stamp = col.cast("timestamp_ntz")
    elif value_type == S.CATEGORY and isinstance(dtype, _WHOLE_TYPES):
        integer = col.cast("long")
    elif value_type == S.CATEGORY and isinstance(dtype, T.StringType):
        string = col
    else:
        raise ValueError(f"value type {value_type} does not take {dtype.simpleString()} values")
    return F.struct(
        integer.alias("value_integer"),
        fraction.alias("value_float"),
        string.alias("value_string"),
        stamp.alias("value_datetime"),
    )


def category_text(integer: Column, string: Column) -> Column:
    """A category is its integer if it has one, else its text (operator H-8)."""
    return F.coalesce(integer.cast("string"), string)


def read_typed(cell: Column, value_type: int) -> Column:
    """Value of a variable of ``value_type`` from the typed columns of its cell (operator E-4)."""
    stamp = cell["value_datetime"]
    if value_type == S.INTEGER:
        return cell["value_integer"]
    if value_type == S.FLOAT:
        return cell["value_float"]
    if value_type == S.STRING:
        return cell["value_string"]
    if value_type == S.DATE:
        return stamp.cast("date")
    if value_type == S.DATETIME:
        return stamp
    if value_type == S.TIME:
        return temporal_text(stamp, T.TimestampNTZType(), S.TIME)
    if value_type == S.CATEGORY:
        return category_text(cell["value_integer"], cell["value_string"])
    raise ValueError(f"unknown value type {value_type}")


def read_text(col: Column, value_type: int, strict: bool = True) -> Column:
    """Typed value from a stored text; ``strict=False`` gives null where it does not parse."""
    spark_type = {
        S.INTEGER: "long",
        S.FLOAT: "double",
        S.DATE: "date",
        S.DATETIME: "timestamp_ntz",
    }.get(value_type, "string")
    if value_type not in range(S.INTEGER, S.CATEGORY + 1):
        raise ValueError(f"unknown value type {value_type}")
    return col.cast(spark_type) if strict else col.try_cast(spark_type)


def default_value_type(dtype: T.DataType) -> int:
    """Value type that fits a Spark column, for dictionaries derived from a schema."""
    if isinstance(dtype, _WHOLE_TYPES):
        return S.INTEGER
    if isinstance(dtype, _FRACTION_TYPES):
        return S.FLOAT
    if isinstance(dtype, T.DateType):
        return S.DATE
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return S.DATETIME
    return S.STRING
