"""Text expressions of the dictionary and vocabulary builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker that ends a sample code, the mark that stands for a comma in a
# description, and the text of a missing cell.
SAMPLE_MARKER = "(?i)_ch"
COMMA_MARK = "^"
MISSING = "missing"


def lines(text: Column) -> Column:
    """Lines of a text, cut at newlines only (operator H-1)."""
    return F.split(text, "\n")


def has_lines(text: Column) -> Column:
    """Whether a text has more than one line."""
    return F.contains(text, F.lit("\n"))


def code_and_description(line: Column) -> Column:
    """First two comma-separated fields of a line; further fields are dropped (operator H-2)."""
    fields = F.split(line, ",", 3)
    return F.struct(
        F.get(fields, F.lit(0)).alias("code"), F.get(fields, F.lit(1)).alias("description")
    )


def sample_code(name: Column) -> Column:
    """What precedes the first sample marker (operator H-10)."""
    return F.get(F.split(name, SAMPLE_MARKER), F.lit(0))


def result_code(name: Column, sample: Column) -> Column:
    """What follows the last ``<sample>_``, in upper case (operator H-11)."""
    return F.upper(F.split_part(name, F.concat(sample, F.lit("_")), F.lit(-1)))


def result_suffix(code: Column) -> Column:
    """`` result N`` for a code that ends in ``_N``, else empty (operator H-13)."""
    digit = F.regexp_extract(code, r"_(\d)$", 1)
    return F.when(digit == "", F.lit("")).otherwise(F.concat(F.lit(" result "), digit))


def trim_list_end(text: Column) -> Column:
    """Without a comma and space at the very end (operator H-14)."""
    return F.regexp_replace(text, ", \\z", "")


def mark_commas(text: Column) -> Column:
    """Commas replaced so that the text fits an unquoted field; null stays null (H-15)."""
    return F.translate(text, ",", COMMA_MARK)


def pair_list(columns: Sequence[str]) -> Column:
    """``name:value`` of each column joined by ``;`` with all spaces removed (operator H-17)."""
    pairs = [
        F.concat(F.lit(f"{c}:"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)))
        for c in columns
    ]
    return F.replace(F.concat_ws(";", *pairs), F.lit(" "), F.lit(""))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends (operator H-17)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
