"""Scans with equality filters and lookups by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longhouse import schemas as S
from longhouse.operators.joins import lookup_join


def select_rows(
    df: DataFrame, columns: Sequence[str | Column] = ("*",), filters: Mapping[str, Any] | None = None
) -> DataFrame:
    """Columns of the rows where every filter column equals its value (operator A-7).

    No filter keeps all rows; a null value matches nothing. Columns may be aggregates.
    """
    for name, value in (filters or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    columns = list(columns)
    if any(isinstance(c, Column) for c in columns):
        return df.select(*columns)
    return df.selectExpr(*columns)


def named_key(df: DataFrame, name: Any, key_col: str, name_col: str = "name") -> int | None:
    """Lowest key of the rows with that name, None if there is none (operator D-13)."""
    found = df.where(F.col(name_col) == F.lit(name)).orderBy(F.asc_nulls_last(key_col)).select(key_col).first()
    return found[0] if found else None


def named_keys(
    rows: DataFrame,
    names: str,
    table: DataFrame,
    key_col: str,
    name_col: str = "name",
) -> DataFrame:
    """``rows`` with the lowest key of each name attached, null where unknown (D-13 in bulk)."""
    keys = table.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias(names)).agg(
        F.min(key_col).alias(key_col)
    )
    return lookup_join(rows, keys, [names], "left")


def variable_id(variables: DataFrame, domain_id: int, name: str) -> int | None:
    """Id of a variable of a domain (operator D-13)."""
    return named_key(variables.where(F.col("domain_id") == domain_id), name, "variable_id")


def variable(variables: DataFrame, variable_id: int) -> DataFrame:
    """The dictionary entry with that id (operator D-13)."""
    return variables.where(F.col("variable_id") == variable_id)


def value_type(variables: DataFrame, variable_id: int) -> int:
    """Value type of a variable; an error if it is unknown or has none of the seven (D-13)."""
    row = variable(variables, variable_id).select("value_type_id").first()
    if row is None:
        raise LookupError(f"there is no variable {variable_id}")
    if row[0] not in range(S.INTEGER, S.CATEGORY + 1):
        raise ValueError(f"variable {variable_id} has no known value type: {row[0]}")
    return row[0]


def dataset_name(datasets: DataFrame, dataset_id: int) -> str | None:
    """Name of a dataset, None if there is no such dataset (operator D-13)."""
    row = datasets.where(F.col("dataset_id") == dataset_id).select("name").first()
    return row[0] if row else None


def lookup_variables(
    variables: DataFrame, names: DataFrame | Iterable[str], domain_id: Any
) -> DataFrame:
    """(name, variable_id, value_type_id) of the named variables of a domain (operator D-3).

    Names match exactly; a name that is asked for twice is found twice.
    """
    known = variables.where(F.col("domain_id") == F.lit(domain_id)).select(
        "name", "variable_id", "value_type_id"
    )
    if isinstance(names, DataFrame):
        return lookup_join(names.select("name"), known, ["name"]).select(
            "name", "variable_id", "value_type_id"
        )
    return known.where(F.col("name").isin(list(names)))


def dataset_variables(members: DataFrame, variables: DataFrame, dataset_id: Any = None) -> DataFrame:
    """Variables of one dataset, or of every dataset if none is named (operator D-7)."""
    if dataset_id is not None:
        members = members.where(F.col("dataset_id") == F.lit(dataset_id))
    known = variables.select("variable_id", F.col("name").alias("variable"), "value_type_id")
    found = lookup_join(members, known, ["variable_id"])
    columns = ["variable_id", "variable", "value_type_id"]
    return found.select(*columns) if dataset_id is not None else found.select("dataset_id", *columns)


def source_sites(sources: DataFrame, sites: DataFrame, source: Any) -> DataFrame:
    """Sites of a named source (operator D-9)."""
    wanted = sources.where(F.col("name") == F.lit(source)).select("source_id")
    return lookup_join(sites, wanted, ["source_id"]).select(*sites.columns)
