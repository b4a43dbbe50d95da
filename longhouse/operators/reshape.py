"""Wide rows to cells and back."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longhouse.functions import values as V

ROW_ID = "row_id"
INNER_ROW_ID = "__row_id"  # where a dataset has a column called row_id


@dataclass(frozen=True)
class Variable:
    """A dictionary entry as the planner needs it: one per dataset column, so schema-sized."""

    variable_id: int
    name: str
    value_type_id: int


def variables_of(rows: DataFrame) -> list[Variable]:
    """Dictionary entries of one dataset, in id order. Their number is that of its columns."""
    found = rows.select("variable_id", "name", "value_type_id").orderBy("variable_id").collect()
    return [Variable(r.variable_id, r.name, r.value_type_id) for r in found]


def variables_from_schema(df: DataFrame, skip: Iterable[str] = ()) -> list[Variable]:
    """Variables numbered 1.. in column order with the type that fits each column."""
    skip = set(skip)
    fields = [f for f in df.schema.fields if f.name not in skip]
    return [
        Variable(i, f.name, V.default_value_type(f.dataType)) for i, f in enumerate(fields, start=1)
    ]


def _by_column(df: DataFrame, variables: list[Variable], row_id: str) -> list[tuple]:
    known = {v.name: v for v in variables}
    columns = [f for f in df.schema.fields if f.name != row_id]
    missing = [f.name for f in columns if f.name not in known]
    if missing:
        raise ValueError("columns missing from the dictionary: " + ", ".join(missing))
    return [(F.col(f"`{f.name}`"), f.dataType, known[f.name]) for f in columns]


def _unpivot(df: DataFrame, row_id: str, cells: list[Column]) -> DataFrame:
    return df.select(F.col(row_id).alias(ROW_ID), F.inline(F.array(*cells)))


def unpivot_text(df: DataFrame, variables: list[Variable], row_id: str = ROW_ID) -> DataFrame:
    """(row_id, variable_id, value) with one row per cell, null cells too (operator E-5).

    Narrow: cells are cast and numbered inside the scan stage, with no join and no shuffle.
    """
    cells = [
        F.struct(
            F.lit(v.variable_id).cast("long").alias("variable_id"),
            V.cell_text(c, dtype, v.value_type_id).alias("value"),
        )
        for c, dtype, v in _by_column(df, variables, row_id)
    ]
    return _unpivot(df, row_id, cells)


def unpivot_typed(df: DataFrame, variables: list[Variable], row_id: str = ROW_ID) -> DataFrame:
    """As ``unpivot_text`` with the value routed to a typed column (operator H-7)."""
    cells = [
        F.struct(
            F.lit(v.variable_id).cast("long").alias("variable_id"),
            V.typed_cell(c, dtype, v.value_type_id).alias("typed"),
        )
        for c, dtype, v in _by_column(df, variables, row_id)
    ]
    return _unpivot(df, row_id, cells).select(ROW_ID, "variable_id", "typed.*")


def _gather(long: DataFrame, variables: list[Variable], cell: Column, gathered: bool = False) -> DataFrame:
    """One array of cells per row, in the order of ``variables``; an absent cell is null.

    A pivot of text evaluates every output column for every input cell. Collecting a row's cells
    and sorting them once costs the same however many columns there are. A row must have at most
    one cell per variable; a second one is an error. Collecting shrinks nothing,
    so cells are shuffled as they are and gathered once, behind the shuffle; cells that are ``gathered``, those
    of a row in one partition as Spark knows, aren't shuffled at all.
    """
    ids = sorted(v.variable_id for v in variables)
    wanted = F.array(*[F.lit(i).cast("long") for i in ids])
    items = long.where(F.col("variable_id").isin(ids)).select(
        ROW_ID, F.struct("variable_id", cell.alias("cell")).alias("item")
    )
    items = items if gathered else items.repartition(ROW_ID)
    rows = items.groupBy(ROW_ID).agg(F.sort_array(F.collect_list("item")).alias("got"))
    # a row that lacks cells is filled up with null ones and sorted again
    dtype = long.select(cell.alias("cell")).schema["cell"].dataType
    absent = F.array_except(wanted, F.transform("got", lambda item: item["variable_id"]))
    nulls = F.transform(
        absent,
        lambda i: F.struct(i.alias("variable_id"), F.lit(None).cast(dtype).alias("cell")),
    )
    full = F.when(F.size("got") == len(ids), F.col("got")).otherwise(
        F.sort_array(F.concat("got", nulls))
    )
    # every variable once: then the sorted cells are those wanted, place by place
    once = F.transform(full, lambda item: item["variable_id"]) == wanted
    twice = F.raise_error(F.format_string("row %d holds a variable twice", F.col(ROW_ID)))
    cells = F.when(once, F.transform(full, lambda item: item["cell"])).otherwise(twice)
    return rows.select(ROW_ID, cells.alias("cells"))


def _spread(rows: DataFrame, variables: list[Variable], read) -> DataFrame:
    """Columns from the gathered cells; our row id steps aside for a variable of that name."""
    place = {i: n for n, i in enumerate(sorted(v.variable_id for v in variables))}
    own = any(v.name == ROW_ID for v in variables)
    return rows.select(
        F.col(ROW_ID).alias(INNER_ROW_ID if own else ROW_ID),
        *[
            read(F.get("cells", F.lit(place[v.variable_id])), v.value_type_id).alias(v.name)
            for v in variables
        ],
    )


def pivot_text(long: DataFrame, variables: list[Variable], gathered: bool = False) -> DataFrame:
    """Wide rows of text, one column per variable (operator E-3)."""
    if not variables:
        return long.select(ROW_ID).limit(0)
    return _spread(_gather(long, variables, F.col("value"), gathered), variables, lambda c, _: c)


def pivot_typed_text(
    long: DataFrame, variables: list[Variable], strict: bool = True, gathered: bool = False
) -> DataFrame:
    """Wide rows cast to the declared types, from the text store (operators E-3, E-4)."""
    if not variables:
        return long.select(ROW_ID).limit(0)
    rows = _gather(long, variables, F.col("value"), gathered)
    return _spread(rows, variables, lambda c, kind: V.read_text(c, kind, strict))


def pivot_typed(long: DataFrame, variables: list[Variable], gathered: bool = False) -> DataFrame:
    """Wide typed rows from the typed store (operator E-4)."""
    if not variables:
        return long.select(ROW_ID).limit(0)
    cell = F.struct("value_integer", "value_float", "value_string", "value_datetime")
    return _spread(_gather(long, variables, cell, gathered), variables, V.read_typed)


def cell_names(long: DataFrame, variables: DataFrame) -> DataFrame:
    """(row_id, variable, value) of a dataset (operator D-5)."""
    from longhouse.operators.joins import lookup_join

    names = variables.select("variable_id", F.col("name").alias("variable"))
    return lookup_join(long, names, ["variable_id"]).select(
        ROW_ID, "variable", "value"
    )


def dataset_column(long: DataFrame, variable: Variable) -> DataFrame:
    """One variable of a text dataset as (row_id, <name>) (operator D-8)."""
    return long.where(F.col("variable_id") == variable.variable_id).select(
        ROW_ID, F.col("value").alias(variable.name)
    )


def typed_dataset_column(long: DataFrame, variable: Variable) -> DataFrame:
    """One variable of a typed dataset, read by its declared type (operator D-8)."""
    cell = F.struct("value_integer", "value_float", "value_string", "value_datetime")
    return long.where(F.col("variable_id") == variable.variable_id).select(
        ROW_ID, V.read_typed(cell, variable.value_type_id).alias(variable.name)
    )


def row_bind(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns (operator G-1).

    Columns keep first-appearance order and are null where a frame lacks them. Numbers of
    different types are widened by Spark; any other clash of types becomes text.
    """
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    as_text = {n for n, seen in kinds.items() if len(seen) > 1 and not seen <= numeric}

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                V.plain_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                if f.name in as_text
                else F.col(f"`{f.name}`")
                for f in df.schema.fields
            ]
        )

    bound = aligned(frames[0])
    for df in frames[1:]:
        bound = bound.unionByName(aligned(df), allowMissingColumns=True)
    return bound.select(*[f"`{n}`" for n in kinds])
