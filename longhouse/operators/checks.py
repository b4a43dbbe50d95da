"""Integrity checks that run as Spark jobs before a batch is published."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longhouse.schemas import TABLES

# The columns of a dictionary.
DICTIONARY_COLUMNS = ("Column_Name", "DataType", "Description", "Note", "Vocabulary")


SAMPLE = 5  # values that a problem names


class IntegrityError(ValueError):
    """A table would break a key, a reference or a required column."""


def require_columns(df: DataFrame, required: Sequence[str] = DICTIONARY_COLUMNS) -> None:
    """An error that lists the columns a dictionary lacks (operator C-6)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError("dictionary lacks columns: " + ", ".join(missing))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (operator K-1).

    A key with a null part is no duplicate. Counts combine before the shuffle.
    """
    for c in keys:
        df = df.where(F.col(c).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_col: str | None = None) -> DataFrame:
    """Values of ``column`` that the parent table lacks, with their row count (operator K-2).

    The child is counted per value before the join, so a value that many rows share is one row.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_col or column).alias(column))
    return values.join(known, column, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls in each column (operator K-3)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


class Rules:
    """What tables declare, checked in one pass: every rule's values are counted in the same shuffle.

    A row of the union is a value under a rule: a null in a required column, a key, a reference or a
    value of the parent that it refers to. Counts combine before the shuffle.
    """

    def __init__(self):
        self.texts: list[str] = []
        self._null: set[int] = set()
        self._rows: list[DataFrame] = []

    def _value(self, text: str, columns: Sequence[str], most: int, known: bool) -> Column:
        """A struct (rule, value, n, known, most); a value breaks its rule if it comes more than ``most``
        times and is not known. Null if one of the columns is null."""
        if text not in self.texts:
            self.texts.append(text)
        value = F.struct(
            F.lit(self.texts.index(text)).alias("rule"),
            F.to_json(F.struct(*columns)).alias("value"),
            F.lit(int(not known)).alias("n"),
            F.lit(known).alias("known"),
            F.lit(most).alias("most"),
        )
        return F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]), value)

    def _take(self, rows: DataFrame, values: list[Column]) -> None:
        if values:
            self._rows.append(rows.select(F.inline(F.array_compact(F.array(*values)))))

    def add(self, name: str, whole: DataFrame, added: DataFrame, table_of: Callable[[str], DataFrame]) -> None:
        """The rules of a table (operators K-1, K-2, K-3).

        Keys are checked over the whole table, nulls and references over the rows that were added.
        Surrogate keys go on from the largest in use and need no check.
        """
        table = TABLES[name]
        values = []
        for c in table.required:
            null = added.select(F.when(F.col(c).isNull(), F.lit(c)).alias("null"))
            self._take(null, [self._value(f"{name}: null in {c}", ["null"], 0, False)])
            self._null.add(len(self.texts) - 1)
        for column, parent in table.parents:
            text = f"{name}: {column} is not in {parent}"
            values.append(self._value(text, [column], 0, False))
            self._take(table_of(parent), [self._value(text, [column], 0, True)])
        self._take(added, values)
        keys = [self._value(f"{name}: duplicate {', '.join(key)}", key, 1, False) for key in table.unique]
        self._take(whole, keys)

    def broken(self) -> DataFrame:
        """(rule, value, n): values that break a rule."""
        counted = reduce(DataFrame.unionByName, self._rows).groupBy("rule", "value").agg(
            F.sum("n").alias("n"), F.bool_or("known").alias("known"), F.max("most").alias("most")
        )
        return counted.where("NOT known AND n > most").select("rule", "value", "n")

    def problems(self) -> list[str]:
        """What breaks a rule, one text for each, with some of the values."""
        if not self._rows:
            return []
        broken = self.broken()
        found = broken.groupBy("rule").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect()
        if not found:
            return []
        first = Window.partitionBy("rule").orderBy("value")
        sample = broken.withColumn("at", F.row_number().over(first)).where(F.col("at") <= SAMPLE)
        named: dict[int, list[str]] = {}
        for r in sample.orderBy("rule", "at").collect():  # SAMPLE rows a rule
            named.setdefault(r.rule, []).append(r.value)
        told = []
        for r in found:
            some = f" ({r.k} values in {r.n} rows: {', '.join(named[r.rule])})"
            told.append(self.texts[r.rule] + ("" if r.rule in self._null else some))
        return sorted(told)


def problems(
    name: str, whole: DataFrame, added: DataFrame, table_of: Callable[[str], DataFrame]
) -> list[str]:
    """What breaks the declarations of one table."""
    rules = Rules()
    rules.add(name, whole, added, table_of)
    return rules.problems()


def row_fingerprint(row_id: str = "row_id") -> list[Column]:
    """What tells a multiset of row ids whatever their order: how many, and the sums of two hashes of each.

    Two different multisets agree in all three by chance only, about once in 2**128 times.
    """
    hashes = [F.xxhash64(row_id), F.xxhash64(F.lit(1), row_id)]
    # the hash of a null is a number, too
    hashes = [F.when(F.col(row_id).isNotNull(), h.cast("decimal(20,0)")) for h in hashes]
    sums = [F.sum(h).alias(f"hash_{k}") for k, h in enumerate(hashes)]
    return [F.count(row_id).alias("n"), *sums]


def cell_problems(name: str, cells: DataFrame, datarows: DataFrame, variables: DataFrame) -> DataFrame:
    """Variables of new datasets that do not have one cell for each row, as (problem) (operator K-1).

    ``variables`` has the dataset_id and variable_id that should have cells. Every variable's
    fingerprint of row ids must be that of the dataset's rows: none is missing, none there twice, none of another
    row. Nothing but the sums is shuffled.
    """
    none = F.lit(None).cast("long")
    own = ["dataset_id", "variable_id", "row_id", "wanted"]
    rows = cells.select("dataset_id", "variable_id", "row_id", F.lit(False).alias("wanted"))
    rows = rows.unionByName(datarows.select("dataset_id", none.alias("variable_id"), "row_id", F.lit(False).alias("wanted")))
    rows = rows.unionByName(variables.select("dataset_id", "variable_id", none.alias("row_id"), F.lit(True).alias("wanted")))
    sums = rows.select(*own).groupBy("dataset_id", "variable_id").agg(F.bool_or("wanted").alias("wanted"), *row_fingerprint())
    print_ = F.struct("n", "hash_0", "hash_1")
    # a row for each variable; that without one is the dataset's rows
    whole = F.max(F.when(F.col("variable_id").isNull(), print_)).over(Window.partitionBy("dataset_id"))
    # a dataset without rows has no cells
    nothing = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(None).cast("decimal(30,0)").alias(f"hash_{k}") for k in (0, 1)])
    compared = sums.withColumn("same", print_.eqNullSafe(F.coalesce(whole, nothing))).where("variable_id IS NOT NULL")
    lacks = F.format_string(f"{name}: variable %d of dataset %d lacks cells or has some twice", "variable_id", "dataset_id")
    strange = F.format_string(f"{name}: variable %d is not one of dataset %d", "variable_id", "dataset_id")
    told = F.when(~F.col("wanted"), strange).when(~F.col("same"), lacks)
    return compared.select(told.alias("problem")).where("problem IS NOT NULL")


def require_none(problems: Sequence[str]) -> None:
    """Raise if there is any problem."""
    if problems:
        raise IntegrityError("; ".join(sorted(problems)))
