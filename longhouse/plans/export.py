"""Stored datasets as wide tables and files (pipeline J-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longhouse.operators import reshape
from longhouse.operators.lookup import dataset_name, dataset_variables
from longhouse.sources.archive import Archive
from longhouse.sources.arrow_ipc import write_arrow
from longhouse.sources.delimited import write_csv


def variables_of_dataset(archive: Archive, dataset_id: int) -> list[reshape.Variable]:
    rows = dataset_variables(
        archive.table("dataset_variables"), archive.table("variables"), dataset_id
    )
    return reshape.variables_of(rows.withColumnRenamed("variable", "name"))


def dataset_cells(archive: Archive, dataset_id: int, typed: bool = False) -> DataFrame:
    """The cells of one dataset; only its files are opened."""
    table = archive.table("typed_data" if typed else "data")
    return table.where(F.col("dataset_id") == dataset_id)


def dataset_to_dataframe(archive: Archive, dataset_id: int) -> DataFrame:
    """A dataset in wide form, all text (operators D-5, E-3); cells are read as they lie, none is moved."""
    cells, gathered = archive.part("data", dataset_id)
    return reshape.pivot_text(cells, variables_of_dataset(archive, dataset_id), gathered)


def dataset_to_typed(
    archive: Archive, dataset_id: int, typed: bool = False, strict: bool = True
) -> DataFrame:
    """A dataset in wide form with its declared types, from either store (operator E-4).

    A stored text that is not of its variable's type is an error, or null if not ``strict``.
    """
    variables = variables_of_dataset(archive, dataset_id)
    cells, gathered = archive.part("typed_data" if typed else "data", dataset_id)
    if typed:
        return reshape.pivot_typed(cells, variables, gathered)
    return reshape.pivot_typed_text(cells, variables, strict, gathered)


def _name(archive: Archive, dataset_id: int) -> str:
    name = dataset_name(archive.table("datasets"), dataset_id)
    if name is None:
        raise LookupError(f"there is no dataset {dataset_id}")
    return name


def dataset_to_csv(archive: Archive, dataset_id: int, path: str, compress: bool = False) -> str:
    """Export to ``csvfiles/<name>.csv``, or ``.gz`` with gzip (operator B-8)."""
    target = f"{path}/csvfiles/{_name(archive, dataset_id)}{'.gz' if compress else '.csv'}"
    return write_csv(dataset_to_dataframe(archive, dataset_id), target, compress=compress)


def dataset_to_arrow(archive: Archive, dataset_id: int, path: str) -> str:
    """Export to ``arrowfiles/<name>.arrow`` with zstd (operator B-9)."""
    target = f"{path}/arrowfiles/{_name(archive, dataset_id)}.arrow"
    return write_arrow(dataset_to_dataframe(archive, dataset_id), target)


def dataset_to_parquet(archive: Archive, dataset_id: int, path: str) -> str:
    """Export typed columns to ``parquetfiles/<name>.parquet`` with zstd."""
    target = f"{path}/parquetfiles/{_name(archive, dataset_id)}.parquet"
    dataset_to_typed(archive, dataset_id).write.mode("overwrite").option("compression", "zstd").parquet(target)
    return target
