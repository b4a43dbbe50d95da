"""Datasets: wide deliveries stored as cells, with their lineage and links."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longhouse.config import IngestConfig, UserIngestConfig
from longhouse.functions import values as V
from longhouse.operators import registry
from longhouse.operators.keys import Placed, numbered, place_rows
from longhouse.operators.lookup import variable_id
from longhouse.operators.reshape import (
    INNER_ROW_ID,
    ROW_ID,
    Variable,
    unpivot_text,
    unpivot_typed,
    variables_of,
)
from longhouse.plans.dictionary import add_domain
from longhouse.plans.metadata import add_source, source_path
from longhouse.plans.registry import register_ingestion
from longhouse.session import with_scratch
from longhouse.sources.archive import Archive, Batch
from longhouse.sources.delimited import read_csv

#: Cells of a bucket, which one task reads, at most; small datasets have buckets of the second number and
#: more, as many as the cluster has cores.
BUCKET_CELLS, LEAST_CELLS = 4_000_000, 50_000
#: Datasets of one ingest that are read or written at the same time.
DATASETS_AT_ONCE = 4

T_ = TypeVar("T_")


def register_transformation(batch: Batch, ingest: IngestConfig | UserIngestConfig) -> int:
    """A new transformation (operator I-4)."""
    return batch.insert_row(
        "transformations",
        {
            "transformation_type_id": ingest.transformation_type_id,
            "transformation_status_id": ingest.transformation_status_id,
            "description": ingest.transform_desc,
            "code_reference": bytearray(ingest.code_reference),
            "date_created": ingest.as_of or date.today(),
            "created_by": ingest.author,
        },
    )


@dataclass(frozen=True)
class NamedRows:
    """Staged rows and the variables of their columns."""

    rows: Placed
    variables: list[Variable]


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], T_]]) -> list[T_]:
    """What the tasks return, run from a pool so that their Spark jobs overlap; an error stops what has not begun.

    Jobs keep the caller's job group and local properties. Each task has a scheduler pool of its own, which counts
    where the cluster schedules fairly.
    """
    if len(tasks) < 2:
        return [task() for task in tasks]

    def run(number: int, task: Callable[[], T_]) -> T_:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"ingest-{number}")
        return task()

    with ThreadPoolExecutor(min(len(tasks), DATASETS_AT_ONCE)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(run), k, t) for k, t in enumerate(tasks)]
        try:
            return [r.result() for r in running]
        finally:
            for r in running:
                r.cancel()


class DatasetWriter:
    """Collects the datasets of one batch and writes what they add to the lineage tables."""

    def __init__(self, batch: Batch, domain_id: int, transformation_id: int, ingestion_id: int):
        self.batch = batch
        self.domain_id = domain_id
        self.transformation_id = transformation_id
        self.ingestion_id = ingestion_id
        self.datasets: list[tuple] = []
        self.inputs: list[tuple] = []
        self.members: list[tuple] = []
        dictionary = batch.table("variables").where(F.col("domain_id") == domain_id)
        self.variables: dict[str, Variable] = {v.name: v for v in variables_of(dictionary)}
        self._dataset = batch.last_id("datasets")
        self._row = batch.last_id("datarows")
        self._first_row: dict[int, int] = {}

    def save(
        self,
        frame: DataFrame,
        name: str,
        description: str,
        unit_of_analysis_id: int,
        as_of: date | None = None,
        inputs: Sequence[int] = (),
        typed: bool = False,
    ) -> tuple[int, DataFrame]:
        """Store a wide frame (pipeline J-10); returns its id and the frame with row ids.

        Row ids are dense. The numbered frame is staged, so that the delivery is read and parsed
        once; cells, rows and links are then written from the staged copy without a shuffle.
        """
        placed = self.place(frame, name)
        dataset_id = self.add(placed, name, description, unit_of_analysis_id, as_of, inputs)
        return dataset_id, self.write(placed, dataset_id, typed)

    def place(self, frame: DataFrame, name: str) -> NamedRows:
        """A frame's rows staged in places, and its variables; frames can be placed side by side."""
        missing = sorted(set(frame.columns) - set(self.variables))
        if missing:
            raise ValueError(f"{name}: columns missing from the dictionary: {', '.join(missing)}")
        own = [v for v in self.variables.values() if v.name in frame.columns]
        return NamedRows(place_rows(frame), own)

    def add(
        self,
        placed: NamedRows,
        name: str,
        description: str,
        unit_of_analysis_id: int,
        as_of: date | None = None,
        inputs: Sequence[int] = (),
    ) -> int:
        """The id of a placed dataset, whose rows get the next numbers."""
        self._dataset += 1
        self._first_row[self._dataset] = self._row
        self._row += placed.rows.count
        self.datasets.append(
            (self._dataset, name, as_of or date.today(), description, unit_of_analysis_id)
        )
        self.members += [(self._dataset, v.variable_id) for v in placed.variables]
        self.inputs += [(self.transformation_id, i) for i in inputs]
        return self._dataset

    def write(self, placed: NamedRows, dataset_id: int, typed: bool = False) -> DataFrame:
        """Store an added dataset's rows and cells; datasets can be written side by side."""
        rows = numbered(placed.rows, INNER_ROW_ID, self._first_row[dataset_id])
        ids = rows.select(F.col(INNER_ROW_ID).alias(ROW_ID))
        self.batch.write("datarows", ids, partition=dataset_id, last=self._row)
        unpivot = unpivot_typed if typed else unpivot_text
        # rows move, before they are cells, to where theirs are written: the cells of a row lie in one
        # bucket, by variable, so that row groups hold few of them and a column is read by itself
        cells = placed.rows.count * len(placed.variables)
        spread = min(self.batch.archive.spark.sparkContext.defaultParallelism, -(-cells // LEAST_CELLS))
        buckets = max(1, spread, -(-cells // BUCKET_CELLS))
        dealt = rows.repartition(buckets, INNER_ROW_ID)
        self.batch.write(
            "typed_data" if typed else "data",
            unpivot(dealt, placed.variables, INNER_ROW_ID),
            partition=dataset_id,
            buckets=buckets,
        )
        return rows

    def finish(self) -> None:
        """Register the datasets, their origin and their variables (operators I-5, I-6)."""
        spark = self.batch.archive.spark
        self.batch.write(
            "datasets",
            spark.createDataFrame(
                self.datasets,
                "dataset_id long, name string, date_created date, description string, "
                "unit_of_analysis_id int",
            ),
        )
        ids = [d[0] for d in self.datasets]
        self.batch.insert_rows(
            "ingest_datasets",
            [
                {
                    "data_ingestion_id": self.ingestion_id,
                    "transformation_id": self.transformation_id,
                    "dataset_id": i,
                }
                for i in ids
            ],
        )
        pair = "transformation_id long, dataset_id long"
        outputs = [(self.transformation_id, i) for i in ids]
        self.batch.write("transformation_outputs", spark.createDataFrame(outputs, pair))
        if self.inputs:
            inputs = spark.createDataFrame(self.inputs, pair).distinct()
            self.batch.write("transformation_inputs", inputs)
        self.batch.write(
            "dataset_variables",
            spark.createDataFrame(self.members, "dataset_id long, variable_id long"),
        )


def row_ids_and_values(rows: DataFrame, id_col: str, id_type: int) -> DataFrame:
    """(row_id, value) of the id column of a numbered dataset, as its cells hold it."""
    dtype = rows.schema[id_col].dataType
    value = V.cell_text(F.col(f"`{id_col}`"), dtype, id_type)
    return rows.select(F.col(INNER_ROW_ID).alias(ROW_ID), value.alias("value"))


@with_scratch
def ingest_data(
    archive: Archive,
    ingest: IngestConfig,
    datapath: str,
    ingestion_id: int = 0,
    typed: bool = False,
    declared_types: bool = True,
) -> list[int]:
    """Store and link all datasets of an ingest (pipeline J-9); returns their ids.

    Datasets are read, and then stored, side by side; one that fails leaves nothing published.
    ``ingestion_id`` 0 makes a new ingestion. ``typed`` stores typed cells. Files are converted as
    the dictionary declares; without ``declared_types`` a pass of its own infers their types.
    """
    batch = archive.begin()
    source_id = add_source(batch, ingest.source.name)
    domain_id = add_domain(batch, ingest.domain_name, ingest.domain_description)
    if ingestion_id == 0:
        ingestion_id = register_ingestion(batch, source_id, ingest.ingest_desc, ingest.as_of)
    writer = DatasetWriter(batch, domain_id, register_transformation(batch, ingest), ingestion_id)
    if ingest.id_col not in writer.variables:
        raise LookupError(f"id column {ingest.id_col} is not in the dictionary")
    deaths = batch.table("deaths")
    if registry.has_deaths(deaths, ingestion_id):
        death_ingestion = ingestion_id
    else:
        death_ingestion = registry.latest_death_ingestion(
            batch.table("data_ingestions"), deaths, source_id
        )
    known = deaths.where(F.col("data_ingestion_id") == death_ingestion)
    kinds = {v.name: v.value_type_id for v in writer.variables.values()}
    folder = source_path(datapath, ingest.source.name, ingest.source.datafolder)
    declared = kinds if declared_types else None
    files = sorted(ingest.datasets.items())

    def place(name: str) -> NamedRows:
        return writer.place(read_csv(archive.spark, f"{folder}/{name}", ingest.csv, types=declared), name)

    def store(placed: NamedRows, dataset_id: int) -> None:
        rows = writer.write(placed, dataset_id, typed)
        if ingest.id_col in rows.columns:
            # row ids are new, so no earlier link can hold them
            ids = row_ids_and_values(rows, ingest.id_col, kinds[ingest.id_col])
            batch.write("death_rows", registry.link_rows(known, ids), partition=dataset_id)

    # ids go on from file to file, so all rows are counted before any is numbered
    placed = side_by_side(archive.spark, [partial(place, name) for _, name in files])
    saved = [
        writer.add(rows, name, description, ingest.unit_of_analysis_id, ingest.as_of)
        for rows, (description, name) in zip(placed, files)
    ]
    side_by_side(archive.spark, [partial(store, *pair) for pair in zip(placed, saved)])
    writer.finish()
    _link_instruments(batch, ingest.source.instruments)
    batch.publish()
    return saved


def _link_instruments(batch: Batch, instruments: dict[str, str]) -> None:
    if not instruments:
        return
    pairs = batch.archive.spark.createDataFrame(
        sorted(instruments.items()), "instrument_name string, dataset_name string"
    )
    linked = registry.link_instruments(pairs, batch.table("instruments"), batch.table("datasets"))
    problem = registry.unknown_instrument_links(linked).first()
    if problem:
        raise LookupError(problem[0])
    ids = linked.select("instrument_id", "dataset_id")
    existing = batch.table("instrument_datasets")
    batch.write("instrument_datasets", ids.join(existing, ids.columns, "left_anti"))


@with_scratch
def ingest_derived(archive: Archive, ingest: UserIngestConfig) -> list[int]:
    """Store datasets a user made from stored ones, with their inputs (operator I-6).

    The variables of the domain must have been added before.
    """
    batch = archive.begin()
    source_id = add_source(batch, ingest.source_name)
    domain_id = add_domain(batch, ingest.domain_name, ingest.domain_description)
    ingestion_id = register_ingestion(batch, source_id, ingest.ingest_desc, ingest.as_of)
    writer = DatasetWriter(batch, domain_id, register_transformation(batch, ingest), ingestion_id)
    saved = [
        writer.save(
            frame,
            name,
            name,
            ingest.unit_of_analysis_id,
            ingest.as_of,
            inputs=ingest.input_datasets.get(name, ()),
        )[0]
        for name, frame in sorted(ingest.datasets.items())
    ]
    writer.finish()
    batch.publish()
    return saved


@with_scratch
def link_dataset(archive: Archive, dataset_id: int, domain_id: int, id_col: str, ingestion_id: int) -> None:
    """Link a stored dataset to the deaths of one ingestion; linking twice adds nothing (D-4).

    The ids are read from whichever store holds the dataset's cells.
    """
    wanted = variable_id(archive.table("variables"), domain_id, id_col)
    if wanted is None:
        raise LookupError(f"id column {id_col} is not in the dictionary")
    batch = archive.begin()
    own = (F.col("dataset_id") == dataset_id) & (F.col("variable_id") == wanted)
    typed = archive.table("typed_data").where(own)
    text = F.coalesce(
        "value_string",
        F.col("value_integer").cast("string"),
        V.number_text(F.col("value_float"), T.DoubleType()),
        V.plain_text(F.col("value_datetime"), T.TimestampNTZType()),
    )
    cells = archive.table("data").where(own).select(ROW_ID, "value")
    cells = cells.unionByName(typed.select(ROW_ID, text.alias("value")))
    deaths = archive.table("deaths").where(F.col("data_ingestion_id") == ingestion_id)
    before = archive.table("death_rows").where(F.col("dataset_id") == dataset_id)
    batch.write("death_rows", registry.link_rows(deaths, cells, before), partition=dataset_id)
    batch.publish()
