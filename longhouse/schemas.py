"""Tables of the archive: columns, keys, references and seed rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Ids of the seven value types.
INTEGER = 1
FLOAT = 2
STRING = 3
DATE = 4
DATETIME = 5
TIME = 6
CATEGORY = 7

TEMPORAL = (DATE, DATETIME, TIME)

# Ids used by ingests and transformations.
TRANSFORMATION_INGEST = 1
TRANSFORMATION_TRANSFORM = 2
STATUS_UNVERIFIED = 1
STATUS_VERIFIED = 2
UNIT_INDIVIDUAL = 1
UNIT_AGGREGATION = 2

# Seed rows.
SEEDS: dict[str, list[tuple]] = {
    "study_types": [
        (1, "Demographic Surveillance"),
        (2, "Cohort study"),
        (3, "Cross-sectional survey"),
        (4, "Panel data"),
    ],
    "transformation_types": [(1, "Raw data ingest"), (2, "Dataset transform")],
    "transformation_statuses": [(1, "Unverified"), (2, "Verified")],
    "value_types": [
        (1, "Integer", ""),
        (2, "Float", ""),
        (3, "String", ""),
        (4, "Date", "ISO Date yyyy-mm-dd"),
        (5, "Datetime", "ISO Datetime yyyy-mm-ddTHH:mm:ss.sss"),
        (6, "Time", "ISO Time HH:mm:ss.sss"),
        (
            7,
            "Categorical",
            "Category represented by a Vocabulary with integer value and string code, "
            "stored as Integer",
        ),
    ],
    "unit_of_analysis_types": [(1, "Individual"), (2, "Aggregation")],
}


@dataclass(frozen=True)
class Table:
    """One archive table. ``columns`` is a DDL string."""

    columns: str
    key: str | None = None  # surrogate key column
    unique: tuple[tuple[str, ...], ...] = ()
    parents: tuple[tuple[str, str], ...] = ()  # (column, parent table) on equal column names
    revised: bool = False  # rows change later, so every batch that touches it writes it whole
    partition: str | None = None
    bucketed: str | None = None  # rows of one value lie in one file, within a partition
    searched: tuple[str, ...] = ()  # columns that are looked up by value; files have Bloom filters of them

    @property
    def required(self) -> list[str]:
        return [f.name for f in T.StructType.fromDDL(self.columns).fields if not f.nullable]

    @property
    def schema(self) -> T.StructType:
        # rows are checked when a batch is published; until then any column may be null
        fields = T.StructType.fromDDL(self.columns).fields
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


# Names of tables and columns.
TABLES: dict[str, Table] = {
    "study_types": Table("study_type_id int NOT NULL, name string NOT NULL", "study_type_id"),
    "transformation_types": Table("transformation_type_id int NOT NULL, name string NOT NULL"),
    "transformation_statuses": Table("transformation_status_id int NOT NULL, name string NOT NULL"),
    "value_types": Table(
        "value_type_id int NOT NULL, value_type string NOT NULL, description string", unique=(("value_type",),)
    ),
    "unit_of_analysis_types": Table("unit_of_analysis_id int NOT NULL, name string NOT NULL"),
    "sources": Table(
        "source_id long NOT NULL, name string NOT NULL, study_type_id int",
        "source_id",
        parents=(("study_type_id", "study_types"),),
        revised=True,
    ),
    "sites": Table(
        "site_id long NOT NULL, site_name string NOT NULL, country_name string NOT NULL, country_iso3 string NOT NULL, "
        "source_id long NOT NULL",
        "site_id",
        unique=(("source_id", "site_name"),),
        parents=(("source_id", "sources"),),
    ),
    "protocols": Table(
        "protocol_id long NOT NULL, name string NOT NULL, description string NOT NULL, ethics_id long",
        "protocol_id",
        unique=(("name",),),
        parents=(("ethics_id", "ethics"),),
        revised=True,
    ),
    "site_protocols": Table(
        "site_id long NOT NULL, protocol_id long NOT NULL",
        unique=(("site_id", "protocol_id"),),
        parents=(("site_id", "sites"), ("protocol_id", "protocols")),
    ),
    "protocol_documents": Table(
        "protocol_document_id long NOT NULL, protocol_id long NOT NULL, name string NOT NULL, document string",
        "protocol_document_id",
        parents=(("protocol_id", "protocols"),),
    ),
    "ethics": Table(
        "ethics_id long NOT NULL, source_id long NOT NULL, name string NOT NULL, ethics_committee string NOT NULL, "
        "ethics_reference string NOT NULL",
        "ethics_id",
        parents=(("source_id", "sources"),),
    ),
    "ethics_documents": Table(
        "ethics_document_id long NOT NULL, ethics_id long NOT NULL, name string NOT NULL, description string, "
        "document string",
        "ethics_document_id",
        unique=(("ethics_id", "name"),),
        parents=(("ethics_id", "ethics"),),
    ),
    "instruments": Table(
        "instrument_id long NOT NULL, name string NOT NULL, description string NOT NULL, collection_cycle string, "
        "collection_start date, collection_end date",
        "instrument_id",
        unique=(("name",),),
    ),
    "instrument_documents": Table(
        "intrument_document_id long NOT NULL, instrument_id long NOT NULL, name string NOT NULL, document string",
        "intrument_document_id",
        unique=(("instrument_id", "name"),),
        parents=(("instrument_id", "instruments"),),
    ),
    "instrument_datasets": Table(
        "instrument_id long NOT NULL, dataset_id long NOT NULL",
        unique=(("instrument_id", "dataset_id"),),
        parents=(("instrument_id", "instruments"), ("dataset_id", "datasets")),
    ),
    "domains": Table(
        "domain_id long NOT NULL, name string NOT NULL, description string", "domain_id", unique=(("name",),)
    ),
    "vocabularies": Table(
        "vocabulary_id long NOT NULL, name string NOT NULL, description string", "vocabulary_id"
    ),
    "vocabulary_items": Table(
        "vocabulary_item_id long NOT NULL, vocabulary_id long NOT NULL, value string NOT NULL, code string NOT NULL, "
        "description string",
        "vocabulary_item_id",
        parents=(("vocabulary_id", "vocabularies"),),
    ),
    "variables": Table(
        "variable_id long NOT NULL, domain_id long NOT NULL, name string NOT NULL, value_type_id int NOT NULL, "
        "vocabulary_id long, description string, note string, keyrole string",
        "variable_id",
        unique=(("domain_id", "name"),),
        parents=(
            ("domain_id", "domains"),
            ("value_type_id", "value_types"),
            ("vocabulary_id", "vocabularies"),
        ),
        revised=True,
    ),
    "data_ingestions": Table(
        "data_ingestion_id long NOT NULL, source_id long NOT NULL, date_received date NOT NULL, description string",
        "data_ingestion_id",
        parents=(("source_id", "sources"),),
    ),
    "transformations": Table(
        "transformation_id long NOT NULL, transformation_type_id int NOT NULL, transformation_status_id int NOT NULL, "
        "description string NOT NULL, code_reference binary NOT NULL, date_created date NOT NULL, created_by string NOT NULL",
        "transformation_id",
        parents=(
            ("transformation_type_id", "transformation_types"),
            ("transformation_status_id", "transformation_statuses"),
        ),
    ),
    "datasets": Table(
        "dataset_id long NOT NULL, name string NOT NULL, date_created date NOT NULL, description string, "
        "unit_of_analysis_id int, repository_id string, doi string",
        "dataset_id",
        parents=(("unit_of_analysis_id", "unit_of_analysis_types"),),
    ),
    "ingest_datasets": Table(
        "ingest_dataset_id long NOT NULL, data_ingestion_id long NOT NULL, transformation_id long NOT NULL, "
        "dataset_id long NOT NULL",
        "ingest_dataset_id",
        parents=(
            ("data_ingestion_id", "data_ingestions"),
            ("transformation_id", "transformations"),
            ("dataset_id", "datasets"),
        ),
    ),
    "transformation_inputs": Table(
        "transformation_id long NOT NULL, dataset_id long NOT NULL",
        unique=(("transformation_id", "dataset_id"),),
        parents=(("transformation_id", "transformations"), ("dataset_id", "datasets")),
    ),
    "transformation_outputs": Table(
        "transformation_id long NOT NULL, dataset_id long NOT NULL",
        unique=(("transformation_id", "dataset_id"),),
        parents=(("transformation_id", "transformations"), ("dataset_id", "datasets")),
    ),
    "dataset_variables": Table(
        "dataset_id long NOT NULL, variable_id long NOT NULL",
        unique=(("dataset_id", "variable_id"),),
        parents=(("dataset_id", "datasets"), ("variable_id", "variables")),
    ),
    "datarows": Table(
        "row_id long NOT NULL, dataset_id long NOT NULL",
        "row_id",
        parents=(("dataset_id", "datasets"),),
        partition="dataset_id",
    ),
    "data": Table(
        "row_id long NOT NULL, variable_id long NOT NULL, value string, dataset_id long NOT NULL",
        unique=(("row_id", "variable_id"),),
        parents=(("variable_id", "variables"),),
        partition="dataset_id",
        bucketed="row_id",
        searched=("value",),
    ),
    "typed_data": Table(
        "row_id long NOT NULL, variable_id long NOT NULL, value_integer long, value_float double, "
        "value_string string, value_datetime timestamp_ntz, value_binary binary, "
        "dataset_id long NOT NULL",
        unique=(("row_id", "variable_id"),),
        parents=(("variable_id", "variables"),),
        partition="dataset_id",
        bucketed="row_id",
    ),
    "deaths": Table(
        "death_id long NOT NULL, site_id long NOT NULL, external_id string NOT NULL, data_ingestion_id long NOT NULL",
        "death_id",
        unique=(("site_id", "external_id"),),
        parents=(("site_id", "sites"), ("data_ingestion_id", "data_ingestions")),
        partition="data_ingestion_id",
        searched=("external_id",),
    ),
    "death_rows": Table(
        "death_id long NOT NULL, row_id long NOT NULL, dataset_id long NOT NULL",
        unique=(("death_id", "row_id"),),
        parents=(("death_id", "deaths"), ("row_id", "datarows")),
        partition="dataset_id",
    ),
}


def seed_table(spark: SparkSession, name: str) -> DataFrame:
    """Seed rows of a reference table (operator B-11)."""
    return spark.createDataFrame(SEEDS[name], TABLES[name].schema)
