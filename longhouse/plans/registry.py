"""Registration of the individuals a delivery is about."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from longhouse.config import IngestConfig
from longhouse.operators.keys import assign_ids
from longhouse.operators.lookup import named_key, select_rows
from longhouse.operators.registry import match_sites
from longhouse.plans.metadata import source_path
from longhouse.session import with_scratch
from longhouse.sources.archive import Archive, Batch
from longhouse.sources.delimited import read_csv


def register_ingestion(batch: Batch, source_id: int, description: str, as_of: date | None) -> int:
    """A new ingestion of a source (operator I-3), stamped with a date (H-18)."""
    return batch.insert_row(
        "data_ingestions",
        {"source_id": source_id, "date_received": as_of or date.today(), "description": description},
    )


@with_scratch
def ingest_deaths(archive: Archive, ingest: IngestConfig, datapath: str) -> int:
    """Register the individuals in the death file and return the ingestion's id (pipeline J-6).

    Rows whose site is unknown are left out; ``operators.registry.unmatched_sites`` lists them.
    """
    source_id = named_key(archive.table("sources"), ingest.source.name, "source_id")
    if source_id is None:
        raise LookupError(f"source {ingest.source.name} is not registered")
    batch = archive.begin()
    ingestion_id = register_ingestion(batch, source_id, ingest.ingest_desc, ingest.as_of)
    folder = source_path(datapath, ingest.source.name, ingest.source.datafolder)
    delivered = read_csv(archive.spark, f"{folder}/{ingest.death_file}", ingest.csv)
    sites = select_rows(archive.table("sites"), ["site_id", "site_name"], {"source_id": source_id})
    matched = match_sites(
        delivered.withColumn(
            ingest.source.site_col, F.col(f"`{ingest.source.site_col}`").cast("string")
        ),
        sites,
        ingest.id_col,
        ingest.source.site_col,
        ingestion_id,
    )
    deaths = assign_ids(matched, "death_id", batch.last_id("deaths"))
    batch.write("deaths", deaths.drop("data_ingestion_id"), partition=ingestion_id)
    batch.publish()
    return ingestion_id
