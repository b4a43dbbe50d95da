"""What is known of a source besides its data: sites, instruments, protocols, ethics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longhouse.config import SourceConfig
from longhouse.operators.lookup import named_key, source_sites
from longhouse.operators.registry import site_protocols, with_country_codes
from longhouse.operators.upsert import assign_ethics, set_value
from longhouse.session import stage, with_scratch
from longhouse.sources.archive import Archive, Batch
from longhouse.sources.delimited import read_csv
from longhouse.sources.documents import read_documents


def source_path(datapath: str, source_name: str, folder: str) -> str:
    return f"{datapath.rstrip('/')}/{source_name}/{folder}"


@with_scratch
def ingest_source(archive: Archive, source: SourceConfig, datapath: str, iso3_path: str) -> None:
    """Register a source with everything that describes it, in one batch (pipeline J-1)."""
    batch = archive.begin()
    source_id = add_source(batch, source.name, source.study_type_id)
    add_sites(batch, source, source_id, datapath, iso3_path)
    add_instruments(batch, source, datapath)
    add_protocols_and_ethics(batch, source, source_id, datapath)
    batch.publish()


def add_source(batch: Batch, name: str, study_type_id: int | None = None) -> int:
    """Id of a source, which is added if it is new (E-10); its study type is set (B-4)."""
    sources = batch.table("sources")
    source_id = named_key(sources, name, "source_id")
    if source_id is None:
        source_id = batch.last_id("sources") + 1
        row = [(source_id, name, study_type_id)]
        new = batch.archive.spark.createDataFrame(row, sources.schema)
        batch.write("sources", sources.unionByName(new))
    elif study_type_id is not None:
        batch.write(
            "sources", set_value(sources, "source_id", source_id, "study_type_id", study_type_id)
        )
    return source_id


def delivered_sites(data: DataFrame, source: SourceConfig) -> DataFrame:
    """Distinct (site_name, country_name) of a delivery (operators C-1, C-2, E-1)."""
    site = F.col(f"`{source.site_col}`").cast("string").alias("site_name")
    country = (
        F.col(f"`{source.country_col}`").cast("string")
        if source.country_col
        else F.lit(source.country_name)
    )
    return data.select(site, country.alias("country_name")).distinct()


def add_sites(
    batch: Batch, source: SourceConfig, source_id: int, datapath: str, iso3_path: str
) -> None:
    """Sites of a source with country names and iso3 codes (pipeline J-2)."""
    spark = batch.archive.spark
    folder = source_path(datapath, source.name, source.datafolder)
    data = read_csv(spark, f"{folder}/{source.site_data}", source.csv)
    codes = spark.read.option("header", True).csv(iso3_path)
    # few rows out of the whole delivery; staged, so that it is scanned once
    sites = with_country_codes(stage(delivered_sites(data, source), "sites"), codes)
    batch.insert("sites", sites.withColumn("source_id", F.lit(source_id)), ["site_name"])


def add_instruments(batch: Batch, source: SourceConfig, datapath: str) -> None:
    """Instruments and their documents (pipeline J-3)."""
    if not source.instruments:
        return
    rows = [{"name": n, "description": d} for n, d in sorted(source.instruments.items())]
    batch.insert_rows("instruments", rows)
    owners = batch.added("instruments").select("instrument_id", "name")
    folder = source_path(datapath, source.name, source.instrumentfolder)
    _add_documents(batch, "instrument_documents", owners, folder)


def _add_documents(batch: Batch, table: str, owners: DataFrame, folder: str) -> None:
    """One document per owner, read from the file it is named after."""
    names = [r.name for r in owners.select("name").collect()]  # as many as are configured
    files = read_documents(batch.archive.spark, folder, names)
    batch.insert(table, owners.join(files, "name"), [owners.columns[0]])


def add_protocols_and_ethics(
    batch: Batch, source: SourceConfig, source_id: int, datapath: str
) -> None:
    """Protocols for every site, their ethics approvals and all documents (J-4, J-5)."""
    protocols = batch.table("protocols")
    if source.protocols:
        rows = [{"name": n, "description": d} for n, d in sorted(source.protocols.items())]
        new = batch.keyed_rows("protocols", rows)
        protocols = protocols.unionByName(new)
        sites = source_sites(batch.table("sources"), batch.table("sites"), source.name)
        own = new.withColumn("source_id", F.lit(source_id).cast("long"))
        batch.write("site_protocols", site_protocols(sites, own))
        folder = source_path(datapath, source.name, source.protocolfolder)
        _add_documents(batch, "protocol_documents", new.select("protocol_id", "name"), folder)
    if source.ethics:
        entries = sorted(source.ethics.items())
        rows = [
            {
                "source_id": source_id,
                "name": name,
                "ethics_committee": committee,
                "ethics_reference": reference,
            }
            for name, (_, committee, reference) in entries
        ]
        batch.insert_rows("ethics", rows)
        ethics = batch.added("ethics")
        described = batch.archive.spark.createDataFrame(
            [(name, description) for name, (description, _, _) in entries],
            "name string, description string",
        )
        owners = ethics.select("ethics_id", "name").join(described, "name")
        folder = source_path(datapath, source.name, source.ethicsfolder)
        _add_documents(
            batch, "ethics_documents", owners.select("ethics_id", "name", "description"), folder
        )
        protocols = assign_ethics(protocols, ethics)
    if source.protocols or source.ethics:
        batch.write("protocols", protocols)
