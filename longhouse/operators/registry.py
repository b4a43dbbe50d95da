"""The registry of individuals: registration, latest ingestion, links to dataset rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longhouse.functions.values import plain_text
from longhouse.operators.joins import lookup_join


def country_key(names: DataFrame, country_col: str) -> Column:
    """How the countries of all sites are given: iso2, iso3 or country (operators C-5, E-8).

    Codes are taken as such only if every row has one of that length. The answer is a single
    value, so it is attached as a scalar subquery.
    """
    size = F.length(F.col(country_col))
    # a null country is not a code, so the whole list is then taken as names
    kind = (
        F.when(F.bool_and(F.coalesce(size == 2, F.lit(False))), F.lit("iso2"))
        .when(F.bool_and(F.coalesce(size == 3, F.lit(False))), F.lit("iso3"))
        .otherwise(F.lit("country"))
    )
    return names.agg(kind).scalar()


def with_country_codes(sites: DataFrame, codes: DataFrame, country_col: str = "country_name") -> DataFrame:
    """Sites with country name and iso3 code from the lookup (operators C-5, D-1).

    ``codes`` has country, iso2 and iso3. Unknown countries give null; a code that is listed twice
    gives two rows.
    """
    kind = country_key(sites.select(country_col), country_col)
    given = F.col(country_col)
    keyed = sites.withColumn("__kind", kind).withColumn(
        "__key", F.when(F.col("__kind") == "country", given).otherwise(F.upper(given))
    )
    ways = ["iso2", "iso3", "country"]
    listed = codes.select(
        "country",
        "iso3",
        F.inline(F.array(*[F.struct(F.lit(w).alias("__kind"), F.col(w).alias("__key")) for w in ways])),
    ).where(F.col("__key").isNotNull())
    found = lookup_join(keyed, listed, ["__kind", "__key"], "left")
    others = [c for c in sites.columns if c != country_col]
    # by name a site keeps the name it came with; codes are replaced by the listed name
    name = F.when(F.col("__kind") == "country", given).otherwise(F.col("country"))
    iso3 = F.when(F.col("__kind") == "iso3", F.col("__key")).otherwise(F.col("iso3"))
    return found.select(*others, name.alias("country_name"), iso3.alias("country_iso3"))


def match_sites(
    delivered: DataFrame, sites: DataFrame, id_col: str, site_col: str, ingestion_id: int | Column
) -> DataFrame:
    """(site_id, external_id, data_ingestion_id) of the rows with a known site (operator D-2).

    An id has the text that a cell of the same type has, so that the two match later.
    """
    rows = delivered.select(
        F.col(f"`{site_col}`").alias("site_name"),
        plain_text(F.col(f"`{id_col}`"), delivered.schema[id_col].dataType).alias("external_id"),
        (F.lit(ingestion_id) if isinstance(ingestion_id, int) else ingestion_id)
        .cast("long")
        .alias("data_ingestion_id"),
    )
    known = sites.select("site_id", "site_name")
    return lookup_join(rows, known, ["site_name"]).select(
        "site_id", "external_id", "data_ingestion_id"
    )


def unmatched_sites(delivered: DataFrame, sites: DataFrame, site_col: str) -> DataFrame:
    """Delivered rows that ``match_sites`` leaves out, their site being null or unknown."""
    known = sites.select(F.col("site_name").alias(site_col), F.lit(True).alias("__known")).distinct()
    found = lookup_join(delivered, known, [site_col], "left")
    return found.where(F.col("__known").isNull()).select(*[f"`{c}`" for c in delivered.columns])


def link_rows(deaths: DataFrame, ids: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New (death_id, row_id) pairs where the id of a row is an external id (operator D-4).

    ``ids`` is (row_id, value) of the id variable of one dataset; ``deaths`` are those of one
    ingestion. Ids match as text. An external id that two sites use links a row to both. Pairs
    that ``existing`` holds already are left out.
    """
    known = deaths.where(F.col("external_id").isNotNull()).select(
        "death_id", F.col("external_id").alias("value")
    )
    # death_id and row_id are keys of their tables, so a pair cannot come twice
    pairs = lookup_join(ids.select("row_id", "value"), known, ["value"])
    pairs = pairs.select("death_id", "row_id")
    if existing is None:
        return pairs
    return pairs.join(existing, ["death_id", "row_id"], "left_anti")


def deaths_by_ingestion(deaths: DataFrame) -> DataFrame:
    """Number of registered individuals of each ingestion (operator E-2)."""
    return deaths.groupBy("data_ingestion_id").agg(F.count(F.lit(1)).alias("n"))


def has_deaths(deaths: DataFrame, ingestion_id: int) -> bool:
    """Whether an ingestion registered anyone (operator E-2)."""
    return not deaths.where(F.col("data_ingestion_id") == ingestion_id).isEmpty()


def latest_death_ingestions(ingestions: DataFrame, deaths: DataFrame) -> DataFrame:
    """Latest ingestion of each source that registered anyone (operators F-3, D-11).

    Of two ingestions on one day the one with the higher id is the later.
    """
    used = deaths.select("data_ingestion_id").distinct()
    return (
        ingestions.join(used, "data_ingestion_id", "left_semi")
        .groupBy("source_id")
        .agg(
            F.max_by("data_ingestion_id", F.struct("date_received", "data_ingestion_id")).alias(
                "data_ingestion_id"
            )
        )
    )


def latest_death_ingestion(ingestions: DataFrame, deaths: DataFrame, source_id: int) -> int:
    """Latest ingestion of one source; an error if it never registered anyone."""
    own = ingestions.where(F.col("source_id") == source_id)
    row = latest_death_ingestions(own, deaths).first()
    if row is None:
        raise LookupError(f"deaths of source {source_id} have not been ingested")
    return row.data_ingestion_id


def link_instruments(
    pairs: DataFrame, instruments: DataFrame, datasets: DataFrame
) -> DataFrame:
    """(instrument_id, dataset_id) for pairs of names (operator D-12).

    ``pairs`` has instrument_name and dataset_name. A dataset name that was ingested more than
    once stands for its first dataset. Names that are unknown give null ids; see
    ``unknown_instrument_links``.
    """
    from longhouse.operators.lookup import named_keys

    keyed = named_keys(pairs, "dataset_name", datasets, "dataset_id")
    return named_keys(keyed, "instrument_name", instruments, "instrument_id")


# What a caller is told of names that are not there.
NOT_INGESTED = {"dataset_name": "Data file %s is not ingested.", "instrument_name": "Instrument file %s is not ingested."}


def unknown_instrument_links(linked: DataFrame) -> DataFrame:
    """Why a linked pair is incomplete, one row per name that is not ingested."""
    told = {column: F.format_string(text, column) for column, text in NOT_INGESTED.items()}
    return linked.where("dataset_id IS NULL OR instrument_id IS NULL").select(
        F.when(F.col("dataset_id").isNull(), told["dataset_name"]).otherwise(told["instrument_name"]).alias("problem")
    )


def site_protocols(sites: DataFrame, protocols: DataFrame, on: Sequence[str] = ("source_id",)) -> DataFrame:
    """Every protocol of a source for every site of that source (operator D-10).

    The pairing is an equi-join on the source, not a product of the two tables.
    """
    return lookup_join(
        sites.select("site_id", *on), protocols.select("protocol_id", *on), list(on),
    ).select("site_id", "protocol_id")
