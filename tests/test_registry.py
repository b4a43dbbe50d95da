import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from longhouse import schemas as S
from longhouse.config import SourceConfig
from longhouse.operators import checks, lookup, registry
from longhouse.plans.metadata import delivered_sites

CODES = [("Kenya", "KE", "KEN"), ("Mali", "ML", "MLI"), ("Mali again", "ML", "MLX")]


@pytest.mark.parametrize(
    "given, want",
    [
        (["ke", "ml"], [("ke", "Kenya", "KEN"), ("ml", "Mali", "MLI"), ("ml", "Mali again", "MLX")]),
        (["ken", "xyz"], [("ken", "Kenya", "KEN"), ("xyz", None, "XYZ")]),
        (["Kenya", "ML"], [("Kenya", "Kenya", "KEN"), ("ML", "ML", None)]),
        (["kenya"], [("kenya", "kenya", None)]),
    ],
)
def test_country_codes(spark, given, want):
    sites = spark.createDataFrame([(g, g) for g in given], "site_name string, country_name string")
    codes = spark.createDataFrame(CODES, "country string, iso2 string, iso3 string")
    assert rows(registry.with_country_codes(sites, codes)) == want


def test_sites_are_distinct_and_take_a_constant_country(spark):
    data = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "s string, n int")
    source = SourceConfig("src", "", "s", country_name="Mozambique")
    assert rows(delivered_sites(data, source)) == [(None, "Mozambique"), ("a", "Mozambique")]


def test_unknown_and_null_sites_are_rejected(spark):
    delivered = spark.createDataFrame([(1, "a"), (2, None), (3, "zz"), (1, "b")], "id int, site string")
    sites = spark.createDataFrame([(10, "a"), (11, "b"), (12, None)], "site_id long, site_name string")
    assert rows(registry.match_sites(delivered, sites, "id", "site", 4)) == [(10, "1", 4), (11, "1", 4)]
    assert rows(registry.unmatched_sites(delivered, sites, "site"), "id") == [(2,), (3,)]


def test_links_go_to_every_site_and_are_made_once(spark):
    deaths = spark.createDataFrame([(1, "7"), (2, "7"), (3, "8"), (4, None)], "death_id long, external_id string")
    ids = spark.createDataFrame([(100, "7"), (101, "7.0"), (102, None), (103, "8")], "row_id long, value string")
    links = registry.link_rows(deaths, ids)
    assert rows(links) == [(1, 100), (2, 100), (3, 103)]
    assert registry.link_rows(deaths, ids, links).count() == 0


def test_latest_ingestion(spark):
    day = dt.date
    ingestions = spark.createDataFrame(
        [(1, 1, day(2023, 1, 1)), (2, 1, day(2023, 1, 1)), (3, 1, day(2024, 1, 1)), (4, 2, day(2024, 1, 1))],
        "data_ingestion_id long, source_id long, date_received date",
    )
    deaths = spark.createDataFrame([(1,), (1,), (2,)], "data_ingestion_id long")
    assert rows(registry.latest_death_ingestions(ingestions, deaths), "source_id", "data_ingestion_id") == [(1, 2)]
    assert registry.latest_death_ingestion(ingestions, deaths, 1) == 2
    with pytest.raises(LookupError):
        registry.latest_death_ingestion(ingestions, deaths, 2)
    assert registry.has_deaths(deaths, 1) and not registry.has_deaths(deaths, 3)


def test_instrument_links(spark):
    pairs = spark.createDataFrame(
        [("i", "d"), ("i", "unknown"), ("nobody", "d")], "instrument_name string, dataset_name string"
    )
    instruments = spark.createDataFrame([(1, "i")], "instrument_id long, name string")
    datasets = spark.createDataFrame([(6, "d"), (5, "d")], "dataset_id long, name string")
    linked = registry.link_instruments(pairs, instruments, datasets)
    assert rows(linked.where("instrument_id IS NOT NULL AND dataset_id IS NOT NULL"), "instrument_id", "dataset_id") == [(1, 5)]
    assert rows(registry.unknown_instrument_links(linked)) == [
        ("Data file unknown is not ingested.",), ("Instrument file nobody is not ingested.",)
    ]


def test_every_protocol_for_every_site_of_its_source(spark):
    sites = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "site_id long, source_id long")
    protocols = spark.createDataFrame([(8, 1), (9, 1)], "protocol_id long, source_id long")
    got = registry.site_protocols(sites, protocols)
    assert rows(got) == [(1, 8), (1, 9), (2, 8), (2, 9)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_lookups(spark):
    df = spark.createDataFrame([(2, 1, "a", 3), (1, 1, "a", 4), (5, 2, "a", 1), (6, 1, "A", 1)],
                               "variable_id long, domain_id long, name string, value_type_id int")
    assert lookup.named_key(df, "a", "variable_id") == 1
    assert lookup.named_key(df, "zz", "variable_id") is None
    assert lookup.variable_id(df, 2, "a") == 5
    assert rows(lookup.lookup_variables(df, ["a"], 1)) == [("a", 1, 4), ("a", 2, 3)]
    assert rows(lookup.variable(df, 6), "name") == [("A",)]
    names = spark.createDataFrame([("a",), (None,), ("q",)], "n string")
    assert rows(lookup.named_keys(names, "n", df, "variable_id"), "n", "variable_id") == [(None, None), ("a", 1), ("q", None)]
    assert rows(lookup.select_rows(df, ["variable_id"], {"domain_id": 1, "name": "a"})) == [(1,), (2,)]
    assert rows(lookup.select_rows(df, ["COUNT(*)"], {"name": None})) == [(0,)]
    assert lookup.select_rows(df).count() == 4
    assert lookup.value_type(df, 1) == 4
    with pytest.raises(LookupError):
        lookup.value_type(df, 77)
    with pytest.raises(ValueError):
        lookup.value_type(df.withColumn("value_type_id", F.lit(9)), 1)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "k int, v string")
    assert rows(checks.duplicate_keys(df, ["k", "v"])) == [(1, "a", 2)]
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(checks.orphans(df, "k", parent, "p")) == [(2, 2)]
    assert checks.null_counts(df, ["k", "v"]).first().asDict() == {"k": 0, "v": 2}


def test_problems_of_a_table(spark):
    names = S.TABLES["deaths"].schema
    deaths = spark.createDataFrame([(1, 5, "x", 1), (2, 5, "x", 1), (3, 6, None, 1)], names)

    def parents(name):
        key = S.TABLES[name].key
        return spark.createDataFrame([(5,), (1,)], f"{key} long")

    found = checks.problems("deaths", deaths, deaths, parents)
    with pytest.raises(checks.IntegrityError) as error:
        checks.require_none(found)
    assert str(error.value) == (
        'deaths: duplicate site_id, external_id (1 values in 2 rows: {"site_id":5,"external_id":"x"}); '
        'deaths: null in external_id; deaths: site_id is not in sites (1 values in 1 rows: {"site_id":6})'
    )
    good = deaths.where(F.col("death_id") == 1)
    checks.require_none(checks.problems("deaths", good, good, parents))


def test_seeds(spark):
    assert rows(S.seed_table(spark, "value_types"), "value_type_id", "value_type") == [
        (1, "Integer"), (2, "Float"), (3, "String"), (4, "Date"), (5, "Datetime"), (6, "Time"), (7, "Categorical")
    ]
    assert {n: len(r) for n, r in S.SEEDS.items()} == {
        "study_types": 4, "transformation_types": 2, "transformation_statuses": 2, "value_types": 7,
        "unit_of_analysis_types": 2,
    }
