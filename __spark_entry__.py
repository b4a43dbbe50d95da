"""

Roles of the tables: region and nation are sources and sites, customer is the registry of
individuals, orders, lineitem and events are delivered datasets, part is a data dictionary, and the
lines of documents are vocabularies. The tables hold no nulls, so some queries blank a value first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longhouse import schemas as S
from longhouse.config import CsvFormat, IngestConfig, SourceConfig, UserIngestConfig
from longhouse.functions import values as V
from longhouse.operators import checks, keys, lookup, numbering, registry, reshape, upsert
from longhouse.plans import dataset, dictionary, export, metadata
from longhouse.plans import registry as registry_plan
from longhouse.session import fresh_dir
from longhouse.sources import arrow_ipc, delimited, documents
from longhouse.sources.archive import Archive

AS_OF = date(2024, 2, 3)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql:
            _ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(column: str) -> F.Column:
    return F.concat(F.lit("  "), column, F.lit(" "))


def blank(column: str, value) -> F.Column:
    return F.nullif(F.col(column), F.lit(value)).alias(column)


# --- datasets as cells -------------------------------------------------------------------------

ORDERS_CELLS = {
    "o_orderkey": "CAST(o_orderkey AS VARCHAR)",
    "o_custkey": "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus": "nullif(o_orderstatus, 'P')",
    "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
    "o_orderdate": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g')",
    "o_orderpriority": "o_orderpriority",
}
EVENTS_CELLS = {
    "event_id": "CAST(event_id AS VARCHAR)",
    "ts": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')",
    "user_id": "CAST(user_id AS VARCHAR)",
    "event_type": "event_type",
    "value": "CAST(value AS VARCHAR)",
    "props": "props",
}


def delivered_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[reshape.Variable]]:
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn("o_orderstatus", blank("o_orderstatus", "P"))
    variables = reshape.variables_from_schema(orders)
    return orders.withColumn("row_id", F.col("o_orderkey")), variables


def delivered_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[reshape.Variable]]:
    events = table(spark, sf_dir, "events")
    variables = [
        reshape.Variable(v.variable_id, v.name, S.CATEGORY if v.name == "event_type" else v.value_type_id)
        for v in reshape.variables_from_schema(events)
    ]
    return events.withColumn("row_id", F.col("event_id")), variables


def dictionary_frame(spark: SparkSession, variables: list[reshape.Variable]) -> DataFrame:
    return spark.createDataFrame(
        [(v.variable_id, v.name, v.value_type_id) for v in variables],
        "variable_id long, name string, value_type_id int",
    )


def _union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)


@query(
    _union(
        [
            f"SELECT o_orderkey AS row_id, CAST({i} AS BIGINT) AS variable_id, {e} AS value FROM orders"
            for i, e in enumerate(ORDERS_CELLS.values(), 1)
        ]
    )
)
def dataset_unpivot(spark, sf_dir):
    orders, variables = delivered_orders(spark, sf_dir)
    return reshape.unpivot_text(orders, variables)


@query(
    _union(
        [
            f"SELECT event_id AS row_id, '{n}' AS variable, {e} AS value FROM events"
            for n, e in EVENTS_CELLS.items()
        ]
    )
)
def dataset_cells(spark, sf_dir):
    events, variables = delivered_events(spark, sf_dir)
    cells = reshape.unpivot_text(events, variables)
    return reshape.cell_names(cells, dictionary_frame(spark, variables))


LINEITEM_TEXT = """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
      CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
      CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
      CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax,
      nullif(l_returnflag, 'R') AS l_returnflag, l_linestatus,
      strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%g') AS l_shipdate
    FROM lineitem
"""


def delivered_lineitem(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[reshape.Variable]]:
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.withColumn("l_returnflag", blank("l_returnflag", "R"))
    return keys.assign_ids(lines, "row_id"), reshape.variables_from_schema(lines)


@query(LINEITEM_TEXT)
def dataset_wide(spark, sf_dir):
    lines, variables = delivered_lineitem(spark, sf_dir)
    cells = reshape.unpivot_text(lines, variables)
    return reshape.pivot_text(cells, variables).drop("row_id")


@query(
    """SELECT o_orderkey AS row_id, o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
      o_totalprice, o_orderdate, o_orderpriority FROM orders"""
)
def dataset_wide_typed(spark, sf_dir):
    orders, variables = delivered_orders(spark, sf_dir)
    return reshape.pivot_typed_text(reshape.unpivot_text(orders, variables), variables)


@query("SELECT event_id AS row_id, event_id, ts, user_id, event_type, value, props FROM events")
def typed_store_wide(spark, sf_dir):
    events, variables = delivered_events(spark, sf_dir)
    return reshape.pivot_typed(reshape.unpivot_typed(events, variables), variables)


def _typed_select(i: int, column: str, slot: str) -> str:
    slots = {
        "value_integer": "CAST(NULL AS BIGINT)",
        "value_float": "CAST(NULL AS DOUBLE)",
        "value_string": "CAST(NULL AS VARCHAR)",
        "value_datetime": "CAST(NULL AS TIMESTAMP)",
    }
    slots[slot] = column
    values = ", ".join(f"{e} AS {n}" for n, e in slots.items())
    return f"SELECT o_orderkey AS row_id, CAST({i} AS BIGINT) AS variable_id, {values} FROM orders"


@query(
    _union(
        [
            _typed_select(1, "o_orderkey", "value_integer"),
            _typed_select(2, "o_custkey", "value_integer"),
            _typed_select(3, "nullif(o_orderstatus, 'P')", "value_string"),
            _typed_select(4, "o_totalprice", "value_float"),
            _typed_select(5, "o_orderdate", "value_datetime"),
            _typed_select(6, "o_orderpriority", "value_string"),
        ]
    )
)
def dataset_typed_values(spark, sf_dir):
    orders, variables = delivered_orders(spark, sf_dir)
    return reshape.unpivot_typed(orders, variables)


@query("SELECT o_orderkey AS row_id, CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders")
def dataset_column(spark, sf_dir):
    orders, variables = delivered_orders(spark, sf_dir)
    price = next(v for v in variables if v.name == "o_totalprice")
    return reshape.dataset_column(reshape.unpivot_text(orders, variables), price)


@query("SELECT event_id AS row_id, ts FROM events")
def typed_dataset_column(spark, sf_dir):
    events, variables = delivered_events(spark, sf_dir)
    stamp = next(v for v in variables if v.name == "ts")
    return reshape.typed_dataset_column(reshape.unpivot_typed(events, variables), stamp)


@query(
    """SELECT row_number() OVER (ORDER BY ts, event_id) AS row_id, event_id, user_id FROM events"""
)
def dense_row_ids(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id", "user_id")
    return keys.assign_ids(events, "row_id", order_by=["ts", "event_id"]).drop("ts")


@query(
    """
    SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
      c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS brand FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, NULL, NULL FROM supplier
    UNION ALL SELECT p_partkey, p_name, NULL, p_retailprice, NULL, CAST(p_size AS VARCHAR), p_brand FROM part
    UNION ALL SELECT o_orderkey, NULL, NULL, o_totalprice, NULL, o_orderpriority, NULL FROM orders
    """
)
def row_bind(spark, sf_dir):
    def read(table_name, **columns):
        return table(spark, sf_dir, table_name).select(*[F.col(c).alias(a) for a, c in columns.items()])

    customers = read(
        "customer", key="c_custkey", name="c_name", nation="c_nationkey", balance="c_acctbal",
        segment="c_mktsegment",
    )
    suppliers = read("supplier", key="s_suppkey", name="s_name", nation="s_nationkey", balance="s_acctbal")
    parts = read("part", key="p_partkey", name="p_name", balance="p_retailprice", size="p_size", brand="p_brand")
    orders = read("orders", key="o_orderkey", balance="o_totalprice", size="o_orderpriority")
    return reshape.row_bind([customers, suppliers, parts, orders])


# --- registry and links ------------------------------------------------------------------------


def delivered_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nation = table(spark, sf_dir, "nation")
    customers = lookup.lookup_join(
        table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"),
        nation.select("n_nationkey", "n_name"),
        ["n_nationkey"],
    ).withColumn("site", blank("n_name", "NATION_3"))
    sites = nation.where(F.col("n_name") != "NATION_5").select(
        F.col("n_nationkey").cast("long").alias("site_id"), F.col("n_name").alias("site_name")
    )
    return customers, sites


@query(
    """
    SELECT row_number() OVER (ORDER BY c_custkey) AS death_id, CAST(n_nationkey AS BIGINT) AS site_id,
      CAST(c_custkey AS VARCHAR) AS external_id, CAST(1 AS BIGINT) AS data_ingestion_id
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name NOT IN ('NATION_3', 'NATION_5')
    """
)
def register_entities(spark, sf_dir):
    customers, sites = delivered_customers(spark, sf_dir)
    matched = registry.match_sites(customers, sites, "c_custkey", "site", 1)
    order = F.col("external_id").cast("long")
    return keys.assign_ids(matched, "death_id", order_by=[order], unique_order=True)


@query(
    """
    SELECT c_custkey, nullif(n_name, 'NATION_3') AS site FROM customer
    JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_3', 'NATION_5')
    """
)
def register_rejects(spark, sf_dir):
    customers, sites = delivered_customers(spark, sf_dir)
    return registry.unmatched_sites(customers, sites, "site").select("c_custkey", "site")


@query(
    """
    SELECT DISTINCT c_custkey AS death_id, o_orderkey AS row_id FROM customer
    JOIN orders ON CAST(c_custkey AS VARCHAR) = CAST(o_custkey AS VARCHAR)
    WHERE NOT (o_orderstatus = 'F')
    """
)
def link_rows(spark, sf_dir):
    deaths = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("death_id"), F.col("c_custkey").cast("string").alias("external_id")
    )
    orders, variables = delivered_orders(spark, sf_dir)
    ids = reshape.unpivot_text(orders.select("row_id", "o_custkey"), variables)
    linked_before = orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("death_id"), "row_id"
    )
    return registry.link_rows(deaths, ids, linked_before)


@query(
    """
    WITH ids AS (SELECT o_orderkey AS row_id,
      CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS id FROM orders)
    SELECT c_custkey AS death_id, row_id FROM ids JOIN customer ON id = c_custkey
    """
)
def link_rows_hot_id(spark, sf_dir):
    """One id holds a third of the rows; adaptive execution splits its partition."""
    deaths = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("death_id"), F.col("c_custkey").cast("string").alias("external_id")
    )
    hot = F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.col("o_custkey"))
    ids = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), hot.cast("string").alias("value")
    )
    return registry.link_rows(deaths, ids)


@query("SELECT c_custkey AS death_id, o_orderkey AS row_id FROM customer JOIN orders ON c_custkey = o_custkey")
def link_rows_double_id(spark, sf_dir):
    """Ids that both the registry and the dataset hold as large doubles."""
    far = 1e7
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + far).alias("id"), F.lit("here").alias("site"), "c_custkey"
    )
    site = spark.createDataFrame([(1, "here")], "site_id long, site_name string")
    registered = registry.match_sites(customers, site, "id", "site", 1)
    deaths = registered.select(
        (F.col("external_id").cast("double") - far).cast("long").alias("death_id"), "external_id"
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), (F.col("o_custkey") + far).alias("id")
    )
    return registry.link_rows(deaths, reshape.unpivot_text(orders, reshape.variables_from_schema(orders, ["row_id"])))


@query(
    """SELECT s.c_custkey AS site_id, s.c_name AS site_name, s.c_nationkey AS source_id FROM customer s
    JOIN nation ss ON s.c_nationkey = ss.n_nationkey WHERE ss.n_name = 'NATION_7'"""
)
def source_sites(spark, sf_dir):
    sources = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("name")
    )
    sites = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("site_id"),
        F.col("c_name").alias("site_name"),
        F.col("c_nationkey").alias("source_id"),
    )
    return lookup.source_sites(sources, sites, "NATION_7")


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").where("n_name <> 'NATION_4'")
    number = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return nation.select(
        F.col("n_name").alias("country"),
        F.translate(number, "0123456789", "ABCDEFGHIJ").alias("iso2"),
        F.concat(F.lit("X"), F.translate(number, "0123456789", "ABCDEFGHIJ")).alias("iso3"),
    )


SITE_COUNTRIES = """
    WITH codes AS (SELECT n_nationkey, n_name AS country,
        translate(lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), '0123456789', 'ABCDEFGHIJ') AS iso2 FROM nation)
    SELECT DISTINCT c_mktsegment AS site_name, {name} AS country_name, {iso3} AS country_iso3
    FROM customer JOIN codes ON c_nationkey = n_nationkey
"""
_KNOWN = "CASE WHEN country <> 'NATION_4' THEN {} END"


def _site_countries(spark, sf_dir, given):
    codes = country_codes(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    delivered = lookup.lookup_join(table(spark, sf_dir, "customer"), nation, ["c_nationkey"])
    source = SourceConfig("source", "", "c_mktsegment", country_col="given")
    sites = metadata.delivered_sites(delivered.withColumn("given", given), source)
    return registry.with_country_codes(sites, codes)


_ISO2 = "translate(lpad(cast(c_nationkey AS string), 2, '0'), '0123456789', 'abcdefghij')"


@query(SITE_COUNTRIES.format(name="country", iso3=_KNOWN.format("'X' || iso2")))
def site_countries_by_name(spark, sf_dir):
    return _site_countries(spark, sf_dir, F.col("n_name"))


@query(SITE_COUNTRIES.format(name=_KNOWN.format("country"), iso3=_KNOWN.format("'X' || iso2")))
def site_countries_by_iso2(spark, sf_dir):
    return _site_countries(spark, sf_dir, F.expr(_ISO2))


@query(SITE_COUNTRIES.format(name=_KNOWN.format("country"), iso3="'X' || iso2"))
def site_countries_by_iso3(spark, sf_dir):
    return _site_countries(spark, sf_dir, F.expr(f"concat('x', {_ISO2})"))


@query(
    """
    WITH protocols AS (SELECT c_nationkey, c_mktsegment,
        row_number() OVER (ORDER BY c_nationkey, c_mktsegment) AS protocol_id
      FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer))
    SELECT s_suppkey AS site_id, protocol_id FROM supplier JOIN protocols ON s_nationkey = c_nationkey
    """
)
def site_protocols(spark, sf_dir):
    listed = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("source_id"), F.col("c_mktsegment").alias("name")
    ).distinct()
    protocols = keys.assign_ids(listed, "protocol_id", order_by=["source_id", "name"], unique_order=True)
    sites = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("site_id"), F.col("s_nationkey").alias("source_id")
    )
    return registry.site_protocols(sites, protocols)


def order_ingestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("source_id")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lookup.lookup_join(orders, customers, ["o_custkey"]).select(
        F.col("o_orderkey").alias("data_ingestion_id"),
        "source_id",
        F.col("o_orderdate").cast("date").alias("date_received"),
    )


@query(
    """
    SELECT c_nationkey AS source_id, o_orderkey AS data_ingestion_id FROM (
      SELECT c_nationkey, o_orderkey, row_number() OVER (PARTITION BY c_nationkey
          ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) WHERE rn = 1
    """
)
def latest_entity_ingest(spark, sf_dir):
    deaths = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("data_ingestion_id"))
    return registry.latest_death_ingestions(order_ingestions(spark, sf_dir), deaths)


@query(
    """
    SELECT o_orderkey AS data_ingestion_id, count(l_orderkey) AS n, count(l_orderkey) > 0 AS present
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
    """
)
def entity_in_ingest(spark, sf_dir):
    deaths = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("data_ingestion_id"))
    ingestions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("data_ingestion_id"))
    counted = ingestions.join(registry.deaths_by_ingestion(deaths), "data_ingestion_id", "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return counted.select("data_ingestion_id", n.alias("n"), (n > 0).alias("present"))


def instrument_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("dataset_name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("instrument_name")
    )
    named = lookup.lookup_join(lines, parts, ["l_partkey"])
    named = lookup.lookup_join(named, suppliers, ["l_suppkey"])
    pairs = named.select("instrument_name", "dataset_name").distinct()
    instruments = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("instrument_id"), F.col("s_name").alias("name")
    )
    datasets = table(spark, sf_dir, "part").where("p_name <> 'hot rod'").select(
        F.col("p_partkey").alias("dataset_id"), F.col("p_name").alias("name")
    )
    return registry.link_instruments(pairs, instruments, datasets)


INSTRUMENT_LINKS = """
    WITH pairs AS (SELECT DISTINCT s_name AS instrument_name, p_name AS dataset_name FROM lineitem
        JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
      ds AS (SELECT p_name AS dataset_name, min(p_partkey) AS dataset_id FROM part
        WHERE p_name <> 'hot rod' GROUP BY 1),
      ins AS (SELECT s_name AS instrument_name, min(s_suppkey) AS instrument_id FROM supplier
        WHERE s_acctbal > 0 GROUP BY 1),
      linked AS (SELECT * FROM pairs LEFT JOIN ds USING (dataset_name) LEFT JOIN ins USING (instrument_name))
"""


@query(INSTRUMENT_LINKS + "SELECT instrument_name, dataset_name, dataset_id, instrument_id FROM linked")
def instrument_links(spark, sf_dir):
    return instrument_pairs(spark, sf_dir)


@query(
    INSTRUMENT_LINKS
    + """SELECT CASE WHEN dataset_id IS NULL THEN 'Data file ' || dataset_name || ' is not ingested.'
      ELSE 'Instrument file ' || instrument_name || ' is not ingested.' END AS problem
    FROM linked WHERE dataset_id IS NULL OR instrument_id IS NULL"""
)
def unknown_instrument_links(spark, sf_dir):
    return registry.unknown_instrument_links(instrument_pairs(spark, sf_dir))


# --- dictionaries ------------------------------------------------------------------------------


def part_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("variable_id"),
        F.col("p_brand").alias("domain_id"),
        F.col("p_name").alias("name"),
        (F.col("p_size") % 7 + 1).alias("value_type_id"),
        blank("p_size", 7).cast("long").alias("vocabulary_id"),
        blank("p_type", "PROMO").alias("description"),
        blank("p_type", "SMALL").alias("note"),
        F.lit(None).cast("string").alias("keyrole"),
    )


@query(
    """
    SELECT dataset_id, p_partkey AS variable_id, p_name AS variable, p_size % 7 + 1 AS value_type_id
    FROM (SELECT DISTINCT l_orderkey AS dataset_id, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey
    """
)
def dataset_variables(spark, sf_dir):
    members = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("dataset_id"), F.col("l_partkey").alias("variable_id")
    ).distinct()
    return lookup.dataset_variables(members, part_variables(spark, sf_dir))


@query(
    """
    SELECT p.p_name AS name, p.p_partkey AS variable_id, p.p_size % 7 + 1 AS value_type_id FROM part p
    JOIN (SELECT DISTINCT p_name FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_returnflag = 'R') n
      ON n.p_name = p.p_name WHERE p.p_brand = 'Brand#7'
    """
)
def lookup_variables(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_partkey")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name")
    )
    names = lookup.lookup_join(lines, parts, ["l_partkey"]).select("name").distinct()
    return lookup.lookup_variables(part_variables(spark, sf_dir), names, "Brand#7")


@query(
    """
    SELECT l_orderkey, l_linenumber, p_name, k.variable_id FROM lineitem JOIN part ON p_partkey = l_partkey
    LEFT JOIN (SELECT p_name, min(p_partkey) AS variable_id FROM part WHERE p_size > 25 GROUP BY 1) k USING (p_name)
    """
)
def named_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf_dir, "part")
    named = lookup.lookup_join(
        lines, parts.select(F.col("p_partkey").alias("l_partkey"), "p_name"), ["l_partkey"]
    )
    known = parts.where("p_size > 25").select(
        F.col("p_partkey").alias("variable_id"), F.col("p_name").alias("name")
    )
    return lookup.named_keys(named, "p_name", known, "variable_id").drop("l_partkey")


UPSERT = """
    WITH rows AS (SELECT p_brand AS domain_id, p_name AS name, p_size % 7 + 1 AS value_type_id,
        nullif(p_size, 7) AS vocabulary_id, nullif(p_type, 'PROMO') AS description,
        nullif(p_type, 'SMALL') AS note, p_partkey AS pos FROM part),
      old AS (SELECT domain_id, name, arg_min(value_type_id, pos) AS value_type_id,
        CAST(NULL AS INTEGER) AS vocabulary_id, min(note) AS note, min(pos) + 1 AS variable_id FROM rows
        WHERE value_type_id = 3 GROUP BY 1, 2),
      allrows AS (SELECT domain_id, name, value_type_id, vocabulary_id, CAST(NULL AS VARCHAR) AS description,
          note, variable_id, -1 AS pos FROM old
        UNION ALL SELECT domain_id, name, value_type_id, vocabulary_id, description, note, NULL, pos FROM rows),
      ranked AS (SELECT *, vocabulary_id IS NOT NULL AND description IS NOT NULL AND note IS NOT NULL AS full_row,
        first_value(value_type_id) OVER w AS first_type, first_value(pos) OVER w AS first_pos,
        first_value(variable_id) OVER w AS old_id
        FROM allrows WINDOW w AS (PARTITION BY domain_id, name ORDER BY pos)),
      chosen AS (SELECT *, row_number() OVER (PARTITION BY domain_id, name ORDER BY {order}) AS rn FROM ranked)
    SELECT CAST(CASE WHEN old_id IS NOT NULL THEN old_id ELSE
        (SELECT max(variable_id) FROM old) + row_number() OVER (PARTITION BY old_id IS NULL ORDER BY first_pos) END AS BIGINT) AS variable_id,
      domain_id, name, first_type AS value_type_id, CAST(vocabulary_id AS BIGINT) AS vocabulary_id, description, note,
      CAST(NULL AS VARCHAR) AS keyrole FROM chosen WHERE rn = 1
"""


def _upsert(spark, sf_dir, overwrite):
    rows = part_variables(spark, sf_dir)
    old = (
        rows.where("value_type_id = 3")
        .groupBy("domain_id", "name")
        .agg(
            F.min_by("value_type_id", "variable_id").alias("value_type_id"),
            F.min("note").alias("note"),
            (F.min("variable_id") + 1).alias("variable_id"),
        )
        .withColumn("vocabulary_id", F.lit(None).cast("long"))
        .withColumn("description", F.lit(None).cast("string"))
        .withColumn("keyrole", F.lit(None).cast("string"))
    )
    incoming = rows.withColumnRenamed("variable_id", "pos")
    return upsert.upsert_variables(old, incoming, overwrite)


@query(UPSERT.format(order="CASE WHEN full_row THEN 0 ELSE 1 END, CASE WHEN full_row THEN pos ELSE -pos END"))
def upsert_dictionary(spark, sf_dir):
    return _upsert(spark, sf_dir, overwrite=False)


@query(UPSERT.format(order="pos DESC"))
def upsert_dictionary_overwrite(spark, sf_dir):
    return _upsert(spark, sf_dir, overwrite=True)


@query(
    """
    WITH known AS (SELECT s_suppkey + 1 AS vocabulary_id, 'u' || s_suppkey AS name FROM supplier)
    SELECT (SELECT max(vocabulary_id) FROM known) + row_number() OVER (ORDER BY pos) AS vocabulary_id, name, description
    FROM (SELECT 'u' || user_id AS name, arg_min(event_type, event_id) AS description, min(event_id) AS pos
      FROM events GROUP BY 1) WHERE name NOT IN (SELECT name FROM known)
    """
)
def insert_if_absent(spark, sf_dir):
    known = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1).alias("vocabulary_id"),
        F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("name"),
    )
    incoming = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("description"),
        F.col("event_id").alias("pos"),
    )
    return upsert.insert_if_absent(known, incoming, "vocabulary_id")


@query(
    """
    WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
      items AS (SELECT doc_id, ls[1] AS vocabulary_description, unnest(range(1, len(ls))) AS value, ls FROM l)
    SELECT doc_id, vocabulary_description, value, string_split(ls[value + 1], ',')[1] AS code,
      string_split(ls[value + 1], ',')[2] AS description FROM items
    """
)
def vocabulary_from_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dictionary.vocabulary_from_lines(docs, "doc_id", "text")


@query("SELECT doc_id, string_split(text, chr(10))[1] AS text FROM documents")
def description_first_line(spark, sf_dir):
    return dictionary.first_line(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query(
    """
    SELECT p_type AS "Column_Name", row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS value,
      p_name AS code, p_brand AS description FROM part
    WHERE p_type IN (SELECT p_type FROM part WHERE p_type <> 'PROMO')
    """
)
def vocabulary_from_sheet(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    items = parts.select(
        F.col("p_type").alias("Column_Name"),
        F.col("p_name").alias("Items"),
        F.col("p_brand").alias("Description"),
        F.col("p_partkey").alias("pos"),
    )
    variables = parts.where("p_type <> 'PROMO'").select(F.col("p_type").alias("Column_Name"))
    return dictionary.vocabulary_from_sheet(items, variables)


@query(
    """SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS value
    FROM events"""
)
def number_large_groups(spark, sf_dir):
    """Groups of any size: numbered across partitions."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return numbering.number_within(events, ["event_type"], ["ts", "event_id"]).drop("ts")


@query(
    """
    SELECT event_type, string_agg(props, '|' ORDER BY event_id) AS description FROM events GROUP BY 1
    """
)
def ordered_concat(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "props")
    return numbering.ordered_concat(events, ["event_type"], ["event_id"], "props", "|", "description")


@query(
    """
    WITH cols AS (SELECT DISTINCT p_brand || '_Ch_' || replace(p_name, ' ', '_') || '_' || p_size AS name FROM part),
      parts AS (SELECT name, regexp_split_to_array(name, '(?i)_ch')[1] AS sample FROM cols),
      coded AS (SELECT name, sample, upper(string_split(name, sample || '_')[-1]) AS code FROM parts),
      words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part),
      voc AS (SELECT upper(word) AS local_code, 'the ' || word || ', any' AS preferred,
        row_number() OVER (ORDER BY word) AS pos FROM words),
      samples AS (SELECT DISTINCT p_brand AS sample, 'Sample of ' || p_brand AS d FROM part WHERE p_brand <> 'Brand#3'),
      found AS (SELECT name, string_agg(preferred || ', ', '' ORDER BY pos) AS names FROM coded
        JOIN voc ON contains(code, local_code) GROUP BY 1),
      texts AS (SELECT name, d || ': ' || coalesce(names, '') || CASE WHEN regexp_matches(code, '_[0-9]$')
          THEN ' result ' || right(code, 1) ELSE '' END AS t
        FROM coded LEFT JOIN samples USING (sample) LEFT JOIN found USING (name))
    SELECT name AS "Column_Name", CASE WHEN name = 'Brand#1_Ch_red_rod_1' THEN 'Yes' ELSE '' END AS "Key",
      replace(regexp_replace(t, ', $', ''), ',', '^') AS "Description", '' AS "Note", 3 AS "DataType" FROM texts
    """
)
def lab_dictionary(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.concat_ws(
        "_", "p_brand", F.lit("Ch"), F.translate("p_name", " ", "_"), F.col("p_size").cast("string")
    )
    words = part.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    vocabulary = keys.assign_ids(words, "pos", order_by=["word"], unique_order=True).select(
        "pos",
        F.upper("word").alias("champs_local_code"),
        F.concat(F.lit("the "), "word", F.lit(", any")).alias("c_pref_name"),
    )
    samples = part.where("p_brand <> 'Brand#3'").select(
        F.col("p_brand").alias("Sample_code"), F.concat(F.lit("Sample of "), "p_brand").alias("Desc")
    ).distinct()
    columns = part.select(name.alias("Column_Name")).distinct()
    return dictionary.lab_dictionary(columns, samples, vocabulary, "Brand#1_Ch_red_rod_1")


@query(
    """
    WITH rows AS (SELECT p_brand AS pathogen, p_type AS interpretation, p_partkey AS pos,
        replace('p_size:' || p_size || ';p_retailprice:' || p_retailprice || ';p_name:' ||
          coalesce(nullif(p_name, 'hot rod'), 'missing'), ' ', '') AS v FROM part),
      keys AS (SELECT pathogen, interpretation, row_number() OVER (PARTITION BY pathogen ORDER BY min(pos)) AS key
        FROM rows GROUP BY 1, 2)
    SELECT pathogen, key, interpretation, string_agg(v, '|' ORDER BY pos) AS description
    FROM rows JOIN keys USING (pathogen, interpretation) GROUP BY 1, 2, 3
    """
)
def panel_vocabulary(spark, sf_dir):
    panels = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("pathogen"),
        F.concat(F.lit("\t "), "p_type", F.lit(" \n")).alias("Interpretation"),
        "p_size",
        "p_retailprice",
        blank("p_name", "hot rod"),
        F.col("p_partkey").alias("pos"),
    )
    return dictionary.panel_vocabulary(panels, ["p_size", "p_retailprice", "p_name"])


@query("SELECT 0 AS vocabulary_id, p_name AS name, p_type AS description FROM part")
def panel_index(spark, sf_dir):
    listed = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("Pathogen"), F.col("p_type").alias("Multi-target result code")
    )
    return dictionary.panel_index(listed)


@query(
    """
    SELECT o_orderkey AS row_id, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
      CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
      nullif(o_orderstatus, 'P') AS o_orderstatus,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, o_orderpriority FROM orders
    """
)
def dataset_wide_sparse(spark, sf_dir):
    """Rows that lack some cells altogether."""
    orders, variables = delivered_orders(spark, sf_dir)
    place = {v.name: v.variable_id for v in variables}
    cells = reshape.unpivot_text(orders, variables).join(
        orders.select("row_id", F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p")), "row_id"
    )
    no_customer = (F.col("variable_id") == place["o_custkey"]) & F.col("s").eqNullSafe("F")
    no_price = (F.col("variable_id") == place["o_totalprice"]) & (F.col("p") == "1-URGENT")
    return reshape.pivot_text(cells.where(~no_customer & ~no_price).drop("s", "p"), variables)


@query("SELECT DISTINCT p_name AS name, nullif(p_type, 'PROMO') AS description FROM part WHERE p_size <= 3")
def variable_report(spark, sf_dir):
    variables = table(spark, sf_dir, "part").select(
        F.col("p_size").alias("domain_id"),
        F.col("p_name").alias("name"),
        blank("p_type", "PROMO").alias("description"),
    )
    return dictionary.variable_report(variables)


@query(
    """
    SELECT p_partkey AS variable_id, p_name AS name, CAST(CASE WHEN p_name ILIKE '%R_d%' AND p_brand = 'Brand#7'
      THEN 99 ELSE nullif(p_size, 7) END AS BIGINT) AS vocabulary_id FROM part
    """
)
def like_assign(spark, sf_dir):
    assigned = upsert.assign_vocabulary(part_variables(spark, sf_dir), "R_d", "Brand#7", 99)
    return assigned.select("variable_id", "name", "vocabulary_id")


@query(
    """
    SELECT p_partkey AS variable_id, CASE WHEN p_brand = 'Brand#7' AND p_name = 'hot ring' THEN 'site_name'
      WHEN p_brand = 'Brand#7' AND p_name = 'red rod' THEN 'id' END AS keyrole FROM part
    """
)
def key_roles(spark, sf_dir):
    marked = upsert.set_key_roles(part_variables(spark, sf_dir), "Brand#7", "red rod", "hot ring")
    return marked.select("variable_id", "keyrole")


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN 'NONE' ELSE c_mktsegment END AS c_mktsegment
    FROM customer"""
)
def update_value(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return upsert.set_value(customers, "c_nationkey", 7, "c_mktsegment", "NONE").select(
        "c_custkey", "c_mktsegment"
    )


@query(
    """
    WITH named AS (SELECT p_name, max(l_orderkey) AS ethics_id FROM lineitem JOIN part ON p_partkey = l_partkey
      WHERE l_returnflag = 'R' AND p_size > 45 GROUP BY 1)
    SELECT p_partkey AS protocol_id, p_name AS name, coalesce(n.ethics_id, nullif(p_size, 7)) AS ethics_id
    FROM part LEFT JOIN named n USING (p_name)
    """
)
def ethics_assign(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    protocols = part.select(
        F.col("p_partkey").alias("protocol_id"),
        F.col("p_name").alias("name"),
        blank("p_size", 7).cast("long").alias("ethics_id"),
    )
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("ethics_id"), F.col("l_partkey").alias("p_partkey")
    )
    approved = part.where("p_size > 45").select("p_partkey", F.col("p_name").alias("ethics_reference"))
    ethics = lookup.lookup_join(lines, approved, ["p_partkey"])
    return upsert.assign_ethics(protocols, ethics)


EVENT_PHRASES = {
    "click": "How many clicks",
    "view": "Please Record the Date of the view",
    "error": "Enter length of the outage and how old it is",
    "purchase": "The weight bought",
}
_PHRASE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_PHRASES.items()) + " ELSE 'Other' END"
HARMONISE_COLUMNS = f"""
    SELECT 'u' || user_id || CASE WHEN event_type = 'view' AND user_id > 20 THEN '_unit' ELSE '_' || event_type END AS name,
      {_PHRASE_SQL} || ', ' || props AS description, event_type, user_id FROM events
"""


def event_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(
            F.lit("u"),
            F.col("user_id").cast("string"),
            F.expr("CASE WHEN event_type = 'view' AND user_id > 20 THEN '_unit' ELSE '_' || event_type END"),
        ).alias("name"),
        F.concat(F.expr(_PHRASE_SQL), F.lit(", "), "props").alias("description"),
        "event_type",
        "user_id",
    )


@query(
    f"""
    WITH d AS ({HARMONISE_COLUMNS}),
      r AS (SELECT name, bool_or(regexp_matches(description, '(?i)record the date')) AS a,
        bool_or(regexp_matches(description, '(?i)the weight|how old|how many|how long')) AS b,
        bool_or(regexp_matches(name, '(?i)_unit')) AS c,
        bool_or(regexp_matches(description, '(?i)enter length of')) AS e FROM d GROUP BY 1)
    SELECT name AS "Column_Name", description AS "Description",
      CASE WHEN e THEN 2 WHEN c THEN 7 WHEN b THEN 2 WHEN a THEN 4 ELSE 3 END AS "DataType"
    FROM d JOIN r USING (name)
    """
)
def harmonise_types(spark, sf_dir):
    rows = event_dictionary(spark, sf_dir).select(
        F.col("name").alias("Column_Name"), F.col("description").alias("Description"), F.lit(3).alias("DataType")
    )
    return dictionary.harmonise_types(rows)


@query(
    f"""
    WITH d AS (SELECT name, description, CASE WHEN user_id > 30 THEN 'integer' ELSE 'text' END AS type
        FROM ({HARMONISE_COLUMNS})),
      r AS (SELECT name, bool_or(regexp_matches(description, '(?i)record the date')) AS a,
        bool_or(regexp_matches(description,
          '(?i)calculated number|what was the weight|how old|how many|how long')) AS b,
        bool_or(regexp_matches(description, '(?i)_unit') OR regexp_matches(name, '(?i)_unit')) AS c FROM d GROUP BY 1),
      typed AS (SELECT DISTINCT name, description, CASE WHEN c THEN 'text' WHEN b THEN 'double precision'
        WHEN a THEN 'date' ELSE type END AS type FROM d JOIN r USING (name)),
      n AS (SELECT name, count(*) AS n FROM typed GROUP BY 1),
      settled AS (SELECT DISTINCT name, description, CASE WHEN n > 1 THEN 'text' ELSE type END AS type
        FROM typed JOIN n USING (name))
    SELECT name AS "Column_Name", CASE WHEN name = 'u7_click' THEN 'Yes' ELSE '' END AS "Key",
      replace(description, ',', '^') AS "Description", '' AS "Note",
      CASE type WHEN 'integer' THEN 1 WHEN 'double precision' THEN 2 WHEN 'text' THEN 3 WHEN 'date' THEN 4 END AS "DataType"
    FROM settled
    """
)
def harmonise_named_types(spark, sf_dir):
    rows = event_dictionary(spark, sf_dir).select(
        F.col("name").alias("column_name"),
        "description",
        F.when(F.col("user_id") > 30, F.lit("integer")).otherwise(F.lit("text")).alias("type"),
    )
    return dictionary.harmonise_named_types(rows, "u7_click")


# --- scans, checks, files ----------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"""
)
def param_scan(spark, sf_dir):
    wanted = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    return lookup.select_rows(table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"], wanted)


@query("SELECT count(*) AS n, max(o_totalprice) AS highest FROM orders WHERE o_orderstatus = 'F'")
def param_count(spark, sf_dir):
    columns = ["count(*) AS n", "max(o_totalprice) AS highest"]
    return lookup.select_rows(table(spark, sf_dir, "orders"), columns, {"o_orderstatus": "F"})


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = NULL")
def param_scan_null(spark, sf_dir):
    return lookup.select_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], {"o_orderstatus": None})


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def integrity_unique(spark, sf_dir):
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT o_custkey, count(*) AS n FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1"""
)
def integrity_reference(spark, sf_dir):
    parent = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return checks.orphans(table(spark, sf_dir, "orders"), "o_custkey", parent, "c_custkey")


@query(
    """SELECT count(*) FILTER (o_orderstatus = 'P') AS o_orderstatus, count(*) FILTER (o_orderkey IS NULL) AS o_orderkey
    FROM orders"""
)
def integrity_null(spark, sf_dir):
    orders, _ = delivered_orders(spark, sf_dir)
    return checks.null_counts(orders, ["o_orderstatus", "o_orderkey"])


@query(
    """
    SELECT 'data: variable ' || v || ' of dataset 1 lacks cells or has some twice' AS problem FROM (VALUES (1), (2), (3)) AS t(v)
    UNION ALL SELECT 'data: variable 9 is not one of dataset 1'
    """
)
def integrity_broken_cells(spark, sf_dir):
    """Cells of orders of which some are there twice and as many missing, one variable has none, one is not known."""
    orders, variables = delivered_orders(spark, sf_dir)
    orders = orders.withColumn("row_id", F.col("row_id") + 1)
    ids = orders.select("row_id").withColumn("dataset_id", F.lit(1).cast("long"))
    # of every five rows in a row: the first, thrice the third, the fifth; the first, twice the second, twice the fifth
    place = F.pmod(F.col("row_id") - 1, F.lit(5))
    moved = {1: [0, 1, 0, -1, 0], 2: [0, 0, -1, 1, 0]}
    cells = reshape.unpivot_text(orders, variables).withColumn("dataset_id", F.lit(1).cast("long"))
    whole = F.floor(orders.agg(F.count("row_id")).scalar() / 5) * 5
    for variable, steps in moved.items():
        step = F.element_at(F.array(*[F.lit(s) for s in steps]), (place + 1).cast("int"))
        mine = (F.col("variable_id") == variable) & (F.col("row_id") <= whole)
        cells = cells.withColumn("row_id", F.col("row_id") + F.when(mine, step).otherwise(0))
    cells = cells.where("variable_id <> 3").withColumn("variable_id", F.when(F.col("variable_id") == 4, 9).otherwise(F.col("variable_id")).cast("long"))
    known = spark.createDataFrame([(1, v.variable_id) for v in variables if v.variable_id != 4], "dataset_id long, variable_id long")
    return checks.cell_problems("data", cells, ids, known)


@query(
    """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,
    o_orderpriority FROM orders"""
)
def csv_roundtrip(spark, sf_dir):
    orders, _ = delivered_orders(spark, sf_dir)
    path = delimited.write_csv(orders.drop("row_id"), fresh_dir(spark, "csv"), compress=True)
    return delimited.read_csv(spark, path)


@query("SELECT doc_id, '  ' || text || ' ' AS text, lang, source, n_chars FROM documents")
def delimited_reexport(spark, sf_dir):
    """Texts with line breaks, quotes, both delimiters and blanks at both ends, through two files."""
    docs = table(spark, sf_dir, "documents").withColumn("text", padded("text"))
    first = delimited.write_csv(docs, fresh_dir(spark, "csv"))
    second = delimited.reexport(spark, first, fresh_dir(spark, "txt"))
    types = {"doc_id": S.INTEGER, "n_chars": S.INTEGER}
    return delimited.read_csv(spark, second, CsvFormat(delim=";"), types=types)


@query("SELECT doc_id, '  ' || text || ' ' AS text, lang, source, n_chars FROM documents")
def csv_quoted_breaks(spark, sf_dir):
    """Texts with line breaks in quoted cells, read by as many tasks as the files have splits."""
    docs = table(spark, sf_dir, "documents").withColumn("text", padded("text"))
    path = delimited.write_csv(docs, fresh_dir(spark, "csv"))
    return delimited.read_csv(spark, path, types={"doc_id": S.INTEGER, "n_chars": S.INTEGER}, whole_up_to=0)


@query("SELECT * FROM lineitem")
def arrow_roundtrip(spark, sf_dir):
    path = arrow_ipc.write_arrow(table(spark, sf_dir, "lineitem"), fresh_dir(spark, "arrow"))
    return arrow_ipc.read_arrow(spark, path)


@query("SELECT doc_id, base64(encode(text)) AS document FROM documents")
def document_base64(spark, sf_dir):
    content = F.encode("text", "UTF-8")
    return table(spark, sf_dir, "documents").select(
        "doc_id", documents.base64_text(content).alias("document")
    )


# --- whole pipelines ---------------------------------------------------------------------------


_ARCHIVES: dict[tuple[str, str], Archive] = {}


def customer_archive(spark: SparkSession, sf_dir: str) -> Archive:
    """Customers as registry and orders as dataset; ingested once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ARCHIVES:
        _ARCHIVES[key] = ingest_customers(spark, sf_dir)
    return _ARCHIVES[key]


def ingest_customers(spark: SparkSession, sf_dir: str) -> Archive:
    """Deliveries written as files, then taken through every ingest."""
    root = fresh_dir(spark, "archive")
    folder = f"{root}/in/SRC/De_identified_data"
    customers, _ = delivered_customers(spark, sf_dir)
    customers.drop("site", "n_nationkey").write.option("header", True).csv(f"{folder}/registry.csv")
    orders, variables = delivered_orders(spark, sf_dir)
    orders.drop("row_id").write.option("header", True).csv(f"{folder}/orders.csv")
    nation = table(spark, sf_dir, "nation")
    nation.select(
        F.col("n_name").alias("country"), F.lit(None).cast("string").alias("iso2"), F.col("n_name").alias("iso3")
    ).write.option("header", True).csv(f"{root}/in/iso.csv")
    entries = [(v.name, v.name, "note", v.value_type_id) for v in variables]
    entries.append(("n_name", "site", "note", S.STRING))
    spark.createDataFrame(
        entries, "Column_Name string, Description string, Note string, DataType int"
    ).coalesce(1).write.option("header", True).option("sep", ";").csv(f"{root}/in/dict/SRC/orders.csv")
    source = SourceConfig("SRC", "registry.csv", "n_name", country_col="n_name")
    ingest = IngestConfig(
        source, "c_custkey", "SRC", "registry.csv", {"Orders": "orders.csv"}, ["orders.csv"]
    )
    archive = Archive.create(spark, f"{root}/archive")
    metadata.ingest_source(archive, source, f"{root}/in", f"{root}/in/iso.csv")
    registry_plan.ingest_deaths(archive, ingest, f"{root}/in")
    by_order = replace(ingest, id_col="o_custkey")
    dictionary.ingest_dictionary(archive, by_order, f"{root}/in/dict")
    dataset.ingest_data(archive, by_order, f"{root}/in")
    return archive


@query(
    """
    SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,
      o_orderpriority, CAST(c_custkey AS VARCHAR) AS external_id, n_name AS site_name FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    """
)
def archive_linked_export(spark, sf_dir):
    """Source, registry, dictionary and data ingested from files; then exported with their links."""
    archive = customer_archive(spark, sf_dir)
    wide = export.dataset_to_typed(archive, 1)
    deaths = lookup.lookup_join(
        archive.table("deaths"), archive.table("sites"), ["site_id"]
    )
    known = deaths.select("death_id", "external_id", "site_name")
    links = lookup.lookup_join(archive.table("death_rows"), known, ["death_id"])
    return wide.join(links.select("row_id", "external_id", "site_name"), "row_id").drop("row_id")


@query(
    """
    SELECT 'orders.csv' AS name, 1 AS transformation_type_id, 2 AS transformation_status_id,
      1 AS unit_of_analysis_id, CAST(6 AS BIGINT) AS variables, count(*) AS n_rows, 6 * count(*) AS n_cells,
      (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS n_links FROM orders
    """
)
def archive_lineage(spark, sf_dir):
    """What each stored dataset came from and how much it holds."""
    archive = customer_archive(spark, sf_dir)

    def per_dataset(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("dataset_id").agg(F.count(F.lit(1)).alias(name))

    linked = archive.table("death_rows").join(archive.table("datarows"), ["row_id", "dataset_id"])
    return (
        archive.table("ingest_datasets")
        .join(archive.table("transformation_outputs"), ["transformation_id", "dataset_id"])
        .join(archive.table("transformations").drop("description"), "transformation_id")
        .join(archive.table("datasets"), "dataset_id")
        .join(per_dataset(archive.table("dataset_variables"), "variables"), "dataset_id")
        .join(per_dataset(archive.table("datarows"), "n_rows"), "dataset_id")
        .join(per_dataset(archive.table("data"), "n_cells"), "dataset_id")
        .join(per_dataset(linked, "n_links"), "dataset_id")
        .select(
            "name", "transformation_type_id", "transformation_status_id", "unit_of_analysis_id",
            "variables", "n_rows", "n_cells", "n_links",
        )
    )


_STUDIES: dict[tuple[str, str], Archive] = {}


def study_archive(spark: SparkSession, sf_dir: str) -> Archive:
    """Documents as text dataset and orders as typed dataset of a described source; made once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STUDIES:
        _STUDIES[key] = ingest_study(spark, sf_dir)
    return _STUDIES[key]


def put_file(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(text.encode()))
    stream.close()


def ingest_study(spark: SparkSession, sf_dir: str) -> Archive:
    """A source with protocols, instruments and ethics; dictionaries as file and as sheet pair."""
    root = fresh_dir(spark, "study")
    folder = f"{root}/in/STUDY"
    customers, _ = delivered_customers(spark, sf_dir)
    delimited.write_csv(customers.select("c_custkey", "n_name"), f"{folder}/De_identified_data/registry.csv")
    docs = table(spark, sf_dir, "documents").withColumn("text", padded("text"))
    delimited.write_csv(docs, f"{folder}/De_identified_data/documents.csv")
    orders, variables = delivered_orders(spark, sf_dir)
    orders = orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    delimited.write_csv(orders.drop("row_id"), f"{folder}/De_identified_data/orders.csv")
    nations = table(spark, sf_dir, "nation")
    names = [r[0] for r in nations.select("n_name").orderBy("n_name").collect()]
    regions = [tuple(r) for r in nations.groupBy("n_regionkey").agg(F.min("n_name")).orderBy("n_regionkey").collect()]
    codes = nations.select(F.col("n_name").alias("country"), F.lit(None).cast("string").alias("iso2"), F.col("n_name").alias("iso3"))
    delimited.write_csv(codes, f"{root}/in/iso.csv")
    protocols = {f"{n}.txt": f"Protocol of {n}" for n in names}
    ethics = {f"region {k}.txt": (f"Approval {k}", "Board", f"{n}.txt") for k, n in regions}
    instruments = {f"form {k}.txt": "documents.csv" for k, _ in regions}
    for kind, files in (("Protocols", protocols), ("Ethics", ethics), ("Instruments", instruments)):
        for name in files:
            put_file(spark, f"{folder}/{kind}/{name}", f"{kind} {name}")
    entry_columns = "Column_Name string, Description string, Note string, DataType int"
    documents_ = [("doc_id", "Id", "", S.INTEGER), ("text", "Text", "", S.STRING), ("lang", "Language", "", S.STRING),
                  ("source", "Source", "", S.STRING), ("n_chars", "Size", "", S.INTEGER), ("n_name", "Site", "", S.STRING)]
    delimited.write_csv(spark.createDataFrame(documents_, entry_columns).coalesce(1), f"{root}/in/dict/STUDY/documents.csv", CsvFormat(delim=";"))
    kinds = {"o_orderstatus": S.CATEGORY, "o_orderdate": S.DATE}
    sheet = [(v.name, v.name, "note", kinds.get(v.name, v.value_type_id)) for v in variables]
    delimited.write_csv(spark.createDataFrame(sheet, entry_columns).coalesce(1), f"{root}/in/dict/STUDY/orders/variables.csv")
    items = spark.createDataFrame([("o_orderstatus", c, f"status {c}") for c in "FOP"], "Column_Name string, Items string, Description string")
    delimited.write_csv(items.coalesce(1), f"{root}/in/dict/STUDY/orders/vocabularies.csv")
    source = SourceConfig(
        "STUDY", "registry.csv", "n_name", country_col="n_name", protocols=protocols, ethics=ethics, instruments=instruments
    )
    ingest = IngestConfig(
        source, "doc_id", "STUDY", "registry.csv", {"Documents": "documents.csv"}, ["documents.csv", "orders.xlsx"], as_of=AS_OF
    )
    archive = Archive.create(spark, f"{root}/archive")
    metadata.ingest_source(archive, source, f"{root}/in", f"{root}/in/iso.csv")
    registry_plan.ingest_deaths(archive, replace(ingest, id_col="c_custkey"), f"{root}/in")
    dictionary.ingest_dictionary(archive, ingest, f"{root}/in/dict")
    dataset.ingest_data(archive, ingest, f"{root}/in", declared_types=True)
    typed = replace(ingest, datasets={"Orders": "orders.csv"}, source=replace(source, instruments={}))
    dataset.ingest_data(archive, typed, f"{root}/in", typed=True, declared_types=True)
    dataset.link_dataset(archive, 2, 1, "o_custkey", 1)
    counts = export.dataset_to_typed(archive, 2, typed=True).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_chars"))
    derived = UserIngestConfig("doc_id", "STUDY", {"counts": counts}, {"counts": [2]}, as_of=AS_OF)
    dataset.ingest_derived(archive, derived)
    return archive


@query("SELECT doc_id, '  ' || text || ' ' AS text, lang, source, n_chars FROM documents")
def documents_archive(spark, sf_dir):
    """Texts with line breaks and blanks: delivered, stored as cells, exported, read back."""
    path = export.dataset_to_csv(study_archive(spark, sf_dir), 1, fresh_dir(spark, "export"))
    back = delimited.read_csv(spark, path, types={"doc_id": S.INTEGER, "n_chars": S.INTEGER})
    return back.select("doc_id", "text", "lang", "source", "n_chars")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, '  ' || text || ' ' AS text, lang, source,
    CAST(n_chars AS VARCHAR) AS n_chars FROM documents"""
)
def archive_arrow_export(spark, sf_dir):
    """A stored dataset exported twice: the second export replaces the first."""
    archive, path = study_archive(spark, sf_dir), fresh_dir(spark, "export")
    export.dataset_to_arrow(archive, 1, path)
    back = arrow_ipc.read_arrow(spark, export.dataset_to_arrow(archive, 1, path))
    return back.select("doc_id", "text", "lang", "source", "n_chars")


def stored_column(archive: Archive, dataset_id: int, name: str, typed: bool = False) -> DataFrame:
    """One variable of a stored dataset; the others are pruned from the scan."""
    wanted = next(v for v in export.variables_of_dataset(archive, dataset_id) if v.name == name)
    read = reshape.typed_dataset_column if typed else reshape.dataset_column
    return read(export.dataset_cells(archive, dataset_id, typed), wanted)


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang FROM documents")
def archive_column(spark, sf_dir):
    archive = study_archive(spark, sf_dir)
    return stored_column(archive, 1, "doc_id").join(stored_column(archive, 1, "lang"), "row_id").drop("row_id")


@query(
    """SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS external_id, n_name AS site_name FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
)
def archive_typed_links(spark, sf_dir):
    """A typed dataset that was linked after it had been stored."""
    archive = study_archive(spark, sf_dir)
    links = archive.table("death_rows").where("dataset_id = 2").select("death_id", "row_id")
    known = archive.table("deaths").join(archive.table("sites"), "site_id").select("death_id", "external_id", "site_name")
    return (
        links.join(known, "death_id")
        .join(stored_column(archive, 2, "o_orderkey", typed=True), "row_id")
        .select("o_orderkey", "external_id", "site_name")
    )


@query(
    """
    SELECT variable, n, CAST(0 AS BIGINT) AS twice FROM (SELECT count(*) AS n FROM documents),
      (VALUES ('doc_id'), ('text'), ('lang'), ('source'), ('n_chars')) AS v(variable)
    """
)
def integrity_cells(spark, sf_dir):
    """How many cells each stored variable has, and how many of them are there twice."""
    archive = study_archive(spark, sf_dir)
    cells = export.dataset_cells(archive, 1)
    names = archive.table("variables").select("variable_id", F.col("name").alias("variable"))
    twice = checks.duplicate_keys(cells, ["row_id", "variable_id"]).groupBy("variable_id").agg(F.sum("n").alias("twice"))
    counts = cells.groupBy("variable_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(names, "variable_id").join(twice, "variable_id", "left").select(
        "variable", "n", F.coalesce("twice", F.lit(0)).cast("long").alias("twice")
    )


@query(
    """
    WITH regions AS (SELECT n_regionkey AS k FROM nation GROUP BY 1), files AS (
      SELECT 'Protocols' AS kind, n_name || '.txt' AS name FROM nation
      UNION ALL SELECT 'Ethics', 'region ' || k || '.txt' FROM regions
      UNION ALL SELECT 'Instruments', 'form ' || k || '.txt' FROM regions)
    SELECT kind, name, base64(encode(kind || ' ' || name)) AS document FROM files
    """
)
def archive_documents(spark, sf_dir):
    """Documents read from the files that the configuration names."""
    archive = study_archive(spark, sf_dir)
    parts = [("Protocols", "protocol_documents"), ("Ethics", "ethics_documents"), ("Instruments", "instrument_documents")]
    found = [archive.table(t).select(F.lit(kind).alias("kind"), "name", "document") for kind, t in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    """
    WITH approvals AS (SELECT n_regionkey AS k, min(n_name) AS n FROM nation GROUP BY 1)
    SELECT n_name || '.txt' AS protocol, 'Protocol of ' || n_name AS description,
      CASE WHEN k IS NOT NULL THEN 'region ' || k || '.txt' END AS ethics,
      (SELECT count(DISTINCT n_name) FROM customer JOIN nation ON c_nationkey = n_nationkey) AS sites,
      (SELECT count(*) FROM approvals) AS instruments, DATE '2024-02-03' AS received
    FROM nation LEFT JOIN approvals ON n = n_name
    """
)
def archive_metadata(spark, sf_dir):
    """Protocols with their approval, sites and the instruments of the dataset."""
    archive = study_archive(spark, sf_dir)
    ethics = archive.table("ethics").select("ethics_id", F.col("name").alias("ethics"))
    sites = archive.table("site_protocols").groupBy("protocol_id").agg(F.count(F.lit(1)).alias("sites"))
    linked = archive.table("instrument_datasets").where("dataset_id = 1").agg(F.count(F.lit(1)))
    received = archive.table("data_ingestions").agg(F.max("date_received"))
    return (
        archive.table("protocols").join(ethics, "ethics_id", "left").join(sites, "protocol_id")
        .select(F.col("name").alias("protocol"), "description", "ethics", "sites",
                linked.scalar().alias("instruments"), received.scalar().alias("received"))
    )


@query("SELECT o_custkey, count(*) AS n_chars, CAST(2 AS BIGINT) AS made_from FROM orders GROUP BY 1")
def archive_derived(spark, sf_dir):
    """A dataset made from a stored one, with its input."""
    archive = study_archive(spark, sf_dir)
    made = archive.table("transformation_outputs").where("dataset_id = 3").select("transformation_id")
    inputs = archive.table("transformation_inputs").join(made, "transformation_id").agg(F.max("dataset_id"))
    return export.dataset_to_typed(archive, 3).drop("row_id").withColumn("made_from", inputs.scalar())


@query(
    """
    SELECT value_type, CAST(k AS BIGINT) AS variables, CAST(n * k AS BIGINT) AS cells FROM (SELECT count(*) AS n FROM orders),
      (VALUES ('Integer', 2), ('Float', 1), ('Date', 1), ('Categorical', 1), ('String', 1), ('Datetime', 0), ('Time', 0)) AS t(value_type, k)
    """
)
def archive_seeded_types(spark, sf_dir):
    """How many variables and cells of the stored orders have each of the value types that an archive begins with."""
    archive = study_archive(spark, sf_dir)
    members = archive.table("dataset_variables").where("dataset_id = 2").join(archive.table("variables"), "variable_id")
    cells = export.dataset_cells(archive, 2, typed=True).groupBy("variable_id").agg(F.count(F.lit(1)).alias("n"))
    counted = members.join(cells, "variable_id").groupBy("value_type_id").agg(
        F.count(F.lit(1)).alias("variables"), F.sum("n").alias("cells")
    )
    types = archive.table("value_types").join(counted, "value_type_id", "left")
    return types.select("value_type", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("variables", "cells")])


@query(
    """
    SELECT name, n, DATE '2024-02-03' AS made, DATE '2024-02-03' AS received, DATE '2024-02-03' AS transformed FROM (
      SELECT 'documents.csv' AS name, count(*) AS n FROM documents UNION ALL SELECT 'orders.csv', count(*) FROM orders)
    """
)
def archive_dates(spark, sf_dir):
    """The dates that datasets, ingestions and transformations were stamped with."""
    archive = study_archive(spark, sf_dir)
    counts = archive.table("datarows").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    stamped = archive.table("ingest_datasets").where("dataset_id < 3")
    stamped = stamped.join(archive.table("data_ingestions").drop("description"), "data_ingestion_id")
    stamped = stamped.join(archive.table("transformations").withColumnRenamed("date_created", "transformed").drop("description"), "transformation_id")
    return stamped.join(archive.table("datasets"), "dataset_id").join(counts, "dataset_id").select(
        "name", "n", F.col("date_created").alias("made"), F.col("date_received").alias("received"), "transformed"
    )


@query(
    """
    SELECT 'dictionary lacks columns: Note, Vocabulary' AS problem, count(*) AS entries FROM part
    UNION ALL SELECT 'none', count(*) FROM part
    """
)
def required_columns(spark, sf_dir):
    """Dictionaries of parts, one that lacks columns and one that has all."""
    part = table(spark, sf_dir, "part")
    short = part.select(F.col("p_name").alias("Column_Name"), F.lit(1).alias("DataType"), F.col("p_type").alias("Description"))
    whole = short.withColumns({"Note": F.lit(None).cast("string"), "Vocabulary": F.lit(None).cast("string")})

    def told(dictionary: DataFrame) -> DataFrame:
        try:
            checks.require_columns(dictionary)
            problem = "none"
        except ValueError as error:
            problem = str(error)
        return dictionary.agg(F.lit(problem).alias("problem"), F.count(F.lit(1)).alias("entries"))

    return told(short).unionByName(told(whole))


@query("SELECT CAST(c_custkey * 7 AS VARCHAR) AS row_id, c_name, CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer")
def own_row_id_column(spark, sf_dir):
    """A delivery with a column called row_id: our ids stand beside it, through cells and back."""
    customers = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 7).alias("row_id"), "c_name", "c_custkey")
    rows = keys.assign_ids(customers, reshape.INNER_ROW_ID)
    variables = reshape.variables_from_schema(customers)
    wide = reshape.pivot_text(reshape.unpivot_text(rows, variables, reshape.INNER_ROW_ID), variables)
    return wide.drop(reshape.INNER_ROW_ID)


# --- contract ----------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: lineitem stored as cells and rebuilt as a wide table."""
    return dataset_wide(spark, "/root/testdata/sf0.001")


try:
    from longhouse.llm import queries as _llm
except ModuleNotFoundError as missing:
    # the subpackage can be left out; an error inside it is not hidden
    if missing.name not in ("longhouse.llm", "longhouse.llm.queries"):
        raise
else:
    _QUERIES.update(_llm.QUERIES)
    _ORACLES.update(_llm.ORACLES)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
