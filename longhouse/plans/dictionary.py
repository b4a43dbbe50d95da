"""Dictionaries and vocabularies: reading, adding, building, reporting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longhouse import schemas as S
from longhouse.config import CsvFormat, IngestConfig, UserIngestConfig
from longhouse.functions import text as X
from longhouse.operators import upsert
from longhouse.operators.checks import require_columns
from longhouse.operators.joins import contained_join, lookup_join
from longhouse.operators.lookup import named_key, named_keys
from longhouse.operators.numbering import number_within, ordered_concat
from longhouse.session import with_scratch
from longhouse.sources.archive import Archive, Batch
from longhouse.sources.delimited import read_dictionary, reexport, write_csv
from longhouse.sources.documents import path_exists

# --- reading -----------------------------------------------------------------------------------


def vocabulary_from_lines(variables: DataFrame, name: str = "Column_Name", text: str = "Description", keep: Sequence[str] = ()) -> DataFrame:
    """Vocabulary items in the lines of a description (operators H-1, H-2).

    Line 1 describes the vocabulary; each later line is ``code,description``, numbered from 1. A
    text of one line has no vocabulary.
    """
    # cut before the lines are spread, or every line would cut the whole text again
    heads = variables.where(X.has_lines(F.col(text))).select(
        name, *keep, X.lines(F.col(text)).alias("__lines")
    )
    cut = heads.select(
        name,
        *keep,
        F.get("__lines", F.lit(0)).alias("vocabulary_description"),
        F.slice("__lines", F.lit(2), F.size("__lines") - 1).alias("__items"),
    ).select(
        name, *keep, "vocabulary_description", F.posexplode("__items").alias("__at", "__line")
    )
    return cut.select(
        name,
        *keep,
        "vocabulary_description",
        (F.col("__at") + 1).cast("long").alias("value"),
        X.code_and_description(F.col("__line")).alias("__item"),
    ).select(name, *keep, "vocabulary_description", "value", "__item.*")


def first_line(variables: DataFrame, text: str = "Description") -> DataFrame:
    """Descriptions cut to their first line (operator H-2)."""
    return variables.withColumn(text, F.substring_index(F.col(text), "\n", 1))


def vocabulary_from_sheet(
    items: DataFrame, variables: DataFrame, order_by: Sequence[str] = ("pos",)
) -> DataFrame:
    """Vocabulary items listed in a sheet of their own (operators F-1, C-7).

    ``items`` has Column_Name, Items and Description; those of one variable are numbered from 1 in
    sheet order. Items of a variable that the dictionary lacks are left out.
    """
    names = variables.select("Column_Name").distinct()
    known = lookup_join(items, names, ["Column_Name"])
    numbered = number_within(known, ["Column_Name"], order_by, "value")
    return numbered.select(
        "Column_Name",
        "value",
        F.col("Items").cast("string").alias("code"),
        F.col("Description").alias("description"),
    )


def read_variables(variables: DataFrame, items: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Variables and vocabulary items of one dictionary (pipeline J-8).

    With a sheet of items vocabularies come from there and are described by their variable;
    without one they come from the lines of the descriptions. ``Vocabulary`` names the vocabulary
    of a variable; ``source`` is the position of the row that an item belongs to.
    """
    if items is None:
        found = vocabulary_from_lines(variables, keep=["pos"]).withColumnRenamed("pos", "source")
        has = X.has_lines(F.col("Description"))
        marked = variables.withColumn("Vocabulary", F.when(has, F.col("Column_Name")))
        return first_line(marked), found
    found = vocabulary_from_sheet(items, variables)
    described = variables.groupBy("Column_Name").agg(
        F.min_by("Description", "pos").alias("vocabulary_description"),
        F.min("pos").alias("source"),
    )
    found = lookup_join(found, described, ["Column_Name"])
    named = items.select("Column_Name", F.col("Column_Name").alias("Vocabulary")).distinct()
    return lookup_join(variables, named, ["Column_Name"], "left"), found


# --- adding ------------------------------------------------------------------------------------


def add_domain(batch: Batch, name: str, description: str = "") -> int:
    """Id of a domain, which is added if it is new (operator E-10)."""
    found = named_key(batch.table("domains"), name, "domain_id")
    return found or batch.insert_row("domains", {"name": name, "description": description})


def new_vocabularies(
    existing: DataFrame, items: DataFrame, last: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Vocabularies and their items that the archive lacks by name (operator E-10).

    ``items`` has Column_Name, vocabulary_description, value, code, description and ``source``, the
    position of the dictionary row they belong to. The first row of a name brings the items.
    """
    heads = items.select(
        F.col("Column_Name").alias("name"),
        F.col("vocabulary_description").alias("description"),
        F.col("source").alias("pos"),
    ).distinct()
    first = heads.groupBy("name").agg(F.min("pos").alias("source"))
    fresh = upsert.insert_if_absent(existing, heads, "vocabulary_id", last=last)
    owned = items.withColumnRenamed("Column_Name", "name")
    owned = lookup_join(owned, first, ["name", "source"])
    owned = lookup_join(
        owned, fresh.select("vocabulary_id", "name"), ["name"]
    )
    return fresh, owned.select("vocabulary_id", "value", "code", "description")


@with_scratch
def ingest_dictionary(
    archive: Archive,
    ingest: IngestConfig | UserIngestConfig,
    dictionarypath: str,
    overwrite: bool = False,
) -> None:
    """Add the variables and vocabularies of all dictionaries of an ingest (pipeline J-7).

    A source's ingest marks its id and its site variable, a user's only the id.
    """
    site_col, files = None, list(ingest.datadictionaries)
    if isinstance(ingest, UserIngestConfig):
        files = [ingest.datadictionaries[name] for name in sorted(ingest.datadictionaries)]
    else:
        site_col = ingest.source.site_col
    batch = archive.begin()
    domain_id = add_domain(batch, ingest.domain_name, ingest.domain_description)
    folder = f"{dictionarypath.rstrip('/')}/{ingest.domain_name}"
    tables = [read_dictionary_tables(archive, folder, f) for f in files]
    add_variables(batch, domain_id, tables, ingest.id_col, site_col, overwrite)
    batch.publish()


def read_dictionary_tables(archive: Archive, folder: str, filename: str) -> tuple[DataFrame, DataFrame]:
    """Variables and items of one dictionary file (operators A-3, A-4).

    ``x.csv`` is one ``;``-separated table. ``x.xlsx`` stands for its sheets, extracted before as
    ``x/variables.csv`` and, if it has one, ``x/vocabularies.csv``.
    """
    spark = archive.spark
    stem, _, ext = filename.rpartition(".")
    if ext == "csv":
        return read_variables(read_dictionary(spark, f"{folder}/{filename}"), None)
    if ext != "xlsx":
        raise ValueError(
            f"a dictionary must be an .xlsx or a .csv file: {filename}"
        )
    variables = read_dictionary(spark, f"{folder}/{stem}/variables.csv", CsvFormat())
    sheet = f"{folder}/{stem}/vocabularies.csv"
    if path_exists(spark, sheet):
        return read_variables(variables, read_dictionary(spark, sheet, CsvFormat()))
    none = spark.createDataFrame(
        [], "Column_Name string, Items string, Description string, pos long"
    )
    return read_variables(variables, none)


def _place(file: int, pos: Column) -> Column:
    return F.struct(F.lit(file).alias("file"), pos.cast("long").alias("pos"))


def add_variables(
    batch: Batch,
    domain_id: int,
    tables: Sequence[tuple[DataFrame, DataFrame]],
    id_col: str,
    site_col: str | None = None,
    overwrite: bool = False,
) -> None:
    """Fold dictionaries, in order, into variables and vocabularies (E-9, E-10, B-5)."""
    rows: DataFrame | None = None
    items: DataFrame | None = None
    # rows are in the order of their files, then of their place in the file
    for n, (variables, vocabulary) in enumerate(tables):
        require_columns(variables)
        placed = variables.select(
            "Column_Name", "DataType", "Description", "Note", "Vocabulary",
            _place(n, F.col("pos")).alias("pos"),
        )
        owned = vocabulary.select(
            "Column_Name", "vocabulary_description", "value", "code", "description",
            _place(n, F.col("source")).alias("source"),
        )
        rows = placed if rows is None else rows.unionByName(placed)
        items = owned if items is None else items.unionByName(owned)
    if rows is None:
        raise ValueError("no data dictionaries given")
    fresh, fresh_items = new_vocabularies(batch.table("vocabularies"), items, batch.last_id("vocabularies"))
    batch.write("vocabularies", fresh)
    batch.insert("vocabulary_items", fresh_items, ["vocabulary_id", "value"])
    incoming = rows.select(
        F.lit(domain_id).cast("long").alias("domain_id"),
        F.col("Column_Name").alias("name"),
        F.col("DataType").cast("int").alias("value_type_id"),
        "Vocabulary",
        F.col("Description").alias("description"),
        F.col("Note").alias("note"),
        "pos",
    )
    incoming = named_keys(incoming, "Vocabulary", batch.table("vocabularies"), "vocabulary_id")
    variables = upsert.upsert_variables(
        batch.table("variables"), incoming, overwrite, last=batch.last_id("variables")
    )
    batch.write("variables", upsert.set_key_roles(variables, domain_id, id_col, site_col))
    keys = [id_col, *([site_col] if site_col else [])]
    own = batch.added("variables").where((F.col("domain_id") == domain_id) & F.col("name").isin(keys))
    found = {r.name for r in own.select("name").collect()}
    for name in keys:
        if name not in found:
            raise LookupError(f"key column {name} is not in the dictionary")


# --- building ----------------------------------------------------------------------------------


def lab_dictionary(
    columns: DataFrame, samples: DataFrame, vocabulary: DataFrame, key_column: str
) -> DataFrame:
    """Dictionary of laboratory result columns (pipeline J-12).

    ``columns`` has Column_Name; ``samples`` Sample_code and Desc; ``vocabulary``
    champs_local_code, c_pref_name and ``pos``. A description is that of the sample, followed by
    the names of all codes the result code contains, in vocabulary order.
    """
    parts = columns.select("Column_Name").withColumn("Sample_code", X.sample_code(F.col("Column_Name")))
    parts = parts.withColumn("Result_code", X.result_code(F.col("Column_Name"), F.col("Sample_code")))
    codes = vocabulary.select(
        F.col("champs_local_code").alias("code"), F.col("c_pref_name").alias("preferred"), "pos"
    )
    # many columns end in the same result code; each code is matched once
    found = contained_join(parts.select("Result_code").distinct(), "Result_code", codes, "code")
    named = ordered_concat(found, ["Result_code"], ["pos"], "preferred", ", ", "names")
    named = named.withColumn("names", F.concat("names", F.lit(", ")))
    described = lookup_join(parts, samples.select("Sample_code", "Desc"), ["Sample_code"], "left")
    described = lookup_join(described, named, ["Result_code"], "left")
    text = F.concat(
        F.col("Desc"),
        F.lit(": "),
        F.coalesce("names", F.lit("")),
        X.result_suffix(F.col("Result_code")),
    )
    return described.select(
        "Column_Name",
        F.when(F.col("Column_Name") == key_column, F.lit("Yes")).otherwise(F.lit("")).alias("Key"),
        X.mark_commas(X.trim_list_end(text)).alias("Description"),
        F.lit("").alias("Note"),
        F.lit(S.STRING).alias("DataType"),
    )


def panel_vocabulary(panels: DataFrame, targets: Sequence[str], order_by: str = "pos") -> DataFrame:
    """Vocabulary of multi-target panels (pipeline J-13).

    ``panels`` has pathogen, Interpretation, the target columns and a position. Rows of one
    interpretation of a pathogen become its description, ``name:value`` lists joined by ``|``;
    interpretations are numbered by first appearance in their panel.
    """
    rows = panels.select(
        "pathogen",
        X.strip(F.col("Interpretation")).alias("interpretation"),
        X.pair_list(targets).alias("values"),
        F.col(order_by).alias("__pos"),
    )
    keys = ["pathogen", "interpretation"]
    texts = ordered_concat(rows, keys, ["__pos"], "values", "|", "description")
    first = rows.groupBy(*keys).agg(F.min("__pos").alias("__first"))
    numbers = number_within(first, ["pathogen"], ["__first"], "key")
    return lookup_join(texts, numbers.drop("__first"), keys).select(
        "pathogen", "key", "interpretation", "description"
    )


def panel_index(pathogens: DataFrame) -> DataFrame:
    """Vocabulary heads of the panels listed in a workbook's first sheet (pipeline J-13).

    ``vocabulary_id`` is 0 until a vocabulary is saved.
    """
    return pathogens.select(
        F.lit(0).alias("vocabulary_id"),
        F.col("Pathogen").alias("name"),
        F.col("`Multi-target result code`").alias("description"),
    )


def write_variable_report(archive: Archive, path: str) -> tuple[str, str]:
    """The variable report as comma-separated file and once more with semicolons (J-14, B-10)."""
    report = variable_report(archive.table("variables"))
    first = write_csv(report, f"{path}/variable_descriptions.csv")
    return first, reexport(archive.spark, first, f"{path}/variable_descriptions.txt")


def variable_report(variables: DataFrame, max_domain: int = 3) -> DataFrame:
    """Distinct (name, description) of the first domains (pipeline J-14)."""
    return variables.where(F.col("domain_id") <= max_domain).select("name", "description").distinct()


# What in a description or column name tells the type of a variable, as (column,
# words, type). Later entries win over earlier ones.
TYPE_RULES = (
    ("Description", "record the date", S.DATE),
    ("Description", "the weight", S.FLOAT),
    ("Description", "how old", S.FLOAT),
    ("Description", "how many", S.FLOAT),
    ("Description", "how long", S.FLOAT),
    ("Column_Name", "_unit", S.CATEGORY),
    ("Description", "enter length of", S.FLOAT),
)

# The same for dictionaries that name types, and the ids of those names.
TYPE_NAME_IDS = {
    "integer": 1,
    "double precision": 2,
    "text": 3,
    "date": 4,
    "timestamp with time zone": 5,
    "time": 6,
    "category": 7,
}
NAMED_TIMESTAMPS = ("id10011", "id10481")
NAMED_DATES = ("id10021", "id10023_a")
NAMED_DESCRIPTION_DATE = "record the date"
NAMED_DESCRIPTION_NUMBERS = (
    "calculated number",
    "what was the weight",
    "how old",
    "how many",
    "how long",
)
NAMED_UNIT = "_unit"


def _mentions(column: Column, words: str) -> Column:
    return F.contains(F.lower(F.coalesce(column, F.lit(""))), F.lit(words))


def harmonise_types(dictionary: DataFrame) -> DataFrame:
    """Declared types corrected by what descriptions and names say (pipeline J-15, first form).

    A rule that one row of a column meets holds for all rows of that column.
    """
    met = dictionary.groupBy("Column_Name").agg(
        *[F.bool_or(_mentions(F.col(c), w)).alias(f"__r{i}") for i, (c, w, _) in enumerate(TYPE_RULES)]
    )
    kind = F.col("DataType")
    for i, (_, _, value) in enumerate(TYPE_RULES):
        kind = F.when(F.col(f"__r{i}"), F.lit(value)).otherwise(kind)
    met_type = lookup_join(dictionary, met, ["Column_Name"])
    return met_type.withColumn("DataType", kind).select(*dictionary.columns)


def harmonise_named_types(dictionary: DataFrame, key_column: str = "rowid") -> DataFrame:
    """Dictionary rows from (column_name, description, type) with named types (J-15, second form).

    Types follow the rules above; a column that is left with several rows becomes text; duplicate
    rows are dropped; names of types become ids, null for an unknown name.
    """
    name, description = F.col("column_name"), F.col("description")
    by_column = dictionary.groupBy("column_name").agg(
        F.bool_or(_mentions(description, NAMED_DESCRIPTION_DATE)).alias("__date"),
        F.bool_or(
            reduce(or_, [_mentions(description, w) for w in NAMED_DESCRIPTION_NUMBERS])
        ).alias("__number"),
        F.bool_or(_mentions(description, NAMED_UNIT) | _mentions(name, NAMED_UNIT)).alias("__unit"),
    )
    typed = lookup_join(
        dictionary, by_column, ["column_name"])
    kind = (
        F.when(F.col("__unit"), F.lit("text"))
        .when(F.col("__number"), F.lit("double precision"))
        .when(name.isin(*NAMED_DATES) | F.col("__date"), F.lit("date"))
        .when(name.isin(*NAMED_TIMESTAMPS), F.lit("timestamp with time zone"))
        .otherwise(F.col("type"))
    )
    typed = typed.select("column_name", "description", kind.alias("type")).distinct()
    several = typed.groupBy("column_name").agg((F.count(F.lit(1)) > 1).alias("__several"))
    settled = lookup_join(typed, several, ["column_name"])
    settled = settled.select(
        "column_name",
        "description",
        F.when(F.col("__several"), F.lit("text")).otherwise(F.col("type")).alias("type"),
    ).distinct()
    ids = F.lit(None).cast("int")
    for type_name, type_id in TYPE_NAME_IDS.items():
        ids = F.when(F.col("type") == type_name, F.lit(type_id)).otherwise(ids)
    return settled.select(
        F.col("column_name").alias("Column_Name"),
        F.when(name == key_column, F.lit("Yes")).otherwise(F.lit("")).alias("Key"),
        X.mark_commas(F.col("description")).alias("Description"),
        F.lit("").alias("Note"),
        ids.alias("DataType"),
    )
