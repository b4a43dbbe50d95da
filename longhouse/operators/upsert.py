"""Insert-if-absent and the dictionary upsert as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longhouse.operators.keys import assign_ids, last_id

FILLED = ("vocabulary_id", "description", "note")


def insert_if_absent(
    existing: DataFrame,
    incoming: DataFrame,
    id_col: str,
    name_col: str = "name",
    pos_col: str = "pos",
    last: int | None = None,
) -> DataFrame:
    """New rows, with ids, for the incoming names that ``existing`` lacks (operator E-10).

    The first row of a name in ``pos_col`` order counts; ids follow that order, from the ``last`` in use
    if the caller knows it. A known name is left as it is.
    """
    others = [c for c in incoming.columns if c not in (name_col, pos_col)]
    first = incoming.groupBy(name_col).agg(
        F.min_by(F.struct(*[F.col(c) for c in [pos_col, *others]]), pos_col).alias("__row")
    )
    fresh = first.join(existing.select(name_col).distinct(), name_col, "left_anti").select(
        name_col, "__row.*"
    )
    last = last_id(existing, id_col) if last is None else last
    numbered = assign_ids(fresh, id_col, last, order_by=[pos_col], unique_order=True)
    return numbered.drop(pos_col)


def upsert_variables(
    existing: DataFrame, incoming: DataFrame, overwrite: bool = False, pos_col: str = "pos", last: int | None = None
) -> DataFrame:
    """The variables table after a dictionary is added row by row in ``pos_col`` order (E-9).

    Key is (domain_id, name). By default a row replaces vocabulary_id, description and note only
    while one of the three is null, so the first complete row in order stays, or else the last row.
    With ``overwrite`` the last row always counts. Type, key role and id keep their first value.

    Both rules are aggregates with map-side combine, so a name that comes many times costs no
    more than the others.
    """
    row = F.struct(*FILLED)
    complete = F.lit(True)
    for c in FILLED:
        complete = complete & F.col(c).isNotNull()
    columns = ["domain_id", "name", "value_type_id", *FILLED]
    # what is there comes first, then the incoming rows in their order
    place = incoming.schema[pos_col].dataType
    before = existing.select(
        *columns, "keyrole", "variable_id", F.lit(0).alias("__new"), F.lit(None).cast(place).alias("__at")
    )
    added = incoming.select(
        *columns,
        F.lit(None).cast("string").alias("keyrole"),
        F.lit(None).cast("long").alias("variable_id"),
        F.lit(1).alias("__new"),
        F.col(pos_col).alias("__at"),
    )
    both = before.unionByName(added).withColumn("__pos", F.struct("__new", "__at"))
    latest = F.max_by(row, "__pos")
    kept: Column = latest
    if not overwrite:
        # a min_by over rows whose order key is null picks from the others, null if there are none
        first_complete = F.min_by(F.when(complete, row), F.when(complete, F.col("__pos")))
        kept = F.coalesce(first_complete, latest)
    folded = (
        both.groupBy("domain_id", "name")
        .agg(
            kept.alias("__kept"),
            F.min_by("value_type_id", "__pos").alias("value_type_id"),
            F.max("variable_id").alias("variable_id"),
            F.max("keyrole").alias("keyrole"),
            F.min("__pos").alias("__pos"),
        )
        .select("variable_id", "domain_id", "name", "value_type_id", "__kept.*", "keyrole", "__pos")
    )
    known = folded.where(F.col("variable_id").isNotNull()).drop("__pos")
    fresh = assign_ids(
        folded.where(F.col("variable_id").isNull()).drop("variable_id"),
        "variable_id",
        last_id(existing, "variable_id") if last is None else last,
        order_by=["__pos", "domain_id", "name"],
        unique_order=True,
    ).drop("__pos")
    return known.unionByName(fresh)


def set_value(
    df: DataFrame, condition_col: str, condition_value, column: str, value
) -> DataFrame:
    """``column`` set to ``value`` where ``condition_col`` equals ``condition_value`` (B-4)."""
    hit = F.col(condition_col) == F.lit(condition_value)
    dtype = df.schema[column].dataType
    return df.withColumn(column, F.when(hit, F.lit(value).cast(dtype)).otherwise(F.col(column)))


def set_key_roles(
    variables: DataFrame, domain_id, id_col: str, site_col: str | None = None
) -> DataFrame:
    """Mark the id variable and the site variable of a domain (operator B-5).

    A variable named as both is the site variable.
    """
    in_domain = F.col("domain_id") == F.lit(domain_id)
    role = F.when(in_domain & (F.col("name") == id_col), F.lit("id")).otherwise(F.col("keyrole"))
    if site_col is not None:
        role = F.when(in_domain & (F.col("name") == site_col), F.lit("site_name")).otherwise(role)
    return variables.withColumn("keyrole", role)


def assign_vocabulary(variables: DataFrame, pattern: str, domain_id, vocabulary_id: int) -> DataFrame:
    """Vocabulary of the domain's variables whose name contains ``pattern`` (operator B-6).

    ``%`` and ``_`` in the pattern act as wildcards and ASCII case is ignored.
    """
    hit = F.col("name").ilike(f"%{pattern}%") & (F.col("domain_id") == F.lit(domain_id))
    return variables.withColumn(
        "vocabulary_id",
        F.when(hit, F.lit(vocabulary_id).cast("long")).otherwise(F.col("vocabulary_id")),
    )


def assign_ethics(protocols: DataFrame, ethics: DataFrame) -> DataFrame:
    """Protocols with the ethics approval that names them (operator B-7).

    ``ethics`` has ethics_id and ethics_reference, a protocol name. Where several approvals name a
    protocol the latest id counts; where none does the protocol stays as it is.
    """
    from longhouse.operators.joins import lookup_join

    latest = (
        ethics.where(F.col("ethics_reference").isNotNull())
        .groupBy(F.col("ethics_reference").alias("name"))
        .agg(F.max("ethics_id").alias("__ethics"))
    )
    joined = lookup_join(protocols, latest, ["name"], "left")
    return joined.withColumn("ethics_id", F.coalesce("__ethics", "ethics_id")).select(
        *protocols.columns
    )
