"""Exact duplicates by skew-safe combining: locally, by salted digest, then over salts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longhouse.llm.common import lookup
from longhouse.operators.keys import PLACE, SLOT, with_slots
from longhouse.session import stage

#: What the winners of the scan's partitions are dealt into before they meet: a text that every one of a
#: million partitions holds is merged by this many tasks first.
SALTS = 64


def unchanged(text: Column) -> Column:
    return text


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def combine(rows: DataFrame) -> DataFrame:
    """(digest, text, keep_id, n) of the distinct texts of ``rows`` (doc_id, text, digest).

    Every step groups by the digest and the full text, so two texts that share a digest stay two.
    First each partition combines its own rows, then the partitions of a salt, then the salts: a text
    that holds a third of all rows is one row for each partition when it first moves, and ``SALTS`` rows at the last.
    The salt is the number of the scan's partition, the same in a task that is run again.
    """
    salted = rows.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    salted = salted.groupBy("digest", "__salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    return salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))


def _parted(rows: DataFrame, clash: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and groups of the digests in ``clash``, under a key that tells their texts apart."""
    own = with_slots(rows.join(clash, "digest", "left_semi"), "dedup-clash")
    groups = combine(own.drop(SLOT, PLACE))
    # the texts of a digest in byte order; there is more than one only where the digest fails
    place = F.row_number().over(Window.partitionBy("digest").orderBy("text"))
    groups = groups.withColumn("key", F.concat_ws(":", F.hex("digest"), place.cast("string")))
    groups = stage(groups.select("digest", "text", "key", "keep_id", "n"), "dedup-clash-groups")
    marks = own.join(groups.select("digest", "text", "key"), ["digest", "text"])
    # slots of their own, behind those of the other rows
    return marks.select("key", "doc_id", "digest", (-1 - F.col(SLOT)).alias(SLOT), PLACE), groups


def duplicates(
    docs: DataFrame,
    normal: Callable[[Column], Column] = unchanged,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest), one row for each row of ``docs`` (doc_id, text).

    Texts are equal if ``normal`` makes the same bytes of them; a null text counts as empty. Of equal
    texts the row with the largest doc_id stays (a null id only where all are null), and of rows that
    repeat text and largest id one stays. No rows give none.

    ``digest`` (binary) only routes: groups are made by ``combine``, which compares full texts. Where a
    digest stands for one text, as it does unless the hash is broken, rows find their group by
    the digest alone and no text moves again; the rows of any other digest find it by digest and text.
    Input columns other than doc_id and text are not read.
    """
    text = normal(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", text.alias("text")).withColumn("digest", digest(F.col("text")))
    by_digest = combine(rows).groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")
    )
    by_digest = stage(by_digest, "dedup-digests")
    marks = with_slots(rows.select("doc_id", "digest"), "dedup-marks")
    clash = by_digest.where("texts > 1").select("digest")
    marks = marks.withColumn("key", F.hex("digest"))
    groups = by_digest.where("texts = 1").select(F.hex("digest").alias("key"), "keep_id", "n")
    if not clash.isEmpty():
        parted, own = _parted(rows, clash)
        marks = marks.join(clash, "digest", "left_anti").select("key", "doc_id", "digest", SLOT, PLACE).unionByName(parted)
        groups = groups.unionByName(own.select("key", "keep_id", "n"))
        marks = stage(marks, "dedup-keyed")
    # rows that repeat id and text: the first by place is the one that can stay
    place = F.struct(SLOT, PLACE)
    repeated = marks.groupBy("key", F.col("doc_id").alias("keep_id")).agg(
        F.count(F.lit(1)).alias("__times"), F.min(place).alias("__first")
    )
    repeated = repeated.where("__times > 1").drop("__times")
    same = (groups["key"] == repeated["key"]) & groups["keep_id"].eqNullSafe(repeated["keep_id"])
    groups = groups.join(repeated, same, "left").select(groups["key"], groups["keep_id"], "n", "__first")
    found = lookup(marks, stage(groups, "dedup-groups"), "key", F.xxhash64(SLOT, PLACE))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.coalesce(place == F.col("__first"), F.lit(True))
    return found.select(
        "doc_id", "keep_id", F.col("n").cast("long").alias("group_size"), kept.alias("kept"), "digest", SLOT, PLACE
    )


def keep_one(docs: DataFrame, normal: Callable[[Column], Column] = unchanged) -> DataFrame:
    """``docs`` with one row of each group of equal texts, as ``duplicates`` chooses it.

    ``docs`` is staged once with the place of each row, by which the rows that stay are found again.
    """
    columns = docs.columns
    placed = with_slots(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__doc")), "dedup-docs")
    rows = placed.select(
        F.struct(SLOT, PLACE).alias("doc_id"), F.col("__doc").getField("text").alias("text"),
        F.col("__doc").getField("doc_id").alias("__id"),
    )
    # the largest id first, then the place: the struct is the id that duplicates compares
    rows = rows.select(F.struct(F.col("__id").alias("id"), F.col("doc_id").alias("at")).alias("doc_id"), "text")
    stays = duplicates(rows, normal).where("kept").select("doc_id.at.*")
    return placed.join(stays, [SLOT, PLACE], "left_semi").select(
        *[F.col("__doc").getField(c).alias(c) for c in columns]
    )
