"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How many keys ``lookup`` may broadcast. Any other key holds at most 1/HOT_KEYS of the rows.
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_rest(column: str, modulus: int) -> F.Column:
    """crc32 of the column as text, modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def lookup(rows: DataFrame, values: DataFrame, key: str, spread: F.Column) -> DataFrame:
    """Left join of ``rows`` to ``values`` (one row per key), whatever share of rows a key holds.

    The keys with the most rows, ``HOT_KEYS`` at most, come by a broadcast of that many rows. Their
    rows then have a join key of their own made from ``spread`` (a hash of the row), so the shuffle
    join that serves all other keys deals them evenly. Null keys are spread the same way and match
    nothing. The key must be a string or number.
    """
    extra = [c for c in values.columns if c != key]
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where("__n > 1").orderBy(F.desc("__n"), key).limit(HOT_KEYS).select(key)
    found = hot.join(values, key, "left")
    found = found.select(F.col(key).alias("__hot"), *[F.col(c).alias(f"__hot_{c}") for c in extra])
    text = F.col(key).cast("string")
    near = rows.join(F.broadcast(found), F.col(key) == F.col("__hot"), "left").withColumn(
        "__key",
        F.when(F.col("__hot").isNull() & F.col(key).isNotNull(), F.concat(F.lit("k"), text)).otherwise(
            F.concat(F.lit("s"), spread.cast("string"))
        ),
    )
    far = values.select(
        F.concat(F.lit("k"), F.col(key).cast("string")).alias("__key"),
        *[F.col(c).alias(f"__far_{c}") for c in extra],
    )
    return near.join(far, "__key", "left").select(
        *rows.columns, *[F.coalesce(f"__hot_{c}", f"__far_{c}").alias(c) for c in extra]
    )
