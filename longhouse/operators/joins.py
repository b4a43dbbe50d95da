"""Joins on equal columns and on containment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``big`` to ``small`` (inner or left) on equal columns; null keys never match.

    How is left to adaptive execution, which knows the sizes once the sides are shuffled: it
    broadcasts a small side and splits the partition of a hot key. Building the join runs no job.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left joins")
    return big.join(small, list(on), how)


def contained_join(big: DataFrame, text: str, codes: DataFrame, code: str) -> DataFrame:
    """Inner join of every text with every code it contains (operator D-15).

    A containment test alone would compare all pairs. Instead texts are cut into their distinct grams
    of the length of the shortest code, so at most as many as they have characters, and each code
    is joined by one of its grams, that which the fewest codes have. What meets is then tested, so matching is
    exact. An empty code is contained in every text.
    """
    known = codes.where(F.col(code).isNotNull())
    shortest = F.coalesce(known.agg(F.min(F.nullif(F.length(code), F.lit(0)))).scalar(), F.lit(1))
    empty = F.coalesce(known.agg(F.bool_or(F.length(code) == 0)).scalar(), F.lit(False))

    def grams(c: str) -> Column:
        places = F.sequence(F.lit(1), F.length(c) - F.col("__q") + 1)
        cut = F.transform(places, lambda at: F.substring(F.col(c), at, F.col("__q")))
        return F.when(F.length(c) >= F.col("__q"), F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))

    nothing = F.array(F.lit(""))
    one = F.when(F.length(code) == 0, nothing).otherwise(grams(code))
    of_codes = known.select(code).distinct().withColumn("__q", shortest).select(code, F.explode(one).alias("__gram"))
    shared = of_codes.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("__gram")))
    rarest = shared.groupBy(code).agg(F.min(F.struct("__n", "__gram"))["__gram"].alias("__gram"))
    of_text = F.when(F.col("__any"), F.concat(grams(text), nothing)).otherwise(grams(text))
    cut = (
        big.withColumns({"__q": shortest, "__any": empty})
        .withColumn("__gram", F.explode(of_text))
        .drop("__q", "__any")
    )
    # both sides may have a column of the code's name
    keyed = lookup_join(known, rarest, [code]).withColumn("__code", F.col(code))
    met = lookup_join(cut, keyed, ["__gram"])
    return met.where(F.contains(F.col(text), F.col("__code"))).drop("__gram", "__code")
