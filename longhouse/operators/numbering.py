"""Running numbers and ordered text within groups, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longhouse.operators.keys import PLACE, SLOT, with_slots

PIECE_ITEMS = 10_000  # values of a group that are joined at a time
CELL_CHARS = (1 << 31) - 64  # a cell holds no longer text


def number_within(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], number_col: str = "value"
) -> DataFrame:
    """1..n per group in ``order_by`` order (operator F-1); the order must be total in a group.

    Rows are range-sorted on (keys, order), which cuts a big group over many partitions, numbered
    within their partition, and shifted by the rows the same group has in earlier partitions.
    """
    columns = df.columns
    order = [*keys, *order_by]
    slotted = with_slots(df.repartitionByRange(*order).sortWithinPartitions(*order), "numbers")
    pieces = slotted.groupBy(SLOT, *keys).agg(
        F.min(PLACE).alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    # a group has at most one piece per partition
    before = Window.partitionBy(*keys).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select(
        F.col(SLOT).alias("__s"),
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
    )
    same = F.col(SLOT) == F.col("__s")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return slotted.join(shifts, same).select(
        *columns, (F.col(PLACE) + F.col("__shift")).cast("long").alias(number_col)
    )


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str | Column,
    sep: str,
    text_col: str,
    piece_items: int = PIECE_ITEMS,
) -> DataFrame:
    """Join the values of each group in order (operator E-6): one row and one text per group.

    The values of a group are joined in pieces, in as many tasks as they need, and the pieces to
    the whole text. A text that a cell cannot hold is an error, not cut.
    """
    value = F.col(value) if isinstance(value, str) else value
    items = number_within(df.withColumn("__value", value), keys, order_by, "__number")
    items = items.withColumn("__piece", F.floor((F.col("__number") - 1) / piece_items).cast("long"))

    def joined(place: str, text: str) -> Column:
        ordered = F.sort_array(F.collect_list(F.struct(place, text)))
        return F.array_join(F.transform(ordered, lambda item: item[text]), sep)

    pieces = items.groupBy(*keys, "__piece").agg(joined("__number", "__value").alias("__text"))
    size = F.sum(F.octet_length("__text").cast("long") + len(sep.encode()))
    fits = F.assert_true(size <= CELL_CHARS, F.lit("a text is too long for one cell"))
    whole = pieces.groupBy(*keys).agg(joined("__piece", "__text").alias(text_col), fits.alias("__fits"))
    # the check is part of the text, or it would be pruned as unused
    return whole.select(*keys, F.when(F.col("__fits").isNull(), F.col(text_col)).alias(text_col))
