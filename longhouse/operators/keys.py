"""Dense surrogate keys without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longhouse.session import stage

SLOT = "__slot"
PLACE = "__place"
_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_slots(df: DataFrame, label: str) -> DataFrame:
    """Stage ``df`` with the partition (``__slot``) and place in it (``__place``) of each row."""
    return stage(
        df.withColumn(SLOT, F.spark_partition_id()).withColumn(
            PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
        ),
        label,
    )


def assign_ids(
    df: DataFrame,
    id_col: str,
    base: int = 0,
    order_by: Sequence[str | Column] | None = None,
    unique_order: bool = False,
) -> DataFrame:
    """Number the rows ``base + 1 .. base + n`` with no gaps (operator I-2).

    Without ``order_by`` rows keep scan order and nothing is shuffled. With it the rows are
    range-partitioned on that order; ties fall back to scan order, so equal sort keys, however
    many, still spread over all partitions. ``unique_order=True`` says there are no ties and
    saves that extra pass.

    The numbered layout is staged before it is counted, so counts and numbers always agree, also
    when a lost executor forces tasks to run again. One number for each partition comes to the driver.
    """
    return numbered(place_rows(df, order_by, unique_order), id_col, base)


@dataclass(frozen=True)
class Placed:
    """Staged rows with their places, and how many rows lie before those of each partition."""

    rows: DataFrame
    columns: list[str]
    offsets: list[int]
    count: int


def place_rows(df: DataFrame, order_by: Sequence[str | Column] | None = None, unique_order: bool = False) -> Placed:
    """Stage rows and count them by partition: all that ``numbered`` needs, whatever number comes first."""
    columns = df.columns
    if order_by:
        order = list(order_by)
        if not unique_order:
            df = with_slots(df, "id-ties")
            order += [SLOT, PLACE]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    slotted = with_slots(df, "ids")
    sizes = {r[SLOT]: r["count"] for r in slotted.groupBy(SLOT).count().collect()}
    slots = range(max(sizes, default=-1) + 1)
    offsets = list(accumulate((sizes.get(s, 0) for s in slots), initial=0))
    return Placed(slotted, columns, offsets[:-1], offsets[-1])


def numbered(placed: Placed, id_col: str, base: int = 0) -> DataFrame:
    """Placed rows with numbers from ``base + 1`` on; nothing is joined or shuffled."""
    # folded into one array, however many partitions there are
    offsets = F.split(F.lit(",".join(map(str, placed.offsets or [0]))), ",").cast("array<bigint>")
    number = F.get(offsets, F.col(SLOT)) + F.col(PLACE) + F.lit(base + 1)
    return placed.rows.select(number.cast("long").alias(id_col), *placed.columns)


def last_id(df: DataFrame, id_col: str) -> int:
    """Largest id in use, 0 for an empty table."""
    return df.agg(F.max(id_col)).first()[0] or 0
