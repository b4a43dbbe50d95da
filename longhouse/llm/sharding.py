"""Shards cut from a Hilbert curve through several metadata dimensions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longhouse.operators.keys import PLACE, SLOT, assign_ids, with_slots
from longhouse.session import stage

#: Bits of a curve coordinate; with three dimensions the curve has 2**15 cells.
BITS = 5
#: Text bytes of a run, the part of the curve that one task sorts and writes, are what the session
#: advises for a partition.
RUN_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Spark writes a size as bytes or with the first letter of a unit.
UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def hilbert_index(coordinates: list[F.Column], bits: int = BITS) -> F.Column:
    """Place of a cell on the Hilbert curve; coordinates are integers of ``bits`` bits.

    Skilling's transform (2004): undo the excess work bit by bit from the top, Gray-encode, and
    interleave the bits of all dimensions. The steps run as a fold over an array, one step for
    each bit and dimension, so the expression stays small.
    """
    n = len(coordinates)

    def places(last: int) -> F.Column:
        bits_down = [1 << b for b in range(bits - 1, last - 1, -1)]
        return F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(i).alias("dim")) for b in bits_down for i in range(n)])

    def undo(x, step):
        bit, dim = step["bit"], step["dim"]
        low = bit - 1
        own, first = F.get(x, dim), F.get(x, F.lit(0))
        is_set = own.bitwiseAND(bit) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, j: F.when(j == 0, F.when(is_set, v.bitwiseXOR(low)).otherwise(v.bitwiseXOR(swap)))
            .when((j == dim) & ~is_set, v.bitwiseXOR(swap))
            .otherwise(v),
        )

    def gray(x, i):
        return F.transform(
            x, lambda v, j: F.when(j == i, v.bitwiseXOR(F.get(x, i - 1))).otherwise(v)
        )

    def turn(acc, b):
        hit = F.get(acc["x"], F.lit(n - 1)).bitwiseAND(b) != 0
        return F.struct(acc["x"].alias("x"), F.when(hit, acc["t"].bitwiseXOR(b - 1)).otherwise(acc["t"]).alias("t"))

    tops = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    x = F.array(*[c.cast("int") for c in coordinates])
    if bits > 1:
        x = F.aggregate(places(1), x, undo)
    if n > 1:
        x = F.aggregate(F.array(*[F.lit(i) for i in range(1, n)]), x, gray)
    if bits > 1:
        start = F.struct(x.alias("x"), F.lit(0).alias("t"))
        x = F.aggregate(tops, start, turn, lambda acc: F.transform(acc["x"], lambda v: v.bitwiseXOR(acc["t"])))
    def weave(acc, p):
        digit = F.get(acc["x"], p["dim"]).bitwiseAND(p["bit"])
        return F.struct(acc["x"].alias("x"), (acc["h"] * 2 + F.when(digit != 0, 1).otherwise(0)).alias("h"))

    start = F.struct(x.alias("x"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(places(0), start, weave, lambda acc: acc["h"])


def text_size(text: str = "text") -> F.Column:
    """UTF-8 bytes of the text plus 1; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def name_bounds(docs: DataFrame, column: str) -> list[str]:
    """The first names of the 2**BITS ranges, even in distinct names, that a column is parted into.

    With no more names than ranges every name is a range of its own. Names are compared byte by byte.
    At most 2**BITS names come to the driver, however many there are.
    """
    ranges = 1 << BITS
    names = docs.select(F.col(column).cast("string").alias("name")).where("name IS NOT NULL").distinct()
    names = stage(names, "curve-names")
    count = names.count()
    if count > ranges:
        wanted = [r * count // ranges + 1 for r in range(ranges)]
        names = assign_ids(names, "__id", order_by=["name"], unique_order=True).where(F.col("__id").isin(wanted))
    return sorted((r.name for r in names.select("name").collect()), key=str.encode)


def name_coordinate(column: str, bounds: list[str]) -> F.Column:
    """The range that a name lies in, in the order of names; ranges are spread over the coordinate.

    A null name lies before all others, at 0 as the first range does.
    """
    if not bounds:
        return F.lit(0)
    ranges = F.array(*[F.lit(b) for b in bounds])
    below = F.size(F.filter(ranges, lambda b: b <= F.col(column).cast("string")))
    place = F.coalesce(F.greatest(below - 1, F.lit(0)), F.lit(0))
    return F.floor(place * (1 << BITS) / len(bounds)).cast("int")


def size_coordinate(size: F.Column) -> F.Column:
    """Half octaves of the size."""
    return F.least(F.floor(F.log2(size.cast("double")) * 1.5), F.lit((1 << BITS) - 1)).cast("int")


def _bytes(size: str) -> int:
    digits, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", size.strip().lower()).groups()
    return int(digits) * UNITS[unit or "b"]


def hilbert_shards(
    docs: DataFrame,
    shards: int = 8,
    size: F.Column | None = None,
    key: F.Column | None = None,
    run_bytes: int | None = None,
) -> DataFrame:
    """``docs`` with the columns shard, slot and hilbert, in ``shards`` runs of the curve.

    The dimensions are the size of the text (``size``), and the places of its source and its language
    among the sorted names, so neighbours on the curve have neighbouring values: each file covers a
    compact box and its min/max statistics prune on any of the three. Rows are ranked by (curve
    index, hash) and the ranks are cut into shards whose row counts are at most one apart; ``slot``
    is the place in the shard, gapless from 0.

    Rows are counted by cell, at most 2**15 of them; the sums along the curve tell the cell's stretch
    of all bytes, and a hash of ``key`` (id and text) the row's place in it. So each row's task is
    known in advance, tasks hold about ``run_bytes`` whatever one cell holds, and a row moves once. It is
    sorted there and staged, one file a run; ranks are then the places in the files and one offset
    for each of them. No window or join sees a row.

    Null sources, languages, texts and ids are values like others. Equal texts of one source and
    language lie in one cell. Repeated rows get a slot each; as the number of the scan's partition goes into the
    hash, they are many tasks, too. The place within a cell thus depends on how the input is cut. Fewer
    rows than shards leave shards empty; no rows give no rows. Input columns called shard, slot or
    hilbert are replaced, others kept, whatever their names.
    """
    own = ("shard", "slot", "hilbert")
    columns = [c for c in docs.columns if c.lower() not in own]
    size = text_size() if size is None else size
    key = F.xxhash64("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))) if key is None else key
    cell = hilbert_index(
        [size_coordinate(size), *[name_coordinate(c, name_bounds(docs, c)) for c in ("source", "lang")]]
    )
    cells = docs.select(cell.alias("__cell"), size.alias("__size")).groupBy("__cell")
    cells = stage(cells.agg(F.sum("__size").alias("__bytes"), F.count(F.lit(1)).alias("__n")), "curve-cells")
    total = cells.agg(F.sum("__bytes").alias("bytes"), F.sum("__n").alias("n")).first()
    n, all_bytes = total.n or 0, total.bytes or 1
    run_bytes = run_bytes or _bytes(docs.sparkSession.conf.get(RUN_BYTES))
    runs = max(shards, -(-all_bytes // run_bytes))
    # at most 2**15 cells by construction
    along = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("__cell", "__bytes", F.coalesce(F.sum("__bytes").over(along), F.lit(0)).alias("__before"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__doc"),
        cell.alias("__cell"),
        # 53 bits, exact in a double
        F.shiftrightunsigned(F.xxhash64(key, F.spark_partition_id()), 11).alias("__hash"),
    )
    place = F.col("__before") + F.col("__bytes") * (F.col("__hash") / float(1 << 53))
    run = F.least(F.floor(place * runs / all_bytes), F.lit(runs - 1)).cast("int")
    dealt = rows.join(F.broadcast(cells), "__cell").withColumn("__run", run).drop("__bytes", "__before")
    placed = with_slots(dealt.repartitionById(runs, "__run").sortWithinPartitions("__cell", "__hash"), "curve-runs")
    sizes = placed.groupBy(SLOT).agg(F.count(F.lit(1)).alias("__n"))
    # one row a run
    earlier = Window.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(SLOT, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    ranked = placed.join(F.broadcast(offsets), SLOT).withColumn("__rank", F.col("__offset") + F.col(PLACE))
    ranked = ranked.withColumn("__shard", F.expr(f"__rank * {shards} div {max(n, 1)}"))
    first = F.expr(f"(__shard * {n} + {shards - 1}) div {shards}")
    return ranked.select(
        *[F.col("__doc").getField(c).alias(c) for c in columns],
        F.col("__shard").cast("int").alias("shard"),
        (F.col("__rank") - first).cast("long").alias("slot"),
        F.col("__cell").alias("hilbert"),
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write the shards as Parquet folders, files in curve order, so that scans prune files."""
    run = F.expr(f"slot div {rows_per_file}")
    (
        sharded.withColumn("__file", run)
        .repartition("shard", "__file")
        .sortWithinPartitions("shard", "slot")
        .drop("__file")
        .write.partitionBy("shard")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
