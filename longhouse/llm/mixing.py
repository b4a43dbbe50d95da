"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longhouse.llm.common import lookup

#: The distribution is tabulated up to the count beyond which less than this probability is left.
TAIL = 1e-15
#: Digits of md5 that make the uniform number: 13 hex digits are 52 bits, exact in a double.
DIGITS = 13


def uniform(*parts: F.Column | str) -> F.Column:
    """A number in [0, 1) that depends on the given texts only."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("double") / float(
        16**DIGITS
    )


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, temperature: float = 2.0
) -> DataFrame:
    """The mean number of copies of a row of each source: (source, n_rows, rate).

    The result of the mix has ``epochs`` times as many rows as ``docs`` on average, of which a source
    has its weight's share. Without ``weights`` a source weighs its rows to the power
    1/``temperature``; with them, a source that they do not name weighs 0. A null source is a source
    of its own, which ``weights`` name by None.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        weight = F.pow(F.col("n_rows").cast("double"), F.lit(1.0 / temperature))
    else:
        if any(not w >= 0 or math.isinf(w) for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    counts = counts.withColumn("__w", weight)
    total = counts.agg(F.sum("n_rows").alias("__rows"), F.sum("__w").alias("__all"))
    rows, all_ = total.select("__rows").scalar(), total.select("__all").scalar()
    share = F.when(all_ > 0, F.col("__w") / all_).otherwise(0.0)
    return counts.select("source", "n_rows", (epochs * rows * share / F.col("n_rows")).alias("rate"))


def poisson_table(rate: F.Column) -> F.Column:
    """P(count <= 0), P(count <= 1), ... as an array, as far as there is probability left.

    The terms are taken through logarithms, so a large rate does not underflow.
    """
    # beyond rate + 9 sqrt(rate) + 40 the tail is below TAIL
    last = F.ceil(rate + 9 * F.sqrt(rate) + 40).cast("int")
    steps = F.transform(
        F.sequence(F.lit(0), last), lambda k: F.when(k > 0, F.ln(rate) - F.ln(k)).otherwise(-rate)
    )
    start = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def add(acc, step):
        log = acc["log"] + step
        total = acc["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.when(rate > 0, F.aggregate(steps, start, add, lambda acc: acc["cdf"])).otherwise(
        F.array().cast("array<double>")
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    epochs: float = 1.0,
    temperature: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with each row repeated a Poisson number of times, all rows in one random order.

    Every row draws its count by inverting the Poisson distribution of its source's rate at a uniform
    number hashed from ``seed`` and doc_id; the same input gives the same mix on any cluster, and a
    retried task draws the same counts. Added columns: ``copy`` (1..count), ``rate`` and
    ``shuffle_key``, by which the result is range-partitioned and sorted. Input columns of these
    names are replaced.

    A null doc_id draws as the empty text; rows that share a doc_id draw the same count, and their
    copies tie in the order only within md5. A null text is kept as it is. No rows give no rows.
    A source that holds most rows is no single task: rates are looked up with ``lookup``, and the
    final order spreads over ranges of the hash.
    """
    own = ("copy", "rate", "shuffle_key")
    columns = [c for c in docs.columns if c.lower() not in own]
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rates = source_rates(docs, weights, epochs, temperature)
    tables = rates.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("__source"),
        F.struct(F.col("rate").alias("rate"), poisson_table(F.col("rate")).alias("cdf")).alias("__law"),
    )
    rows = docs.select(*columns).withColumn(
        "__source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    )
    drawn = lookup(rows, tables, "__source", F.xxhash64(doc)).withColumn("__u", uniform(seed, doc))
    count = F.size(F.filter(F.col("__law.cdf"), lambda p: p <= F.col("__u")))
    copies = drawn.withColumn("__count", F.when(F.col("__law.rate") > 0, count).otherwise(0)).where("__count > 0")
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__count"))))
    out = copies.select(
        *columns,
        "copy",
        F.col("__law.rate").alias("rate"),
        F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), doc, F.col("copy").cast("string")).cast("binary")).alias(
            "shuffle_key"
        ),
    )
    return out.repartitionByRange(F.col("shuffle_key")).sortWithinPartitions("shuffle_key")
