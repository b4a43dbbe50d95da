"""Embedding whitening: leading eigenpairs by spectrum slicing, rows projected on them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longhouse.session import stage

#: How an entry becomes a whole number.
SCALE, SHIFT = 1024, 100_000
#: Entries from here on have no exact whole number in a double and count as not finite.
LARGEST = float(1 << 40)
COMPONENTS = 8
#: Exact sums, also where they pass 64 bits.
WHOLE = pa.decimal128(38, 0)
#: Products that are summed in doubles stay under this, so that the sums are exact.
EXACT = float(1 << 53)
#: Rows that one step of a task takes.
STEP = 4096
#: An eigenvalue is above nought if it is more than this share of the largest, by dimension.
RANK = 4 * np.finfo(np.float64).eps
#: Bunch's bound of the growth of entries, by which a pivot of one or of two rows is taken.
GROWTH = (1 + 17**0.5) / 8


# --- spectrum slicing --------------------------------------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are larger than ``shift``.

    By Sylvester's law it is the number of positive pivots of an LDL' of the shifted matrix. Pivots
    are chosen from the whole rest (Bunch and Parlett): the largest diagonal entry, or the two rows of
    the largest other entry, which make one positive and one negative pivot.
    """
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        size = np.abs(rest)
        diagonal = size.diagonal()
        one = int(diagonal.argmax())
        r, s = divmod(int(size.argmax()), len(rest))
        if diagonal[one] >= GROWTH * size[r, s]:
            pivots = [one]
            positive += bool(rest[one, one] > 0)
            if rest[one, one] == 0:
                return positive  # all that is left is nought
        else:
            pivots = [r, s]
            positive += 1
        others = np.delete(np.arange(len(rest)), pivots)
        block, side = rest[np.ix_(pivots, pivots)], rest[np.ix_(pivots, others)]
        rest = rest[np.ix_(others, others)] - side.T @ np.linalg.solve(block, side)
        rest = (rest + rest.T) / 2
    return positive


@dataclass
class Pair:
    """An eigenvalue, its unit vector, and how many eigenvalues are above the bounds around it."""

    value: float
    vector: np.ndarray
    low: float
    high: float


def _polish(matrix: np.ndarray, low: float, high: float, found: np.ndarray, scale: float, seed: int) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from inside (low, high), orthogonal to ``found``; None if it leaves."""
    n, eye = len(matrix), np.eye(len(matrix))
    x = np.random.default_rng(seed).standard_normal(n)
    shift, best = (low + high) / 2, None
    for step in range(60):
        x -= found @ (found.T @ x)
        x -= found @ (found.T @ x)
        x /= np.linalg.norm(x)
        if step > 2:  # inverse iteration first, so that the nearest vector leads
            value = float(x @ (matrix @ x))
            miss = float(np.linalg.norm(matrix @ x - value * x))
            if best is not None and miss >= best[2] / 2:
                break  # converged as far as doubles go
            best = (value, x.copy(), miss)
            if low < value < high:
                shift = value
        try:
            x = np.linalg.solve(matrix - shift * eye, x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            x = np.linalg.solve(matrix - (shift + scale * 1e-15) * eye, x)
        if not np.isfinite(x).all():
            break
    if best is None or best[2] > 1e-11 * scale or not low <= best[0] <= high:
        return None
    return best[:2]


def leading(matrix: np.ndarray, count: int) -> list[Pair]:
    """The largest eigenvalues above nought, ``count`` at most, by falling value, with unit vectors.

    Inertia counts halve an interval until it holds the wanted eigenvalue alone (or several that
    doubles cannot tell apart); Rayleigh quotients then converge to it. Counts on both sides of the
    value found certify its number. Vectors are orthogonal; the largest entry of each is positive.
    """
    scale = float(np.abs(matrix).sum(axis=1).max()) if len(matrix) else 0.0
    if not scale > 0:
        return []
    tiny = scale * 64 * len(matrix) * np.finfo(np.float64).eps
    counts: dict[float, int] = {}

    def over(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(matrix, shift)
        return counts[shift]

    pairs: list[Pair] = []
    found = np.zeros((len(matrix), 0))
    over(-scale * 1.0625), over(scale * 1.0625)
    for k in range(1, min(count, len(matrix)) + 1):
        # the nearest shifts tried so far that have k eigenvalues above them, and fewer
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k)
        pair = None
        while pair is None:
            alone = over(low) == k and over(high) == k - 1
            if alone or high - low <= tiny:
                pair = _polish(matrix, low - tiny, high + tiny, found, scale, k)
                if pair is not None and not over(pair[0] - tiny) >= k > over(pair[0] + tiny):
                    pair = None  # a neighbour's
            if pair is None:
                middle = (low + high) / 2
                if high - low <= tiny / 16 or middle in (low, high):
                    raise ArithmeticError(f"eigenvalue {k} could not be told from its neighbours")
                if over(middle) >= k:
                    low = middle
                else:
                    high = middle
        value, vector = pair
        if pairs and value <= RANK * len(matrix) * pairs[0].value or value <= 0:
            break
        if vector[np.abs(vector).argmax()] < 0:
            vector = -vector
        pairs.append(Pair(value, vector, value - tiny, value + tiny))
        found = np.column_stack([found, vector])
    return pairs


# --- sums over all rows ------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector is whole: no null, no entry that is null or not finite."""
    entry = F.col("embedding")
    fine = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST))
    x = F.transform(entry, lambda c: F.floor(SCALE * c.cast("double")).cast("long") + SHIFT)
    return vectors.where(entry.isNotNull() & (F.size(entry) > 0)).where(fine).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("x"))
    return np.asarray(lists.flatten()).reshape(-1, dims)


def _total(sums: DataFrame, *keys: str) -> list:
    return sums.groupBy(*keys).agg(F.sum("total").cast("string").alias("total")).collect()


def column_sums(rows: DataFrame, dims: int) -> list[int]:
    """Exact sums of the columns; each task sends one row for each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                # 4096 numbers under 2**51 fit a long
                total = total + _matrix(batch.slice(start, STEP), dims).sum(axis=0).astype(object)
        yield _sums({"i": list(range(dims))}, total.tolist())

    found = {r.i: int(r.total) for r in _total(rows.mapInArrow(add, "i int, total decimal(38,0)"), "i")}
    return [found.get(i, 0) for i in range(dims)]


def _sums(keys: dict[str, list[int]], totals: list) -> pa.RecordBatch:
    arrays = [pa.array(k, pa.int32()) for k in keys.values()]
    arrays.append(pa.array([Decimal(int(t)) for t in totals], WHOLE))
    return pa.RecordBatch.from_arrays(arrays, [*keys, "total"])


def product_sums(rows: DataFrame, centre: list[int]) -> np.ndarray:
    """Exact sums of the products of all pairs of centred columns, as Python numbers.

    ``centre`` is the whole part of the mean, so products are those of deviations. They are multiplied
    as doubles where every sum is exact in one, else as Python numbers.
    """
    dims, left, right = len(centre), *np.triu_indices(len(centre))
    middle = np.array(centre, np.int64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                z = _matrix(batch.slice(start, STEP), dims) - middle
                most = float(np.abs(z).max(initial=0))
                if most * most * len(z) < EXACT:
                    z = z.astype(np.float64)
                    total = total + (z.T @ z).astype(np.int64).astype(object)
                else:
                    z = z.astype(object)
                    total = total + z.T @ z
        yield _sums({"i": left.tolist(), "j": right.tolist()}, total[left, right].tolist())

    out = np.zeros((dims, dims), object)
    for r in _total(rows.mapInArrow(add, "i int, j int, total decimal(38,0)"), "i", "j"):
        out[r.i, r.j] = out[r.j, r.i] = int(r.total)
    return out


@dataclass
class Whitener:
    """What was learned from the fit list: n, the sums, the components and the trace of the covariance."""

    n: int
    sums: list[int]
    pairs: list[Pair]
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener:
    """The covariance's leading eigenpairs over ``rows`` (vec_id, x), which have one length.

    Sums are exact whole numbers, so the covariance is the same to the last bit however rows lie:
    with z = x - m for whole m near the mean, n * n * V is n times the sums of z z' less the outer
    product of the sums of z. What comes to the driver grows with the square of the dimension only.
    """
    lengths = rows.agg(F.max(F.size("x")).alias("dims"), F.count(F.lit(1)).alias("n")).first()
    if not lengths.n:
        return Whitener(0, [], [], 0.0)
    n, dims = lengths.n, lengths.dims
    sums = column_sums(rows, dims)
    centre = [s // n for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, centre)], object)
    scaled = n * product_sums(rows, centre) - np.outer(rest, rest)
    # one whole number divided by another: rounded once
    covariance = np.array([[v / (n * n) for v in row] for row in scaled.tolist()], np.float64)
    trace = sum(scaled.diagonal().tolist()) / (n * n)
    return Whitener(n, sums, leading(covariance, components), trace)


def project(rows: DataFrame, model: Whitener) -> DataFrame:
    """(vec_id, deviation, w): the squared deviation times n * n, and the whitened components."""
    n, dims = model.n, model.dims
    values = np.array([p.value for p in model.pairs])
    axes = np.array([p.vector for p in model.pairs]).reshape(-1, dims)
    sums = np.array(model.sums, object)
    whole = np.array([s // n for s in model.sums], np.int64)
    part = np.array([(s % n) / n for s in model.sums])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                own = batch.slice(start, STEP)
                x = _matrix(own, dims)
                far = max(float(np.abs(x).max(initial=0)) * n, float(max(map(abs, model.sums))))
                if (2 * far) ** 2 * dims < 2.0**62:
                    y = n * x - sums.astype(np.int64)
                    deviation = pa.array((y * y).sum(axis=1)).cast(WHOLE)
                else:
                    y = n * x.astype(object) - sums
                    deviation = pa.array([Decimal(d) for d in (y * y).sum(axis=1).tolist()], WHOLE)
                # the whole part first: x - S/n without rounding x
                w = ((x - whole) - part) @ axes.T / np.sqrt(values)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), len(values))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), deviation, lists.cast(pa.list_(pa.float64()))],
                    ["vec_id", "deviation", "w"],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"vec_id {kind}, deviation decimal(38,0), w array<double>")


def identity_error(projected: DataFrame, components: int) -> float:
    """The largest entry, in size, of the whitened columns' covariance less the identity."""
    w = [F.get("w", F.lit(i)) for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    off = [F.abs(F.covar_pop(w[i], w[j]) - float(i == j)) for i, j in pairs]
    return projected.agg(F.array_max(F.array(*off)).alias("most")).first().most


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Rows whose vector is null, empty, or holds an entry that is null, not finite or of 2**40 and more are
    left out, and those that have not the most frequent length (the longest of several). Nought is
    a vector like others; repeated rows and null ids count and are returned each. Components are those
    with an eigenvalue above nought, ``components`` at most; if all vectors are equal there are none
    and no rows, and no rows give none. Deviations are whole numbers of up to 38 digits. Other input
    columns are not read.
    """
    rows = usable(vectors.select("vec_id", "embedding"))
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    rows = rows.where(F.size("x") == (most.dims if most else 0))
    model = fit(rows, components)
    if not model.pairs:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        none = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], none)
    projected = stage(project(rows, model), "whitened")
    error = identity_error(projected, len(model.pairs))
    shares = F.array(*[F.lit(p.value / model.trace) for p in model.pairs])
    return projected.select(
        "vec_id", "deviation", F.posexplode("w").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
