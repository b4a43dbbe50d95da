"""Nearest neighbours on a robust-pruned directed graph for each shard of the vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longhouse.session import stage

#: Out-edges of a node, beam of the searches that build and that answer, and how relaxed pruning is.
DEGREE = 24
BUILD_BEAM = 40
QUERY_BEAM = 100
ALPHA = 1.2
#: Vectors of a shard on average; the graph of a shard is built in one task.
SHARD_ROWS = 4000
#: Nodes that are searched at a time.
BATCH = 256
#: Queries that are sent to the tasks at a time.
QUERY_BLOCK = 5000


def distances(points: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of ``to`` (n, d) to the points numbered ``at`` (n, m)."""
    difference = points[at] - to[:, None, :]
    return np.einsum("nmd,nmd->nm", difference, difference)


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, to: np.ndarray, beam: int):
    """Best-first search from ``entry`` for all rows of ``to`` at once.

    ``edges`` (n, degree) holds -1 where a node has fewer. Returns the beam's nodes and squared
    distances, nearest first; the search of a row ends when all nodes of its beam were expanded.
    """
    n, rows = len(to), np.arange(len(to))
    nodes = np.full((n, beam), -1, np.int32)
    far = np.full((n, beam), np.inf, np.float32)
    expanded = np.ones((n, beam), bool)
    nodes[:, 0] = entry
    far[:, 0] = distances(points, nodes[:, :1], to)[:, 0]
    expanded[:, 0] = False
    seen = np.zeros((n, len(points)), bool)
    seen[:, entry] = True
    live = rows
    while len(live):
        waiting = np.where(expanded[live], np.inf, far[live])
        pick = waiting.argmin(axis=1)
        open_ = np.isfinite(waiting[np.arange(len(live)), pick])
        live, pick = live[open_], pick[open_]
        if not len(live):
            break
        expanded[live, pick] = True
        reached = edges[nodes[live, pick]]
        fresh = (reached >= 0) & ~seen[live[:, None], reached]
        seen[live[:, None], np.where(fresh, reached, nodes[live, pick][:, None])] = True
        d = distances(points, np.where(fresh, reached, 0), to[live])
        d[~fresh] = np.inf
        all_nodes = np.concatenate([nodes[live], reached], axis=1)
        all_far = np.concatenate([far[live], d], axis=1)
        all_expanded = np.concatenate([expanded[live], ~fresh], axis=1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        nodes[live] = np.take_along_axis(all_nodes, best, 1)
        far[live] = np.take_along_axis(all_far, best, 1)
        expanded[live] = np.take_along_axis(all_expanded, best, 1) | ~np.isfinite(far[live])
    order = far.argsort(axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(far, order, 1)


def robust_prune(points: np.ndarray, owners: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Edges of ``owners`` from their candidate pools (n, m), -1 where there is none.

    The nearest candidate is kept, and every other that is nearer to it, relaxed by ``alpha``, than
    to the owner is dropped; then the next nearest that is left, so the kept edges are diverse.
    """
    n = len(owners)
    pool = np.sort(pool, axis=1)
    valid = (pool >= 0) & (pool != owners[:, None])
    valid[:, 1:] &= pool[:, 1:] != pool[:, :-1]
    near = distances(points, np.where(valid, pool, 0), points[owners])
    near[~valid] = np.inf
    out = np.full((n, degree), -1, np.int32)
    vectors = points[np.where(valid, pool, 0)]
    rows = np.arange(n)
    for k in range(degree):
        pick = near.argmin(axis=1)
        open_ = np.isfinite(near[rows, pick])
        if not open_.any():
            break
        out[open_, k] = pool[rows, pick][open_]
        difference = vectors - vectors[rows, pick][:, None, :]
        between = np.einsum("nmd,nmd->nm", difference, difference)
        near[(alpha * alpha * between <= near) & open_[:, None]] = np.inf
        near[rows, pick] = np.inf
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 1):
    """Edges (n, degree) and the entry node, the one nearest to the mean.

    From random edges, two passes over all nodes: a search for each node proposes its neighbours,
    pruning keeps some, and each kept neighbour gets an edge back, pruned again when it has too
    many. The first pass prunes strictly, the second as relaxed as ``alpha`` says.
    """
    n, draw = len(points), np.random.default_rng(seed)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    if n <= degree + 1:
        everyone = np.tile(np.arange(n, dtype=np.int32), (n, 1))
        everyone[np.arange(n), np.arange(n)] = -1
        return np.concatenate([everyone, np.full((n, degree + 1 - n), -1, np.int32)], axis=1), entry
    edges = draw.integers(0, n, (n, degree), dtype=np.int32)
    for strictness in (1.0, alpha):
        order = draw.permutation(n)
        for start in range(0, n, BATCH):
            own = order[start : start + BATCH]
            found, _ = beam_search(points, edges, entry, points[own], beam)
            edges[own] = robust_prune(points, own, np.concatenate([found, edges[own]], axis=1), degree, strictness)
            # edges back, gathered by the node that gets them
            at, source = edges[own].ravel(), np.repeat(own, degree)
            at, source = at[at >= 0], source[at >= 0]
            by = at.argsort(kind="stable")
            at, source = at[by], source[by]
            targets, first, count = np.unique(at, return_index=True, return_counts=True)
            slot = np.arange(len(at)) - np.repeat(first, count)
            back = np.full((len(targets), int(count.max())), -1, np.int32)
            back[np.repeat(np.arange(len(targets)), count), slot] = source
            for part in range(0, len(targets), BATCH):
                to = targets[part : part + BATCH]
                pool = np.concatenate([edges[to], back[part : part + BATCH]], axis=1)
                edges[to] = robust_prune(points, to, pool, degree, strictness)
    return edges, entry


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part, as doubles.

    Left out are null ids and vectors that are null, empty, all zero, or hold a null, a NaN or an infinity.
    """
    parts = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine & F.exists("embedding", lambda x: x != 0)
    )


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in values])


GRAPH = "size int, vectors binary, ids array<array<long>>, edges binary, entry int"


def build_shard(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """A shard's graph as a row: its vectors, the ids of each, edges and the entry."""
    group = group.sort_values("__key")
    vectors = _matrix(group["embedding"])
    edges, entry = build_graph(vectors.astype(np.float32))
    row = (vectors.shape[1], vectors.tobytes(), [list(i) for i in group["ids"]], edges.tobytes(), entry)
    return pd.DataFrame([row], columns=["size", "vectors", "ids", "edges", "entry"])


def search_graph(row: dict, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of a shard for each query, by the graph, then by exact distances."""
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["size"])
    edges = np.frombuffer(row["edges"], np.int32).reshape(len(vectors), -1)
    points, ids = vectors.astype(np.float32), row["ids"]
    wide = _matrix(queries["embedding"])
    out = []
    for start in range(0, len(wide), BATCH):
        block = wide[start : start + BATCH]
        found, _ = beam_search(points, edges, row["entry"], block.astype(np.float32), min(QUERY_BEAM, len(points)))
        for q, nodes in enumerate(found):
            nodes = nodes[nodes >= 0]
            exact = np.sqrt(((vectors[nodes] - block[q]) ** 2).sum(axis=1))
            own = int(queries["query_id"].iloc[start + q])
            rows = [(d, i) for d, node in zip(exact, nodes) for i in ids[node] if i != own]
            out += [(own, i, d) for d, i in sorted(rows)[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _search_all(shared, k: int):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = shared.value
        lengths = queries["embedding"].map(len)
        for frame in frames:
            for row in frame.to_dict("records"):
                own = queries[lengths == row["size"]]
                if len(own):
                    yield search_graph(row, own, k)

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nearest ``vectors`` of each query: query_id, rank (from 1), vec_id, score (distance).

    Both tables have vec_id and embedding. The distance is Euclidean, taken in double precision on
    the given components; ties go to the smaller vec_id; a row never is its own neighbour, nor is
    any row with the query's vec_id. ``usable`` says which rows take part. Vectors are neighbours of
    vectors of the same length only. Rows that repeat a vec_id with the same vector count once; a
    query_id with several vectors gets the nearest of all of them. Fewer candidates than ``k`` give
    fewer rows; no queries or no vectors give none.

    Equal vectors are one node that keeps its k + 1 smallest ids, all that any query can return, so
    a vector that most rows hold is no larger than others. Distinct vectors are dealt to shards by
    hash; each shard's graph is built once, in one task, and staged. Every shard then answers the queries, of which
    ``QUERY_BLOCK`` are sent to the tasks at a time, and the shards' answers are merged.
    """
    rows = usable(vectors).withColumn("__key", F.sha1(F.to_json("embedding").cast("binary")))
    order = Window.partitionBy("__key").orderBy("vec_id")
    kept = rows.dropDuplicates(["__key", "vec_id"]).withColumn("__k", F.row_number().over(order)).where(F.col("__k") <= k + 1)
    nodes = kept.groupBy("__key").agg(
        F.first("embedding").alias("embedding"), F.array_sort(F.collect_list("vec_id")).alias("ids")
    )
    nodes = stage(nodes, "ann-nodes")
    shards = max(1, -(-nodes.count() // SHARD_ROWS))
    # vectors of different lengths never share a graph
    nodes = nodes.withColumn("__size", F.size("embedding")).withColumn(
        "__shard", F.pmod(F.xxhash64("__key"), F.lit(shards))
    )
    graphs = stage(nodes.groupBy("__shard", "__size").applyInPandas(build_shard, GRAPH), "ann-graphs")
    asked = usable(queries).select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    asked = stage(asked, "ann-queries")
    answers = None
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    for part in range(parts):
        block = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == part).toPandas()
        shared = vectors.sparkSession.sparkContext.broadcast(block)
        found = graphs.mapInPandas(_search_all(shared, k), "query_id long, vec_id long, score double")
        answers = found if answers is None else answers.unionByName(found)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
