"""N-gram Jaccard join: rare shingles name candidates, an R-tree of group counts bounds their overlap.

Distinct shingle sets are the nodes; equal sets are one. All sets are put in one order, shingles of
many sets last. For routing a set takes the first of that order, more than it can lack of a set it is
linked with, so two linked sets have one of those in common (prefix filter), while sets that only
share a passage of many texts don't meet. Sets that share one are brought together, with counts of
groups of hashed shingles as points. The sum of coordinate minima bounds the overlap of two sets; those
it allows are tied into clusters. In a cluster the counts of ``DIMENSIONS`` groups are points of an
R-tree, where the sum also bounds a set's overlap with everything below a node, and pairs that
survive are verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longhouse.llm.common import lookup
from longhouse.llm.components import components, local_labels
from longhouse.llm.ngramlm import _Numbers, pack, unpack
from longhouse.session import stage

#: Words of a shingle, and the similarity of a link in hundredths.
WORDS, SIMILAR = 3, 90
#: Coordinates of a point of the R-tree, and entries of a node.
DIMENSIONS, FANOUT = 256, 32
#: Least and most coordinates of the points that go with signatures: about as many as the sets of a level have
#: elements, as the minima of fuller groups bound little. The longest run that is looked at in pairs.
COORDINATES, SHORT_RUN = (256, 4096), 16
#: Bits of the buckets in which shingles of several texts are counted. Counts only make the order in which sets
#: take their shingles: any order finds all links, one with frequent shingles last lets fewer sets meet.
BUCKET_BITS = 20
#: Texts are cut into chunks of about so many bytes.
CHUNK = 4_000_000
#: Signatures for each shard on average, and sets for a task at most.
SHARD_SIGNATURES = 700_000
TASK_SETS = 2000
#: Sets that a large cluster compares all others with first.
PIVOTS = 4

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of texts as 64-bit hashes, sorted in each text, and the sizes of the sets.

    Words are runs of anything but ASCII blanks, A-Z in lower case. A text with fewer words than a
    shingle has one shingle, all of it; without words it has none.
    """
    numbers, parts, lengths = _Numbers(), [], []
    for text in texts:
        tokens = (text or "").encode("utf-8", "replace").lower().split()
        lengths.append(len(tokens))
        parts.append(np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)))
    tokens = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    lengths = np.array(lengths, np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))[tokens]
    stop = np.cumsum(lengths)
    left = np.repeat(stop, lengths) - np.arange(len(tokens))
    at_start = np.zeros(len(tokens), bool)
    at_start[(stop - lengths)[lengths > 0]] = True
    short = np.repeat((lengths < words) & (lengths > 0), lengths) & at_start
    code = np.zeros(len(tokens), np.uint64)
    for k in range(words):
        here = left > k
        following = np.zeros(len(tokens), np.uint64)
        following[: len(tokens) - k] = hashes[k:]
        code = np.where(here, mix(code * np.uint64(3) + following + np.uint64(k + 1)), code)
    # a short text's only shingle is told from longer ones by its length
    code = np.where(short, mix(code ^ np.repeat(lengths, lengths).astype(np.uint64)), code)
    keep = (left >= words) | short
    owner = np.repeat(np.arange(len(lengths)), lengths)[keep]
    code = code[keep]
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])
    return code[new], np.bincount(owner[new], minlength=len(lengths))


def prints(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each set; as a signed number, so that Spark holds it as a long."""
    ends = np.cumsum(sizes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes + np.uint64(11)), dtype=np.uint64)])
    return mix((total[ends] - total[ends - sizes]) ^ sizes.astype(np.uint64)).view(np.int64)


def step(similar: int) -> float:
    """Width of a size level on the logarithm, a touch over that of linked sets."""
    return math.log(100 / similar) * (1 + 1e-9)


def levels_of(sizes: np.ndarray, similar: int) -> np.ndarray:
    """Size level: linked sets lie in one level or in two that adjoin."""
    return np.floor(np.log(np.maximum(sizes, 1)) / step(similar)).astype(np.int64)


def prefix(sizes: np.ndarray, similar: int) -> np.ndarray:
    """Shingles by which a set is routed: one more than it can have that a set it is linked with has not.

    Linked sets have at least ``similar`` hundredths of either's size in common.
    """
    return sizes * (100 - similar) // 100 + 1


def bucket(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def coordinates_at(level: np.ndarray, similar: int) -> np.ndarray:
    """Coordinates of the points of a level: a power of two about the size of its sets."""
    size = np.exp((level + 1) * step(similar))
    return np.clip(2 ** np.ceil(np.log2(size)).astype(np.int64), *COORDINATES)


def signatures(
    codes: np.ndarray, sizes: np.ndarray, similar: int, rank: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, set number, level) of the shingles that route each set, at its level and the next.

    ``rank`` has a number for each bucket, higher ones for those of more frequent shingles.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((codes, rank[bucket(codes)], owner))
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = order[place < prefix(sizes, similar)[owner]]
    codes, owner = codes[order], owner[order]
    own_level = levels_of(sizes, similar)[owner]
    level = np.concatenate([own_level, own_level + 1])
    return mix(np.tile(codes, 2) ^ mix(level.astype(np.uint64))), np.tile(owner, 2), level


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids, texts) of about ``CHUNK`` bytes."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(tuple(i.values()) if isinstance(i, dict) else i)
            texts.append(text)
            size += len(text or "") + 64
            if size >= CHUNK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _arrow(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], [n for n, _ in schema])


SETS = "doc_id long, text_hash long, n long, print long, buckets array<int>, counts array<int>"


def _keyed(docs: DataFrame) -> DataFrame:
    """A row is told by its id and the hash of its text, as ids may repeat or be null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def document_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Key, size and fingerprint of each document's set; the fingerprint of an empty set is null.

    Each chunk of texts adds a row with nothing but ``buckets`` and ``counts``: the shingles that
    several of its sets have, by bucket, and in how many sets they are.
    """
    schema = [(c, pa.int64()) for c in ("doc_id", "text_hash", "n", "print")]
    schema += [(c, pa.list_(pa.int32())) for c in ("buckets", "counts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for ids, texts in _chunks(batches):
                codes, sizes = shingle_sets(texts, words)
                marks = prints(codes, sizes)
                # equal sets count once
                first = np.zeros(len(sizes), bool)
                first[np.unique(marks, return_index=True)[1]] = True
                shingles, sets = np.unique(codes[np.repeat(first, sizes)], return_counts=True)
                shared = [x[sets > 1].astype(np.int32) for x in (bucket(shingles), sets)]
                marks = [p if n else None for p, n in zip(marks.tolist(), sizes)]
                none = [None] * len(ids)
                yield _arrow(schema, [[i for i, _ in ids], [h for _, h in ids], sizes, marks, none, none])
                yield _arrow(schema, [[None]] * 4 + [[x] for x in shared])

    return _keyed(docs).select(F.struct("doc_id", "text_hash").alias("id"), "text").mapInArrow(run, SETS)


def reaches(points: np.ndarray, i: np.ndarray, j: np.ndarray, similar: int) -> np.ndarray:
    """Whether the summed minima of the points numbered ``i`` and ``j`` allow a link of their sets."""
    out = np.zeros(len(i), bool)
    part = max(1, (1 << 22) // points.shape[1])
    for k in range(0, len(i), part):
        a, b = points[i[k : k + part]], points[j[k : k + part]]
        overlap = np.minimum(a, b).sum(axis=1, dtype=np.int64)
        both = a.sum(axis=1, dtype=np.int64) + b.sum(axis=1, dtype=np.int64)
        out[k : k + part] = overlap * (100 + similar) >= similar * both
    return out


def tied(starts: np.ndarray, lengths: np.ndarray, member: np.ndarray, points: np.ndarray, similar: int) -> np.ndarray:
    """Labels that join all sets which stand in one run and whose points allow a link.

    Runs are slices of ``member``. Short runs are looked at pair by pair, all at once. In a long one
    a set meets only those that aren't yet of its label, so near copies are joined by the first.
    """
    n, left, right = len(points), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for length in range(2, SHORT_RUN + 1):
        at = starts[lengths == length]
        i, j = np.triu_indices(length, 1)
        left.append(member[at[:, None] + i].ravel())
        right.append(member[at[:, None] + j].ravel())
    pairs = np.unique(np.concatenate(left) * n + np.concatenate(right))
    i, j = pairs // n, pairs % n
    near = reaches(points, i, j, similar)
    i, j = [i[near]], [j[near]]
    label, seen = local_labels(i[0], j[0], n), set()
    for start, length in zip(starts[lengths > SHORT_RUN].tolist(), lengths[lengths > SHORT_RUN].tolist()):
        run = member[start : start + length]
        own = label[run]
        key = hash(run.tobytes())
        if key in seen or (own == own[0]).all():
            continue
        seen.add(key)
        before = len(i)
        for k in range(length):
            if (own == own[k]).all():
                break
            # earlier ones have met this one in their turn
            others = k + 1 + np.flatnonzero(own[k + 1 :] != own[k])
            hit = others[reaches(points, np.full(len(others), run[k]), run[others], similar)]
            if len(hit):
                i.append(np.full(len(hit), run[k]))
                j.append(run[hit])
                own[np.isin(own, own[hit])] = own[k]
        if len(i) > before:
            label = local_labels(np.concatenate(i), np.concatenate(j), n)
    return label


MESSAGE = "shard int, sigs binary, owners binary, prints binary, points binary"


def level_shards(found: DataFrame, similar: int) -> np.ndarray:
    """Shards of each size level, as many as its signatures ask; there are some dozens of levels."""
    level = F.floor(F.ln(F.col("n").cast("double")) / step(similar))
    sent = F.sum(F.floor(F.col("n") * (100 - similar) / 100) + 1)
    counts = {int(r.level): r.n for r in found.where("n > 0").groupBy(level.alias("level")).agg(sent.alias("n")).collect()}
    levels = range(max(counts, default=0) + 3)
    return np.array([(counts.get(k, 0) + counts.get(k - 1, 0)) // SHARD_SIGNATURES + 1 for k in levels])


def bucket_ranks(shared: DataFrame) -> np.ndarray:
    """Binary orders of magnitude of the counts of all buckets, a byte each."""
    one = shared.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x")).select("x.*")
    sums = one.groupBy("buckets").agg(F.floor(F.log2(F.sum("counts"))).cast("byte").alias("rank")).toArrow()
    rank = np.zeros(1 << BUCKET_BITS, np.uint8)
    rank[sums["buckets"].to_numpy()] = sums["rank"].to_numpy()
    return rank


def _counted(codes: np.ndarray, holder: np.ndarray, member: np.ndarray, row: np.ndarray, dims: int) -> np.ndarray:
    """How many elements of each member set fall into each of ``dims`` groups, in the fewest bytes."""
    own = member[holder]
    group = ((codes[own] >> np.uint64(40)) % np.uint64(dims)).astype(np.int64)
    n = int(member.sum())
    counts = np.bincount(row[holder[own]] * dims + group, minlength=n * dims).reshape(n, dims)
    most = int(counts.max(initial=0))
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def candidate_edges(docs: DataFrame, shards: np.ndarray, rank: np.ndarray, words: int, similar: int) -> DataFrame:
    """Edges (a, b) that tie together sets which share a signature and whose counts allow a link.

    Chunks send sorted signatures, each set once, to a shard of their level, and with them the counts
    of its groups, as many as the level's sets have elements, once for each shard. A shard sends a spanning forest of the sets it ties,
    not their pairs. Half of a signature's bits do: those that are equal by chance are not tied, as
    their counts tell.
    """
    first_shard = np.cumsum(shards) - shards
    dims = coordinates_at(np.arange(len(shards)), similar)
    schema = [("shard", pa.int32())] + [(c, pa.binary()) for c in ("sigs", "owners", "prints", "points")]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for _, texts in _chunks(batches):
                codes, sizes = shingle_sets(texts, words)
                marks = prints(codes, sizes)
                holder = np.repeat(np.arange(len(sizes)), sizes)
                sig, owner, level = signatures(codes, sizes, similar, rank)
                _, first, back = np.unique(marks, return_index=True, return_inverse=True)
                once = first[back[owner]] == owner
                sig, owner, level = sig[once], owner[once], np.minimum(level[once], len(shards) - 1)
                points = {}  # of the sets of each level, and the row of each set
                for own_level in np.unique(level).tolist():
                    member = np.zeros(len(sizes), bool)
                    member[owner[level == own_level]] = True
                    row = np.cumsum(member) - 1
                    points[own_level] = row, _counted(codes, holder, member, row, int(dims[own_level]))
                shard = first_shard[level] + (sig % shards[level].astype(np.uint64)).astype(np.int64)
                sig = (sig >> np.uint64(32)).astype(np.uint32)
                order = np.lexsort((sig, shard))
                sig, owner, shard = sig[order], owner[order], shard[order]
                starts = np.flatnonzero(np.diff(shard, prepend=-1))
                stops = np.concatenate([starts[1:], [len(shard)]])
                rows = []
                for a, b in zip(starts, stops):
                    own, place = np.unique(owner[a:b], return_inverse=True)
                    row, counts = points[int(np.searchsorted(first_shard, shard[a], "right")) - 1]
                    counts = pack(np.ascontiguousarray(counts[row[own]].T).ravel())
                    rows.append((int(shard[a]), pack(sig[a:b]), pack(place.astype(np.uint32)), pack(marks[own]), counts))
                yield _arrow(schema, list(zip(*rows)) or [[]] * 5)

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sigs, owners, marks, points, base = [], [], [], [], 0
        wide = int(dims[np.searchsorted(first_shard, key[0], "right") - 1])
        for s, o, m, c in zip(frame["sigs"], frame["owners"], frame["prints"], frame["points"]):
            sigs.append(unpack(s))
            owners.append(unpack(o).astype(np.int64) + base)
            marks.append(unpack(m))
            points.append(unpack(c).reshape(wide, -1).T)
            base += len(marks[-1])
        nodes, first, number = np.unique(np.concatenate(marks), return_index=True, return_inverse=True)
        points = np.concatenate(points)[first]
        sig, member = np.concatenate(sigs), number[np.concatenate(owners)]
        order = np.lexsort((member, sig))
        sig, member = sig[order], member[order]
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (member[1:] != member[:-1])
        sig, member = sig[fresh], member[fresh]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        lengths = np.diff(np.concatenate([starts, [len(sig)]]))
        label = tied(starts[lengths > 1], lengths[lengths > 1], member, points, similar)
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[moved], "b": nodes[label[moved]]})

    sent = docs.select("doc_id", "text").mapInArrow(send, MESSAGE)
    return sent.groupBy("shard").applyInPandas(meet, "a long, b long")


class Tree:
    """An R-tree of count vectors, packed bottom-up in the order of size and coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # the order goes by sums over some of the coordinates
        coarse = points[:, :64].reshape(len(points), 4, 16).sum(axis=2, dtype=np.int64) // 4
        self.order = np.lexsort((*coarse.T[::-1], sizes))
        self.layers = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.layers[-1][0]) > FANOUT:
            top, low, high = self.layers[-1]
            at = np.arange(0, len(top), FANOUT)
            self.layers.append(
                (np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at))
            )

    def search(self, points: np.ndarray, sizes: np.ndarray, similar: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs whose summed minima reach the overlap that a link needs."""
        query = np.repeat(np.arange(len(points)), len(self.layers[-1][0]))
        node = np.tile(np.arange(len(self.layers[-1][0])), len(points))
        for depth in range(len(self.layers) - 1, -1, -1):
            top, low, high = self.layers[depth]
            n = sizes[query]
            fits = (100 * low[node] * similar <= 10_000 * n) & (n * similar <= 100 * high[node])
            query, node = query[fits], node[fits]
            # in parts, as the minima take a vector for each pair
            reach = np.zeros(len(query), np.int64)
            for k in range(0, len(query), 16_384):
                part = slice(k, k + 16_384)
                reach[part] = np.minimum(points[query[part]], top[node[part]]).sum(axis=1, dtype=np.int64)
            fits = reach * (100 + similar) >= similar * (sizes[query] + low[node])
            query, node = query[fits], node[fits]
            if depth:
                below = len(self.layers[depth - 1][0])
                child = (node[:, None] * FANOUT + np.arange(FANOUT)[None, :]).ravel()
                query = np.repeat(query, FANOUT)[child < below]
                node = child[child < below]
        return query, self.order[node]


def count_vectors(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements of each set fall into each of ``DIMENSIONS`` groups."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    group = (np.concatenate(sets) >> np.uint64(40)) % np.uint64(DIMENSIONS) if len(sets) else np.zeros(0, np.uint64)
    flat = np.bincount(owner * DIMENSIONS + group.astype(np.int64), minlength=len(sets) * DIMENSIONS)
    return flat.reshape(-1, DIMENSIONS).astype(np.uint16 if flat.max(initial=0) < 1 << 16 else np.uint32)


def linked_pairs(
    sets: list[np.ndarray], asked: np.ndarray, label: np.ndarray, similar: int
) -> list[tuple[int, int]]:
    """Links that join the sets numbered ``asked`` with all ``sets``: a spanning forest of them.

    ``label`` says which are known to be of one component; it is brought up to date. A pair within
    one is not verified, so a cluster of near copies takes one verification for each member.
    """
    points, sizes = count_vectors(sets), np.array([len(s) for s in sets], np.int64)
    tree, out = Tree(points, sizes), []
    parent = {int(x): int(x) for x in np.unique(label)}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for k in range(0, len(asked), 256):
        part = asked[k : k + 256]
        query, found = tree.search(points[part], sizes[part], similar)
        for i, j in zip(part[query].tolist(), found.tolist()):
            a, b = root(int(label[i])), root(int(label[j]))
            if a == b:
                continue
            overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if overlap * (100 + similar) >= similar * (len(sets[i]) + len(sets[j])):
                parent[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


MEMBER = "cluster long, print long, parts int, elements binary"


def member_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """The elements of each member's set: ``members`` has print, cluster, parts and the key of one document."""
    schema = [("cluster", pa.int64()), ("print", pa.int64()), ("parts", pa.int32()), ("elements", pa.binary())]
    own = _keyed(docs)
    same = own["doc_id"].eqNullSafe(members["doc_id"]) & (own["text_hash"] == members["text_hash"])
    texts = own.join(members, same).select(F.struct("cluster", "print", "parts").alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for ids, part in _chunks(batches):
                codes, sizes = shingle_sets(part, words)
                ends = np.cumsum(sizes)
                sets = [codes[e - n : e].tobytes() for e, n in zip(ends, sizes)]
                yield _arrow(schema, [*map(list, zip(*ids)), sets])

    # rows that repeat in all give the same set again
    return stage(texts.mapInArrow(run, MEMBER).dropDuplicates(["print"]), "join-members")


EDGE = "a long, b long"


def _compare(similar: int):
    """Links among the sets of one task, as edges from each set to one of its component.

    A row asks others of its cluster if ``asks``. The first row that asks and leads its cluster
    (``lead``), or else the smallest print, stands for the component.
    """

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out_a, out_b = [], []
        for _, rows in frame.groupby("cluster", sort=False):
            rows = rows.sort_values(["lead", "asks", "print"], ascending=[False, False, True]).drop_duplicates("print")
            if len(rows) < 2:
                continue
            sets = [np.frombuffer(e, np.uint64) for e in rows["elements"]]
            marks = rows["print"].to_numpy()
            label = np.unique(rows["label"].to_numpy(), return_inverse=True)[1]
            links = linked_pairs(sets, np.flatnonzero(rows["asks"].to_numpy()), label, similar)
            if links:
                i, j = np.array(links).T
                to = local_labels(i, j, len(sets))
                moved = np.flatnonzero(to != np.arange(len(sets)))
                out_a.append(marks[moved])
                out_b.append(marks[to[moved]])
        none = [np.zeros(0, np.int64)]
        return pd.DataFrame({"a": np.concatenate(out_a or none), "b": np.concatenate(out_b or none)})

    return run


def link_edges(members: DataFrame, similar: int) -> DataFrame:
    """Links between the sets of each cluster, as many as make its components.

    A cluster of up to ``TASK_SETS`` sets is one of many in a task. A larger one is dealt into parts,
    and each part is joined in itself and with a few pivots that all parts have; near copies of one
    text hang on the first pivot after that. What doesn't then meets all parts, in blocks.
    """
    columns = ["cluster", "print", "elements"]
    part = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    small, large = members.where("parts = 1"), members.where("parts > 1").withColumn("part", part)
    own = [F.lit(True).alias("asks"), F.col("print").alias("label")]
    # small clusters share a task by their hash
    bins = F.lit(members.count() // TASK_SETS + 1)
    task = F.concat(F.lit("s"), F.pmod(F.xxhash64("cluster"), bins).cast("string"))
    first = small.select(*columns, task.alias("task"), F.lit(False).alias("lead"), *own)
    any_large = not large.isEmpty()
    if any_large:
        rank = Window.partitionBy("cluster").orderBy(F.xxhash64("print"), "print")
        keys = large.select("cluster", "print", "parts").withColumn("k", F.row_number().over(rank))
        pivots = stage(keys.where(F.col("k") <= PIVOTS), "join-pivots")
        everywhere = large.join(pivots.select("print", "k"), "print").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        )
        alone = large.join(pivots.select("print"), "print", "left_anti").withColumn("k", F.lit(0))
        to_part = F.concat_ws(":", F.lit("l"), F.col("cluster").cast("string"), F.col("part").cast("string"))
        dealt = alone.select(*columns, "part", "k").unionByName(everywhere.select(*columns, "part", "k"))
        first = first.unionByName(dealt.select(*columns, to_part.alias("task"), (F.col("k") == 1).alias("lead"), *own))
    edges = stage(first.groupBy("task").applyInPandas(_compare(similar), EDGE), "join-links")
    if not any_large:
        return edges
    # a set that isn't a pivot was in one task and has one edge at most there
    lead = pivots.where("k = 1").select("cluster", F.col("print").alias("main"))
    label = edges.groupBy(F.col("a").alias("print")).agg(F.min("b").alias("to"))
    named = large.select("cluster", "print", "parts", "part").join(label, "print", "left")
    named = lookup(named, lead, "cluster", F.col("print")).withColumn("label", F.coalesce("to", "print"))
    named = stage(named.select("cluster", "print", "parts", "part", "label", "main"), "join-labels")
    others = named.where("label <> main").groupBy("cluster").agg(F.count(F.lit(1)).alias("others"))
    named = lookup(named, others, "cluster", F.col("print")).where("others IS NOT NULL")
    blocks = F.ceil(F.col("others") / TASK_SETS).cast("int")
    rest = named.where("label <> main").withColumn("block", F.pmod(F.xxhash64("print"), blocks).cast("int"))
    rest = rest.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    every = named.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    keys = ["cluster", "print", "label", "block", "part"]
    meet = rest.select(*keys, F.lit(True).alias("asks")).unionByName(every.select(*keys, F.lit(False).alias("asks")))
    meet = meet.withColumn("lead", F.lit(False)).join(large.select("print", "elements"), "print")
    more = meet.groupBy("cluster", "block", "part").applyInPandas(_compare(similar), EDGE)
    return edges.unionByName(stage(more, "join-links"))


def _linked(docs: DataFrame, words: int, similar: int) -> DataFrame:
    """Key and set size of each row, and the key of its component's first document, ``lead``.

    The first one has the smallest doc_id, then the smallest text hash; null ids come last.
    """
    read = stage(document_sets(docs, words), "join-sets")
    found = read.where("buckets IS NULL").drop("buckets", "counts")
    rank = bucket_ranks(read.where("buckets IS NOT NULL"))
    near = components(candidate_edges(docs, level_shards(found, similar), rank, words, similar))
    lead = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = found.where("print IS NOT NULL").groupBy("print").agg(F.min(lead).alias("lead"))
    members = distinct.join(near.select(F.col("node").alias("print"), F.col("label").alias("cluster")), "print")
    members = stage(members.select("print", "cluster", "lead.doc_id", "lead.text_hash"), "join-keys")
    parts = F.ceil(F.count(F.lit(1)) / TASK_SETS).cast("int").alias("parts")
    members = lookup(members, members.groupBy("cluster").agg(parts), "cluster", F.col("print"))
    links = components(link_edges(member_sets(docs, members, words), similar))
    labels = distinct.join(links.select(F.col("node").alias("print"), "label"), "print", "left")
    labels = stage(labels.withColumn("label", F.coalesce("label", "print")), "join-labels")
    lowest = labels.groupBy("label").agg(F.min("lead").alias("lead"))
    by_print = lookup(labels.select("print", "label"), lowest, "label", F.col("print")).select("print", "lead")
    return lookup(found, by_print, "print", F.xxhash64("doc_id", "text_hash"))


def jaccard_components(docs: DataFrame, words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """Components of documents whose shingle sets are linked: doc_id, n_shingles, component_id.

    Two documents link when 100 * intersection >= ``similar`` * union of their sets of distinct
    ``words``-word shingles. A document with fewer words has its whole sequence as one shingle; null
    texts and texts without words have an empty set, link with nothing, and are their own component.
    component_id is the smallest doc_id that can be reached, itself included; a null doc_id is never
    the smallest, and is what a component of none but null ids gets. There is a row for each input
    row, repeated ones too. The result is exact but for collisions of 64-bit hashes.
    """
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("lead.doc_id"))
    return _linked(docs, words, similar).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def keep_one(docs: DataFrame, words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """``docs`` with one row of each component: its document with the smallest doc_id.

    Texts without words have no component and stay. Null ids come last; of equal or null ids the
    smallest text hash stays, and of rows that share id and text one, whatever their other columns.
    """
    first = _linked(docs, words, similar).where(
        (F.col("n") > 0)
        & F.col("doc_id").eqNullSafe(F.col("lead.doc_id"))
        & (F.col("text_hash") == F.col("lead.text_hash"))
    )
    first = first.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    rows = docs.withColumn("__text", F.xxhash64("text"))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    others = [F.xxhash64(*[c for c in docs.columns if c not in ("doc_id", "text")])] if len(docs.columns) > 2 else []
    one = Window.partitionBy("__id", "__hash").orderBy("__id", *others)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    kept = rows.join(first, same).withColumn("__k", F.row_number().over(one)).where("__k = 1")
    return kept.select(*docs.columns).unionByName(docs.where(wordless))
