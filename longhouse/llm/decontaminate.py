"""Benchmark passages in documents: q-gram counts in diagonal bands, then banded alignment.

Three things are found: whole regions of an item within an edit budget; passages of an item of at
least ``PASSAGE`` characters wherever they begin and end; and items shorter than ``MIN_ITEM`` as
they are, on word boundaries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Length of the q-grams, in characters of the normalised text.
Q = 10
#: A region of the benchmark has at most this length; longer items are cut into regions that overlap
#: by half, the last one ending with the item.
REGION = 96
#: The edit budget of a region, as a share of its length.
EDITS = 0.08
#: Items shorter than this, normalised, are matched exactly, as whole words.
MIN_ITEM = 32
#: The shortest passage of an item that must be found, wherever in the item it begins. It may have
#: ``EDITS`` of its length in edits, and must hold a seed within the seed's own budget.
PASSAGE = 50
#: Seeds are regions of this length at this stride: two lie whole in every passage.
SEED, STRIDE = 24, 12
#: A passage of at least ``LONG`` characters may have this share of edits: words replaced here and there.
LONG, LONG_EDITS = 96, 0.16
#: Items are cut into sections that overlap by half; a passage is followed within its section.
SECTION = 384
#: So far a passage may wander from the diagonal of its seed.
DRIFT = 16
#: So many sections make one block.
BLOCK_SECTIONS = 4_000
#: Diagonal bands start every so many diagonals and reach over the next one by the edit budget.
BAND = 16
#: So many regions make one block; the index of a block is what a task holds of the benchmark.
BLOCK_REGIONS = 20_000
#: Documents are read in chunks of about so many characters.
CHUNK = 2_000_000

_PRIME = 0x9E3779B97F4A7C15
_BITS = 22


def normalise(text: str) -> str:
    """Lower case, and every run of white space one blank."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    """Code points."""
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def budget(length: int) -> int:
    """Edits allowed in a region: its share, as far as the q-gram lemma still asks for a shared gram."""
    return max(0, min(int(EDITS * length), (length - Q) // Q))


def threshold(length: int) -> int:
    """q-gram lemma: within e edits, length + 1 - Q (e + 1) of the region's grams are kept."""
    return max(1, length + 1 - Q * (budget(length) + 1))


def grams(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each q-gram of code points."""
    if len(points) < Q:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(points) - Q + 1, np.uint64)
    wide = points.astype(np.uint64)
    with np.errstate(over="ignore"):
        for i in range(Q):
            out *= np.uint64(_PRIME)
            out += wide[i : len(wide) - Q + 1 + i]
        out *= np.uint64(_PRIME)
    return out ^ (out >> np.uint64(29))


def regions_of(text: str) -> list[tuple[int, str]]:
    """(start, region) of a normalised item."""
    if len(text) < MIN_ITEM:
        return []
    last = max(0, len(text) - REGION)
    starts = list(range(0, last, REGION // 2)) + [last]
    return [(s, text[s : s + REGION]) for s in starts]


def sections_of(text: str) -> list[tuple[int, str]]:
    """(start, section) of a normalised item, those shorter than ``MIN_ITEM`` whole."""
    if not text or MIN_ITEM <= len(text) < PASSAGE:
        return []
    last = max(0, len(text) - SECTION)
    starts = list(range(0, last, SECTION // 2)) + [last]
    return [(s, text[s : s + SECTION]) for s in starts]


def region_table(benchmark: DataFrame, of: Callable[[str], list[tuple[int, str]]] = regions_of) -> DataFrame:
    """A row for each region (or section): item_id, start, region. Null and empty items give none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, parts = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start, part in of(normalise(text or "")):
                    ids.append(item)
                    starts.append(start)
                    parts.append(part)
            arrays = [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(parts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["item_id", "start", "region"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return items.mapInArrow(cut, "item_id long, start int, region string")


@dataclass
class Index:
    """One block of regions with the sorted q-grams of all of them."""

    items: list
    starts: list[int]
    texts: list[str]

    def __post_init__(self):
        self.points = [codes(t) for t in self.texts]
        self.length = np.array([len(p) for p in self.points], np.int64)
        self.edits = np.array([budget(n) for n in self.length], np.int64)
        self.least = np.array([threshold(n) for n in self.length], np.int64)
        each = [grams(p) for p in self.points]
        hashes = np.concatenate(each) if each else np.zeros(0, np.uint64)
        region = np.repeat(np.arange(len(each)), [len(g) for g in each])
        place = np.concatenate([np.arange(len(g)) for g in each]) if each else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.region, self.place = region[order], place[order]
        self.grams, first, count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.first, self.count = first.astype(np.int64), count.astype(np.int64)
        self.present = np.zeros(1 << _BITS, bool)
        self.present[(self.grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """(region, band) pairs whose shared q-grams reach the lemma's number."""
        hashes = grams(points)
        at = np.flatnonzero(self.present[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at):
            return np.zeros((0, 2), np.int64)
        found = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        same = self.grams[found] == hashes[at]
        at, found = at[same], found[same]
        count = self.count[found]
        hit = np.repeat(self.first[found] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(found) else found, count)
        hit = hit + np.arange(len(hit))
        region = self.region[hit]
        # the offset keeps diagonals positive
        diagonal = np.repeat(at, count) - self.place[hit] + REGION
        bands = (len(points) + 2 * REGION) // BAND + 2
        band = diagonal // BAND
        over = (diagonal % BAND < self.edits[region]) & (band > 0)
        key = np.concatenate([region * bands + band, region[over] * bands + band[over] - 1])
        key, shared = np.unique(key, return_counts=True)
        region, band = key // bands, key % bands
        enough = shared >= self.least[region]
        return np.stack([region[enough], band[enough]], axis=1)

    def align(self, points: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Edit distance and end of the best place of each candidate's region in its band.

        The region stands in the rows, the text around the band in the columns, with free ends in the
        text. Between documents stands a gap wider than a band, whose characters never match.
        """
        region, band = candidates[:, 0], candidates[:, 1]
        edits, length = self.edits[region], self.length[region]
        most = int(edits.max())
        # diagonals band * BAND - REGION - e .. band * BAND - REGION + BAND + 2 e
        low = band * BAND - REGION - most
        width = BAND + 3 * most + 1
        column = np.arange(width)
        rows = np.zeros((len(region), int(length.max())), np.uint32)
        for k, r in enumerate(region):
            rows[k, : length[k]] = self.points[r]
        far = np.int32(1 << 20)
        cost = np.zeros((len(region), width), np.int32)
        limit = len(points) - 1
        best = np.full((len(region), 2), far, np.int64)
        for i in range(int(length.max())):
            # cell (i, c) has taken i + 1 characters of the region and ends before text place low + i + 1 + c
            place = low[:, None] + i + column[None, :]
            inside = (place >= 0) & (place <= limit)
            letter = np.where(inside, points[np.clip(place, 0, limit)], np.uint32(0xFFFFFFFF))
            step = cost + (letter != rows[:, i : i + 1])
            up = np.concatenate([cost[:, 1:], np.full((len(region), 1), far, np.int32)], axis=1) + 1
            step = np.minimum(step, up)
            step = (np.minimum.accumulate(step - column, axis=1) + column).astype(np.int32)
            cost = step
            done = length == i + 1
            if done.any():
                best[done, 0] = cost[done].min(axis=1)
                best[done, 1] = low[done] + i + 1 + cost[done].argmin(axis=1)
        return best

    def scan(self, texts: list[str]) -> list[tuple[int, object, int, int, int, int]]:
        """(text number, item, region start, distance, from, to) of each region found within budget.

        ``from`` and ``to`` are places in the normalised text.
        """
        gap = REGION + 2 * BAND + 3 * int(self.edits.max(initial=0))
        parts, starts, size = [], [], gap
        hollow = np.full(gap, 0xFFFFFFFE, np.uint32)
        for text in texts:
            starts.append(size)
            own = codes(text)
            parts += [hollow, own]
            size += len(own) + gap
        points = np.concatenate([*parts, hollow])
        starts = np.array(starts, np.int64)
        found, out = self.candidates(points), []
        if not len(found):
            return out
        for (r, _), (distance, end) in zip(found, self.align(points, found)):
            if distance <= self.edits[r]:
                k = int(np.searchsorted(starts, end - 1, "right")) - 1
                stop = int(end - starts[k])
                start = int(max(0, stop - self.length[r]))
                out.append((k, self.items[r], self.starts[r], int(distance), start, stop))
        return out


def _follow(points: np.ndarray, at: np.ndarray, pattern: np.ndarray, size: np.ndarray, step: int) -> np.ndarray:
    """Least edits of the first 0, 1, ... characters of each pattern, read in the text from ``at``
    forwards (step 1) or backwards (step -1), and where they end: (2, patterns, longest + 1).

    The pattern's beginning is tied to ``at``, its end is free; it stays within ``DRIFT`` diagonals.
    """
    width, far = 2 * DRIFT + 1, np.int32(1 << 20)
    column = np.arange(width)
    cost = np.where(column < DRIFT, far, column - DRIFT)[None, :].repeat(len(at), axis=0).astype(np.int32)
    out = np.zeros((2, len(at), pattern.shape[1] + 1), np.int64)
    limit = len(points) - 1
    for i in range(pattern.shape[1]):
        # cell (i, c) has taken i + 1 characters of the pattern and i + 1 + c - DRIFT of the text
        took = i + column - DRIFT
        place = at[:, None] + step * took - (step < 0)
        inside = (took >= 0) & (place >= 0) & (place <= limit)
        letter = np.where(inside, points[np.clip(place, 0, limit)], np.uint32(0xFFFFFFFF))
        straight = cost + (letter != pattern[:, i : i + 1])
        straight[:, took < 0] = far
        up = np.concatenate([cost[:, 1:], np.full((len(at), 1), far, np.int32)], axis=1) + 1
        up[:, took < -1] = far
        both = np.minimum(straight, up)
        cost = (np.minimum.accumulate(both - column, axis=1) + column).astype(np.int32)
        out[0, :, i + 1] = np.where(i < size, cost.min(axis=1), far)
        out[1, :, i + 1] = at + step * (i + 1 + cost.argmin(axis=1) - DRIFT)
    out[1, :, 0] = at
    return out


@dataclass
class Passages:
    """One block of sections: the index of their seeds, and the short items as they are."""

    items: list
    starts: list[int]
    texts: list[str]

    def __post_init__(self):
        section, place, seeds, short = [], [], [], {}
        for k, text in enumerate(self.texts):
            if len(text) < MIN_ITEM:
                short.setdefault(len(codes(text)), []).append(k)
                continue
            for s in sorted({*range(0, len(text) - SEED + 1, STRIDE), len(text) - SEED}):
                section.append(k)
                place.append(s)
                seeds.append(text[s : s + SEED])
        self.points = [codes(t) for t in self.texts]
        self.section, self.place = np.array(section, np.int64), np.array(place, np.int64)
        self.seeds = Index(list(range(len(seeds))), place, seeds) if seeds else None
        self.short = {}
        for n, sections in short.items():
            of = {}
            for k in sections:
                of.setdefault(_window_hashes(self.points[k], np.zeros(1, np.int64), n)[0], []).append(k)
            self.short[n] = (np.array(sorted(of), np.uint64), of)

    def scan(self, texts: list[str]) -> list[tuple[int, object, int, int, int, int]]:
        """(text number, item, start in the item, distance, from, to) of passages and short items."""
        return [*self._passages(texts), *self._exact(texts)]

    def _passages(self, texts: list[str]) -> Iterator[tuple[int, object, int, int, int, int]]:
        hits = self.seeds.scan(texts) if self.seeds else []
        if not hits:
            return
        text, seed, _, distance, _, stop = np.array(hits, np.int64).T
        section, start = self.section[seed], self.place[seed]
        # neighbours on a diagonal are one run, followed from its best seed
        diagonal = stop - start
        order = np.lexsort((start, diagonal, section, text))
        key = np.stack([text, section, diagonal])[:, order]
        new = (np.diff(key, axis=1, prepend=-1) != 0).any(axis=0)
        new |= np.diff(start[order], prepend=-SEED) > SEED
        run = np.cumsum(new)
        best = np.lexsort((start[order], distance[order], run))
        first = order[best[np.unique(run[best], return_index=True)[1]]]
        points = [codes(t) for t in texts]
        offset = np.cumsum([0] + [len(p) + SECTION for p in points])
        hollow = np.full(SECTION, 0xFFFFFFFE, np.uint32)
        whole = np.concatenate([x for p in points for x in (p, hollow)])
        for part in np.array_split(first, -(-len(first) // 2000)):
            end = start[part] + SEED
            length = np.array([len(self.points[k]) for k in section[part]], np.int64)
            left = np.zeros((len(part), int(end.max())), np.uint32)
            right = np.zeros((len(part), int((length - end).max())), np.uint32)
            for i, k in enumerate(section[part]):
                own = self.points[k]
                left[i, : end[i]] = own[: end[i]][::-1]
                right[i, : length[i] - end[i]] = own[end[i] :]
            at = offset[text[part]] + stop[part]
            back, ahead = _follow(whole, at, left, end, -1), _follow(whole, at, right, length - end, 1)
            for i, j in enumerate(part):
                took = np.arange(SEED, end[i] + 1)[:, None] + np.arange(length[i] - end[i] + 1)[None, :]
                edits = back[0, i, SEED : end[i] + 1, None] + ahead[0, i, None, : length[i] - end[i] + 1]
                fits = (took >= PASSAGE) & (edits <= EDITS * took) | (took >= LONG) & (edits <= LONG_EDITS * took)
                if fits.any():
                    # long, but not led on into other text by edits that are left
                    most = np.where(fits, took - 3 * edits, -SECTION * 4)
                    l, r = np.unravel_index(int(most.argmax()), most.shape)
                    k, here = section[j], offset[text[j]]
                    item_start = int(self.starts[k] + end[i] - SEED - l)
                    from_, to = back[1, i, SEED + l] - here, ahead[1, i, r] - here
                    to = min(int(to), len(points[text[j]]))
                    yield int(text[j]), self.items[k], item_start, int(edits[l, r]), max(0, int(from_)), to

    def _exact(self, texts: list[str]) -> Iterator[tuple[int, object, int, int, int, int]]:
        if not self.short:
            return
        joined = " ".join(texts)
        points = codes(joined)
        starts = np.cumsum([0] + [len(codes(t)) + 1 for t in texts])
        word = np.array([c.isalnum() or c == "_" for c in joined], bool)
        # the places where no word goes on: before the first character, between, and after the last
        edge = np.ones(len(points) + 1, bool)
        edge[1:-1] = ~(word[1:] & word[:-1])
        begins = np.flatnonzero(edge[:-1])
        for n, (known, of) in self.short.items():
            at = begins[begins + n <= len(points)]
            at = at[edge[at + n]]
            if not len(at):
                continue
            hashes = _window_hashes(points, at, n)
            found = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for place, value in zip(at[known[found] == hashes].tolist(), hashes[known[found] == hashes]):
                text = int(np.searchsorted(starts, place, "right")) - 1
                if place + n > starts[text + 1] - 1:
                    continue  # runs into the next text
                for k in of[value]:
                    if (points[place : place + n] == self.points[k]).all():
                        here = int(place - starts[text])
                        yield text, self.items[k], 0, 0, here, here + n


def _window_hashes(points: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the ``n`` code points from each place."""
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = out * np.uint64(_PRIME) + points[at + i].astype(np.uint64) + np.uint64(1)
    return out


def _pieces(table: DataFrame, each: int) -> Iterator[tuple[list, list, list]]:
    n = table.count()
    parts = -(-n // each)
    for k in range(parts):
        own = F.pmod(F.xxhash64("item_id", "start", "region"), F.lit(parts)) == k
        rows = table.where(own).orderBy("item_id", "start", "region").toArrow()
        if rows.num_rows:
            yield tuple(rows.column(i).to_pylist() for i in range(3))


def blocks(benchmark: DataFrame) -> Iterator[tuple]:
    """The benchmark as (regions, sections) of about ``BLOCK_REGIONS`` and ``BLOCK_SECTIONS`` each.

    Both have a bounded length, so what is sent to the tasks at a time is bounded whatever the size
    of the benchmark; all documents are read once for each block. Either may be None.
    """
    regions = _pieces(region_table(benchmark), BLOCK_REGIONS)
    sections = _pieces(region_table(benchmark, sections_of), BLOCK_SECTIONS)
    yield from zip_longest(regions, sections)


def _scanners(shared: tuple) -> list:
    return [kind(*own) for kind, own in zip((Index, Passages), shared) if own]


def _chunks(texts: list) -> Iterator[tuple[int, list[str]]]:
    """(first number, normalised texts) in chunks of about ``CHUNK`` characters."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append(normalise(text or ""))
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


FOUND = "doc_id long, item_id long, start int, distance int, from_char int, to_char int, region boolean"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each doc_id and item_id where the document holds a region, passage or short item.

    A region within its budget is found always, and so is each verbatim passage of ``PASSAGE``
    characters. An edited passage is found if it is within ``EDITS`` (``LONG_EDITS`` from ``LONG``
    characters on) and one of its seeds is within one edit. An item under ``MIN_ITEM`` characters
    is found where it stands as it is, as whole words; a single word, too.

    doc_id, item_id, regions (how many different ones were found whole; 0 if only passages or a
    short item were), distance (the least of a region, passage or item), and from_char and to_char,
    the outer ends of the places found, in the normalised text (lower case, single blanks). Null and
    empty texts hold nothing, null and empty items are found nowhere. Rows that share an id, null too, are reported
    together. Documents aren't moved: each task scans its own rows against a block of the
    benchmark, and only what it finds is grouped.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], FOUND)
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scanners = _scanners(shared.value)
            names = ["doc_id", "item_id", "start", "distance", "from_char", "to_char", "region"]
            kinds = [pa.int64(), pa.int64()] + [pa.int32()] * 4 + [pa.bool_()]
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for first, texts in _chunks(batch.column(1).to_pylist()):
                    hits = [
                        (ids[first + h[0]], *h[1:], isinstance(own, Index)) for own in scanners for h in own.scan(texts)
                    ]
                    columns = list(zip(*hits)) or [[]] * len(names)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        found = found.unionByName(rows.mapInArrow(find, FOUND))
    return found.groupBy("doc_id", "item_id").agg(
        F.countDistinct(F.when(F.col("region"), F.col("start"))).cast("int").alias("regions"),
        F.min("distance").alias("distance"),
        F.min("from_char").alias("from_char"),
        F.max("to_char").alias("to_char"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a region, passage or short item of the benchmark.

    All columns are kept as they are and rows aren't moved. See ``leaks`` for the empty cases.
    """
    at = docs.columns.index("text")
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scanners = _scanners(shared.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for first, texts in _chunks(batch.column(at).to_pylist()):
                    for own in scanners:
                        for found in own.scan(texts):
                            clean[first + found[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
