"""Phrase collocations: n-gram counts of burstable tries, and scores of the frequent ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longhouse.llm.ngramlm import pack, unpack
from longhouse.session import stage

#: Longest phrase, least count of a phrase, phrases a language returns.
LONGEST, LEAST, TOP = 5, 100, 2000
#: A container of more entries bursts into one for each next word, down to this depth.
BURST, DEPTH = 2048, 2
#: Entries, different words and bytes of these that a task holds; beyond it the largest subtrees are spilled.
ENTRIES, WORDS, WORD_BYTES = 400_000, 400_000, 1 << 27
#: Bytes of text that are counted at once, and phrases of runs that are merged at once.
CHUNK, MERGE = 1 << 21, 1 << 20
#: Bits of the filter of frequent shorter phrases that is broadcast, for each phrase and at most.
FILTER_BITS, MOST_BITS = 16, 1 << 27
NO_LANGUAGE = "und"

#: Tabs are blanks; what ends a piece becomes a full stop, which no word holds.
_FOLD = bytes.maketrans(b"\t,;:!?\n\x0b\x0c\r", b" .........")
_BREAK = b"."
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


# --- the trie ----------------------------------------------------------------------------------


class Container:
    """A hash table of the counts under one prefix: the rest of the phrase (four bytes a word) to its count."""

    __slots__ = ("counts",)

    def __init__(self):
        self.counts: dict[bytes, int] = {}

    def __len__(self):
        return len(self.counts)

    def collect(self, prefix: bytes, phrases: list[bytes], counts: list[int]) -> None:
        phrases += [prefix + rest for rest in self.counts] if prefix else self.counts
        counts += self.counts.values()


class Branch:
    """A node of the trie: one child for each next word, and the count of the phrase that ends here."""

    __slots__ = ("children", "own", "size")

    def __init__(self):
        self.children: dict[bytes, Container | Branch] = {}
        self.own, self.size = 0, 0

    def __len__(self):
        return self.size

    def collect(self, prefix: bytes, phrases: list[bytes], counts: list[int]) -> None:
        if self.own:
            phrases.append(prefix)
            counts.append(self.own)
        for word, child in self.children.items():
            child.collect(prefix + word, phrases, counts)


class HatTrie:
    """Counts of phrases, given as bytes with four for each word's id.

    All begins in one container. One that has more than ``burst`` entries bursts into a branch whose
    children are containers again, one for each next word, down to ``depth`` words. Below it stay hash tables,
    however large.
    """

    def __init__(self, burst: int, depth: int):
        self.root: Container | Branch = Container()
        self.burst, self.depth = burst, depth

    def __len__(self):
        return len(self.root)

    def add(self, phrases: list[bytes], counts: list[int]) -> None:
        """Add counts; phrases that begin alike should follow each other."""
        path, node, depth, begin = [], self.root, 0, b""
        for phrase, n in zip(phrases, counts):
            if not (depth and phrase.startswith(begin)) or type(node) is Branch:
                path, node, depth = [], self.root, 0
                while type(node) is Branch and 4 * depth < len(phrase):
                    path.append(node)
                    word = phrase[4 * depth : 4 * depth + 4]
                    depth += 1
                    child = node.children.get(word)
                    if child is None:
                        child = node.children[word] = Container()
                    node = child
                begin = phrase[: 4 * depth]
            if type(node) is Branch:
                fresh = not node.own
                node.own += n
                node.size += fresh
            else:
                rest, table = phrase[4 * depth :], node.counts
                before = table.get(rest)
                fresh = before is None
                table[rest] = n if fresh else before + n
            if fresh:
                for branch in path:
                    branch.size += 1
                if type(node) is Container and len(table) > self.burst and depth < self.depth:
                    whole = self._burst(node)
                    if path:
                        path[-1].children[begin[-4:]] = whole
                    else:
                        self.root = whole
                    depth = 0  # the next phrase goes down anew

    @staticmethod
    def _burst(full: Container) -> Branch:
        branch = Branch()
        branch.size = len(full)
        for rest, n in full.counts.items():
            if not rest:
                branch.own = n
                continue
            child = branch.children.get(rest[:4])
            if child is None:
                child = branch.children[rest[:4]] = Container()
            child.counts[rest[4:]] = n
        return branch

    def cut(self, keep: int) -> tuple[list[bytes], list[int]]:
        """Take whole subtrees off the root, the largest first, until no more than ``keep`` entries are left."""
        phrases: list[bytes] = []
        counts: list[int] = []
        if type(self.root) is Container:
            if len(self) > keep:
                self.root.collect(b"", phrases, counts)
                self.root = Container()
            return phrases, counts
        for word, child in sorted(self.root.children.items(), key=lambda c: -len(c[1])):
            if len(self) <= keep:
                break
            child.collect(word, phrases, counts)
            del self.root.children[word]
            self.root.size -= len(child)
        return phrases, counts


# --- filters of frequent phrases ---------------------------------------------------------------


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _ODD[k]
    return h ^ (h >> np.uint64(32))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * _ODD[1] + b, 0)


def _word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=xxhash.xxh32_intdigest(lang))


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [_mix(hashes, k) & np.uint64(bits - 1) for k in (0, 1)]


def frequent_filter(grams: DataFrame) -> np.ndarray:
    """A Bloom filter of phrases of one or two words, (lang, phrase), as 64-bit words.

    It has ``FILTER_BITS`` bits a phrase, ``MOST_BITS`` at most: a fuller filter lets more phrases
    through, which are then counted for nothing, and never keeps one out. The bits are set by Spark; what
    comes to the driver is bounded by the filter.
    """
    bits = 1 << 10
    while bits < min(MOST_BITS, FILTER_BITS * grams.count()):
        bits *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = zip(*(c.to_pylist() for c in batch.columns))
            h = np.array([[_word_hash(lang, w) for w in phrase.split(b" ")] for lang, phrase in rows], np.uint64)
            h = h[:, 0] if h.shape[1] == 1 else _pair_hash(h[:, 0], h[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(h, bits)).astype(np.int64))], ["bit"])

    set_ = grams.select(F.col("lang").cast("binary"), F.col("phrase").cast("binary")).mapInArrow(places, "bit long")
    one = F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")
    words = set_.groupBy(F.expr("bit div 64").alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def _passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    fine = np.ones(len(hashes), bool)
    for place in _places(hashes, 64 * len(filter_)):
        fine &= (filter_[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return fine


# --- counting in tasks -------------------------------------------------------------------------


class Words(dict):
    """Word to number in a task; nought is the end of a piece."""

    def __init__(self, lang: bytes, filter_: np.ndarray | None):
        super().__init__()
        self.seed, self.filter = xxhash.xxh32_intdigest(lang), filter_
        self.names, self.hashes, self.bytes = [b""], [0], 0
        self.fine = np.zeros(1, bool)
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        self.bytes += len(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, seed=self.seed))
        return number

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        """The tokens' numbers; a word that no frequent phrase holds ends a piece, too."""
        ids = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        fresh = np.array(self.hashes[len(self.fine) :], np.uint64)
        passed = np.ones(len(fresh), bool) if self.filter is None else _passes(self.filter, fresh)
        self.fine = np.append(self.fine, passed)
        return np.where(self.fine[ids], ids, np.uint64(0))


RUN = pa.schema(
    [("part", pa.int32()), ("lang", pa.binary()), ("lengths", pa.binary()), ("phrases", pa.binary()), ("counts", pa.binary())]
)


def write_run(part: int, lang: bytes, phrases: pa.Array, counts: np.ndarray) -> list:
    """A sorted run as a row: lengths, the phrases' bytes and counts, each compressed."""
    ends = np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset : phrases.offset + len(phrases) + 1]
    text = phrases.buffers()[2][int(ends[0]) : int(ends[-1])]
    small = zstandard.ZstdCompressor(level=1).compress(text)
    return [part, lang, pack(np.diff(ends).astype(np.uint32)), small, pack(counts.astype(np.uint64))]


def read_run(lengths: bytes, phrases: bytes, counts: bytes) -> pa.Table:
    ends = np.concatenate([[0], np.cumsum(unpack(lengths), dtype=np.int64)])
    text = pa.py_buffer(zstandard.ZstdDecompressor().decompress(phrases))
    column = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), text])
    return pa.table({"phrase": column, "n": pa.array(unpack(counts).astype(np.int64))})


class Counter:
    """The n-grams of one language in one task: a trie, the words it speaks of, and what it spills."""

    def __init__(
        self, lang: bytes, orders: tuple[int, ...], parts: int, words: np.ndarray | None = None, pairs: np.ndarray | None = None
    ):
        self.lang, self.orders, self.parts, self.word_filter, self.pair_filter = lang, orders, parts, words, pairs
        self.words, self.trie = Words(lang, words), HatTrie(BURST, min(DEPTH, max(orders) - 1))
        self.waiting, self.size = [], 0

    def text(self, data: bytes) -> Iterator[pa.RecordBatch]:
        self.waiting.append(data)
        self.size += len(data) + 1
        if self.size >= CHUNK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        data = _BREAK.join(self.waiting).lower().translate(_FOLD).replace(_BREAK, b" . ")
        self.waiting, self.size = [], 0
        tokens = data.split()
        ids = self.words.numbers(tokens)
        del data, tokens
        self._count(ids)
        if len(self.trie) > ENTRIES:
            yield from self.spill(ENTRIES // 2)
        if len(self.words) > WORDS or self.words.bytes > WORD_BYTES:
            yield from self.spill(0)
            self.words = Words(self.lang, self.word_filter)

    def _count(self, ids: np.ndarray) -> None:
        if 1 in self.orders:
            found, counts = np.unique(ids[ids > 0], return_counts=True)
            self._add(found[:, None], counts)
        if max(self.orders) < 2 or len(ids) < 2:
            return
        # every different pair has a number; 0 is that of pairs that end a phrase
        low = np.uint64(32)
        whole = (ids[:-1] > 0) & (ids[1:] > 0)
        keys, number, counts = np.unique(ids[:-1][whole] << low | ids[1:][whole], return_inverse=True, return_counts=True)
        first, second = keys >> low, keys & np.uint64(0xFFFFFFFF)
        if 2 in self.orders:
            self._add(np.stack([first, second], axis=1), counts)
        if max(self.orders) < 3:
            return
        hashes = np.array(self.words.hashes, np.uint64)
        fine = _passes(self.pair_filter, _pair_hash(hashes[first], hashes[second]))
        pair = np.zeros(len(ids) - 1, np.uint64)
        pair[whole] = np.where(fine[number], number + 1, 0)
        ends = np.append(np.uint64(0), second)
        # the number of the n-gram at each place, 0 for none, and the words of each number
        gram, spelled = pair, np.stack([np.append(np.uint64(0), first), ends], axis=1)
        for order in range(3, max(self.orders) + 1):
            if len(ids) < order:
                return
            # an n-gram is one of n - 1 words and the pair that overlaps its last one
            here, ahead = gram[: len(ids) - order + 1], pair[order - 2 :]
            whole = (here > 0) & (ahead > 0)
            keys, number, counts = np.unique(here[whole] << low | ahead[whole], return_inverse=True, return_counts=True)
            grams = np.column_stack([spelled[keys >> low], ends[keys & np.uint64(0xFFFFFFFF)]])
            if order in self.orders:
                self._add(grams, counts)
            spelled = np.vstack([np.zeros((1, order), np.uint64), grams])
            gram = np.zeros(len(here), np.uint64)
            gram[whole] = number + 1

    def _add(self, grams: np.ndarray, counts: np.ndarray) -> None:
        packed = np.ascontiguousarray(grams.astype(np.uint32))
        if len(packed):
            self.trie.add(packed.view(f"V{4 * packed.shape[1]}").ravel().tolist(), counts.tolist())

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """What is cut, as a sorted run for each prefix partition: the phrases spelled, in their order."""
        phrases, counts = self.trie.cut(keep)
        if not phrases:
            return
        names, hashes = pa.array(self.words.names, pa.binary()), np.array(self.words.hashes, np.uint64)
        rank = np.empty(len(names), np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        sizes, counts = np.fromiter(map(len, phrases), np.int64, len(phrases)), np.array(counts, np.int64)
        rows = []
        for size in np.unique(sizes).tolist():
            own = phrases if size == sizes[0] and (sizes == size).all() else [p for p in phrases if len(p) == size]
            ids = np.frombuffer(b"".join(own), np.uint32).reshape(len(own), -1)
            first = hashes[ids[:, 0]]
            prefix = first if ids.shape[1] == 1 else _pair_hash(first, hashes[ids[:, 1]])
            part = (prefix % np.uint64(self.parts)).astype(np.int64)
            order = np.lexsort((*(rank[c] for c in ids.T[::-1]), part))
            ids, part, count = ids[order], part[order], counts[sizes == size][order]
            spelled = pc.binary_join_element_wise(*(names.take(pa.array(c)) for c in ids.T), b" ")
            cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            for start, stop in zip(cuts, [*cuts[1:], len(part)]):
                rows.append(write_run(int(part[start]), self.lang, spelled.slice(start, stop - start), count[start:stop]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RUN)], schema=RUN)

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.flush()
        yield from self.spill(0)


def count_phrases(
    texts: DataFrame,
    orders: tuple[int, ...],
    least: int,
    words: np.ndarray | None = None,
    pairs: np.ndarray | None = None,
) -> DataFrame:
    """(lang, phrase, n): phrases of ``orders`` words that occur ``least`` times and more in ``texts`` (lang, text).

    Rows with a null phrase sum up all occurrences, of rarer phrases, too. ``words`` and ``pairs`` are filters of what is
    frequent: phrases with another word, or of three words and
    more with another pair, are left out; others are counted in full. Tasks count in tries and spill
    sorted runs; those of one prefix, the first two words, meet in one partition and are merged.
    """
    spark = texts.sparkSession
    filters = spark.sparkContext.broadcast((words, pairs))
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                counter = counters.get(lang)
                if counter is None:
                    if len(counters) >= 64:  # many languages: the first makes room
                        yield from counters.pop(next(iter(counters))).close()
                    counter = counters[lang] = Counter(lang, orders, parts, *filters.value)
                yield from counter.text(text.as_py())
        for counter in counters.values():
            yield from counter.close()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[pa.Table]] = {}
        waiting: dict[bytes, int] = {}

        def summed(lang: bytes) -> pa.Table:
            whole = pa.concat_tables(held[lang]).group_by("phrase").aggregate([("n", "sum")])
            return whole.rename_columns({"n_sum": "n"}).select(["phrase", "n"])

        for batch in batches:
            for row in batch.to_pylist():
                lang, run = row["lang"], read_run(row["lengths"], row["phrases"], row["counts"])
                held.setdefault(lang, []).append(run)
                waiting[lang] = waiting.get(lang, 0) + len(run)
                if waiting[lang] > 2 * len(held[lang][0]) + MERGE:
                    held[lang], waiting[lang] = [summed(lang)], 0
        for lang in held:
            whole = summed(lang)
            often = whole.filter(pc.greater_equal(whole["n"], least))
            total = pc.sum(whole["n"]).as_py()
            phrases = [*often["phrase"].to_pylist(), None]
            langs = pa.array([lang] * len(phrases), pa.binary())
            counts = pa.array([*often["n"].to_pylist(), total], pa.int64())
            yield pa.RecordBatch.from_arrays([langs, pa.array(phrases, pa.binary()), counts], ["lang", "phrase", "n"])

    kinds = {pa.int32(): "int", pa.binary(): "binary"}
    runs = texts.mapInArrow(count, ", ".join(f"{f.name} {kinds[f.type]}" for f in RUN))
    merged = runs.repartitionById(parts, F.col("part")).mapInArrow(merge, "lang binary, phrase binary, n long")
    return merged.select(F.col("lang").cast("string"), F.col("phrase").cast("string"), "n")


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE)).cast("binary").alias("lang"), text.alias("text"))


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words with ``least`` occurrences, (lang, phrase, n), and the words of each
    language, (lang, n).

    Three readings of the texts: words; pairs of frequent words; longer phrases of frequent pairs. No phrase is more frequent
    than a part of it, so nothing frequent is lost.
    """
    texts = texts_of(docs)
    words = stage(count_phrases(texts, (1,), least), "words")
    totals = words.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    found = words.where("phrase IS NOT NULL")
    if longest > 1:
        fine = frequent_filter(found)
        pairs = stage(count_phrases(texts, (2,), least, fine).where("phrase IS NOT NULL"), "pairs")
        found = found.unionByName(pairs)
    if longest > 2:
        orders = tuple(range(3, longest + 1))
        more = count_phrases(texts, orders, least, fine, frequent_filter(pairs))
        found = found.unionByName(stage(more.where("phrase IS NOT NULL"), "phrases"))
    return found, totals


def _part(first: F.Column | int, length: F.Column) -> F.Column:
    return F.array_join(F.slice(F.col("words"), first, length), " ")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered: int = 100
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts (``docs`` has text and lang) are lower-cased in A-Z, cut at ``.,;:!?`` and line breaks, and split at
    blanks and tabs. A phrase of 2 to ``longest`` words with a >= ``least`` occurrences scores
    floor(1000 a n / (l r)), n the language's words and l and r the occurrences of its two parts at the
    cut that scores least, the first of equal ones. A phrase is left out if a longer frequent one holds it and has
    ``covered`` percent of its occurrences. The ``top`` by score, a, phrase (bytes) return. Arithmetic is on whole numbers of up to 38 digits.

    A null lang is ``und``; null and empty texts count nothing; repeated rows count each. No texts give no rows.
    Other input columns are not read.
    """
    grams, totals = frequent_phrases(docs, longest, least)
    grams = grams.withColumn("words", F.split("phrase", " ")).withColumn("k", F.size("words"))
    candidates = grams.where("k > 1").withColumnRenamed("n", "a")
    parts = grams.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", _part(1, F.col("cut")).alias("left"),
        _part(F.col("cut") + 1, F.size("words")).alias("right"),
    )
    cuts = cuts.join(parts.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
    cuts = cuts.join(parts.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
    # languages are joined by their totals, a row each
    cuts = cuts.join(totals, "lang")
    big = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    cuts = cuts.withColumn("above", (big["a"] * big["n"]).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
    cuts = cuts.withColumn("below", (big["l"] * big["r"]).cast("decimal(38,0)"))
    scored = cuts.withColumn("score", F.expr("above div below"))
    least_cut = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(least_cut).select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score"
    )
    inner = candidates.where("k > 2").select(
        "lang", "a", "words", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("length")
    )
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("length") + 1)))
    longer = inner.groupBy("lang", _part(F.col("at"), F.col("length")).alias("phrase")).agg(F.max("a").alias("most"))
    free = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < covered * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # the limit is taken in each partition before rows of a language meet
    best = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
