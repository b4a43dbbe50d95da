"""An n-gram language model in Elias-Fano tries, one for each shard of the contexts.

Texts are cut once into blocks, a row each, that hold token numbers and their words. Blocks ask the
shards of the vocabulary for word ids, then the shards of the n-grams for probabilities; what is
shuffled are sorted, deduplicated arrays, so a word or n-gram that stands in every text is one
entry for each block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longhouse.llm.eliasfano import Level, Quantiser, map_trie, starts, trie_to_bytes
from longhouse.session import stage

#: A block is closed when its texts reach so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 12_000_000
#: So much of a block is cut into words at a time: what a step works on stays in a core's cache.
PIECE_BYTES = 1 << 19
#: Twice the tokens for each shard of vocabulary and n-grams, on average.
SHARD_TOKENS = 3_000_000
#: Words of the longest n-grams.
ORDER = 3
#: Taken from each count of a successor and left to shorter contexts.
DISCOUNT = 0.75
#: The end of a text as a word; it stands for the context of the first word, too.
END = b""


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers, byte planes side by side, compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), -1).T if len(values) else np.zeros((1, 0), np.uint8)
    return values.dtype.str.encode() + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes))


def unpack(data: bytes) -> np.ndarray:
    kind, raw = np.dtype(bytes(data[:3]).decode()), zstandard.ZstdDecompressor().decompress(bytes(data[3:]))
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def pack_codes(codes: np.ndarray) -> bytes:
    """Numbers of two bytes of which few are different, compressed as they are: their bytes go together."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(codes, np.uint16))


def unpack_codes(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint16)


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(bytes(data)).split(b"\n")


def word_array(data: bytes) -> pa.LargeBinaryArray:
    """``unpack_words`` as an Arrow array."""
    letters = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint8)
    cuts = np.concatenate([np.flatnonzero(letters == 0x0A), [len(letters)]])
    return _arrow_words(letters[letters != 0x0A], np.diff(cuts, prepend=-1) - 1)


def _arrow_words(letters: np.ndarray, lengths: np.ndarray) -> pa.LargeBinaryArray:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), buffers)


#: For each byte whether it is part of a word.
_INSIDE = bytes(b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256))


def cut_words(text: bytes) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """Runs of anything but ASCII blanks, A-Z in lower case, and the place after each."""
    inside = np.frombuffer(b"".join([b"\0", text.translate(_INSIDE), b"\0"]), bool)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    letters = np.frombuffer(text.lower(), np.uint8)[inside[1:-1]]  # lower() of bytes: A-Z only
    return _arrow_words(letters, edges[1::2] - edges[::2]), edges[1::2]


def distinct(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers of ``bits`` bits in order, and the place of each given one among them. ``keys`` is used up.

    Where a number and its place fit 64 bits they are sorted as one, which is faster than an argsort.
    """
    wide = len(keys).bit_length()
    if bits + wide > 64 or not len(keys):
        return np.unique(keys, return_inverse=True)
    low = np.uint64(wide)
    keys <<= low
    keys |= np.arange(len(keys), dtype=np.uint64)
    keys.sort()
    at = (keys & np.uint64((1 << wide) - 1)).view(np.int64)
    keys >>= low
    new = starts(keys)
    place = np.cumsum(new, dtype=np.int32 if wide < 32 else np.int64)
    place -= 1
    back = np.empty_like(place)
    back[at] = place
    return keys[new], back


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


BLOCK = "block long, docs binary, train binary, lengths binary, tokens binary, words binary, counts binary, n_tokens long, n_train long"


def _block(number: int, docs: list, train: list, texts: list[bytes]) -> dict:
    found, lengths, start, size = [], [], 0, 0
    for stop, text in enumerate(texts, 1):
        size += len(text)
        if size >= PIECE_BYTES or stop == len(texts):
            words, at = cut_words(b"\n".join(texts[start:stop]))
            # the words of a text end by its line end
            ends = np.cumsum(np.fromiter(map(len, texts[start:stop]), np.int64, stop - start) + 1) - 1
            found.append(words)
            lengths.append(np.diff(np.searchsorted(at, ends, "right"), prepend=0) + 1)
            start, size = stop, 0
    coded = pa.chunked_array(found, pa.large_binary()).dictionary_encode()  # the chunks share one dictionary
    words = [END, *coded.chunk(0).dictionary.to_pylist()]
    lengths, train = np.concatenate(lengths).astype(np.uint32), np.array(train, bool)
    tokens = np.zeros(int(lengths.sum(dtype=np.int64)), np.uint32)
    is_word = np.ones(len(tokens), bool)
    is_word[np.cumsum(lengths, dtype=np.int64) - 1] = False
    tokens[is_word] = np.concatenate([c.indices.to_numpy() for c in coded.chunks]) + 1
    del found, coded, is_word
    # frequent words get small numbers
    order = np.argsort(-np.bincount(tokens, minlength=len(words)), kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    tokens = place[tokens]
    counts = np.bincount(tokens[np.repeat(train, lengths)], minlength=len(words)).astype(np.uint32)
    known = np.array([d is not None for d in docs], np.uint8)
    ids = np.array([d or 0 for d in docs], np.int64).view(np.uint64)
    return {
        "block": number,
        "docs": pack(np.stack([ids, known.astype(np.uint64)]).ravel()),
        "train": pack(train.astype(np.uint8)),
        "lengths": pack(lengths),
        "tokens": pack(tokens),
        "words": pack_words([words[i] for i in order]),
        "counts": pack(counts),
        "n_tokens": len(tokens),
        "n_train": int(counts.sum()),
    }


def tokenise(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, train) as a staged table of blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, [[], [], []]
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal number, held, size
            row = _block(number, *held)
            number, held, size = number + 1, [[], [], []], 0
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema(
            [(f.split()[0], pa.int64() if f.endswith("long") else pa.binary()) for f in BLOCK.split(", ")]
        )
        for batch in batches:
            ids, texts, flags = batch.columns
            for doc, text, train in zip(ids.to_pylist(), texts.cast(pa.large_binary()).to_pylist(), flags.to_pylist()):
                text = text or b""
                for column, value in zip(held, (doc, bool(train), text)):
                    column.append(value)
                size += len(text) + 64
                if size >= BLOCK_BYTES:
                    yield close()
        if held[0]:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "train")
    return stage(rows.mapInArrow(cut, BLOCK), "lm-blocks")


MESSAGE = "shard int, block long, place binary, first binary, second binary, counts binary"


def _map_rows(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` (a row as a dict -> an iterator of dicts) over every row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in schema.split(", ")]
        for frame in frames:
            for row in frame.to_dict("records"):
                out = list(function(row))
                if out:
                    yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def _word_messages(blocks: DataFrame, shards: int) -> DataFrame:
    """The words of each block with their training counts, dealt out by the words' crc32."""

    def deal(row: dict) -> Iterator[dict]:
        words, counts = unpack_words(row["words"]), unpack(row["counts"])
        shard = np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words))
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            yield {
                "shard": int(shard[part[0]]),
                "block": row["block"],
                "place": pack(part.astype(np.uint32)),
                "first": pack_words([words[i] for i in part]),
                "second": b"",
                "counts": pack(counts[part]),
            }

    return _map_rows(blocks.select("block", "words", "counts"), deal, MESSAGE)


KNOWN = "block long, shard int, place binary, ids binary, seen binary, n_words long"


def _word_replies(messages: DataFrame, shards: int) -> DataFrame:
    """For each block's words their ids (0: in no training text) and exact counts over all training texts. An id is the
    word's place in its shard, the most frequent first, times the number of shards, plus the shard, plus 1. The first
    reply of a shard says how many words it has."""

    def answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # in the order of the blocks, so that a task that runs again gives the same ids
        frame = frame.sort_values("block")
        asked = [word_array(data) for data in frame["first"]]
        coded = pa.concat_arrays(asked).dictionary_encode()
        codes = np.split(coded.indices.to_numpy(), np.cumsum([len(a) for a in asked])[:-1])
        total = np.zeros(len(coded.dictionary), np.uint64)
        for code, count in zip(codes, frame["counts"]):
            total[code] += unpack(count)  # a block has a word once
        order = np.argsort(-total.astype(np.int64), kind="stable")
        known = int((total > 0).sum())
        ids = np.zeros(len(total), np.uint32)
        ids[order[:known]] = np.arange(known, dtype=np.int64) * shards + int(key[0]) + 1
        rows = [
            (block, int(key[0]), place, pack(ids[code]), pack(total[code]), 0)
            for block, place, code in zip(frame["block"], frame["place"], codes)
        ]
        rows[0] = (*rows[0][:-1], known)
        return pd.DataFrame(rows, columns=[f.split()[0] for f in KNOWN.split(", ")])

    return messages.groupBy("shard").applyInPandas(answer, KNOWN)


def _known_words(replies: DataFrame) -> DataFrame:
    """The replies to a block side by side, a row a block."""
    rows = F.collect_list(F.struct("place", "ids", "seen"))
    return stage(replies.groupBy("block").agg(rows.alias("known"), F.sum("n_words").alias("n_words")), "lm-words")


def _spread(values: np.ndarray, factor: int) -> np.ndarray:
    return (values.astype(np.uint32) * np.uint32(factor)) >> np.uint32(7)


class _Level:
    """The different n-grams of a block of one order, and which of them ends at each token (-1: none).

    They are sorted by what they extend, ``parent``: the word before, in the first level, or the number of the n-gram of
    one word less, then by ``word``.
    """

    def __init__(self, parent: np.ndarray, word: np.ndarray, at: np.ndarray, back: np.ndarray, tokens: int):
        self.parent, self.word = parent, word
        self.ends = np.full(tokens, -1, back.dtype)
        self.ends[at] = back

    def counts(self, trained: np.ndarray) -> np.ndarray:
        at = self.ends[trained & (self.ends >= 0)]
        return np.bincount(at, minlength=len(self.word)).astype(np.uint32)


def _pairs(left: np.ndarray, right: np.ndarray, shift: np.uint64) -> np.ndarray:
    keys = left.astype(np.uint64)
    keys <<= shift
    keys |= right
    return keys


class _Grams:
    """A block's n-grams of 2 to ``order`` words, by the shard that holds them.

    The end mark is the context of a text's first token. Pairs whose context is unknown are left out, and so is what
    extends them. A pair goes to the shard of its context, and what extends the pair goes with it. A
    context that comes more than ``often`` times is dealt over several shards by the second word; how often it
    comes is known from the vocabulary, and how many successors it has each of them is asked. ``nth`` is each pair's
    place among these contexts (-1: none of them).
    """

    def __init__(self, row: dict, shards: int, order: int, often: int):
        self.tokens, self.lengths = unpack(row["tokens"]), unpack(row["lengths"]).astype(np.int64)
        self.train = np.repeat(unpack(row["train"]).astype(bool), self.lengths)
        n = int(self.tokens.max()) + 1
        ids, counts = np.zeros(n, np.uint32), np.zeros(n, np.uint64)
        for reply in row["known"]:
            place = unpack(reply["place"])
            ids[place], counts[place] = unpack(reply["ids"]), unpack(reply["seen"])
        self.seen = counts.astype(np.float64)
        # words by the rank of their id: the order is that of ids, the numbers are small
        known, rank = np.unique(ids, return_inverse=True)
        word = rank.astype(np.uint32)[self.tokens]
        low = len(known).bit_length()
        shift, mask = np.uint64(low), np.uint64((1 << low) - 1)
        stops = np.cumsum(self.lengths)
        first = np.concatenate([[0], stops[:-1]])
        context = np.concatenate([word[:1], word[:-1]])
        context[first] = word[stops - 1]
        at = (known > 0)[context]
        pairs, back = distinct(_pairs(context[at], word[at], shift), 2 * low)
        del context
        before, after = (pairs >> shift).astype(np.int64), (pairs & mask).astype(np.int64)
        parent, second = known[before], known[after]
        # frequent contexts, how often they come, and over how many shards they are dealt
        times = np.zeros(len(known), np.uint64)
        times[rank] = counts
        hot = np.zeros(len(known), bool)
        hot[before] = True
        hot &= times > often
        self.hot, self.totals = known[hot], times[hot]
        ways = np.minimum(self.totals // np.uint64(often) + np.uint64(1), np.uint64(shards)).astype(np.uint32)
        home = _spread(parent, 0x9E3779B1)
        nth = np.where(hot, np.cumsum(hot) - 1, -1)[before]
        dealt = np.flatnonzero(nth >= 0)
        home[dealt] += (_spread(second[dealt], 0x85EBCA6B) % ways[nth[dealt]]).astype(np.uint32)
        shard = home % np.uint32(shards)
        # numbers of two bytes are sorted by counting
        by = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
        place = np.empty(len(by), back.dtype)
        place[by] = np.arange(len(by))
        self.shard, self.nth = shard[by], nth[by]
        self.levels = [_Level(parent[by], second[by], at, place[back], len(word))]
        opens = np.zeros(len(word), bool)
        opens[first] = True
        for _ in range(3, order + 1):
            # the n-gram at a token extends that at the token before
            ends = self.levels[-1].ends
            shorter = np.concatenate([ends[:1], ends[:-1]])
            at = (shorter >= 0) & ~opens
            bits = low + len(self.levels[-1].word).bit_length()
            keys, back = distinct(_pairs(shorter[at], word[at], shift), bits)
            self.levels.append(
                _Level((keys >> shift).astype(np.int64), known[(keys & mask).astype(np.int64)], at, back, len(word))
            )
        # which shards are told of which frequent contexts: all that these are dealt over
        self.asked: dict[int, list[int]] = {}
        for k, (start, many) in enumerate(zip(_spread(self.hot, 0x9E3779B1).tolist(), ways.tolist())):
            for way in range(many):
                self.asked.setdefault((start + way) % shards, []).append(k)

    def parts(self) -> Iterator[tuple[int, list[slice], list[int]]]:
        """Each shard's stretch of every level, and the frequent contexts it is told of."""
        found = dict.fromkeys([*np.unique(self.shard).tolist(), *self.asked])
        for shard in found:
            start, stop = np.searchsorted(self.shard, [shard, shard + 1])
            cuts = [slice(int(start), int(stop))]
            for level in self.levels[1:]:
                start, stop = np.searchsorted(level.parent, [cuts[-1].start, cuts[-1].stop])
                cuts.append(slice(int(start), int(stop)))
            yield shard, cuts, self.asked.get(shard, [])


GRAMS = "shard int, block long, hot binary, totals binary, grams array<binary>"


def _gram_messages(blocks: DataFrame, shards: int, order: int, often: int) -> DataFrame:
    """The n-grams of each block with their training counts, dealt out by context: for each level what an n-gram extends,
    as steps from one to the next, its last word and its count."""

    def deal(row: dict) -> Iterator[dict]:
        own = _Grams(row, shards, order, often)
        counts = [level.counts(own.train) for level in own.levels]
        for shard, cuts, asked in own.parts():
            grams, base = [], 0
            for level, count, cut in zip(own.levels, counts, cuts):
                parent = level.parent[cut].astype(np.int64) - base
                grams += [pack(np.diff(parent, prepend=0).astype(np.uint32)), pack(level.word[cut]), pack(count[cut])]
                base = cut.start
            yield {
                "shard": shard,
                "block": row["block"],
                "hot": pack(own.hot[asked]),
                "totals": pack(own.totals[asked]),
                "grams": grams,
            }

    return _map_rows(blocks.select("block", "train", "lengths", "tokens", "known"), deal, GRAMS)


class _Asked:
    """A message read again."""

    def __init__(self, hot: bytes, totals: bytes, grams: list[bytes]):
        self.hot, self.totals = unpack(hot), unpack(totals)
        self.parents = [np.cumsum(unpack(g), dtype=np.int64) for g in grams[::3]]
        self.words = [unpack(g) for g in grams[1::3]]
        self.counts = [unpack(g) for g in grams[2::3]]


class _Union:
    """The n-grams that all blocks ask of a shard, each once, level by level.

    ``keys`` of a level hold the context's id, in the first level, or the place of the n-gram of one word less in the level
    above, then the word; ``back`` says which of them is each block's n-gram, ``counts`` how often it was
    trained. Those that were only asked for have no count.
    """

    def __init__(self, asked: list[_Asked]):
        low = np.uint64(32)
        self.asked, self.keys, self.back, self.counts = asked, [], [], []
        places = [a.parents[0] for a in asked]
        for n in range(len(asked[0].words)):
            word, parent = np.concatenate([a.words[n] for a in asked]), np.concatenate(places)
            width = int(word.max(initial=0)).bit_length()
            bits = width + int(parent.max(initial=0)).bit_length()
            keys, back = distinct(_pairs(parent, word, np.uint64(width)), bits)
            keys = ((keys >> np.uint64(width)) << low) | (keys & np.uint64((1 << width) - 1))
            count = np.bincount(back, np.concatenate([a.counts[n] for a in asked]), len(keys)).astype(np.int64)
            ends = np.cumsum([len(a.words[n]) for a in asked])
            self.keys.append(keys)
            self.counts.append(count)
            self.back.append(np.split(back, ends[:-1]))
            if n + 1 < len(asked[0].words):
                places = [own[a.parents[n + 1]] for own, a in zip(self.back[n], asked)]

    def parents(self, n: int) -> np.ndarray:
        return (self.keys[n] >> np.uint64(32)).astype(np.int64)

    def words(self, n: int) -> np.ndarray:
        return self.keys[n].astype(np.uint32)


def build_trie(union: _Union, discount: float) -> bytes:
    """The trie of a shard from the training counts of all blocks, level by level."""
    totals = {int(c): int(t) for a in union.asked for c, t in zip(a.hot, a.totals)}
    levels, place = [], None
    for n, counts in enumerate(union.counts):
        parent, word = union.parents(n), union.words(n)
        # an n-gram that extends one no training text has was not trained either
        trained = counts > 0 if place is None else (counts > 0) & (place[parent] >= 0)
        parent, word, counts = parent[trained], word[trained].astype(np.uint64), counts[trained]
        if n:
            levels.append(Level.below(place[parent], levels[-1].numbers["n"], word, counts, discount))
        else:
            levels.append(Level.build(parent.astype(np.uint64), word, counts, discount, totals))
        place = np.where(trained, np.cumsum(trained) - 1, -1)
    return trie_to_bytes(levels)


REPLY = "block long, shard int, shares array<binary>, rests array<binary>, kinds binary, codebook array<double>"
_REPLY_NAMES = [f.split()[0] for f in REPLY.split(", ")]


def ask_trie(trie: list[Level], union: _Union) -> Iterator[tuple[list[bytes], list[bytes], bytes]]:
    """What a trie says of each block's n-grams: a code for the share of each, one for the rest of each that is extended, and the
    number of successors of its frequent contexts here.

    It is queried once for each different n-gram, level by level: the rank of a context, its range of successors, then the
    successor search, whose place is the rank in the next level.
    """
    contexts = union.parents(0)
    new = starts(contexts)
    parent = np.cumsum(new) - 1
    ranks, shares, rests = trie[0].context_ranks(contexts[new].astype(np.uint64)), [], []
    for n, level in enumerate(trie):
        rests.append(level.rests(ranks))
        ranks = level.places(ranks[union.parents(n) if n else parent], union.words(n))
        shares.append(level.share_codes(ranks))
    hot = np.concatenate([a.hot for a in union.asked]).astype(np.uint64)
    kinds = trie[0].successor_counts(trie[0].context_ranks(hot))
    kinds = np.split(kinds, np.cumsum([len(a.hot) for a in union.asked])[:-1])
    for k, a in enumerate(union.asked):
        back = [own[k] for own in union.back]
        # a rest for each context of the block, in the first level, then for each n-gram of one word less
        own = [parent[back[0][starts(a.parents[0])]], *back[:-1]]
        yield [pack_codes(s[b]) for s, b in zip(shares, back)], [pack_codes(r[b]) for r, b in zip(rests, own)], pack(kinds[k])


def _tries(messages: DataFrame, discount: float) -> DataFrame:
    """Each shard's trie as the bytes that ``eliasfano.map_trie`` reads: (shard, first)."""

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        union = _Union([_Asked(*m) for m in zip(frame["hot"], frame["totals"], frame["grams"])])
        return pd.DataFrame([(int(key[0]), build_trie(union, discount))], columns=["shard", "first"])

    return messages.groupBy("shard").applyInPandas(build, "shard int, first binary")


def _replies(messages: DataFrame, discount: float) -> DataFrame:
    """What each shard's trie says of every block's n-grams; it is mapped as it is, not decoded."""

    def answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        union = _Union([_Asked(*m) for m in zip(frame["hot"], frame["totals"], frame["grams"])])
        trie = map_trie(build_trie(union, discount))
        codebook = [x for level in trie for q in (level.share, level.rest) for x in (q.least, q.step)]
        out = [(block, int(key[0]), *said, codebook) for block, said in zip(frame["block"], ask_trie(trie, union))]
        return pd.DataFrame(out, columns=_REPLY_NAMES)

    return messages.groupBy("shard").applyInPandas(answer, REPLY)


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _chances(own: _Grams, replies: pd.DataFrame, first: np.ndarray, discount: float) -> np.ndarray:
    """The probability of each token: from the share of all words up, order by order."""
    shares = [np.zeros(len(level.word)) for level in own.levels]
    rests = [np.ones(len(level.word)) for level in own.levels]
    kinds = np.zeros(len(own.hot), np.int64)
    cuts = {shard: (c, asked) for shard, c, asked in own.parts()}
    for reply in replies.to_dict("records"):
        stretch, asked = cuts[reply["shard"]]
        kinds[asked] += unpack(reply["kinds"])
        for n, (level, cut) in enumerate(zip(own.levels, stretch)):
            least, step, least2, step2 = reply["codebook"][4 * n : 4 * n + 4]
            shares[n][cut] = Quantiser(least, step).values(unpack_codes(reply["shares"][n]))
            codes = unpack_codes(reply["rests"][n])
            rest = np.where(codes > 0, Quantiser(least2, step2).values(codes), 1.0)
            # by context in the first level, then by the n-gram of one word less
            which = np.cumsum(starts(level.parent[cut])) - 1 if not n else level.parent[cut] - stretch[n - 1].start
            rests[n][cut] = rest[which]
    dealt = np.flatnonzero(own.nth >= 0)
    rests[0][dealt] = (discount * kinds / own.totals)[own.nth[dealt]]
    chance = first
    for level, share, rest in zip(own.levels, shares, rests):
        at = np.flatnonzero(level.ends >= 0)
        ends = level.ends[at]
        chance[at] = share[ends] + rest[ends] * chance[at]
    return chance


def _scores(
    blocks: DataFrame, replies: DataFrame, shape: tuple[int, int, int], tokens: int, words: int, discount: float
) -> DataFrame:
    """Scores of a block's texts from what the shards said."""

    def add_up(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.to_dict("records"):
            own = _Grams(row, *shape)
            base = np.log10((own.seen + 1) / (tokens + words + 1))
            if tokens:
                first = np.maximum(own.seen - discount, 0) / tokens + discount * words / tokens / (words + 1)
            else:
                first = np.ones(len(own.seen))
            chance = _chances(own, right, first[own.tokens], discount)
            begins = np.concatenate([[0], np.cumsum(own.lengths)[:-1]])
            ids, known = unpack(row["docs"]).reshape(2, -1)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(ids.view(np.int64), dtype="Int64").copy(),
                        "n_tokens": own.lengths,
                        "n_known": np.add.reduceat((own.seen > 0).astype(np.int64)[own.tokens], begins),
                        "base_score": np.add.reduceat(base[own.tokens], begins),
                        "score": np.add.reduceat(np.log10(chance), begins),
                    }
                )
            )
            out[-1].loc[known == 0, "doc_id"] = pd.NA
        return pd.concat(out) if out else pd.DataFrame(columns=[f.split()[0] for f in SCORED.split(", ")])

    own = blocks.select("block", "docs", "train", "lengths", "tokens", "known")
    return own.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(add_up, SCORED)


def train_and_score(docs: DataFrame, discount: float = DISCOUNT, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Learn a model of ``order`` words from the rows of ``docs`` (doc_id, text, train) with train set, and score all.

    Returns the scores and the tries. Scores: doc_id, n_tokens, n_known, base_score (add-one
    unigrams), score (the model's log10 probability of the text and its end) and train_tokens. Tries:
    shard and ``first``, the bytes that ``eliasfano.map_trie`` reads, a level for each order from 2 on.

    Tokens are runs of anything but ASCII blanks, A-Z in lower case, and one end for each text. The
    probability of a word mixes its share after the ``order`` - 1 words before it with that after one word less, down to
    its share of all words and 1/(words + 1), by absolute discounting; over all words and one unknown word it sums to 1, but
    for the rounding of the 16-bit codes.

    A null text is empty: its end is all that is scored. A null train is false. Without training
    texts every probability is 1/(0 + 1), so scores are 0. Ids may repeat or be null; each row is
    scored. A word or n-gram may stand in any share of the texts: each block sends it once, and the successors of a
    word that is a large share of all are dealt over several shards.
    """
    if order < 2:
        raise ValueError("a trie has n-grams of two words and more")
    blocks = tokenise(docs)
    total = blocks.agg(F.sum("n_tokens"), F.sum("n_train")).first()
    tokens, train_tokens = int(total[0] or 0), int(total[1] or 0)
    # uneven shards are no harm, and the number must not divide the multiplier of a hash
    shards = tokens // SHARD_TOKENS * 2 + 7
    messages = _word_messages(blocks, shards)
    known = _known_words(_word_replies(messages, shards))
    words = int(known.agg(F.sum("n_words")).first()[0] or 0)
    blocks = blocks.drop("words", "counts").join(known.drop("n_words"), "block")
    shape = (shards, order, SHARD_TOKENS)
    grams = _gram_messages(blocks, *shape)
    scores = _scores(blocks, _replies(grams, discount), shape, train_tokens, words, discount)
    return scores.withColumn("train_tokens", F.lit(train_tokens).cast("long")), _tries(grams, discount)
