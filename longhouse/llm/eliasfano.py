"""Elias-Fano sequences and the levels of an n-gram trie, laid out to be memory-mapped."""

from __future__ import annotations

import json
import struct
from functools import cached_property

import numpy as np

#: So many n-grams are looked up at a time: what a step works on stays in a core's cache.
STEP = 1 << 15
_BYTE_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: place of the k-th set bit of a byte
_BYTE_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _BYTE_SELECT[_b, _k] = _p
# a word's bits in groups
_EVERY_2ND, _TWO_OF_4, _FOUR_OF_8 = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F))
_EACH_BYTE, _TOP_BITS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


def starts(values: np.ndarray) -> np.ndarray:
    """Whether each value is the first of a run of equal ones."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def to_buffer(arrays: dict[str, np.ndarray], **numbers) -> bytes:
    """Arrays and numbers in one buffer: a JSON head, then the arrays, each on a multiple of 8 bytes."""
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = [at, len(a), a.dtype.str]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps({"arrays": places, "numbers": numbers}).encode()
    head += b" " * (-len(head) % 8)
    body = [np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values()]
    return struct.pack("<Q", len(head)) + head + b"".join(body)


def from_buffer(buffer) -> tuple[dict[str, np.ndarray], dict]:
    """Views of the arrays in ``buffer``, bytes or a memory map; nothing is copied or decoded."""
    (size,) = struct.unpack_from("<Q", buffer)
    head = json.loads(bytes(buffer[8 : 8 + size]))
    arrays = {
        name: np.frombuffer(buffer, np.dtype(kind), n, 8 + size + at) for name, (at, n, kind) in head["arrays"].items()
    }
    return arrays, head["numbers"]


class EliasFano:
    """A monotone sequence: low bits packed side by side, high bits in unary, a rank for each word."""

    def __init__(self, arrays: dict[str, np.ndarray], n: int, low_bits: int):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.ones = arrays["low"], arrays["high"], arrays["ones"]

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values`` must not decrease and lie below ``universe``."""
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, int(universe // n).bit_length() - 1) if n else 0
        l = np.uint64(low_bits)
        place = (values >> l).astype(np.int64) + np.arange(n)
        words = (int(place[-1]) if n else 0) // 64 + 2
        # each word's set bits are different powers of two, so adding up sets them
        high = np.zeros(words, np.uint64)
        if n:
            bits = np.uint64(1) << (place & 63).astype(np.uint64)
            word = place >> 6
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            high[word[start]] = np.bitwise_or.reduceat(bits, start)
        per_word = _BYTE_ONES[high.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        ones = np.concatenate([[0], np.cumsum(per_word)]).astype(np.uint32)
        low = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if n and low_bits:
            part = values & ((np.uint64(1) << l) - np.uint64(1))
            bit = np.arange(n, dtype=np.int64) * low_bits
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low[word[start]] |= np.bitwise_or.reduceat(part << shift, start)
            over = np.flatnonzero((bit & 63) + low_bits > 64)
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        return cls({"low": low, "high": high, "ones": ones}, n, low_bits)

    def parts(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones}

    @classmethod
    def of(cls, name: str, arrays: dict[str, np.ndarray], n: int, low_bits: int) -> EliasFano:
        return cls({k: arrays[f"{name}.{k}"] for k in ("low", "high", "ones")}, n, low_bits)

    @cached_property
    def unset(self) -> np.ndarray:
        """Unset high bits before each word."""
        return np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = (bit & 63) + self.low_bits > 64
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & ((np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1))

    @staticmethod
    def _in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th set bit of each word: set bits up to each of its bytes, side by side in a word, tell the byte."""
        pairs = words - ((words >> np.uint64(1)) & _EVERY_2ND)
        fours = (pairs & _TWO_OF_4) + ((pairs >> np.uint64(2)) & _TWO_OF_4)
        upto = ((fours + (fours >> np.uint64(4))) & _FOUR_OF_8) * _EACH_BYTE
        k = k.astype(np.uint64)
        # the top bit of a byte stays where no more than k bits are set up to its end
        ends = ((k * _EACH_BYTE | _TOP_BITS) - upto) & _TOP_BITS
        shift = np.bitwise_count(ends).astype(np.uint64) << np.uint64(3)
        before = ((upto << np.uint64(8)) >> shift) & np.uint64(255)
        byte = (words >> shift) & np.uint64(255)
        return shift.astype(np.int64) + _BYTE_SELECT[byte.astype(np.int64), (k - before).astype(np.int64)]

    def _select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the k-th set (or unset) bit of the high bits, counted from 0."""
        if zeros:
            word = np.searchsorted(self.unset, k, "right") - 1
            return word * 64 + self._in_word(~self.high[word], k - self.unset[word])
        word = np.searchsorted(self.ones, k.astype(np.uint32), "right") - 1
        return word * 64 + self._in_word(self.high[word], k - self.ones[word])

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        if not len(i):
            return np.zeros(0, np.uint64)
        i = i.astype(np.int64)
        high = (self._select(i, False) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def find(self, x: np.ndarray, start: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Place of each value of ``x`` within [start, stop), or -1: its successor, if that is it.

        The high part names a run of elements by two selects; the low parts of the run, narrowed to
        the range, are searched by halving.
        """
        x = x.astype(np.uint64)
        out = np.full(len(x), -1, np.int64)
        if not len(x) or not self.n:
            return out
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        # there is an unset bit after the last run only up to the end of the bits
        known = np.flatnonzero(high < len(self.high) * 64 - self.n)
        high, want = high[known], x[known] & ((np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1))
        # values side by side often share it
        new = starts(high)
        run, back = high[new], np.cumsum(new) - 1
        first = np.where(run > 0, self._select(np.maximum(run - 1, 0), True) - (run - 1), 0)[back]
        last = (self._select(run, True) - run)[back]
        if start is not None:
            first, last = np.maximum(first, start[known]), np.minimum(last, stop[known])
        low, top = first.copy(), last.copy()
        while True:
            open_ = np.flatnonzero(low < top)
            if not len(open_):
                break
            middle = (low[open_] + top[open_]) >> 1
            less = self._low(middle) < want[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            top[open_] = np.where(less, top[open_], middle)
        inside = np.flatnonzero(low < last)
        same = self._low(low[inside]) == want[inside]
        out[known[inside[same]]] = low[inside[same]]
        return out


class Quantiser:
    """Positive numbers as 16-bit codes, evenly spaced on the logarithm; code 0 stands for none."""

    def __init__(self, least: float, step: float):
        self.least, self.step = least, step

    @classmethod
    def over(cls, values: np.ndarray) -> Quantiser:
        if not len(values):
            return cls(0.0, 0.0)
        logs = np.log10(values)
        return cls(float(logs.min()), float(logs.max() - logs.min()) / 65534)

    def codes(self, values: np.ndarray) -> np.ndarray:
        if not self.step:
            return np.ones(len(values), np.uint16)
        return (np.rint((np.log10(values) - self.least) / self.step) + 1).astype(np.uint16)

    def values(self, codes: np.ndarray) -> np.ndarray:
        return np.where(codes > 0, 10.0 ** (self.least + (codes.astype(np.float64) - 1) * self.step), 0.0)


class Level:
    """One level of the trie: monotone pointers from contexts to their successors, and quantised numbers.

    A successor is stored relative to its context: the sequence holds rank of the context times the
    width of a word id plus the id, which is monotone over all contexts. The first level keeps its contexts, too; in
    those below a context is an n-gram of the level above, and its rank is its place there.
    """

    def __init__(self, arrays: dict[str, np.ndarray], numbers: dict):
        self.arrays, self.numbers = arrays, numbers
        n, m = numbers["n"], numbers["m"]
        self.contexts = EliasFano.of("contexts", arrays, m, numbers["contexts"]) if "contexts" in numbers else None
        self.pointers = EliasFano.of("pointers", arrays, m + 1, numbers["pointers"])
        self.successors = EliasFano.of("successors", arrays, n, numbers["successors"])
        self.share = Quantiser(*numbers["share"])
        self.rest = Quantiser(*numbers["rest"])

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, count: np.ndarray, discount: float, totals: dict | None = None) -> Level:
        """From n-grams sorted by context, then word, all with a count of at least 1.

        Absolute discounting: a successor has the share (count - discount) / sum of its context's
        counts; the rest, discount * successors / sum, is left to the shorter context. ``totals`` are the sums of
        contexts that have successors elsewhere, too.
        """
        known, first, successors = np.unique(context, return_index=True, return_counts=True)
        total = np.add.reduceat(count, first).astype(np.float64) if len(known) else np.zeros(0)
        for k in np.flatnonzero(np.isin(known, list(totals))) if totals else ():
            total[k] = totals[int(known[k])]
        ends = np.concatenate([first, [len(word)]]) if len(known) else np.zeros(1, np.int64)
        return cls._of(ends, total, word, count, discount, known)

    @classmethod
    def below(cls, parent: np.ndarray, parents: int, word: np.ndarray, count: np.ndarray, discount: float) -> Level:
        """From n-grams sorted by the place of their first n - 1 words in the level above, then word."""
        parent = parent.astype(np.int64)
        ends = np.searchsorted(parent, np.arange(parents + 1))
        total = np.bincount(parent, weights=count, minlength=parents)
        return cls._of(ends, total, word, count, discount)

    @classmethod
    def _of(cls, ends, total, word, count, discount: float, contexts: np.ndarray | None = None) -> Level:
        successors = np.diff(ends)
        m, rank = len(successors), np.repeat(np.arange(len(successors), dtype=np.uint64), successors)
        share = (count - discount) / np.repeat(total, successors)
        some = successors > 0
        rest = discount * successors[some] / total[some]
        by_share, by_rest = Quantiser.over(share), Quantiser.over(rest)
        rests = np.zeros(m, np.uint16)
        rests[some] = by_rest.codes(rest)
        width = int(word.max(initial=0)).bit_length()
        sequences = {
            "pointers": EliasFano.encode(ends, len(word) + 1),
            "successors": EliasFano.encode((rank << np.uint64(width)) | word.astype(np.uint64), max(1, m) << width),
        }
        if contexts is not None:
            sequences["contexts"] = EliasFano.encode(contexts, int(contexts.max(initial=0)) + 1)
        arrays = {k: v for name, s in sequences.items() for k, v in s.parts(name).items()}
        arrays |= {"share": by_share.codes(share), "rest": rests}
        numbers = {name: s.low_bits for name, s in sequences.items()}
        numbers |= {"n": len(word), "m": m, "width": width}
        numbers |= {"share": [by_share.least, by_share.step], "rest": [by_rest.least, by_rest.step]}
        return cls(arrays, numbers)

    def to_bytes(self) -> bytes:
        return to_buffer(self.arrays, **self.numbers)

    @classmethod
    def map(cls, buffer) -> Level:
        return cls(*from_buffer(buffer))

    def context_ranks(self, contexts: np.ndarray) -> np.ndarray:
        return self.contexts.find(contexts)

    def places(self, rank: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of ``word`` after the contexts of these ranks (-1: unknown); -1 for none."""
        steps = range(0, len(rank), STEP)
        return np.concatenate([np.zeros(0, np.int64), *[self._places(rank[i : i + STEP], word[i : i + STEP]) for i in steps]])

    def _places(self, rank: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(rank), -1, np.int64)
        width = self.numbers["width"]
        at = np.flatnonzero((rank >= 0) & (word.astype(np.uint64) >> np.uint64(width) == 0))
        new = starts(rank[at])
        ranks, back = rank[at][new], np.cumsum(new) - 1
        start = self.pointers.access(ranks).astype(np.int64)[back]
        stop = self.pointers.access(ranks + 1).astype(np.int64)[back]
        x = (rank[at].astype(np.uint64) << np.uint64(width)) | word[at].astype(np.uint64)
        out[at] = self.successors.find(x, start, stop)
        return out

    def share_codes(self, place: np.ndarray) -> np.ndarray:
        """Codes of the shares at these places; 0 for none."""
        if not self.numbers["n"]:
            return np.zeros(len(place), np.uint16)
        return np.where(place >= 0, self.arrays["share"][np.maximum(place, 0)], 0).astype(np.uint16)

    def shares(self, rank: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of the shares of ``word`` after the contexts of these ranks; 0 for none."""
        return self.share_codes(self.places(rank, word))

    def successor_counts(self, rank: np.ndarray) -> np.ndarray:
        """How many successors the contexts of these ranks have; 0 for unknown ones."""
        out = np.zeros(len(rank), np.uint32)
        at = np.flatnonzero(rank >= 0)
        out[at] = self.pointers.access(rank[at] + 1) - self.pointers.access(rank[at])
        return out

    def rests(self, rank: np.ndarray) -> np.ndarray:
        """Codes of what the contexts of these ranks leave to the shorter context; 0 for unknown ones."""
        if not self.numbers["m"]:
            return np.zeros(len(rank), np.uint16)
        return np.where(rank >= 0, self.arrays["rest"][np.maximum(rank, 0)], 0).astype(np.uint16)


def trie_to_bytes(levels: list[Level]) -> bytes:
    """A trie as its levels' sizes and buffers, each on a multiple of 8 bytes."""
    parts = [level.to_bytes() for level in levels]
    return struct.pack(f"<{len(parts) + 1}Q", len(parts), *map(len, parts)) + b"".join(parts)


def map_trie(buffer) -> list[Level]:
    """The levels of a trie in ``buffer``, bytes or a memory map; nothing is copied or decoded."""
    (count,) = struct.unpack_from("<Q", buffer)
    at, levels, view = 8 * (count + 1), [], memoryview(buffer)
    for size in struct.unpack_from(f"<{count}Q", buffer, 8):
        levels.append(Level.map(view[at : at + size]))
        at += size
    return levels
