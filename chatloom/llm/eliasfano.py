"""Elias-Fano sequences in numpy: sorted whole numbers in about 2 + log2(universe / n) bits each."""

from __future__ import annotations

import json
import struct

import numpy as np

_POP = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    _SELECT[_b, : _POP[_b]] = [i for i in range(8) if _b >> i & 1]
_ADD = np.uint64(0x0101010101010101)
SAMPLE = 32
TOGETHER = 8  # places read per value asked for, at most, to merge instead of searching


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of every 64-bit word."""
    parts = np.ascontiguousarray(word).view(np.uint8).reshape(-1, 8)
    # Bits up to and with each byte, all eight sums in one product.
    each = np.bitwise_count(parts).view(np.uint64).ravel()
    upto = (each * _ADD).view(np.uint8).reshape(-1, 8)
    byte = (upto <= k.astype(np.uint8)[:, None]).view(np.int8).sum(axis=1, dtype=np.int64)
    row = 8 * np.arange(len(word))
    left = k - np.where(byte > 0, upto.ravel()[row + byte - 1], 0)
    return 8 * byte + _SELECT[parts.ravel()[row + byte], left]


class Sequence:
    """Sorted distinct or repeated values; ``get`` by index, ``locate`` by value."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        pick = lambda part: arrays[f"{name}.{part}"]
        self.n, self.low_bits, self.top = (int(v) for v in pick("sizes"))
        self.low, self.high, self.ones = pick("low"), pick("high"), pick("ones").astype(np.int64)
        self.sample1, self.sample0 = pick("sample1"), pick("sample0")

    @staticmethod
    def arrays(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        """What is stored of sorted non-negative values."""
        n = len(values)
        last = int(values[-1]) if n else 0
        bits = max(0, ((last + 1) // n).bit_length() - 1) if n else 0
        high = values >> bits
        top = int(high[-1]) if n else 0
        upper = np.zeros(-(-(n + top + 2) // 64) * 64, bool)
        upper[high + np.arange(n)] = True
        words = np.packbits(upper, bitorder="little").view(np.uint64)
        ones = np.zeros(len(words) + 1, np.uint32)
        np.cumsum(np.bitwise_count(words), out=ones[1:])
        at_ones, at_zeros = np.flatnonzero(upper)[::SAMPLE], np.flatnonzero(~upper)[::SAMPLE]
        low = np.zeros(0, bool)
        if bits:
            low = (values[:, None] >> np.arange(bits) & 1).astype(bool).ravel()
        padded = np.zeros((-(-len(low) // 64) + 1) * 64, bool)
        padded[: len(low)] = low
        made = {
            "sizes": np.array([n, bits, top], np.int64),
            "low": np.packbits(padded, bitorder="little").view(np.uint64),
            "high": words,
            "ones": ones,
            "sample1": (at_ones >> 6).astype(np.uint32),
            "sample0": (at_zeros >> 6).astype(np.uint32),
        }
        return {f"{name}.{part}": a for part, a in made.items()}

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.int64)
        bit = at * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> shift
        # The rest stands in the next word; a shift by 64 is done as two.
        value |= (self.low[word + 1] << (np.uint64(63) - shift)) << np.uint64(1)
        return (value & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one, or zero, in the upper bits."""
        ones = self.ones
        before = (lambda w: ones[w]) if one else (lambda w: 64 * w - ones[w])
        sample = self.sample1 if one else self.sample0
        # The word lies between those of the sampled bits before and after; runs can be long.
        word = sample[k // SAMPLE].astype(np.int64)
        last = sample[np.minimum(k // SAMPLE + 1, len(sample) - 1)].astype(np.int64)
        last[k // SAMPLE + 1 >= len(sample)] = len(self.high) - 1
        todo = np.flatnonzero(word < last)
        while len(todo):
            mid = (word[todo] + last[todo] + 1) >> 1
            here = before(mid) <= k[todo]
            word[todo[here]] = mid[here]
            last[todo[~here]] = mid[~here] - 1
            todo = todo[word[todo] < last[todo]]
        bits = self.high[word] if one else ~self.high[word]
        return 64 * word + _select_in_word(bits, k - before(word))

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self._select(at, True) - at) << self.low_bits) | self._lows(at)

    def locate(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, or -1: the successor among the values of equal upper bits."""
        out = np.full(len(values), -1, np.int64)
        ask = np.flatnonzero((values >= 0) & (values >> self.low_bits <= self.top)) if self.n else np.zeros(0, np.int64)
        if not len(ask):
            return out
        upper = values[ask] >> self.low_bits
        wanted = values[ask] & ((1 << self.low_bits) - 1)
        # Neighbours with equal upper bits share a bucket, whose ends are looked up once.
        first = np.flatnonzero(np.r_[True, upper[1:] != upper[:-1]])
        bucket = upper[first]
        begin, past = np.zeros(len(first), np.int64), bucket > 0
        begin[past] = self._select(bucket[past] - 1, False) - (bucket[past] - 1)
        end = self._select(bucket, False) - bucket
        asked = np.diff(np.r_[first, len(upper)])
        held = np.maximum(end - begin, 0)
        if held.sum() <= TOGETHER * len(ask):
            # The buckets hold about as much as is asked for: read them whole and merge.
            of = np.repeat(np.arange(len(first)), held)
            at = np.arange(len(of)) + np.repeat(begin - (np.cumsum(held) - held), held)
            there = (of << self.low_bits) | self._lows(at)
            asked_for = (np.repeat(np.arange(len(first)), asked) << self.low_bits) | wanted
            place = np.searchsorted(there, asked_for)
            found = np.flatnonzero(place < len(there))
            found = found[there[place[found]] == asked_for[found]]
            out[ask[found]] = at[place[found]]
            return out
        lo, end = np.repeat(begin, asked), np.repeat(end, asked)
        # Those still searched: where they stand, and between which places.
        todo = np.flatnonzero(lo < end)
        left, right, goal = lo[todo], end[todo], wanted[todo]
        while len(todo):
            mid = (left + right) >> 1
            less = self._lows(mid) < goal
            left, right = np.where(less, mid + 1, left), np.where(less, right, mid)
            ended = left == right
            lo[todo[ended]] = left[ended]
            more = ~ended
            todo, left, right, goal = todo[more], left[more], right[more], goal[more]
        found = np.flatnonzero(lo < end)
        found = found[self._lows(lo[found]) == wanted[found]]
        out[ask[found]] = lo[found]
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """All arrays in one blob: a JSON table of what stands where, then the arrays."""
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 8) % 8)
    parts = [struct.pack("<Q", len(head)), head]
    for a in arrays.values():
        parts += [a.tobytes(), b"\0" * (-a.nbytes % 8)]
    return b"".join(parts)


def from_buffer(data: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the arrays of a blob, which may be a memory map of bytes."""
    # A plain array over the same memory: taking from a memory map's own class costs more.
    data = data.view(np.ndarray)
    (size,) = struct.unpack("<Q", data[:8].tobytes())
    places = json.loads(data[8 : 8 + size].tobytes())
    out = {}
    for name, (kind, n, at) in places.items():
        kind = np.dtype(kind)
        begin = 8 + size + at
        out[name] = data[begin : begin + n * kind.itemsize].view(kind)
    return out
