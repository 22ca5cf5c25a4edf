"""Elias-Fano sequences with vectorised access, and n-gram trie levels built of them.

A non-decreasing sequence keeps the low bits of its values packed and the high
bits in unary, with the set bits before each word of the unary part as a rank
directory.  Arrays lie one after the other in one file and are used straight
from a memory map.

A trie level has the children of all contexts in a row.  ``pointers`` (one
sequence) gives each context's range; ``keys`` (another) holds the child ids,
each raised by the last value before its range so that the whole level is
non-decreasing.  A child is found by a successor search relative to its
context: the first value at or above base + id, inside the range.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


_LOW8, _HIGH8 = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Place of the (k+1)-th set bit of a byte, by k and byte.
_IN_BYTE = np.array([[next((i for i in range(8) if v >> i & 1 and bin(v & ((1 << i) - 1)).count("1") == k), 0) for v in range(256)] for k in range(8)],
                    np.int64).ravel()


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the (k+1)-th set bit of each word: the byte by sums of all bytes at once, then a table."""
    k = k.astype(np.uint64)
    sums = words - (words >> _ONE & np.uint64(0x5555555555555555))
    sums = (sums & np.uint64(0x3333333333333333)) + (sums >> np.uint64(2) & np.uint64(0x3333333333333333))
    sums = ((sums + (sums >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _LOW8
    place = np.bitwise_count(((k * _LOW8 | _HIGH8) - sums) & _HIGH8).astype(np.uint64) << np.uint64(3)
    place = np.minimum(place, np.uint64(56))
    rank = k - (sums << np.uint64(8) >> place & np.uint64(0xFF))
    byte = words >> place & np.uint64(0xFF)
    return place.astype(np.int64) + _IN_BYTE[((rank << np.uint64(8)) | byte).astype(np.int64)]


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits in 64-bit words (one spare word at the end)."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        values = values.astype(np.uint64)
        # Words are filled in order; the values that begin in a word lie together.
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[heads]] |= np.bitwise_or.reduceat(values << shift, heads)
        over = np.flatnonzero(shift.astype(np.int64) + width > 64)
        words[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return words


def read_bits(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.int64) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    value = words[word] >> shift
    spill = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (value | spill) & np.uint64((1 << width) - 1)


class EliasFano:
    """``EliasFano(*EliasFano.build(values))``; all arrays may be memory-mapped."""

    @staticmethod
    def build(values: np.ndarray) -> list[np.ndarray]:
        values = values.astype(np.uint64, copy=False)
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(high[-1]) if n else 0) // 64 * 8 + 16, np.uint8)
        np.bitwise_or.at(bits, high >> 3, (1 << (high & 7)).astype(np.uint8))
        words = bits.view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint32)]).astype(np.uint32)
        return [np.array([n, width], np.uint64), pack_bits(values & np.uint64((1 << width) - 1), width), words, ones]

    def __init__(self, head, low, high, ones):
        self.n, self.width = int(head[0]), int(head[1])
        self.low, self.high, self.ones = low, high, ones
        self.zeros = None

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at places."""
        at = at.astype(np.int64)
        word = np.searchsorted(self.ones, at.astype(np.uint32), "right") - 1
        place = (word << 6) + _select_in_word(self.high[word], at - self.ones[word])
        return ((place - at).astype(np.uint64) << np.uint64(self.width)) | read_bits(self.low, self.width, at)

    def successor(self, low: np.ndarray, high: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place in [low, high) whose value is at least the asked one, else high; is it equal?).

        The values with the asked upper part are the set bits between two zeros
        of the unary part; their low bits are searched by halving.
        """
        upper = (values >> np.uint64(self.width)).astype(np.int64)
        rest = values & np.uint64((1 << self.width) - 1)
        if self.zeros is None:
            self.zeros = (np.arange(len(self.ones), dtype=np.int64) << 6) - self.ones.astype(np.int64)
        beyond = upper > int(self.zeros[-1])
        want = np.where(beyond, 0, np.maximum(upper - 1, 0))
        word = np.searchsorted(self.zeros, want, "right") - 1
        bit = (word << 6) + _select_in_word(~self.high[word], want - self.zeros[word]) + 1
        bit[upper == 0] = 0
        begin = np.where(beyond, self.n, bit - np.where(upper > 0, upper, 0))
        stop = np.where(beyond, self.n, begin)
        todo = np.flatnonzero(~beyond & (begin < self.n))
        bit = bit[todo]
        while len(todo):
            shift = (bit & 63).astype(np.uint64)
            zero = ~(self.high[bit >> 6] >> shift)
            run = np.minimum(np.bitwise_count((zero & (~zero + _ONE)) - _ONE).astype(np.int64), 64 - (bit & 63))
            stop[todo] += run
            bit += run
            more = (bit & 63 == 0) & (run > 0) & (stop[todo] < self.n)
            todo, bit = todo[more], bit[more]
        at, end = np.clip(begin, low, high), np.clip(stop, low, high)
        limit = end.copy()
        todo = np.flatnonzero(at < end)
        while len(todo):
            middle = (at[todo] + end[todo]) >> 1
            ahead = read_bits(self.low, self.width, middle) < rest[todo]
            at[todo[ahead]] = middle[ahead] + 1
            end[todo[~ahead]] = middle[~ahead]
            todo = todo[at[todo] < end[todo]]
        equal = at < limit
        some = np.flatnonzero(equal)
        equal[some] = read_bits(self.low, self.width, at[some]) == rest[some]
        return at, equal


#: Places asked at once; what a search reads and writes for so many stays in a core's cache.
_BLOCK = 1 << 14


def _in_blocks(ask, out: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    for a in range(0, len(out), _BLOCK):
        out[a:a + _BLOCK] = ask(*(c[a:a + _BLOCK] for c in columns))
    return out


class Level:
    """Children of every context: pointers, relative ids, and two columns of codes."""

    @staticmethod
    def build(parent: np.ndarray, ids: np.ndarray, n_parents: int, codes: list[np.ndarray], code_bits: int) -> list[np.ndarray]:
        counts = np.bincount(parent, minlength=n_parents)
        stops = np.cumsum(counts)
        # base of a context: the last value before its range
        last = np.zeros(n_parents, np.uint64)
        some = np.flatnonzero(counts)
        last[some] = ids[stops[some] - 1].astype(np.uint64)
        base = np.concatenate([[np.uint64(0)], np.cumsum(last, dtype=np.uint64)[:-1]]) if n_parents else np.zeros(0, np.uint64)
        return [*EliasFano.build(np.concatenate([[0], stops])), *EliasFano.build(base[parent] + ids.astype(np.uint64)),
                *(pack_bits(c, code_bits) for c in codes)]

    def __init__(self, arrays: list[np.ndarray], code_bits: int):
        self.pointers, self.keys, self.codes, self.code_bits = EliasFano(*arrays[:4]), EliasFano(*arrays[4:8]), arrays[8:], code_bits

    def find(self, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Place of each child id under its context, or -1; an unknown context is -1 too."""
        out = np.full(len(context), -1, np.int64)
        return _in_blocks(self._find, out, context, ids) if self.keys.n else out

    def _find(self, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(context), -1, np.int64)
        known = np.flatnonzero(context >= 0)
        owners = context[known]
        if not len(owners):
            return out
        head = np.ones(len(owners), bool)  # neighbours mostly ask under one context
        head[1:] = owners[1:] != owners[:-1]
        owners, back = owners[head], np.cumsum(head) - 1
        low, high = self.pointers.get(owners).astype(np.int64), self.pointers.get(owners + 1).astype(np.int64)
        base = np.where(low > 0, self.keys.get(np.maximum(low - 1, 0)), np.uint64(0))
        value = base[back] + ids[known].astype(np.uint64)
        at, equal = self.keys.successor(low[back], high[back], value)
        out[known[equal]] = at[equal]
        return out

    def code(self, column: int, at: np.ndarray) -> np.ndarray:
        """Codes at places; 0 (nothing) where the place is -1."""
        def ask(at: np.ndarray) -> np.ndarray:
            return np.where(at >= 0, read_bits(self.codes[column], self.code_bits, np.maximum(at, 0)), np.uint64(0))

        return _in_blocks(ask, np.zeros(len(at), np.uint64), at)


def to_bytes(arrays: list[np.ndarray]) -> bytes:
    """Count, then kind and size of every array, then the arrays, each at a multiple of 8 bytes."""
    kinds = {np.dtype(np.uint32): 4, np.dtype(np.uint64): 8}
    head = np.array([len(arrays), *(x for a in arrays for x in (kinds[a.dtype], len(a)))], "<u8").tobytes()
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


def from_buffer(data: np.ndarray) -> list[np.ndarray]:
    """Views into a byte array, such as a memory map."""
    data = np.asarray(data)
    n = int(data[:8].view("<u8")[0])
    head = data[8:8 + 16 * n].view("<u8").astype(np.int64).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for width, size in head.tolist():
        out.append(data[at:at + width * size].view({4: "<u4", 8: "<u8"}[width]))
        at += -(-width * size // 8) * 8
    return out
