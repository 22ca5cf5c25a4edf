"""Vectorised text helpers for Arrow batches: word bounds and 64-bit hashes.

All functions work on one flat byte buffer plus document offsets, so a batch of
documents costs a fixed number of numpy passes.  Hashes are pure functions of
the bytes: every task derives the same value without any exchange.  Spans are
hashed modulo a prime (polynomials modulo a power of two collide on some
words whatever their base); where equal hashes alone would decide a result,
the caller compares the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ridemart.llm.cluster import per_worker

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64 (or of the inverse), grown on demand and kept per worker."""
    kept = per_worker("powers", dict)
    have = kept.get(inverse)
    if have is None or len(have) < n:
        steps = np.full(1 << max(16, (n - 1).bit_length()), _INVERSE if inverse else _BASE, np.uint64)
        steps[0] = 1
        have = kept[inverse] = np.multiply.accumulate(steps)
    return have[:n]


#: The prime that spans are hashed by, and the bases of their two polynomials.
_PRIME = np.uint64((1 << 31) - 1)
_BLOCK = 1 << 14
#: Powers are kept for this many places; further places are a multiple of it and one of these.
_PAGE = 1 << 18
_PRIME_BASES = (1_482_396_571, 737_215_909)
_PRIME_CODES = [(mix(_BYTE_CODES + np.uint64(k)) % (_PRIME - np.uint64(1)) + np.uint64(1)) for k in (1, 2)]
_LOWER_CODES = [np.concatenate([c[:65], c[97:123], c[91:]]) for c in _PRIME_CODES]


def prime_powers(base: int) -> np.ndarray:
    """base^0 .. base^(_PAGE-1) modulo the prime, kept per worker."""
    kept = per_worker("prime_powers", dict)
    if base not in kept:
        have = np.ones(1, np.uint64)
        while len(have) < _PAGE:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), int(_PRIME))) % _PRIME])
        kept[base] = have
    return kept[base]


def _page_powers(n: int, base: int) -> np.ndarray:
    """The power of base at the first place of every page of ``n`` places."""
    step, out = pow(base, _PAGE, int(_PRIME)), [1]
    for _ in range((n - 1) // _PAGE):
        out.append(out[-1] * step % int(_PRIME))
    return np.array(out, np.uint64)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), off - off[:1]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, size: int):
    """Yield (first, last) row ranges of at most ``size`` bytes (one row at least)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each row's first word (n+1 entries)."""
    n = len(data)
    inside = ~SPACES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span: two polynomials over random byte codes modulo a prime, then mixed."""
    out = np.zeros(len(starts), np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    for base, codes in zip(_PRIME_BASES, _LOWER_CODES if lower else _PRIME_CODES):
        steps, pages = prime_powers(base), _page_powers(len(data), base)
        for a in range(0, len(data), _BLOCK):  # blocks that stay in the processor's cache
            if a % _PAGE == 0:
                paged = codes * pages[a // _PAGE] % _PRIME
            terms = paged[data[a:a + _BLOCK]]
            terms *= steps[a % _PAGE:][:len(terms)]
            carry = terms >> np.uint64(31)
            terms &= _PRIME
            terms += carry  # below 2^32
            terms[0] += sums[a]
            np.cumsum(terms, out=sums[a + 1:a + 1 + len(terms)])
        inverse = pow(base, -1, int(_PRIME))
        part = sums[ends]
        part -= sums[starts]
        part %= _PRIME
        part *= prime_powers(inverse)[starts & (_PAGE - 1)]
        part %= _PRIME
        if len(data) > _PAGE:
            part *= _page_powers(len(data) + 1, inverse)[starts // _PAGE]
            part %= _PRIME
        out <<= np.uint64(31)
        out |= part
    return mix(out)


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values (row bounds are the caller's business)."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    m = len(values) - n + 1
    if n <= 8:
        total = np.zeros(m, np.uint64)
        weights = powers(n + 1)[1:]
        for k in range(n):
            total += values[k:k + m] * weights[k]
        return mix(total)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * powers(len(values)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(m, inverse=True))


def gram_rows(word_first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask over the ``total - n + 1`` gram starts: True where the gram stays in its row."""
    ok = np.ones(max(0, total - n + 1), bool)
    for back in range(1, n):
        cut = word_first[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    return ok


def row_of(word_first: np.ndarray) -> np.ndarray:
    """Row number of every word."""
    return np.repeat(np.arange(len(word_first) - 1), np.diff(word_first))


def unique_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``np.unique`` with first places and inverse for keys below ``2**bits``.

    Keys and places share one word where they fit, so that a plain sort of
    numbers does it, which is several times faster than sorting places.
    """
    n = len(keys)
    place_bits = max(1, (n - 1).bit_length()) if n else 1
    if bits + place_bits > 64:
        return np.unique(keys, return_index=True, return_inverse=True)
    packed = (keys.astype(np.uint64) << np.uint64(place_bits)) | np.arange(n, dtype=np.uint64)
    packed.sort()
    place = (packed & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    packed >>= np.uint64(place_bits)
    head = np.ones(n, bool)
    head[1:] = packed[1:] != packed[:-1]
    back = np.empty(n, np.int64)
    back[place] = np.cumsum(head) - 1
    return packed[head].astype(keys.dtype), place[head], back


def unique_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes and the inverse: sorted by their upper bits, unless those collide."""
    n = len(hashes)
    place_bits = max(1, (n - 1).bit_length()) if n else 1
    mask = np.uint64((1 << place_bits) - 1)
    packed = (hashes & ~mask) | np.arange(n, dtype=np.uint64)
    packed.sort()
    place = (packed & mask).astype(np.int64)
    ordered = hashes[place]
    head = np.ones(n, bool)
    head[1:] = ordered[1:] != ordered[:-1]
    distinct = ordered[head]
    if (distinct[1:] <= distinct[:-1]).any():  # two hashes with equal upper bits
        return np.unique(hashes, return_inverse=True)
    back = np.empty(n, np.int64)
    back[place] = np.cumsum(head) - 1
    return distinct, back
