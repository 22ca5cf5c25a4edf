"""Token ids of whole texts by a public byte-level BPE vocabulary (the ``tokenizers`` library).

Natural text repeats its words, so the library is asked for each distinct piece
of a batch once, and every worker keeps the ids of the pieces it has met.  A
piece starts where the vocabulary's pre-tokeniser always starts a new token: at
a single space after a non-space, at and after a single newline, and at ASCII
punctuation after a letter.  So the ids of the pieces in a row are exactly the
ids of the text.  Texts with runs of white space, with white space other than
space and newline, or with the string of an added token of the vocabulary go to
the library whole.

Pieces are looked up by a 64-bit hash of their bytes and length, and their
bytes are compared with those that the ids are of; a text with a piece of equal
hash and other bytes goes to the library whole.

Edge cases: a null text is empty; an empty text has no ids; a text of any length
is encoded as a whole, by the memory of its own size.
"""

from __future__ import annotations

import os

import numpy as np

from ridemart.llm import text as T
from ridemart.llm.cluster import per_worker

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[10, 32]] = True
#: Bytes that are, or may begin, other white space (UTF-8).
_ODD = np.zeros(256, bool)
_ODD[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _odd_space(data: np.ndarray) -> np.ndarray:
    """Places of white space other than space and newline."""
    at = np.flatnonzero(_ODD[data])
    second, third = (np.where(at + k < len(data), data[np.minimum(at + k, len(data) - 1)], 0) for k in (1, 2))
    first = data[at]
    yes = first < 32
    yes |= (first == 0xC2) & ((second == 0x85) | (second == 0xA0))
    yes |= (first == 0xE1) & (second == 0x9A) & (third == 0x80)
    yes |= (first == 0xE2) & (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
    yes |= (first == 0xE2) & (second == 0x81) & (third == 0x9F)
    yes |= (first == 0xE3) & (second == 0x80) & (third == 0x80)
    return at[yes]


def _letters(data: np.ndarray) -> np.ndarray:
    """True on the last byte of an ASCII or Latin-1 letter."""
    out = _ASCII_LETTER[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    out[latin[(data[latin] != 0x97) & (data[latin] != 0xB7)]] = True
    return out


class Encoder:
    """Texts to ids; ``kept_pieces`` and ``kept_bytes`` (of their texts) bound the memory of the piece table."""

    def __init__(self, path: str, kept_pieces: int = 1_500_000, joined: int = 2000, kept_bytes: int = 24 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.kept_pieces, self.joined, self.kept_bytes = kept_pieces, joined, kept_bytes
        # Pieces may be encoded in one go, one per line, when a newline is one id of its own.
        newline = self._whole(["\n"])[0]
        self.newline = int(newline[0]) if len(newline) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.at = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int32)
        self.raw = np.zeros(0, np.uint8)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, ids per piece)."""
        ids = self._whole([b"\n".join(pieces).decode()])[0]
        at = np.flatnonzero(ids == self.newline)
        if len(at) != len(pieces) - 1:
            parts = self._whole([p.decode() for p in pieces])
            return np.concatenate(parts), np.array([len(p) for p in parts])
        return np.delete(ids, at), np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        ids, sizes = [], []
        lines = [p for p in pieces if p != b"\n"]
        for a in range(0, len(lines), self.joined):
            got = self._lines(lines[a:a + self.joined])
            ids.append(got[0])
            sizes.append(got[1])
        size = np.concatenate([*sizes, np.zeros(0, np.int64)])
        if len(lines) < len(pieces):
            at = pieces.index(b"\n")
            size = np.insert(size, at, 1)
            flat = np.concatenate([*ids, np.zeros(0, np.uint32)])
            ids = [np.insert(flat, int(size[:at].sum()), self.newline)]
        first = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *ids]).astype(np.uint32, copy=False)
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.first = np.insert(self.first, place, first)
        self.size = np.insert(self.size, place, size)
        length = np.array([len(p) for p in pieces], np.int64)
        self.at = np.insert(self.at, place, len(self.raw) + np.cumsum(length) - length)
        self.length = np.insert(self.length, place, length)
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(pieces), np.uint8)])

    def _others(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Pieces whose bytes are not those of the known piece at their place (pieces follow one another without a gap)."""
        length = ends - starts
        wrong = self.length[place] != length
        known = np.repeat(np.where(wrong, 0, self.at[place]) - starts, length) + np.arange(len(data))
        differs = np.flatnonzero(self.raw[np.minimum(known, len(self.raw) - 1)] != data)
        wrong[np.searchsorted(starts, differs, "right") - 1] = True
        return np.flatnonzero(wrong)

    def _plain(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, id offsets, rows whose ids are not right) of texts without odd white space."""
        blank = _BLANK[data]
        begins = blank.copy()
        begins[1:] |= data[:-1] == 10
        begins[1:] |= _letters(data)[:-1] & _PUNCTUATION[data[1:]]
        begins[off[:-1][off[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        hashes = T.mix(T.span_hashes(data, starts, ends) + (ends - starts).astype(np.uint64))
        keys, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.kept_pieces or len(self.raw) + int((ends - starts)[at].sum()) > self.kept_bytes:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        fresh[inside] = self.keys[place[inside]] != keys[inside]
        if fresh.any():
            raw = data.tobytes()
            self._learn(keys[fresh], [raw[a:b] for a, b in zip(starts[at[fresh]].tolist(), ends[at[fresh]].tolist())])
            place = np.searchsorted(self.keys, keys)
        place = place[back]
        wrong = np.unique(np.searchsorted(off, starts[self._others(data, starts, ends, place)], "right") - 1)
        size = self.size[place]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.ids[np.repeat(self.first[place] - (stop - size), size) + np.arange(total)]
        return ids, np.concatenate([[0], stop])[np.searchsorted(starts, off)], wrong

    def _with_added(self, data: np.ndarray) -> list[int]:
        """Places of added tokens' strings."""
        raw, out = data.tobytes(), []
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                out.append(at)
                at = raw.find(token, at + 1)
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> list[bytes]:
        """The ids of every text of a slice (bytes and offsets), as little-endian uint32."""
        n = len(off) - 1
        blank = _BLANK[data]
        odd = np.zeros(n, bool)
        if self.newline is None:
            odd[:] = True
        else:
            runs = np.flatnonzero(blank[1:] & blank[:-1])
            row = np.searchsorted(off, runs, "right") - 1
            odd[row[off[row + 1] > runs + 1]] = True
            odd[np.searchsorted(off, _odd_space(data), "right") - 1] = True
            odd[np.searchsorted(off, self._with_added(data), "right") - 1] = True  # (one that spans two rows only costs time)
        size = np.diff(off)
        out: list[bytes] = [b""] * n
        whole = np.flatnonzero(odd & (size > 0)).tolist()
        plain = np.flatnonzero(~odd)
        kept, cut = (data[np.repeat(~odd, size)], np.concatenate([[0], np.cumsum(size[~odd])])) if odd.any() else (data, off)
        if len(kept):
            ids, cuts, wrong = self._plain(kept, cut)
            raw, cuts = ids.astype("<u4", copy=False).tobytes(), (cuts * 4).tolist()
            for k, a, b in zip(plain.tolist(), cuts, cuts[1:]):
                out[k] = raw[a:b]
            whole += plain[wrong].tolist()
        for k, ids in zip(whole, self._whole([data[off[k]:off[k + 1]].tobytes().decode() for k in whole])):
            out[k] = ids.astype("<u4", copy=False).tobytes()
        return out


def encoder(path: str) -> Encoder:
    return per_worker("encoder:" + path, lambda: Encoder(path))


def encoded(column, path: str, slice_bytes: int = 1 << 20):
    """Yield (first row, ids of its rows) over a text column, a slice at a time."""
    library = encoder(path)
    data, off = T.flat(column)
    for a, b in T.slices(off, slice_bytes):
        yield a, library.encode(data[off[a]:off[b]], off[a:b + 1] - off[a])
