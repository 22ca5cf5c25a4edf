import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridemart.llm import elias_fano as E


@settings(max_examples=120, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**50)), min_size=1, max_size=300), st.lists(st.integers(0, 2**50), max_size=30))
def test_sequence(values, asked):
    values = np.sort(np.array(values, np.uint64))
    ef = E.EliasFano(*E.EliasFano.build(values))
    n = len(values)
    assert ef.get(np.arange(n)).tolist() == values.tolist()
    asked = np.array([*asked, *values.tolist(), *(values + np.uint64(1)).tolist()], np.uint64)
    rng = np.random.default_rng(0)
    low = rng.integers(0, n, len(asked))
    high = np.minimum(n, low + rng.integers(0, n + 1, len(asked)))
    want = np.clip(np.searchsorted(values, asked), low, high)
    at, equal = ef.successor(low, high, asked)
    assert at.tolist() == want.tolist()
    assert equal.tolist() == [p < h and values[p] == v for p, h, v in zip(want, high, asked)]


@pytest.mark.parametrize("width", [0, 1, 7, 12, 31, 33, 63])
def test_bits(width):
    values = np.random.default_rng(1).integers(0, 1 << width, 500).astype(np.uint64)
    assert E.read_bits(E.pack_bits(values, width), width, np.arange(500)).tolist() == values.tolist()


def test_level_in_a_memory_map(tmp_path):
    rng = np.random.default_rng(2)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 50, 2000), rng.integers(0, 300, 2000)) if a % 7})
    parent, ids = np.array(pairs).T
    codes = [np.arange(len(pairs)) % 4096, (np.arange(len(pairs)) * 7) % 4096]
    (tmp_path / "level").write_bytes(E.to_bytes(E.Level.build(parent, ids, 50, codes, 12)))
    level = E.Level(E.from_buffer(np.memmap(tmp_path / "level", np.uint8, "r")), 12)
    ask = [(a, b) for a in range(-1, 50) for b in range(0, 300, 3)]
    got = level.find(*np.array(ask).T)
    where = {p: k for k, p in enumerate(pairs)}
    assert got.tolist() == [where.get(p, -1) for p in ask]
    assert level.code(1, got).tolist() == [0 if k < 0 else codes[1][k] for k in got]


def test_empty_level():
    level = E.Level(E.Level.build(np.zeros(0, np.int64), np.zeros(0, np.int64), 3, [np.zeros(0, np.int64)] * 2, 12), 12)
    assert level.find(np.array([0, 2, -1]), np.array([1, 2, 3])).tolist() == [-1, -1, -1]


def test_places_are_asked_in_blocks(monkeypatch):
    """Any number and order of questions is answered block by block, as all at once."""
    rng = np.random.default_rng(4)
    pairs = np.unique(rng.integers(0, 40, (300, 2)), axis=0)
    level = E.Level(E.Level.build(pairs[:, 0], pairs[:, 1], 40, [np.arange(len(pairs), dtype=np.uint16)], 12), 12)
    context, ids = rng.integers(-1, 40, 500), rng.integers(0, 45, 500)
    places = {tuple(p): k for k, p in enumerate(pairs.tolist())}
    want = [places.get((c, i), -1) for c, i in zip(context.tolist(), ids.tolist())]
    asked, search = [], E.EliasFano.successor
    monkeypatch.setattr(E.EliasFano, "successor", lambda self, low, high, values: asked.append(len(values)) or search(self, low, high, values))
    for block in (7, 1 << 14):
        monkeypatch.setattr(E, "_BLOCK", block)
        assert level.find(context, ids).tolist() == want
        assert level.code(0, np.array(want)).tolist() == [max(k, 0) for k in want]
    assert max(asked[:-1]) <= 7 and asked[-1] > 400
