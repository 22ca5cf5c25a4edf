import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ridemart.llm import direct_codes as C
from ridemart.llm import packing as P
from ridemart.llm import text as T
from ridemart.llm.tokens import Encoder, encoded, vocabulary

SF = "/root/testdata/sf0.001"
EDGE = [None, "", " ", "\n", "  two", "a  b", "a\n\nb", " lead", "trail ", "trail\n", "x\n y", "tab\there", "nul\x00 x", "a\x1cb c", "é ü z",
        "  x", "don't we'll 12 3.5!? #a", "<|endoftext|> x", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext", "|>", "日本 語", "w " * 3000, "a" * 5000, "\r\nq\r\n"]


@pytest.fixture(scope="module")
def direct():
    t = Tokenizer.from_file(vocabulary())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def got_ids(encoder, texts):
    data, off = T.flat(pa.array(texts, pa.string()))
    return [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(data, off)]


def test_pieces_equal_the_library(direct):
    encoder = Encoder(vocabulary(), kept_pieces=20, joined=3)
    assert got_ids(encoder, EDGE) == [direct(t) for t in EDGE]


def test_words_that_collide_modulo_powers_of_two(direct):
    word, other = "a", "b"
    while len(word) < 4096:
        word, other = word + other, other + word
    texts = [word, other, f"{word} x y", f"{other} x y", f"x\n{other}", f"x\n{word}"]
    data, off = T.flat(pa.array([word, other, word.upper()], pa.string()))
    h = T.span_hashes(data, off[:-1], off[1:])
    assert len(set(h.tolist())) == 3
    low = T.span_hashes(data, off[:-1], off[1:], lower=True)
    assert low[0] == low[2] != low[1]
    assert got_ids(Encoder(vocabulary()), texts) == [direct(t) for t in texts]


def test_pieces_of_equal_hash_are_told_apart(direct, monkeypatch):
    monkeypatch.setattr(T, "span_hashes", lambda data, starts, ends, lower=False: (ends - starts).astype(np.uint64))
    encoder = Encoder(vocabulary())
    texts = ["one two six", "ten two", "six one", "abc", "", "one"]
    for _ in range(2):
        assert got_ids(encoder, texts) == [direct(t) for t in texts]


def test_span_hashes_do_not_depend_on_the_place_and_keep_small_tables():
    from ridemart.llm.cluster import per_worker

    rng = np.random.default_rng(3)
    word = rng.integers(97, 123, 300_000).astype(np.uint8)
    data = rng.integers(97, 123, 3_000_000).astype(np.uint8)
    starts = np.array([0, 262_143, 700_000, 1_048_576, 2_699_990, 2_999_999, 3_000_000])
    for size in (0, 1, 7, 300_000):
        at = starts[starts + size <= len(data)]
        for a in at.tolist():
            data[a:a + size] = word[:size]
            assert T.span_hashes(data, np.array([a]), np.array([a + size])) == T.span_hashes(word, np.array([0]), np.array([size]))
    assert sum(v.nbytes for v in per_worker("prime_powers", dict).values()) <= 16 << 20


def test_kept_pieces_are_bounded_by_their_bytes(direct):
    encoder = Encoder(vocabulary(), kept_bytes=2000)
    for k in range(40):
        texts = [f"{k}x{i}" * 30 + " a" for i in range(10)]
        assert got_ids(encoder, texts) == [direct(t) for t in texts]
        assert len(encoder.raw) <= 2000


def test_a_batch_is_encoded_in_memory_of_a_slice(direct):
    import tracemalloc

    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(words[(i * 7 + j * j) % 3000] for j in range(400)) for i in range(4000)]
    column = pa.array(texts, pa.string())
    first = [x for _, some in encoded(column.slice(0, 5), vocabulary()) for x in some]
    assert [np.frombuffer(x, "<u4").tolist() for x in first] == [direct(t) for t in texts[:5]]
    tracemalloc.start()
    try:
        rows = sum(len(some) for _, some in encoded(column, vocabulary()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < 100 << 20


@settings(max_examples=400, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="ab \n\té'1.Ü \x1c", max_size=30), max_size=6))
def test_pieces_equal_the_library_on_any_text(texts):
    encoder = _SHARED.setdefault("e", Encoder(vocabulary()))
    assert got_ids(encoder, texts) == [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]


_SHARED: dict = {}


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700), max_size=8), st.sampled_from([8, 16]))
def test_file_round_trip_and_random_access(docs, bits):
    ids = np.array([x for d in docs for x in d], np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs], dtype=np.int64)]).astype(np.int64)
    tokens = C.TokenFile(C.pack(np.arange(len(docs)), np.ones(len(docs), bool), starts, ids, bits))
    assert tokens.all_ids().tolist() == ids.tolist()
    places = np.random.default_rng(1).permutation(len(ids))
    assert tokens.ids(places).tolist() == ids[places].tolist()
    assert [tokens.document(k).tolist() for k in range(len(docs))] == [list(d) for d in docs]


def test_damaged_file_is_refused():
    packed = bytearray(C.pack(np.array([1]), np.array([True]), np.array([0, 3]), np.array([1, 2, 3], np.uint32)))
    packed[-1] ^= 1
    with pytest.raises(ValueError):
        C.TokenFile(bytes(packed))


def reference(rows, direct):
    return [(i, [*direct(t), 2]) for i, t in rows]


def test_corpus_files(spark, make_docs, direct, tmp_path):
    rows = [(1000 - k, t) for k, t in enumerate(EDGE)] + [(None, "null id"), (7, "same"), (7, "same")]
    docs = make_docs(rows).repartition(5)
    manifest = C.write_corpus(docs, vocabulary(), 2, f"file://{tmp_path}/tokens", tokens_per_file=2000)
    assert manifest.count() > 1
    got = sorted(C.read_corpus(manifest).collect(), key=lambda r: r.start)
    want = sorted(reference(rows, direct), key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for g, (i, ids) in zip(got, want, strict=True):
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_documents_table(spark, direct):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = C.encode_corpus(spark, docs, vocabulary(), 2).toPandas().sort_values("start")
    assert got.doc_id.tolist() == [i for i, _ in rows]
    assert got.ids_crc32.tolist() == [zlib.crc32(np.array(ids, "<u4").tobytes()) for _, ids in reference(rows, direct)]
    assert got.start.tolist() == [0, *np.cumsum(got.n_tokens)[:-1]]


def test_empty_corpus(spark, make_docs):
    assert C.encode_corpus(spark, make_docs([]), vocabulary(), 2).count() == 0
    assert P.pack_documents(make_docs([]), vocabulary(), 2).count() == 0


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (19, [(0, 3), (3, 8), (11, 8)])])
def test_cut_pieces(n, want):
    assert P.cut_pieces(n, 8) == want


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 6))
def test_best_fit_matches_a_plain_search(lengths, open_bins):
    fast, spaces, n = P.BestFit(50, open_bins), {}, 0
    for length in lengths:
        fits = [s for s in spaces.values() if s >= length]
        b, offset = fast.place(length)
        if fits:
            assert spaces[b] == min(fits) and offset == 50 - spaces[b]
        else:
            assert b == n and offset == 0
            n += 1
            if len(spaces) >= open_bins:
                fullest = min(spaces.values())
                still = {x for v in fast.by_space for x in v} | {b}
                closed = [k for k in spaces if k not in still]
                assert len(closed) == 1 and spaces[closed[0]] == fullest  # any one of equally full bins
                del spaces[closed[0]]
            spaces[b] = 50
        spaces[b] -= length
        if not spaces[b]:
            del spaces[b]
        assert {x: s for s, v in enumerate(fast.by_space) for x in v} == spaces and fast.open == len(spaces) <= open_bins


def check_packed(packed, rows, direct):
    by_doc = {}
    for r in packed:
        by_doc.setdefault((r.row, r.doc_id), []).append(r)
    want = sorted(((i, tuple(ids)) for i, ids in reference(rows, direct)), key=str)
    assert len(by_doc) == len(want)
    seen = []
    for (_, i), parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        n = sum(p.length for p in parts)
        assert [(p.start, p.length) for p in parts] == P.cut_pieces(n, 1024)
        ids = next(ids for j, ids in want if j == i and len(ids) == n and all(
            zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for p in parts))
        seen.append((i, ids))
    assert sorted(seen, key=str) == want
    fill = {}
    for r in packed:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(fill), sum(r.length for r in packed)


def test_packing(make_docs, direct):
    rows = list(enumerate(EDGE)) + [(None, "null id"), (7, "same"), (7, "same")]
    check_packed(P.pack_documents(make_docs(rows), vocabulary(), 2, P.PackingConfig(lookahead=5, pieces_per_task=20)).collect(), rows, direct)


def test_packing_is_tight_and_ids_come_back(spark, direct):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    packed = P.pack_documents(docs, vocabulary(), 2)
    n, total = check_packed(packed.collect(), rows, direct)
    assert n <= 1.01 * -(-total // 1024) + 1
    some = packed.where("sequence_id % 50 = 0")
    whole = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in P.sequences(docs, some, vocabulary(), 2).collect()}
    for r in some.collect():
        assert zlib.crc32(whole[r.sequence_id][r.offset:r.offset + r.length].tobytes()) == r.ids_crc32
