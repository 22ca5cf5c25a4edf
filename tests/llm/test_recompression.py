import hashlib
import random
import re

import numpy as np
import pytest

from ridemart.llm import recompression as R
from ridemart.llm import text as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """Rows in (doc_id, row) order; null ids last."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), []
    for k in order:
        w = WORD.findall(rows[k][1] or "")
        gone = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone |= set(range(s, s + window))
            seen.add(key)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((rows[k][0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted((tuple(r)[:4] for r in R.remove_repeats(docs, R.RecompressionConfig(**kw)).collect()), key=str)


def cases(seed=2, window=20):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)] + ["The", "the", "é,"]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        texts.append(" \n".join(parts))
    texts += ["a " * 70, "a " * 25, "a b " * 40, "b a " * 15 + "c", "a a b " * 30, "", "x", texts[0], texts[0], texts[1].replace("\n", "\t"), "a " * 19]
    rng.shuffle(texts)
    ids = rng.sample(range(1000), len(texts))
    return [*zip(ids, texts), (2000, None), (None, texts[3]), (2001, texts[3])]


@pytest.mark.parametrize("kw", [{}, {"chunk_bytes": 2500, "slice_bytes": 600, "bucket_keys": 100}, {"window": 5, "chunk_bytes": 1500}, {"rounds": 6}])
def test_matches_brute_force(make_docs, kw):
    rows = cases(window=kw.get("window", 20))
    assert run(make_docs(rows), **kw) == brute(rows, kw.get("window", 20))


def test_repeated_rows_of_one_id(make_docs):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text), (5, text), (1, "q " * 30)]
    assert run(make_docs(rows)) == brute(rows, 20)


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 20)


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(0)
    words = T.mix(rng.integers(0, 3, 5000).astype(np.uint64) + np.uint64(7))
    first = np.array([0, 1000, 1000, 1013, 5000])
    starts, keys, _ = R.window_keys(words, first, R.RecompressionConfig(window=8))
    by = {}
    for s, k in zip(starts.tolist(), keys.tolist()):
        assert by.setdefault(words[s:s + 8].tobytes(), k) == k


def test_empty_and_text(make_docs):
    assert run(make_docs([])) == []
    text = " ".join(f"w{k}" for k in range(30))
    got = {r.doc_id: r.kept for r in R.remove_repeats(make_docs([(1, text), (2, "x  " + text + " y")]), with_text=True).collect()}
    assert got == {1: text, 2: "x y"}


def thue_morse(size):
    """Two words that polynomial hashes modulo powers of two cannot tell apart."""
    word, other = "a", "b"
    while len(word) < size:
        word, other = word + other, other + word
    return word, other


def test_words_that_collide_modulo_powers_of_two(make_docs):
    word, other = thue_morse(1024)
    rows = [(k, " ".join([*(f"w{j}" for j in range(10)), w, *(f"v{j}" for j in range(12))])) for k, w in enumerate([word, other, word])]
    assert run(make_docs(rows)) == brute(rows, 20)


def test_names_decide(make_docs, monkeypatch):
    """Without the rounds' names no repeat is found between chunks."""
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"a{k} b{k} {passage} c{k}") for k in range(6)]
    kw = {"chunk_bytes": 200}
    assert run(make_docs(rows), **kw) == brute(rows, 20)
    monkeypatch.setattr(R, "_name_phrases", lambda requests: R._number(np.arange(sum(len(R.X.unsqueeze(r[0], np.uint32)) for r in requests)), [np.ones_like(R.X.unsqueeze(r[0], np.uint32)) for r in requests]))
    assert all(removed == 0 for _, _, removed, _ in run(make_docs(rows), **kw))


@pytest.mark.parametrize("hashes_differ", [True, False])
def test_rows_and_windows_are_told_apart_by_values(monkeypatch, hashes_differ):
    if not hashes_differ:  # every hash the same: only the values are left
        monkeypatch.setattr(R, "hash_columns", lambda columns: np.zeros(len(columns[0]), np.uint64))
        monkeypatch.setattr(R.T, "gram_hashes", lambda values, n: np.zeros(len(values) - n + 1, np.uint64))
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, 3, 200).astype(np.uint64) for _ in range(4)]
    _, first, back = R.distinct_rows(columns)
    rows = list(zip(*(c.tolist() for c in columns)))
    assert [rows[first[b]] for b in back] == rows and [rows.index(r) for r in rows] == first[back].tolist()
    words = rng.integers(0, 2, 120).astype(np.uint64)
    starts = np.arange(116)
    firsts, index = R.distinct_windows(words, starts, 5, (starts,))
    grams = [tuple(words[s:s + 5].tolist()) for s in starts]
    assert firsts[index].tolist() == [grams.index(g) for g in grams]


def test_frequent_anchors_and_long_texts(make_docs):
    """Anchors above the bound send windows one by one; one text is many times a chunk."""
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(40_000))
    rows = [(1, long), (2, long[1000:9000]), (3, "x " + long[20_000:21_000]), (4, None), (5, "")]
    for kw in ({"hot_class": 1, "chunk_bytes": 3000}, {"chunk_bytes": 3000, "bucket_keys": 300}):
        assert run(make_docs(rows), **kw) == brute(rows, 20)


def test_other_columns_are_not_read(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", "y"), (2, None, "x", None)], "doc_id long, text string, chunk string, kept_sha256 string")
    assert run(docs) == brute([(1, "a b c"), (2, None)], 20)


def test_windows_of_a_chunk_are_searched_a_slice_at_a_time(make_docs, tmp_path):
    import tracemalloc

    import pyarrow as pa

    from ridemart.llm import exchange as X

    rows = cases()
    assert run(make_docs(rows), slice_words=50) == brute(rows, 20)

    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 40)}" for _ in range(200)) for _ in range(500)]
    table, peaks, asked = pa.table({"doc_id": pa.array(range(500), pa.int64()), "text": pa.array(texts)}), [], []
    for slice_words in (1 << 30, 2000):
        cfg = R.RecompressionConfig(slice_words=slice_words)
        chunk, what = R._keep_chunk(cfg)(f"file://{tmp_path}", table)
        rows = list(R._ask_words(1)(what, chunk))
        for level in range(cfg.rounds + 1):  # each request comes twice, so all have names
            reduce = R._name_phrases if level else R._name_words
            told = [(X.CHUNK_ROW, rows[0][2])] if level else []
            pairs = told + [(k, reduce([X.split_parts(p)] * 2)[0]) for k, _, p in rows if k != X.CHUNK_ROW]
            if level == cfg.rounds:
                tracemalloc.start()
            rows = [(r["bucket"], r["chunk"], r["payload"]) for r in R._step(cfg, f"file://{tmp_path}", 1, level)(chunk, pairs).to_pylist()]
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        asked.append([p for k, _, p in rows if k != X.CHUNK_ROW])
    assert asked[0] == asked[1] and len(asked[0]) == 1
    assert peaks[1] < 0.75 * peaks[0], peaks
