import hashlib
import random

import numpy as np
import pytest

from ridemart.llm import induced_sort as I
from ridemart.llm import suffix_dedup as S


def brute(rows, length=50):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for i, t in order:
        raw = (t or "").encode()
        for s in range(len(raw) - length + 1):
            first.setdefault(raw[s:s + length], i if i is not None else 1 << 62)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 2, bool)
        for s in range(len(raw) - length + 1):
            if first[raw[s:s + length]] < (i if i is not None else 1 << 62):
                gone[s + 1:s + length + 1] = True
        mine = gone[1:-1]
        kept = bytes(b for b, g in zip(raw, mine) if not g)
        out.append((i, len(raw), int(mine.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted((tuple(r)[:5] for r in S.remove_repeats(docs, S.SuffixConfig(**kw)).collect()), key=str)


def cases():
    rng = random.Random(8)
    letters = "abcé ñ\n"
    passages = ["".join(rng.choice(letters) for _ in range(rng.randint(40, 160))) for _ in range(8)]
    texts = []
    for _ in range(70):
        texts.append("".join(rng.choice(passages)[rng.randint(0, 20):] if rng.random() < 0.6 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
                             for _ in range(rng.randint(1, 4))))
    texts += ["a" * 49, "a" * 50, "a" * 400, "ab" * 300, "x" + "ab" * 200, "", "é" * 25, "\x00" * 60, "\x00" * 70, texts[0], texts[0], texts[1] + "!", "日本語" * 20]
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return [*zip(ids, texts), (20_000, None), (None, texts[4]), (None, texts[4]), (ids[2], texts[2]), (20_001, texts[2])]


@pytest.mark.parametrize("kw", [{}, {"chunk_bytes": 3000, "slice_bytes": 500, "bucket_keys": 50, "shard_text_bytes": 2000, "segment_windows": 40, "sort_memory": 4000}])
def test_matches_brute_force(make_docs, kw):
    assert run(make_docs(cases()), **kw) == brute(cases())


def test_common_phrase_between_other_neighbours_is_spread(make_docs, monkeypatch):
    rng = random.Random(5)
    noise = lambda n: "".join(chr(rng.randrange(0x21, 0x7F)) for _ in range(n))
    passages = [noise(70) for _ in range(40)]
    rows = [(i, noise(35) + "the most common phrase of all, to be" + noise(35) + passages[i % 40]) for i in range(400)]
    docs, loads, answer = make_docs(rows), [], S.X.answer

    def spied(requests, *a, **kw):
        if kw.get("pass_chunks"):
            sums = requests.where("bucket >= 0").selectExpr("bucket", "length(payload) as n").groupBy("bucket").sum("n").collect()
            loads.extend(r[1] for r in sums)
        return answer(requests, *a, **kw)

    monkeypatch.setattr(S.X, "answer", spied)
    assert run(docs, shard_text_bytes=4000) == brute(rows)
    assert max(loads) < 2 * sum(loads) / len(loads)  # 2.9 times the mean without a split


def test_other_lengths(make_docs):
    assert run(make_docs(cases()), length=30, gram=8) == brute(cases(), 30)


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_empty_and_cut_texts(make_docs):
    assert run(make_docs([])) == []
    passage = "é" * 20 + "0123456789" * 4
    docs = make_docs([(1, passage), (2, "head " + passage + " tail"), (3, None), (4, "é" + "é" * 25)]).selectExpr("*", "doc_id as spans")
    got = {r.doc_id: r.text for r in S.cut_documents(docs).collect()}
    assert got == {1: passage, 2: "head  tail", 3: None, 4: "é" * 26}
    assert S.cut_documents(docs).columns == docs.columns


def suffixes(body, depth, **kw):
    text = np.append(np.append(np.array(body, np.uint8), 1), 0).astype(np.uint8)
    raw = text.tobytes() + bytes(I.PADDING)
    got = list(I.sorted_suffixes(text, depth, **kw))
    positions, common = (np.concatenate([g[k] for g in got]).tolist() for k in (0, 1))
    assert sorted(positions) == list(range(len(text)))
    prefixes = [raw[p:p + depth] for p in positions]
    assert prefixes == sorted(prefixes, reverse=True)
    for a, b, c in zip(prefixes, prefixes[1:], common[1:]):
        assert c == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), depth)


@pytest.mark.parametrize("kw", [{}, {"memory": 600, "block": 7}])
def test_induced_sorting_matches_plain_sorting(kw):
    rng = np.random.default_rng(0)
    for _ in range(60):
        suffixes(rng.integers(0, rng.integers(2, 5), rng.integers(0, 250)), int(rng.integers(1, 60)), **kw)
    suffixes([2] * 500, 50, **kw)
    suffixes([2, 3] * 200, 50, **kw)
    suffixes([200, 0, 0, 245, 0] * 30, 50, **kw)


def test_small_memory_spills_and_sorts_a_larger_text(spark):
    raw = "\n".join(r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(100).collect()).encode()
    text = np.append(np.frombuffer(raw, np.uint8) + 1, 0).astype(np.uint8)
    one, two = ([np.concatenate(c) for c in zip(*I.sorted_suffixes(text, 50, memory=m))] for m in (1 << 30, 1 << 16))
    assert (one[1] == two[1]).all() and (np.sort(two[0]) == np.arange(len(text))).all()


def thue_morse(size):
    """Two words that polynomial hashes modulo powers of two cannot tell apart."""
    word, other = "a", "b"
    while len(word) < size:
        word, other = word + other, other + word
    return word, other


def test_texts_that_collide_modulo_powers_of_two(make_docs):
    word, other = thue_morse(1024)
    rows = [(1, word), (2, other), (3, word), (4, other + "!")]
    assert run(make_docs(rows)) == brute(rows)
