import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ridemart.llm import ngram_lm as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


class Plain:
    """The same model with dictionaries and exact probabilities."""

    def __init__(self, rows, order):
        train = [tokens(t) for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 10]
        self.order = order
        self.counts = [Counter(tuple(t[k:k + n]) for t in train for k in range(len(t) - n + 1)) for n in range(1, order + 1)]
        self.n, self.v = sum(self.counts[0].values()), len(self.counts[0])
        self.context = [Counter() for _ in range(order + 1)]
        self.types = [Counter() for _ in range(order + 1)]
        self.d = [0.0] * (order + 1)
        for n in range(2, order + 1):
            values = Counter(self.counts[n - 1].values())
            self.d[n] = min(0.95, max(0.1, values[1] / max(1, values[1] + 2 * values[2])))
            for g, c in self.counts[n - 1].items():
                self.context[n][g[:-1]] += c
                self.types[n][g[:-1]] += 1

    def p(self, gram):
        if len(gram) == 1:
            return (self.counts[0][gram] + 0.1) / (self.n + 0.1 * (self.v + 1))
        n, lower, total = len(gram), self.p(gram[1:]), self.context[len(gram)][gram[:-1]]
        if not total:
            return lower
        return max(self.counts[n - 1][gram] - self.d[n], 0) / total + self.d[n] * self.types[n][gram[:-1]] / total * lower

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(tuple(t[max(0, k - self.order + 1):k + 1]))) for k in range(len(t)))

    def base(self, text):
        return sum(math.log10(self.p((w,))) for w in tokens(text))


def check(got, rows, order, exact):
    plain = Plain(rows, order)
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(t)
    for r in got:
        texts = want[r.doc_id]
        t = min(texts, key=lambda t: abs(len(tokens(t)) - r.n_tokens))
        assert r.n_tokens == len(tokens(t)) and r.train_tokens == plain.n
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 10 == 0)
        assert r.n_known == sum(plain.counts[0][(w,)] > 0 for w in tokens(t))
        assert r.base_score == pytest.approx(plain.base(t), abs=1e-6)
        if exact:
            assert r.score == pytest.approx(plain.score(t), abs=0.01 * r.n_tokens)
            assert r.score <= plain.score(t) + 1e-6 * r.n_tokens + 0.003 * r.n_tokens


def cases():
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(40)] + ["The", "the", "É", "é,"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    return rows + [(500, None), (501, "new words only"), (502, ""), (None, "w1 w2 w3"), (3, rows[3][1]), (503, "w1 " * 2000)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_match_a_plain_model(make_docs, order):
    check(L.train_and_score(make_docs(cases()), L.LmConfig(order=order)).collect(), cases(), order, True)


def test_many_chunks_and_buckets(make_docs):
    cfg = L.LmConfig(chunk_bytes=700, slice_bytes=200, bucket_grams=300)
    many = L.train_and_score(make_docs(cases()).repartition(3), cfg).collect()
    check(many, cases(), 3, True)
    one = {(r.doc_id, r.n_tokens): r.score for r in L.train_and_score(make_docs(cases())).collect()}
    assert all(r.score == pytest.approx(one[r.doc_id, r.n_tokens], abs=1e-9) for r in many)


def other_rows():
    rng = random.Random(9)
    vocab = [f"w{k}" for k in range(0, 60, 2)] + ["THE", "unseen", "é,"]
    return [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30)))) for i in range(40)] + [(900, None), (None, "w1 w2"), (901, "unseen " * 3)]


@pytest.mark.parametrize("small", [False, True])
def test_kept_model_scores_another_table(make_docs, tmp_path, small):
    cfg = L.LmConfig(chunk_bytes=700, slice_bytes=200, bucket_grams=300) if small else L.LmConfig()
    model = (tmp_path / "model").as_uri()
    L.train(make_docs(cases()), model, cfg)
    plain = Plain(cases(), 3)
    texts = dict(other_rows())
    got = L.score(model, make_docs(other_rows()), cfg).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(tokens(t)), plain.n, sum(plain.counts[0][(w,)] > 0 for w in tokens(t)))
        assert r.base_score == pytest.approx(plain.base(t), abs=1e-6)
        assert r.score == pytest.approx(plain.score(t), abs=0.01 * r.n_tokens)
    again = {(r.doc_id, r.n_tokens): r.score for r in L.score(model, make_docs(cases()), cfg).collect()}
    for r in L.train_and_score(make_docs(cases()), cfg).collect():
        assert again[r.doc_id, r.n_tokens] == pytest.approx(r.score, abs=1e-9)
    assert L.score(model, make_docs([])).count() == 0


def test_model_without_training(make_docs, tmp_path):
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    for name, rows in (("nothing", []), ("held-out", [(out, "a b")])):
        model = (tmp_path / name).as_uri()
        L.train(make_docs(rows), model)
        r = L.score(model, make_docs([(1, "a b")])).first()
        assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 3) and r.score == pytest.approx(0.0)


def test_words_that_collide_modulo_powers_of_two(make_docs):
    word, other = "a", "b"
    while len(word) < 1024:
        word, other = word + other, other + word
    rows = [(k, f"{word} x") for k in range(6)] + [(k, f"{other} y") for k in range(6, 8)]
    check(L.train_and_score(make_docs(rows)).collect(), rows, 3, True)


def test_probabilities_of_a_context_add_up():
    """Over all words after any context, quantised alphas and lambdas give at most one, and nearly one."""
    cfg, rng = L.LmConfig(), np.random.default_rng(3)
    ids = [rng.integers(0, 9, 3000), rng.integers(0, 9, 3000), rng.integers(0, 60, 3000)]
    grams, counts = np.unique(np.column_stack(ids), axis=0, return_counts=True)
    known = L.Grams([grams[:, j] for j in range(3)], counts * (np.arange(len(counts)) % 10 > 0))
    trie = L.Trie(L.build_trie(known, cfg, 0.5), 3, cfg.code_bits)
    alpha, rest = trie.query(known.levels)
    assert ((alpha == 0) == (known.total == 0)).all()
    value = L.decode_table(cfg)
    total = np.bincount(known.levels[-1][0], weights=value[alpha]) + value[rest]
    assert total.max() <= 1 + 1e-9 and total.min() > 0.98
    other = L.Grams([np.array([1, 1]), np.array([2, 2]), np.array([999, int(grams[(grams[:, 0] == 1) & (grams[:, 1] == 2)][0, 2])])], np.ones(2))
    assert (trie.query(other.levels)[0] == 0).sum() >= 1


def test_held_out_text_is_predicted_better_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.train_and_score(docs).where("held_out").toPandas()
    assert got.score.sum() > 0.8 * got.base_score.sum() and np.isfinite(got.score).all()


def test_empty_and_no_training(make_docs):
    assert L.train_and_score(make_docs([])).count() == 0
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = L.train_and_score(make_docs([(out, "a b")])).first()
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 3) and r.base_score == pytest.approx(0.0)
