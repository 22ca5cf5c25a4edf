import random
import re

import pytest

from ridemart.llm import ngram_jaccard as J
from ridemart.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text):
    w = tuple(WORD.findall((text or "").translate(LOWER)))
    return {w[i:i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else {w} - {()}


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    by_token = {}
    for k, s in enumerate(sets):
        for t in s:
            by_token.setdefault(t, []).append(k)
    seen = set()
    for ks in by_token.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    inter = len(sets[a] & sets[b])
                    if 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter):
                        group[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def run(docs, **kw):
    return sorted((tuple(r) for r in J.near_duplicates(docs, J.JaccardConfig(**kw)).collect()), key=str)


def family(rng, base, n, low, high):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(low, high)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def cases():
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(400)]
    base = [rng.choice(vocab) for _ in range(120)]
    other = [rng.choice(vocab) for _ in range(60)]
    passage = " ".join(rng.choice(vocab) for _ in range(30))
    texts = family(rng, base, 60, 0, 6) + family(rng, other, 20, 0, 3)
    chain = list(base[:60])
    for k in range(12):  # linked only from neighbour to neighbour
        chain = chain[1:] + [f"c{k}"]
        texts.append(" ".join(chain))
    texts += [passage + " " + " ".join(f"u{k}_{j}" for j in range(rng.randint(3, 40))) for k in range(40)]
    texts += ["", "a", "A", "a b c", "a b C", "a b c d e", "a b c d e f", "\x85 \x1c x", texts[0], texts[0].upper(), "z " * 500, "z " * 400]
    rng.shuffle(texts)
    return [*enumerate(texts), (3, texts[3]), (None, texts[5]), (900, None), (None, "only null id here ok"), (901, " \n ")]


@pytest.mark.parametrize("kw", [{}, {"chunk_bytes": 3000, "block": 7, "bucket_tokens": 300, "slice_bytes": 700}, {"orders": 1}])
def test_matches_brute_force(make_docs, kw):
    rows = cases()
    assert run(make_docs(rows).repartition(3), **kw) == brute(rows)


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_empty_and_kept(make_docs):
    assert run(make_docs([])) == []
    docs = make_docs([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, "q")]).selectExpr("*", "doc_id as id", "text as tokens")
    kept = J.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]


def test_components_of_a_long_path(spark):
    n = 200
    order = random.Random(1).sample(range(n), n)
    got = components(spark.createDataFrame([*zip(order, order[1:]), (1000, 1001)], "a long, b long"), J.shared_folder(spark, "test"))
    assert {r.id: r.component for r in got.collect()} == {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000}


def thue_morse(size):
    """Two words that polynomial hashes modulo powers of two cannot tell apart."""
    word, other = "a", "b"
    while len(word) < size:
        word, other = word + other, other + word
    return word, other


def test_words_that_collide_modulo_powers_of_two(make_docs):
    word, other = thue_morse(2048)
    rows = [(1, f"{word} x y z w"), (2, f"{other} x y z w"), (3, f"{word} X y z w"), (4, f"x y z w {word}"), (5, f"x y z w {other}")]
    assert run(make_docs(rows)) == brute(rows)
