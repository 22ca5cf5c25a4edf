import random
import re

import pytest

from ridemart.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out, key=str)


def run(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"])) for r in D.decontaminate(docs, bench).collect()), key=str)


def cases():
    rng = random.Random(5)
    vocab = ["The", "of", "é", "É", "Öl", "x1", "über", "AND", "Σας", "kB"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    docs = list(enumerate(texts)) + [(100, None), (101, ""), (102, "?!"), (3, texts[3]), (None, texts[5]), (103, "the-of É,x1 " * 400)]
    items = [(1, texts[0]), (2, " ".join(texts[1].split()[3:20]).upper()), (3, texts[2][-80:]), (4, texts[0]), (5, None), (6, "..."),
             (7, "über"), (8, "É x1 the"), (10, " ".join(rng.choice(vocab) for _ in range(9)))]
    return docs, items


def test_matches_brute_force(spark, make_docs):
    docs, items = cases()
    assert run(spark, make_docs(docs), items) == brute(docs, items)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_without_broadcast_is_the_same(spark, make_docs, limit):
    docs, items = cases()
    cfg = D.DecontaminationConfig(broadcast_fingerprints=limit)
    bench = spark.createDataFrame(items[:4], "item_id long, text string")
    got = {r.doc_id for r in D.decontaminate(make_docs(docs), bench, cfg).where("contaminated").collect()}
    assert got == {r[0] for r in brute(docs, items[:4]) if r[2]}


def test_drop_keeps_clean_rows_and_columns(spark, make_docs):
    docs, items = cases()
    table = make_docs(docs).selectExpr("*", "doc_id as k1", "text as words")
    kept = D.drop_contaminated(table, spark.createDataFrame(items[:4], "item_id long, text string"))
    assert kept.columns == table.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in brute(docs, items[:4]) if not r[2])


def test_empty_tables(spark, make_docs):
    assert run(spark, make_docs([]), [(1, "a b")]) == []
    assert run(spark, make_docs([(1, "a b"), (2, None)]), []) == [(1, 2, 0, 0, ""), (2, 0, 0, 0, "")]
