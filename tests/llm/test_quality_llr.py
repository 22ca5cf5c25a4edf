import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from ridemart.llm import quality_llr as Q

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text or ""), "n_dup_lines": dup, "n_repeat_words": len(covered),
            "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words)}


EDGE = [None, "", " ", "\n\n", "a", "é\x85ü \x1c", "a b c a b c", "x\nx\nx \n\nx", "# $ | <é>", "a a a a a a",
        "one two three\r\none two three\r\n", "w " * 3000, "日本語 テキスト"]


def test_measures_match_brute_force(spark, make_docs):
    docs = make_docs(list(enumerate(EDGE)) + [(3, "\n\n"), (None, "null id")])
    docs = docs.unionByName(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100 as doc_id", "text", "lang", "source", "n_chars"))
    got = Q.score_documents(docs, np.zeros(1 << 16)).toPandas()
    want = pd.DataFrame([{"doc_id": r[0], **brute(r[1])} for r in docs.select("doc_id", "text").collect()])
    cols = list(want.columns)
    key = ["doc_id", "n_words"]
    pd.testing.assert_frame_equal(got[cols].sort_values(key).reset_index(drop=True),
                                  want.sort_values(key).reset_index(drop=True), check_dtype=False)


def test_counts_and_ratio_match_brute_force(make_docs):
    cfg = Q.QualityConfig(buckets=64, slice_bytes=50)
    texts = [(i, t) for i, t in enumerate(["abcdefgh ijk", "ab", None, "zzzz yyyy" * 20, "abcdefgh"])]
    docs = make_docs(texts)
    counts = Q.count_grams(docs, np.array([0, 2]), cfg)
    want = np.zeros((2, 64), np.int64)
    for i, t in texts:
        for b in Q.gram_buckets(np.frombuffer((t or "").encode(), np.uint8), cfg):
            want[0, b] += 1
            want[1, b] += i in (0, 2)
    assert (counts == want).all()
    ratios = np.linspace(-1, 1, 64)
    got = Q.score_documents(docs, ratios, cfg).toPandas().set_index("doc_id")["llr"]
    for i, t in texts:
        b = Q.gram_buckets(np.frombuffer((t or "").encode(), np.uint8), cfg)
        assert got[i] == pytest.approx(ratios[b].mean() if len(b) else 0.0)


def test_separates_labelled_documents(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    ratios = Q.fit(docs, labels.where("doc_id % 2 = 0"))
    got = (Q.score_documents(docs, ratios).join(labels.where("doc_id % 2 = 1"), "doc_id").where("n_words >= 50 and not base_failed").toPandas())
    good = got[(got.quality == 1) & (got.toxic == 0)]
    assert good.kept.mean() > 0.995
    assert got[got.quality == 0].kept.mean() < 0.35


def test_empty_table_no_labels_and_filter_schema(spark, make_docs):
    docs = make_docs([]).selectExpr("*", "doc_id as kept")
    ratios = Q.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert not ratios.any()
    assert Q.score_documents(docs, ratios).count() == 0
    kept = Q.keep_documents(docs, ratios)
    assert kept.columns == docs.columns and kept.count() == 0
    good = "w%d " * 60 % tuple(range(60))
    assert [r.doc_id for r in Q.keep_documents(make_docs([(1, good), (2, "a b"), (3, None)]), ratios).collect()] == [1]
