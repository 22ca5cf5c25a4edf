import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline as C
from ridemart.llm import packing
from ridemart.llm import quality_llr as Q
from ridemart.llm import text as T
from ridemart.llm.tokens import vocabulary
from tests.llm import test_decontamination as B
from tests.llm import test_ngram_jaccard as J
from tests.llm import test_quality_llr as QT

SF = "/root/testdata/sf0.001"


def brute(docs, labels, items):
    """(doc_id -> text) that the first four stages leave."""
    cfg = Q.QualityConfig()
    trusted = {i for i, q, t in labels if q == 1 and t == 0}
    counts = np.full((2, cfg.buckets), cfg.smoothing)
    for i, t in docs:
        grams = Q.gram_buckets(np.frombuffer((t or "").encode(), np.uint8), cfg)
        np.add.at(counts[0], grams, 1)
        if i in trusted:
            np.add.at(counts[1], grams, 1)
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    kept = []
    for i, t in docs:
        grams = Q.gram_buckets(np.frombuffer((t or "").encode(), np.uint8), cfg)
        if not QT.brute(t)["base_failed"] and (ratios[grams].mean() if len(grams) else 0.0) >= cfg.threshold:
            kept.append((i, t))
    kept = [(i, t) for (i, t) in kept if i in {d for d, _, c in J.brute(kept) if d == c}]
    first, cut = {}, []
    for i, t in sorted(kept):
        raw = t.encode()
        for s in range(len(raw) - 49):
            first.setdefault(raw[s:s + 50], i)
    for i, t in kept:
        raw, gone = t.encode(), set()
        for s in range(len(raw) - 49):
            if first[raw[s:s + 50]] < i:
                gone |= set(range(s, s + 50))
        cut.append((i, bytes(b for k, b in enumerate(raw) if k not in gone).decode(errors="ignore")))
    hit = {r[0] for r in B.brute(cut, items) if r[2]}
    return {i: t for i, t in cut if i not in hit}


def test_pipeline_matches_brute_force(spark):
    rows = {n: [tuple(r) for r in spark.read.parquet(f"{SF}/{n}.parquet").select(c).collect()]
            for n, c in (("documents", ["doc_id", "text"]), ("labels", ["doc_id", "quality", "toxic"]), ("benchmark", ["item_id", "text"]))}
    want = brute(rows["documents"], rows["labels"], rows["benchmark"])
    assert 20 < len(want) < len(rows["documents"])
    library = Tokenizer.from_file(vocabulary())
    pieces = {}
    for r in C.run(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(want)
    for i, parts in pieces.items():
        ids = np.array([*library.encode(want[i], add_special_tokens=False).ids, 2], "<u4")
        assert [(p.start, p.length, p.ids_crc32) for p in sorted(parts, key=lambda p: p.piece)] == [
            (s, n, zlib.crc32(ids[s:s + n].tobytes())) for s, n in packing.cut_pieces(len(ids), 1024)]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)


def test_empty_table_goes_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in C.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_odd_rows_go_through(make_docs, spark):
    text = " ".join(f"word{k}" for k in range(80))
    docs = make_docs([(1, text), (1, text), (2, text), (None, None), (None, text + " x"), (3, None), (4, ""), (5, "w " * 40_000)])
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        docs.count()
    assert {r.doc_id for r in docs.collect()} <= {1, None}


def test_null_ids_and_repeated_rows_have_a_result(make_docs, spark):
    text, other, third = (" ".join(f"{w}{k}" for k in range(80)) for w in ("word", "other", "third"))
    docs = make_docs([(1, text), (1, text), (2, text), (None, text + " x"), (None, other), (None, other), (None, None), (None, None), (4, ""), (4, third)])
    got = sorted(((r.doc_id, r.text) for r in C.near_copies(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, text), (None, other), (None, None), (None, None), (4, ""), (4, third)], key=str)
    passage = "0123456789" * 6
    docs = make_docs([(1, passage), (7, "a " + passage), (7, "bcd " + passage + " e"), (7, "a " + passage), (None, passage + " f"), (None, "g")])
    got = sorted(((r.doc_id, r.text) for r in C.repeats(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, passage), (7, "a "), (7, "bcd  e"), (7, "a "), (None, "f"), (None, "g")], key=str)


def test_flat_handles_sliced_arrays():
    column = pa.array(["ab", None, "cde", ""])[1:]
    data, off = T.flat(column)
    assert bytes(data) == b"cde" and off.tolist() == [0, 0, 3, 3]


def test_freed_memory_goes_back_to_the_system():
    import re
    from pathlib import Path

    from ridemart.llm.cluster import release_memory

    def held():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    release_memory()
    before = held()
    kept = [[bytearray(60_000), bytearray(500)] for _ in range(3000)]  # small ones between large ones keep the heap's end in place
    kept = [small for _, small in kept]
    release_memory()
    assert len(kept) == 3000 and held() < before + 40
