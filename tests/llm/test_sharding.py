import zlib

import pandas as pd
import pytest

from ridemart.llm import sharding as S

SF = "/root/testdata/sf0.01"


def check(got, n, rows):
    assert len(got) == len(rows)
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted(zip(got.doc_id.fillna(-1).astype(int), got["size"], got.text_crc32)) == want
    assert got.shard.between(0, n - 1).all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_documents_balanced_and_copies_together(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = S.assign(docs, 24).toPandas()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(got, 24, rows)
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 24 and sizes.max() <= 1.02 * sizes.mean() and sizes.min() >= 0.98 * sizes.mean()
    assert got.groupby("text_crc32").shard.nunique().max() == 1


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(None, ""), (None, "x" * 100), (2, None), (2, None)],
    [(7, "same text")] * 500 + [(i, f"t{i}") for i in range(50)],  # repeated rows, one key
    [(i, "copy " * 20) for i in range(400)] + [(1000, "y" * 30_000)],  # hot text, one very long text
])
def test_edges(make_docs, rows):
    got = S.assign(make_docs(rows), 5, S.ShardConfig(ranges_per_shard=8)).toPandas()
    check(got, 5, rows)
    if len(rows) > 400:
        sizes = got[got["size"] < 20_000].groupby("shard")["size"].sum()
        assert sizes.max() < 2.5 * max(sizes.mean(), 1)


def test_large_group_below_a_shard_is_not_collected(make_docs, monkeypatch):
    rows = [(i, f"{i:06d}" + "z" * 86) for i in range(6000)] + [(10_000 + i, "c" * 92) for i in range(800)]
    drawn, plans, sample_keys, plan_shards = [], [], S.sample_keys, S.plan_shards

    def spied(*a):
        drawn.append(sample_keys(*a))
        return drawn[-1]

    def planned(*a):
        plans.append(plan_shards(*a))
        return plans[-1]

    monkeypatch.setattr(S, "sample_keys", spied)
    monkeypatch.setattr(S, "plan_shards", planned)
    got = S.assign(make_docs(rows), 4, S.ShardConfig(ranges_per_shard=8)).toPandas()
    check(got, 4, rows)
    copies = got[got.doc_id >= 10_000]
    assert copies.shard.nunique() == 1  # 0.47 of a shard
    h = make_docs([(1, "c" * 92)]).select(S._key_columns()[0]).first()[0]
    assert sum(b[0] == h for b in plans[0].boundaries) >= 3  # its ranges
    assert sum(sum(r["h"] == h for r in sample) for sample in drawn) < 100
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() <= 1.1 * sizes.mean()


def test_range_of_is_bisect(spark):
    import bisect
    cuts = [(-5, 0, 0), (3, -2, 9), (3, 7, 0), (8, 0, 0), (8, 0, 1)]
    keys = [(-9, 0, 0), (-5, 0, 0), (-5, 0, 1), (3, -2, 8), (3, -2, 9), (3, 8, 0), (8, 0, 0), (8, 0, 1), (9, 9, 9)]
    df = spark.createDataFrame(keys, "h long, d long, u long").withColumn("r", S.range_of(cuts))
    assert [r.r for r in df.collect()] == [bisect.bisect_right(cuts, k) for k in keys]


def test_write_shards_keeps_rows_and_clashing_columns(make_docs, tmp_path):
    rows = [(i, f"text {i % 7} " * (i % 13)) for i in range(200)]
    docs = make_docs(rows).selectExpr("*", "doc_id as h", "text as `range`")
    S.write_shards(docs, 4, str(tmp_path / "out"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "shard"}
    a = back.select(docs.columns).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, docs.toPandas().sort_values("doc_id").reset_index(drop=True))
