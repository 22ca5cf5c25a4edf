import hashlib

import pytest

from ridemart.llm import archive as A
from ridemart.llm import store

SF = "/root/testdata/sf0.01"


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        ref = first.get(h or "") if len(raw) >= 100 and sum((x[2] or "") == (h or "") for x in rows) > 1 else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if ref is None or ref == i else "revisit", None if ref == i else ref))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return sorted((tuple(r)[:5] for r in A.archive_pages(spark, pages, A.ArchiveConfig(**kw)).collect()), key=str)


def test_edges(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 2000
    rows = [(1, "http://a", None), (2, None, ""), (3, "http://a b\n", "x" * 99), (4, "u", "x" * 99), (9, "u", "y" * 100), (5, "u", "y" * 100),
            (7, "u", "y" * 100), (None, "u", "y" * 100), (None, "u", "only null " * 20), (5, "u", "y" * 100), (20, "u", big), (21, "u", big), (22, "u", "\r\n\r\n" * 40)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("limit", [300_000, 32 << 20])
def test_pages_table_and_files(spark, limit, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").selectExpr("*", "url as digest", "page_id as first")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    cfg = A.ArchiveConfig(file_payload_bytes=limit, dictionary_bytes=4096)
    manifest = A.write_archives(pages.repartition(2), f"file://{tmp_path}/w", cfg)
    got = sorted((tuple(r)[:5] for r in A.read_archives(manifest).collect()), key=str)
    assert got == brute(rows)
    payloads = {}
    for m in manifest.collect():
        data = store.read_file(m.uri)
        assert data[:4] == b"\x5d\x2a\x4d\x18" and int.from_bytes(data[4:8], "little") > 100
        found = list(A.read_records(data))
        assert len(found) == m.n_records and len(data) == m.n_bytes
        for _, record in found:
            fields, block = A.parse_record(record)
            if fields["WARC-Type"] == "response":
                payloads[int(fields["WARC-Record-ID"][12:-1])] = block.split(b"\r\n\r\n", 1)[1].decode()
    for i, _, h in rows:
        assert payloads.get(i, h) == h
    assert len(payloads) == sum(r[3] == "response" for r in got)


def test_damage_is_noticed():
    parts = A.file_parts([A.record_bytes(1, "u", b"z" * 500, "d", None, "now")], A.ArchiveConfig())
    with pytest.raises(Exception):
        list(A.read_records(b"".join(parts)[:-4]))


@pytest.mark.parametrize("salt_rows", [1, 7, 50_000])
def test_one_payload_on_a_third_of_the_pages(spark, salt_rows):
    rows = [(k, f"u{k}", "hot " * 40 if k % 3 == 0 else f"page {k % 50} " * 20) for k in range(90)]
    rows += [(None, None, "hot " * 40), (None, "u", "hot " * 40), (200, None, None), (201, None, "")]
    assert run(spark, rows, salt_rows=salt_rows) == brute(rows)
