"""Registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm import (archive, centroid_clustering, conversation_repair, decontamination, direct_codes, html_differencing, ngram_jaccard, ngram_lm, packing,
                          quality_llr, recompression, sharding, suffix_dedup)
from ridemart.llm.tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Ends every document of the encoded and the packed corpus.
END_ID = 2


def op1_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram scores of all documents, trained on nine tenths of them."""
    return ngram_lm.train_and_score(_table(spark, sf_dir, "documents"))


def op2_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as token-id files of directly addressable codes, read back."""
    return direct_codes.encode_corpus(spark, _table(spark, sf_dir, "documents"), vocabulary(), END_ID).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of near equal bytes."""
    return sharding.assign(_table(spark, sf_dir, "documents"), 24).withColumn("grown_shard", F.lit(None).cast("int"))


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary(), END_ID).drop("row")


def op5_multi_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a 5-word-shingle Jaccard similarity of 0.8."""
    return ngram_jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the likelihood-ratio verdict of every document."""
    docs = _table(spark, sf_dir, "documents")
    ratios = quality_llr.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_llr.score_documents(docs, ratios)


#: Every ten-word window of the benchmark looked up among all windows of the documents.
DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bn AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bs AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bs),
dn AS (SELECT doc_id, w, n FROM d, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dn),
hit AS (SELECT doc_id, i, ds.n AS n, item_id FROM ds JOIN bw ON bw.n = ds.n AND array_to_string(w[i:i + ds.n - 1], ' ') = win),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
covered AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of later copies of 20-word sequences removed."""
    return recompression.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_induced_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings of smaller documents removed."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives."""
    records = archive.archive_pages(spark, _table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Equal payloads of 100 bytes or more refer to their smallest page.
ARCHIVE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op11_url_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, next to the page with the nearest URL."""
    return html_differencing.main_text_report(html_differencing.extract_main_text(_table(spark, sf_dir, "pages")))


def op12_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    return conversation_repair.repair_report(conversation_repair.repair(conversation_repair.damage(_table(spark, sf_dir, "conversations"))))


def op13_simplex_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of the embeddings after three rounds, in exact integers."""
    return centroid_clustering.cluster_report(*centroid_clustering.cluster_vectors(_table(spark, sf_dir, "embeddings")))


def _clustering_sql(rounds: int = 3) -> str:
    """Every vector against every centroid, round by round."""
    parts = ["""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS k, v FROM kept
  ORDER BY k LIMIT 16)"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, k := k)) AS best
  FROM (SELECT r, k, CAST(list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM kept, c{i}) x
  GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
s{i} AS MATERIALIZED (
  SELECT k, j, sum(x) AS s, count(*) AS n
  FROM (SELECT best.k AS k, unnest(v) AS x, unnest(range(64)) AS j FROM a{i} JOIN kept USING (r)) u
  GROUP BY k, j),
m{i} AS MATERIALIZED (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT c{i}.k AS k, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (k))""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} c ON c.k = best.k
"""


def llm_queries() -> dict:
    return {f.__name__: f for f in (op1_elias_fano_lm, op2_direct_codes, op3_sampled_splitters, op4_best_fit, op5_multi_order, op6_winnowing, op7_quality_llr, op8_recompression, op9_induced_sort, op10_warc_dictionary,
                                    op11_url_differencing, op12_auction_repair, op13_simplex_centroids)}


def llm_oracle_sql() -> dict[str, str]:
    return {"op6_winnowing": DECONTAMINATION_SQL, "op10_warc_dictionary": ARCHIVE_SQL, "op13_simplex_centroids": _clustering_sql()}
