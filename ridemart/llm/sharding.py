"""Sampled splitters: size-weighted key samples, quantile boundaries, range partitioning.

The key is (hash of the text, document id, row number), so equal texts lie
next to each other and stay in one shard, yet a group larger than a shard can
be split.  A sample weighted by
size gives the boundaries of many small ranges; their exact sizes are then
counted, overfull ranges are sampled again and subdivided, and the ranges are
dealt to the shards largest first, each to the lightest shard so far.  Law:
``bytes`` (shard sizes near equal).

Groups of equal texts above a range's size are known exactly.  Each has ranges
of its own, cut by rows and dealt together unless the group is larger than a
shard should be.

The driver holds the sample, the large groups and one row per range: in shards
x ``ranges_per_shard``, a few times ``samples_per_range``, one, and a few.  Rows
never leave Spark.

Edge cases: a null text has size 8 and CRC 0 like an empty one; null ids sort
before all others; repeated rows are told apart by their row number, so even
one row repeated everywhere is split; a single row larger than a shard stays
whole; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Collection, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemart.session import ensure_checkpoint_dir

#: Added to the bytes of every text.
ROW_BYTES = 8
_KEY = ("h", "d", "u")
_LOWEST = -(1 << 63)


@dataclass(frozen=True)
class ShardConfig:
    ranges_per_shard: int = 64
    samples_per_range: int = 8
    overfull: float = 2.0
    #: Largest group of equal texts kept whole, in mean shard sizes.
    whole_group: float = 0.9


@dataclass
class ShardPlan:
    """Sorted range boundaries and, by range, its shard and its first slot there."""

    boundaries: list[tuple[int, int, int]]
    shards: list[int] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)


def _key_columns() -> list[Column]:
    """The key: equal texts together, then by id, then by row."""
    return [F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("d"),
            F.monotonically_increasing_id().alias("u")]


def keyed(docs: DataFrame) -> DataFrame:
    """Slim rows: id, size, CRC and the partitioning key."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), *_key_columns())


def range_of(boundaries: list[tuple[int, int, int]]) -> Column:
    """Number of boundaries at or below the row's key: a binary search over a literal array."""
    if not boundaries:
        return F.lit(0)
    listed = F.from_json(F.lit(json.dumps([dict(zip(_KEY, b)) for b in boundaries])), "array<struct<h: bigint, d: bigint, u: bigint>>")
    key = F.struct(*_KEY)
    steps = [1 << k for k in reversed(range(len(boundaries).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda low, step: F.when((low + step <= len(boundaries)) & (F.get(listed, low + step - 1) <= key), low + step).otherwise(low))


def sample_keys(rows: DataFrame, rate: float, *more: str) -> list:
    """Keys of rows drawn with probability ``rate * size`` (certain beyond 1), in order, with what each stands for."""
    uniform = F.pmod(F.xxhash64("u", "d", "h"), F.lit(1 << 52)) / float(1 << 52)
    return (rows.where(uniform < F.col("size") * rate).orderBy(*_KEY)
            .select(*_KEY, F.greatest(F.col("size").cast("double"), F.lit(1 / rate)).alias("stands"), *more).collect())


def group_cuts(groups: Iterable[int]) -> list[tuple[int, int, int]]:
    """Cuts before and after each of these groups of equal texts."""
    return [(h, _LOWEST, _LOWEST) for g in groups for h in (g, g + 1) if h < 1 << 63]


def quantiles(sample: list, target: float, large: Collection[int]) -> list[tuple[int, int, int]]:
    """Cuts between units so that sampled sizes stay below ``target``; a unit is a group of equal texts, or a row of a large group."""
    units: dict[tuple, float] = {}
    for h, d, u, stands in sample:
        unit = (h, d, u) if h in large else (h, _LOWEST, _LOWEST)
        units[unit] = units.get(unit, 0.0) + stands
    cuts, total, group = [], 0.0, None
    for unit, size in units.items():
        own = unit[0] if unit[0] in large else None
        if own != group:  # group_cuts() has a cut here
            total, group = 0.0, own
        if total and total + size > target:
            cuts.append(unit)
            total = 0.0
        total += size
    return cuts


def plan_shards(rows: DataFrame, n_shards: int, cfg: ShardConfig | None = None) -> ShardPlan:
    """Boundaries with no overfull range left, dealt to shards.

    Groups of equal texts stay in one shard unless one is larger than a shard
    should be.  The loop ends soon because the sampling rate doubles and no unit
    of an overfull range is above ``target`` but single rows of a large group,
    which are all drawn.
    """
    cfg = cfg or ShardConfig()
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return ShardPlan([])
    target = total / (n_shards * cfg.ranges_per_shard)
    # At most n_shards x ranges_per_shard rows.
    large = {r["h"]: r["size"] for r in rows.groupBy("h").agg(F.sum("size").alias("size")).where(F.col("size") > target).collect()}
    whole = {h for h, size in large.items() if size <= cfg.whole_group * total / n_shards}
    rate = cfg.samples_per_range / target
    cuts = sorted({*group_cuts(large), *quantiles(sample_keys(rows, rate), target, large)})
    while True:
        ranged = rows.withColumn("range", range_of(cuts))
        sizes = {r["range"]: r for r in ranged.groupBy("range").agg(
            F.sum("size").alias("size"), F.count("*").alias("rows"), F.min("h").alias("first"), F.max("h").alias("last")).collect()}
        over = [k for k, r in sizes.items() if r["size"] > cfg.overfull * target
                and (r["first"] < r["last"] or r["first"] in large and r["rows"] > 1)]
        if not over:
            break
        rate *= 2
        drawn: dict[int, list] = {}
        for r in sample_keys(ranged.where(F.col("range").isin(over)), rate, "range"):
            drawn.setdefault(r["range"], []).append(r[:4])
        cuts = sorted({*cuts, *(c for part in drawn.values() for c in quantiles(part, target, large))})
    shards, offsets = _deal(sizes, len(cuts) + 1, n_shards, whole)
    return ShardPlan(cuts, shards, offsets)


def _deal(sizes: dict, n_ranges: int, n_shards: int, whole: set[int]) -> tuple[list[int], list[int]]:
    """Largest first to the lightest shard, a range or all ranges of a ``whole`` group; slots follow range order within a shard."""
    together: dict[tuple, list[int]] = {}
    for k in sorted(sizes):
        h = sizes[k]["first"]
        together.setdefault(("group", h) if h in whole else ("range", k), []).append(k)
    loads = [(0, s) for s in range(n_shards)]
    shard = [0] * n_ranges
    for size, ranges in sorted(((sum(sizes[k]["size"] for k in ranges), ranges) for ranges in together.values()), key=lambda x: (-x[0], x[1])):
        load, s = heapq.heappop(loads)
        for k in ranges:
            shard[k] = s
        heapq.heappush(loads, (load + size, s))
    filled, offset = [0] * n_shards, [0] * n_ranges
    for k in range(n_ranges):
        offset[k] = filled[shard[k]]
        filled[shard[k]] += sizes[k]["rows"] if k in sizes else 0
    return shard, offset


def _by_range(values: list[int]) -> Column:
    return F.get(F.from_json(F.lit(json.dumps(values or [0])), "array<bigint>"), F.col("range"))


def assign(docs: DataFrame, n_shards: int, cfg: ShardConfig | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot (gapless from 0 in its shard)."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = keyed(docs).checkpoint()  # slim; fixes the row numbers
    plan = plan_shards(rows, n_shards, cfg)
    order = F.row_number().over(Window.partitionBy("range").orderBy(*_KEY))
    return (rows.withColumn("range", range_of(plan.boundaries))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), _by_range(plan.shards).cast("int").alias("shard"),
                    (_by_range(plan.offsets) + order - 1).cast("long").alias("slot")))


def write_shards(docs: DataFrame, n_shards: int, uri: str, cfg: ShardConfig | None = None) -> ShardPlan:
    """Write whole rows as Parquet, one folder per shard (``shard=0`` ...; it replaces a column of that name)."""
    ensure_checkpoint_dir(docs.sparkSession)
    plan = plan_shards(keyed(docs).checkpoint(), n_shards, cfg)
    ranged = docs.select(F.struct(*[c for c in docs.columns if c != "shard"]).alias("row"), *_key_columns())
    (ranged.withColumn("range", range_of(plan.boundaries)).withColumn("shard", _by_range(plan.shards).cast("int"))
     .repartition("range").select("row.*", "shard").write.partitionBy("shard").parquet(uri))
    return plan
