"""Raw fleet-month trip files.

One parquet file per (fleet, month) named ``{fleet}_tripdata_{month}.parquet``
(or a folder of that name with part files); columns carry a fleet-specific
prefix (``tpep_``/``lpep_``) and loose types, which drift from month to month.
Files are read in groups of equal physical column types, one scan a group, so
the plan grows with the number of type combinations, not of files.
"""

from __future__ import annotations

import logging
import math
import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.constants import FLEET_PREFIX, RAW_FILE_PATTERN
from ridemart.operators.joins import bounded
from ridemart.settings import Settings

# The footer reader runs in Python workers: shipped by value, so they need no package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

log = logging.getLogger("ridemart.landing")

RAW_COLUMNS = [
    "fleet", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "passenger_count", "trip_distance", "fare_amount",
    "tip_amount", "total_amount", "payment_type",
]


def raw_file_name(fleet: str, month: str) -> str:
    return RAW_FILE_PATTERN.format(fleet=fleet, month=month)


def _list_files(spark: SparkSession, landing_dir: str) -> set[str]:
    """Names of the files in the landing folder (one listing, metadata only)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(landing_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return set()
    # A landed file may be a single parquet file or a directory of part files.
    return {st.getPath().getName() for st in fs.listStatus(path)}


def discover_landing(spark: SparkSession, landing_dir: str, settings: Settings) -> list[dict]:
    """The requested (fleet x month) grid reduced to files that exist.

    Missing files are logged; no file at all is an error.  Returns landing
    manifest rows (S19) ``{fleet, month, path, source}``.
    """
    present = _list_files(spark, landing_dir)
    found = []
    for fleet in settings.ingest.fleets:
        for month in settings.ingest.months:
            name = raw_file_name(fleet, month)
            if name in present:
                found.append({"fleet": fleet, "month": month,
                              "path": f"{landing_dir.rstrip('/')}/{name}", "source": "landing"})
            else:
                log.warning("landing folder has no %s; skipped", name)
    if not found:
        raise FileNotFoundError(f"no raw trip files for the requested grid in {landing_dir}")
    return found


def normalize_fleet(raw: DataFrame, fleet: str, more: list[str] | None = None) -> DataFrame:
    """Prefixed raw columns -> common typed names, fleet tag added (and columns of ``more`` kept).

    Integer casts round half-even first (``rint``) so a fractional id such as
    3.6 becomes 4, the way a database cast does (K9).
    """
    prefix = FLEET_PREFIX[fleet]

    def as_int(c: str):
        return F.rint(F.col(c).cast("double")).cast("int")

    return raw.select(
        F.lit(fleet).alias("fleet"),
        F.col(f"{prefix}_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(f"{prefix}_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        as_int("PULocationID").alias("pickup_location_id"),
        as_int("DOLocationID").alias("dropoff_location_id"),
        F.col("passenger_count").cast("double").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
        F.col("total_amount").cast("double").alias("total_amount"),
        as_int("payment_type").alias("payment_type"),
        *(more or []),
    )


#: Columns that normalisation reads, besides the two prefixed times.
_READ = ("PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount", "payment_type")
_FILE_NAME = r"/([^/]+)_tripdata_([^/]+)\.parquet(?:/[^/]*)?$"


def raw_columns(fleet: str) -> list[str]:
    """The raw columns of a fleet's files that normalisation reads."""
    return [f"{FLEET_PREFIX[fleet]}_{c}_datetime" for c in ("pickup", "dropoff")] + list(_READ)


def landed_parts(spark: SparkSession, files: list[dict]) -> DataFrame:
    """``(fleet, month, path, bytes, rows)`` of every parquet file behind the landed ones that has rows.

    All come from the hidden ``_metadata`` columns of one scan that reads no
    data column (row counts are in the footers), whatever the files' types.
    """
    scan = spark.read.schema("_none string").parquet(*[f["path"] for f in files])
    parts = scan.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))
    return parts.select(F.regexp_extract("path", _FILE_NAME, 1).alias("fleet"), F.regexp_extract("path", _FILE_NAME, 2).alias("month"),
                        "path", "bytes", "rows")


def landing_manifest(spark: SparkSession, files: list[dict]) -> DataFrame:
    """The landing manifest as a DataFrame (fleet, month, path, source)."""
    return spark.createDataFrame(files, "fleet string, month string, path string, source string")


MANIFEST = "fleet string, month string, path string, source string, parts long, bytes long, rows long"


def manifest_rows(files: list[dict], parts: list[dict]) -> list[dict]:
    """The landed files with the number, bytes and rows of their parts (0 where a file has no rows)."""
    out = []
    for f in files:
        own = [p for p in parts if (p["fleet"], p["month"]) == (f["fleet"], f["month"])]
        out.append({**f, "parts": len(own), "bytes": sum(p["bytes"] for p in own), "rows": sum(p["rows"] for p in own)})
    return out


def landing_counts(spark: SparkSession, files: list[dict]) -> DataFrame:
    """The manifest with counts as a DataFrame."""
    return spark.createDataFrame(manifest_rows(files, [r.asDict() for r in landed_parts(spark, files).collect()]), MANIFEST)


def physical_types(spark: SparkSession, parts: list[dict]) -> dict[str, str]:
    """Path -> the physical types of the columns that are read, from footers read in tasks.

    Stores that only Spark opens have their footers read by the driver, one
    after the other.
    """
    wanted = {p["path"]: raw_columns(p["fleet"]) for p in parts}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyarrow import parquet as pq

        for batch in batches:
            out = []
            for path in batch["path"]:
                try:
                    system, inside = fs.FileSystem.from_uri(path)
                    schema = pq.read_schema(inside, filesystem=system)
                    out.append(",".join(f"{c} {schema.field(c).type}" for c in wanted[path] if c in schema.names))
                except (ValueError, OSError, ImportError):
                    out.append(None)
            yield pd.DataFrame({"path": batch["path"], "types": out})

    tasks = max(1, min(len(parts), spark.sparkContext.defaultParallelism))
    asked = spark.createDataFrame([(p["path"],) for p in parts], "path string").repartition(tasks)
    types = {r["path"]: r["types"] for r in asked.mapInPandas(read, "path string, types string").collect()}
    for path, found in types.items():
        if found is None:
            fields = dict(spark.read.parquet(unquote(path)).dtypes)
            types[path] = ",".join(f"{c} {fields[c]}" for c in wanted[path] if c in fields)
    return types


def spread_step(rows: int) -> int:
    """A step that visits every row number below ``rows`` once before it repeats: about 0.618 of them, without a common divisor."""
    step = max(1, math.floor(rows * 0.6180339887498949))
    while math.gcd(step, rows) != 1:
        step += 1
    return step


def sampled_rows(scan: DataFrame, parts: list[dict], cap: int) -> DataFrame:
    """S3: exactly ``min(cap, rows)`` rows of every landed file, spread over it, filtered in the scan.

    A row's number in its landed file (parts in name order, then its number
    in the part) times a step without a common divisor runs through all
    numbers modulo the file's rows, so exactly ``cap`` of them fall below
    ``cap``.  Nothing is shuffled, counted or sorted; the row counts are the
    footers'.
    """
    totals: dict[tuple[str, str], int] = {}
    rows = []
    for p in sorted(parts, key=lambda p: (p["fleet"], p["month"], p["path"])):
        key = (p["fleet"], p["month"])
        rows.append((p["path"], totals.get(key, 0), key))
        totals[key] = totals.get(key, 0) + p["rows"]
    places = scan.sparkSession.createDataFrame([(path, before, totals[key], spread_step(totals[key])) for path, before, key in rows],
                                               "_path string, _before long, _rows long, _step long")
    marked = scan.withColumns({"_path": F.col("_metadata.file_path"), "_index": F.col("_metadata.row_index")})
    joined = marked.join(bounded(places, known_max_rows=len(rows)), "_path")
    return joined.where((F.col("_before") + F.col("_index")) * F.col("_step") % F.col("_rows") < cap).select(*scan.columns)


def read_landing(spark: SparkSession, landing_dir: str, settings: Settings, with_month: bool = False) -> DataFrame:
    """S1-S3 + U1: all requested raw files as one normalised frame (``landed_month`` added on request)."""
    return read_files(spark, discover_landing(spark, landing_dir, settings), settings.ingest.sample_rows, with_month)


def read_files(spark: SparkSession, files: list[dict], sample_rows: int | None = None, with_month: bool = False,
               parts: list[dict] | None = None) -> DataFrame:
    """S1-S3 + U1: landed files, normalised; one scan per fleet and combination of physical types.

    Monthly files drift in physical types and Spark reads a scan with one
    schema, so files are grouped by the types in their footers.  ``parts``
    are the rows of ``landed_parts`` if the caller has them.
    """
    if parts is None:
        parts = [r.asDict() for r in landed_parts(spark, files).collect()]  # a row per file, as the scans' own file lists
    if not parts:  # all files are empty: their schema still counts
        parts = [{"fleet": f["fleet"], "month": f["month"], "path": f["path"], "rows": 0} for f in files[:1]]
    types = physical_types(spark, parts)
    groups: dict[tuple[str, str], list[dict]] = {}
    for p in parts:
        groups.setdefault((p["fleet"], types[p["path"]]), []).append(p)
    frames = []
    for (fleet, _), group in sorted(groups.items(), key=lambda g: g[0]):
        scan = spark.read.parquet(*sorted(unquote(p["path"]) for p in group)).select(*raw_columns(fleet), F.col("_metadata"))
        if with_month:
            scan = scan.withColumn("landed_month", F.regexp_extract("_metadata.file_path", _FILE_NAME, 2))
        if sample_rows:
            own = {(p["fleet"], p["month"]) for p in group}
            scan = sampled_rows(scan, [p for p in parts if (p["fleet"], p["month"]) in own], sample_rows)
        frames.append(normalize_fleet(scan, fleet, ["landed_month"] if with_month else []))
    return reduce(DataFrame.unionByName, frames)
