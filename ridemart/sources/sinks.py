"""Table, report and export sinks."""

from __future__ import annotations

import json
import logging
import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger("ridemart.sinks")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """A parquet table directory, written anew.

    S14 (registering in-memory frames as tables) is not needed: model and
    anomaly results are DataFrames already and are written the same way.
    """
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


# --- tables that are replaced as a whole (S13) -------------------------------

_VERSION = re.compile(r"^version-(\d{8})-[0-9a-f]{32}$")


def _filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _filesystem(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of a table's complete versions, oldest first."""
    return [f"{path}/{v}" for v in _children(spark, path) if _VERSION.match(v) and _exists(spark, f"{path}/{v}/_SUCCESS")]


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the newest complete version."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version of a table in {path}")
    return found[-1]


def replace_table(df: DataFrame, path: str, keep: int = 2) -> str:
    """Create or replace the table at ``path``; readers see the old rows or the new ones, never none.

    The rows become a new version folder.  Its ``_SUCCESS`` file, which the
    job commit writes last, makes it the current one; a write that fails
    leaves the table as it was.  Older versions but ``keep`` are removed
    after that, so readers that have opened the one before can go on.  The
    frame may read the table that it replaces.
    """
    spark = df.sparkSession
    numbers = [int(m.group(1)) for m in map(_VERSION.match, _children(spark, path)) if m]
    new = f"{path}/version-{max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(new)
    for old in versions(spark, path)[:-keep]:
        fs, p = _filesystem(spark, old)
        fs.delete(p, True)
    return new


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written by ``replace_table``."""
    return spark.read.parquet(current_version(spark, path))


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """The table's current version under its name in the session's catalog.

    With a persistent catalog the name outlives the session; without one a
    new session registers the folders again.
    """
    folder = current_version(spark, path)
    catalog = spark.catalog
    catalog.dropTempView(name)
    if catalog.tableExists(name):
        if spark.table(name).schema == spark.read.parquet(folder).schema:
            spark.sql(f"ALTER TABLE `{name}` SET LOCATION '{folder}'")
            catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE `{name}`")  # an external table: its files stay
    catalog.createTable(name, path=folder, source="parquet")


def catalog_counts(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """``(table, rows)`` of every table and view that the catalog lists (or of those in ``names``), in one job."""
    listed = sorted(t.name for t in spark.catalog.listTables())
    parts = [spark.table(f"`{t}`").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows")
             for t in listed if names is None or t in names]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "table string, rows long")


# --- tables that grow by partitions (S11) --------------------------------------

def replace_partitions(df: DataFrame, path: str, landed: list[str], finer: list[str], stale_below: list[dict]) -> str:
    """Write the rows' partitions and leave all others as they are (dynamic partition overwrite).

    Partitions are ``landed`` then ``finer`` columns.  ``stale_below`` lists
    the ``landed`` values that this write stands for as a whole: their finer
    partitions that got no row any more are removed.
    """
    spark = df.sparkSession
    groups = ["/".join([path, *[f"{c}={g[c]}" for c in landed]]) for g in stale_below]

    def files(group: str) -> dict[str, set[str]]:
        return {d: set(_children(spark, f"{group}/{d}")) for d in _children(spark, group) if d.startswith(f"{finer[0]}=")}

    before = {g: files(g) for g in groups}
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*landed, *finer).parquet(path))
    for group in groups:
        for folder, now in files(group).items():
            if now == before[group].get(folder):
                fs, p = _filesystem(spark, f"{group}/{folder}")
                fs.delete(p, True)
    return path


# --- reports and extracts -----------------------------------------------------------

def write_report(spark: SparkSession, report: dict, path: str) -> str:
    """A small report as one JSON line written by Spark to ``path`` (``spark.read.json`` gives it as a struct)."""
    doc = json.dumps(report, default=str, sort_keys=True)
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def table_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``(table, rows)`` for every table, as one union of counts (one job)."""
    if not tables:
        return spark.createDataFrame([], "table string, rows long")
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table"), "rows") for name, p in tables.items()]
    return reduce(DataFrame.unionByName, parts)


MANIFEST_SCHEMA = "table string, rows long, columns array<string>, formats array<string>"


def export_tables(spark: SparkSession, tables: dict[str, DataFrame] | dict[str, str], out_dir: str,
                  csv_tables: tuple[str, ...] = ()) -> DataFrame:
    """Every table (a frame or a parquet folder) to parquet, the listed ones also to CSV (with header, any size).

    Returns the manifest ``(table, rows, columns, formats)`` and writes it as
    JSON next to the extracts.  Row counts are of the extracts, in one job.
    """
    out_dir = out_dir.rstrip("/")
    frames = {name: spark.read.parquet(t) if isinstance(t, str) else t for name, t in sorted(tables.items())}
    for name, df in frames.items():
        write_table(df, f"{out_dir}/{name}.parquet")
        if name in csv_tables:
            (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .csv(f"{out_dir}/{name}.csv"))
    counts = {r["table"]: r["rows"] for r in table_counts(spark, {n: f"{out_dir}/{n}.parquet" for n in frames}).collect()}
    rows = [(name, int(counts[name]), list(df.columns), ["parquet", "csv"] if name in csv_tables else ["parquet"]) for name, df in frames.items()]
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    manifest.coalesce(1).write.mode("overwrite").json(f"{out_dir}/manifest.json")
    log.info("exported %d tables to %s", len(rows), out_dir)
    return manifest


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The manifest of an export."""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{out_dir.rstrip('/')}/manifest.json")


def read_extract(spark: SparkSession, out_dir: str, name: str, schema: StructType | str, fmt: str = "csv") -> DataFrame:
    """An extract with the schema that its table had (CSV files carry names but no types; an empty text is read as NULL)."""
    reader = spark.read.schema(schema)
    path = f"{out_dir.rstrip('/')}/{name}.{fmt}"
    return (reader.option("header", True).option("enforceSchema", False).option("multiLine", True).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(path)) if fmt == "csv" else reader.parquet(path)
