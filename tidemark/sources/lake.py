"""Lake I/O: Parquet reads/writes, Hive-partitioned layout, fingerprints, freshness refresh,
run metadata (A-10..A-14, A-18..A-20, A-22, A-23).

Written tables go under the shared folder named by ``spark.checkpoint.dir`` (never a
machine-local temp folder), one fresh sub-folder per write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def write_partitioned(df: DataFrame, spark: SparkSession, name: str, date_col: str = "date",
                      levels: tuple[str, ...] = ("year", "month"), dealt: bool = False) -> str:
    """A-12/A-22: Hive layout ``year=/month=[/day=]`` derived from the date column. ``dealt``: the rows already are
    dealt by folder and are not moved for it."""
    parts = {"year": F.year(date_col), "month": F.month(date_col), "day": F.dayofmonth(date_col),
             "quarter": F.quarter(date_col)}
    out = df.withColumns({lv: parts[lv].cast("int") for lv in levels})
    path = scratch_path(spark, name)
    (out if dealt else rebalanced(out, levels)).write.mode("overwrite").partitionBy(*levels).parquet(path)
    return path


def rebalanced(df: DataFrame, levels) -> DataFrame:
    """Rows grouped by the partition columns for few files per folder; AQE splits a large folder over
    several writer tasks and merges small ones, so no folder is bound to one task."""
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({', '.join(levels)}) */ * FROM {{df}}", df=df)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Filters on the partition columns prune folders (PartitionFilters in the scan)."""
    return spark.read.option("basePath", path).parquet(path)


def fingerprint_expr(cols: list[str]):
    """A-13: order-free content fingerprint; decimal sum so ANSI mode never overflows."""
    return F.sum(F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)"))


def partition_fingerprints(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprint and row count per partition key (one partial aggregate)."""
    value_cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(fingerprint_expr(value_cols).alias("fingerprint"), F.count(F.lit(1)).alias("rows"))


def changed_partitions(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A-14: partitions whose fingerprint differs (added, removed or changed)."""
    a = partition_fingerprints(old, keys).withColumnsRenamed({"fingerprint": "old_fp", "rows": "old_rows"})
    b = partition_fingerprints(new, keys).withColumnsRenamed({"fingerprint": "new_fp", "rows": "new_rows"})
    j = a.join(b, keys, "full_outer")
    status = (F.when(F.col("old_fp").isNull(), F.lit("added")).when(F.col("new_fp").isNull(), F.lit("removed"))
              .when(F.col("old_fp") != F.col("new_fp"), F.lit("changed")).otherwise(F.lit("same")))
    return j.withColumn("status", status).filter(F.col("status") != "same")


def refresh(spark: SparkSession, path: str, fresh: DataFrame, keys: list[str], age_hours: float,
            max_age_hours: float = 24.0) -> DataFrame:
    """A-14: if the stored copy is older than ``max_age_hours``, make it equal to ``fresh`` by rewriting
    only the added and changed partitions and deleting the removed ones.

    Returns the change list, without rows when the copy is young enough. The list is written before the
    lake is touched, because it is derived from the files that the rewrite replaces.
    """
    stored = read_partitioned(spark, path).select(fresh.columns)
    changes = changed_partitions(stored, fresh, keys)
    if age_hours < max_age_hours:
        return changes.limit(0)
    listed = scratch_path(spark, "refresh-changes")
    changes.write.parquet(listed)
    changes = spark.read.schema(changes.schema).parquet(listed)
    to_write = fresh.join(changes.filter(F.col("status") != "removed").select(*keys), keys, "left_semi")
    (rebalanced(to_write, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))
    for gone in changes.filter(F.col("status") == "removed").select(*keys).toLocalIterator():  # one row per folder
        delete_folder(spark, f"{path}/" + "/".join(f"{k}={gone[k]}" for k in keys))
    return changes


def delete_folder(spark: SparkSession, path: str) -> None:
    """Through the cluster's file system, which need not be this machine's."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def latest_per(df: DataFrame, key: str, ts: str) -> DataFrame:
    """A-19/A-20/A-23: newest row per key (registry, run log, model pointer)."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_r")).select(key, "_r.*")


def annotate(df: DataFrame, meta: dict[str, str]) -> DataFrame:
    """A-18: attach metadata to every column (survives Parquet)."""
    return df.select(*[F.col(c).alias(c, metadata=dict(meta)) for c in df.columns])


def is_nonempty(df: DataFrame) -> bool:
    """A-17: cheap emptiness check (reads at most one row)."""
    return not df.isEmpty()


def require_tables(tables: dict, names: list[str]) -> None:
    """A-16: raise on a missing input table."""
    missing = [n for n in names if n not in tables]
    if missing:
        raise ValueError(f"Missing required table(s): {', '.join(missing)}")


# Tables keyed without a date range (A-15).
STATIC_TABLES = ("raw_dsenames", "raw_dsfhdr")


def table_path(root: str, name: str, start=None, end=None) -> str:
    """A-15: static tables live under one fixed name; dated extracts under their range."""
    if name in STATIC_TABLES or start is None:
        return f"{root}/{name}"
    return f"{root}/{name}_{start}_{end}"
