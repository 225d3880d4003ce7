"""File tables: rerun-safe partition writes and partition-pruned reads.

Plain ``append`` (what a blind daily job does) duplicates a day when the job is
rerun or a task is retried after a partial commit. The writers here replace the one
partition directory a run owns as a whole, also when the run has no rows, so a rerun
leaves exactly its own rows: none twice, and none that the rerun no longer has. Catalog
tables are committed by location (``sources.commits``): a job that dies while it writes
leaves the former partition. A table that is only a path has no such switch; there the
job's own partition is incomplete until it is rerun:

* daily order fact and daily reports: partitioned by ``date``; one run owns one date.
* page-stay rows: ``dt`` comes from each record, so a run for day D also
  carries late rows of earlier days. Overwriting by ``dt`` would erase the
  earlier days' other rows, so the table is partitioned by ``load_date, dt``
  and a run replaces only its own ``load_date``. Reports still filter on
  ``dt`` and get partition pruning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_key, iso
from .commits import commit_partitions
from .schemas import DAILY_FACT, PAGE_STAY


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], *,
                     fmt: str = "parquet", mode: str = "replace",
                     max_records_per_file: int | None = None) -> None:
    """Write ``df`` partitioned by ``partition_cols``.

    ``mode="replace"``: dynamic partition overwrite, only the partitions present
    in ``df`` are replaced. ``mode="append"``: plain append. Each task writes its
    own files (no repartition by the partition column, which would send a whole
    day to one task); ``max_records_per_file`` bounds their size.
    """
    writer = df.write.format(fmt).partitionBy(*partition_cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    writer.save(path)


def replace_partition(df: DataFrame, path: str, owned: tuple[str, object], partition_cols: Sequence[str] = (), *,
                      fmt: str = "parquet", max_records_per_file: int | None = None) -> None:
    """Replace the partition ``owned`` = (column, value) of a table by the rows of ``df``.

    A static overwrite of the ``column=value`` directory: its older files go even if
    ``df`` is empty or holds fewer inner partitions. ``df`` may carry the column; its
    rows must all belong to the partition.
    """
    column, value = owned
    writer = df.drop(column).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(f"{path.rstrip('/')}/{column}={value}")


def is_catalog_name(target: str) -> bool:
    """``db.table`` or ``table``, not a path."""
    return "/" not in target and "\\" not in target


def replace_table_partition(df: DataFrame, name: str, owned: tuple[str, object], partition_cols: Sequence[str] = (), *,
                            fmt: str = "parquet", track: str | None = None) -> None:
    """``replace_partition`` for a catalog table, which the first run creates: committed by location,
    so a run that fails leaves the partitions it owns as they were. ``track``: see ``sources.changes``."""
    commit_partitions(df, name, [owned[0], *partition_cols], owned=owned, fmt=fmt, track=track)


def read_table(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet") -> DataFrame:
    """A catalog table, or a partitioned file table with a declared schema (partition
    columns keep their declared types instead of being inferred as DATE/INT)."""
    if is_catalog_name(path):
        return spark.table(path)
    return spark.read.format(fmt).schema(schema).load(path)


PAGE_STAY_TABLE = T.StructType(PAGE_STAY.fields + [T.StructField("load_date", T.StringType())])
DAILY_FACT_TABLE = DAILY_FACT


def store_page_stay(rows: DataFrame, path: str, load_day, *, fmt: str = "orc", mode: str = "replace") -> None:
    """R6 sink (a path or a catalog table name): page-stay rows of one load (``load_day``) into ``load_date=/dt=`` partitions.

    ``mode="replace"`` replaces everything an earlier run of the load stored.
    """
    if mode == "replace" and is_catalog_name(path):
        replace_table_partition(rows, path, ("load_date", iso(load_day)), ["dt"], fmt=fmt, track="dt")
    elif mode == "replace":
        replace_partition(rows, path, ("load_date", iso(load_day)), ["dt"], fmt=fmt)
    else:
        write_partitions(rows.withColumn("load_date", F.lit(iso(load_day))), path, ["load_date", "dt"],
                         fmt=fmt, mode=mode)


def read_page_stay(spark: SparkSession, path: str, days: Iterable | None = None, *,
                   fmt: str = "orc") -> DataFrame:
    """Stored page stays, pruned to the ``dt`` partitions of ``days``."""
    df = read_table(spark, path, PAGE_STAY_TABLE, fmt=fmt)
    if days is not None:
        df = df.where(F.col("dt").isin([iso(d) for d in days]))
    return df.drop("load_date")


def store_daily_fact(fact: DataFrame, path: str, day=None, *, fmt: str = "parquet", mode: str = "replace") -> None:
    """R4 sink: replaces the partition of ``day``, or without one those present in ``fact`` (a backfill)."""
    if day is not None and mode == "replace" and is_catalog_name(path):
        replace_table_partition(fact, path, ("date", str(date_key(day))), fmt=fmt, track="date")
    elif mode == "replace" and is_catalog_name(path):
        commit_partitions(fact, path, ["date"], fmt=fmt, track="date")
    elif day is not None and mode == "replace":
        replace_partition(fact, path, ("date", date_key(day)), fmt=fmt)
    else:
        write_partitions(fact, path, ["date"], fmt=fmt, mode=mode)


def read_daily_fact(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, DAILY_FACT_TABLE, fmt=fmt)


def read_report(spark: SparkSession, path: str, columns: Sequence[str] | None = None, *,
                fmt: str = "parquet") -> DataFrame:
    """The stored report table (``date`` read back as the int ``yyyyMMdd`` key)."""
    df = spark.table(path) if is_catalog_name(path) else spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df
