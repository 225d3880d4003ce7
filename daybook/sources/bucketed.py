"""Bucketed tables: a large table is shuffled once, when it is stored, and never by the joins that follow.

The entitlement table is the largest of the membership inputs and each report joins it by
``order_id``. Stored in buckets of that key, its side of the join is read as it lies: the
other side, the (much smaller) orders of the report, is dealt to the same buckets. Sorted
buckets also spare the sort where a bucket is one file.

The number of buckets is fixed when the table is created; take the table's size divided
by what a task should read (say 256 MB). A bucket is a task, so the key must not be one that
a large part of the rows shares; order ids are not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def store_bucketed(df: DataFrame, name: str, key: str, buckets: int, *, columns: Sequence[str] | None = None,
                   fmt: str = "parquet") -> None:
    """(Re)write a catalog table in ``buckets`` buckets of ``key``, one sorted file each.

    The rows are dealt by the key before they are written: the same hash that buckets use, so each task
    writes one file and not one for every bucket.
    """
    rows = df.select(*columns) if columns else df
    (rows.repartition(buckets, F.col(key)).write.format(fmt).mode("overwrite")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, str]:
    """(buckets, key) of a table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return int(rows["Num Buckets"]), rows["Bucket Columns"].strip("[]`")
