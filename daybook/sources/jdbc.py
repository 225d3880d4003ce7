"""JDBC source and sinks (report inputs from a database, results into one).

Connection details (URL, user, password, driver) always come from the caller;
nothing is stored in code. Reads are parallel when a numeric
``partition_column`` and bounds are given (one query per partition instead of
a single connection); a ``query`` is pushed to the database as a subquery.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_source(spark: SparkSession, url: str, *, table: str | None = None, query: str | None = None,
                properties: Mapping[str, str] | None = None, partition_column: str | None = None,
                lower_bound: int | None = None, upper_bound: int | None = None,
                num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Read ``table`` or ``query`` (exactly one) over JDBC."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    bounds = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(b is not None for b in bounds) and not all(b is not None for b in bounds):
        raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    # Spark wraps a partitioned read's statement itself; a query becomes a subquery table
    dbtable = table if table is not None else f"({query}) q"
    reader = reader.option("dbtable", dbtable)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def jdbc_sink(df: DataFrame, url: str, table: str, *, mode: str = "append",
              properties: Mapping[str, str] | None = None, truncate: bool = True,
              batch_size: int = 5_000, num_partitions: int | None = None) -> None:
    """Write ``df`` into ``table``.

    ``mode="append"`` adds rows (not rerun-safe: prefer exporting from a
    rerun-safe file table with ``mode="overwrite"``); ``"overwrite"`` replaces
    the table, keeping its definition when ``truncate``. ``num_partitions``
    caps concurrent connections.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    # repartition, not coalesce: coalesce would run the stages above in as few tasks
    out = df.repartition(num_partitions) if num_partitions else df
    writer = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size)))
    if mode == "overwrite":
        writer = writer.option("truncate", "true" if truncate else "false")
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()
