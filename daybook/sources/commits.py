"""Commits of partitions by location, for catalog tables.

Rows are first written whole into a fresh folder of their run, ``<table>/_runs/<run>``,
where no reader looks. Only when that write has succeeded does the catalog turn the
run's partitions to the new folders, each by one statement (``ADD PARTITION ...
LOCATION`` for all new ones together, ``SET LOCATION`` for one that there was). So

* a run that dies while it writes changes nothing: every partition stays readable
  and whole, and a rerun starts a folder of its own;
* a partition is the old one or the new one, never a mixture; a run that dies between
  two statements leaves some partitions old and some new, each whole, until the rerun;
* a reader that has planned on the old folder finishes on it, as nothing is moved or
  overwritten. Folders that no partition names any longer can be removed once such
  readers are done; ``live_folders`` lists those in use.

Partition columns of such tables are strings or ints; their values name the folders.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import changes


def new_run() -> str:
    """A fresh name for a run's folder; names sort by the time of the run."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(values: dict[str, str | None]) -> str:
    return ", ".join(f"`{c}` = {'NULL' if v is None else _quoted(v)}" for c, v in values.items())


def table_folder(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return unquote(described["data_type"])


def partitions(spark: SparkSession, name: str, owned: tuple[str, object] | None = None) -> list[dict[str, str | None]]:
    """The partitions that the catalog knows, or those of them with ``owned`` = (column, value)."""
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        values = {c: None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v)
                  for c, v in (part.split("=", 1) for part in row[0].split("/"))}
        if owned is None or values[owned[0]] == str(owned[1]):
            out.append(values)
    return out


def live_folders(spark: SparkSession, name: str) -> list[str]:
    """The folders that the table's partitions name, sorted."""
    folders = set()
    for values in partitions(spark, name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({_spec(values)})").where("col_name = 'Location'")
        folders.add(unquote(rows.first()["data_type"]))
    return sorted(folders)


def drop_partition(spark: SparkSession, name: str, values: dict[str, str | None]) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(values)})")


def ensure_table(spark: SparkSession, name: str, like: DataFrame, partition_cols: Sequence[str], fmt: str) -> None:
    """The first run creates the table, empty, with the columns of its rows (whose plan is not run)."""
    if not spark.catalog.tableExists(name):
        empty = like.select(*[c for c in like.columns if c not in partition_cols], *partition_cols)
        spark.createDataFrame([], empty.schema).write.format(fmt).partitionBy(*partition_cols).saveAsTable(name)


def write_run(df: DataFrame, folder: str, partition_cols: Sequence[str], *, fmt: str = "parquet",
              max_records_per_file: int | None = None) -> list[tuple[dict[str, str | None], str]]:
    """Write a run's rows and return its partitions with their folders, once all of them are there."""
    writer = df.write.format(fmt).partitionBy(*partition_cols).mode("errorifexists")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(folder)
    spark, types = df.sparkSession, dict(df.dtypes)
    stored = spark.read.format(fmt).schema(", ".join(f"`{c}` {types[c]}" for c in df.columns)).load(folder)
    # reads no column: partition values and the names of the files
    place = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    found = stored.select(*(F.col(c).cast("string").alias(c) for c in partition_cols), place.alias("_folder")).distinct()
    return [({c: row[c] for c in partition_cols}, unquote(row["_folder"])) for row in found.collect()]


def turn_to(spark: SparkSession, name: str, written: Sequence[tuple[dict[str, str | None], str]],
            owned: tuple[str, object] | None = None, *, track: str | None = None, run: str | None = None) -> None:
    """Make the table's partitions name the folders of a finished run.

    With ``owned`` = (column, value), partitions of that value that the run doesn't have go. ``track``
    names a partition column; its values among the partitions that change are noted for derived tables.
    """
    if track is not None:
        touched = [values[track] for values, _ in written]
        touched += [values[track] for values in partitions(spark, name, owned)] if owned is not None else []
        run = run or new_run()
        changes.note(spark, name, run, touched, changes.BEGUN)
    key = lambda values: tuple(sorted(values.items()))
    known = {key(values) for values in partitions(spark, name)}
    new = [(values, folder) for values, folder in written if key(values) not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
            f"PARTITION ({_spec(values)}) LOCATION {_quoted(folder)}" for values, folder in new))
    for values, folder in written:
        if key(values) in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(values)}) SET LOCATION {_quoted(folder)}")
    if owned is not None:
        mine = {key(values) for values, _ in written}
        for values in partitions(spark, name, owned):
            if key(values) not in mine:
                drop_partition(spark, name, values)
    spark.catalog.refreshTable(name)
    if track is not None:
        changes.note(spark, name, run, touched, changes.ENDED)


def commit_partitions(df: DataFrame, name: str, partition_cols: Sequence[str], *,
                      owned: tuple[str, object] | None = None, fmt: str = "parquet", run: str | None = None,
                      track: str | None = None, max_records_per_file: int | None = None) -> list[dict[str, str | None]]:
    """Replace the partitions of a catalog table that ``df`` has rows of, and return them.

    With ``owned`` the run owns every partition of that (column, value), also those it has no
    rows of. ``df`` may read the table itself: its partitions stay what they are until
    the run has been written. The first run creates the table. ``track``: see ``sources.changes``.
    """
    spark, run = df.sparkSession, run or new_run()
    if owned is not None:
        df = df.withColumn(owned[0], F.lit(owned[1]))
    ensure_table(spark, name, df, partition_cols, fmt)
    folder = f"{table_folder(spark, name).rstrip('/')}/_runs/{run}"
    columns = [c for c in spark.table(name).columns if c not in partition_cols]
    written = write_run(df.select(*columns, *partition_cols), folder, partition_cols, fmt=fmt,
                        max_records_per_file=max_records_per_file)
    turn_to(spark, name, written, owned, track=track, run=run)
    return [values for values, _ in written]
