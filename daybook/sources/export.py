"""Report exports that readers of the database see whole.

Spark's tasks write over connections of their own, so an append or overwrite is visible while it
runs and part filled when it fails. Here they load a staging table; then one short
transaction on the driver's connection replaces the day (or all rows) in the report table from
it, inside the database. A run that fails before the commit leaves the report table as it was,
and a rerun leaves the same rows.

The report table must exist. Reports hold aggregates, so the moved rows are few.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import date_key
from .jdbc import jdbc_sink

_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*\Z")


def _checked(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a plain table or column name: {name!r}")
    return name


def swap_statements(table: str, staging: str, columns: Sequence[str], day=None, day_column: str = "date") -> list[str]:
    """The statements that replace ``day`` (its ``yyyyMMdd`` key), or without one all rows, by the staged rows."""
    table, staging = _checked(table), _checked(staging)
    listed = ", ".join(map(_checked, columns))
    where = "" if day is None else f" WHERE {_checked(day_column)} = {date_key(day)}"
    return [f"DELETE FROM {table}{where}", f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging}{where}"]


def in_transaction(connection, statements: Sequence[str]) -> None:
    """Run the statements on a ``java.sql.Connection`` as one transaction, and close it."""
    try:
        connection.setAutoCommit(False)
        try:
            for text in statements:
                statement = connection.createStatement()
                try:
                    statement.executeUpdate(text)
                finally:
                    statement.close()
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def connect(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None):
    """A connection of the driver, through the JDBC driver that Spark loads; nothing is collected through it."""
    jvm = spark.sparkContext._jvm
    given = dict(properties or {})
    if driver := given.pop("driver", None):
        jvm.java.lang.Class.forName(driver)
    settings = jvm.java.util.Properties()
    for key, value in given.items():
        settings.setProperty(key, value)
    return jvm.java.sql.DriverManager.getConnection(url, settings)


def staged_export(df: DataFrame, url: str, table: str, *, day=None, day_column: str = "date", staging: str | None = None,
                  properties: Mapping[str, str] | None = None, load: Callable = jdbc_sink,
                  open_connection: Callable = connect) -> None:
    """Load ``df`` into the staging table (``table_staging``), then replace ``day`` or all of ``table`` from it.

    With ``day`` only its rows are loaded.
    """
    staging = staging or f"{table}_staging"
    statements = swap_statements(table, staging, df.columns, day, day_column)      # names are checked before anything is loaded
    rows = df if day is None else df.where(df[day_column] == date_key(day))
    load(rows, url, staging, mode="overwrite", properties=properties)
    in_transaction(open_connection(df.sparkSession, url, properties), statements)
