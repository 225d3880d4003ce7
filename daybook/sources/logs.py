"""Launcher log input: day-folder layout, input gate and one multi-day JSON read.

Logs are gzip JSON lines under ``{root}/{yyyy-MM-dd}/{part}/*.gz``. All days a
report needs are read with an explicit schema (no inference pass), one scan per day
folder in a union; each row carries ``log_day``, the day whose folder was read.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import iso
from .schemas import LOG_RECORD


class MissingInputError(FileNotFoundError):
    """A report input folder holds no log file."""


def day_glob(root: str, day, pattern: str = "*/*.gz") -> str:
    return f"{root.rstrip('/')}/{iso(day)}/{pattern}"


def _path_missing(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    return (cond() if cond else None) == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(exc)


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise ``MissingInputError`` naming every glob that matches no file.

    Resolving a file source lists the matching files on the driver (metadata
    only, nothing is read); a glob without matches fails with PATH_NOT_FOUND.
    """
    missing = []
    for p in paths:
        try:
            spark.read.format("text").load(p)
        except AnalysisException as exc:
            if not _path_missing(exc):
                raise
            missing.append(p)
    if missing:
        raise MissingInputError(f"no input files: {', '.join(missing)}")


def read_logs(spark: SparkSession, root: str, days: Iterable, *, schema: StructType = LOG_RECORD,
              pattern: str = "*/*.gz", check: bool = True, corrupt_column: str | None = None) -> DataFrame:
    """Log records of ``days`` with a ``log_day`` string column (folder day).

    A day folder without log files raises ``MissingInputError`` naming every
    missing day (``check=False`` re-raises Spark's error instead). gzip is not
    splittable: each file is one task, so producers should write many moderate
    files (or a splittable format) per day. ``corrupt_column`` keeps the text of
    malformed lines in that column (their fields are NULL) instead of dropping
    them silently.
    """
    days = [iso(d) for d in days]
    paths = [day_glob(root, d, pattern) for d in days]
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    try:
        # the day is a literal of its own read, never parsed from a path: a dated root can't shift it
        parts = [reader.schema(schema).json(p).withColumn("log_day", F.lit(d))
                 for p, d in zip(paths, days, strict=True)]
    except AnalysisException as exc:
        if check and _path_missing(exc):
            require_inputs(spark, paths)   # names every missing day, not only the first
        raise
    return reduce(DataFrame.unionAll, parts)
