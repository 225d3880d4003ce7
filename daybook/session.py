"""Session helpers.

Reports never depend on the session time zone: every day boundary and label is
computed from epoch values with an explicit zone (see ``functions.dates``). The
builder below is for tests, the bench and local runs; on a cluster the session
comes from spark-submit and only ``checkpoint_dir`` is consulted.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook",
                  extra: dict | None = None, call_site_context: bool = True) -> SparkSession:
    """A local[N] session with AQE on, UI off and UTC as the display zone.

    ``call_site_context=False`` stops PySpark from recording the Python call
    site of every Column function (a few JVM round trips per call); errors then
    lack the DataFrame query context. The bench uses it.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce small shuffles to the advisory size instead of keeping one task per core
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    if not call_site_context:
        builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared filesystem). Only
    when it is unset (tests, local runs) is a fresh scratch folder created and
    registered, so lineage cuts never land on a machine-local path on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:          # set from spark.checkpoint.dir at start; setting it again would nest a new folder
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="daybook-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage at a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
