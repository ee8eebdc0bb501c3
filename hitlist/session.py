"""Session construction and stage tables in the shared folder."""

from __future__ import annotations

import os
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every pipeline relies on. AQE re-plans joins from measured stage sizes
# (broadcast only when the materialised side is under the threshold, sort-merge
# otherwise), splits skewed join partitions and coalesces small shuffle outputs.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "hitlist", more: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench (a cluster passes its own session)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.memory": os.environ.get("HITLIST_DRIVER_MEMORY", "8g"),
        }
    )
    for k, v in (conf | (more or {})).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for stage tables, which all executors must see: ``spark.checkpoint.dir``
    where the session names one, else a folder below the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages").rstrip("/")


def store(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table below the shared folder and read it back.

    Used at stage boundaries that several branches read (raw chart, cleaned chart, stored
    model): the stage is computed once, later filters cannot be pushed back into the long
    chain of cleaning projections (which Catalyst would otherwise inline, growing the plan
    with every rule), its columns are pruned and its filters pushed down when it is read, and
    a lost executor recomputes from the table, not from the scans.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expire_stages(spark: SparkSession, older_than_hours: float) -> int:
    """Delete stage tables of finished jobs: folders below the shared one, not written to for so
    many hours, that ``store`` named. How many went."""
    where = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    before = time.time() * 1000 - older_than_hours * 3_600_000
    gone = 0
    for status in fs.listStatus(where) if fs.exists(where) else []:
        named = re.search(r"[-_][0-9a-f]{32}$", status.getPath().getName())
        if status.isDirectory() and named and status.getModificationTime() < before:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone
