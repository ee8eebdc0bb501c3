"""Stored tables bucketed by their key, so that joins on the key leave them where they are.

A bucketed table has one sorted file a bucket, dealt by Spark's own hash of the key. A join or
an aggregate on the whole key reads it in that partitioning: the stored side has no exchange and
no sort, and only the other side, a drop, is shuffled. Files are plain Parquet; the bucketing is in
the session's catalog, and ``attach`` puts it there again for files of an earlier session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hitlist.session import shared_folder


def _identifier(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}".replace("-", "_")


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_bucketed(
    df: DataFrame, name: str, key_cols: list[str], buckets: int | None = None, path: str | None = None
) -> DataFrame:
    """``df`` written as a table in ``buckets`` files by ``key_cols``, and read back."""
    spark = df.sparkSession
    n, table = buckets or default_buckets(spark), _identifier(name)
    where = path or f"{shared_folder(spark)}/{table}"
    # the same hash deals rows to tasks and to buckets: a task writes one file
    dealt = df.repartition(n, *[f"`{c}`" for c in key_cols])
    dealt.write.bucketBy(n, *key_cols).sortBy(*key_cols).format("parquet").option("path", where).saveAsTable(table)
    return spark.table(table)


def attach(spark: SparkSession, path: str, name: str, key_cols: list[str], buckets: int) -> DataFrame:
    """Files that ``store_bucketed`` wrote with this key and number of buckets, as a table of
    this session."""
    table = _identifier(name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    keys = ", ".join(f"`{c}`" for c in key_cols)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)
