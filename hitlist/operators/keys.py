"""K1: dense surrogate keys equal to the rank of a natural key, without a global sort.

``row_number() OVER (ORDER BY key)`` would move every row into one task. Instead:

1. range-partition on the natural key (a sampled, parallel shuffle) and sort inside
   each partition; stamp each row with its partition id and position;
2. store that as a table in the shared folder, so the counting pass and the numbering
   pass see identical positions even if an executor is lost;
3. count rows per partition (one row per partition), turn the counts into
   cumulative offsets, and broadcast that table (its size is the partition count);
4. id = offset of the partition + position inside it + ``start``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlist.session import store


def _order_cols(cols: list[str | Column]) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(f"`{c}`").asc_nulls_last() if isinstance(c, str) else c)
    return out


def with_dense_id(
    df: DataFrame,
    order_by: list[str | Column],
    id_col: str,
    start: Column | int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = start + 0-based rank of the row in ``order_by`` (NULLS LAST)."""
    keys = _order_cols(order_by)
    # Without an explicit count AQE sizes the range partitions from the data; it only
    # merges *contiguous* partitions, so partition ids stay in key order.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    staged = store(
        ranged.sortWithinPartitions(*keys)
        .withColumn("_k1_part", F.spark_partition_id())
        .withColumn("_k1_pos", F.monotonically_increasing_id()),
        "numbered",
    )
    # One row per partition: the partition count bounds this table, so it is broadcast.
    counts = staged.groupBy("_k1_part").agg(F.count(F.lit(1)).alias("_k1_n"), F.min("_k1_pos").alias("_k1_first"))
    offsets = counts.select(
        "_k1_part",
        "_k1_first",
        F.coalesce(
            F.sum("_k1_n").over(Window.orderBy("_k1_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_k1_off"),
    )
    base = start if isinstance(start, Column) else F.lit(start)
    out = staged.join(F.broadcast(offsets), "_k1_part").withColumn(
        id_col, (base + F.col("_k1_off") + F.col("_k1_pos") - F.col("_k1_first")).cast("long")
    )
    return out.drop("_k1_part", "_k1_pos", "_k1_first", "_k1_off")
