"""Chart sources: the raw weekly chart as CSV (S1) or derived from the driver tables.

The derived form turns order lines into a weekly sales chart of every part sold, with the
same seven columns and value shapes as the published chart file: ``Date`` text,
``Last Week`` text with ``-`` for "not charted last week", and artist credits in shapes
that exercise every cleaning rule.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlist.functions.artist import COMMA_ACT, LEAKED_ANCHOR, PROTECTED_ACTS
from hitlist.operators.keys import with_dense_id
from hitlist.schemas import CHART_COLUMNS, CHART_RAW
from hitlist.session import store
from hitlist.sources.tables import read_csv, read_table


def read_chart_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header CSV, every column read as text, then selected by name and cast.

    Binding by name (not an explicit CSV schema, which Spark binds by position)
    lets the file carry extra or reordered columns. ``multi_line`` reads line breaks
    inside quotes, at the price of one task per file.
    """
    raw = read_csv(spark, path, multi_line)
    return raw.select(
        *[
            F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.dataType.typeName() != "string" else F.col(f"`{f.name}`")
            for f in CHART_RAW.fields
        ]
    )


# Artist credits by part key: every shape that a cleaning rule must handle, among them a
# leaked anchor in either letter case, a missing credit, a repeated keyword and every act
# whose name holds a separator. ``{brand}`` and ``{type}`` are columns of the part.
CREDITS: list[str | None] = [
    "{brand}",
    "{brand} Featuring {type}",
    "{brand} & {type}",
    '"{brand}"',
    "{brand} Feat. {type} x Brand#1",
    "{brand} duet with {type} / Brand#3",
    COMMA_ACT + " Featuring {brand}",
    "{brand} featuring {type}",
    LEAKED_ANCHOR + "{brand}",
    LEAKED_ANCHOR.upper() + "{brand}",
    None,
    "{brand} Featuring {type} Featuring Brand#2",
    "{brand} Feat. {type} & Brand#4",
    "{brand} with {type} + Brand#5",
    *(act + " & {brand}" for act in PROTECTED_ACTS),
]


def _artist_credit(pk: Column, brand: Column, ptype: Column) -> Column:
    columns = {"{brand}": brand, "{type}": ptype}
    shape = (pk % len(CREDITS)).cast("int")
    out = F.lit(None).cast("string")
    for i, credit in enumerate(CREDITS):
        if credit is not None:
            parts = [columns.get(x, F.lit(x)) for x in re.split(r"(\{brand\}|\{type\})", credit) if x]
            out = F.when(shape == i, F.concat(*parts)).otherwise(out)
    return out


def weekly_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part sold in a week, ranked by units sold: (wk, pk, rnk).

    lineitem joins orders on the order key (both large: sort-merge, AQE may split skewed
    keys), units are summed per (week, part) with a map-side partial aggregate. A week can
    hold any number of parts, so it is not ranked by a window over the week, which would be
    one task: the rows are numbered over all weeks in the order (week, units, part) by
    ranges (K1), and a week's rank is the distance to its first number. The table of first
    numbers has a row per week; it is stored, so the planner knows its size and broadcasts it
    below the session's threshold.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    # The week is computed once per order, before the join, so the join (and its
    # shuffle at scale) carries a 4-byte date instead of a timestamp and the
    # truncation runs on orders rather than on every line item.
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_trunc("week", "o_orderdate").cast("date").alias("wk")
    )
    weekly = (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .groupBy("wk", F.col("l_partkey").alias("pk"))
        # units in exact hundredths: each quantity is fixed to decimal(18,2) as
        # specified, then summed as a long (same order as the decimal sum; a
        # decimal(28,2) sum buffer would run every update through BigDecimal)
        .agg(F.sum((F.col("l_quantity").cast("decimal(18,2)") * 100).cast("long")).alias("units"))
    )
    # the numbering has stored its rows already
    numbered = with_dense_id(weekly, ["wk", F.col("units").desc_nulls_last(), "pk"], "number").drop("units")
    first = store(numbered.groupBy(F.col("wk").alias("first_wk")).agg(F.min("number").alias("first")), "first-numbers")
    return numbered.join(first, F.col("wk").eqNullSafe(F.col("first_wk"))).select(
        "wk", "pk", (F.col("number") - F.col("first") + 1).cast("int").alias("rnk")
    )


def chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw chart rows (all seven columns, ``Date`` and ``Last Week`` as text)."""
    chart = weekly_chart(spark, sf_dir)
    by_part = Window.partitionBy("pk").orderBy("wk")  # a part's rows: one per week at most
    hist = chart.select(
        "wk",
        "pk",
        "rnk",
        F.lag("wk").over(by_part).alias("prev_wk"),
        F.lag("rnk").over(by_part).alias("prev_rnk"),
        F.min("rnk").over(by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("peak"),
        F.row_number().over(by_part).cast("int").alias("weeks"),
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    # on the key the history is already partitioned by; Spark broadcasts the parts where
    # their measured size allows
    joined = hist.join(part, part.p_partkey == hist.pk)
    return joined.select(
        F.col("wk").cast("string").alias("Date"),
        F.col("rnk").alias("Rank"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("Song"),
        _artist_credit(F.col("pk"), F.col("p_brand"), F.col("p_type")).alias("Artist"),
        F.when(F.col("prev_wk") == F.date_sub(F.col("wk"), 7), F.col("prev_rnk").cast("string"))
        .otherwise(F.lit("-"))
        .alias("Last Week"),
        F.col("peak").alias("Peak Position"),
        F.col("weeks").alias("Weeks in Charts"),
    )


def bootstrap_flagged(raw: DataFrame) -> DataFrame:
    """S3: the one-time load marks every row as already processed."""
    return raw.select(*[F.col(f"`{c}`") for c in CHART_COLUMNS], F.lit(False).alias("is_new"))

