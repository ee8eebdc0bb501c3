"""Employee records derived from the driver tables (customers as staff).

Each customer becomes an employee: its market segment names the department,
its first order date the joining date, its order total the sales total.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlist.sources.tables import read_csv, read_table


def employee_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with the eleven employee-data columns.

    Orders are reduced to one row per customer with a map-side partial aggregate
    before the (sort-merge) join with customers; nation is a 25-row dimension that
    Spark broadcasts from its measured file size.
    """
    orders = read_table(spark, sf_dir, "orders")
    per_cust = orders.groupBy("o_custkey").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_date"),
        # exact cents summed as a long (a decimal(28,2) sum buffer goes through BigDecimal)
        F.sum((F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("long")).alias("total_cents"),
    )
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    joined = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").join(
        per_cust, cust.c_custkey == per_cust.o_custkey, "left"
    )
    return joined.select(
        k.cast("int").alias("EmployeeID"),
        F.col("c_name").alias("EmployeeName"),
        (F.lit(20) + k % 45).cast("int").alias("Age"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit("Sales"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("Support"))
        .otherwise(F.col("c_mktsegment"))
        .alias("Department"),
        F.col("first_date").alias("DateOfJoining"),
        (k % 23).cast("int").alias("YearsOfExperience"),
        F.col("n_name").alias("Country"),
        # whole thousandths, so that a mean of values fixed to cents first would be wrong
        (((F.col("c_acctbal").cast("decimal(18,2)") * 1000).cast("long") + 20_000_000 + k % 1000).cast("double") / F.lit(1000.0)).alias(
            "Salary"
        ),
        (F.lit(1) + k % 5).cast("int").alias("PerformanceRating"),
        (F.lit(1) + k % 4).cast("int").alias("SupportRating"),
        # thousandths / 1000 in double arithmetic is the correctly rounded value of the
        # exact decimal, as a decimal -> double cast is
        F.when(k % 5 == 2, F.lit(None).cast("double"))
        .otherwise((F.col("total_cents") * 10 + k % 7).cast("double") / F.lit(1000.0))
        .alias("TotalSales"),
    )


def read_employee_data(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """Employee data from a file: CSV (header, all text) or Parquet, bound by column
    name and cast to the employee-data schema."""
    from hitlist.schemas import EMPLOYEE_DATA

    if fmt == "csv":
        raw = read_csv(spark, path, multi_line)
    else:
        raw = spark.read.format(fmt).load(path)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in EMPLOYEE_DATA.fields])
