"""Driver tables (one parquet file or folder per table)."""

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV with a header, every column as text. ``multi_line`` reads line breaks inside
    quotes; such files cannot be split, so each is one task."""
    reader = spark.read.option("header", True).option("escape", '"').option("inferSchema", False)
    return reader.option("multiLine", multi_line).csv(path)
