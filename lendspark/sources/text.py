"""CSV tables and JSON sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.types import StructType


def csv_reader(spark: SparkSession) -> DataFrameReader:
    """Reader of quoted CSV with a header: doubled quotes, line breaks and outer blanks kept."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the data once more to infer it.

    A field may hold line breaks, so a file is read by one task; ``write_csv`` writes
    one file per task.
    """
    reader = csv_reader(spark)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV that ``read_csv`` reads back unchanged, but for empty text, which reads as null."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
