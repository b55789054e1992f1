"""Table scans and the other file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The file formats of an external table. "avro" needs the
# spark-avro module on the classpath.
PROFILES = ("text", "csv", "parquet", "orc", "avro")


def scan(spark: SparkSession, table_or_path: str) -> DataFrame:
    """A catalog table, or a parquet path if the name holds a slash."""
    if "/" in table_or_path:
        return spark.read.parquet(table_or_path)
    return spark.table(table_or_path)


def read_profile(
    spark: SparkSession,
    profile: str,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    header: bool = False,
    **options: str,
) -> DataFrame:
    """An external table over all files below a path.

    Text formats take a declared schema; the others carry their own.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}, one of {', '.join(PROFILES)}")
    if profile == "csv" and schema is None:
        raise ValueError("csv needs a declared schema")
    reader = spark.read.format(profile).options(**options)
    if profile == "csv":
        reader = reader.option("header", str(header).lower()).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_profile(df: DataFrame, profile: str, path: str, **options: str) -> None:
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}, one of {', '.join(PROFILES)}")
    df.write.format(profile).options(**options).save(path)
