"""Sources and sinks: the two loaders, CSV reading, and persisted results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.dates import age_bucket
from ..functions.names import clean_names
from ..session import scratch_path
from . import fixtures


def risk_loader(raw: DataFrame, birth_col: str = "date_of_birth", repair_century: bool = True) -> DataFrame:
    """Clean names, then replace the raw birth date by its age bucket (one projection)."""
    df = clean_names(raw)
    return df.withColumn(birth_col, age_bucket(birth_col, repair_century))


def load_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_loader(fixtures.raw_assessments(spark, sf_dir))


def load_house(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The house table as read, raw names (cleaning happens in ``combine``)."""
    return fixtures.raw_houses(spark, sf_dir)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    na_values: str = "NA",
) -> DataFrame:
    """Header row, ``NA`` text and blanks read as NULL.

    Prefer an explicit ``schema``: inference costs an extra full pass over the files
    and, at scale, can disagree between files.
    """
    reader = spark.read.option("header", "true").option("nullValue", na_values).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, na_values: str = "NA") -> None:
    df.write.mode("overwrite").option("header", "true").option("nullValue", na_values).csv(path)


def persist_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a result as parquet (re-loadable target); optional ``partitionBy`` for pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a persisted table; pass the written ``schema`` so partition columns keep their type."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def csv_roundtrip(spark: SparkSession, df: DataFrame, infer: bool = False) -> DataFrame:
    """Write ``df`` as CSV to shared scratch space and read it back."""
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    return read_csv(spark, path, schema=None if infer else df.schema)


def persist_roundtrip(spark: SparkSession, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    path = scratch_path(spark, "table")
    persist_table(df, path, partition_by)
    out = load_table(spark, path, df.schema)
    return out.select(*df.columns)
