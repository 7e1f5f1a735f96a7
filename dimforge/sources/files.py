"""File sources and sinks beyond the driver parquet: CSV with header, catalog tables, temp views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header row.

    With ``schema`` the columns are typed on read (no extra pass). Without
    it, ``infer=True`` samples the data to guess types (an extra full read,
    fine for small dimension files only); ``infer=False`` keeps every column
    a string, as the untyped notebook did.
    """
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", infer).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def as_view(df: DataFrame, prefix: str = "v") -> str:
    """Register ``df`` under a fresh temp-view name (no clash between concurrent jobs)."""
    name = f"{prefix}_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    return name
