"""Reading the sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def month_spec(ts: str) -> Column:
    return F.concat(F.lit("year="), F.date_format(ts, "yyyy"), F.lit("/month="), F.date_format(ts, "MM"))


def text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")
