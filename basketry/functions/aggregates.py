"""One-row frames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_row(df: DataFrame, **metrics: Column) -> DataFrame:
    return df.agg(*[metric.alias(name) for name, metric in metrics.items()])


def literal_row(spark: SparkSession, schema: T.StructType, *values: Any) -> DataFrame:
    """A row of driver values, built from literals: no Python worker takes part."""
    return spark.range(1).select(
        *[F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(schema, values)]
    )
