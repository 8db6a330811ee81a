"""P5 rename / subset projection (silver → gold)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """``{output_name: input column name or Column}`` in output order."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k)
                       for k, v in mapping.items()])
