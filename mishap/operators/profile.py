"""S3: shape of a frame as a small table (one aggregate, no per-column jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-NULL count, row count."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"_nn{i}").alias("non_null"), F.col("_rows").alias("rows"))
        for i, f in enumerate(df.schema.fields)])
    return counts.select(F.inline(rows))


def head(df: DataFrame, n: int = 5, *order) -> DataFrame:
    """T5: the first ``n`` rows, of the given order if there is one (a bounded top-k)."""
    return (df.orderBy(*order) if order else df).limit(n)
