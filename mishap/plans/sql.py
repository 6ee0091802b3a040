"""SQL surface (Q0-Q3).

Spark's own SQL engine does all parsing and planning; this module only
holds query texts.  Frames are passed as ``{accidents}`` arguments of
``spark.sql``, so no session-global view is needed; ``register_view`` is
there for users who want to type their own SQL against the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from mishap.constants import TOP_HIGH_SEVERITY_CITIES

VIEW_NAME = "accidents"

HIGH_SEVERITY_BY_CITY = """
SELECT city, count(*) AS high_severity_count
FROM {accidents}
WHERE severity = 'High'
GROUP BY city
ORDER BY high_severity_count DESC, city
LIMIT {k}
"""

WEATHER_SEVERITY_CROSS = """
SELECT weather_condition, severity, count(*) AS count
FROM {accidents}
GROUP BY weather_condition, severity
ORDER BY weather_condition, severity
"""

MONTHLY_HIGH = """
SELECT month_year, count(*) AS accidents, count_if(severity = 'High') AS high_count
FROM {accidents}
GROUP BY month_year
ORDER BY month_year
"""


def register_view(clean_df: DataFrame, name: str = VIEW_NAME) -> str:
    """Q0: expose the frame as a temporary view for free-form SQL."""
    clean_df.createOrReplaceTempView(name)
    return name


def run_sql(clean_df: DataFrame, text: str, **params) -> DataFrame:
    """Run SQL text with ``{accidents}`` bound to the frame."""
    return clean_df.sparkSession.sql(text, accidents=clean_df, **params)


def high_severity_by_city(clean_df: DataFrame, k: int = TOP_HIGH_SEVERITY_CITIES) -> DataFrame:
    """Q1: cities with the most High-severity accidents (top k)."""
    return run_sql(clean_df, HIGH_SEVERITY_BY_CITY, k=int(k))


def weather_severity_cross(clean_df: DataFrame) -> DataFrame:
    """Q2: weather x severity counts."""
    return run_sql(clean_df, WEATHER_SEVERITY_CROSS)


def monthly_high(clean_df: DataFrame) -> DataFrame:
    """Q3: per month: accidents and High-severity accidents."""
    return run_sql(clean_df, MONTHLY_HIGH)
