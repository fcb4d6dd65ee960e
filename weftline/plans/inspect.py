"""Reading plans, for tests and tuning only."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical(df: DataFrame) -> str:
    """Physical plan as text. After an action on the same frame it is the final adaptive plan."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df: DataFrame) -> str:
    """Run a query of small result and return the final adaptive plan."""
    df.collect()
    return physical(df)
