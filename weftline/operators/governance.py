"""Audit trail, row-level security and column masking."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from weftline.operators.joins import broadcast_if_small


def with_audit(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with metrics that are gathered while it is written, without a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]), seen


def write_audited(df: DataFrame, path: str, audit_path: str, name: str, **metrics: Column) -> None:
    """Write ``df`` and append one line of run metrics to the audit table."""
    audited, seen = with_audit(df, name, **metrics)
    audited.write.parquet(path)
    values = seen.get
    measured = [F.lit(v).cast("long" if isinstance(v, int) else "double").alias(n) for n, v in values.items()]
    line = df.sparkSession.range(1).select(F.lit(name).alias("run"), *measured)
    line.write.mode("append").parquet(audit_path)


def row_security(df: DataFrame, entitlements: DataFrame, user: str, on: str) -> DataFrame:
    """The rows ``user`` may see, by a table of ``user`` and the permitted values of ``on``."""
    allowed = entitlements.where(F.col("user") == user).select(on).distinct()
    return df.join(broadcast_if_small(allowed), on, "left_semi")


def hashed(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def partial(keep: int) -> Callable[[Column], Column]:
    """Keep the last ``keep`` characters and hide the rest, whatever the length."""

    def apply(c: Column) -> Column:
        hidden = F.greatest(F.length(c) - keep, F.lit(0))
        return F.concat(F.repeat(F.lit("*"), hidden), F.right(c, F.lit(keep)))

    return apply


def bucketed(width: float) -> Callable[[Column], Column]:
    return lambda c: F.floor(c / width) * width


def mask(df: DataFrame, policies: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    return df.withColumns({name: policy(F.col(name)) for name, policy in policies.items()})
