"""Random choice that a retried task, another partitioning or another session repeats.

The random number of a row is a function of its row id and a seed, never of its place. It is uniform in (0, 1) with 52 bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.skew import SALT, salt_of
from weftline.operators.windows import top_n_per

DRAW = "_draw"
BITS = 52
SALTS = 32  # shares of a group that are cut down to size apart, before they meet


def uniform(row_id: Sequence[str], seed: int = 0) -> Column:
    """The random number of a row, in (0, 1). Nulls in the row id count as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_id]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    bits = F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << BITS))


def sample_share(df: DataFrame, share: float, row_id: Sequence[str], seed: int = 0) -> DataFrame:
    """About ``share`` of the rows. A larger share holds every row of a smaller one; no shuffle."""
    return df.where(uniform(row_id, seed) < share)


def sample_per_group(
    df: DataFrame, keys: Sequence[str], n: int, row_id: Sequence[str], seed: int = 0, weight: str | None = None, salts: int = SALTS
) -> DataFrame:
    """``n`` rows of each group without replacement, or the whole group if it has no more.

    Drawn are the rows with the smallest random numbers, ties to the smaller row id. With ``weight`` a row's number is
    exponential with that rate, which draws one row after the other by weight; rows whose weight is null or not above zero
    are never drawn. Each task, then each of ``salts`` shares of a group, keeps ``n`` rows per group before the group meets.
    """
    draw = uniform(row_id, seed)
    if weight:
        df, draw = df.where(F.col(weight) > 0), -F.ln(draw) / F.col(weight)
    drawn = df.withColumns({DRAW: draw, SALT: salt_of(row_id, salts)})
    order = [F.col(DRAW).asc(), *[F.col(c).asc() for c in row_id]]
    shares = top_n_per(drawn, [*keys, SALT], order, n)
    return top_n_per(shares, keys, order, n).drop(DRAW, SALT)
