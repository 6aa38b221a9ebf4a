"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
HEAVY_SHARE = 1 / 256
SALTS = 64


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a lookup for broadcast, but only after counting that it is small.

    The count stops one row past the limit. A larger lookup is returned as it is,
    and the join then shuffles (or is decided by the adaptive planner).
    """
    seen = df.limit(max_rows + 1).count()
    return F.broadcast(df) if seen <= max_rows else df


def heavy_keys(df: DataFrame, on: list[str], share: float = HEAVY_SHARE) -> DataFrame:
    """Keys that hold more than `share` of the rows: never more than 1/share keys."""
    counts = df.groupBy(*on).count()
    total = df.count()
    return counts.where(F.col("count") > total * share).select(*on)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    salts: int = SALTS,
    share: float = HEAVY_SHARE,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """Shuffled equi-join whose heavy left keys are spread over `salts` tasks.

    Only the rows of heavy keys get a salt, and only their right rows are repeated.
    Rows with a null key never match; they are spread as well. `counted_in` is a
    cheaper table with the same key shares, if the left side is costly to compute.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    keys = (left if counted_in is None else counted_in).select(*on)
    heavy = F.broadcast(heavy_keys(keys, on, share).withColumn("_heavy", F.lit(True)))
    spread = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(salts)).cast("int")
    null_key = F.lit(False)
    for key in on:
        null_key = null_key | F.col(key).isNull()
    salted_left = (
        left.join(heavy, on, "left")
        .withColumn("_salt", F.when(F.col("_heavy") | null_key, spread).otherwise(F.lit(0)))
        .drop("_heavy")
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = (
        right.join(heavy, on, "left")
        .withColumn("_salt", F.explode(F.when(F.col("_heavy"), every).otherwise(F.array(F.lit(0)))))
        .drop("_heavy")
    )
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def join_lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join a large table with a lookup: broadcast if counted small, else spread."""
    side = right.limit(max_rows + 1).count()
    if side <= max_rows:
        return left.join(F.broadcast(right), on, how)
    return spread_join(left, right, on, how, spread_by)
