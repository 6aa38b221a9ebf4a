"""Row numbers and running sums without a single-task window over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Four hexadecimal digits: at most 65 536 groups, evenly filled, whose sizes one task can add up.
_DIGITS = 4
# More blocks of ids than this are not added up in one task.
_MOST_BLOCKS = 1 << 16


def assign_ids(new: DataFrame, key: Column, id_column: str, taken: DataFrame | None = None) -> DataFrame:
    """Number new rows from `max(id) + 1`, in the order of the digest of their key.

    The key is unique, so digest prefixes split the rows evenly whatever the key
    looks like; only the group sizes, of a bounded number, meet in one task. The same rows
    always get the same numbers. `taken` holds the ids in use, in its first column.
    """
    rows = new.withColumn("_digest", F.md5(key.cast("string"))).withColumn(
        "_group", F.substring("_digest", 1, _DIGITS)
    )
    sizes = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    if taken is not None:
        used = taken.select(F.col(taken.columns[0]).cast("bigint").alias("_id"))
        start = used.agg(F.coalesce(F.max("_id"), F.lit(0)).cast("bigint").alias("_size"))
        sizes = start.select(F.lit("").alias("_group"), "_size").unionByName(sizes)
    before = W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).cast("bigint").alias("_offset")
    )
    within = W.partitionBy("_group").orderBy("_digest")
    return (
        rows.join(F.broadcast(offsets), "_group")
        .withColumn(id_column, F.col("_offset") + F.row_number().over(within))
        .drop("_digest", "_group", "_offset")
    )


def running_total(
    df: DataFrame, group: list[str], position: str, value: str, out: str, block: int = 10_000
) -> DataFrame:
    """Running sum of `value` along an integer position, per group, in two levels.

    Blocks of `block` positions are summed first; their totals are accumulated, and
    each block then runs its own sum. No task sees more than one block of rows.
    """
    rows = df.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
    sums = rows.groupBy(*group, "_block").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    within = W.partitionBy(*group, "_block").orderBy(position).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.join(bases, [*group, "_block"])
        .withColumn(out, F.col("_base") + F.sum(value).over(within))
        .drop("_block", "_base")
    )


def number_by_id(df: DataFrame, id_column: str, out: str, block: int = 1_000_000) -> DataFrame:
    """1-based position of each row in the order of a unique integer id.

    A block covers `block` consecutive ids, hence at most `block` rows. Ids that are
    spread over too many blocks are sorted instead.
    """
    low, high = df.agg(F.min(id_column), F.max(id_column)).first()
    if low is not None and (high - low) // block >= _MOST_BLOCKS:
        from gleanery.operators.pages import number_by_order

        return number_by_order(df, [id_column], out)
    rows = df.withColumn("_block", F.floor(F.col(id_column) / F.lit(block)))
    sizes = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    within = W.partitionBy("_block").orderBy(id_column)
    return (
        rows.join(bases, "_block")
        .withColumn(out, (F.col("_base") + F.row_number().over(within)).cast("bigint"))
        .drop("_block", "_base")
    )
