"""Get-or-insert of dimension rows by natural key."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.keys import assign_ids
from gleanery.operators.lineage import cut


class Grown(NamedTuple):
    """A dimension after an insert: every row, and the rows that are new."""

    rows: DataFrame
    added: DataFrame


def first_seen(wanted: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the earliest one. Copies collapse before the shuffle."""
    rest = [c for c in wanted.columns if c != key and c not in order]
    rows = wanted.where(F.col(key).isNotNull())
    if not rest:
        return rows.select(key).distinct()
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(key).agg(picked).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def get_or_insert(
    existing: DataFrame, wanted: DataFrame, key: str, id_column: str, order: list[str] | None = None
) -> Grown:
    """Add the keys that are not there yet, with ids after the largest one in use.

    `wanted` may repeat a key; the row that comes first in `order` gives the values.
    Columns that `wanted` lacks stay null, and columns `existing` lacks are ignored,
    so an optional column is written only where the dimension has it.
    """
    firsts = first_seen(wanted, key, order) if order else wanted.where(F.col(key).isNotNull())
    new = firsts.join(existing.select(key), key, "left_anti")
    # Made from the whole batch and read by every lookup of the run: written once.
    numbered = assign_ids(new, F.col(key), id_column, existing.select(id_column))
    types = dict(existing.dtypes)
    added = numbered.select(
        *[
            (F.col(c).cast(types[c]) if c in numbered.columns else F.lit(None).cast(types[c])).alias(c)
            for c in existing.columns
        ]
    )
    added = cut(added)
    return Grown(existing.unionByName(added), added)


def insert_ignore(existing: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `wanted` whose key is not there yet, once per key.

    Keys with a null part never collide, as in a unique constraint.
    """
    columns = existing.columns
    rows = wanted.select(*columns)
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    rest = [c for c in columns if c not in key]
    keyed = rows.where(~null_key)
    if rest:
        keyed = (
            keyed.groupBy(*key)
            .agg(F.min(F.struct(*rest)).alias("_row"))
            .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])
            .select(*columns)
        )
    else:
        keyed = keyed.distinct()
    return keyed.join(existing.select(*key), key, "left_anti").select(*columns).unionByName(rows.where(null_key))
