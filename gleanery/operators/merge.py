"""Upsert of raw rows: last document wins, first identifier stays, holders are unique.

Row-by-row rules, applied to whole imports:

* a stored key takes the latest document and keeps its uuid;
* a new key is accepted if nobody holds its uuid yet, the earliest arrival first;
* an arrival that is not accepted is rejected and logged;
* a null uuid collides with nothing.

Arrivals carry `seq`, any orderable column that gives the order of processing.
Everything is grouped with partial aggregation, so copies of one key collapse
before they are shuffled, and a uuid shared by many keys never meets them in one
group: only its earliest holder is kept.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.operators.components import components
from gleanery.operators.lineage import cut

KEY = S.DATA_KEY


class Merged(NamedTuple):
    """Outcome of an upsert.

    `state`    every stored row afterwards;
    `written`  one row per key touched: stored columns, `writes`, `inserted`
               (documents also have `seq`, their first arrival);
    `rejected` the rejected arrivals.
    """

    state: DataFrame
    written: DataFrame
    rejected: DataFrame


def latest(rows: DataFrame, key: list[str], order: str, how: str = "last") -> DataFrame:
    """One row per key, the last (or first) in the given order."""
    rest = [c for c in rows.columns if c not in key]
    pick = F.max_by if how == "last" else F.min_by
    return (
        rows.groupBy(*key)
        .agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
        .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def _claims(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Arrivals of new keys, one row per (key, uuid): `first_seq`, `hits`."""
    grouped = batch.groupBy(*KEY, "uuid").agg(
        F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("hits")
    )
    return grouped.join(state.select(*KEY), KEY, "left_anti")


def _winners(claims: DataFrame, holders: DataFrame) -> DataFrame:
    """Earliest claimant of each uuid that no stored row holds: one row per uuid."""
    claim = claims.where("uuid IS NOT NULL").select(
        "uuid", F.struct("first_seq", *KEY).alias("_claim"), F.lit(False).alias("_stored")
    )
    held = holders.where("uuid IS NOT NULL").select(
        "uuid", F.lit(None).cast(claim.schema["_claim"].dataType).alias("_claim"), F.lit(True).alias("_stored")
    )
    return (
        claim.unionByName(held)
        .groupBy("uuid")
        .agg(F.min("_claim").alias("_claim"), F.max("_stored").alias("_stored"))
        .where(~F.col("_stored") & F.col("_claim").isNotNull())
        .select("uuid", "_claim.*")
    )


def accept_keys(
    batch: DataFrame, state: DataFrame, holders: DataFrame | None = None, one_uuid_per_key: bool | None = None
) -> tuple[DataFrame, bool]:
    """New keys that get stored: key, `uuid`, `first_seq` (the moment of acceptance).

    Also returns whether every new key came with one uuid only.

    With one uuid per key (the normal case) a single pass decides. A key that came
    with several uuids may take a later one, which can free or block others; then
    the claims fall into components by the keys and uuids they share, and each component is
    settled row by row, in one task. Components of more than `REPLAY_CLAIMS` claims are settled
    in rounds, earliest claims first, until none is left.
    """
    # Read several times below, and made from the keys of the whole table: written once.
    claims = cut(_claims(batch, state))
    if one_uuid_per_key is None:
        several = claims.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        one_uuid_per_key = several.isEmpty()
    holders = state.select("uuid") if holders is None else holders.select("uuid")
    if one_uuid_per_key:
        free = claims.where("uuid IS NULL").select(*KEY, "uuid", "first_seq")
        return _winners(claims, holders).select(*KEY, "uuid", "first_seq").unionByName(free), True

    open_claims = cut(claims.join(holders, "uuid", "left_anti").select(*KEY, "uuid", "first_seq"))
    nobody = holders.limit(0)
    accepted, open_claims = _replayed(open_claims)
    while not open_claims.isEmpty():
        free = open_claims.where("uuid IS NULL").select(*KEY, "uuid", "first_seq")
        best_of_uuid = _winners(open_claims, nobody).select(*KEY, "uuid", "first_seq").unionByName(free)
        best_of_key = latest(open_claims, KEY, "first_seq", "first").select(*KEY, "first_seq")
        settled = cut(best_of_uuid.join(best_of_key, [*KEY, "first_seq"], "left_semi"))
        accepted = settled if accepted is None else accepted.unionByName(settled)
        open_claims = cut(
            open_claims.join(settled.select(*KEY), KEY, "left_anti").join(
                settled.where("uuid IS NOT NULL").select("uuid"), "uuid", "left_anti"
            ).select(*KEY, "uuid", "first_seq")
        )
    return (accepted if accepted is not None else claims.select(*KEY, "uuid", "first_seq").limit(0)), False


#: Claims of a component that one task settles.
REPLAY_CLAIMS = 100_000


def _replayed(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is accepted in all components of bounded size, and the claims of the others."""
    key = F.sha2(F.to_json(F.struct(*KEY), {"ignoreNullFields": "false"}), 256)
    named = cut(claims.withColumn("_key", F.concat(F.lit("k"), key)))
    edges = named.where("uuid IS NOT NULL").select(F.col("_key").alias("a"), F.concat(F.lit("u"), "uuid").alias("b"))
    labels = components(edges).select(F.col("node").alias("_key"), "label")
    placed = cut(named.join(labels, "_key", "left").withColumn("_of", F.coalesce("label", "_key")).drop("label"))
    sizes = placed.groupBy("_of").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > REPLAY_CLAIMS)
    large = cut(sizes.select("_of"))
    small = placed.join(large, "_of", "left_anti").select("_of", "_key", "uuid", "first_seq")
    settled = small.groupBy("_of").applyInArrow(_replay, "_key string, uuid string")
    accepted = cut(placed.join(settled.withColumnRenamed("uuid", "_uuid"), "_key").where(F.col("uuid").eqNullSafe(F.col("_uuid"))))
    rest = placed.join(large, "_of", "left_semi")
    columns = [*KEY, "uuid", "first_seq"]
    return accepted.select(*columns), cut(rest.select(*columns))


def _replay(claims: pa.Table) -> pa.Table:
    """Accept the claims of a component in their order: the first of its key and of its uuid."""
    keys, uuids, moments = claims["_key"].to_pylist(), claims["uuid"].to_pylist(), claims["first_seq"].to_pylist()
    order = sorted(range(len(keys)), key=lambda i: (_moment(moments[i]), keys[i], uuids[i] or ""))
    taken_keys, taken_uuids, out = set(), set(), []
    for i in order:
        if keys[i] not in taken_keys and (uuids[i] is None or uuids[i] not in taken_uuids):
            taken_keys.add(keys[i])
            taken_uuids.add(uuids[i])
            out.append(i)
    return pa.table({"_key": pa.array([keys[i] for i in out], pa.string()), "uuid": pa.array([uuids[i] for i in out], pa.string())})


def _moment(value: object) -> tuple:
    """Sorts as the column does: nulls first, field by field."""
    if isinstance(value, dict):
        return tuple(_moment(v) for v in value.values())
    return (value is not None, value if value is not None else 0)


def upsert_data(
    state: DataFrame,
    batch: DataFrame,
    holders: DataFrame | None = None,
    one_uuid_per_key: bool | None = None,
) -> Merged:
    """Merge one import into the stored rows.

    `state` has the columns of `schemas.DATA_JSON`; `batch` the same and `seq`.
    `holders` gives the uuids in use when `state` is only a part of the table.
    """
    # What is stored of the keys of the batch: all that the decisions below need of the
    # stored rows, so their keys are shuffled here and for the untouched rows only.
    existing = cut(state.select(*KEY, "uuid", "controler").join(batch.select(*KEY).distinct(), KEY, "left_semi"))
    wanted = batch.where("uuid IS NOT NULL").select("uuid").distinct()
    holders = (state if holders is None else holders).select("uuid").join(wanted, "uuid", "left_semi")
    accepted, one_uuid_per_key = accept_keys(batch, existing, holders, one_uuid_per_key)
    payload = [c for c in state.columns if c not in (*KEY, "uuid", "controler")]
    arrivals = batch.select(*KEY, "controler", *payload, "seq")
    grouped = arrivals.groupBy(*KEY).agg(
        F.max_by(F.struct("controler", *payload), F.col("seq")).alias("_doc"),
        F.min_by("controler", "seq").alias("_controler"),
        F.count(F.lit(1)).alias("_hits"),
    )
    known = existing.select(*KEY, F.struct("uuid", "controler").alias("_old"))
    fresh = accepted.select(*KEY, F.struct("uuid", "first_seq").alias("_new"))
    decided = grouped.join(known, KEY, "left").join(fresh, KEY, "left")
    decided = decided.where(F.col("_old").isNotNull() | F.col("_new").isNotNull())
    if one_uuid_per_key:
        decided = decided.withColumn("writes", F.col("_hits"))
    else:
        # Arrivals before the moment of acceptance were rejected and do not count.
        moments = accepted.select(*KEY, "first_seq")
        late = batch.select(*KEY, "seq").join(moments, KEY).where(F.col("seq") >= F.col("first_seq"))
        late = late.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_late"))
        decided = decided.join(late, KEY, "left").withColumn("writes", F.coalesce("_late", "_hits"))
    fixed = {
        "uuid": F.coalesce(F.col("_old.uuid"), F.col("_new.uuid")),
        "controler": F.coalesce(F.col("_old.controler"), F.col("_controler")),
    }
    columns = state.columns
    written = decided.select(
        *[fixed.get(c, F.col(f"_doc.{c}") if c in payload else F.col(c)).alias(c) for c in columns],
        "writes",
        F.col("_old").isNull().alias("inserted"),
    )
    # Every stored key of the batch is updated, so the rest is what the batch lacks.
    untouched = state.join(batch.select(*KEY).distinct(), KEY, "left_anti").select(*columns)
    new_state = untouched.unionByName(written.select(*columns))
    rejected = (
        batch.join(existing.select(*KEY), KEY, "left_anti")
        .join(accepted.select(*KEY, "first_seq"), KEY, "left")
        .where(F.col("first_seq").isNull() | (F.col("seq") < F.col("first_seq")))
        .drop("first_seq")
    )
    return Merged(new_state, written, rejected)


def upsert_metadata(state: DataFrame, batch: DataFrame) -> Merged:
    """Merge metadata documents, keyed by (uuid, source).

    Within one import the first document of a key counts, across imports the last
    one. A uuid held by another source is rejected; level and type are kept.
    """
    key = ["uuid", "source"]
    columns = state.columns
    firsts = latest(batch, [*key, "import_id"], "seq", "first")
    keyed = firsts.groupBy(*key).agg(
        F.min("import_id").alias("_first_import"),
        F.max_by(F.struct(*[c for c in columns if c not in key]), F.col("import_id")).alias("_doc"),
        F.min_by(F.struct("level", "type", "controler"), F.col("import_id")).alias("_kept"),
        F.count(F.lit(1)).alias("writes"),
        F.min("seq").alias("seq"),
    )
    # One row per document; what it is made from repeats them in every observation.
    keyed = cut(keyed)
    claims = keyed.select("uuid", F.struct("_first_import", "source").alias("_claim"), F.lit(False).alias("_stored"))
    held = state.select(
        "uuid", F.struct(F.lit(-1).cast("bigint").alias("_first_import"), "source").alias("_claim"),
        F.lit(True).alias("_stored"),
    )
    owner = (
        claims.unionByName(held)
        .groupBy("uuid")
        .agg(F.min("_claim").alias("_claim"), F.max("_stored").alias("_known"))
        .select("uuid", F.col("_claim.source").alias("source"), "_known")
    )
    accepted = keyed.join(owner, key)
    kept = state.select(*key, F.struct("level", "type", "controler").alias("_old"))
    merged = accepted.join(kept, key, "left").withColumn("_head", F.coalesce("_old", "_kept"))
    written = merged.select(
        *[
            (F.col(c) if c in key else F.col(f"_head.{c}") if c in ("level", "type", "controler") else F.col(f"_doc.{c}")).alias(c)
            for c in columns
        ],
        "writes",
        F.col("_old").isNull().alias("inserted"),
        "seq",
    )
    untouched = state.join(written.select(*key), key, "left_anti")
    rejected = batch.join(owner.select(*key), key, "left_anti")
    return Merged(untouched.unionByName(written.select(*columns)), written, rejected)


def delete_by_log(state: DataFrame, log: DataFrame, controler: str = S.CONTROLER_DATA) -> tuple[DataFrame, DataFrame]:
    """Drop the rows a publisher reports as deleted: (rows kept, rows deleted).

    `log` has `source, id_data`; the record type plays no part.
    """
    keys = log.select("source", "id_data").distinct().withColumn("controler", F.lit(controler))
    on = ["source", "id_data", "controler"]
    return state.join(keys, on, "left_anti").select(*state.columns), state.join(keys, on, "left_semi").select(
        *state.columns
    )
