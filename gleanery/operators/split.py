"""Splitting embedded metadata documents off the observations, and checking values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.functions import documents as D
from gleanery.functions import geometry, text
from gleanery.operators.dims import first_seen
from gleanery.operators.lineage import cut


def _may_embed(item: Column) -> Column:
    """Whether an item can have a key `ca_data` or `jdd_data`, from its text alone; an escape may hide one."""
    return item.contains("ca_data") | item.contains("jdd_data") | item.contains("\\u")


def split_metadata(arrivals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Take the framework and dataset documents out of the items.

    Returns the arrivals with slim items (`ca_uuid` and `jdd_uuid` stay behind), and
    one row per document found: `level, uuid, item` with the other columns of the
    arrival. The dataset document gets the uuid of its framework; it is null where
    the item names none.
    """
    # Most items of most sources embed nothing: they are not opened.
    opened = arrivals.withColumn("_obj", F.when(_may_embed(F.col("item")), D.open_object(F.col("item"))))
    parts = opened.withColumn("_ca", D.as_object(D.member(F.col("_obj"), "ca_data"))).withColumn(
        "_jdd", D.as_object(D.member(F.col("_obj"), "jdd_data"))
    )
    has_ca, has_jdd = F.col("_ca").isNotNull(), F.col("_jdd").isNotNull()
    ca_uuid = D.text_member(D.member(F.col("_ca"), "uuid"), "$")
    jdd_uuid = D.text_member(D.member(F.col("_jdd"), "uuid"), "$")

    def slim(obj: Column) -> Column:
        first = F.when(has_ca, D.with_member(D.without(obj, "ca_data"), "ca_uuid", ca_uuid)).otherwise(obj)
        return F.when(has_jdd, D.with_member(D.without(first, "jdd_data"), "jdd_uuid", jdd_uuid)).otherwise(first)

    changed = has_ca | has_jdd
    data = parts.withColumn("item", F.when(changed, F.to_json(slim(F.col("_obj")))).otherwise(F.col("item"))).select(
        *arrivals.columns
    )

    # A plain `ca_uuid` of the item counts only where no `ca_data` is there at all.
    plain_ca = F.when(
        ~F.map_contains_key("_obj", F.lit("ca_data")), D.text_member(D.member(F.col("_obj"), "ca_uuid"), "$")
    )
    owner = F.when(has_ca, ca_uuid).otherwise(plain_ca)
    both = F.array(
        F.struct(
            F.lit(S.LEVEL_FRAMEWORK).alias("level"),
            text.clean_uuid(ca_uuid).alias("uuid"),
            F.when(has_ca, F.to_json("_ca")).alias("item"),
        ),
        F.struct(
            F.lit(S.LEVEL_DATASET).alias("level"),
            text.clean_uuid(jdd_uuid).alias("uuid"),
            F.when(has_jdd, F.to_json(D.with_member(F.col("_jdd"), "ca_uuid", owner))).alias("item"),
        ),
    )
    kept = [c for c in arrivals.columns if c not in ("item", "uuid", "level")]
    # Picked behind the explosion: a condition before it would open every item once more.
    metadata = parts.select(*kept, F.explode_outer(both).alias("_doc")).where("_doc.item IS NOT NULL").select(*kept, "_doc.*")
    return data, metadata


def first_documents(arrivals: DataFrame, per: list[str], order: str = "seq") -> DataFrame:
    """Documents of the first arrival that carries each uuid, per group of `per`.

    The same document comes with every observation of a dataset, so the uuids alone
    are read first, and only the few items that win are taken apart. Documents
    without a uuid are all returned. `order` is unique within a group.
    """
    found = found_documents(arrivals, per, order)
    if found is None:
        return arrivals.sparkSession.createDataFrame([], split_metadata(arrivals)[1].schema)
    return found


def found_documents(arrivals: DataFrame, per: list[str], order: str = "seq") -> DataFrame | None:
    """The same, or None where no item embeds a document."""
    head = F.from_json(F.col("item"), "ca_data struct<uuid:string>, jdd_data struct<uuid:string>")
    docs = F.filter(F.array("_head.ca_data", "_head.jdd_data"), lambda d: d.isNotNull())
    # One narrow row per item with documents, parsed once and written; those without are left
    # out as they are read, since a condition before that would parse every item once more.
    heads = cut(
        arrivals.where(_may_embed(F.col("item")))
        .select(*per, order, head.alias("_head"))
        .select(*per, order, F.transform(docs, lambda d: text.clean_uuid(d["uuid"])).alias("_uuids"))
    ).where(F.size("_uuids") > 0)
    if heads.isEmpty():
        return None
    key = [*per, order]
    first = (
        heads.select(*key, F.explode("_uuids").alias("_uuid"))
        .where("_uuid IS NOT NULL")
        .groupBy(*per, "_uuid")
        .agg(F.min(order).alias(order))
    )
    nameless = heads.where(F.exists("_uuids", lambda u: u.isNull()))
    wanted = first.select(*key).unionByName(nameless.select(*key)).distinct()
    return split_metadata(arrivals.join(wanted, key, "left_semi"))[1]


def backfill_metadata(rows: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """Metadata table filled from stored rows that still embed their documents.

    The earliest document of each uuid is added unless the uuid is there already.
    """
    ordered = rows.withColumn("_order", F.struct(*order))
    found = first_documents(ordered, [], "_order").where("uuid IS NOT NULL")
    found = found.withColumn("controler", F.lit(S.CONTROLER_METADATA))
    columns = existing.columns
    first = first_seen(found.select(*columns, "_order"), "uuid", ["_order"])
    added = first.join(existing.select("uuid"), "uuid", "left_anti").select(*columns)
    return existing.unionByName(added)


def rewrite_items(rows: DataFrame) -> DataFrame:
    """Slim down stored items that still embed both documents; others stay as they are.

    A `ca_uuid` or `jdd_uuid` that is already there is kept.
    """
    obj = D.open_object(F.col("item"))
    opened = rows.withColumn("_both", D.has_keys(F.col("item"), "ca_data", "jdd_data")).withColumn("_obj", obj)

    def keep(o: Column, key: str, doc: str) -> Column:
        value = D.text_member(D.member(F.col("_obj"), doc), "$.uuid")
        return F.when(F.map_contains_key(o, key), o).otherwise(D.with_member(o, key, value))

    slim = D.without(F.col("_obj"), "ca_data", "jdd_data")
    slim = keep(keep(slim, "ca_uuid", "ca_data"), "jdd_uuid", "jdd_data")
    return opened.withColumn(
        "item", F.when(F.col("_both"), F.to_json(slim)).otherwise(F.col("item"))
    ).select(*rows.columns)


def first_error(item: Column) -> Column:
    """Message of the first value of a parsed item that cannot be stored, else null.

    `item` is the struct of `schemas.ITEM_TEXT`.
    """

    def message(key: str, kind: str) -> Column:
        value = item[key]
        bad = value.isNotNull() & text.clean(value, kind).isNull()
        return F.when(bad, F.concat(F.lit(f"invalid {kind} for {key}: "), value))

    checks = [message(key, kind) for _, key, kind in S.PLAIN if kind in text.CLEANERS]
    checks += [message(key, "uuid") for key in ("ca_uuid", "jdd_uuid")]
    checks += [message("id_synthese", "bigint"), message("cd_hab", "int")]
    wkt = item["wkt_4326"]
    checks.append(
        F.when(wkt.isNotNull() & ~geometry.is_supported(wkt), F.concat(F.lit("unsupported geometry: "), wkt))
    )
    return F.coalesce(*checks)


def validate(arrivals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split arrivals into storable ones and rejected ones (with an `error` text).

    A row is rejected if its id or uuid is no id or uuid, or a typed attribute
    cannot be cast. Nothing is dropped: each arrival is in exactly one result. The
    checked rows are written once, so no item is parsed a second time.
    """
    error = [F.when(F.col("id_data").isNull(), F.lit("missing id_synthese"))]
    if "_raw_uuid" in arrivals.columns:
        bad_uuid = F.col("_raw_uuid").isNotNull() & F.col("uuid").isNull()
        error.append(F.when(bad_uuid, F.concat(F.lit("invalid uuid: "), F.col("_raw_uuid"))))
    error.append(first_error(F.col("_item")))
    columns = [c for c in arrivals.columns if c != "_raw_uuid"]
    parsed = arrivals.withColumn("_item", F.from_json(F.col("item"), S.ITEM_TEXT))
    checked = cut(parsed.select(*columns, F.coalesce(*error).alias("error")))
    return checked.where("error IS NULL").drop("error"), checked.where("error IS NOT NULL")


# What a metadata document must be able to be cast to, by level.
_DOCUMENT_CHECKS = {
    S.LEVEL_FRAMEWORK: (("start_date", "date"), ("end_date", "date"), ("initial_closing_date", "date")),
    S.LEVEL_DATASET: (("marine_domain", "bool"), ("terrestrial_domain", "bool")),
}


def validate_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split metadata documents into storable ones and rejected ones (with an `error` text).

    A document is rejected if one of its dates or booleans cannot be cast; each document is
    in exactly one result.
    """
    keys = [key for checks in _DOCUMENT_CHECKS.values() for key, _ in checks]
    opened = documents.withColumn("_doc", F.from_json("item", ", ".join(f"{key} string" for key in keys)))
    error = F.lit(None).cast("string")
    for level, checks in _DOCUMENT_CHECKS.items():
        faults = []
        for key, kind in checks:
            value = F.col(f"_doc.{key}")
            bad = value.isNotNull() & text.clean(value, kind).isNull()
            faults.append(F.when(bad, F.concat(F.lit(f"invalid {kind} for {key}: "), value)))
        error = F.when(F.col("level") == level, F.coalesce(*faults)).otherwise(error)
    checked = cut(opened.withColumn("error", error).drop("_doc"))
    return checked.where("error IS NULL").drop("error"), checked.where("error IS NOT NULL")
