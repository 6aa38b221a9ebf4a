"""Raw rows loaded into the fact table, and removed from it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.functions import geometry, text
from gleanery.operators import metadata as M
from gleanery.operators.dims import Grown
from gleanery.operators.joins import join_lookup
from gleanery.operators.keys import assign_ids
from gleanery.operators.lineage import cut
from gleanery.operators.lookups import CodeBook, Lookup, area_ids


class Loaded(NamedTuple):
    facts: DataFrame
    written: DataFrame
    sources: Grown
    frameworks: Grown
    datasets: Grown


FACT = (
    "id_synthese bigint, unique_id_sinp string, unique_id_sinp_grp string, id_source bigint,"
    " entity_source_pk_value string, id_dataset bigint, "
    + ", ".join(f"{c.column} bigint" for c in (*S.CODES, S.BIOGEO))
    + ", "
    + ", ".join(
        f"{name} {'timestamp_ntz' if kind == 'date' else 'int' if kind == 'int' else 'string'}"
        for name, _, kind in (*S.PLAIN, S.VALIDATION_COMMENT)
        if name != "unique_id_sinp_grp"
    )
    + ", cd_hab int, the_geom_4326 string, the_geom_point string, the_geom_local string,"
    " id_area_attachment bigint, id_digitiser bigint, additional_data string,"
    " meta_validation_date timestamp_ntz, meta_create_date timestamp_ntz,"
    " meta_update_date timestamp_ntz, last_action string"
)


def owned_rows(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows whose uuid is free in the fact table or held there by the same source.

    `rows` has `uuid, id_source`. Adds `fact`: what is kept of a fact that is there
    already (`id_synthese, meta_create_date`), else null.
    """
    holder = facts.where("unique_id_sinp IS NOT NULL").select(
        F.col("unique_id_sinp").alias("uuid"),
        F.col("id_source").alias("_holder"),
        F.struct("id_synthese", "meta_create_date").alias("fact"),
    )
    joined = rows.join(holder, "uuid", "left")
    return joined.where(F.col("fact").isNull() | (F.col("_holder") == F.col("id_source"))).drop("_holder")


def load_facts(
    rows: DataFrame,
    facts: DataFrame,
    sources: DataFrame,
    frameworks: DataFrame,
    datasets: DataFrame,
    book: CodeBook,
    areas: DataFrame,
    now: Column,
    strict: bool = False,
    last_id: DataFrame | None = None,
) -> Loaded:
    """Insert or update the facts of raw rows just written.

    `rows` has the stored columns and `writes` (how often the key was written).
    Rows without uuid are left out. Items with metadata use the frameworks and
    datasets that are there; other types create what is missing from uuid and name.
    `strict` reads the habitat and the determination method only under their import
    names; otherwise the export names count as well. `last_id` is the highest number ever given
    (one row); without it, it is taken from the facts. `facts` may then be a part of the table, if
    it holds every fact with a uuid of the rows.
    """
    keyed = rows.where("uuid IS NOT NULL")
    grown_sources = M.sources_by_name(sources, keyed.select("source"))
    ids = grown_sources.rows.select(F.col("name_source").alias("source"), "id_source")
    keyed = owned_rows(join_lookup(keyed, ids, ["source"], "left", spread_by=["uuid"]), facts)
    # Checked against the whole fact table and parsed once, in this order: a text is shuffled, not
    # the struct of all attributes, and parsed by all tasks. The steps below read only
    # the attributes they need.
    keyed = cut(
        keyed.withColumn("doc", F.from_json(F.col("item"), S.ITEM_TEXT)).select(
            "uuid", "type", "import_id", "writes", "id_source", "fact", "doc",
            text.clean_uuid(F.col("doc.ca_uuid")).alias("_ca"), text.clean_uuid(F.col("doc.jdd_uuid")).alias("_jdd"),
        )
    )
    basic = keyed.where(F.col("type") != S.TYPE_WITH_METADATA)
    grown_af = M.basic_frameworks(
        frameworks, basic.select(F.col("_ca").alias("uuid"), F.col("doc.ca_nom").alias("name"), "import_id", F.col("uuid").alias("by")),
        ["import_id", "by"], now,
    )
    af_ids = grown_af.rows.select(
        F.col("unique_acquisition_framework_id").alias("_ca"), F.col("id_acquisition_framework").alias("id_af")
    ).where("_ca IS NOT NULL")
    first_ds = basic.select(
        F.col("_jdd").alias("uuid"), "_ca", F.col("doc.jdd_nom").alias("name"), "import_id", F.col("uuid").alias("by")
    )
    first_ds = first_ds.where("uuid IS NOT NULL").groupBy("uuid").agg(
        F.min_by(F.struct("_ca", "name", "import_id", "by"), F.struct("import_id", "by")).alias("r")
    ).select("uuid", "r.*")
    grown_ds = M.basic_datasets(datasets, join_lookup(first_ds, af_ids, ["_ca"], "left"), ["import_id", "by"], now)
    ds_ids = grown_ds.rows.select(F.col("unique_dataset_id").alias("_jdd"), "id_dataset").where("_jdd IS NOT NULL")
    coded = join_lookup(keyed, ds_ids, ["_jdd"], "left", spread_by=["uuid"])

    # Only uuids are numbered; the wide rows stay where they are.
    new_ids = assign_ids(keyed.where("fact IS NULL").select("uuid"), F.col("uuid"), "_new_id", facts.select("id_synthese") if last_id is None else last_id)
    coded = coded.join(new_ids, "uuid", "left")

    labelled = F.col("type") == S.TYPE_WITH_LABEL
    lookups = []
    for code in (*S.CODES, S.BIOGEO):
        value = F.col(f"doc.{code.key}")
        if code.list_type == "TYPE":
            value = F.col("doc.label") if strict else F.coalesce(F.col("doc.label"), value)
        if code.list_type != "TYP_INF_GEO":
            lookups.append(Lookup(code.list_type, value, code.column))
    coded = area_ids(
        coded, areas, F.col("doc.area_attachment.type_code"), F.col("doc.area_attachment.area_code"), "id_area_attachment"
    )
    coded = book.ids(coded, lookups, labelled)
    # The geographic information type is attached where the area is known here, and
    # always looked up by code.
    geo_code = F.when(F.col("id_area_attachment").isNotNull(), F.lit(S.GEO_INFO_ATTACHED)).otherwise(
        F.lit(S.GEO_INFO_REFERENCED)
    )
    coded = book.id_of_code(coded, "TYP_INF_GEO", geo_code, "id_nomenclature_info_geo_type")

    points = geometry.coordinates(F.col("doc.wkt_4326"))
    habitat = F.col("doc.cd_hab") if strict else F.coalesce(F.col("doc.cd_hab"), F.col("doc.code_habitat"))
    plain = []
    for name, key, kind in (*S.PLAIN, S.VALIDATION_COMMENT):
        value = text.clean(F.col(f"doc.{key}"), kind)
        plain.append((value.cast("timestamp_ntz") if kind == "date" else value).alias(name))
    shaped = coded.withColumn("_points", points).select(
        F.col("uuid").alias("unique_id_sinp"),
        "id_source",
        text.clean_bigint(F.col("doc.id_synthese")).cast("string").alias("entity_source_pk_value"),
        "id_dataset",
        *[c.column for c in (*S.CODES, S.BIOGEO)],
        *plain,
        text.clean_int(habitat).alias("cd_hab"),
        F.col("doc.wkt_4326").alias("the_geom_4326"),
        geometry.as_text(F.array(geometry.centroid(F.col("_points")))).alias("the_geom_point"),
        geometry.as_text(geometry.to_local(F.col("_points"))).alias("the_geom_local"),
        "id_area_attachment",
        F.lit(None).cast("bigint").alias("id_digitiser"),
        F.col("doc.donnees_additionnelles").alias("additional_data"),
        F.lit(None).cast("timestamp_ntz").alias("meta_validation_date"),
        F.when(F.col("fact").isNotNull() | (F.col("writes") > 1), F.lit("U")).otherwise(F.lit("I")).alias("last_action"),
        F.coalesce(F.col("fact.id_synthese"), F.col("_new_id")).alias("id_synthese"),
        F.when(F.col("fact").isNotNull(), F.col("fact.meta_create_date")).otherwise(now).alias("meta_create_date"),
        F.when(F.col("fact").isNotNull() | (F.col("writes") > 1), now).alias("meta_update_date"),
    )
    columns = facts.columns
    # Several tables and logs of a run are derived from these rows: written once.
    written = cut(shaped.select(*columns))
    changed = keyed.where("fact IS NOT NULL").select(F.col("uuid").alias("unique_id_sinp"))
    untouched = facts.join(changed, "unique_id_sinp", "left_anti").select(*columns)
    return Loaded(untouched.unionByName(written), written, grown_sources, grown_af, grown_ds)


def deleted_keys(deleted: DataFrame, sources: DataFrame) -> DataFrame:
    """(entity_source_pk_value, id_source) of the facts of raw rows just deleted.

    Only the record types that feed the fact table count.
    """
    gone = deleted.where(F.col("type").isin(*S.FACT_TYPES)).select(
        "source", F.get_json_object("item", "$.id_synthese").alias("entity_source_pk_value")
    )
    ids = sources.select(F.col("name_source").alias("source"), "id_source")
    return join_lookup(gone.distinct(), ids, ["source"], "inner").select("entity_source_pk_value", "id_source")


def delete_facts(facts: DataFrame, deleted: DataFrame, sources: DataFrame) -> DataFrame:
    """Remove the facts of raw rows just deleted, matched by source and their own id."""
    keys = deleted_keys(deleted, sources)
    return facts.join(keys, ["entity_source_pk_value", "id_source"], "left_anti").select(*facts.columns)
