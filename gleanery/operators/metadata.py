"""Framework and dataset documents loaded into their tables and bridges."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.functions import documents as D
from gleanery.functions import text
from gleanery.operators.dims import Grown, get_or_insert
from gleanery.operators.joins import join_lookup
from gleanery.operators.lookups import CodeBook, Lookup

MODULE = "gleanery"


def basic_frameworks(existing: DataFrame, wanted: DataFrame, order: list[str], now: Column) -> Grown:
    """Get or create frameworks that are known by uuid and name only."""
    rows = wanted.select(
        F.col("uuid").alias("unique_acquisition_framework_id"),
        F.col("name").alias("acquisition_framework_name"),
        F.concat(F.lit(S.BASIC_FRAMEWORK_DESC), F.col("name")).alias("acquisition_framework_desc"),
        now.cast("date").alias("acquisition_framework_start_date"),
        now.alias("meta_create_date"),
        D.with_provenance(F.lit("{}"), F.col("name"), MODULE).alias("additional_data"),
        *order,
    )
    return get_or_insert(existing, rows, "unique_acquisition_framework_id", "id_acquisition_framework", order)


def basic_datasets(existing: DataFrame, wanted: DataFrame, order: list[str], now: Column) -> Grown:
    """Get or create datasets that are known by uuid, name and framework only."""
    rows = wanted.select(
        F.col("uuid").alias("unique_dataset_id"),
        F.col("id_af").alias("id_acquisition_framework"),
        F.col("name").alias("dataset_name"),
        F.left(F.col("name"), F.lit(30)).alias("dataset_shortname"),
        F.lit(S.BASIC_DATASET_DESC).alias("dataset_desc"),
        F.lit(True).alias("marine_domain"),
        F.lit(True).alias("terrestrial_domain"),
        now.alias("meta_create_date"),
        D.with_provenance(F.lit("{}"), F.col("name"), MODULE).alias("additional_data"),
        *order,
    )
    return get_or_insert(existing, rows, "unique_dataset_id", "id_dataset", order)


def sources_by_name(existing: DataFrame, names: DataFrame) -> Grown:
    """Get or create the rows of source names (`source`)."""
    rows = names.select(F.col("source").alias("name_source")).distinct()
    rows = rows.withColumn("additional_data", D.with_provenance(F.lit("{}"), F.col("name_source"), MODULE))
    return get_or_insert(existing, rows, "name_source", "id_source")


def code_bridge(
    owners: DataFrame,
    book: CodeBook,
    list_type: str,
    owner_id: str,
    values: Column,
    out: str,
    when_absent: str | None = None,
    when_null: str | None = None,
) -> DataFrame:
    """Bridge rows (owner, code id) from an array of codes.

    `when_absent` stands in for a missing array, `when_null` for a null element.
    Unknown codes take the default of the type.
    """
    array = values if when_absent is None else F.coalesce(values, F.array(F.lit(when_absent)))
    rows = owners.select(owner_id, F.explode(array).alias("_code"))
    code = F.col("_code") if when_null is None else F.coalesce("_code", F.lit(when_null))
    return book.id_of_code(rows, list_type, code, out).select(owner_id, out).where(F.col(out).isNotNull()).distinct()


class Actors(NamedTuple):
    organisms: Grown
    roles: Grown


def actor_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per actor named in the documents, with its place in the list."""
    listed = F.from_json(F.col("doc.actors"), f"array<struct<{_nested(S.ACTOR)}>>")
    return docs.select(*keep, F.posexplode(listed).alias("pos", "actor")).select(
        *keep,
        "pos",
        F.col("actor.type_role").alias("type_role"),
        text.clean_uuid(F.col("actor.uuid_actor")).alias("uuid_actor"),
        F.col("actor.cd_nomenclature_actor_role").alias("cd_role"),
        F.col("actor.identity").alias("identity"),
        F.col("actor.email").alias("email"),
    )


def _nested(ddl: str) -> str:
    return ", ".join(part.strip().replace(" ", ":", 1) for part in ddl.split(", "))


def get_or_create_actors(organisms: DataFrame, roles: DataFrame, actors: DataFrame, order: list[str]) -> Actors:
    """Get or create the organisms and persons named as actors; the first mention counts.

    `actors` comes from `actor_rows` and has `source`. The e-mail of a person goes
    into the provenance, and its own column stays null.
    """
    source = F.col("source")
    org = actors.where(F.col("type_role") == "organism").select(
        F.col("uuid_actor").alias("uuid_organisme"),
        F.col("identity.organism_name").alias("nom_organisme"),
        F.col("email").alias("email_organisme"),
        D.full_json(F.struct(source.alias("source"), F.lit(MODULE).alias("module"))).alias("additional_data"),
        *order,
    )
    person = actors.where(F.col("type_role") == "role").select(
        F.col("uuid_actor").alias("uuid_role"),
        F.col("identity.first_name").alias("nom_role"),
        F.col("identity.last_name").alias("prenom_role"),
        F.lit(None).cast("string").alias("email"),
        D.full_json(
            F.struct(
                source.alias("source"),
                F.lit(MODULE).alias("module"),
                F.struct(F.col("email").alias("email")).alias(f"{MODULE}_data"),
            )
        ).alias("champs_addi"),
        *order,
    )
    return Actors(
        get_or_insert(organisms, org, "uuid_organisme", "id_organisme", order),
        get_or_insert(roles, person, "uuid_role", "id_role", order),
    )


def actor_bridge(actors: DataFrame, grown: Actors, book: CodeBook, owner_id: str) -> DataFrame:
    """Bridge rows (owner, organism or person, role code) of the actors, without copies."""
    coded = book.id_of_code(actors, S.ACTOR_ROLE_TYPE, F.col("cd_role"), "id_nomenclature_actor_role")

    def side(kind: str, table: DataFrame, uuid: str, id_column: str) -> DataFrame:
        rows = coded.where(F.col("type_role") == kind).select(owner_id, "uuid_actor", "id_nomenclature_actor_role")
        ids = table.select(F.col(uuid).alias("uuid_actor"), id_column).where("uuid_actor IS NOT NULL")
        return join_lookup(rows.distinct(), ids, ["uuid_actor"], "left")

    none = F.lit(None).cast("bigint")
    org = side("organism", grown.organisms.rows, "uuid_organisme", "id_organisme").select(
        owner_id, F.col("id_organisme").alias("id_organism"), none.alias("id_role"), "id_nomenclature_actor_role"
    )
    person = side("role", grown.roles.rows, "uuid_role", "id_role").select(
        owner_id, none.alias("id_organism"), "id_role", "id_nomenclature_actor_role"
    )
    return org.unionByName(person).distinct()


def open_documents(rows: DataFrame, layout: str) -> DataFrame:
    return rows.withColumn("doc", F.from_json(F.col("item"), layout))


def framework_rows(docs: DataFrame, book: CodeBook, now: Column) -> DataFrame:
    """Framework rows of opened documents (`schemas.FRAMEWORK_DOC`) and their uuid."""
    coded = book.ids(docs, [Lookup(c.list_type, F.col(f"doc.{c.key}"), c.column) for c in S.FRAMEWORK_CODES])
    return coded.select(
        "unique_acquisition_framework_id",
        F.col("doc.name").alias("acquisition_framework_name"),
        F.col("doc.desc").alias("acquisition_framework_desc"),
        text.clean_date(F.col("doc.start_date")).alias("acquisition_framework_start_date"),
        text.clean_date(F.col("doc.end_date")).alias("acquisition_framework_end_date"),
        F.col("doc.ecologic_or_geologic_target").alias("ecologic_or_geologic_target"),
        *[c.column for c in S.FRAMEWORK_CODES],
        F.col("doc.initial_closing_date").try_cast("timestamp_ntz").alias("initial_closing_date"),
        F.col("doc.target_description").alias("target_description"),
        now.alias("meta_create_date"),
        now.alias("meta_update_date"),
        D.with_provenance(F.lit("{}"), F.col("source"), MODULE).alias("additional_data"),
        "seq",
    )


def dataset_rows(docs: DataFrame, frameworks: DataFrame, book: CodeBook, now: Column) -> DataFrame:
    """Dataset rows of opened documents (`schemas.DATASET_DOC`) and their uuid."""
    coded = docs.withColumn("_ca", text.clean_uuid(F.col("doc.ca_uuid")))
    owners = frameworks.select(
        F.col("unique_acquisition_framework_id").alias("_ca"), "id_acquisition_framework"
    ).where("_ca IS NOT NULL")
    coded = join_lookup(coded, owners, ["_ca"], "left")
    coded = book.ids(coded, [Lookup(c.list_type, F.col(f"doc.{c.key}"), c.column) for c in S.DATASET_CODES])
    return coded.select(
        "unique_dataset_id",
        "id_acquisition_framework",
        F.col("doc.name").alias("dataset_name"),
        F.col("doc.shortname").alias("dataset_shortname"),
        F.coalesce(F.col("doc.desc"), F.lit(S.DATASET_DESC)).alias("dataset_desc"),
        F.coalesce(text.clean_bool(F.col("doc.marine_domain")), F.lit(False)).alias("marine_domain"),
        F.coalesce(text.clean_bool(F.col("doc.terrestrial_domain")), F.lit(False)).alias("terrestrial_domain"),
        *[c.column for c in S.DATASET_CODES],
        F.col("doc.keywords").alias("keywords"),
        now.alias("meta_create_date"),
        now.alias("meta_update_date"),
        D.with_provenance(F.lit("{}"), F.col("source"), MODULE).alias("additional_data"),
        "seq",
    )


def codes_of(name: str) -> Column:
    """Codes listed under a key of the opened document; null where it is missing."""
    return F.from_json(F.col(f"doc.{name}"), "array<string>")
