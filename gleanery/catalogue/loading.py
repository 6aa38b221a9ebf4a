"""Queries that load raw rows and documents into the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.catalogue import sql as Q
from gleanery.catalogue.views import Domain
from gleanery.functions import documents as D
from gleanery.functions import geometry as G
from gleanery.functions.text import stamp_text, uuid_of
from gleanery.operators import facts as FA
from gleanery.operators import metadata as M
from gleanery.operators.lookups import CodeBook, Lookup, area_ids
from gleanery.plans.consolidate import LAYOUTS, load_metadata

NOW = "TIMESTAMP_NTZ '2025-01-01 00:00:00'"


def as_layout(df: DataFrame, layout: str) -> DataFrame:
    """Rows in a layout; columns that are not there stay null."""
    want = df.sparkSession.createDataFrame([], layout).dtypes
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in want])


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


# ---------------------------------------------------------------------- lookups
def code_lookup_default(spark: SparkSession, folder: str) -> DataFrame:
    d = Domain(spark, folder)
    book = CodeBook(d.codes())
    key = F.col("o_orderkey")
    rows = d.table("orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, F.lit("?")).when(key % 11 != 0, F.col("o_orderstatus")).alias("a"),
        F.when(key % 5 != 0, F.substring("o_orderpriority", 1, 1)).alias("b"),
        F.concat(F.lit("Brand#"), _text(key % 30)).alias("c"),
    )
    rows = book.ids(
        rows,
        [
            Lookup(S.ACTOR_ROLE_TYPE, F.col("a"), "id_a"),
            Lookup(S.THEME_TYPE, F.col("b"), "id_b"),
            Lookup(S.TERRITORY_TYPE, F.col("c"), "id_c"),
        ],
    )
    return rows.select("o_orderkey", "id_a", "id_b", "id_c")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("o_orderkey") % 9 == 0, F.col("o_orderpriority")).otherwise(F.lower("o_orderpriority"))
    return Domain(spark, folder).table("orders").select("o_orderkey", label.alias("label"))


def label_lookup(spark: SparkSession, folder: str) -> DataFrame:
    book = CodeBook(Domain(spark, folder).codes())
    rows = book.id_of_label(_labels(spark, folder), S.THEME_TYPE, F.col("label"), "id")
    return rows.select("o_orderkey", "id")


def label_lookup_like(spark: SparkSession, folder: str) -> DataFrame:
    """The type name as a pattern, which several types match."""
    book = CodeBook(Domain(spark, folder).codes(), like_types=("STATUT_%", "TYP_DEN_R"))
    rows = book.id_of_label(_labels(spark, folder), "STATUT_%", F.col("label"), "id")
    rows = book.id_of_label(rows, "TYP_DEN_R", F.col("label"), "id_wild")
    return rows.select("o_orderkey", "id", "id_wild")


def area_lookup(spark: SparkSession, folder: str) -> DataFrame:
    d = Domain(spark, folder)
    areas = d.areas()
    rows = d.table("customer").join(
        areas.select(F.col("id_area").cast("int").alias("c_nationkey"), "type_code", "area_code"), "c_nationkey"
    )
    code = F.when(F.col("c_custkey") % 9 == 0, F.lit("NOWHERE")).otherwise(F.col("area_code"))
    rows = rows.select("c_custkey", F.when(F.col("c_custkey") % 13 != 0, F.col("type_code")).alias("t"), code.alias("a"))
    found = area_ids(rows, areas, F.col("t"), F.col("a"), "id_area")
    kind = F.when(F.col("id_area").isNotNull(), F.lit(S.GEO_INFO_ATTACHED)).otherwise(F.lit(S.GEO_INFO_REFERENCED))
    return CodeBook(d.codes()).id_of_code(found, "TYP_INF_GEO", kind, "info_type").select("c_custkey", "id_area", "info_type")


# ------------------------------------------------------------------- dimensions
def _known_frameworks(d: Domain) -> DataFrame:
    key = F.col("n_nationkey")
    rows = d.table("nation").where("n_regionkey < 2").select(
        (key + 1).alias("id_acquisition_framework"),
        uuid_of(F.concat(F.lit("a"), _text(key))).alias("unique_acquisition_framework_id"),
        F.col("n_name").alias("acquisition_framework_name"),
    )
    return as_layout(rows, LAYOUTS["frameworks"])


def get_or_insert_dims(spark: SparkSession, folder: str) -> DataFrame:
    """Frameworks and datasets from uuid and name; the first mention gives the name."""
    d = Domain(spark, folder)
    now = F.expr(NOW)
    o = d.table("orders")
    cust = F.col("o_custkey")
    wanted = o.select(
        uuid_of(F.concat(F.lit("a"), _text(cust % 25))).alias("ca"),
        uuid_of(F.concat(F.lit("d"), _text(cust))).alias("jdd"),
        F.concat(F.lit("AF "), _text("o_orderkey")).alias("ca_nom"),
        F.concat(F.lit("A rather long name of a dataset "), _text("o_orderkey")).alias("jdd_nom"),
        F.col("o_orderkey").alias("seq"),
    )
    af = M.basic_frameworks(_known_frameworks(d), wanted.select(F.col("ca").alias("uuid"), F.col("ca_nom").alias("name"), "seq"), ["seq"], now)
    ids = af.rows.select(F.col("unique_acquisition_framework_id").alias("ca"), F.col("id_acquisition_framework").alias("id_af"))
    first = wanted.groupBy("jdd").agg(F.min_by(F.struct("ca", "jdd_nom", "seq"), F.col("seq")).alias("r")).select("jdd", "r.*")
    ds = M.basic_datasets(
        as_layout(d.datasets().where("id_dataset < 0"), LAYOUTS["datasets"]),
        first.join(ids, "ca", "left").select(F.col("jdd").alias("uuid"), F.col("jdd_nom").alias("name"), "id_af", "seq"),
        ["seq"], now,
    )
    left = af.rows.select(
        F.lit("framework").alias("kind"), F.col("id_acquisition_framework").alias("id"),
        F.col("unique_acquisition_framework_id").alias("uuid"), F.col("acquisition_framework_name").alias("name"),
        F.col("acquisition_framework_desc").alias("text"), F.lit(None).cast("bigint").alias("owner"),
    )
    right = ds.rows.select(
        F.lit("dataset").alias("kind"), F.col("id_dataset").alias("id"), F.col("unique_dataset_id").alias("uuid"),
        F.col("dataset_name").alias("name"), F.col("dataset_shortname").alias("text"),
        F.col("id_acquisition_framework").alias("owner"),
    )
    return left.unionByName(right)


# ------------------------------------------------------------------------ facts
def _raw_items(d: Domain) -> DataFrame:
    """Orders as raw rows of two record types, with a full item."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = F.when(key % 17 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    item = F.concat(
        F.lit('{"id_synthese":'), _text(key), F.lit(',"nature_objet_geo":"'), status,
        F.lit('","stade_vie":"'), status, F.lit('","sexe":"'), F.substring("o_orderpriority", 1, 1),
        F.lit('","label":null,"methode_determination":"'), F.substring("o_orderpriority", 1, 1),
        F.lit('","date_debut":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(' 10:11:12","cd_nom":"'), _text(cust),
        F.lit('","code_habitat":'), F.substring("o_orderpriority", 1, 1),
        F.lit(',"wkt_4326":"POINT('), _text(cust % 10), F.lit(" "), _text(cust % 50), F.lit(')","ca_uuid":"'),
        uuid_of(F.concat(F.lit("a"), _text(cust % 25))), F.lit('","ca_nom":"AF '), _text(cust % 25),
        F.lit('","jdd_uuid":"'), uuid_of(F.concat(F.lit("d"), _text(cust))), F.lit('","jdd_nom":"DS '), _text(cust), F.lit('"'),
        F.when(key % 3 == 0, F.concat(F.lit(',"area_attachment":{"type_code":"AFRICA","area_code":"NATION_'), _text(cust % 25), F.lit('"}'))).otherwise(F.lit("")),
        F.lit("}"),
    )
    return d.dealt("orders", "o_orderkey").select(
        F.concat(F.lit("s"), _text(key % 2)).alias("source"), F.lit("data").alias("controler"),
        F.when(key % 2 == 0, S.TYPE_WITH_METADATA).otherwise(S.TYPE_WITH_CODES).alias("type"),
        key.alias("id_data"), F.when(key % 19 != 0, uuid_of(F.concat(F.lit("o"), _text(key)))).alias("uuid"),
        item.alias("item"), F.col("o_orderdate").alias("update_ts"), F.lit(1).cast("bigint").alias("import_id"),
        F.when(key % 23 == 0, 2).otherwise(1).cast("bigint").alias("writes"),
    )


def _known_sources(spark: SparkSession) -> DataFrame:
    rows = spark.range(1).select(F.lit(1).alias("id_source"), F.lit("s0").alias("name_source"))
    return as_layout(rows, LAYOUTS["sources"])


def _known_facts(d: Domain) -> DataFrame:
    """Facts of the older orders; every thirteenth belongs to another source."""
    key = F.col("o_orderkey")
    rows = d.table("orders").where("o_orderdate < TIMESTAMP_NTZ '1997-01-01 00:00:00'").select(
        (key + 1).alias("id_synthese"), uuid_of(F.concat(F.lit("o"), _text(key))).alias("unique_id_sinp"),
        F.when(key % 13 == 0, 7).otherwise(key % 2 + 1).alias("id_source"), _text(key).alias("entity_source_pk_value"),
        F.lit("I").alias("last_action"), F.col("o_orderdate").alias("meta_create_date"),
    )
    return as_layout(rows, FA.FACT)


def load_fact(spark: SparkSession, folder: str) -> DataFrame:
    d = Domain(spark, folder)
    loaded = FA.load_facts(
        _raw_items(d), _known_facts(d), _known_sources(spark), _known_frameworks(d),
        as_layout(d.datasets(), LAYOUTS["datasets"]).where("id_acquisition_framework < 10"),
        CodeBook(d.codes()), d.areas(), F.expr(NOW),
    )
    return loaded.facts.select(
        "id_synthese", "unique_id_sinp", "id_source", "entity_source_pk_value", "id_dataset",
        "id_nomenclature_geo_object_nature", "id_nomenclature_life_stage", "id_nomenclature_sex",
        "id_nomenclature_determination_method", "id_nomenclature_info_geo_type", "id_nomenclature_biogeo_status",
        "cd_nom", "cd_hab", "the_geom_point", "id_area_attachment", stamp_text(F.col("date_min")).alias("date_min"), "last_action",
    )


def delete_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Facts left after the deletions of the change log; records of no fact type stay."""
    d = Domain(spark, folder)
    key = F.col("o_orderkey")
    facts = as_layout(
        d.table("orders").select(
            key.alias("id_synthese"), uuid_of(F.concat(F.lit("o"), _text(key))).alias("unique_id_sinp"),
            (key % 2 + 1).alias("id_source"), _text(key).alias("entity_source_pk_value"),
        ),
        FA.FACT,
    )
    log = d.change_log().where("last_action = 'D'")
    deleted = log.select(
        "source", F.when(F.col("id_data") % 4 == 0, F.lit("other")).otherwise(F.lit(S.TYPE_WITH_LABEL)).alias("type"),
        F.concat(F.lit('{"id_synthese":'), _text("id_data"), F.lit("}")).alias("item"),
    )
    sources = M.sources_by_name(_known_sources(spark), log.select("source")).rows
    return FA.delete_facts(facts, deleted, sources).select("id_synthese", "unique_id_sinp", "id_source")


# --------------------------------------------------------------------- metadata
def _documents(d: Domain) -> DataFrame:
    """Framework documents of nations and dataset documents of customers."""
    n, c = F.col("n_nationkey"), F.col("c_custkey")
    af = D.full_json(
        F.struct(
            uuid_of(F.concat(F.lit("a"), _text(n))).alias("uuid"), F.col("n_name").alias("name"),
            F.concat(F.lit("about "), "n_name").alias("desc"), F.lit("2001-02-03").alias("start_date"),
            F.when(n % 2 == 0, F.lit("1")).otherwise(F.lit("none")).alias("financing_type"), F.lit("3").alias("territorial_level"),
            F.when(n % 3 != 0, F.array(F.lit("Brand#7"), F.concat(F.lit("Brand#"), _text(n)))).alias("territories"),
            F.when(n % 4 != 0, F.array(F.lit("MACHINERY"), F.lit("MACHINERY"))).alias("objectives"),
            F.when(n % 5 != 0, F.array(F.lit("2"), F.lit("4"))).alias("voletsinp"),
        )
    )
    ds = D.full_json(
        F.struct(
            uuid_of(F.concat(F.lit("d"), _text(c))).alias("uuid"),
            uuid_of(F.concat(F.lit("a"), _text(F.col("c_nationkey") + F.when(c % 6 == 0, 100).otherwise(0)))).alias("ca_uuid"),
            F.col("c_name").alias("name"), F.when(c % 7 != 0, F.col("c_mktsegment")).alias("desc"),
            F.when(c % 3 == 0, F.lit(True)).alias("marine_domain"), _text(c % 5 + 1).alias("data_type"),
            F.when(c % 5 != 0, F.array(F.concat(F.lit("Brand#"), _text(c % 25 + 1)), F.lit(None).cast("string"))).alias("territories"),
        )
    )
    head = [F.lit("s0").alias("source"), F.lit(S.CONTROLER_METADATA).alias("controler"), F.lit(S.TYPE_WITH_METADATA).alias("type")]
    one = d.table("nation").select(*head, F.lit(S.LEVEL_FRAMEWORK).alias("level"), af.alias("item"), F.col("n_nationkey").cast("bigint").alias("seq"))
    two = d.dealt("customer", "c_custkey").select(*head, F.lit(S.LEVEL_DATASET).alias("level"), ds.alias("item"), c.alias("seq"))
    return one.unionByName(two)


def _loaded_metadata(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    d = Domain(spark, folder)
    tables = {name: spark.createDataFrame([], layout) for name, layout in LAYOUTS.items()}
    tables.update(codes=d.codes(), areas=d.areas(), frameworks=_known_frameworks(d))
    return load_metadata(tables, _documents(d), F.expr(NOW))


def load_metadata_query(spark: SparkSession, folder: str) -> DataFrame:
    out = _loaded_metadata(spark, folder)
    af = out["frameworks"].select(
        F.lit("framework").alias("kind"), F.col("id_acquisition_framework").alias("id"),
        F.col("unique_acquisition_framework_id").alias("uuid"), F.col("acquisition_framework_name").alias("name"),
        F.col("acquisition_framework_desc").alias("text"), F.lit(None).cast("bigint").alias("owner"),
        F.lit(None).cast("boolean").alias("marine"), F.col("id_nomenclature_financing_type").alias("code"),
    )
    ds = out["datasets"].select(
        F.lit("dataset").alias("kind"), F.col("id_dataset").alias("id"), F.col("unique_dataset_id").alias("uuid"),
        F.col("dataset_name").alias("name"), F.col("dataset_desc").alias("text"),
        F.col("id_acquisition_framework").alias("owner"), F.col("marine_domain").alias("marine"),
        F.col("id_nomenclature_data_type").alias("code"),
    )
    return af.unionByName(ds)


def framework_bridges(spark: SparkSession, folder: str) -> DataFrame:
    out = _loaded_metadata(spark, folder)
    parts = [
        out[name].select(F.lit(name).alias("bridge"), F.col("id_acquisition_framework").alias("owner"), F.col(column).alias("code"))
        for name, column in (
            ("framework_territories", "id_nomenclature_territory"),
            ("framework_objectives", "id_nomenclature_objectif"),
            ("framework_themes", "id_nomenclature_voletsinp"),
        )
    ]
    parts.append(out["dataset_territories"].select(F.lit("dataset_territories").alias("bridge"), F.col("id_dataset").alias("owner"), F.col("id_nomenclature_territory").alias("code")))
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def bridge_territories(spark: SparkSession, folder: str) -> DataFrame:
    """Brands of a customer's orders as territory codes; null elements take the default code."""
    d = Domain(spark, folder)
    line = d.table("lineitem").select("l_orderkey", "l_partkey").join(
        d.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"
    )
    rows = line.join(d.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    owner = rows.groupBy("o_custkey").agg(F.collect_set("p_brand").alias("brands"))
    null = F.array(F.lit(None).cast("string"))
    values = F.when(F.col("o_custkey") % 5 == 0, F.concat("brands", null)).when(F.col("o_custkey") % 7 != 0, F.col("brands"))
    return M.code_bridge(
        owner, CodeBook(d.codes()), S.TERRITORY_TYPE, "o_custkey", values, "id_territory",
        when_absent=S.DEFAULT_TERRITORY, when_null=S.DEFAULT_TERRITORY,
    )


def _actor_documents(d: Domain) -> DataFrame:
    """One document per customer with the actors of its orders."""
    o = d.table("orders")
    actor, is_org = F.col("o_orderkey") % 100, F.col("o_orderstatus") == "F"
    one = D.full_json(
        F.struct(
            F.when(is_org, "organism").when(F.col("o_orderstatus") == "O", "role").alias("type_role"),
            F.when(is_org, uuid_of(F.concat(F.lit("s"), _text(actor)))).otherwise(uuid_of(F.concat(F.lit("r"), _text(actor)))).alias("uuid_actor"),
            F.when(F.col("o_orderkey") % 4 == 0, F.lit("?")).otherwise(F.col("o_orderstatus")).alias("cd_nomenclature_actor_role"),
            F.struct(
                F.when(is_org, F.concat(F.lit("Org "), _text(actor))).alias("organism_name"),
                F.when(~is_org, F.concat(F.lit("Name "), _text(actor))).alias("first_name"),
                F.when(~is_org, F.lit("First")).alias("last_name"),
            ).alias("identity"),
            F.concat(F.lit("m"), _text(actor), F.lit("@example.org")).alias("email"),
        )
    )
    docs = o.select("o_custkey", one.alias("actor")).groupBy("o_custkey").agg(F.sort_array(F.collect_set("actor")).alias("a"))
    text = F.concat(F.lit("["), F.array_join("a", ","), F.lit("]"))
    return docs.select(
        F.col("o_custkey").alias("id_dataset"), F.lit("s0").alias("source"), F.col("o_custkey").alias("seq"),
        F.struct(text.alias("actors")).alias("doc"),
    )


def _actors(spark: SparkSession, folder: str):
    d = Domain(spark, folder)
    known = as_layout(d.organisms().where("email_organisme IS NULL"), LAYOUTS["organisms"])
    actors = M.actor_rows(_actor_documents(d), ["id_dataset", "source", "seq"])
    grown = M.get_or_create_actors(known, spark.createDataFrame([], LAYOUTS["roles"]), actors, ["seq", "pos"])
    return d, actors, grown


def actors_get_or_create(spark: SparkSession, folder: str) -> DataFrame:
    _, _, grown = _actors(spark, folder)
    org = grown.organisms.rows.select(
        F.lit("organism").alias("kind"), F.col("id_organisme").alias("id"), F.col("uuid_organisme").alias("uuid"),
        F.col("nom_organisme").alias("name"), F.col("email_organisme").alias("email"), F.col("additional_data").alias("origin"),
    )
    person = grown.roles.rows.select(
        F.lit("role").alias("kind"), F.col("id_role").alias("id"), F.col("uuid_role").alias("uuid"),
        F.col("nom_role").alias("name"), "email", F.col("champs_addi").alias("origin"),
    )
    return org.unionByName(person)


def actor_bridges(spark: SparkSession, folder: str) -> DataFrame:
    d, actors, grown = _actors(spark, folder)
    return M.actor_bridge(actors, grown, CodeBook(d.codes()), "id_dataset")


def additional_data(spark: SparkSession, folder: str) -> DataFrame:
    s = Domain(spark, folder).table("supplier")
    key = F.col("s_suppkey")
    old = F.when(key % 3 == 0, F.lit('{"a":1}')).when(key % 3 == 1, F.lit('{"source":"old","z":[1,null]}'))
    doc = D.with_provenance(old, F.col("s_name"), M.MODULE)
    return s.select("s_suppkey", D.canonical(doc).alias("additional_data"))


def wkt_centroid(spark: SparkSession, folder: str) -> DataFrame:
    c = Domain(spark, folder).table("customer")
    key = F.col("c_custkey")
    x, y, w = key % 300 - 150, key % 120 - 60, key % 7 + 1
    pair = lambda a, b: F.concat(_text(a), F.lit(" "), _text(b))
    ring = F.concat_ws(",", pair(x, y), pair(x + w, y), pair(x, y + w * 2), pair(x, y))
    wkt = (
        F.when(key % 5 == 0, F.concat(F.lit("POINT("), pair(x, y), F.lit(")")))
        .when(key % 5 == 1, F.concat(F.lit("LINESTRING("), pair(x, y), F.lit(","), pair(y, x), F.lit(")")))
        .otherwise(F.concat(F.lit("POLYGON(("), ring, F.lit("))")))
    )
    rows = c.select("c_custkey", wkt.alias("wkt")).withColumn("points", G.coordinates(F.col("wkt")))
    middle = G.centroid(F.col("points"))
    return rows.withColumn("m", middle).select(
        "c_custkey", F.round(F.col("m.x"), 6).alias("x"), F.round(F.col("m.y"), 6).alias("y"), G.as_text(F.col("points")).alias("wkt")
    )


QUERIES = {
    "code_lookup_default": code_lookup_default,
    "label_lookup": label_lookup,
    "label_lookup_like": label_lookup_like,
    "area_lookup": area_lookup,
    "get_or_insert_dims": get_or_insert_dims,
    "load_fact": load_fact,
    "delete_fact": delete_fact,
    "load_metadata": load_metadata_query,
    "metadata_bridges": framework_bridges,
    "bridge_territories": bridge_territories,
    "actors_get_or_create": actors_get_or_create,
    "actor_bridges": actor_bridges,
    "additional_data": additional_data,
    "wkt_centroid": wkt_centroid,
}

_U = Q.uuid_sql


def _id(list_type: str, code: str) -> str:
    """Id of a code of a type, else the default of the type."""
    return (
        f"coalesce((SELECT min(id_nomenclature) FROM codes WHERE mnemonique = '{list_type}' AND cd_nomenclature = {code}),"
        f" (SELECT min(id_nomenclature) FROM codes WHERE mnemonique = '{list_type}' AND is_default))"
    )


_AF_KNOWN = f"""af0 AS (SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, {_U("'a' || n_nationkey")} AS uuid, n_name AS name
    FROM nation WHERE n_regionkey < 2)"""
_ACTOR_DOCS = f"""act AS (SELECT DISTINCT o_custkey AS id_dataset, o_orderstatus AS st, o_orderkey % 100 AS n,
        {_U("CASE WHEN o_orderstatus = 'F' THEN 's' ELSE 'r' END || (o_orderkey % 100)")} AS uuid,
        CASE WHEN o_orderkey % 4 = 0 THEN '?' ELSE o_orderstatus END AS role FROM orders WHERE o_orderstatus <> 'P'),
    org0 AS (SELECT s_suppkey AS id, {_U("'s' || s_suppkey")} AS uuid, s_name AS name FROM supplier WHERE s_nationkey = 0),
    org AS (SELECT id, uuid, name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS origin FROM org0
            UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM org0) + row_number() OVER (ORDER BY md5(uuid)), uuid, 'Org ' || n,
                   'm' || n || '@example.org', '{{"source":"s0","module":"{M.MODULE}"}}'
            FROM (SELECT DISTINCT uuid, n FROM act WHERE st = 'F' AND uuid NOT IN (SELECT uuid FROM org0))),
    per AS (SELECT row_number() OVER (ORDER BY md5(uuid)) AS id, uuid, 'Name ' || n AS name, CAST(NULL AS VARCHAR) AS email,
                   '{{"source":"s0","module":"{M.MODULE}","{M.MODULE}_data":{{"email":"m' || n || '@example.org"}}}}' AS origin
            FROM (SELECT DISTINCT uuid, n FROM act WHERE st = 'O'))"""
_FACT_ITEMS = f"""raw AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate, o_orderkey % 2 + 1 AS id_source,
        CASE WHEN o_orderkey % 19 <> 0 THEN {_U("'o' || o_orderkey")} END AS uuid,
        CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS st, substr(o_orderpriority, 1, 1) AS digit,
        {_U("'d' || o_custkey")} AS jdd, {_U("'a' || (o_custkey % 25)")} AS ca FROM orders),
    old AS (SELECT o_orderkey + 1 AS id, {_U("'o' || o_orderkey")} AS uuid, CASE WHEN o_orderkey % 13 = 0 THEN 7 ELSE o_orderkey % 2 + 1 END AS id_source,
                   o_orderkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
    {_AF_KNOWN},
    ds0 AS (SELECT id_dataset AS id, unique_dataset_id AS uuid FROM datasets WHERE id_acquisition_framework < 10),
    good AS (SELECT r.*, o.id AS old_id FROM raw r LEFT JOIN old o ON o.uuid = r.uuid
             WHERE r.uuid IS NOT NULL AND (o.uuid IS NULL OR o.id_source = r.id_source)),
    ds AS (SELECT id, uuid FROM ds0 UNION ALL
           SELECT (SELECT max(id) FROM ds0) + row_number() OVER (ORDER BY md5(jdd)), jdd
           FROM (SELECT DISTINCT jdd FROM good WHERE k % 2 = 1 AND jdd NOT IN (SELECT uuid FROM ds0))),
    named AS (SELECT g.*, ds.id AS id_dataset, a.id_area FROM good g LEFT JOIN ds ON ds.uuid = g.jdd
              LEFT JOIN areas a ON g.k % 3 = 0 AND a.type_code = 'AFRICA' AND a.area_code = 'NATION_' || (g.c % 25)),
    ids AS (SELECT uuid, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY md5(uuid)) AS id FROM named WHERE old_id IS NULL)"""
_DOCS = f"""afd AS (SELECT n_nationkey AS n, {_U("'a' || n_nationkey")} AS uuid, n_name AS name FROM nation),
    {_AF_KNOWN},
    af AS (SELECT id, uuid, name, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS BIGINT) AS code, CAST(NULL AS INT) AS n FROM af0
           UNION ALL SELECT (SELECT max(id) FROM af0) + row_number() OVER (ORDER BY md5(uuid)), uuid, name, 'about ' || name,
                  {_id("TYPE_FINANCEMENT", "CASE WHEN n % 2 = 0 THEN '1' ELSE 'none' END")}, n
           FROM afd WHERE uuid NOT IN (SELECT uuid FROM af0)),
    ds AS (SELECT row_number() OVER (ORDER BY md5(uuid)) AS id, * FROM (
           SELECT c_custkey AS c, {_U("'d' || c_custkey")} AS uuid, {_U("'a' || (c_nationkey + CASE WHEN c_custkey % 6 = 0 THEN 100 ELSE 0 END)")} AS ca,
                  c_name AS name, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment ELSE '...' END AS text, c_custkey % 3 = 0 AS marine FROM customer))"""

SQL = {
    "code_lookup_default": Q.with_views("codes", f"""SELECT o_orderkey, {_id(S.ACTOR_ROLE_TYPE, "a")} AS id_a, {_id(S.THEME_TYPE, "b")} AS id_b,
            {_id(S.TERRITORY_TYPE, "c")} AS id_c
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '?' WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS a,
                     CASE WHEN o_orderkey % 5 <> 0 THEN substr(o_orderpriority, 1, 1) END AS b, 'Brand#' || (o_orderkey % 30) AS c FROM orders)"""),
    "label_lookup": Q.with_views("codes", f"""SELECT o_orderkey, n.id_nomenclature AS id FROM orders
        LEFT JOIN codes n ON n.mnemonique = '{S.THEME_TYPE}' AND n.label_default =
            CASE WHEN o_orderkey % 9 = 0 THEN o_orderpriority ELSE lower(o_orderpriority) END"""),
    "label_lookup_like": Q.with_views("codes", """SELECT o_orderkey,
            (SELECT min(id_nomenclature) FROM codes WHERE mnemonique LIKE 'STATUT_%' AND label_default = label) AS id,
            (SELECT min(id_nomenclature) FROM codes WHERE mnemonique LIKE 'TYP_DEN_R' AND label_default = label) AS id_wild
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN o_orderpriority ELSE lower(o_orderpriority) END AS label FROM orders)"""),
    "area_lookup": Q.with_views("codes areas", f"""SELECT c_custkey, id_area, {_id("TYP_INF_GEO", "CASE WHEN id_area IS NULL THEN '1' ELSE '2' END")} AS info_type
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 AND c_custkey % 13 <> 0 THEN id_area END AS id_area
              FROM customer JOIN areas ON id_area = c_nationkey)"""),
    "get_or_insert_dims": f"""WITH {_AF_KNOWN},
        w AS (SELECT {_U("'a' || (o_custkey % 25)")} AS ca, {_U("'d' || o_custkey")} AS jdd, o_orderkey FROM orders),
        af AS (SELECT id, uuid, name, CAST(NULL AS VARCHAR) AS text FROM af0 UNION ALL
               SELECT (SELECT max(id) FROM af0) + row_number() OVER (ORDER BY md5(ca)), ca, 'AF ' || k, '{S.BASIC_FRAMEWORK_DESC}AF ' || k
               FROM (SELECT ca, min(o_orderkey) AS k FROM w WHERE ca NOT IN (SELECT uuid FROM af0) GROUP BY ca)),
        ds AS (SELECT row_number() OVER (ORDER BY md5(jdd)) AS id, jdd, 'A rather long name of a dataset ' || k AS name, ca
               FROM (SELECT jdd, min(o_orderkey) AS k, arg_min(ca, o_orderkey) AS ca FROM w GROUP BY jdd))
        SELECT 'framework' AS kind, id, uuid, name, text, CAST(NULL AS BIGINT) AS owner FROM af
        UNION ALL SELECT 'dataset', ds.id, jdd, ds.name, left(ds.name, 30), af.id FROM ds LEFT JOIN af ON af.uuid = ds.ca""",
    "load_fact": Q.with_views("codes areas datasets", f"""
        SELECT coalesce(n.old_id, ids.id) AS id_synthese, n.uuid AS unique_id_sinp, n.id_source, CAST(k AS VARCHAR) AS entity_source_pk_value, id_dataset,
               {_id("NAT_OBJ_GEO", "st")} AS id_nomenclature_geo_object_nature, {_id("STADE_VIE", "st")} AS id_nomenclature_life_stage,
               {_id("SEXE", "digit")} AS id_nomenclature_sex, {_id("TYPE", "digit")} AS id_nomenclature_determination_method,
               {_id("TYP_INF_GEO", "CASE WHEN id_area IS NULL THEN '1' ELSE '2' END")} AS id_nomenclature_info_geo_type,
               {_id("STAT_BIOGEO", "CAST(NULL AS VARCHAR)")} AS id_nomenclature_biogeo_status,
               CAST(c AS INT) AS cd_nom, CAST(digit AS INT) AS cd_hab, 'POINT(' || (c % 10) || ' ' || (c % 50) || ')' AS the_geom_point,
               id_area AS id_area_attachment, {Q.stamp_sql("o_orderdate")} AS date_min,
               CASE WHEN old_id IS NOT NULL OR k % 23 = 0 THEN 'U' ELSE 'I' END AS last_action
        FROM named n LEFT JOIN ids ON ids.uuid = n.uuid
        UNION ALL SELECT id, uuid, id_source, CAST(k AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'I'
        FROM old WHERE uuid NOT IN (SELECT uuid FROM good)""", _FACT_ITEMS),
    "delete_fact": Q.with_views("change_log", f"""SELECT o_orderkey AS id_synthese, {_U("'o' || o_orderkey")} AS unique_id_sinp, o_orderkey % 2 + 1 AS id_source
        FROM orders WHERE NOT EXISTS (SELECT 1 FROM change_log c WHERE c.last_action = 'D' AND c.id_data = o_orderkey
              AND c.id_data % 4 <> 0 AND CAST(substr(c.source, 2) AS INT) + 1 = o_orderkey % 2 + 1)"""),
    "load_metadata": Q.with_views("codes", f"""SELECT 'framework' AS kind, id, uuid, name, text, CAST(NULL AS BIGINT) AS owner, CAST(NULL AS BOOLEAN) AS marine, code FROM af
        UNION ALL SELECT 'dataset', ds.id, ds.uuid, ds.name, ds.text, af.id, ds.marine, {_id("DATA_TYP", "CAST(c % 5 + 1 AS VARCHAR)")}
        FROM ds LEFT JOIN af ON af.uuid = ds.ca""", _DOCS),
    "metadata_bridges": Q.with_views("codes", f"""
        SELECT DISTINCT 'framework_territories' AS bridge, id AS owner, {_id(S.TERRITORY_TYPE, "v")} AS code
        FROM (SELECT id, unnest(CASE WHEN n % 3 <> 0 THEN ['Brand#7', 'Brand#' || n] ELSE ['{S.DEFAULT_TERRITORY}'] END) AS v FROM af WHERE n IS NOT NULL)
        UNION ALL SELECT DISTINCT 'framework_objectives', id, {_id(S.OBJECTIVE_TYPE, "v")}
        FROM (SELECT id, unnest(CASE WHEN n % 4 <> 0 THEN ['MACHINERY'] ELSE ['{S.DEFAULT_OBJECTIVE}'] END) AS v FROM af WHERE n IS NOT NULL)
        UNION ALL SELECT DISTINCT 'framework_themes', id, {_id(S.THEME_TYPE, "v")}
        FROM (SELECT id, unnest(CASE WHEN n % 5 <> 0 THEN ['2', '4'] ELSE ['{S.DEFAULT_THEME}'] END) AS v FROM af WHERE n IS NOT NULL)
        UNION ALL SELECT DISTINCT 'dataset_territories', id, {_id(S.TERRITORY_TYPE, "v")}
        FROM (SELECT id, unnest(['Brand#' || (c % 25 + 1), '{S.DEFAULT_TERRITORY}']) AS v FROM ds WHERE c % 5 <> 0)""", _DOCS),
    "bridge_territories": Q.with_views("codes", f"""SELECT DISTINCT o_custkey, {_id(S.TERRITORY_TYPE, "v")} AS id_territory FROM (
        SELECT o_custkey, p_brand AS v FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        WHERE o_custkey % 5 = 0 OR o_custkey % 7 <> 0
        UNION ALL SELECT o_custkey, '{S.DEFAULT_TERRITORY}' FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_custkey % 5 = 0 OR o_custkey % 7 = 0)"""),
    "actors_get_or_create": f"""WITH {_ACTOR_DOCS} SELECT 'organism' AS kind, id, uuid, name, email, origin FROM org
        UNION ALL SELECT 'role', id, uuid, name, email, origin FROM per""",
    "actor_bridges": Q.with_views("codes", f"""SELECT DISTINCT id_dataset, CASE WHEN st = 'F' THEN org.id END AS id_organism,
            CASE WHEN st = 'O' THEN per.id END AS id_role, {_id(S.ACTOR_ROLE_TYPE, "role")} AS id_nomenclature_actor_role
        FROM act LEFT JOIN org ON st = 'F' AND org.uuid = act.uuid LEFT JOIN per ON st = 'O' AND per.uuid = act.uuid""", _ACTOR_DOCS),
    "additional_data": f"""SELECT s_suppkey, CAST(CASE s_suppkey % 3
            WHEN 0 THEN json_object('a', 1, 'module', '{M.MODULE}', 'source', s_name)
            WHEN 1 THEN json_object('module', '{M.MODULE}', 'source', s_name, 'z', [1, NULL])
            ELSE json_object('module', '{M.MODULE}', 'source', s_name) END AS VARCHAR) AS additional_data FROM supplier""",
    "wkt_centroid": """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN x WHEN 1 THEN NULL ELSE round(x + w / 3.0, 6) END AS x,
            CASE c_custkey % 5 WHEN 0 THEN y WHEN 1 THEN NULL ELSE round(y + 2 * w / 3.0, 6) END AS y,
            CASE c_custkey % 5 WHEN 0 THEN 'POINT(' || x || ' ' || y || ')' WHEN 1 THEN NULL
                 ELSE 'POLYGON((' || x || ' ' || y || ',' || (x + w) || ' ' || y || ',' || x || ' ' || (y + 2 * w) || ',' || x || ' ' || y || '))' END AS wkt
        FROM (SELECT c_custkey, c_custkey % 300 - 150 AS x, c_custkey % 120 - 60 AS y, c_custkey % 7 + 1 AS w FROM customer)""",
}
