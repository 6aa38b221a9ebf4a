"""The publisher's tables seen in the given order, customer and event tables.

Orders act as observations, customers as datasets, nations as frameworks, suppliers
as organisms and persons. Ids of codes are computed, not looked up, so that a view
costs a projection. `sql.py` has the same views as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.functions.text import uuid_of
from gleanery.plans.export import Tables

# Kind of codes of each type: order status, order priority, market segment or brand.
KINDS = "SPMB"
ROLE_KINDS = "SP"


def type_index(list_type: str) -> int:
    return S.ALL_CODE_TYPES.index(list_type) + 1


def kind_of(list_type: str) -> str:
    """Kind of code a type uses in these views."""
    fixed = {
        S.TERRITORY_TYPE: "B",
        S.OBJECTIVE_TYPE: "M",
        S.THEME_TYPE: "P",
        S.ACTOR_ROLE_TYPE: "S",
        "TYP_INF_GEO": "P",
    }
    metadata = {c.list_type for c in (*S.DATASET_CODES, *S.FRAMEWORK_CODES)} - {"STATUT_SOURCE"}
    if list_type in fixed:
        return fixed[list_type]
    if list_type in metadata:
        return "P"
    return ROLE_KINDS[type_index(list_type) % 2]


def has_gap(list_type: str) -> bool:
    """Types whose list lacks the code `P` or `5`: facts then point to no code."""
    return type_index(list_type) % 5 == 0 and kind_of(list_type) in ROLE_KINDS


class Domain:
    """Views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._opened[name]

    def dealt(self, name: str, key: str) -> DataFrame:
        """A table dealt over the tasks by its key, for columns that are costly to make.

        A small file is read by one task, whatever its rows are made into.
        """
        return self.table(name).repartition(key)

    # ------------------------------------------------------------- code lists
    def codes(self) -> DataFrame:
        orders, customer, part = self.table("orders"), self.table("customer"), self.table("part")
        digit = F.substring("o_orderpriority", 1, 1)
        found = (
            orders.select(F.lit("S").alias("kind"), F.col("o_orderstatus").alias("cd"), F.ascii("o_orderstatus").alias("ord"), F.col("o_orderstatus").alias("label"))
            .distinct()
            .unionByName(
                orders.select(F.lit("P").alias("kind"), digit.alias("cd"), digit.cast("int").alias("ord"), F.col("o_orderpriority").alias("label")).distinct()
            )
            .unionByName(
                customer.select(F.lit("M").alias("kind"), F.col("c_mktsegment").alias("cd"), F.ascii("c_mktsegment").alias("ord"), F.col("c_mktsegment").alias("label")).distinct()
            )
            .unionByName(
                part.select(F.lit("B").alias("kind"), F.col("p_brand").alias("cd"), F.substring("p_brand", 7, 9).cast("int").alias("ord"), F.col("p_brand").alias("label")).distinct()
            )
        )
        types = F.array(
            *[
                F.struct(
                    F.lit(kind_of(t)).alias("kind"), F.lit(type_index(t)).alias("id_type"),
                    F.lit(t).alias("mnemonique"), F.lit(has_gap(t)).alias("gap"),
                )
                for t in S.ALL_CODE_TYPES
            ]
        )
        rows = found.withColumn("t", F.explode(F.filter(types, lambda t: t["kind"] == F.col("kind"))))
        rows = rows.where(~(F.col("t.gap") & F.col("cd").isin("P", "5")))
        lowest = F.when(F.col("kind") == "S", 70).when(F.col("kind") == "M", 65).otherwise(1)
        return rows.select(
            (F.col("t.id_type") * 100 + F.col("ord")).cast("bigint").alias("id_nomenclature"),
            F.col("t.id_type").alias("id_type"),
            F.col("t.mnemonique").alias("mnemonique"),
            F.col("cd").alias("cd_nomenclature"),
            F.lower("label").alias("label_default"),
            (F.col("ord") == lowest).alias("is_default"),
        )

    def areas(self) -> DataFrame:
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("type_code"))
        return self.table("nation").join(region, "n_regionkey").select(
            F.col("n_nationkey").cast("bigint").alias("id_area"), "type_code", F.col("n_name").alias("area_code")
        )

    # ------------------------------------------------------------------ facts
    def code_id(self, code: S.Code, status: Column, digit: Column, number: Column) -> Column:
        index = type_index(code.list_type)
        order = F.ascii(status) if kind_of(code.list_type) == "S" else digit.cast("int")
        # Every type is missing on some rows.
        return F.when(number % (index + 7) != 0, (F.lit(index * 100) + order).cast("bigint"))

    def facts(self) -> DataFrame:
        o = self.table("orders")
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        digit = F.substring("o_orderpriority", 1, 1)
        text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
        return o.select(
            key.alias("id_synthese"),
            key.cast("string").alias("entity_source_pk_value"),
            uuid_of(text("o", key)).alias("unique_id_sinp"),
            F.when(key % 3 == 0, uuid_of(text("g", F.col("o_custkey")))).alias("unique_id_sinp_grp"),
            (key % 2 + 1).alias("id_source"),
            F.col("o_custkey").alias("id_dataset"),
            F.col("o_orderdate").alias("date_min"),
            (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("date_max"),
            F.col("o_custkey").cast("int").alias("cd_nom"),
            F.lit("v16").alias("meta_v_taxref"),
            F.col("o_orderpriority").alias("nom_cite"),
            F.lit(1).alias("count_min"),
            F.floor(F.col("o_totalprice") / 1000).cast("int").alias("count_max"),
            (key % 1000).cast("int").alias("altitude_min"),
            (key % 1000 + 100).cast("int").alias("altitude_max"),
            F.lit(None).cast("int").alias("depth_min"),
            F.lit(None).cast("int").alias("depth_max"),
            text("observer ", F.col("o_custkey")).alias("observers"),
            F.when(key % 5 == 0, text("expert ", key % 11)).alias("determiner"),
            F.lit(None).cast("string").alias("validator"),
            F.lit(None).cast("string").alias("sample_number_proof"),
            F.lit(None).cast("string").alias("digital_proof"),
            F.lit(None).cast("string").alias("non_digital_proof"),
            F.col("o_orderstatus").alias("comment_context"),
            F.lit(None).cast("string").alias("comment_description"),
            F.lit(None).cast("string").alias("reference_biblio"),
            text("place ", key % 97).alias("place_name"),
            (key % 500).cast("int").alias("precision"),
            F.lit(None).cast("string").alias("grp_method"),
            digit.cast("int").alias("cd_hab"),
            F.concat(F.lit('{"price":'), F.floor("o_totalprice").cast("string"), F.lit("}")).alias("additional_data"),
            F.concat(F.lit("POINT("), (F.col("o_custkey") % 360 - 180).cast("string"), F.lit(" "), (F.col("o_custkey") % 180 - 90).cast("string"), F.lit(")")).alias("the_geom_4326"),
            (F.col("o_custkey") % 30).alias("id_area_attachment"),
            F.col("o_orderdate").alias("meta_create_date"),
            F.when(key % 4 != 0, F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("meta_update_date"),
            *[self.code_id(c, status, digit, key).alias(c.column) for c in S.CODES],
        )

    def habitats(self) -> DataFrame:
        rows = self.table("orders").select("o_orderpriority").distinct()
        return rows.select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("cd_hab"), F.lower("o_orderpriority").alias("lb_hab_fr")
        )

    # --------------------------------------------------------------- metadata
    def datasets(self) -> DataFrame:
        c = self.table("customer")
        key = F.col("c_custkey")
        ids = [
            F.when(key % (type_index(d.list_type) + 3) != 0, (F.lit(type_index(d.list_type) * 100 + (70 if kind_of(d.list_type) == "S" else 1)) + (0 if kind_of(d.list_type) == "S" else key % 5)).cast("bigint")).alias(d.column)
            for d in S.DATASET_CODES
        ]
        return c.select(
            key.alias("id_dataset"),
            uuid_of(F.concat(F.lit("d"), key.cast("string"))).alias("unique_dataset_id"),
            F.col("c_nationkey").cast("bigint").alias("id_acquisition_framework"),
            F.col("c_name").alias("dataset_name"),
            F.left("c_name", F.lit(12)).alias("dataset_shortname"),
            F.when(key % 7 != 0, F.concat(F.lit("about "), "c_mktsegment")).alias("dataset_desc"),
            (F.col("c_acctbal") < 0).alias("marine_domain"),
            (F.col("c_acctbal") >= 0).alias("terrestrial_domain"),
            F.lower("c_mktsegment").alias("keywords"),
            *ids,
        )

    def frameworks(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.cast("bigint").alias("id_acquisition_framework"),
            uuid_of(F.concat(F.lit("a"), key.cast("string"))).alias("unique_acquisition_framework_id"),
            F.col("n_name").alias("acquisition_framework_name"),
            F.concat(F.lit("framework of "), "n_name").alias("acquisition_framework_desc"),
            F.date_add(F.lit("2000-01-01").cast("date"), key).alias("acquisition_framework_start_date"),
            F.lit(None).cast("date").alias("acquisition_framework_end_date"),
            F.lit(None).cast("timestamp_ntz").alias("initial_closing_date"),
            F.lit(None).cast("string").alias("territory_desc"),
            F.lower("n_name").alias("target_description"),
            F.lit(None).cast("string").alias("ecologic_or_geologic_target"),
            (key < 5).alias("is_parent"),
            F.when(key >= 5, F.col("n_regionkey").cast("bigint")).alias("acquisition_framework_parent_id"),
            *[
                (F.lit(type_index(c.list_type) * 100 + 1) + key % 6).cast("bigint").alias(c.column)
                for c in S.FRAMEWORK_CODES
            ],
        )

    def organisms(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("id_organisme"),
            uuid_of(F.concat(F.lit("s"), key.cast("string"))).alias("uuid_organisme"),
            F.col("s_name").alias("nom_organisme"),
            F.when(F.col("s_nationkey") != 0, F.concat("s_name", F.lit("@example.org"))).alias("email_organisme"),
        )

    def roles(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("id_role"),
            uuid_of(F.concat(F.lit("r"), key.cast("string"))).alias("uuid_role"),
            F.concat(F.lit("Name "), key.cast("string")).alias("nom_role"),
            F.concat(F.lit("First "), F.col("s_nationkey").cast("string")).alias("prenom_role"),
            F.when(key % 2 == 0, F.concat(F.lit("p"), key.cast("string"), F.lit("@example.org"))).alias("email"),
        )

    def dataset_actors(self) -> DataFrame:
        """An order with status F names an organism, one with O a person, one with P nobody."""
        actor = F.col("o_orderkey") % 100
        index = type_index(S.ACTOR_ROLE_TYPE)
        return (
            self.table("orders")
            .select(
                F.col("o_custkey").alias("id_dataset"),
                F.when(F.col("o_orderstatus") == "F", actor).alias("id_organism"),
                F.when(F.col("o_orderstatus") == "O", actor).alias("id_role"),
                (F.lit(index * 100) + F.ascii("o_orderstatus")).cast("bigint").alias("id_nomenclature_actor_role"),
            )
            .distinct()
        )

    def framework_actors(self) -> DataFrame:
        index = type_index(S.ACTOR_ROLE_TYPE)
        return (
            self.table("customer")
            .select(
                F.col("c_nationkey").cast("bigint").alias("id_acquisition_framework"),
                F.ascii("c_mktsegment").cast("bigint").alias("id_organism"),
                F.lit(None).cast("bigint").alias("id_role"),
                F.lit(index * 100 + 70).cast("bigint").alias("id_nomenclature_actor_role"),
            )
            .distinct()
        )

    def dataset_territories(self) -> DataFrame:
        """Brands of the parts each customer ordered."""
        line = self.table("lineitem").select("l_orderkey", "l_partkey")
        part = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.substring("p_brand", 7, 9).cast("int").alias("brand")
        )
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("id_dataset"))
        index = type_index(S.TERRITORY_TYPE)
        return (
            line.join(part, "l_partkey")
            .join(orders, "l_orderkey")
            .select("id_dataset", (F.lit(index * 100) + F.col("brand")).cast("bigint").alias("id_nomenclature_territory"))
            .distinct()
        )

    def protocols(self) -> DataFrame:
        key = F.ascii("c_mktsegment").cast("bigint")
        return self.table("customer").select("c_mktsegment").distinct().select(
            key.alias("id_protocol"),
            uuid_of(F.concat(F.lit("p"), "c_mktsegment")).alias("unique_protocol_id"),
            F.col("c_mktsegment").alias("protocol_name"),
            F.lit(None).cast("string").alias("protocol_desc"),
            F.concat(F.lit("http://example.org/"), F.lower("c_mktsegment")).alias("protocol_url"),
            (F.lit(type_index("DATA_TYP") * 100) + key % 5 + 1).cast("bigint").alias("id_nomenclature_protocol_type"),
        )

    def dataset_protocols(self) -> DataFrame:
        """One protocol for a balance from zero up, a second one for a large balance."""
        c = self.table("customer").where("c_acctbal >= 0")
        own = F.ascii("c_mktsegment").cast("bigint")
        second = F.when(own == 65, F.lit(66)).otherwise(F.lit(65)).cast("bigint")
        listed = F.when(F.col("c_acctbal") > 5000, F.array(own, second)).otherwise(F.array(own))
        return c.select(F.col("c_custkey").alias("id_dataset"), F.explode(listed).alias("id_protocol"))

    def framework_bridges(self) -> dict[str, DataFrame]:
        c, s, n = self.table("customer"), self.table("supplier"), self.table("nation")
        owner = F.col("c_nationkey").cast("bigint").alias("id_acquisition_framework")
        code = lambda t, c: (F.lit(type_index(t) * 100) + c).cast("bigint")
        return {
            "framework_territories": c.select(
                owner, code(S.TERRITORY_TYPE, F.col("c_custkey") % 27 + 1).alias("id_nomenclature_territory")
            ).distinct(),
            "framework_objectives": c.select(
                owner, code(S.OBJECTIVE_TYPE, F.ascii("c_mktsegment")).alias("id_nomenclature_objectif")
            ).distinct(),
            "framework_themes": s.select(
                F.col("s_nationkey").cast("bigint").alias("id_acquisition_framework"),
                code(S.THEME_TYPE, F.col("s_suppkey") % 5 + 1).alias("id_nomenclature_voletsinp"),
            ).distinct(),
            "framework_publications": n.select(
                F.col("n_nationkey").cast("bigint").alias("id_acquisition_framework"),
                F.explode(F.array(F.col("n_regionkey").cast("bigint"), F.lit(0).cast("bigint"))).alias("id_publication"),
            ),
        }

    def publications(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("id_publication"),
            uuid_of(F.concat(F.lit("b"), F.col("r_regionkey").cast("string"))).alias("unique_publication_id"),
            F.col("r_name").alias("publication_reference"),
            F.lit(None).cast("string").alias("publication_url"),
        )

    def publisher(self) -> Tables:
        """All the tables an export needs."""
        return Tables(
            facts=self.facts(), datasets=self.datasets(), frameworks=self.frameworks(),
            organisms=self.organisms(), roles=self.roles(), dataset_actors=self.dataset_actors(),
            framework_actors=self.framework_actors(), codes=self.codes(), habitats=self.habitats(),
            areas=self.areas(), dataset_territories=self.dataset_territories(),
            dataset_protocols=self.dataset_protocols(), protocols=self.protocols(),
            publications=self.publications(), **self.framework_bridges(),
        )

    # ------------------------------------------------------------------- logs
    def change_log(self) -> DataFrame:
        """Change log of the publishers: an error event deletes, a signup inserts."""
        kind = F.col("event_type")
        return self.table("events").select(
            F.concat(F.lit("s"), (F.col("user_id") % 2).cast("string")).alias("source"),
            F.col("user_id").alias("id_data"),
            F.when(kind == "error", "D").when(kind == "signup", "I").otherwise("U").alias("last_action"),
            F.col("ts").alias("meta_last_action_date"),
        )

    def run_log(self) -> DataFrame:
        """Each event as one import run of one of five sources."""
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("src"), (F.col("user_id") % 5).cast("string")).alias("source"),
            F.lit(S.CONTROLER_DATA).alias("controler"),
            F.when(kind == "signup", "full").otherwise("update").alias("xfer_type"),
            F.when(kind == "purchase", S.STATUS_SUCCESS).when(kind == "error", S.STATUS_FAILED).otherwise(S.STATUS_IMPORT).alias("xfer_status"),
            F.col("ts").alias("xfer_start_ts"),
            F.floor("value").cast("bigint").alias("api_count_items"),
            F.col("props").alias("xfer_filters"),
        )
