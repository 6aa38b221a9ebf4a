"""Page, split and merge queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.catalogue import sql as Q
from gleanery.catalogue.views import Domain
from gleanery.functions import documents as D
from gleanery.functions import text as text_tables
from gleanery.functions.text import clean_uuid, uuid_of
from gleanery.operators import pages as P
from gleanery.operators import runlog as R
from gleanery.operators import split as SP
from gleanery.operators.joins import join_lookup
from gleanery.operators.lineage import cut, shared_folder
from gleanery.operators.merge import delete_by_log, latest, upsert_data, upsert_metadata
from gleanery.sources.snapshot import Store
from gleanery.streaming.polling import poll_into_store

_MID = "TIMESTAMP_NTZ '1999-01-01 00:00:00'"
_OVERLAP = "TIMESTAMP_NTZ '1998-06-01 00:00:00'"


def empty(spark: SparkSession, layout: str) -> DataFrame:
    return spark.createDataFrame([], layout)


# ------------------------------------------------------------------------ pages
def page_plan(spark: SparkSession, folder: str) -> DataFrame:
    totals = Domain(spark, folder).table("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("total"))
    return P.page_plan(totals, "total", 100)


def page_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of events that lack some, have some twice, and end before or behind their totals."""
    e = Domain(spark, folder).table("events").select((F.col("user_id") % 3).alias("k"), F.floor(F.col("event_id") / 100).alias("page_no"))
    top = e.agg(F.max("page_no")).first()[0]
    pages = e.distinct().where((F.col("page_no") + F.col("k")) % 7 != 3)
    pages = pages.unionByName(pages.where("page_no % 5 = 0")).withColumn("top", F.lit(top))
    planned = F.when(F.col("k") == 0, F.col("top") + 1).when(F.col("k") == 1, F.greatest(F.lit(1), F.col("top") - 1)).otherwise(F.col("top") + 5)
    landed = pages.select(
        F.concat(F.lit("s"), F.col("k").cast("string")).alias("source"), "page_no",
        (planned * 100 - 50).alias("total_filtered"), F.lit(100).cast("bigint").alias("limit"),
    )
    return P.page_gaps(landed, ["source"])


def page_plan_log(spark: SparkSession, folder: str) -> DataFrame:
    totals = Domain(spark, folder).change_log().groupBy("source").agg(
        F.count_if(F.col("last_action") == "D").alias("total")
    )
    return P.page_plan(totals, "total", 100, param="page")


def _event_items(spark: SparkSession, folder: str) -> DataFrame:
    e = Domain(spark, folder).table("events")
    item = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"props":'), F.col("props"), F.lit("}"))
    return e.select("event_id", "event_type", "value", item.alias("item"))


def page_scan(spark: SparkSession, folder: str) -> DataFrame:
    items = _event_items(spark, folder)
    paged = P.paginate(items, 100, id_column="event_id")
    return P.scan_pages(P.to_envelopes(paged, "item", 100, items.count()))


def page_scan_ordered(spark: SparkSession, folder: str) -> DataFrame:
    items = _event_items(spark, folder)
    paged = P.paginate(items, 100, order="event_type:event_id")
    return P.scan_pages(P.to_envelopes(paged, "item", 100, items.count()))


def progress(spark: SparkSession, folder: str) -> DataFrame:
    e = Domain(spark, folder).table("events")
    run = F.concat(F.lit("src"), (F.col("user_id") % 5).cast("string")).alias("run")
    pages = e.groupBy(run, F.floor(F.col("event_id") / 100).alias("page")).agg(F.count(F.lit(1)).alias("size"))
    totals = pages.groupBy("run").agg(F.sum("size").alias("total"))
    out = P.progress(join_lookup(pages, totals, ["run"], "inner"), "run", "page", "size", "total")
    return out.withColumn("percent", F.col("percent").cast("double"))


def source_names(spark: SparkSession, folder: str) -> DataFrame:
    docs = Domain(spark, folder).table("documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    lang = F.col("lang")
    sources = docs.select(
        F.concat(F.lit("  Réseau -  "), "source", F.lit(" (Île "), lang, F.lit(") ~É#1? ")).alias("name"),
        F.when(lang == "fr", F.lit("Synthese_With_LABEL")).alias("data_type"),
        F.when(lang == "de", F.lit(False)).when(lang == "es", F.lit(True)).alias("enable"),
        "n",
    )
    return R.enabled_sources(sources).select("std_name", "data_type", "n")


# --------------------------------------------------------------------- metadata
def items(spark: SparkSession, folder: str) -> DataFrame:
    """Items as they landed: a written table."""
    return cut(_items(spark, folder))


def _items(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as items with embedded documents; every tenth one is flat."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda c: c.cast("string")
    ca, jdd = uuid_of(F.concat(F.lit("a"), text(cust % 25))), uuid_of(F.concat(F.lit("d"), text(cust)))
    head = F.concat(
        F.lit('{"id_synthese":'), text(key), F.lit(',"id_perm_sinp":"'), F.col("uuid"), F.lit('","prix":12.5,')
    )
    nested = F.concat(
        head, F.lit('"ca_data":{"uuid":"'), F.col("ca"), F.lit('","name":"AF '), text(cust % 25),
        F.lit('"},"jdd_data":{"uuid":"'), F.col("jdd"), F.lit('","name":"DS '), text(cust), F.lit(" "),
        F.col("o_orderstatus"), F.lit('","seen":'), text(key), F.lit("}}"),
    )
    flat = F.concat(head, F.lit('"ca_uuid":"'), F.col("ca"), F.lit('","jdd_uuid":"'), F.col("jdd"), F.lit('"}'))
    early = F.expr(f"o_orderdate < {_MID}")
    return (
        Domain(spark, folder)
        .dealt("orders", "o_orderkey")
        .withColumn("uuid", uuid_of(F.concat(F.lit("o"), text(key))))
        .withColumn("ca", ca)
        .withColumn("jdd", jdd)
        .select(
            F.concat(F.lit("s"), text(key % 2)).alias("source"),
            F.lit("data").alias("controler"),
            F.lit(S.TYPE_WITH_METADATA).alias("type"),
            key.alias("id_data"),
            "uuid",
            F.when(key % 10 == 0, flat).otherwise(nested).alias("item"),
            F.col("o_orderdate").alias("update_ts"),
            (F.when(early, 1).otherwise(3) + key % 2).cast("bigint").alias("import_id"),
            key.alias("seq"),
        )
    )


def metadata_split(spark: SparkSession, folder: str) -> DataFrame:
    docs = SP.first_documents(items(spark, folder), []).select("level", "uuid", "item", "seq")
    first = latest(docs, ["uuid"], "seq", "first")
    return first.select("level", "uuid", D.canonical(F.col("item")).alias("item"))


def metadata_split_items(spark: SparkSession, folder: str) -> DataFrame:
    data = SP.split_metadata(items(spark, folder))[0]
    return data.select("id_data", D.canonical(F.col("item")).alias("item"))


def upsert_metadata_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = SP.first_documents(items(spark, folder), ["source", "import_id"])
    docs = docs.withColumn("controler", F.lit(S.CONTROLER_METADATA))
    # What one import leaves behind is a written table for the next one.
    first = cut(upsert_metadata(empty(spark, S.METADATA_JSON), docs.where("import_id < 3")).state)
    second = upsert_metadata(first, docs.where("import_id >= 3"))
    return second.state.select("source", "uuid", "level", D.canonical(F.col("item")).alias("item"), "import_id")


def metadata_backfill(spark: SparkSession, folder: str) -> DataFrame:
    known = Domain(spark, folder).table("nation").where("n_regionkey < 2").select(
        F.lit("old").alias("source"), F.lit(S.CONTROLER_METADATA).alias("controler"),
        F.lit(S.TYPE_WITH_METADATA).alias("type"), F.lit(S.LEVEL_FRAMEWORK).alias("level"),
        uuid_of(F.concat(F.lit("a"), F.col("n_nationkey").cast("string"))).alias("uuid"),
        F.lit("{}").alias("item"), F.lit(None).cast("timestamp_ntz").alias("update_ts"),
        F.lit(0).cast("bigint").alias("import_id"),
    )
    out = SP.backfill_metadata(items(spark, folder), known, ["update_ts", "seq"])
    return out.select("source", "uuid", "level", D.canonical(F.col("item")).alias("item"), "import_id")


def item_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    e = Domain(spark, folder).table("events")
    number = F.col("user_id").cast("string")
    ca = F.concat(F.lit(',"ca_data":{"uuid":"a'), number, F.lit('"}'))
    jdd = F.concat(F.lit(',"jdd_data":{"uuid":"d'), number, F.lit('"}'))
    kind = F.col("event_type")
    more = (
        F.when(kind == "view", F.concat(ca, jdd))
        .when(kind == "click", ca)
        .when(kind == "signup", F.concat(ca, jdd, F.lit(',"ca_uuid":"kept"')))
        .otherwise(F.lit(""))
    )
    item = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"props":'), F.col("props"), more, F.lit("}"))
    rows = SP.rewrite_items(e.select("event_id", item.alias("item")))
    return rows.select("event_id", D.canonical(F.col("item")).alias("item"))


# ------------------------------------------------------------------------ merge
def raw_rows(spark: SparkSession, folder: str, uuid_key=None) -> DataFrame:
    """Orders as raw rows, with the price in the item."""
    key = F.col("o_orderkey")
    price = F.floor("o_totalprice")
    named = F.col("o_orderkey") if uuid_key is None else uuid_key
    return (
        Domain(spark, folder)
        .table("orders")
        .select(
            F.concat(F.lit("s"), (key % 2).cast("string")).alias("source"),
            F.lit("data").alias("controler"),
            F.lit(S.TYPE_WITH_CODES).alias("type"),
            key.alias("id_data"),
            uuid_of(F.concat(F.lit("o"), named.cast("string"))).alias("uuid"),
            price.alias("price"),
            F.col("o_orderdate").alias("update_ts"),
        )
    )


def _with_item(rows: DataFrame, factor, first_import: int) -> DataFrame:
    item = F.concat(
        F.lit('{"id_synthese":'), F.col("id_data").cast("string"), F.lit(',"price":'),
        (F.col("price") * factor).cast("string"), F.lit("}"),
    )
    return rows.withColumn("item", item).withColumn("import_id", (F.lit(first_import) + F.col("id_data") % 2).cast("bigint"))


def batches(spark: SparkSession, folder: str, uuid_key=None) -> tuple[DataFrame, DataFrame]:
    """Two overlapping imports; the second doubles prices and sends every tenth order twice."""
    rows = raw_rows(spark, folder, uuid_key)
    order = lambda pos: F.struct("import_id", "update_ts", "id_data", pos.alias("pos"))
    one = _with_item(rows.where(f"update_ts < {_MID}"), F.lit(1), 1).withColumn("seq", order(F.lit(0)))
    twice = F.when(F.col("id_data") % 10 == 0, F.array(F.lit(2), F.lit(3))).otherwise(F.array(F.lit(2)))
    two = rows.where(f"update_ts >= {_OVERLAP}").withColumn("f", F.explode(twice))
    two = _with_item(two, F.col("f"), 3).withColumn("seq", order(F.col("f")))
    return one.drop("price"), two.drop("price", "f")


def upsert_data_query(spark: SparkSession, folder: str) -> DataFrame:
    one, two = batches(spark, folder)
    state = cut(upsert_data(empty(spark, S.DATA_JSON), one).state)
    return upsert_data(state, two).state.select("source", "type", "id_data", "uuid", "item", "import_id")


def upsert_uuid_conflict(spark: SparkSession, folder: str) -> DataFrame:
    # Three neighbours share a uuid, whatever their source.
    one, two = batches(spark, folder, F.floor(F.col("o_orderkey") / 3))
    first = upsert_data(empty(spark, S.DATA_JSON), one)
    second = upsert_data(cut(first.state), two)
    cols = ["source", "id_data", "uuid", "item", "import_id"]
    stored = second.state.select(F.lit("stored").alias("outcome"), *cols)
    return stored.unionByName(first.rejected.select(F.lit("rejected").alias("outcome"), *cols)).unionByName(
        second.rejected.select(F.lit("rejected").alias("outcome"), *cols)
    )


def delete_by_log_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_item(raw_rows(spark, folder), F.lit(1), 1)
    log = Domain(spark, folder).change_log().where("last_action = 'D'")
    kept, gone = delete_by_log(rows, log)
    cols = ["source", "id_data", "item"]
    return kept.select(F.lit("kept").alias("outcome"), *cols).unionByName(
        gone.select(F.lit("deleted").alias("outcome"), *cols)
    )


def incremental_run(spark: SparkSession, folder: str) -> DataFrame:
    """Upserts first, then the deletions of the log, as one run does it."""
    one, two = batches(spark, folder)
    state = cut(upsert_data(empty(spark, S.DATA_JSON), one).state)
    state = upsert_data(state, two).state
    log = Domain(spark, folder).change_log().where("last_action = 'D'")
    return delete_by_log(state, log)[0].select("source", "id_data", "uuid", "item", "import_id")


def quarantine_casts(spark: SparkSession, folder: str) -> DataFrame:
    e = Domain(spark, folder).table("events")
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    raw_uuid = F.when((kind == "signup") & (k % 7 == 0), F.lit("no-uuid")).otherwise(
        uuid_of(F.concat(F.lit("e"), F.col("event_id").cast("string")))
    )
    item = F.concat(
        F.lit('{"id_synthese":'), F.col("event_id").cast("string"),
        F.lit(',"nombre_min":'), F.when(kind == "error", F.lit('"12a"')).otherwise(k.cast("string")),
        F.lit(',"altitude_min":'), F.when(kind == "click", F.lit("1.5")).otherwise(F.lit("null")),
        F.lit(',"date_debut":"'), F.when(kind == "purchase", F.lit("2024-13-45")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        F.lit('","wkt_4326":"'), F.when((kind == "view") & (k > 50), F.lit("LINESTRING(1 2,3 4)")).otherwise(F.lit("POINT(1 2)")),
        F.lit('"}'),
    )
    rows = e.select(
        F.col("event_id").alias("id_data"), clean_uuid(raw_uuid).alias("uuid"), raw_uuid.alias("_raw_uuid"), item.alias("item")
    )
    good, bad = SP.validate(rows)
    return good.select("id_data", F.lit(None).cast("string").alias("error")).unionByName(bad.select("id_data", "error"))


# -------------------------------------------------------------------- streaming
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Events land as pages in three imports; a stream merges each into a store."""
    e = Domain(spark, folder).table("events")
    text = lambda c: c.cast("string")
    item = F.concat(
        F.lit('{"id_synthese":'), text(F.col("user_id")), F.lit(',"id_perm_sinp":"'),
        uuid_of(F.concat(F.lit("u"), text(F.col("user_id")))), F.lit('","event":'), text(F.col("event_id")), F.lit("}"),
    )
    bounds = e.agg(F.min("event_id").alias("a"), (F.max("event_id") + 1).alias("b")).first()
    width = max(1, -(-(bounds["b"] - bounds["a"]) // 3))
    rows = e.select(
        F.lit("s0").alias("source"),
        F.floor((F.col("event_id") - bounds["a"]) / width).alias("part"),
        F.floor(F.col("event_id") / 100).alias("page_no"),
        "event_id", item.alias("item"),
    )
    pages = rows.groupBy("source", "part", "page_no").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("event_id", "item"))), lambda x: x["item"]).alias("items")
    )
    line = F.concat(F.lit('{"page_no":'), text(F.col("page_no")), F.lit(',"items":['), F.array_join("items", ","), F.lit("]}"))
    place = shared_folder(spark)
    store = Store(spark, f"{place}/store")
    for part in range(3):
        pages.where(F.col("part") == part).select(line).write.text(f"{place}/landing/source=s0/import_id={part + 1}")
        poll_into_store(spark, f"{place}/landing", f"{place}/progress", store).awaitTermination()
    return store.read_ranged("data_json", S.DATA_JSON).select("source", "type", "id_data", "uuid", "item", "import_id")


QUERIES = {
    "page_plan": page_plan,
    "page_plan_log": page_plan_log,
    "page_gaps": page_gaps,
    "page_scan": page_scan,
    "page_scan_ordered": page_scan_ordered,
    "progress": progress,
    "source_names": source_names,
    "metadata_split": metadata_split,
    "metadata_split_items": metadata_split_items,
    "upsert_metadata": upsert_metadata_query,
    "metadata_backfill": metadata_backfill,
    "item_rewrite": item_rewrite,
    "upsert_data": upsert_data_query,
    "upsert_uuid_conflict": upsert_uuid_conflict,
    "delete_by_log": delete_by_log_query,
    "incremental_run": incremental_run,
    "quarantine_casts": quarantine_casts,
    "stream_upsert": stream_upsert,
}

_U = Q.uuid_sql
_EVENT_ITEM = """'{"id":' || event_id || ',"props":' || props || '}'"""
_FOLD, _FOLD_TO = text_tables.FOLDED, text_tables.FOLDED_TO
_DROP = text_tables.REMOVED.replace("'", "''")

_ITEMS = f"""items AS (SELECT 's' || (o_orderkey % 2) AS source, o_orderkey AS id_data, {_U("'o' || o_orderkey")} AS uuid,
    {_U("'a' || (o_custkey % 25)")} AS ca, {_U("'d' || o_custkey")} AS jdd, o_custkey, o_orderstatus, o_orderdate,
    o_orderkey % 10 <> 0 AS nested,
    CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 1 ELSE 3 END + o_orderkey % 2 AS import_id FROM orders)"""
_DOCS = """docs AS (SELECT source, id_data, o_orderdate, import_id, 'acquisition framework' AS level, ca AS uuid,
        CAST(json_object('name', 'AF ' || (o_custkey % 25), 'uuid', ca) AS VARCHAR) AS item FROM items WHERE nested
    UNION ALL SELECT source, id_data, o_orderdate, import_id, 'dataset', jdd,
        CAST(json_object('ca_uuid', ca, 'name', 'DS ' || o_custkey || ' ' || o_orderstatus, 'seen', id_data, 'uuid', jdd) AS VARCHAR)
        FROM items WHERE nested)"""


def _raw(uuid_key: str) -> str:
    return f"""raw AS (SELECT 's' || (o_orderkey % 2) AS source, '{S.TYPE_WITH_CODES}' AS type, o_orderkey AS id_data,
        {_U(f"'o' || {uuid_key}")} AS uuid, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderdate AS ts FROM orders),
    b1 AS (SELECT *, '{{"id_synthese":' || id_data || ',"price":' || price || '}}' AS item, 1 + id_data % 2 AS import_id, 0 AS pos
           FROM raw WHERE ts < TIMESTAMP '1999-01-01'),
    b2 AS (SELECT r.*, '{{"id_synthese":' || id_data || ',"price":' || price * f || '}}' AS item, 3 + id_data % 2 AS import_id, f AS pos
           FROM raw r, (VALUES (2), (3)) AS v(f) WHERE ts >= TIMESTAMP '1998-06-01' AND (f = 2 OR id_data % 10 = 0))"""


_MERGED = """merged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, type, id_data ORDER BY import_id DESC, pos DESC) AS rn
    FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2)) WHERE rn = 1)"""

SQL = {
    "page_plan": """SELECT event_type, total, p AS page, 'limit=100&offset=' || p AS query
        FROM (SELECT event_type, count(*) AS total FROM events GROUP BY event_type),
             LATERAL (SELECT unnest(range(CAST(ceil(total / 100.0) AS BIGINT))) AS p)""",
    "page_gaps": """WITH tops AS (SELECT max(event_id // 100) AS top FROM events),
        landed AS (SELECT DISTINCT user_id % 3 AS k, event_id // 100 AS p FROM events WHERE (event_id // 100 + user_id % 3) % 7 <> 3),
        ends AS (SELECT k, CASE k WHEN 0 THEN top WHEN 1 THEN greatest(top - 2, 0) ELSE top + 4 END AS last FROM tops, range(3) r(k)),
        lost AS (SELECT k, p FROM (SELECT k, unnest(range(0, last + 1)) AS p FROM ends) ANTI JOIN landed USING (k, p)),
        islands AS (SELECT k, p, p - row_number() OVER (PARTITION BY k ORDER BY p) AS island FROM lost)
        SELECT 's' || k AS source, 'missing' AS kind, min(p) AS first_page, max(p) AS last_page FROM islands GROUP BY k, island
        UNION ALL SELECT 's' || k, 'doubled', p, p FROM landed WHERE p % 5 = 0
        UNION ALL SELECT 's' || k, 'surplus', p, p FROM landed JOIN ends USING (k) WHERE p > last""",
    "page_plan_log": Q.with_views("change_log", """SELECT source, total, p + 1 AS page, 'limit=100&page=' || (p + 1) AS query
        FROM (SELECT source, count(*) FILTER (last_action = 'D') AS total FROM change_log GROUP BY source),
             LATERAL (SELECT unnest(range(CAST(ceil(total / 100.0) AS BIGINT))) AS p)"""),
    "page_scan": f"""SELECT (rn - 1) // 100 AS page_no, CAST((rn - 1) % 100 AS INT) AS pos, total AS total_len, item
        FROM (SELECT row_number() OVER (ORDER BY event_id) AS rn, count(*) OVER () AS total, {_EVENT_ITEM} AS item FROM events)""",
    "page_scan_ordered": f"""SELECT (rn - 1) // 100 AS page_no, CAST((rn - 1) % 100 AS INT) AS pos, total AS total_len, item
        FROM (SELECT row_number() OVER (ORDER BY event_type, event_id) AS rn, count(*) OVER () AS total, {_EVENT_ITEM} AS item FROM events)""",
    "progress": """SELECT run, page, size, total, done, ((done * 20000 + total) // (2 * total)) / 100.0 AS percent
        FROM (SELECT *, CAST(sum(size) OVER (PARTITION BY run ORDER BY page) AS BIGINT) AS done,
                     CAST(sum(size) OVER (PARTITION BY run) AS BIGINT) AS total
              FROM (SELECT 'src' || (user_id % 5) AS run, event_id // 100 AS page, count(*) AS size FROM events GROUP BY ALL))""",
    "source_names": f"""SELECT translate(translate(lower(trim(regexp_replace(name, '[\\s ]+', ' ', 'g'))), '{_DROP}', ''), '{_FOLD}', '{_FOLD_TO}') AS std_name,
               lower(coalesce(data_type, 'synthese_with_cd_nomenclature')) AS data_type, n
        FROM (SELECT '  Réseau -  ' || source || ' (Île ' || lang || ') ~É#1? ' AS name,
                     CASE WHEN lang = 'fr' THEN 'Synthese_With_LABEL' END AS data_type,
                     CASE WHEN lang = 'de' THEN false WHEN lang = 'es' THEN true END AS enable, count(*) AS n
              FROM documents GROUP BY source, lang) WHERE coalesce(enable, true)""",
    "metadata_split": f"""WITH {_ITEMS}, {_DOCS} SELECT level, uuid, item FROM
        (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY id_data) AS rn FROM docs) WHERE rn = 1""",
    "metadata_split_items": f"""WITH {_ITEMS} SELECT id_data, CAST(json_object('ca_uuid', ca, 'id_perm_sinp', uuid,
        'id_synthese', id_data, 'jdd_uuid', jdd, 'prix', 12.5) AS VARCHAR) AS item FROM items""",
    "upsert_metadata": f"""WITH {_ITEMS}, {_DOCS},
        owner AS (SELECT uuid, arg_min(source, import_id) AS source FROM docs GROUP BY uuid),
        firsts AS (SELECT d.*, row_number() OVER (PARTITION BY d.uuid ORDER BY d.import_id DESC, d.id_data) AS rn
                   FROM docs d JOIN owner USING (uuid, source))
        SELECT source, uuid, level, item, import_id FROM firsts WHERE rn = 1""",
    "metadata_backfill": f"""WITH {_ITEMS}, {_DOCS},
        known AS (SELECT {_U("'a' || n_nationkey")} AS uuid FROM nation WHERE n_regionkey < 2)
        SELECT 'old' AS source, uuid, 'acquisition framework' AS level, '{{}}' AS item, 0 AS import_id FROM known
        UNION ALL SELECT source, uuid, level, item, import_id FROM (
            SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY o_orderdate, id_data) AS rn FROM docs) d
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM known k WHERE k.uuid = d.uuid)""",
    "item_rewrite": """SELECT event_id, CAST(CASE event_type
            WHEN 'view' THEN json_object('ca_uuid', 'a' || user_id, 'id', event_id, 'jdd_uuid', 'd' || user_id, 'props', CAST(props AS JSON))
            WHEN 'click' THEN json_object('ca_data', json_object('uuid', 'a' || user_id), 'id', event_id, 'props', CAST(props AS JSON))
            WHEN 'signup' THEN json_object('ca_uuid', 'kept', 'id', event_id, 'jdd_uuid', 'd' || user_id, 'props', CAST(props AS JSON))
            ELSE json_object('id', event_id, 'props', CAST(props AS JSON)) END AS VARCHAR) AS item
        FROM (SELECT * REPLACE (replace(props, ' ', '') AS props) FROM events)""",
    "upsert_data": f"""WITH {_raw("o_orderkey")}, {_MERGED} SELECT source, type, id_data, uuid, item, import_id FROM merged""",
    "upsert_uuid_conflict": f"""WITH {_raw("(o_orderkey // 3)")},
        k1 AS (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY import_id, ts, id_data, pos) AS rn FROM b1),
        s1 AS (SELECT * FROM k1 WHERE rn = 1),
        known AS (SELECT b2.* FROM b2 WHERE EXISTS (SELECT 1 FROM s1 WHERE s1.id_data = b2.id_data)),
        fresh AS (SELECT b2.*, EXISTS (SELECT 1 FROM s1 WHERE s1.uuid = b2.uuid) AS held,
                         first_value(id_data) OVER (PARTITION BY uuid ORDER BY import_id, ts, id_data, pos) AS winner
                  FROM b2 WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.id_data = b2.id_data)),
        writes AS (SELECT source, id_data, uuid, item, import_id, pos FROM s1
                   UNION ALL SELECT source, id_data, uuid, item, import_id, pos FROM known
                   UNION ALL SELECT source, id_data, uuid, item, import_id, pos FROM fresh WHERE NOT held AND winner = id_data)
        SELECT 'stored' AS outcome, source, id_data, uuid, item, import_id FROM (
            SELECT *, row_number() OVER (PARTITION BY id_data ORDER BY import_id DESC, pos DESC) AS rn FROM writes) WHERE rn = 1
        UNION ALL SELECT 'rejected', source, id_data, uuid, item, import_id FROM k1 WHERE rn > 1
        UNION ALL SELECT 'rejected', source, id_data, uuid, item, import_id FROM fresh WHERE held OR winner <> id_data""",
    "delete_by_log": Q.with_views("change_log", """SELECT CASE WHEN gone THEN 'deleted' ELSE 'kept' END AS outcome, source, id_data, item
        FROM (SELECT 's' || (o_orderkey % 2) AS source, o_orderkey AS id_data,
                     '{"id_synthese":' || o_orderkey || ',"price":' || CAST(floor(o_totalprice) AS BIGINT) || '}' AS item,
                     EXISTS (SELECT 1 FROM change_log c WHERE c.last_action = 'D' AND c.id_data = o_orderkey
                             AND c.source = 's' || (o_orderkey % 2)) AS gone FROM orders)"""),
    "incremental_run": Q.with_views("change_log", """SELECT source, id_data, uuid, item, import_id FROM merged m
        WHERE NOT EXISTS (SELECT 1 FROM change_log c WHERE c.last_action = 'D' AND c.id_data = m.id_data AND c.source = m.source)""",
        f"{_raw('o_orderkey')}, {_MERGED}"),
    "quarantine_casts": """SELECT event_id AS id_data, CASE
            WHEN event_type = 'signup' AND k % 7 = 0 THEN 'invalid uuid: no-uuid'
            WHEN event_type = 'error' THEN 'invalid int for nombre_min: 12a'
            WHEN event_type = 'click' THEN 'invalid int for altitude_min: 1.5'
            WHEN event_type = 'purchase' THEN 'invalid date for date_debut: 2024-13-45'
            WHEN event_type = 'view' AND k > 50 THEN 'unsupported geometry: LINESTRING(1 2,3 4)' END AS error
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "stream_upsert": f"""SELECT 's0' AS source, '{S.TYPE_WITH_CODES}' AS type, user_id AS id_data, {_U("'u' || user_id")} AS uuid,
            '{{"id_synthese":' || user_id || ',"id_perm_sinp":"' || {_U("'u' || user_id")} || '","event":' || event_id || '}}' AS item,
            (event_id - lo) // greatest(1, (hi - lo + 2) // 3) + 1 AS import_id
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn,
                     min(event_id) OVER () AS lo, max(event_id) OVER () + 1 AS hi FROM events) WHERE rn = 1""",
}
