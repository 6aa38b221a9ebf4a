"""Whole runs over a store as queries: what a stream rejects, the log of a cycle, faulty documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.catalogue import sql as Q
from gleanery.catalogue.views import Domain
from gleanery.functions.text import uuid_of
from gleanery.operators.lineage import shared_folder
from gleanery.operators.runlog import watermarks
from gleanery.operators.split import validate_documents
from gleanery.plans.incremental import run_incremental, stored_runs
from gleanery.sources.snapshot import Store
from gleanery.streaming.polling import poll_into_store

_PAGE = 100


def _event_items(spark: SparkSession, folder: str) -> DataFrame:
    """Events as items: the uuid is the user's, and every seventh has a count that is no number."""
    e = Domain(spark, folder).table("events")
    text = lambda c: F.col(c).cast("string")
    count = F.when(F.col("event_id") % 7 == 0, F.lit(',"nombre_min":"12a"')).otherwise(F.lit(""))
    item = F.concat(
        F.lit('{"id_synthese":'), text("event_id"), F.lit(',"id_perm_sinp":"'),
        uuid_of(F.concat(F.lit("u"), text("user_id"))), F.lit('"'), count, F.lit("}"),
    )
    return e.select("event_id", "user_id", F.floor(F.col("event_id") / _PAGE).alias("page_no"), item.alias("item"))


def _paged(rows: DataFrame, *by: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("event_id", "item")))
    return rows.groupBy(*by, "page_no").agg(F.transform(ordered, lambda x: x["item"]).alias("items"))


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings streamed into one store: each event is stored, or its uuid is in the error log."""
    rows = _event_items(spark, folder).withColumn("part", F.col("event_id") % 2)
    pages = _paged(rows, "part")
    line = F.concat(F.lit('{"page_no":'), F.col("page_no").cast("string"), F.lit(',"items":['), F.array_join("items", ","), F.lit("]}"))
    place = shared_folder(spark)
    store = Store(spark, f"{place}/store")
    for part in range(2):
        # Each landing has a checkpoint of its own.
        pages.where(F.col("part") == part).select(line).write.text(f"{place}/landing{part}/source=s0/import_id={part + 1}")
        poll_into_store(spark, f"{place}/landing{part}", f"{place}/progress{part}", store).awaitTermination()
    stored = store.read_ranged("data_json", S.DATA_JSON)
    errors = store.read_added("error_log", S.ERROR_LOG)
    return stored.select(F.lit("stored").alias("outcome"), "id_data", "uuid", "import_id").unionByName(
        errors.select(F.lit("rejected").alias("outcome"), F.lit(None).cast("bigint").alias("id_data"), "uuid", "import_id")
    )


def run_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of three sources: a success, one with an unreadable page, and one without pages."""
    rows = _event_items(spark, folder).withColumn("source", F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")))
    pages = _paged(rows, "source").withColumn("import_id", F.lit(0).cast("bigint"))
    sources = spark.createDataFrame([("S0", True, None), ("s1", None, None), ("s2", False, None)], "name string, enable boolean, data_type string")
    unreadable = pages.where("source = 's1' AND page_no = 0").withColumn("items", F.lit(None).cast("array<string>"))
    store = Store(spark, f"{shared_folder(spark)}/store")
    even, odd = pages.where("page_no % 2 = 0"), pages.where("page_no % 2 = 1")
    for day, delivered in ((1, even), (2, odd.unionByName(unreadable)), (3, pages.limit(0))):
        # Every delivery numbers its pages without gaps.
        delivered = delivered.withColumn("page_no", F.floor(F.col("page_no") / 2))
        run_incremental(store, f"run {day}", sources, delivered, datetime(2024, 1, day), loader=None)
    runs = stored_runs(store)
    since = watermarks(runs).select("source", "since")
    return runs.join(since, "source").select(
        "source", F.dayofmonth("xfer_start_ts").alias("day"), "xfer_type", "xfer_status",
        "api_count_items", "data_count_upserts", "data_count_errors", "comment", F.dayofmonth("since").alias("since_day"),
    )


def late_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over one landing folder; what lands second has changed long before the first run."""
    rows = _event_items(spark, folder).withColumn("source", F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")))
    dated = F.concat(F.expr("substr(item, 1, length(item) - 1)"), F.lit(',"derniere_action":"2023-06-01"}'))
    rows = rows.withColumn("item", dated).withColumn("item", F.regexp_replace("item", '"id_perm_sinp":"[^"]*"', '"id_perm_sinp":null'))
    pages = _paged(rows, "source").withColumn("import_id", F.col("page_no") % 2).withColumn("page_no", F.floor(F.col("page_no") / 2))
    line = F.concat(F.lit('{"page_no":'), F.col("page_no").cast("string"), F.lit(',"items":['), F.array_join("items", ","), F.lit("]}"))
    sources = spark.createDataFrame([("s0", True, None), ("s1", True, None), ("s2", True, None)], "name string, enable boolean, data_type string")
    place = shared_folder(spark)
    store = Store(spark, f"{place}/store")
    for wave in range(2):
        landing = pages.where(F.col("import_id") == wave).select("source", "import_id", line.alias("line"))
        landing.write.mode("append").partitionBy("source", "import_id").text(f"{place}/landing")
        run_incremental(store, f"wave {wave}", sources, f"{place}/landing", datetime(2024, 1, wave + 1), loader=None)
    runs = stored_runs(store).select(F.col("id").alias("import_id"), F.dayofmonth("xfer_start_ts").alias("day"), "api_count_items")
    stored = store.read_ranged("data_json", S.DATA_JSON).select("source", "id_data", "import_id")
    return stored.join(F.broadcast(runs), "import_id").select("source", "id_data", "day", "api_count_items")


def stream_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """Two polls: pages, then the deletion of every fourth event with further pages, older and newer than it."""
    e = Domain(spark, folder).table("events").select("event_id", F.floor(F.col("event_id") / _PAGE).alias("page_no"))
    anew = (F.col("page_no") % 2 == 1) & (F.col("event_id") % 12 == 0)
    changed = F.when(anew, F.lit("2024-03-01")).otherwise(F.lit("2024-01-01"))
    item = F.concat(F.lit('{"id_synthese":'), F.col("event_id").cast("string"), F.lit(',"derniere_action":"'), changed, F.lit('"}'))
    pages = _paged(e.withColumn("item", item))
    line = F.concat(F.lit('{"page_no":'), F.col("page_no").cast("string"), F.lit(',"items":['), F.array_join("items", ","), F.lit("]}"))
    deleted = e.where("event_id % 4 = 0").select("event_id")
    log = F.to_json(F.struct(F.col("event_id").alias("id_data"), F.lit("D").alias("last_action"), F.lit("2024-02-01 00:00:00").alias("meta_last_action_date")))
    place = shared_folder(spark)
    store = Store(spark, f"{place}/store")
    for poll in range(2):
        pages.where(F.col("page_no") % 2 == poll).select(line).write.text(f"{place}/landing/source=s0/import_id={poll + 1}")
        rows = deleted if poll else deleted.limit(0)
        rows.select(log).write.text(f"{place}/deleted/source=s0/import_id={poll + 1}")
        poll_into_store(spark, f"{place}/landing", f"{place}/progress", store, deletions=f"{place}/deleted").awaitTermination()
    none = F.lit(0).cast("bigint")
    stored = store.read_ranged("data_json", S.DATA_JSON).select(F.lit("stored").alias("outcome"), F.col("id_data").alias("n"), none.alias("m"))
    late = store.read_added("error_log", S.ERROR_LOG).select(F.lit("late").alias("outcome"), F.get_json_object("item", "$.id_synthese").cast("bigint").alias("n"), none.alias("m"))
    runs = stored_runs(store).select(F.concat(F.lit("run "), "xfer_status").alias("outcome"), F.col("data_count_upserts").alias("n"), F.col("data_count_delete").alias("m"))
    return stored.unionByName(late).unionByName(runs)


def quarantine_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of frameworks (orders) and datasets (customers), every few with a bad date or boolean."""
    d = Domain(spark, folder)
    text = lambda c: F.col(c).cast("string")
    date = F.when(F.col("o_orderkey") % 5 == 0, "nodate").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    frameworks = d.table("orders").select(
        F.lit(S.LEVEL_FRAMEWORK).alias("level"),
        uuid_of(F.concat(F.lit("a"), text("o_orderkey"))).alias("uuid"),
        F.to_json(F.struct(F.lit("2020-01-01").alias("start_date"), date.alias("end_date"), F.lit("maybe").alias("marine_domain"))).alias("item"),
    )
    sea = F.when(F.col("c_custkey") % 4 == 0, "maybe").when(F.col("c_custkey") % 4 == 1, "true").when(F.col("c_custkey") % 4 == 2, "false")
    datasets = d.table("customer").select(
        F.lit(S.LEVEL_DATASET).alias("level"),
        uuid_of(F.concat(F.lit("d"), text("c_custkey"))).alias("uuid"),
        F.to_json(F.struct(sea.alias("marine_domain"), F.lit("true").alias("terrestrial_domain"), F.lit("nodate").alias("start_date"))).alias("item"),
    )
    good, bad = validate_documents(frameworks.unionByName(datasets))
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad).select("level", "uuid", "error")


QUERIES = {
    "stream_rejects": stream_rejects,
    "run_cycle": run_cycle,
    "late_pages": late_pages,
    "stream_deletes": stream_deletes,
    "quarantine_metadata": quarantine_metadata,
}

_U = Q.uuid_sql

SQL = {
    "stream_rejects": f"""WITH e AS (SELECT event_id, event_id % 2 AS part, {_U("'u' || user_id")} AS uuid, event_id % 7 = 0 AS bad FROM events),
        first AS (SELECT uuid, min_by(event_id, (part, event_id)) AS event_id FROM e WHERE NOT bad GROUP BY uuid)
        SELECT 'stored' AS outcome, event_id AS id_data, uuid, part + 1 AS import_id FROM e WHERE event_id IN (SELECT event_id FROM first)
        UNION ALL SELECT DISTINCT 'rejected', CAST(NULL AS BIGINT), uuid, part + 1 FROM e WHERE event_id NOT IN (SELECT event_id FROM first)""",
    "run_cycle": f"""WITH e AS (SELECT 's' || (user_id % 3) AS source, event_id, user_id, event_id // {_PAGE} AS page, event_id % 7 = 0 AS bad FROM events),
        done AS (SELECT *, CASE WHEN page % 2 = 0 THEN 1 ELSE 2 END AS day FROM e WHERE source = 's0' OR source = 's1' AND page % 2 = 0),
        first AS (SELECT min_by(event_id, (day, page, event_id)) AS event_id FROM done WHERE NOT bad GROUP BY user_id),
        counted AS (SELECT source, day, count(*) AS items, count(*) FILTER (event_id IN (SELECT event_id FROM first)) AS stored FROM done GROUP BY ALL),
        runs AS (SELECT source, day, CASE WHEN source = 's1' AND day = 2 THEN 'failed' ELSE 'success' END AS xfer_status
            FROM (VALUES ('s0'), ('s1')) s(source), (VALUES (1), (2), (3)) d(day))
        SELECT source, CAST(day AS INTEGER) AS day, 'update' AS xfer_type, xfer_status, coalesce(items, 0) AS api_count_items,
            coalesce(stored, 0) AS data_count_upserts, coalesce(items - stored, 0) AS data_count_errors,
            CASE WHEN xfer_status = 'failed' THEN 'page 0 has no items' END AS comment, 3 AS since_day
        FROM runs LEFT JOIN counted USING (source, day)""",
    "late_pages": f"""WITH e AS (SELECT 's' || (user_id % 3) AS source, event_id, CAST(1 + event_id // {_PAGE} % 2 AS INTEGER) AS day, event_id % 7 = 0 AS bad FROM events),
        counted AS (SELECT source, day, count(*) AS api_count_items FROM e GROUP BY ALL)
        SELECT source, event_id AS id_data, day, api_count_items FROM e JOIN counted USING (source, day) WHERE NOT bad""",
    "stream_deletes": f"""WITH e AS (SELECT event_id, event_id // {_PAGE} % 2 = 1 AS odd, event_id % 4 = 0 AS gone FROM events),
        told AS (SELECT event_id, odd, gone, odd AND event_id % 12 = 0 AS anew FROM e)
        SELECT 'stored' AS outcome, event_id AS n, CAST(0 AS BIGINT) AS m FROM told WHERE NOT gone OR anew
        UNION ALL SELECT 'late', event_id, 0 FROM told WHERE gone AND odd AND NOT anew
        UNION ALL SELECT 'run success', count(*) FILTER (NOT odd), 0 FROM told
        UNION ALL SELECT 'run success', count(*) FILTER (odd AND (NOT gone OR anew)), count(*) FILTER (gone AND NOT odd) FROM told""",
    "quarantine_metadata": f"""SELECT '{S.LEVEL_FRAMEWORK}' AS level, {_U("'a' || o_orderkey")} AS uuid,
            CASE WHEN o_orderkey % 5 = 0 THEN 'invalid date for end_date: nodate' END AS error FROM orders
        UNION ALL SELECT '{S.LEVEL_DATASET}', {_U("'d' || c_custkey")},
            CASE WHEN c_custkey % 4 = 0 THEN 'invalid bool for marine_domain: maybe' END FROM customer""",
}
