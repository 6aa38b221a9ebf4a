"""Run log, error log and watermark queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.catalogue import sql as Q
from gleanery.catalogue.imports import empty, raw_rows
from gleanery.catalogue.views import Domain
from gleanery.functions.text import stamp_text, uuid_of
from gleanery.operators import runlog as R

_CUT = "TIMESTAMP_NTZ '2024-01-10 00:00:00'"


def _numbered(prefix: str, column: str, n: int):
    return F.concat(F.lit(prefix), (F.col(column) % n).cast("string"))


def _failures(spark: SparkSession, folder: str) -> DataFrame:
    e = Domain(spark, folder).table("events").where("event_type = 'error'")
    return e.select(
        _numbered("s", "user_id", 2).alias("source"),
        uuid_of(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("uuid"),
        F.lit("data").alias("controler"),
        F.col("ts").alias("last_ts"),
        F.col("props").alias("item"),
        F.concat(F.lit("failed event "), F.col("event_id").cast("string")).alias("error"),
        F.when(F.expr(f"ts < {_CUT}"), 1).otherwise(2).cast("bigint").alias("import_id"),
        F.struct("ts", "event_id").alias("seq"),
    )


def error_log(spark: SparkSession, folder: str) -> DataFrame:
    failures = _failures(spark, folder)
    log = R.append_errors(empty(spark, S.ERROR_LOG), failures.where("import_id = 1"))
    log = R.append_errors(log, failures)
    return log.withColumn("last_ts", stamp_text(F.col("last_ts")))


def watermarks(spark: SparkSession, folder: str) -> DataFrame:
    marks = R.watermarks(Domain(spark, folder).run_log())
    return marks.withColumn("since", stamp_text(F.col("since")))


def _moved(spark: SparkSession, folder: str) -> DataFrame:
    """Events five days later; every eleventh user belongs to a source that never ran."""
    e = Domain(spark, folder).table("events")
    return e.select(
        "event_id",
        F.when(F.col("user_id") % 11 == 0, F.lit("new")).otherwise(_numbered("src", "user_id", 5)).alias("source"),
        (F.col("ts") + F.expr("INTERVAL 5 DAYS")).alias("moment"),
        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("last_action"),
    )


def incremental_since(spark: SparkSession, folder: str) -> DataFrame:
    marks = R.watermarks(Domain(spark, folder).run_log())
    return R.changed_since(_moved(spark, folder), marks, "moment").select("event_id", "source")


def deleted_since(spark: SparkSession, folder: str) -> DataFrame:
    marks = R.watermarks(Domain(spark, folder).run_log())
    return R.deleted_since(_moved(spark, folder), marks, "moment").select("event_id", "source")


def run_status(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a user as log entries of one run: each sets some columns only."""
    e = Domain(spark, folder).table("events")
    kind = F.col("event_type")
    log = e.select(
        F.col("user_id").alias("id"),
        _numbered("src", "user_id", 5).alias("source"),
        F.when(kind == "purchase", S.STATUS_SUCCESS).when(kind == "error", S.STATUS_FAILED).otherwise(S.STATUS_IMPORT).alias("xfer_status"),
        F.when(kind == "signup", stamp_text(F.col("ts"))).alias("xfer_start_ts"),
        F.when(kind == "error", F.col("props")).alias("comment"),
        F.col("event_id").alias("seq"),
    )
    return R.current_runs(log)


def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    outcomes = Domain(spark, folder).table("orders").select(
        _numbered("s", "o_orderkey", 2).alias("source"),
        F.year("o_orderdate").cast("bigint").alias("import_id"),
        F.when(status == "F", "data_count_upserts").when(status == "O", "data_count_errors").otherwise("metadata_count_upserts").alias("outcome"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return R.run_counters(outcomes)


def import_report(spark: SparkSession, folder: str) -> DataFrame:
    report = R.import_report(Domain(spark, folder).run_log(), source="src1", xfer_type="update")
    return report.withColumn("xfer_start_ts", stamp_text(F.col("xfer_start_ts")))


def error_report(spark: SparkSession, folder: str) -> DataFrame:
    report = R.error_report(_failures(spark, folder), source="s1", import_id=2)
    return report.withColumn("last_ts", stamp_text(F.col("last_ts")))


def purge_import(spark: SparkSession, folder: str) -> DataFrame:
    """Purge the failed runs; those that every third order points to are refused."""
    d = Domain(spark, folder)
    log = d.run_log().select("id", "source", "xfer_status")
    errors = d.table("events").select(F.col("event_id").alias("import_id"), F.col("props").alias("item"))
    raw = d.table("orders").select((F.col("o_orderkey") * 3).alias("import_id"))
    runs, left, refused = R.purge_imports(log, errors, log.where(F.col("xfer_status") == S.STATUS_FAILED), raw)
    out = runs.select(F.lit("run").alias("kind"), "id")
    out = out.unionByName(left.select(F.lit("error").alias("kind"), F.col("import_id").alias("id")))
    return out.unionByName(refused.select(F.lit("refused").alias("kind"), F.col("import_id").alias("id")))


def history_backfill(spark: SparkSession, folder: str) -> DataFrame:
    e = Domain(spark, folder).table("events").select(
        "event_type", _numbered("s", "user_id", 2).alias("source"), F.lit("data").alias("controler"),
        F.col("ts").alias("xfer_start_ts"),
    )
    data = raw_rows(spark, folder)
    out = R.backfill_history(
        e.where("event_type = 'signup'"), e.where("event_type = 'purchase'"), data, "generated on upgrade"
    )
    return out.withColumn("xfer_start_ts", stamp_text(F.col("xfer_start_ts")))


def attach_import(spark: SparkSession, folder: str) -> DataFrame:
    rows = Domain(spark, folder).table("orders").select(
        F.col("o_orderkey").alias("id_data"), _numbered("src", "o_orderkey", 6).alias("source")
    )
    return R.attach_import(rows, Domain(spark, folder).run_log())


def count_by_source(spark: SparkSession, folder: str) -> DataFrame:
    """Three sources put together: orders, customers and order lines."""
    d = Domain(spark, folder)

    def rows(table: str, key: str, source: str) -> DataFrame:
        return d.table(table).select(
            F.lit(source).alias("source"), F.when(F.col(key) % 6 != 0, F.col(key).cast("string")).alias("uuid")
        )

    every = rows("orders", "o_orderkey", "orders").unionByName(rows("customer", "c_custkey", "customers"))
    return R.count_by_source(every.unionByName(rows("lineitem", "l_orderkey", "lines")))


QUERIES = {
    "error_log": error_log,
    "watermarks": watermarks,
    "incremental_since": incremental_since,
    "deleted_since": deleted_since,
    "run_status": run_status,
    "run_counters": run_counters,
    "import_report": import_report,
    "error_report": error_report,
    "purge_import": purge_import,
    "history_backfill": history_backfill,
    "attach_import": attach_import,
    "count_by_source": count_by_source,
}

_FAIL = f"""fail AS (SELECT 's' || (user_id % 2) AS source, {Q.uuid_sql("'u' || user_id")} AS uuid, 'data' AS controler,
    {Q.stamp_sql("ts")} AS last_ts, props AS item, 'failed event ' || event_id AS error,
    CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 1 ELSE 2 END AS import_id, ts, event_id
    FROM events WHERE event_type = 'error')"""
_MARKS = "marks AS (SELECT source, max(xfer_start_ts) AS since FROM run_log WHERE xfer_status = 'success' GROUP BY source)"
_MOVED = """moved AS (SELECT event_id, CASE WHEN user_id % 11 = 0 THEN 'new' ELSE 'src' || (user_id % 5) END AS source,
    ts + INTERVAL 5 DAY AS moment, event_type FROM events)"""

SQL = {
    "error_log": f"""WITH {_FAIL} SELECT source, uuid, controler, last_ts, item, error, import_id FROM (
        SELECT *, row_number() OVER (PARTITION BY source, controler, uuid, import_id ORDER BY ts, event_id) AS rn FROM fail) WHERE rn = 1""",
    "watermarks": Q.with_views("run_log", f"""SELECT source, controler, {Q.stamp_sql("max(xfer_start_ts)")} AS since
        FROM run_log WHERE xfer_status = 'success' GROUP BY source, controler"""),
    "incremental_since": Q.with_views("run_log", """SELECT event_id, m.source FROM moved m LEFT JOIN marks k ON m.source = k.source
        WHERE k.since IS NULL OR m.moment >= k.since""", f"{_MARKS}, {_MOVED}"),
    "deleted_since": Q.with_views("run_log", """SELECT event_id, m.source FROM moved m JOIN marks k ON m.source = k.source
        WHERE event_type = 'error' AND m.moment >= k.since""", f"{_MARKS}, {_MOVED}"),
    "run_status": f"""SELECT user_id AS id, 'src' || (user_id % 5) AS source,
            arg_max(CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'importing data' END, event_id) AS xfer_status,
            arg_max({Q.stamp_sql("ts")}, event_id) FILTER (event_type = 'signup') AS xfer_start_ts,
            arg_max(props, event_id) FILTER (event_type = 'error') AS comment
        FROM events GROUP BY user_id""",
    "run_counters": """SELECT 's' || (o_orderkey % 2) AS source, CAST(year(o_orderdate) AS BIGINT) AS import_id,
            CAST(0 AS BIGINT) AS api_count_items, CAST(0 AS BIGINT) AS api_count_errors,
            count(*) FILTER (o_orderstatus = 'F') AS data_count_upserts, CAST(0 AS BIGINT) AS data_count_delete,
            count(*) FILTER (o_orderstatus = 'O') AS data_count_errors,
            count(*) FILTER (o_orderstatus = 'P') AS metadata_count_upserts, CAST(0 AS BIGINT) AS metadata_count_errors
        FROM orders GROUP BY 1, 2""",
    "import_report": Q.with_views("run_log", f"""SELECT id, source, controler, xfer_type, xfer_status,
            {Q.stamp_sql("xfer_start_ts")} AS xfer_start_ts, api_count_items, xfer_filters
        FROM run_log WHERE source = 'src1' AND xfer_type = 'update' ORDER BY id DESC"""),
    "error_report": f"""WITH {_FAIL} SELECT source, uuid, controler, last_ts, item, error, import_id FROM fail
        WHERE source = 's1' AND import_id = 2""",
    "purge_import": """WITH raw AS (SELECT DISTINCT o_orderkey * 3 AS id FROM orders),
        refused AS (SELECT event_id AS id FROM events WHERE event_type = 'error' AND event_id IN (SELECT id FROM raw)),
        gone AS (SELECT event_id AS id FROM events WHERE event_type = 'error' AND event_id NOT IN (SELECT id FROM raw))
        SELECT 'run' AS kind, event_id AS id FROM events WHERE event_id NOT IN (SELECT id FROM gone)
        UNION ALL SELECT 'error', event_id FROM events WHERE event_id NOT IN (SELECT id FROM gone)
        UNION ALL SELECT 'refused', id FROM refused""",
    "history_backfill": f"""SELECT c.source, 'data' AS controler, 'full' AS xfer_type, 'success' AS xfer_status,
            {Q.stamp_sql("newest.started")} AS xfer_start_ts, c.data_count_upserts, 'generated on upgrade' AS comment
        FROM (SELECT 's' || (o_orderkey % 2) AS source, count(*) AS data_count_upserts FROM orders GROUP BY ALL) c
        JOIN (SELECT 's' || (user_id % 2) AS source, max(ts) AS started FROM events
              WHERE event_type IN ('signup', 'purchase') GROUP BY ALL) newest USING (source)""",
    "attach_import": Q.with_views("run_log", """SELECT o_orderkey AS id_data, 'src' || (o_orderkey % 6) AS source, l.id AS import_id
        FROM orders LEFT JOIN (SELECT source, max(id) AS id FROM run_log GROUP BY source) l ON l.source = 'src' || (o_orderkey % 6)"""),
    "count_by_source": """SELECT 'orders' AS source, count(*) FILTER (o_orderkey % 6 <> 0) AS n FROM orders
        UNION ALL SELECT 'customers', count(*) FILTER (c_custkey % 6 <> 0) FROM customer
        UNION ALL SELECT 'lines', count(*) FILTER (l_orderkey % 6 <> 0) FROM lineitem""",
}
