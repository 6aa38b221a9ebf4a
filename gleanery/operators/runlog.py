"""Import history, error log, watermarks and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.functions.text import simplify_source
from gleanery.operators.joins import join_lookup
from gleanery.operators.keys import assign_ids


def open_runs(log: DataFrame, sources: DataFrame, now: Column, xfer_type: str, filters: Column | None = None) -> DataFrame:
    """First log event of one new run per source: new ids after the largest one in use.

    `sources` comes from `enabled_sources`. The events are appended to the log and read
    back through `current_runs`.
    """
    numbered = assign_ids(sources.select(F.col("std_name").alias("source")).distinct(), F.col("source"), "id", log.select("id"))
    return numbered.select(
        "id", "source", F.lit(S.CONTROLER_DATA).alias("controler"), F.lit(xfer_type).alias("xfer_type"),
        F.lit(S.STATUS_INIT).alias("xfer_status"), now.alias("xfer_start_ts"),
        (F.lit("{}") if filters is None else filters).alias("xfer_filters"), F.lit(0).alias("seq"),
    )


def close_runs(opened: DataFrame, counters: DataFrame, failed: DataFrame, now: Column) -> DataFrame:
    """Last log event of each run: its counters, and success unless its source failed.

    A run without any arrival is a success as well. `failed` has `source, comment`; the
    failure of one source leaves the runs of the others alone.
    """
    counts = counters.withColumnRenamed("import_id", "id")
    names = [c for c in counts.columns if c not in ("id", "source")]
    rows = opened.select("id", "source", "controler").join(counts.drop("source"), "id", "left").join(failed, "source", "left")
    bad = F.col("comment").isNotNull()
    return rows.select(
        "id", "source", "controler",
        F.when(bad, F.lit(S.STATUS_FAILED)).otherwise(F.lit(S.STATUS_SUCCESS)).alias("xfer_status"),
        now.alias("xfer_end_ts"), *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names], "comment", F.lit(9).alias("seq"),
    )


def current_runs(events: DataFrame, seq: str = "seq") -> DataFrame:
    """State of each run from its log events: the last value set, column by column."""
    columns = [c for c in events.columns if c not in ("id", seq)]
    return events.groupBy("id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns]
    )


def watermarks(import_log: DataFrame) -> DataFrame:
    """Start of the last successful run per source and controler."""
    return (
        import_log.where(F.col("xfer_status") == S.STATUS_SUCCESS)
        .groupBy("source", "controler")
        .agg(F.max("xfer_start_ts").alias("since"))
    )


def changed_since(rows: DataFrame, marks: DataFrame, moment: str) -> DataFrame:
    """Rows changed at or after the watermark of their source; all rows without one."""
    joined = join_lookup(rows, marks.select("source", "since"), ["source"], "left")
    return joined.where(F.col("since").isNull() | (F.col(moment) >= F.col("since"))).drop("since")


def deleted_since(log: DataFrame, marks: DataFrame, moment: str = "meta_last_action_date") -> DataFrame:
    """Deletions reported at or after the watermark of their source."""
    deletions = log.where(F.col("last_action") == "D")
    joined = join_lookup(deletions, marks.select("source", "since"), ["source"], "inner")
    return joined.where(F.col(moment) >= F.col("since")).drop("since")


def enabled_sources(sources: DataFrame) -> DataFrame:
    """Sources in use with their stored name and data type (defaults filled in)."""
    return (
        sources.where(F.coalesce(F.col("enable"), F.lit(True)))
        .withColumn("std_name", simplify_source(F.col("name")))
        .withColumn("data_type", F.lower(F.coalesce(F.col("data_type"), F.lit(S.DEFAULT_DATA_TYPE))))
    )


def new_errors(error_log: DataFrame, failures: DataFrame) -> DataFrame:
    """Failures the log lacks: the first one per source, controler, uuid and import.

    `failures` has the columns of the log and `seq`. A null uuid cannot identify an
    earlier entry, so such failures are all kept.
    """
    key = ["source", "controler", "uuid", "import_id"]
    named = failures.where("uuid IS NOT NULL")
    first = (
        named.groupBy(*key)
        .agg(F.min_by(F.struct("last_ts", "item", "error"), F.col("seq")).alias("_row"))
        .select(*key, "_row.*")
        .join(error_log.select(*key), key, "left_anti")
    )
    return first.select(*error_log.columns).unionByName(failures.where("uuid IS NULL").select(*error_log.columns))


def append_errors(error_log: DataFrame, failures: DataFrame) -> DataFrame:
    """The log with the failures it lacks."""
    return error_log.unionByName(new_errors(error_log, failures))


def run_counters(outcomes: DataFrame) -> DataFrame:
    """Counters per run from outcome rows (`source, import_id, outcome, n`)."""
    names = [
        "api_count_items",
        "api_count_errors",
        "data_count_upserts",
        "data_count_delete",
        "data_count_errors",
        "metadata_count_upserts",
        "metadata_count_errors",
    ]
    return outcomes.groupBy("source", "import_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("outcome") == n, F.col("n"))), F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def import_report(log: DataFrame, source: str | None = None, xfer_type: str | None = None) -> DataFrame:
    """Import history, newest run first."""
    rows = log.select(*[c for c in S.IMPORT_LOG_COLUMNS if c in log.columns])
    if source is not None:
        rows = rows.where(F.col("source") == source)
    if xfer_type is not None:
        rows = rows.where(F.col("xfer_type") == xfer_type)
    return rows.orderBy(F.desc("id"))


def error_report(errors: DataFrame, **equal: object) -> DataFrame:
    """Error list, filtered by any of source, uuid, controler and import_id."""
    rows = errors.select(*[c for c in S.ERROR_LOG_COLUMNS if c in errors.columns])
    for name in ("source", "uuid", "controler", "import_id"):
        if equal.get(name) is not None:
            rows = rows.where(F.col(name) == equal[name])
    return rows


def purge_imports(
    import_log: DataFrame, error_log: DataFrame, purge: DataFrame, *raw_tables: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Delete runs from the log together with their errors: (runs, errors, refused).

    A run that stored rows still point to is refused and stays.
    """
    wanted = purge.select(F.col("id").alias("import_id")).distinct()
    refused = None
    for table in raw_tables:
        # One run may hold most rows; its id is needed once only.
        used = wanted.join(table.select("import_id").distinct(), "import_id", "left_semi")
        refused = used if refused is None else refused.unionByName(used)
    refused = wanted.limit(0) if refused is None else refused.distinct()
    gone = wanted.join(refused, "import_id", "left_anti")
    runs = import_log.join(gone.withColumnRenamed("import_id", "id"), "id", "left_anti")
    errors = error_log.join(gone, "import_id", "left_anti")
    return runs, errors, refused


def attach_import(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Set `import_id` from the newest run of the row's source; keep it if there is none."""
    newest = log.groupBy("source").agg(F.max("id").alias("_newest"))
    joined = join_lookup(rows, newest, ["source"], "left")
    current = F.col("import_id") if "import_id" in rows.columns else F.lit(None).cast("bigint")
    return joined.withColumn("import_id", F.coalesce("_newest", current)).drop("_newest")


def backfill_history(downloads: DataFrame, increments: DataFrame, data: DataFrame, comment: str) -> DataFrame:
    """Import log rebuilt from the two older logs and the stored rows.

    Both logs are reduced to one row per key before the rows are counted, and the
    rows to one count per key before the join.
    """
    key = ["source", "controler"]
    history = (
        downloads.select(*key, "xfer_start_ts")
        .unionByName(increments.select(*key, "xfer_start_ts"))
        .groupBy(*key)
        .agg(F.max("xfer_start_ts").alias("xfer_start_ts"))
    )
    stored = data.groupBy(*key).agg(F.count(F.lit(1)).alias("data_count_upserts"))
    return history.join(stored, key).select(
        *key,
        F.lit("full").alias("xfer_type"),
        F.lit(S.STATUS_SUCCESS).alias("xfer_status"),
        "xfer_start_ts",
        "data_count_upserts",
        F.lit(comment).alias("comment"),
    )


def count_by_source(data: DataFrame) -> DataFrame:
    """Stored rows with a uuid, per source."""
    return data.groupBy("source").agg(F.count("uuid").alias("n"))
