"""One incremental run: open, find new pages, import, delete, close, all in the stored log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.operators import runlog as R
from gleanery.operators.joins import join_lookup, small_side
from gleanery.operators.lineage import cut
from gleanery.operators.pages import page_gaps
from gleanery.plans.consolidate import LAYOUTS, Report, attempts, import_into_store, load_star
from gleanery.sources import ledger
from gleanery.sources.landing import arrivals
from gleanery.sources.snapshot import Conflict, Store

_EVENTS = LAYOUTS["import_log"]
#: Characters of a fault that the log keeps.
_COMMENT = 1000


def stored_runs(store: Store, version: int | None = None) -> DataFrame:
    """State of every run in the log of a store."""
    return R.current_runs(store.read_added("import_log", _EVENTS, version))


def run_events(opened: DataFrame, failed: DataFrame, deletes: bool, moment):
    """Makes the log events of opened runs from the counters of their sources."""
    steps = [(S.STATUS_IMPORT, 1)] + ([(S.STATUS_DELETE, 2)] if deletes else [])
    events = opened.withColumn("seq", F.lit(0).cast("bigint"))
    for status, seq in steps:
        step = opened.select("id", "source", "controler", F.lit(status).alias("xfer_status"), F.lit(seq).cast("bigint").alias("seq"))
        events = events.unionByName(step, allowMissingColumns=True)

    def closing(counters: DataFrame) -> DataFrame:
        last = R.close_runs(opened, counters, failed, moment).withColumn("seq", F.col("seq").cast("bigint"))
        every = events.unionByName(last, allowMissingColumns=True)
        return opened.sparkSession.createDataFrame([], _EVENTS).unionByName(every, allowMissingColumns=True)

    return closing


def _failing(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source, comment) of sources whose newest delivery cannot be imported whole.

    A page without items or a gap in the page numbers makes a delivery fail; pages that the
    store took in before count as landed.
    """
    now = landed.select("source", "delivery", "page_no", "total_filtered", "limit")
    newest = cut(landed.groupBy("source").agg(F.max("delivery").alias("delivery")))
    on = ["source", "delivery"]
    earlier = join_lookup(ledger.withColumnRenamed("import_id", "delivery"), newest, on, "inner").select(now.columns)
    current = join_lookup(now, newest, on, "inner").select(now.columns)
    missing = page_gaps(current.unionByName(earlier), on).where("kind = 'missing'")
    span = F.concat_ws("-", *[F.col(c).cast("string") for c in ("first_page", "last_page")])
    first = missing.groupBy("source").agg(F.min(F.struct("first_page", "last_page")).alias("_gap")).select("source", "_gap.*")
    gaps = first.select("source", F.format_string("pages %s have not landed", span).alias("comment"), F.lit(2).alias("_rank"))
    unreadable = join_lookup(landed.where("items IS NULL"), newest, on, "inner").groupBy("source").agg(F.min("page_no").alias("page_no"))
    blank = unreadable.select(
        "source", F.format_string("page %s has no items", F.col("page_no").cast("string")).alias("comment"), F.lit(1).alias("_rank")
    )
    return blank.unionByName(gaps).groupBy("source").agg(F.min_by("comment", "_rank").alias("comment"))


def run_incremental(
    store: Store,
    run_id: str,
    sources: DataFrame,
    pages: DataFrame | str,
    now: datetime,
    deletions: DataFrame | None = None,
    codes: DataFrame | None = None,
    areas: DataFrame | None = None,
    loader=load_star,
    changed_at: str | None = "derniere_action",
) -> Report | None:
    """Import what enabled sources have delivered and the store has not taken in.

    `sources` has `name, enable, data_type`; `pages` is a landing folder, of which new files alone
    are read, or comes from `landing.read_pages`; `deletions` is the delivered log (`source,
    id_data, last_action, meta_last_action_date`). Whether a page is new is known from the
    ledger of files, whatever the times of its items. Only for pages that name no file, items
    whose member `changed_at` lies before the watermark of their source are passed over; items
    without it are taken.

    A source fails if a page of its newest delivery could not be read (no items) or if one has
    not landed: nothing of it is imported, its watermark stays, its files stay unread, and the
    other sources go on. What an older delivery lacks is covered by a newer one, which asks for
    all since the last success; its pages come first. Every run of a source gets its events:
    opened, importing, deleting, and closed with counters.

    If the import or the loader raises, nothing is committed; the sources are then run one by one,
    each with a commit `<run_id>/<source>`, and those that raise again are logged as failed. The
    result is None in that case, as for a run that is there already.
    """
    names = [r["source"] for r in R.enabled_sources(sources).select(F.col("std_name").alias("source")).distinct().collect()]

    def of(own: DataFrame, name: str) -> Report | None:
        run = lambda version: _run_version(store, name, own, pages, now, deletions, codes, areas, loader, changed_at, version)
        return attempts(store, name, run)

    try:
        return of(sources, run_id)
    except Conflict:
        raise
    except Exception as fault:
        if len(names) == 1:
            _fail(store, run_id, {names[0]: fault}, now)
            return None
    # Nothing of the run has been committed: go on source by source, each a commit of its own.
    faults = {}
    for name in sorted(names):
        try:
            of(R.enabled_sources(sources).where(F.col("std_name") == name), f"{run_id}/{name}")
        except Conflict:
            raise
        except Exception as fault:
            faults[name] = fault
    _fail(store, run_id, faults, now)
    return None


def _fail(store: Store, run_id: str, faults: dict[str, Exception], now: datetime) -> None:
    """Log a failed run for each of the sources, and end the run."""
    moment = F.lit(now).cast("timestamp_ntz")
    comments = [(name, f"{type(fault).__name__}: {fault}"[:_COMMENT]) for name, fault in faults.items()]
    failed = cut(store.spark.createDataFrame(comments, "source string, comment string"))
    named = failed.select("source", F.col("source").alias("std_name"))

    def once(version: int) -> None:
        opened = cut(R.open_runs(stored_runs(store, version), named, moment, "update"))
        counters = R.run_counters(store.spark.createDataFrame([], "source string, import_id bigint, outcome string, n bigint"))
        last = R.close_runs(opened, counters, failed, moment).withColumn("seq", F.col("seq").cast("bigint"))
        events = opened.withColumn("seq", F.lit(0).cast("bigint")).unionByName(last, allowMissingColumns=True)
        log = store.spark.createDataFrame([], _EVENTS).unionByName(events, allowMissingColumns=True)
        store.write(run_id, {}, None, {"import_log": log}, version)

    attempts(store, run_id, once)


def _run_version(
    store: Store, run_id: str, sources: DataFrame, pages: DataFrame | str, now: datetime, deletions, codes, areas, loader, changed_at, version: int
) -> Report | None:
    spark = store.spark
    moment = F.lit(now).cast("timestamp_ntz")
    enabled = cut(R.enabled_sources(sources).select(F.col("std_name").alias("source"), "std_name", "data_type").dropDuplicates(["source"]))
    runs = cut(stored_runs(store, version))
    filters = F.to_json(F.struct(F.lit(changed_at).alias("changed_at")))
    opened = cut(R.open_runs(runs, enabled, moment, "update", filters))
    # Polls take what lands, whenever it was changed: they move no watermark.
    asked = runs.where(F.coalesce(F.col("xfer_type"), F.lit("")) != S.STREAM)
    marks = cut(R.watermarks(asked).where(F.col("controler") == S.CONTROLER_DATA).select("source", "since"))

    known, files = ledger.taken(store, version), None
    if isinstance(pages, str):
        listed = join_lookup(ledger.landed_files(spark, pages), enabled.select("source"), ["source"], "inner")
        files = cut(ledger.unread(listed, known))
        pages = ledger.read_files(spark, pages, files)
    elif "file" in pages.columns:
        named = join_lookup(pages.select("source", "import_id", "file").distinct(), enabled.select("source"), ["source"], "inner")
        files = cut(ledger.unread(named, known))
        pages = pages.join(small_side(files.select("source", "file")), ["source", "file"], "left_semi")
    for name in ("total_filtered", "limit"):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast("bigint"))
    landed = join_lookup(pages, opened.select("source", F.col("id").alias("_run")), ["source"], "inner")
    # Read once; a page is judged by the copy that is imported.
    landed = cut(landed.withColumn("delivery", F.col("import_id")))
    failed = cut(_failing(landed, known))
    readable = join_lookup(landed.where("items IS NOT NULL"), failed.select("source", F.lit(True).alias("_failed")), ["source"], "left")
    readable = readable.where("_failed IS NULL").withColumn("import_id", F.col("_run")).drop("_run", "_failed")
    rows = arrivals(readable, enabled.select("source", "data_type"), now)
    if changed_at is not None and files is None:
        at = F.get_json_object("item", f"$.{changed_at}").try_cast("timestamp_ntz")
        rows = R.changed_since(rows.withColumn("_at", F.coalesce(at, moment)), marks, "_at").drop("_at")

    gone = None
    if deletions is not None:
        good = opened.join(failed, "source", "left_anti").select("source", F.col("id").alias("import_id"))
        since = R.deleted_since(deletions, marks).drop("import_id")
        gone = cut(join_lookup(since, good, ["source"], "inner").select("source", "id_data", "import_id"))

    closing = run_events(opened, failed, gone is not None, moment)
    added = {}
    if files is not None:
        done = join_lookup(files, failed.select("source", F.lit(True).alias("_failed")), ["source"], "left").where("_failed IS NULL")
        added[ledger.TABLE] = ledger.entries(done, landed)
    return import_into_store(store, run_id, rows, moment, codes, areas, gone, loader, closing, added, version)
