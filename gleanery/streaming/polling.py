"""Pages that land in a folder, merged batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanery import schemas as S
from gleanery.operators.lineage import cut
from gleanery.operators.runlog import open_runs
from gleanery.plans.consolidate import import_into_store
from gleanery.plans.incremental import run_events, stored_runs
from gleanery.sources.landing import arrivals, stream_deletions, stream_pages
from gleanery.sources.snapshot import Store


def upsert_into_store(store: Store, run_id: str, batch: DataFrame, now=None, **options) -> None:
    """Import a batch of arrivals as one run; a repeated run does nothing.

    The batch goes through the whole import: documents are split off, values are checked,
    and what cannot be stored is in the error log. Give `codes`, `areas` and a `loader`
    to load the star schema as well.
    """
    moment = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    import_into_store(store, run_id, batch, moment, **({"loader": None} | options))


def batch_name(pages: DataFrame) -> str:
    """Name of a batch by the files it holds, whatever checkpoint or folder it came through."""
    files = pages.select("file").distinct()
    count, total = files.agg(F.count("*"), F.sum(F.xxhash64("file").cast("decimal(20,0)"))).first()
    return f"{count}-{total or 0}"


def _logged(store: Store, rows: DataFrame, gone: DataFrame | None, moment) -> Callable:
    """Makes the log events of a batch: one run per source, with the counters of all it brought."""
    sources = rows.select("source") if gone is None else rows.select("source").unionByName(gone.select("source"))
    named = cut(sources.distinct().withColumn("std_name", F.col("source")))

    def events(counters: DataFrame) -> DataFrame:
        opened = cut(open_runs(stored_runs(store), named, moment, S.STREAM))
        sums = [F.sum(c).alias(c) for c in counters.columns if c not in ("source", "import_id")]
        total = counters.groupBy("source").agg(*sums).join(opened.select("source", F.col("id").alias("import_id")), "source")
        failed = store.spark.createDataFrame([], "source string, comment string")
        return run_events(opened, failed, gone is not None, moment)(total)

    return events


def poll(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    on_batch: Callable[[DataFrame, str], None],
    data_types: DataFrame | None = None,
    files_per_batch: int = 1000,
    now=None,
) -> StreamingQuery:
    """Hand the arrivals of newly landed pages to `on_batch`, until none is left.

    A batch can come twice after a failure, under the same name, so `on_batch` must be
    idempotent; an upsert is.
    """

    def handle(pages: DataFrame, batch_id: int) -> None:
        on_batch(arrivals(pages, data_types, now), batch_name(pages))

    return _until_empty(stream_pages(spark, folder, files_per_batch), handle, checkpoint)


def _until_empty(stream: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def poll_into_store(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    store: Store,
    name: str = "poll",
    imports: dict | None = None,
    deletions: str | None = None,
    data_types: DataFrame | None = None,
    files_per_batch: int = 1000,
    now=None,
) -> StreamingQuery:
    """Keep a store up to date with a landing folder; `imports` goes to `upsert_into_store`.

    `deletions` is a folder of deletion logs; both folders are read as one stream. A deletion
    takes its row out unless the row was changed later, and keeps older pages that come after it
    from bringing the row back. Every batch leaves a run per source in the import log.
    """
    given = dict(imports or {})

    def merge(rows: DataFrame, gone: DataFrame | None, batch: str) -> None:
        moment = given.get("now", F.lit(datetime.now()).cast("timestamp_ntz"))
        rows = cut(rows)
        upsert_into_store(store, f"{name}-{batch}", rows, **({"log": _logged(store, rows, gone, moment)} | given), **({} if gone is None else {"deletions": gone}))

    if deletions is None:
        return poll(spark, folder, checkpoint, lambda rows, batch: merge(rows, None, batch), data_types, files_per_batch, now)

    pages = stream_pages(spark, folder, files_per_batch).withColumn("deletion", F.lit(False))
    logs = stream_deletions(spark, deletions, files_per_batch).withColumn("deletion", F.lit(True))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = cut(batch)
        gone = batch.where("deletion AND last_action = 'D' AND id_data IS NOT NULL").select(
            "source", "id_data", "import_id", F.col("meta_last_action_date").alias("at")
        )
        merge(arrivals(batch.where("NOT deletion"), data_types, now), cut(gone), batch_name(batch))

    return _until_empty(pages.unionByName(logs, allowMissingColumns=True), handle, checkpoint)
