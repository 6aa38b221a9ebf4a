"""Landing folders of delivered pages.

A publisher's pages land as `<folder>/source=<name>/import_id=<n>/<file>.json`, one
JSON document per line: `{"items": [...], "total_filtered": n, "limit": n}`. The page
number is the member `page_no`, else the number at the end of the file name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.functions import text
from gleanery.operators.joins import join_lookup

_LAYOUT = S.PAGE + ", page_no bigint, source string, import_id bigint"


def _written() -> Column:
    """When a row's file was written, in microseconds."""
    return F.unix_micros("_metadata.file_modification_time")


def file_name() -> Column:
    """Name of a row's file for a store: its place and when it was written."""
    return F.concat_ws("@", "_metadata.file_path", _written().cast("string"))


def _with_page_no(df: DataFrame) -> DataFrame:
    digits = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1)
    return df.withColumns({"page_no": F.coalesce("page_no", digits.try_cast("bigint")), "file": file_name()})


def read_pages(
    spark: SparkSession,
    folder: str | list[str],
    multi_line: bool = False,
    base: str | None = None,
    since: int | None = None,
) -> DataFrame:
    """Delivered pages; elements stay JSON text. Source and run prune folders.

    `multi_line` is for one page per file, written over several lines. Files may be named one by
    one below the folder `base`; `since` leaves files that were written before (microseconds)
    unopened.
    """
    reader = spark.read.schema(_LAYOUT).option("multiLine", multi_line)
    if not folder:
        return spark.createDataFrame([], _LAYOUT).withColumn("file", F.lit(""))
    if base is not None:
        reader = reader.option("basePath", base)
    pages = reader.json(folder)
    return _with_page_no(pages if since is None else pages.where(_written() >= since))


def stream_pages(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, multi_line: bool = False
) -> DataFrame:
    """The same as a stream of newly landed pages."""
    reader = spark.readStream.schema(_LAYOUT).option("multiLine", multi_line)
    return _with_page_no(reader.option("maxFilesPerTrigger", files_per_batch).json(folder))


_DELETION = "id_data bigint, last_action string, meta_last_action_date timestamp_ntz, source string, import_id bigint"


def stream_deletions(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Deletion logs as a stream: the layout of the pages, one log row per line."""
    reader = spark.readStream.schema(_DELETION).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder).withColumn("file", file_name())


def arrivals(pages: DataFrame, data_types: DataFrame | None = None, now=None) -> DataFrame:
    """Elements of pages as raw rows with their order of arrival.

    The order is that of runs (and of the column `delivery` within one, if given) and page
    numbers; pages of one number, as in files whose names end in no page number, follow in the
    order of files and lines.

    `data_types` (`source, data_type`) gives the record type of each source.
    Columns: those of `schemas.DATA_JSON`, `seq` and the uuid text as delivered.
    """
    if "file" not in pages.columns:
        pages = pages.withColumn("file", F.lit(""))
    pages = pages.withColumn("line", F.monotonically_increasing_id())
    order = [c for c in ("import_id", "delivery", "page_no", "file", "line") if c in pages.columns]
    rows = pages.select("source", *order, F.posexplode("items").alias("pos", "item"))
    if data_types is not None:
        types = data_types.select("source", F.col("data_type").alias("type"))
        # One source may send a third of all rows, so this join must not shuffle on it.
        rows = join_lookup(rows, types, ["source"], "left")
    else:
        rows = rows.withColumn("type", F.lit(None).cast("string"))
    head = F.from_json(F.col("item"), "id_synthese string, id_perm_sinp string")
    return (
        rows.withColumn("_head", head)
        .withColumn("type", F.coalesce("type", F.lit(S.DEFAULT_DATA_TYPE)))
        .select(
            "source",
            F.lit(S.CONTROLER_DATA).alias("controler"),
            "type",
            F.col("_head.id_synthese").try_cast("bigint").alias("id_data"),
            text.clean_uuid(F.col("_head.id_perm_sinp")).alias("uuid"),
            "item",
            (F.lit(now) if now is not None else F.current_timestamp()).cast("timestamp_ntz").alias("update_ts"),
            "import_id",
            F.struct(*order, "pos").alias("seq"),
            F.col("_head.id_perm_sinp").alias("_raw_uuid"),
        )
    )
