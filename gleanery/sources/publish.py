"""Publishing an export: as a view, as Parquet, or as pages of JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import documents as D
from gleanery.operators.pages import paginate

# Columns that hold JSON text and go into the element as JSON, not as a string.
NESTED = ("jdd_data", "ca_data", "area_attachment", "donnees_additionnelles")


def publish_view(export: DataFrame, name: str) -> None:
    export.createOrReplaceTempView(name)


def publish_parquet(export: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Files of bounded size, in the order of the export."""
    export.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def to_items(export: DataFrame) -> DataFrame:
    """Export rows as elements: `id_synthese, item`."""
    plain = [c for c in export.columns if c not in NESTED]
    item = D.full_json(F.struct(*plain))
    body = [F.substring(item, F.lit(1), F.length(item) - 1)]
    for name in NESTED:
        if name in export.columns:
            body += [F.lit(f',"{name}":'), F.coalesce(F.col(name), F.lit("null"))]
    return export.select("id_synthese", F.concat(*body, F.lit("}")).alias("item"))


def publish_pages(export: DataFrame, path: str, limit: int = 1000, order: str | None = None) -> None:
    """Write pages of `limit` elements as JSON lines, in folders of 10,000 pages.

    Each line is one page with its number; a page is one group of at most `limit`
    rows, so the work spreads over all tasks.
    """
    items = to_items(export)
    paged = paginate(items, limit, id_column="id_synthese", order=order)
    total = items.count()
    listed = F.transform(F.sort_array(F.collect_list(F.struct("pos", "item"))), lambda e: e["item"])
    line = F.concat(
        F.lit('{"page_no":'), F.col("page_no").cast("string"), F.lit(f',"limit":{limit},"total_filtered":{total},"items":['),
        F.array_join("items", ","), F.lit("]}"),
    )
    pages = paged.groupBy("page_no").agg(listed.alias("items"))
    folder = F.floor(F.col("page_no") / 10_000).alias("folder")
    pages.select(line.alias("value"), folder).write.mode("overwrite").partitionBy("folder").text(path)


def read_published(spark, path: str) -> DataFrame:
    """Pages written by `publish_pages`."""
    schema = "page_no bigint, items array<string>, total_filtered bigint, limit bigint"
    return spark.read.schema(schema).json(path)
