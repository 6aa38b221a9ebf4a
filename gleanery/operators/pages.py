"""Pages of an export: planning, cutting, reading and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleanery.operators.joins import join_lookup
from gleanery.operators.keys import number_by_id, running_total
from gleanery.operators.lineage import cut

_CHUNK = 10_000


def query_string(parameters: dict[str, object]) -> Column:
    """URL-encoded parameters; a list repeats its parameter, a null leaves it out."""
    parts = []
    for name, value in parameters.items():
        for one in value if isinstance(value, (list, tuple)) else [value]:
            text = (one if isinstance(one, Column) else F.lit(one)).cast("string")
            parts.append(F.concat(F.url_encode(F.lit(name)), F.lit("="), F.url_encode(text)))
    return F.concat_ws("&", *parts)


def page_plan(
    totals: DataFrame, total: str, limit: int | str, param: str = "offset", parameters: dict[str, object] | None = None
) -> DataFrame:
    """One row per page to fetch: ceil(total / limit) pages, none for an empty result.

    `parameters` are further ones of the query (order, filters).

    Pages count from 0 for `offset` and from 1 for `page`. A long plan is opened in
    chunks, so that no row holds it whole.
    """
    size = F.lit(limit) if isinstance(limit, int) else F.col(limit)
    first = 1 if param == "page" else 0
    pages = totals.where(F.col(total) > 0).withColumn("_pages", F.ceil(F.col(total) / size).cast("bigint"))
    chunks = pages.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_pages") - 1) / _CHUNK)))
    )
    start = F.col("_chunk") * _CHUNK
    stop = F.least(start + _CHUNK, F.col("_pages")) - 1
    numbered = chunks.withColumn("page", F.explode(F.sequence(start + first, stop + first)))
    return numbered.withColumn(
        "query", query_string({"limit": size, param: F.col("page")} | (parameters or {}))
    ).drop("_pages", "_chunk")


def page_gaps(
    landed: DataFrame, by: list[str], page: str = "page_no", total: str = "total_filtered", limit: str = "limit",
    block: int = _CHUNK,
) -> DataFrame:
    """Ranges of pages that a delivery lacks, has twice, or has beyond its plan.

    `landed` has a row per landed page with the total and page size it tells. The plan of a
    delivery (its columns are `by`) is that of its largest total, ceil(total / limit) pages; a
    delivery without totals ends at its last page. Pages count from 1 if there is no page 0 and the plan
    reaches its end that way, else from 0. Rows: `by`, `kind` (missing, doubled, surplus),
    `first_page`, `last_page`. Pages without a number are passed over.

    The plan is never written out: landed numbers are compared with the one before, in blocks
    of `block` numbers, whose last numbers alone meet per delivery.
    """
    told = F.struct(F.col(total).cast("bigint").alias("total"), F.col(limit).cast("bigint").alias("size"))
    known = F.col(total).isNotNull() & (F.col(limit) > 0)
    plan = landed.where(F.col(page).isNotNull()).groupBy(*by).agg(
        F.max(F.when(known, told)).alias("_told"), F.min(page).alias("_low"), F.max(page).alias("_high")
    )
    planned = F.greatest(F.lit(1), F.ceil(F.col("_told.total") / F.col("_told.size")).cast("bigint"))
    from_one = (F.col("_low") > 0) & (F.col("_told").isNull() | (F.col("_high") >= planned))
    start = F.when(from_one, 1).otherwise(0).cast("bigint")
    end = F.when(F.col("_told").isNull(), F.col("_high")).otherwise(start + planned - 1)
    plan = cut(plan.select(*by, start.alias("_start"), end.alias("_end")))

    copies = landed.where(F.col(page).isNotNull()).groupBy(*by, F.col(page).cast("bigint").alias("_page"))
    pages = cut(join_lookup(copies.agg(F.count(F.lit(1)).alias("_copies")), plan, by, "inner"))
    one = lambda rows, kind: rows.select(*by, F.lit(kind).alias("kind"), F.col("_page").alias("first_page"), F.col("_page").alias("last_page"))
    inside = F.col("_page").between(F.col("_start"), F.col("_end"))

    held = pages.where(inside).withColumn("_block", F.floor(F.col("_page") / block))
    ends = held.groupBy(*by, "_block").agg(F.max("_page").alias("_last"))
    before = W.partitionBy(*by).orderBy("_block")
    ends = ends.select(*by, "_block", F.lag("_last").over(before).alias("_earlier"))
    in_block = W.partitionBy(*by, "_block").orderBy("_page")
    stepped = held.withColumn("_before", F.lag("_page").over(in_block)).join(ends, [*by, "_block"])
    stepped = stepped.withColumn("_before", F.coalesce("_before", "_earlier", F.col("_start") - 1))
    between = stepped.where(F.col("_page") - F.col("_before") > 1).select(
        *by, F.lit("missing").alias("kind"), (F.col("_before") + 1).alias("first_page"), (F.col("_page") - 1).alias("last_page")
    )
    reached = held.groupBy(*by).agg(F.max("_page").alias("_last"))
    tail = plan.join(reached, by, "left").withColumn("_last", F.coalesce("_last", F.col("_start") - 1))
    tail = tail.where(F.col("_last") < F.col("_end")).select(
        *by, F.lit("missing").alias("kind"), (F.col("_last") + 1).alias("first_page"), F.col("_end").alias("last_page")
    )
    extra = one(pages.where(F.col("_copies") > 1), "doubled").unionByName(one(pages.where(~inside), "surplus"))
    return between.unionByName(tail).unionByName(extra)


def number_by_order(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """1-based position of each row in any total order.

    The sorted rows are written once, so the two passes over them (sizes of the
    parts, then positions) see the same parts; only the sizes meet in one task.
    """
    placed = df.orderBy(*order).withColumn("_part", F.spark_partition_id())
    rows = cut(placed.withColumn("_in", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    return (
        rows.join(F.broadcast(bases), "_part")
        .withColumn(out, (F.col("_base") + F.col("_in") + 1).cast("bigint"))
        .drop("_part", "_in", "_base")
    )


def paginate(df: DataFrame, limit: int, id_column: str | None = None, order: str | None = None) -> DataFrame:
    """Give each row its `page_no` and `pos`, both from 0.

    `order` is the publisher's order parameter: column names separated by `:`.
    """
    if order is not None:
        numbered = number_by_order(df, order.split(":"), "_rn")
    else:
        numbered = number_by_id(df, id_column, "_rn")
    zero = F.col("_rn") - 1
    return (
        numbered.withColumn("page_no", F.floor(zero / limit).cast("bigint"))
        .withColumn("pos", (zero % limit).cast("int"))
        .drop("_rn")
    )


def to_envelopes(paged: DataFrame, item: str, limit: int, total: int | Column) -> DataFrame:
    """Pages as delivered: `page_no, items, total_filtered, limit`; a group is one page."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", item)))
    return paged.groupBy("page_no").agg(
        F.transform(ordered, lambda e: e[item]).alias("items"),
    ).withColumn("total_filtered", total if isinstance(total, Column) else F.lit(total).cast("bigint")).withColumn(
        "limit", F.lit(limit).cast("bigint")
    )


def scan_pages(envelopes: DataFrame) -> DataFrame:
    """Elements of delivered pages in arrival order (`page_no`, `pos`), with the total."""
    total = F.coalesce("total_filtered", "total") if "total" in envelopes.columns else F.col("total_filtered")
    keep = [c for c in envelopes.columns if c not in ("items", "total_filtered", "total", "limit")]
    return envelopes.select(*keep, total.alias("total_len"), F.posexplode("items").alias("pos", "item"))


def progress(pages: DataFrame, run: str, page: str, size: str, total: str) -> DataFrame:
    """Running item count and percentage after each page of a run."""
    counted = running_total(pages, [run], page, size, "done")
    ratio = F.when(F.col(total) > 0, F.round(F.col("done") * F.lit(100.0) / F.col(total), 2))
    return counted.withColumn("percent", ratio.cast("decimal(7,2)"))
