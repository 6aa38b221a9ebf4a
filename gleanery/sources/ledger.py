"""Which landed files a store has taken in.

A landing folder only grows, and a page may land long after the run that asked for it. So a
run does not go by times: it lists the files (without opening one), leaves out those in the
ledger of the store, and reads the others. The ledger has one row per page of a file, with what the
page says about its delivery, and is written with the commit of the run that took the file in; the
files of a source that failed stay out of it and are read again.

A file is named by its place and the time it was written, so a page that is delivered anew under
the same name counts as new.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.joins import small_side
from gleanery.sources.landing import file_name, read_pages
from gleanery.sources.snapshot import Store

TABLE = "page_files"
LAYOUT = "source string, import_id bigint, file string, page_no bigint, total_filtered bigint, `limit` bigint"

#: Files that are handed to the reader by name; more are found by their time, then by name.
NAMED_FILES = 10_000
_PATTERN = re.compile(r"[*?\[\]{}\\]")


def taken(store: Store, version: int | None = None) -> DataFrame:
    """Pages of all files the store has taken in."""
    return store.read_added(TABLE, LAYOUT, version)


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a landing folder: `source, import_id, file, path`; none of them is opened."""
    files = spark.read.format("binaryFile").load(folder)
    # The folders' values as text: a name like 007 must not become a number.
    value = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    named = F.url_decode(F.replace(value("source"), F.lit("+"), F.lit("%2B")))
    return files.select(named.alias("source"), value("import_id").try_cast("bigint").alias("import_id"), file_name().alias("file"), "path")


def unread(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The files that are not in the ledger."""
    return files.join(ledger.select("source", "file").distinct(), ["source", "file"], "left_anti")


def read_files(spark: SparkSession, folder: str, files: DataFrame, multi_line: bool = False) -> DataFrame:
    """Pages of the given files of a folder only."""
    if files.limit(NAMED_FILES + 1).count() <= NAMED_FILES:
        paths = [row["path"] for row in files.select("path").distinct().collect()]
        if not any(_PATTERN.search(path) for path in paths):
            return read_pages(spark, paths, multi_line, base=folder)
    # The time is compared before a file is opened, the name behind it.
    oldest = files.agg(F.min(F.substring_index("file", "@", -1).cast("bigint"))).first()[0]
    pages = read_pages(spark, folder, multi_line, since=oldest)
    return pages.join(small_side(files.select("file")), "file", "left_semi").select(pages.columns)


def entries(files: DataFrame, pages: DataFrame) -> DataFrame:
    """Ledger rows of files with their pages; a file without pages has one row as well."""
    told = pages.select("source", "file", "page_no", "total_filtered", "limit")
    columns = ["source", "import_id", "file", "page_no", "total_filtered", "limit"]
    return files.select("source", "import_id", "file").join(told, ["source", "file"], "left").select(*columns)
