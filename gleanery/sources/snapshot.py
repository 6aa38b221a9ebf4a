"""Versioned Parquet tables of one consolidated store.

A run writes its tables into folders of its own (`<table>/commit=<token>`, the token is
new for every attempt) and then appends one commit record: version, run, token, and
which folder holds each table that is written whole. The record is a single file that
appears at once, and readers follow records only. So the tables of a run appear together
or not at all, and what a run that died has left is never read.

Small tables are written whole. The raw table and the facts are split by source and by
range of ids (`id_data div ids_per_range`): a range holds a bounded number of rows
whatever the source, and an update, which mostly touches recent ids, rewrites few of
them. The live folder of a range is that of the newest commit that lists it. Logs only
grow, so a run appends its rows to them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.joins import small_side

RANGE = ["p_source", "p_range"]
_COMMITS = "version bigint, run_id string, token string, whole map<string,string>, added array<string>"
_RANGES = "token string, name string, p_source string, p_range bigint"


class Conflict(RuntimeError):
    """Another run has written the version that this one was to write."""


class Store:
    """Any number of readers and writers; of two writers that start from one version one succeeds.

    The record of a version is a file of its own, which is created only if it is not there, so the
    other writer gets a `Conflict` and has to start again from the newer version.

    `ranged_by` names the source and id columns of each table split in ranges. `uuid_parts` is the
    number of parts of the index of uuids, some hundred thousand uuids each; it stays as it is.
    """

    def __init__(self, spark: SparkSession, root: str, ids_per_range: int = 1_000_000, uuid_parts: int = 64):
        self.spark = self._spark = spark
        self.uuid_parts = uuid_parts
        #: What has been read of a version; it does not change any more.
        self.known: dict = {}
        self.ranged_by = {"data_json": ("source", "id_data"), "facts": ("id_source", "id_synthese"), "tombstones": ("source", "id_data")}
        self.root = root.rstrip("/")
        self.ids_per_range = ids_per_range

    def _append(self, rows: DataFrame, name: str) -> None:
        if name == "commits":
            self._record(*rows.select("version", F.to_json(F.struct("*"))).first())
        else:
            rows.coalesce(1).write.mode("append").json(f"{self.root}/{name}")

    def append(self, rows: DataFrame, name: str) -> None:
        """Add rows to a list; those of a run count from its commit on, by its token."""
        self._append(rows, name)

    def _record(self, version: int, text: str) -> None:
        """Create the record of a version; a file that is half written reads as none."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/version-{version:010d}.json")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(path.getParent())
        try:
            out = files.create(path, False)
        except Py4JJavaError as error:
            if files.exists(path):
                raise Conflict(f"version {version} is there already") from error
            raise
        out.write(bytearray(text + "\n", "utf-8"))
        out.close()

    def _list(self, name: str, schema: str) -> DataFrame:
        """One of the lists; it is there from the first commit on."""
        try:
            return self._spark.read.schema(schema).json(f"{self.root}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], schema)

    def listed(self, name: str, schema: str) -> DataFrame:
        return self._list(name, schema)

    # --------------------------------------------------------------- reading
    def commits(self, version: int) -> DataFrame:
        """Records up to a version."""
        return self._commits(version)

    def _commits(self, version: int | None = None) -> DataFrame:
        commits = self._list("commits", _COMMITS)
        return commits if version is None else commits.where(F.col("version") <= version)

    def version(self) -> int:
        return self._commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def has_run(self, run_id: str) -> bool:
        return not self._commits().where(F.col("run_id") == run_id).isEmpty()

    def _whole(self, version: int) -> dict[str, str]:
        """Folder of every whole table as of a version."""
        if ("whole", version) not in self.known:
            last = self._commits().where(F.col("version") == version).first()
            self.known["whole", version] = dict(last["whole"] or {}) if last else {}
        return self.known["whole", version]

    def read(self, name: str, schema: str, version: int | None = None) -> DataFrame:
        """A table that is written whole; empty until a run has written it."""
        token = self._whole(self.version() if version is None else version).get(name)
        if token is None:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(f"{self.root}/{name}/commit={token}")

    def read_added(self, name: str, schema: str, version: int | None = None) -> DataFrame:
        """A table to which runs append: the rows of all committed runs."""
        version = self.version() if version is None else version
        commits = self._commits(version).where(F.array_contains("added", name))
        if commits.isEmpty():
            return self._spark.createDataFrame([], schema)
        table = self._spark.read.schema(f"{schema}, commit string").parquet(f"{self.root}/{name}")
        live = commits.select(F.col("token").alias("commit"))
        return table.join(small_side(live), "commit", "left_semi").drop("commit")

    def _live_ranges(self, name: str, version: int) -> DataFrame:
        commits = self._commits(version).select("version", "token")
        rows = self._list("ranges", _RANGES).where(F.col("name") == name).join(F.broadcast(commits), "token")
        return rows.groupBy(*RANGE).agg(F.max_by("token", "version").alias("commit"))

    def read_ranged(
        self, name: str, schema: str, touched: DataFrame | None = None, version: int | None = None
    ) -> DataFrame:
        """A table split in ranges, or only the ranges listed in `touched`.

        The ranges are joined on partition columns, so folders without a live range
        are not opened.
        """
        version = self.version() if version is None else version
        live = self._live_ranges(name, version)
        if version == 0 or live.isEmpty():
            return self._spark.createDataFrame([], schema)
        if touched is not None:
            live = live.join(touched, RANGE, "left_semi")
        parts = f"{schema}, commit string, p_source string, p_range bigint"
        columns = self._spark.createDataFrame([], schema).columns
        table = self._spark.read.schema(parts).parquet(f"{self.root}/{name}")
        return table.join(small_side(live), ["commit", *RANGE]).select(*columns)

    def range_of(self, name: str) -> list[Column]:
        source, number = self.ranged_by[name]
        part = F.floor(F.col(number) / F.lit(self.ids_per_range)).cast("bigint")
        return [F.col(source).cast("string").alias("p_source"), part.alias("p_range")]

    def touched(self, *batches: DataFrame, name: str = "data_json") -> DataFrame:
        """Ranges the rows of some batches (source and id of the table) fall into."""
        out = None
        for batch in batches:
            rows = batch.select(*self.range_of(name)).distinct()
            out = rows if out is None else out.unionByName(rows)
        return out.distinct()

    def within(self, rows: DataFrame, touched: DataFrame, name: str) -> DataFrame:
        """Rows of a table that fall into some ranges."""
        split = rows.select("*", *self.range_of(name))
        return split.join(small_side(touched), RANGE, "left_semi").select(*rows.columns)

    # --------------------------------------------------------------- writing
    def write(
        self,
        run_id: str,
        whole: dict[str, DataFrame],
        ranged: dict[str, tuple[DataFrame, DataFrame]] | None = None,
        added: dict[str, DataFrame] | None = None,
        base: int | None = None,
        beside: Callable[[str, int], None] | None = None,
    ) -> int:
        """Write the version after `base` (the newest one, if not given) and return its number.

        `whole` tables replace their predecessors. `ranged` ones give the new rows of
        some ranges and the list of these ranges; all other ranges stay as they are.
        `added` rows are appended to their tables. `beside` writes further files by the token
        and the number of the version. Raises `Conflict` if another run was faster.
        """
        version = self.version() if base is None else base
        token = uuid.uuid4().hex
        for name, df in (whole | (added or {})).items():
            df.write.parquet(f"{self.root}/{name}/commit={token}")
        for name, (df, touched) in (ranged or {}).items():
            split = df.select("*", *self.range_of(name))
            # The rows of one range meet in one task; their number is bounded.
            split.repartition(*RANGE).write.partitionBy(*RANGE).parquet(f"{self.root}/{name}/commit={token}")
            listed = touched.select(F.lit(token).alias("token"), F.lit(name).alias("name"), *RANGE)
            self._append(listed, "ranges")
        if beside is not None:
            beside(token, version + 1)
        folders = self._whole(version) | dict.fromkeys(whole, token)
        record = (version + 1, run_id, token, folders, sorted(added or {}))
        self._append(self._spark.createDataFrame([record], _COMMITS), "commits")
        return version + 1
