"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of blocks that meet the tiles in one task, tasks that small tables are dealt over, and groups of tiles at most.
CHUNK_BYTES = 8 << 20
TASKS = 64
GROUPS = 4


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under internal names; extra columns cannot clash with anything."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def free(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below `spark.checkpoint.dir`, or below the session's checkpoint folder.

    All machines must see it, so on a cluster there is no default; a session on one machine has
    its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        set_by_call = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not set_by_call.isEmpty():
            root = set_by_call.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them back: survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def meeting(blocks: DataFrame, tiles: DataFrame, content: str) -> DataFrame:
    """Blocks and tiles dealt so that every tile lies beside every block once, in a task that reads its blocks first.

    A task has one chunk of the blocks, of about `CHUNK_BYTES` of `content`, and one group of the
    tiles. Tiles are repeated for each chunk and blocks for each group, in a shuffle and never in
    a broadcast: their product has no bound. Both have `ids` of their own.
    """
    count, size = blocks.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(content)), F.lit(0))).first()
    asked = tiles.count()
    least = -(-size // CHUNK_BYTES)
    groups = max(1, min(asked, GROUPS, -(-TASKS // max(1, least))))
    chunks = max(1, least, min(count, -(-TASKS // groups)))

    def dealt(df: DataFrame, own: int, of: int, step: int, stride: int) -> DataFrame:
        place = F.pmod(F.xxhash64("ids", content), F.lit(own)) * F.lit(stride)
        return df.withColumn("slot", F.explode(F.transform(F.sequence(F.lit(0), F.lit(of - 1)), lambda i: (place + i * F.lit(step)).cast("int"))))

    held = dealt(blocks, chunks, groups, 1, groups).withColumn("is_tile", F.lit(False))
    put = dealt(tiles, groups, chunks, groups, 1).withColumn("is_tile", F.lit(True))
    both = held.unionByName(put, allowMissingColumns=True)
    return both.repartitionById(chunks * groups, F.col("slot")).sortWithinPartitions("slot", "is_tile")


def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """Each tile with the blocks of its task, from the rows of `meeting`."""
    slot, blocks = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["slot"] != slot:
                slot, blocks = row["slot"], []
            if row["is_tile"]:
                yield row, [b for b in blocks if b["dim"] == row["dim"]]
            else:
                blocks.append(row)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
