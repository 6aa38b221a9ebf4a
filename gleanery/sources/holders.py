"""Index of uuid holders: which stored row has a uuid, found without reading the table.

Every run appends what it changed (uuid, key, held or given up) to the parts its uuids fall into by
hash. Beside them it writes a Bloom filter per part and run: words of 64 bits, in one of which a
uuid sets four. A lookup joins its uuids with these words and opens the files of those parts and
runs only that may have one of them; a new uuid, the normal case, opens next to none. Of the
entries of a uuid that of the newest run counts.

A part that has gathered `MERGE_AT` runs is written anew as a whole by the next one that
touches it, so a lookup opens at most that many files per part, whatever the history.

A second index of the same make says in which ranges of ids the facts of a uuid, or of a source
and its own id, may lie. Its entries are only added: a range that has lost a fact is opened in vain.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.joins import small_side
from gleanery.operators.lineage import cut
from gleanery.sources.snapshot import Store


class Index(NamedTuple):
    """Name of an index, and what tells its entries apart."""

    name: str
    identity: tuple[str, ...]

    def folder(self, store: Store, what: str) -> str:
        return f"{store.root}/{self.name}_{what}"


UUIDS = Index("uuid", ("uuid",))
FACTS = Index("fact", ("uuid", "source", "id_data"))
ENTRY = "uuid string, held boolean, source string, id_data bigint, version bigint"
_WORD = "p_part bigint, word bigint, mask bigint"
_PART = "token string, parts bigint, p_part bigint, words bigint, merged boolean"
MERGE_AT = 8
#: Bits of a filter per uuid.
BITS = 16


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("uuid"), F.lit(parts))


def _word(words: Column) -> Column:
    return F.pmod(F.shiftright(F.xxhash64("uuid", F.lit("word")), 8), words)


def _mask() -> Column:
    hashed = "xxhash64(uuid, 'bits')"
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned({hashed}, {6 * i}) & 63 AS int))" for i in range(4)))


def _live(store: Store, version: int, index: Index = UUIDS) -> list[tuple[str, int, int]]:
    """(token, part, words) of the files that count: at most `MERGE_AT` + 1 per part."""
    if (index.name, version) not in store.known:
        store.known[index.name, version] = _read_live(store, version, index)
    return store.known[index.name, version]


def _read_live(store: Store, version: int, index: Index) -> list[tuple[str, int, int]]:
    if not version:
        return []
    commits = store.commits(version).select("version", "token")
    listed = store.listed(f"{index.name}_parts", _PART).join(F.broadcast(commits), "token")
    if not listed.where(F.col("parts") != store.uuid_parts).isEmpty():
        raise ValueError("a store keeps the number of uuid parts it was made with")
    base = listed.groupBy("p_part").agg(F.coalesce(F.max(F.when(F.col("merged"), F.col("version"))), F.lit(0)).alias("base"))
    live = listed.join(F.broadcast(base), "p_part").where("version >= base")
    return [(r["token"], r["p_part"], r["words"]) for r in live.select("token", "p_part", "words").collect()]


def _paths(store: Store, index: Index, places: list[tuple[str, int]]) -> list[str]:
    return [f"{index.folder(store, 'index')}/commit={token}/p_part={part}" for token, part in places]


def _entries(store: Store, paths: list[str]) -> DataFrame:
    if not paths:
        return store.spark.createDataFrame([], ENTRY)
    return store.spark.read.schema(ENTRY).parquet(*paths)


def indexed(store: Store, version: int, index: Index = UUIDS) -> bool:
    return bool(_live(store, version, index))


def find(store: Store, wanted: DataFrame, version: int, index: Index = UUIDS) -> DataFrame | None:
    """(uuid, source, id_data) of the wanted uuids that a stored row holds; None without an index."""
    spark = store.spark
    live = _live(store, version, index)
    if not live:
        return None
    asked = cut(wanted.select("uuid").where("uuid IS NOT NULL").distinct().withColumn("p_part", _part(store.uuid_parts)))
    files = spark.createDataFrame(live, "commit string, p_part bigint, words bigint")
    # The files are of a bounded number, and each uuid meets those of its part.
    probes = asked.join(F.broadcast(files), "p_part").select("commit", "p_part", _word(F.col("words")).alias("word"), _mask().alias("need"))
    folder = index.folder(store, "words")
    paths = [f"{folder}/commit={token}" for token in sorted({token for token, _, _ in live})]
    words = spark.read.schema(_WORD + ", commit string").option("basePath", folder).parquet(*paths)
    hits = probes.join(words, ["commit", "p_part", "word"]).where(F.col("mask").bitwiseAND(F.col("need")) == F.col("need"))
    places = [(r["commit"], r["p_part"]) for r in hits.select("commit", "p_part").distinct().collect()]
    rows = _entries(store, _paths(store, index, sorted(places))).join(small_side(asked.select("uuid")), "uuid", "left_semi")
    return _newest(rows, index).where("held").select("uuid", "source", "id_data")


def _newest(entries: DataFrame, index: Index) -> DataFrame:
    rest = [c for c in entries.columns if c not in index.identity]
    newest = entries.groupBy(*index.identity).agg(F.max_by(F.struct(*rest), "version").alias("_row"))
    return newest.select(*[F.col(c) if c in index.identity else F.col(f"_row.{c}").alias(c) for c in entries.columns])


def append(store: Store, token: str, version: int, changed: DataFrame, index: Index = UUIDS) -> None:
    """Write the entries of the run that makes `version`: `uuid, held, source, id_data`.

    A uuid that the run both stores and gives up is given up.
    """
    own = [c for c in ("held", "source", "id_data") if c not in index.identity]
    rows = changed.where("uuid IS NOT NULL").groupBy(*index.identity).agg(F.min_by(F.struct(*own), "held").alias("_row"))
    entry = [F.col(c) if c in index.identity else F.col(f"_row.{c}").alias(c) for c in ("uuid", "held", "source", "id_data")]
    rows = cut(rows.select(*entry, F.lit(version).cast("bigint").alias("version"), _part(store.uuid_parts).alias("p_part")))
    touched = {r["p_part"] for r in rows.select("p_part").distinct().collect()}
    if not touched:
        return
    held: dict[int, list[tuple[str, int]]] = {}
    for other, part, _ in _live(store, version - 1, index):
        if part in touched:
            held.setdefault(part, []).append((other, part))
    merged = {part for part, files in held.items() if len(files) >= MERGE_AT}
    if merged:
        old = _entries(store, _paths(store, index, [place for part in sorted(merged) for place in held[part]]))
        known = old.withColumn("p_part", _part(store.uuid_parts)).select(rows.columns)
        # All entries of an identity lie in one part, so the part may be found anew.
        newest = _newest(rows.drop("p_part").unionByName(known.drop("p_part")), index)
        rows = cut(newest.withColumn("p_part", _part(store.uuid_parts)))
    sizes = rows.groupBy("p_part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    words = max(1, sizes * BITS // 64)
    rows.repartition("p_part").write.partitionBy("p_part").parquet(f"{index.folder(store, 'index')}/commit={token}")
    masks = rows.groupBy("p_part", _word(F.lit(words)).alias("word")).agg(F.bit_or(_mask()).alias("mask"))
    masks.write.parquet(f"{index.folder(store, 'words')}/commit={token}")
    listed = [(token, store.uuid_parts, part, words, part in merged) for part in sorted(touched)]
    store.append(store.spark.createDataFrame(listed, _PART), f"{index.name}_parts")


def changes(written: DataFrame, deleted: DataFrame) -> DataFrame:
    """Entries of a run from the raw rows it has inserted and deleted."""
    key = ["uuid", "source", "id_data"]
    new = written.where("inserted").select(*key, F.lit(True).alias("held"))
    return new.unionByName(deleted.select(*key, F.lit(False).alias("held")))


def _own_key() -> Column:
    return F.concat_ws(":", F.lit("k"), F.col("id_source").cast("string"), F.col("entity_source_pk_value"))


def fact_entries(facts: DataFrame, ids_per_range: int) -> DataFrame:
    """Entries of facts: the range of each by its uuid, and by its source and the id it has there."""
    start = F.floor(F.col("id_synthese") / F.lit(ids_per_range)) * F.lit(ids_per_range)
    keys = F.array(
        F.concat(F.lit("u:"), F.col("unique_id_sinp")), F.when(F.col("entity_source_pk_value").isNotNull(), _own_key())
    )
    rows = facts.select(
        F.explode(keys).alias("uuid"), F.lit(True).alias("held"), F.col("id_source").cast("string").alias("source"),
        start.cast("bigint").alias("id_data"),
    )
    return rows.where("uuid IS NOT NULL")


def fact_keys(uuids: DataFrame, own: DataFrame) -> DataFrame:
    """Keys under which facts are looked up: of `uuid`, and of `id_source, entity_source_pk_value`."""
    named = own.where("entity_source_pk_value IS NOT NULL").select(_own_key().alias("uuid"))
    return uuids.select(F.concat(F.lit("u:"), F.col("uuid")).alias("uuid")).unionByName(named)
