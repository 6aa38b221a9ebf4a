"""One import run over the consolidated tables.

Order of a run: split the metadata off, check the values, merge metadata, merge data,
load the star schema, apply the deletions, write the logs. Every step takes whole
tables; the driver only chains them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.operators import facts as FA
from gleanery.operators import metadata as M
from gleanery.operators.joins import join_lookup
from gleanery.operators.lineage import cut
from gleanery.operators.lookups import CodeBook
from gleanery.operators.merge import Merged, delete_by_log, upsert_data, upsert_metadata
from gleanery.operators.runlog import new_errors, run_counters
from gleanery.operators.split import first_documents, split_metadata, validate, validate_documents
from gleanery.plans.loaders import register
from gleanery.sources import holders
from gleanery.sources.snapshot import Conflict, Store

Tables = dict[str, DataFrame]


class Changes(NamedTuple):
    """What a run changed in the raw tables, for the loaders."""

    data: DataFrame
    metadata: DataFrame
    deleted: DataFrame
    now: object


class Report(NamedTuple):
    """Tables after a run, its counters and failures, and the raw rows it changed."""

    tables: Tables
    counters: DataFrame
    rejected: DataFrame
    changes: Changes
    new_errors: DataFrame
    log: DataFrame


# Layouts of the tables a run works on.
LAYOUTS = {
    "data_json": S.DATA_JSON,
    "metadata_json": S.METADATA_JSON,
    "error_log": S.ERROR_LOG,
    "import_log": S.IMPORT_LOG + ", seq bigint",
    "facts": FA.FACT,
    "sources": "id_source bigint, name_source string, additional_data string",
    "frameworks": (
        "id_acquisition_framework bigint, unique_acquisition_framework_id string,"
        " acquisition_framework_name string, acquisition_framework_desc string,"
        " acquisition_framework_start_date date, acquisition_framework_end_date date,"
        " ecologic_or_geologic_target string, id_nomenclature_financing_type bigint,"
        " id_nomenclature_territorial_level bigint, initial_closing_date timestamp_ntz,"
        " target_description string, meta_create_date timestamp_ntz, meta_update_date timestamp_ntz,"
        " additional_data string"
    ),
    "datasets": (
        "id_dataset bigint, unique_dataset_id string, id_acquisition_framework bigint,"
        " dataset_name string, dataset_shortname string, dataset_desc string, marine_domain boolean,"
        " terrestrial_domain boolean, "
        + ", ".join(f"{c.column} bigint" for c in S.DATASET_CODES)
        + ", keywords string, meta_create_date timestamp_ntz, meta_update_date timestamp_ntz,"
        " additional_data string"
    ),
    "organisms": (
        "id_organisme bigint, uuid_organisme string, nom_organisme string, email_organisme string,"
        " additional_data string"
    ),
    "roles": (
        "id_role bigint, uuid_role string, nom_role string, prenom_role string, email string,"
        " champs_addi string"
    ),
    "framework_territories": "id_acquisition_framework bigint, id_nomenclature_territory bigint",
    "framework_objectives": "id_acquisition_framework bigint, id_nomenclature_objectif bigint",
    "framework_themes": "id_acquisition_framework bigint, id_nomenclature_voletsinp bigint",
    "framework_actors": (
        "id_acquisition_framework bigint, id_organism bigint, id_role bigint,"
        " id_nomenclature_actor_role bigint"
    ),
    "dataset_territories": "id_dataset bigint, id_nomenclature_territory bigint",
    "dataset_actors": (
        "id_dataset bigint, id_organism bigint, id_role bigint, id_nomenclature_actor_role bigint"
    ),
}


# Highest number given in each numbered table; kept in the store, so that none is given twice.
SEQUENCES = "name string, last bigint"

# Tables that only grow: a run appends its rows. The import log holds the events of the runs.
ADDED = ("error_log", "import_log")


def empty_tables(spark, codes: DataFrame, areas: DataFrame) -> Tables:
    out = {name: spark.createDataFrame([], layout) for name, layout in LAYOUTS.items()}
    out["codes"], out["areas"] = codes, areas
    return out


def _added(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bridge with the wanted rows it does not hold yet (nulls compare as equal)."""
    rows = wanted.select(*[F.col(c).cast(t).alias(c) for c, t in existing.dtypes])
    return existing.unionByName(rows.subtract(existing))


def load_metadata(tables: Tables, documents: DataFrame, now) -> Tables:
    """Load framework and dataset documents that were not known before.

    Only first insertions count: later versions of a document change nothing here.
    `documents` has the stored columns and `seq`.
    """
    book = CodeBook(tables["codes"])
    out = dict(tables)
    key_af, key_ds = "id_acquisition_framework", "id_dataset"

    def opened(level: str, layout: str, uuid: str) -> DataFrame:
        # Rows, bridges and actors are all made from the documents: taken apart once and written.
        docs = M.open_documents(documents.where(F.col("level") == level), layout)
        return cut(docs.select("source", "seq", "doc", M.text.clean_uuid(F.col("doc.uuid")).alias(uuid)))

    # Frameworks first: datasets refer to them.
    af_docs = opened(S.LEVEL_FRAMEWORK, S.FRAMEWORK_DOC, "unique_acquisition_framework_id")
    grown = M.get_or_insert(
        tables["frameworks"], M.framework_rows(af_docs, book, now), "unique_acquisition_framework_id", key_af, ["seq"]
    )
    out["frameworks"] = grown.rows
    new_af = af_docs.join(
        grown.added.select("unique_acquisition_framework_id", key_af), "unique_acquisition_framework_id"
    )
    for name, list_type, column, absent, out_column in (
        ("framework_territories", S.TERRITORY_TYPE, "territories", S.DEFAULT_TERRITORY, "id_nomenclature_territory"),
        ("framework_objectives", S.OBJECTIVE_TYPE, "objectives", S.DEFAULT_OBJECTIVE, "id_nomenclature_objectif"),
        ("framework_themes", S.THEME_TYPE, "voletsinp", S.DEFAULT_THEME, "id_nomenclature_voletsinp"),
    ):
        values = M.codes_of(column)
        if column == "voletsinp":
            # The export calls the themes by another name than the import.
            values = F.coalesce(values, M.codes_of("sinp_theme"))
        rows = M.code_bridge(new_af, book, list_type, key_af, values, out_column, when_absent=absent)
        out[name] = _added(tables[name], rows)

    ds_docs = opened(S.LEVEL_DATASET, S.DATASET_DOC, "unique_dataset_id")
    grown_ds = M.get_or_insert(
        tables["datasets"], M.dataset_rows(ds_docs, out["frameworks"], book, now), "unique_dataset_id", key_ds, ["seq"]
    )
    out["datasets"] = grown_ds.rows
    new_ds = ds_docs.join(grown_ds.added.select("unique_dataset_id", key_ds), "unique_dataset_id")
    rows = M.code_bridge(
        new_ds, book, S.TERRITORY_TYPE, key_ds, M.codes_of("territories"), "id_nomenclature_territory",
        when_null=S.DEFAULT_TERRITORY,
    )
    out["dataset_territories"] = _added(tables["dataset_territories"], rows)

    # Numbered twice and joined twice below: listed once and written.
    af_actors = cut(M.actor_rows(new_af, [key_af, "source", "seq"]))
    ds_actors = cut(M.actor_rows(new_ds, [key_ds, "source", "seq"]))
    both = af_actors.drop(key_af).unionByName(ds_actors.drop(key_ds))
    people = M.get_or_create_actors(tables["organisms"], tables["roles"], both, ["seq", "pos"])
    out["organisms"], out["roles"] = people.organisms.rows, people.roles.rows
    out["framework_actors"] = _added(tables["framework_actors"], M.actor_bridge(af_actors, people, book, key_af))
    out["dataset_actors"] = _added(tables["dataset_actors"], M.actor_bridge(ds_actors, people, book, key_ds))
    return out


def _raised(sequences: DataFrame | None, facts: DataFrame) -> DataFrame:
    """The highest numbers, also over some facts."""
    given = facts.select(F.lit("facts").alias("name"), F.col("id_synthese").alias("last"))
    given = given if sequences is None else given.unionByName(sequences)
    return given.groupBy("name").agg(F.max("last").alias("last"))


@register("star_schema")
def load_star(tables: Tables, changes: Changes) -> Tables:
    """Load documents, then facts, then take out the facts of deleted rows."""
    now = changes.now
    out = load_metadata(tables, changes.metadata.where("inserted"), now)
    last_id = tables["sequences"].where("name = 'facts'").select("last") if "sequences" in tables else None
    loaded = FA.load_facts(
        changes.data, out["facts"], out["sources"], out["frameworks"], out["datasets"],
        CodeBook(out["codes"], tuple(c.list_type for c in (*S.CODES, S.BIOGEO))), out["areas"], now, last_id=last_id,
    )
    if last_id is not None:
        out["sequences"] = _raised(tables["sequences"], loaded.written)
    out["sources"] = loaded.sources.rows
    out["frameworks"], out["datasets"] = loaded.frameworks.rows, loaded.datasets.rows
    out["facts"] = FA.delete_facts(loaded.facts, changes.deleted, out["sources"])
    return out


def run_import(
    tables: Tables,
    arrivals: DataFrame,
    now,
    deletions: DataFrame | None = None,
    loader=load_star,
    keep_metadata_of_rejected: bool = True,
    holders: DataFrame | None = None,
) -> Report:
    """Apply arrivals (and then deletions) of one or more runs to the tables.

    `arrivals` comes from `sources.landing.arrivals`; `deletions` has
    `source, id_data, import_id`. The inputs that several steps read are written once
    to the checkpoint folder, the arrivals first: their lines are numbered as they are read.
    `holders` gives the uuids in use where the raw table is only a part of the stored one.
    """
    return _import(tables, cut(arrivals), now, deletions, loader, keep_metadata_of_rejected, holders)


def _import(
    tables: Tables, arrivals: DataFrame, now, deletions=None, loader=load_star, keep_metadata_of_rejected=True, holders_of=None,
    facts_of: Callable[[Changes], DataFrame] | None = None,
) -> Report:
    """The import of arrivals that are written; `facts_of` gives the facts that the changes may concern."""
    out = dict(tables)
    slim, _ = split_metadata(arrivals)
    documents = first_documents(arrivals, ["source", "import_id"])
    good, bad = validate(slim)
    if not keep_metadata_of_rejected:
        # The first document of an accepted item counts then.
        accepted = arrivals.join(good.select("seq"), "seq", "left_semi")
        documents = first_documents(accepted, ["source", "import_id"])
    documents = documents.withColumn("controler", F.lit(S.CONTROLER_METADATA))
    nameless = documents.where("uuid IS NULL")
    documents, faulty = validate_documents(documents.where("uuid IS NOT NULL"))

    meta = upsert_metadata(tables["metadata_json"], documents)
    meta = Merged(meta.state, cut(meta.written), meta.rejected)
    data = upsert_data(tables["data_json"], good, holders=holders_of)
    data = Merged(data.state, cut(data.written), cut(data.rejected))
    out["metadata_json"] = meta.state

    if deletions is not None:
        kept, gone = delete_by_log(data.state, deletions)
        gone = cut(gone)
    else:
        kept, gone = data.state, data.state.limit(0)
    out["data_json"] = kept

    failures = _failures(bad, "error").unionByName(_failures(faulty, "error")).unionByName(
        _failures(data.rejected.withColumn("error", F.lit("uuid already held by another row")), "error")
    )
    failures = failures.unionByName(
        _failures(meta.rejected.withColumn("error", F.lit("uuid already held by another source")), "error")
    ).unionByName(_failures(nameless.withColumn("error", F.lit("document without uuid")), "error"))
    fresh = cut(new_errors(tables["error_log"], failures))
    out["error_log"] = tables["error_log"].unionByName(fresh)

    changes = Changes(data.written, meta.written, gone, now)
    if loader is not None:
        if facts_of is not None:
            out["facts"] = facts_of(changes)
        out = loader(out, changes)

    def counted(rows: DataFrame, outcome: str, n=None) -> DataFrame:
        amount = F.count(F.lit(1)) if n is None else F.sum(n)
        return rows.groupBy("source", "import_id").agg(amount.cast("bigint").alias("n")).withColumn(
            "outcome", F.lit(outcome)
        )

    outcomes = counted(good, "api_count_items")
    for rows, name, n in (
        (bad, "api_count_items", None),
        (data.written, "data_count_upserts", "writes"),
        (bad, "data_count_errors", None),
        (data.rejected, "data_count_errors", None),
        (meta.written, "metadata_count_upserts", "writes"),
        (meta.rejected, "metadata_count_errors", None),
        (faulty, "metadata_count_errors", None),
        (nameless, "metadata_count_errors", None),
    ):
        outcomes = outcomes.unionByName(counted(rows, name, n))
    if deletions is not None:
        runs = deletions.groupBy("source").agg(F.max("import_id").alias("import_id"))
        removed = join_lookup(gone.select("source", "id_data"), runs, ["source"], "inner")
        outcomes = outcomes.unionByName(counted(removed, "data_count_delete"))
    log = fresh.sparkSession.createDataFrame([], LAYOUTS["import_log"])
    return Report(out, run_counters(outcomes), failures, changes, fresh, log)


def open_tables(
    store: Store, codes: DataFrame | None, areas: DataFrame | None, touched: DataFrame | None = None, version: int | None = None
) -> Tables:
    """Tables of the newest (or of a given) version of a store; of the raw table only the touched ranges, if given."""
    version = store.version() if version is None else version
    out = {}
    for name, layout in LAYOUTS.items():
        if name in store.ranged_by:
            ranges = touched if name == "data_json" else None
            out[name] = store.read_ranged(name, layout, ranges, version)
        elif name in ADDED:
            out[name] = store.read_added(name, layout, version)
        else:
            out[name] = store.read(name, layout, version)
    out["codes"], out["areas"] = codes, areas
    sequences = store.read("sequences", SEQUENCES, version)
    if not sequences.isEmpty():
        out["sequences"] = sequences
    return out


def facts_for(store: Store, tables: Tables, changes: Changes, version: int) -> DataFrame:
    """Stored facts in the ranges that changes of raw rows may concern.

    These are the ranges of facts with a uuid of a written row or the own id of a deleted one, by the
    index, and the range that the next new fact of a source falls into. All facts, for a store
    without an index.
    """
    if "sequences" not in tables or not holders.indexed(store, version, holders.FACTS):
        return tables["facts"]
    own = FA.deleted_keys(changes.deleted, tables["sources"])
    wanted = holders.fact_keys(changes.data.select("uuid").distinct(), own)
    hits = holders.find(store, wanted, version, holders.FACTS)
    spots = hits.select(F.col("source").alias("id_source"), F.col("id_data").alias("id_synthese"))
    named = changes.data.select(F.col("source").alias("name_source")).distinct()
    growing = join_lookup(named, tables["sources"].select("name_source", "id_source"), ["name_source"], "inner")
    following = tables["sequences"].where("name = 'facts'").first()["last"] + 1
    growing = growing.select(F.col("id_source").cast("string"), F.lit(following).cast("bigint").alias("id_synthese"))
    touched = cut(store.touched(spots, growing, name="facts"))
    return store.read_ranged("facts", FA.FACT, touched, version)


def save_run(
    store: Store, run_id: str, before: Tables, report: Report, added: dict[str, DataFrame] | None = None,
    base: int | None = None, ranged: dict | None = None,
) -> int:
    """Write the tables of a run as the version after `base`; a run already there is skipped.

    Of the raw table and of the facts only the ranges with changed rows are written, and
    logs get their new rows, as do further tables by `added`. A table the run has not touched
    is left as it is.
    """
    if store.has_run(run_id):
        return store.version()
    changes = report.changes
    base = store.version() if base is None else base
    raw = cut(store.touched(changes.data, changes.deleted))
    ranged = {"data_json": (store.within(report.tables["data_json"], raw, "data_json"), raw)} | (ranged or {})
    fact_entries, sequences = None, {}
    if report.tables["facts"] is not before["facts"]:
        uuids = changes.data.select(F.col("uuid").alias("unique_id_sinp")).where("unique_id_sinp IS NOT NULL")
        new = report.tables["facts"]
        ids = ["id_source", "id_synthese"]
        gone = before["facts"].select(*ids).join(new.select(*ids), ids, "left_anti")
        keys = new.select("unique_id_sinp", "entity_source_pk_value", *ids)
        changed = cut(keys.join(uuids, "unique_id_sinp", "left_semi"))
        facts = cut(store.touched(changed, gone, name="facts"))
        ranged["facts"] = (store.within(new, facts, "facts"), facts)
        # Facts that were written before there was an index are indexed once.
        known = "sequences" in before and holders.indexed(store, base, holders.FACTS)
        fact_entries = holders.fact_entries(changed if known else keys, store.ids_per_range)
        top = cut(_raised(report.tables.get("sequences"), changed if known else keys))
        if not top.isEmpty():
            sequences["sequences"] = top
    whole = {
        name: report.tables[name]
        for name in LAYOUTS
        if name not in store.ranged_by and name not in ADDED and report.tables[name] is not before[name]
    }
    logs = {"error_log": report.new_errors, "import_log": report.log} | (added or {})
    held = holders.changes(changes.data, changes.deleted)
    if base and not holders.indexed(store, base):
        # Written before there was an index: all of it is indexed once.
        stored = store.read_ranged("data_json", S.DATA_JSON, version=base)
        held = held.unionByName(stored.join(changes.deleted.select("uuid"), "uuid", "left_anti").select("uuid", "source", "id_data", F.lit(True).alias("held")))

    def beside(token: str, version: int) -> None:
        holders.append(store, token, version, held)
        if fact_entries is not None:
            holders.append(store, token, version, fact_entries, holders.FACTS)

    return store.write(run_id, whole | sequences, ranged, logs, base, beside)


def import_into_store(
    store: Store,
    run_id: str,
    arrivals: DataFrame,
    now,
    codes: DataFrame | None = None,
    areas: DataFrame | None = None,
    deletions: DataFrame | None = None,
    loader=load_star,
    log: Callable[[DataFrame], DataFrame] | None = None,
    added: dict[str, DataFrame] | None = None,
    base: int | None = None,
) -> Report | None:
    """Import arrivals into a store as one run; None if the run is there already.

    Raw rows and facts are read and rewritten only in the ranges that the arrivals and deletions
    concern; holders of their uuids, and the ranges of their facts, come from an index. The tables of
    the report hold these ranges only. A run that another writer overtakes
    starts again, unless its version `base` is given: then it raises `Conflict`. Every arrival is stored, superseded or in the error log. `log` makes the
    events for the import log from the counters; `added` are rows for further tables that only
    grow, written with the run.
    """
    rows = cut(arrivals)

    def once(version: int) -> Report:
        return _import_version(store, run_id, rows, now, codes, areas, deletions, loader, log, added, version)

    return attempts(store, run_id, once) if base is None else once(base)


#: Starts of a run that other writers overtake.
ATTEMPTS = 5


def attempts(store: Store, run_id: str, once: Callable[[int], Report]) -> Report | None:
    """Run from the newest version, again if another writer was faster; None if the run is there."""
    for attempt in range(ATTEMPTS):
        if store.has_run(run_id):
            return None
        try:
            return once(store.version())
        except Conflict:
            if attempt + 1 == ATTEMPTS:
                raise
    return None


#: Last deletion of every key that a log has named.
TOMBSTONE = "source string, id_data bigint, at timestamp_ntz, import_id bigint"


def _changed(rows: DataFrame) -> DataFrame:
    at = F.get_json_object("item", f"$.{S.CHANGED_AT}").try_cast("timestamp_ntz")
    return rows.withColumn("_changed", at)


def _buried(rows: DataFrame, tombstones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Arrivals that no deletion has overtaken, and those older than the deletion of their key.

    Where an item does not say when it was changed, the order of the deliveries decides.
    """
    graves = tombstones.select("source", "id_data", "at", F.col("import_id").alias("_last"))
    joined = _changed(rows).join(graves, ["source", "id_data"], "left")
    older = F.when(F.col("_changed").isNotNull() & F.col("at").isNotNull(), F.col("_changed") <= F.col("at")).otherwise(
        F.col("import_id") < F.col("_last")
    )
    told = cut(joined.withColumn("_older", F.coalesce(older, F.lit(False))))
    return told.where("NOT _older").select(*rows.columns), told.where("_older").select(*rows.columns)


def _import_version(
    store: Store, run_id: str, rows: DataFrame, now, codes, areas, deletions, loader, log, added, version: int
) -> Report:
    """One start of an import.

    Deletions that say when they happened (`at`) leave later rows alone and keep earlier ones out
    from then on; plain deletions apply as they are.
    """
    named = rows.where("id_data IS NOT NULL").select("source", "id_data")
    touched = cut(store.touched(named, *([deletions] if deletions is not None else [])))
    tables = open_tables(store, codes, areas, touched, version)
    ranged, late = {}, None
    graves = store.read_ranged("tombstones", TOMBSTONE, touched, version)
    if deletions is not None and "at" in deletions.columns:
        dated = deletions.select("source", "id_data", "at", "import_id")
        graves = cut(graves.unionByName(dated).groupBy("source", "id_data").agg(F.max("at").alias("at"), F.max("import_id").alias("import_id")))
        spots = cut(store.touched(dated, name="tombstones"))
        ranged["tombstones"] = (store.within(graves, spots, "tombstones"), spots)
        rows, late = _buried(rows, graves)
        # A row that was changed after the deletion stays.
        newer = _changed(tables["data_json"].select("source", "id_data", "item")).join(graves, ["source", "id_data"]).where(F.col("_changed") > F.col("at"))
        deletions = deletions.join(newer.select("source", "id_data"), ["source", "id_data"], "left_anti")
        deletions = cut(deletions.join(rows.select("source", "id_data").distinct(), ["source", "id_data"], "left_anti"))
    elif not graves.isEmpty():
        rows, late = _buried(rows, graves)
    wanted = rows.where("uuid IS NOT NULL").select("uuid").distinct()
    known = holders.find(store, wanted, version)
    if known is None:
        known = store.read_ranged("data_json", S.DATA_JSON, version=version).join(wanted, "uuid", "left_semi")

    def facts_of(changes: Changes) -> DataFrame:
        tables["facts"] = facts_for(store, tables, changes, version)
        return tables["facts"]

    report = _import(tables, rows, now, deletions, loader, holders_of=known.select("uuid"), facts_of=facts_of)
    if late is not None:
        passed = _failures(late.withColumn("error", F.lit("older than its deletion")), "error")
        report = report._replace(new_errors=report.new_errors.unionByName(cut(new_errors(tables["error_log"], passed))))
    if log is not None:
        report = report._replace(log=log(report.counters))
    save_run(store, run_id, tables, report, added, version, ranged)
    return report


def _failures(rows: DataFrame, error: str) -> DataFrame:
    return rows.select(
        "source", "uuid", "controler", F.col("update_ts").alias("last_ts"), "item",
        F.col(error).alias("error"), "import_id", "seq",
    )
