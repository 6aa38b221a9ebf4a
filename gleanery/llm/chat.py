"""Chat formatting: tool calls linked to their results, ordered, checked and written as canonical JSON.

Calls and results are joined by conversation and call identifier. Calls name the calls they need;
they are put into an order that follows those needs and otherwise the transcript. A call whose needs
all stand before it keeps its place without further work. Only conversations in which some
call needs a later one are ordered by relaxation: the place of a call becomes the greatest place among
itself and all it needs, ties following depth, step by step until nothing changes. So no
conversation has to fit into one task. Arguments are validated against the tool's schema, and every
call is written as one line of JSON with sorted keys and no white space.

Defined results: a call without result has status `unanswered`, a result without call does not
appear as a call but is returned by `orphans`; of several results of a call the first by position
counts, as of several calls of one identifier; needs that name no call of the conversation are
ignored; calls that need each other in a circle, and those that need them, have no order and the
status `circular`; arguments that are null, no JSON object or against the schema are `invalid`, with
the faults listed; a call without conversation or identifier links with nothing: `link_calls`
leaves it out, and `keyless` returns it, copy by copy, with the status `unanswered`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import picked, written

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def faults(value: object, schema: dict, at: str = "$") -> list[str]:
    """What in a value is against a schema of type, required, properties, items, enum and bounds."""
    wanted = schema.get("type")
    wanted = [wanted] if isinstance(wanted, str) else wanted
    if wanted and not any(isinstance(value, _TYPES[t]) and (t == "boolean" or not isinstance(value, bool)) for t in wanted):
        return [f"{at}: not {' or '.join(wanted)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{at}: below minimum")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{at}: above maximum")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(set(value) - set(own))]
        for k in sorted(set(own) & set(value)):
            out += faults(value[k], own[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += faults(x, schema["items"], f"{at}[{i}]")
    return out


def canonical(value: object) -> str:
    """JSON with sorted keys, no white space, and characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def ordered(calls: DataFrame) -> DataFrame:
    """Calls (conv, id, place, needs) with `at` and `depth`, null in circles: sort by at, depth, place."""
    needs = calls.select("conv", F.col("id").alias("by"), F.col("place").alias("by_place"), F.explode("needs").alias("id")).distinct()
    edges = needs.join(calls.select("conv", "id", "place"), ["conv", "id"]).select("conv", "by", "by_place", F.col("id").alias("needed"), "place")
    late = edges.where(F.col("place") >= F.col("by_place")).select("conv").distinct()
    late = written(late)
    if late.isEmpty():
        return calls.withColumns({"at": F.col("place"), "depth": F.lit(0)})
    odd = calls.join(late, "conv", "left_semi")
    edges = written(edges.join(late, "conv", "left_semi").select("conv", "by", "needed"))
    place = _relaxed(odd.select("conv", "id", F.col("place").alias("at"), F.lit(0).alias("depth")), edges)
    placed = odd.join(place, ["conv", "id"], "left").withColumn("needs", F.col("needs"))
    plain = calls.join(late, "conv", "left_anti").withColumns({"at": F.col("place"), "depth": F.lit(0)})
    return plain.unionByName(placed.select(*plain.columns))


def _relaxed(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv, id, at, depth) of the nodes that are in no circle and need none.

    Nodes leave in waves: those whose needs have all left take the greatest place among
    themselves and their needs. What never leaves is in a circle or behind one.
    """
    waiting, left, done = written(nodes), edges, None
    while True:
        blocked = left.select("conv", F.col("by").alias("id")).distinct()
        free = written(waiting.join(blocked, ["conv", "id"], "left_anti"))
        if free.isEmpty():
            return done if done is not None else free
        done = free if done is None else done.unionByName(free)
        cleared = left.join(free.withColumnRenamed("id", "needed"), ["conv", "needed"])
        most = cleared.groupBy("conv", F.col("by").alias("id")).agg(F.max(F.struct("at", (F.col("depth") + 1).alias("depth"))).alias("m"))
        rest = waiting.join(free, ["conv", "id"], "left_anti").join(most, ["conv", "id"], "left")
        best = F.greatest(F.struct("at", "depth"), F.col("m"))
        waiting = written(rest.select("conv", "id", best["at"].alias("at"), best["depth"].alias("depth")))
        left = written(left.join(free.select("conv", F.col("id").alias("needed")), ["conv", "needed"], "left_anti").select("conv", "by", "needed"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, in an order that its needs allow, with its result and canonical line.

    calls: conv, id, place, name, arguments (JSON), needs (array of ids);
    results: conv, id, place, content. Columns beyond these are ignored.
    """
    named = picked(calls, conv="conv", id="id", place="place", name="name", arguments="arguments", needs="needs")
    body = F.struct("place", "name", "arguments", "needs")
    keyed = named.where(F.col("conv").isNotNull() & F.col("id").isNotNull())
    single = keyed.groupBy("conv", "id").agg(F.min(body).alias("c")).select("conv", "id", "c.*")
    single = single.withColumn("needs", F.coalesce("needs", F.array().cast("array<string>")))
    answers = picked(results, conv="conv", id="id", place="place", content="content").where(F.col("conv").isNotNull() & F.col("id").isNotNull())
    answers = answers.groupBy("conv", "id").agg(F.min(F.struct("place", "content")).alias("r"))
    linked = ordered(written(single)).join(answers, ["conv", "id"], "left")
    linked = linked.withColumns({"answered": F.col("r").isNotNull(), "content": F.col("r.content")}).drop("r")
    return _lines(linked, schemas)


def keyless(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call without conversation or identifier, in the columns of `link_calls`.

    Nothing can answer such a call or be needed by it: it stands at its own place, `unanswered`,
    whatever its arguments, whose faults are listed all the same.
    """
    named = picked(calls, conv="conv", id="id", place="place", name="name", arguments="arguments", needs="needs")
    alone = named.where(F.col("conv").isNull() | F.col("id").isNull())
    alone = alone.withColumn("needs", F.coalesce("needs", F.array().cast("array<string>")))
    alone = alone.withColumns({"at": F.col("place"), "depth": F.lit(0), "answered": F.lit(False), "content": F.lit(None).cast("string")})
    return _lines(alone, schemas).withColumn("status", F.lit("unanswered"))


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results that answer no call."""
    return results.join(picked(calls, conv="conv", id="id").distinct(), ["conv", "id"], "left_anti")


def _lines(linked: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    columns = linked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_line(r, schemas) for r in batch.to_pylist()]
            extra = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.list_(pa.string()), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*columns, "status", "faults", "line"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in linked.schema)
    return linked.mapInArrow(run, f"{kinds}, status string, faults array<string>, line string")


def _line(row: dict, schemas: dict[str, dict]) -> tuple[str, list[str], str]:
    try:
        value = json.loads(row["arguments"] or "")
    except ValueError:
        value, found = row["arguments"], ["$: no JSON"]
    else:
        found = faults(value, {"type": "object"} | schemas[row["name"]]) if row["name"] in schemas else ["$: unknown tool"]
    status = "circular" if row["at"] is None else "invalid" if found else "unanswered" if not row["answered"] else "linked"
    line = {"arguments": value, "id": row["id"], "name": row["name"]}
    if row["answered"]:
        line["result"] = row["content"]
    return status, found, canonical(line)


# ---- the given conversations: every assistant turn asks a tool, the next turn answers it

#: What the derived calls must look like.
SCHEMAS = {
    "search": {
        "required": ["query", "words"],
        "properties": {"query": {"type": "string"}, "words": {"type": "integer", "minimum": 1, "maximum": 400}},
        "additionalProperties": False,
    },
    "lookup": {
        "required": ["query", "words", "exact"],
        "properties": {"query": {"type": "string"}, "words": {"type": "integer", "minimum": 1}, "exact": {"type": "boolean"}},
        "additionalProperties": False,
    },
}


def derived_calls(turns: DataFrame, brief: bool = False, with_text: bool = False) -> DataFrame:
    """Assistant turns as calls: the first turns search; later ones look up.

    Their query is the whole text; if `brief`, what stands before its first full stop. What a call
    needs follows from its text: by the number of its words modulo three nothing, the call before, or
    the call after. So calls need later ones, and two neighbours can need each other.
    """
    rows = picked(turns, conv="conv_id", turn="turn", role="role", text="text").where("role = 'assistant'")
    text = F.coalesce("text", F.lit(""))
    first = F.col("turn") < 3
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    query = F.substring_index(text, ".", 1) if brief else text
    searched = F.to_json(F.struct(words.alias("words"), query.alias("query")))
    looked_up = F.to_json(F.struct((words < 60).alias("exact"), words.alias("words"), query.alias("query")))
    call = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    needs = F.when(words % 3 == 1, F.array(call(F.col("turn") - 2))).when(words % 3 == 2, F.array(call(F.col("turn") + 2)))
    return rows.select(
        "conv",
        call(F.col("turn")).alias("id"),
        F.col("turn").alias("place"),
        F.when(first, "search").otherwise("lookup").alias("name"),
        F.when(first, searched).otherwise(looked_up).alias("arguments"),
        F.coalesce(needs, F.array().cast("array<string>")).alias("needs"),
        *(["text"] if with_text else []),
    )


def _beyond_first(rows: DataFrame, order: list[str]) -> DataFrame:
    """All rows of a (conv, id) but the first in this order, copy by copy; copies are counted before they meet."""
    body = F.struct(*order)
    counted = rows.groupBy("conv", "id", *order).agg(F.count("*").alias("n"))
    first = counted.groupBy("conv", "id").agg(F.min(body).alias("first"))
    left = counted.join(first, ["conv", "id"]).withColumn("n", F.col("n") - body.eqNullSafe(F.col("first")).cast("int"))
    return left.where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))


def repeats(turns: DataFrame) -> DataFrame:
    """Turns (conv, place, role, content) that a call or its result stands for already.

    Of several turns of one number the first by content is the call, or the result; these are the others.
    """
    calls = derived_calls(turns, with_text=True).where(F.col("conv").isNotNull() & F.col("id").isNotNull())
    again = _beyond_first(calls, ["place", "name", "arguments", "needs", "text"])
    again = again.select("conv", "place", F.lit("assistant").alias("role"), F.col("text").alias("content"))
    answers = derived_results(turns).join(calls.select("conv", "id").distinct(), ["conv", "id"], "left_semi")
    return again.unionByName(_beyond_first(answers, ["place", "content", "role"]).select("conv", "place", "role", "content"))


def derived_results(turns: DataFrame) -> DataFrame:
    """The turn behind an assistant turn as its result; a turn without role is none of an assistant."""
    rows = picked(turns, conv="conv_id", turn="turn", role="role", text="text").where("role is null or role <> 'assistant'")
    id_ = F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string")).alias("id")
    return rows.select("conv", id_, F.col("turn").alias("place"), F.col("text").alias("content"), "role")


def _reported(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("conv").alias("conv_id"),
        F.col("id").alias("call_id"),
        F.col("at").alias("order_at"),
        F.col("depth").alias("order_depth"),
        "name",
        "status",
        F.array_join("faults", "; ").alias("faults"),
        "line",
    )


def report(turns: DataFrame) -> DataFrame:
    """One row per call of the conversations, with brief queries and without the other turns."""
    return _reported(link_calls(derived_calls(turns, brief=True), derived_results(turns), SCHEMAS))


def transcript(turns: DataFrame) -> DataFrame:
    """The whole conversations: a row per call (kind `call`), and one per turn that belongs to none (`orphan`).

    The line of an orphan holds its role and its whole text; it stands at its own place, as does a
    further turn of a number that a call or result has (`repeat`). So every turn is in the line of a
    call, once, or has a row of its own. Assistant turns without conversation or number are calls that
    nothing answers.
    """
    calls, results = derived_calls(turns), derived_results(turns)
    found = link_calls(calls, results, SCHEMAS)
    called = _reported(found.unionByName(keyless(calls, SCHEMAS).select(*found.columns))).withColumn("kind", F.lit("call"))
    return called.unionByName(_turn_lines(orphans(calls, results), "orphan")).unionByName(_turn_lines(repeats(turns), "repeat"))


def _turn_lines(left: DataFrame, kind: str) -> DataFrame:
    """Turns (conv, place, role, content) in the columns of the transcript."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [canonical({"role": r, "text": t}) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lines, pa.string())], ["conv", "place", "name", "line"])

    rows = left.select("conv", "place", "role", "content")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "place")}
    lined = rows.mapInArrow(run, f"conv {kinds['conv']}, place {kinds['place']}, name string, line string")
    return lined.select(
        F.col("conv").alias("conv_id"),
        F.lit(None).cast("string").alias("call_id"),
        F.col("place").alias("order_at"),
        F.lit(0).alias("order_depth"),
        "name",
        F.lit(kind).alias("status"),
        F.lit("").alias("faults"),
        "line",
        F.lit(kind).alias("kind"),
    )
