"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Candidates are the matches of the base patterns (assignments, access keys, long hex runs) and long
tokens that mix cases and digits. The hash of every candidate value is aggregated over the corpus
by distinct repositories and owners. A value that many owners hold, or that is in many repositories
of few owners, is a copied example; one that stays with few is owner-specific and looks live. Live-looking
tokens are added as spans of their own kind; base spans always stay, and are told apart by the
same frequency.

Positions follow from the matches and what stands between them, in code points, by sums within
runs of matches and then over the runs, so that a text of many matches is not copied for each. The
candidates of a text are found in one projection; only they are shuffled. Copies of a value collapse before the shuffle (distinct
by hash, repository and owner, with partial aggregation), and the join of candidates with
the frequencies is one that the adaptive planner splits where a value is hot.

Defined results: a null text counts as empty; null owners and repositories count as one unknown
each; repeated documents give a row each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import picked, written

# The base patterns, in the order in which they are listed.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Long tokens; those with both cases and a digit are candidates.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "live")
#: From so many owners on, a value is a copied example.
EXAMPLE_OWNERS = 3
#: From so many repositories on, whatever their owners, it is one as well.
EXAMPLE_REPOSITORIES = 4
#: Matches whose positions are summed up together.
RUN = 128

_FOUND = "array<struct<start:int,kind:int,end:int,hash:bigint>>"


def _matches(text: Column, pattern: str, kind: int, value_group: int, keep) -> Column:
    """Start, kind, end and hash of the value of every match that `keep` passes."""
    whole = F.expr(f"regexp_extract_all(_text, {_quoted(pattern)}, 0)")
    value = F.expr(f"regexp_extract_all(_text, {_quoted(pattern)}, {value_group})")
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    none = F.array().cast(_FOUND)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["0"])
        end = start + F.length(x["1"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.xxhash64(x["2"]).alias("hash"))
        return F.struct(end.alias("at"), F.when(keep(x["2"]), F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    def found(run: Column, at: Column) -> Column:
        return F.aggregate(run, F.struct(at.alias("at"), none.alias("out")), step)

    runs = _runs(F.arrays_zip(between, whole, value))
    return F.when(text.rlike(pattern), _run_by_run(runs, found, "at", f"array<struct<at:int,out:{_FOUND}>>")).otherwise(none)


def _once(value: Column, use) -> Column:
    """What `use` makes of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _runs(matches: Column) -> Column:
    """The array in runs of `RUN` elements."""

    def cut(held: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(held) - 1) / RUN).cast("int"))
        return F.when(F.size(held) > 0, F.transform(starts, lambda r: F.slice(held, r * RUN + 1, F.lit(RUN)))).otherwise(F.array())

    return _once(matches, cut)


def _run_by_run(runs: Column, found, at: str, kind: str) -> Column:
    """What `found` makes of every run, from where the run before has ended, in one array."""
    last = lambda done: F.coalesce(F.get(done, F.size(done) - 1)[at], F.lit(0))
    done = F.aggregate(runs, F.array().cast(kind), lambda acc, run: F.concat(acc, F.array(found(run, last(acc)))))
    return F.flatten(F.transform(done, lambda d: d["out"]))


def _quoted(pattern: str) -> str:
    escaped = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def candidates(text: Column) -> Column:
    """All candidates of the column `_text`, kind by kind."""
    every = lambda v: F.lit(True)
    mixed = lambda v: v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9]")
    return F.concat(
        _matches(text, ASSIGN, 0, 2, lambda v: F.length(v) >= ASSIGN_VALUE),
        _matches(text, ACCESS, 1, 0, every),
        _matches(text, HEX, 2, 0, every),
        _matches(text, TOKEN, 3, 0, mixed),
    )


def find_secrets(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "lang", example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """The given row as `_doc`, and `_spans`: array of (start, kind, end, example, owners, repositories), in order.

    A repository is named by owner and repository column. `text` must be a column of `docs`;
    it is read but need not be kept by the caller.
    """
    names = [c for c in docs.columns]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"),
        F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("_owner"),
        F.coalesce(F.col(f"`{repository}`").cast("string"), F.lit("")).alias("_repository"),
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    rows = written(rows.withColumn("_found", candidates(F.col("_text"))).drop("_text"))
    return _spans_of(rows, example_owners, example_repositories)


def _spans_of(rows: DataFrame, example_owners: int, example_repositories: int) -> DataFrame:
    kind = "array<struct<start:int,kind:int,end:int,example:boolean,owners:bigint,repositories:bigint>>"
    with_some = rows.where(F.size("_found") > 0)
    held = with_some.select("_row", "_owner", "_repository", F.explode("_found").alias("c")).select("_row", "_owner", "_repository", "c.*")
    owners = (
        held.select("hash", "_owner", "_repository")
        .distinct()
        .groupBy("hash", "_owner")
        .agg(F.count("*").alias("n"))
        .groupBy("hash")
        .agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    )
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    told = held.join(owners, "hash").withColumn("example", copied)
    kept = told.where((F.col("kind") < 3) | ~F.col("example"))
    spans = kept.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "example", "owners", "repositories"))).alias("_spans"))
    empty = F.array().cast(kind)
    found = with_some.join(spans, "_row", "left").withColumn("_spans", F.coalesce(F.col("_spans"), empty))
    none = rows.where(F.size("_found") == 0).withColumn("_spans", empty)
    return found.select("_doc", "_spans").unionByName(none.select("_doc", "_spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _count(spans: Column, test) -> Column:
    return F.size(F.filter(spans, test)).cast("long")


def _most(spans: Column, member: str) -> Column:
    return F.coalesce(F.array_max(F.transform(spans, lambda s: s[member])), F.lit(0)).cast("long")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "lang") -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans.

    `most_owners` and `most_repositories` are those of its most widely held value, 0 without one.
    """
    rows = picked(docs, doc_id=key, text=text, owner=owner, repository=repository)
    rows = written(
        rows.select(
            F.struct("doc_id").alias("_doc"),
            F.coalesce(F.col("owner").cast("string"), F.lit("")).alias("_owner"),
            F.coalesce(F.col("repository").cast("string"), F.lit("")).alias("_repository"),
            F.monotonically_increasing_id().alias("_row"),
            F.coalesce("text", F.lit("")).alias("_text"),
        )
        .withColumn("_found", candidates(F.col("_text")))
        .drop("_text")
    )
    spans = F.col("_spans")
    return _spans_of(rows, EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES).select(
        F.col("_doc.doc_id").alias("doc_id"),
        _count(spans, lambda s: s["kind"] == 0).alias("n_assign"),
        _count(spans, lambda s: s["kind"] == 1).alias("n_access"),
        _count(spans, lambda s: s["kind"] == 2).alias("n_hex"),
        F.sha2(_listed(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        _count(spans, lambda s: s["kind"] == 3).alias("n_live"),
        _count(spans, lambda s: s["example"]).alias("n_example"),
        _most(spans, "owners").alias("most_owners"),
        _most(spans, "repositories").alias("most_repositories"),
    )


def mask(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "lang", by: str = "[SECRET]") -> DataFrame:
    """Replace every span by a placeholder, spans that overlap by one; columns as given."""
    found = find_secrets(docs, text, owner, repository)
    body = F.col("_doc")[text]
    spans = F.col("_spans")
    last = F.array_max(F.transform(spans, lambda s: s["end"]))

    def masked(part) -> Column:
        def step(acc: Column, s: Column) -> Column:
            after = F.concat(acc["out"], F.array(part(acc["at"], s["start"])))
            return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), after.alias("out"))).otherwise(
                F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
            )

        def cut(run: Column, at: Column) -> Column:
            return F.aggregate(run, F.struct(at.alias("at"), F.array().cast("array<string>").alias("out")), step)

        parts = _run_by_run(_runs(spans), cut, "at", "array<struct<at:int,out:array<string>>>")
        return F.concat(F.array_join(parts, by), F.lit(by), part(last, F.length(body)))

    # Of a text with many spans the characters are taken apart once; else each part is cut out of it.
    by_chars = _once(F.split(body, ""), lambda chars: masked(lambda a, b: F.array_join(F.slice(chars, a + 1, b - a), "")))
    by_places = masked(lambda a, b: F.substring(body, a + 1, b - a))
    done = F.when(F.size(spans) > RUN, by_chars).when(F.size(spans) > 0, by_places).otherwise(body)
    return found.select(*[(done if c == text else F.col("_doc")[c]).alias(c) for c in docs.columns])
