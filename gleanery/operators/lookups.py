"""Codes, labels, areas and identifiers turned into local ids.

A code list has the columns `id_nomenclature, mnemonique, cd_nomenclature,
label_default, is_default`.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.joins import join_lookup, small_side
from gleanery.operators.lineage import cut

_SEP = "\u0001"


class Lookup(NamedTuple):
    """One attribute to look up: code-list type, the value, the column to add."""

    list_type: str
    value: Column
    out: str


class CodeBook:
    """A code list prepared for many lookups in one job.

    All the lookups of a job share one build side, in which kind (code or label),
    type and value are glued into one key, so that the list is read, sized and sent
    out once. `like_types` are type names used as patterns in label lookups.
    """

    def __init__(self, codes: DataFrame, like_types: tuple[str, ...] = ()):
        self._given = codes
        self._read: DataFrame | None = None
        self._like_types = like_types
        self._by_key: DataFrame | None = None
        self._by_id: DataFrame | None = None
        self._defaults: dict[str, int] | None = None

    @property
    def _codes(self) -> DataFrame:
        # Written once: every role of every table joins a scan of a small file then,
        # and not whatever the list is made from.
        if self._read is None:
            self._read = cut(self._given)
        return self._read

    @property
    def by_key(self) -> DataFrame:
        if self._by_key is None:
            code = self._codes.where("cd_nomenclature IS NOT NULL").select(
                F.lit("code").alias("kind"), "mnemonique", F.col("cd_nomenclature").alias("value"), "id_nomenclature"
            )
            label = self._codes.where("label_default IS NOT NULL").select(
                F.lit("label").alias("kind"), "mnemonique", F.col("label_default").alias("value"), "id_nomenclature"
            )
            if self._like_types:
                # Pattern match on the type name: `_` and `%` are wildcards.
                patterns = F.array(*[F.lit(t) for t in self._like_types])
                hits = F.filter(patterns, lambda pattern: F.like(F.col("mnemonique"), pattern))
                label = label.withColumn("mnemonique", F.explode(hits))
            keyed = code.unionByName(label).select(
                F.concat_ws(_SEP, "kind", "mnemonique", "value").alias("_key"), "id_nomenclature"
            )
            self._by_key = small_side(cut(keyed.groupBy("_key").agg(F.min("id_nomenclature").alias("_id"))))
        return self._by_key

    @property
    def by_id(self) -> DataFrame:
        if self._by_id is None:
            self._by_id = small_side(
                self._codes.select(F.col("id_nomenclature").alias("_id"), F.col("cd_nomenclature").alias("_cd"))
            )
        return self._by_id

    @property
    def defaults(self) -> dict[str, int]:
        """Default id of each type: one small row per type of the list."""
        if self._defaults is None:
            rows = (
                self._codes.where("is_default")
                .groupBy("mnemonique")
                .agg(F.min("id_nomenclature").alias("id"))
                .collect()
            )
            self._defaults = {r["mnemonique"]: r["id"] for r in rows}
        return self._defaults

    def default(self, list_type: str) -> Column:
        return F.lit(self.defaults.get(list_type)).cast("bigint")

    def ids(self, df: DataFrame, lookups: list[Lookup], labelled: Column | None = None) -> DataFrame:
        """Add the ids of several attributes.

        A code that is null or unknown gives the default of its type. Rows where
        `labelled` holds carry labels instead; an unknown label gives null.
        """
        by_label = F.lit(False) if labelled is None else labelled
        columns = df.columns
        keys = []
        for i, (list_type, value, _) in enumerate(lookups):
            prefix = F.when(by_label, F.lit(f"label{_SEP}{list_type}{_SEP}")).otherwise(
                F.lit(f"code{_SEP}{list_type}{_SEP}")
            )
            keys.append(F.concat(prefix, value.cast("string")).alias(f"_key{i}"))
        out = df.select("*", by_label.alias("_labelled"), *keys)
        for i in range(len(lookups)):
            side = self.by_key.select(F.col("_key").alias(f"_key{i}"), F.col("_id").alias(f"_id{i}"))
            out = out.join(side, f"_key{i}", "left")
        found = [
            F.coalesce(f"_id{i}", F.when(~F.col("_labelled"), self.default(list_type))).alias(name)
            for i, (list_type, _, name) in enumerate(lookups)
        ]
        new = {name for _, _, name in lookups}
        return out.select(*[c for c in columns if c not in new], *found)

    def id_of_code(self, df: DataFrame, list_type: str, code: Column, out: str) -> DataFrame:
        """Id of a code of a type; the default of the type for an unknown or null code."""
        return self.ids(df, [Lookup(list_type, code, out)])

    def id_of_label(self, df: DataFrame, list_type: str, label: Column, out: str) -> DataFrame:
        """Id of a label of a type; null when there is none."""
        return self.ids(df, [Lookup(list_type, label, out)], F.lit(True))

    def codes_of(self, df: DataFrame, ids: dict[str, str], how: str = "left") -> DataFrame:
        """Replace id columns by their codes: `{id column: column of the code}`."""
        for id_column, out in ids.items():
            side = self.by_id.select(F.col("_id").alias(id_column), F.col("_cd").alias(out))
            df = df.join(side, id_column, how)
        return df


def area_ids(df: DataFrame, areas: DataFrame, type_code: Column, area_code: Column, out: str) -> DataFrame:
    """Id of an area from its type code and its own code (`id_area, type_code, area_code`)."""
    side = areas.groupBy(F.col("type_code").alias("_type"), F.col("area_code").alias("_area")).agg(
        F.min("id_area").alias(out)
    )
    wanted = df.select("*", type_code.alias("_type"), area_code.alias("_area"))
    return join_lookup(wanted, side, ["_type", "_area"], "left").drop("_type", "_area")
