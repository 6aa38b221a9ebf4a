"""Text, identifier and cast expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters folded in source names, their replacements, and signs removed.
# A sign that is in both lists is removed.
FOLDED = "àâäéèêëîïôöùûüŷÿç~- "
FOLDED_TO = "aaaeeeeiioouuuyyc___"
REMOVED = "&'([{|}])`^\\/+-=*°$£%§.?!;:<>"

UUID_PATTERN = "^[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}$"


def simplify_source(name: Column) -> Column:
    """Source name as used in the stored rows: one case, no accents, no signs."""
    blank = r"(?U)[\s\x1c-\x1f]+"
    one_line = F.trim(F.regexp_replace(name, blank, " "))
    kept = F.translate(F.lower(one_line), REMOVED, "")
    return F.translate(kept, FOLDED, FOLDED_TO)


def uuid_of(text: Column) -> Column:
    """Stable uuid-shaped identifier of a text."""
    # One call keeps the generated code of wide projections small.
    return F.regexp_replace(F.md5(text), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")


def clean_uuid(text: Column) -> Column:
    """Lower-case uuid, or null where the text is no uuid."""
    low = F.lower(F.trim(text))
    return F.when(low.rlike(UUID_PATTERN), low)


def clean_int(text: Column) -> Column:
    return text.try_cast("int")


def clean_bigint(text: Column) -> Column:
    return text.try_cast("bigint")


def clean_date(text: Column) -> Column:
    """Day of a date or timestamp text; the time of day is dropped."""
    return F.coalesce(text.try_cast("date"), text.try_cast("timestamp_ntz").cast("date"))


def clean_bool(text: Column) -> Column:
    return text.try_cast("boolean")


CLEANERS = {"int": clean_int, "bigint": clean_bigint, "uuid": clean_uuid, "date": clean_date, "bool": clean_bool}


def clean(text: Column, kind: str) -> Column:
    return CLEANERS[kind](text) if kind in CLEANERS else text


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
