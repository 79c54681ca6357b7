"""Reading loosely typed JSON values held as VARIANT, which keeps the JSON type of every value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_UNWRAP = 4
_AS_MAP = "map<string,variant>"
# What a decimal number looks like as text; Spark's own cast would also take Java suffixes such as "1f".
_NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def is_missing(value: Column) -> Column:
    return value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False))


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _step(value: Column) -> Column:
    """One union level: the `string` branch, else `STRING`, else the only entry; anything else is left alone."""

    def branch(entries: Column) -> Column:
        return (
            F.when(F.map_contains_key(entries, "string"), F.try_element_at(entries, F.lit("string")))
            .when(F.map_contains_key(entries, "STRING"), F.try_element_at(entries, F.lit("STRING")))
            .when(F.size(entries) == 1, F.map_values(entries)[0])
            .otherwise(value)
        )

    # the one-element array gives the entries a name, so they are read from the variant once
    opened = F.transform(F.array(F.try_variant_get(value, "$", _AS_MAP)), branch)
    return F.when(is_object(value), opened[0]).otherwise(value)


def unwrap_text(value: Column) -> Column:
    """Text inside up to four union wrappers; empty text and JSON null become null. The fold binds each level
    to a lambda variable, so the expression does not grow with the depth."""
    levels = F.sequence(F.lit(1), F.lit(MAX_UNWRAP))
    inner = F.when(is_object(value), F.aggregate(levels, value, lambda acc, _: _step(acc))).otherwise(value)
    return F.nullif(as_text(inner), F.lit(""))


def to_bigint(value: Column, default: int | None = 0) -> Column:
    """Whole numbers: JSON numbers are cut at the point, text must be an integer, all else is the default."""
    number = F.try_variant_get(value, "$", "bigint")
    return number if default is None else F.coalesce(number, F.lit(default).cast("bigint"))


def to_double(value: Column, default: float = 0.0) -> Column:
    unreadable = is_text(value) & ~as_text(value).rlike(_NUMBER_TEXT)
    return F.coalesce(F.when(~unreadable, F.try_variant_get(value, "$", "double")), F.lit(default))


# Words read as a boolean.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")


def to_boolean(value: Column) -> Column:
    """Tri-state: known words, booleans, numbers by being non-zero, containers by being non-empty, else null."""
    word = F.lower(as_text(value))
    kind = F.schema_of_variant(value)
    spoken = F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
    return (
        F.when(kind == "STRING", spoken)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind.startswith("OBJECT"), F.size(F.try_variant_get(value, "$", _AS_MAP)) > 0)
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(value, "$", "array<variant>")) > 0)
        .otherwise(F.try_variant_get(value, "$", "double") != 0)
    )


def is_falsy(value: Column) -> Column:
    """Missing, empty text, zero, false or an empty container."""
    empty = F.when(is_text(value), as_text(value) == "").otherwise(~to_boolean(value))
    return is_missing(value) | F.coalesce(empty, F.lit(False))
