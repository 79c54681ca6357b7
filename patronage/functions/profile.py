"""Predicates and labels on profile columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def has_profile(first_name: str | Column = "first_name", email: str | Column = "email", *more: str | Column) -> Column:
    """True when any of the identifying columns carries text; an empty string counts as missing."""
    names = [F.col(c) if isinstance(c, str) else c for c in (first_name, email, *more)]
    return F.coalesce(*[blank_to_null(c) for c in names]).isNotNull()


def full_name(first: Column, last: Column) -> Column:
    """Both names joined by a blank, missing parts skipped, a dash when nothing is left."""
    return F.coalesce(blank_to_null(F.trim(F.concat_ws(" ", blank_to_null(first), blank_to_null(last)))), F.lit("—"))


def activity_label(is_active: Column) -> Column:
    return F.when(is_active.isNull(), "—").when(is_active, "Active").otherwise("Inactive")
