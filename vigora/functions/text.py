"""String columns with Unicode-aware semantics; every function stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Runs of white space, no-break space included.
WS = r"(?U)\s+"


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; outer ones go."""
    return F.trim(F.regexp_replace(c, WS, " "))


def strip(c: Column) -> Column:
    """Drop outer white space of any kind, keep inner runs."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def bare(c: Column) -> Column:
    """Lower case without white space and ordinal mark: the form in which unit numbers are compared."""
    return F.lower(F.regexp_replace(c, r"(?U)[\sº]+", ""))


def norm_key(c: Column) -> Column:
    """Name of a norm without case, white space and thousands dots."""
    return F.lower(F.regexp_replace(c, r"(?U)[\s.]+", ""))


def slug_of(unit_id: Column) -> Column:
    """The part of a unit's id before ``--``."""
    return F.substring_index(unit_id, "--", 1)


def note_set(notes: Column) -> Column:
    """Sorted set of squeezed notes; null, empty and blank ones are left out, null gives an empty array."""
    squeezed = F.transform(F.coalesce(notes, F.array().cast("array<string>")), squeeze)
    return F.array_sort(F.array_distinct(F.filter(squeezed, lambda x: x.isNotNull() & (x != ""))))

