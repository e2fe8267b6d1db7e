"""File names and time stamps as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def extension(path: Column) -> Column:
    """Last dot and what follows; leading dots belong to the name."""
    return F.regexp_extract(base_name(path), r"^\.*[^.].*(\.[^.]*)$", 1)


def stem(path: Column) -> Column:
    name, ext = base_name(path), extension(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(ext))


def folder(path: Column) -> Column:
    """Folder prefix with exactly one slash at its end."""
    return F.concat(F.regexp_replace(path, "/+$", ""), F.lit("/"))


def sized_name(path: Column, size: Column) -> Column:
    """``<stem>__<size>B<extension>``."""
    return F.concat(stem(path), F.lit("__"), size.cast("string"), F.lit("B"), extension(path))


def destination_name(path: Column, stamp: Column, mode: Column) -> Column:
    """``<stem>_<stamp>`` with the extension dropped, kept, or replaced (``force:.ext``)."""
    chosen = F.lower(F.trim(mode))
    forced = F.regexp_replace(chosen, r"^force:\s*\.?(.*)$", ".$1")
    return F.concat(
        stem(path), F.lit("_"), stamp,
        F.when(chosen == "keep", extension(path))
        .when(F.startswith(chosen, F.lit("force:")) & (forced != "."), forced)
        .otherwise(F.lit("")))


def offset_minutes(offset: Column) -> Column:
    """Minutes of ``±HH:MM`` or ``±HHMM``; 0 for ``Z``, ``UTC`` and anything else."""
    pattern = r"^([+-])(\d{2}):?(\d{2})$"
    minutes = (F.regexp_extract(offset, pattern, 2).cast("int") * 60
               + F.regexp_extract(offset, pattern, 3).cast("int"))
    return F.when(F.rlike(offset, F.lit(pattern)),
                  F.when(F.startswith(offset, F.lit("-")), -minutes).otherwise(minutes)) \
        .otherwise(F.lit(0))


def stamp(at: Column, offset: Column, pattern: str = "yyyyMMddHHmmss") -> Column:
    """A point in time at a fixed offset from UTC, whatever the session's time zone is."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))
    return F.date_format(utc + F.make_dt_interval(mins=offset_minutes(offset)), pattern)
