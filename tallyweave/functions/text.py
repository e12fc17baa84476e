"""Text and id columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """True for null and for text of blanks only."""
    return F.coalesce(F.length(F.trim(c)) == 0, F.lit(True))


def path_depth(parent_ids: Column) -> Column:
    """Number of ids in a comma list; commas at the end add no id, no list gives 0."""
    kept = F.regexp_replace(parent_ids, ",+$", "")
    only_commas = (kept == "") & (parent_ids != "")
    return F.when(only_commas | parent_ids.isNull(), F.lit(0)).otherwise(F.size(F.split(kept, ",")))


def id_list(ids: Column) -> Column:
    """A comma list as an array of trimmed, non-empty ids."""
    return F.filter(F.transform(F.split(ids, ","), lambda x: F.trim(x)), lambda x: x != "")


def sub_type(type_: Column) -> Column:
    """``brand::tags`` has the sub type ``brand``; a plain type has ``-``."""
    parts = _type_parts(type_)
    return F.when(F.size(parts) > 1, parts[0]).otherwise(F.lit("-"))


def field_name(type_: Column) -> Column:
    """``brand::tags`` names the field ``tags``; a plain type names itself."""
    parts = _type_parts(type_)
    return F.when(F.size(parts) > 1, parts[1]).otherwise(parts[0])


def _type_parts(type_: Column) -> Column:
    return F.split(F.regexp_replace(type_, "(::)+$", ""), "::")


def digest(*parts: Column) -> Column:
    """Hex md5 of the parts put together."""
    return F.md5(F.concat(*parts))


def hex_uuid() -> Column:
    """A random id of 32 hex digits."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))
