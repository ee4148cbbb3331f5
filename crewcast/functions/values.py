"""Row-level value choices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def flag_to_int(flag: Column) -> Column:
    """Text flag to integer, 0 where it is missing; text that is no number gives null."""
    return F.coalesce(flag, F.lit("0")).try_cast("int")


def guarded_ratio(part: Column, total: Column) -> Column:
    """``part / total`` where the total is positive, else null."""
    return F.when(total > 0, part / total)


def child_or_parent(child_id: Column, child: Column, parent: Column) -> Column:
    """The child's value whenever there is a child, even a null one; else the parent's."""
    return F.when(child_id.isNotNull(), child).otherwise(parent)


def repaired(text: Column, fixes: Mapping[str, str]) -> Column:
    """Replace whole values that were stored wrongly; other values stay."""
    for wrong, right in fixes.items():
        text = F.when(text == wrong, F.lit(right)).otherwise(text)
    return text


def renamed_key(flag: Column, new: Column, old: Column) -> Column:
    """The new name where the migration flag is blank, the old one where it is set or null."""
    return F.when(flag == "", new).otherwise(old)
