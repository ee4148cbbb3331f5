"""Label rules and text helpers, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column, functions as F


def first_match(rules: Iterable[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first rule that holds. A rule that evaluates to null does not hold."""
    label = None
    for condition, value in rules:
        label = F.when(condition, F.lit(value)) if label is None else label.when(condition, F.lit(value))
    if label is None:
        return F.lit(default)
    return label if default is None else label.otherwise(F.lit(default))


def any_like(text: Column, patterns: Iterable[str]) -> Column:
    """True when one SQL pattern fits; ``_`` and ``%`` are wildcards, case counts."""
    return reduce(lambda a, b: a | b, [text.like(p) for p in patterns])


def recode(key: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Look a value up in a short fixed mapping without a join."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def joined_parts(parts: Iterable[Column], separator: str = " ") -> Column:
    """Trimmed parts in one text; null parts leave no separator behind."""
    return F.concat_ws(separator, *[F.trim(p) for p in parts])


def mentions(text: Column, word: str) -> Column:
    """Literal, case-blind containment: ``%`` and ``_`` stand for themselves."""
    return F.contains(F.lower(text), F.lit(word.lower()))
