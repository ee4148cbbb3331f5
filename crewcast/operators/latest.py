"""Current rows and latest values of history tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crewcast.fixed_values import OPEN_END_DATE
from crewcast.functions import folder_of


def open_rows(history: DataFrame, end_column: str = "effective_end_ts") -> DataFrame:
    """Rows whose validity has not ended. A stored history is read from the folder of its open rows alone."""
    rows = history.filter(F.col(end_column) == F.lit(OPEN_END_DATE).cast(history.schema[end_column].dataType))
    folder = folder_of(history.columns, end_column)
    return rows.filter(F.col(folder[0]) == F.trunc(F.lit(OPEN_END_DATE).cast("date"), folder[1])) if folder else rows


def latest_rows(rows: DataFrame, entity: Sequence[str], order: str, named: bool = False) -> DataFrame:
    """Every row that carries the greatest ``order`` of its entity; ties all stay.

    The maxima come from a partially aggregated group-by, and the rows are matched on entity *and*
    order value, so the rows of one very frequent entity spread over the partitions instead of
    meeting in one window. With ``named`` every row has an entity: plain equality then lets a history that is bucketed by
    the entity be matched where it lies.
    """
    tops = rows.groupBy(*entity).agg(F.max(order).alias("_top")).select(
        *[F.col(k).alias(f"_{k}") for k in entity], "_top"
    )
    same = [F.col(k) == F.col(f"_{k}") if named else F.col(k).eqNullSafe(F.col(f"_{k}")) for k in entity]
    same.append(F.col(order).eqNullSafe(F.col("_top")))
    return rows.join(tops, reduce(lambda a, b: a & b, same), "inner").select(*rows.columns)


def latest_counts(rows: DataFrame, entity: str, order: str, name: str) -> DataFrame:
    """How many rows :func:`latest_rows` would keep per entity, by two aggregations and no join."""
    ties = rows.groupBy(entity, order).agg(F.count(F.lit(1)).alias(name))
    newest = F.max(F.struct(F.col(order), F.col(name)))
    return ties.groupBy(entity).agg(newest[name].alias(name))


@dataclass(frozen=True)
class Latest:
    """One output of :func:`latest_pivot`: which codes feed it, and from which value column.

    With several codes the result is the greatest of the codes' latest values.
    """

    codes: Sequence[str]
    value: str


def latest_pivot(rows: DataFrame, entity: str, code: str, order: str, outputs: Mapping[str, Latest]) -> DataFrame:
    """One row per entity with the latest value of each code as a column.

    Where several rows of an entity and code share the latest order, the greatest value wins. That
    is the maximum of the pair (order, value), so one aggregation with a partial step on the map
    side does the ranking, the tie rule and the pivot; no group is ever brought together first.
    A value that is the order itself needs no pair, and one that is the code only whether the code occurs: where all
    are numbers, times or such flags, the aggregation hashes instead of sorting.
    """
    wanted = sorted({c for out in outputs.values() for c in out.codes})
    pairs = sorted({(c, out.value) for out in outputs.values() for c in out.codes})
    slots = {pair: f"_p{i}" for i, pair in enumerate(pairs)}

    def candidate(c: str, value: str) -> Column:
        if value == code:
            best = F.lit(True)
        else:
            best = F.col(value) if value == order else F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
        return F.max(F.when(F.col(code) == c, best)).alias(slots[(c, value)])

    def latest(c: str, value: str) -> Column:
        slot = F.col(slots[(c, value)])
        if value == code:
            return F.when(slot, F.lit(c))
        return slot if value == order else slot["v"]

    best = rows.filter(F.col(code).isin(wanted)).groupBy(entity).agg(*[candidate(*pair) for pair in pairs])
    columns = []
    for name, out in outputs.items():
        values = [latest(c, out.value) for c in out.codes]
        columns.append((values[0] if len(values) == 1 else F.greatest(*values)).alias(name))
    return best.select(entity, *columns)


def stamp_order(version: str) -> Column:
    """Versions by the time their stamp names, whatever its digits; a stamp that is no time comes before all, by its text."""
    return F.struct(F.try_to_timestamp(F.col(version).cast("string")).alias("at"), F.col(version).alias("stamp"))


def latest_version_flag(rows: DataFrame, version: str) -> Column:
    """True on rows of the newest version; the newest one is a one-row scalar subquery."""
    newest = rows.filter(F.col(version).isNotNull()).agg(F.max(stamp_order(version))["stamp"]).scalar()
    return F.coalesce(F.col(version) == newest, F.lit(False))


def nth_latest_version(rows: DataFrame, version: str, back: int) -> DataFrame:
    """The version that is ``back`` places before the newest, as one row; empty if there is none."""
    versions = rows.select(version).filter(F.col(version).isNotNull()).distinct()
    return versions.orderBy(stamp_order(version).desc()).offset(back).limit(1)
