"""Runs of several steps that go on where they were broken off."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from crewcast.sources.versioned import VersionedTable


class Run:
    """Steps under one name. Each writes one table, and its commit says which step of which run made it.

    The journal is the tables' commits: a step is done exactly when its rows are, so there is nothing that could be
    written without the other. A step that is done is read, not computed. Arguments belong to a step: with others it is
    another step.
    """

    def __init__(self, spark: SparkSession, name: str, before: Mapping[str, Callable[[], None]] | None = None, made: list | None = None):
        self.spark, self.name, self.before = spark, name, before or {}
        #: What this driver did: (step, whether it was computed).
        self.made: list[tuple[str, bool]] = made if made is not None else []

    def key(self, job: str, arguments: dict) -> str:
        return json.dumps([self.name, job, arguments], sort_keys=True, default=str)

    def step(self, job: str, table: VersionedTable, build: Callable[[], DataFrame], arguments: dict | None = None,
             period: tuple[date, date] | None = None, slot: str | None = None) -> DataFrame:
        """Rows of ``table`` as this step leaves it; ``build`` is called only if the step is not done yet.

        The rows replace the table, or with a ``period`` its days, or with a ``slot`` that slot's rows.
        """
        key = self.key(job, {**(arguments or {}), **({"period": period} if period else {}), **({"slot": slot} if slot else {})})
        done = table.done(key)
        if done is None:
            self.before.get(job, lambda: None)()
            rows = build()
            version = table.load(rows, *period, step=key) if period else table.put(rows, slot, key) if slot else table.replace(rows, key)
        else:
            version = done["version"]
        self.made.append((job, done is None))
        return table.read(version)
