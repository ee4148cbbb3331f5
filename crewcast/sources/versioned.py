"""Tables that change as a whole: data is written first, and one commit row, written last, makes it the table.

Below the path of a table lie ``data/load=<id>``, one folder per write, and ``commits``, one small file per commit. A commit
lists the loads that make up the table and the days each of them owns, so

* a reader sees the table of the last commit or of an earlier one, never a half-written one, and a job that dies before its
  commit changes nothing;
* a load of a period takes over the days of that period from all loads before it, also where it has no rows for them,
  so that overlapping loads do not count twice and an emptied period is empty;
* a load of a slot, such as a forecast's stamp, takes the place of that slot's rows and leaves the others where they lie;
* a commit carries the step that made it, and a step that has been committed need not run again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

COMMIT = "version bigint, token string, step string, segments array<struct<load: string, first: date, until: date, slot: string>>"


def schema_text(rows: DataFrame) -> str:
    """The DDL of a frame's columns."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


class Conflict(RuntimeError):
    """Another writer has committed the same version."""


@dataclass(frozen=True)
class Segment:
    """A load and the days [first, until) or the slot it owns; without them it owns all its rows."""

    load: str
    first: date | None = None
    until: date | None = None
    slot: str | None = None

    def without(self, first: date, until: date) -> list[Segment]:
        """What is left of it when another load takes over [first, until)."""
        parts = []
        if self.first is None or self.first < first:
            parts.append(Segment(self.load, self.first, first if self.until is None else min(first, self.until)))
        if self.until is None or self.until > until:
            parts.append(Segment(self.load, until if self.first is None else max(until, self.first), self.until))
        return parts


class VersionedTable:
    """A parquet table with commits. ``schema`` is its DDL, ``day`` the date column by which loads own rows."""

    def __init__(self, spark: SparkSession, path: str, schema: str, day: str | None = None):
        self.spark, self.path, self.schema, self.day = spark, path.rstrip("/"), schema, day

    def _entries(self) -> DataFrame:
        if not self._exists("commits"):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).json(f"{self.path}/commits")

    def commits(self) -> DataFrame:
        """All commits that hold. Of two with one version the smaller token holds; the other writer has been told."""
        held = self._entries().groupBy("version").agg(F.min(F.struct("token", "step", "segments")).alias("held"))
        return held.select("version", "held.*")

    def last(self, version: int | None = None) -> Row | None:
        """The newest commit, or that of ``version``."""
        rows = self._entries()
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        return rows.orderBy(F.desc("version"), "token").limit(1).first()

    def done(self, step: str) -> Row | None:
        """The newest commit made by ``step``."""
        return self.commits().filter(F.col("step") == step).orderBy(F.desc("version")).limit(1).first()

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the newest commit, or of an earlier one; none before the first.

        All loads are one scan. Which days of a load count is a filter on its folder and its month folders, so the
        scan opens only those.
        """
        commit = self.last(version)
        if version is not None and commit is None:
            raise ValueError(f"{self.path} has no version {version}")
        segments = commit["segments"] if commit else []
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        folders = sorted({f"{self.path}/data/load={s['load']}" for s in segments})
        types = T.StructType.fromDDL(self.schema)
        columns = [f.name for f in types]
        stored = T.StructType([*types.fields, T.StructField("load", T.StringType())] + ([T.StructField("load_month", T.DateType())] if self.day else []))
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*folders)
        if self.day is None:
            return rows.select(*columns)
        counts = F.lit(False)
        for s in segments:
            owned = F.col("load") == s["load"]
            if s["first"] is not None:
                owned &= (F.col(self.day) >= F.lit(s["first"])) & (F.col("load_month") >= F.lit(s["first"].replace(day=1)))
            if s["until"] is not None:
                owned &= (F.col(self.day) < F.lit(s["until"])) & (F.col("load_month") < F.lit(s["until"]))
            counts |= owned
        return rows.filter(counts).select(*columns)

    def replace(self, rows: DataFrame, step: str = "") -> int:
        """Commit ``rows`` as the whole table; they may read from the table itself. Returns the version."""
        return self._commit(lambda segments, load: [Segment(load)], self._write(rows), step)

    def load(self, rows: DataFrame, first: date, until: date, step: str = "") -> int:
        """Commit ``rows`` as the table's rows for the days [first, until), whatever earlier loads hold for them.

        Rows of other days are stored and not counted: they belong to the loads that own those days. A row without a
        day belongs to none.
        """
        if self.day is None:
            raise ValueError("a table without a day column has no periods")

        def taken_over(segments: list[Segment], load: str) -> list[Segment]:
            return [part for s in segments for part in s.without(first, until)] + [Segment(load, first, until)]

        return self._commit(taken_over, self._write(rows), step)

    def put(self, rows: DataFrame, slot: str, step: str = "") -> int:
        """Commit ``rows`` as the rows of ``slot``, in place of what it held; rows of other slots are not touched."""
        return self._commit(lambda segments, load: [s for s in segments if s.slot != slot] + [Segment(load, slot=slot)], self._write(rows), step)

    def compact(self) -> int:
        """Rewrite the loads as one, which no slot or period takes the place of any more but by its days."""
        return self.replace(self.read(), "compact")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the loads that none of the newest ``keep`` commits lists; earlier versions cannot be read any more.

        Not to be run next to a writer, whose load is in no commit yet.
        """
        recent = self.commits().orderBy(F.desc("version")).limit(keep)
        live = {r["load"] for r in recent.select(F.explode("segments").alias("s")).select("s.load").collect()}
        gone = sorted(name for name in self._names("data") if name.startswith("load=") and name.removeprefix("load=") not in live)
        for name in gone:
            self._files().delete(self._file(f"data/{name}"), True)
        return gone

    def _write(self, rows: DataFrame) -> str:
        load = uuid.uuid4().hex
        types = T.StructType.fromDDL(self.schema)
        shaped = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in types])
        folder = f"{self.path}/data/load={load}"
        if self.day is None:
            shaped.write.parquet(folder)
        else:
            # Rebalancing writes few files a month and splits a month that is too large for one task.
            months = shaped.withColumn("load_month", F.trunc(self.day, "MM")).hint("rebalance", "load_month")
            months.write.partitionBy("load_month").parquet(folder)
        return load

    def _commit(self, change, load: str, step: str) -> int:
        last = self.last()
        before = [Segment(s["load"], s["first"], s["until"], s["slot"]) for s in last["segments"]] if last else []
        version, token = (last["version"] if last else 0) + 1, uuid.uuid4().hex
        entry = {"version": version, "token": token, "step": step,
                 "segments": [{k: str(v) for k, v in vars(s).items() if v is not None} for s in change(before, load)]}
        # One file, moved into place when it is complete.
        self.spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/commits")
        if self.last(version)["token"] != token:
            raise Conflict(f"version {version} of {self.path} was committed by another writer")
        return version

    def _file(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def _files(self):
        return self._file().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self._files().exists(self._file(name))

    def _names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self._files().listStatus(self._file(name))] if self._exists(name) else []
