"""Registry of queries and the SQL text each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crewcast.session import shared_folder
from crewcast.sources.tables import read_parquet, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables by name, each a lazy parquet scan."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        frame = read_parquet(self.spark, f"{self.folder}/{name}.parquet")
        self.__dict__[name] = frame
        return frame

    def new_folder(self) -> str:
        return shared_folder(self.spark)

    def stored(self, rows: DataFrame) -> DataFrame:
        """Rows that several steps read, written once to the shared folder."""
        return written(rows, self.new_folder())


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``build(tables)`` under ``name``; ``sql`` gives the same rows in plain SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def money(name: str) -> Column:
    """Amounts are added up as exact decimals, so the order of addition does not matter."""
    return F.col(name).cast("decimal(18,2)")


def doubles(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name).cast("double"), digits).alias(name)
