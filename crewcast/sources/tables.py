"""Reading and writing tables. Readers stay lazy; each writer is one Spark write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_sheet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and declared types. The header must name the declared columns."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST")


def read_checked_sheet(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV with a header row that names the declared columns.

    A row with a cell that is not of its declared type, or with too few or too many cells, is no row: it goes to the rejects,
    one for each fault, as (file, line text, column, cell). A row with too few or too many cells has no column. Empty
    cells are null and no fault.
    """
    types = T.StructType.fromDDL(schema)
    text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in types], T.StructField("_line", T.StringType())])
    cells = spark.read.csv(path, header=True, schema=text, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord="_line")
    parsed = {f.name: F.col(f.name).try_cast(f.dataType) for f in types}
    fault = lambda f: F.when(F.col(f.name).isNotNull() & parsed[f.name].isNull(), F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("cell")))
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("cell"))
    marked = cells.withColumn("_faults", F.when(F.col("_line").isNotNull(), F.array(whole)).otherwise(F.array_compact(F.array(*[fault(f) for f in types]))))
    rows = marked.filter(F.size("_faults") == 0).select(*[c.alias(n) for n, c in parsed.items()])
    line = F.coalesce("_line", F.to_csv(F.struct(*[f.name for f in types])))
    rejects = marked.filter(F.size("_faults") > 0).select(F.input_file_name().alias("file"), line.alias("line"), F.explode("_faults").alias("_f"))
    return rows, rejects.select("file", "line", "_f.column", "_f.cell")


def read_series(spark: SparkSession, path: str, schema: str, time_column: str) -> DataFrame:
    """CSV whose time column is text; text that is no date becomes null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == time_column else f for f in T.StructType.fromDDL(schema)])
    return spark.read.csv(path, header=True, schema=text).withColumn(time_column, parsed_day(F.col(time_column)))


def parsed_day(text: Column) -> Column:
    """Text to DATE, null where it is not one; a time part is cut off."""
    return F.try_to_timestamp(text).cast("date")


def write_sheet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True)


def append(rows: DataFrame, path: str) -> None:
    """Add rows. A repeated run adds them again; use :func:`replace_partitions` where that matters."""
    rows.write.mode("append").parquet(path)


def refresh(rows: DataFrame, path: str) -> None:
    """Replace the whole table. ``rows`` must not read from ``path``."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_partitions(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``rows`` contains, so a repeated run changes nothing more.

    Rebalancing groups rows of a partition into few files and splits a partition that is too large
    for one task.
    """
    spread = rows.hint("rebalance", *by)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def written(rows: DataFrame, path: str) -> DataFrame:
    """Write rows once and go on from the stored copy, so later steps do not compute them again."""
    refresh(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
