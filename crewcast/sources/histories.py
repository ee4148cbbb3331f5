"""Upstream histories stored the way a period's load reads them.

* Rows of one key lie in one bucket, so histories of one key join, and aggregate by it, without being moved.
* Months (or years, for short histories) are folders: rows whose validity has ended lie apart from the open ones, and
  jobs by their two dates, so a load opens the files of its period and of the open rows only.

The store is an ordinary bucketed Spark table outside the warehouse; nothing but its name has to be known to read it.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from crewcast.fixed_values import FOLDERS
from crewcast.plans.fact import Upstream


@dataclass(frozen=True)
class Layout:
    """Bucket column, and the timestamp columns whose months or years are folders."""

    key: str
    cut: tuple[str, ...] = ()


#: Histories that are written at a time.
AT_ONCE = 4

ORDER, JOB = "work_order_id", "job_id"
ENDS = ("effective_end_ts",)
LAYOUTS: Mapping[str, Layout] = {
    "work_order": Layout(ORDER), "component": Layout(ORDER), "job": Layout(ORDER, ("appointment_start_datetime", "early_start_time")),
    "work_order_status": Layout(ORDER, ENDS), "location": Layout(ORDER, ENDS), "work_order_attribute": Layout(ORDER), "service": Layout(ORDER),
    "party": Layout(ORDER, ENDS), "assignment": Layout(JOB, ENDS), "job_status": Layout(JOB, ENDS), "processing_state": Layout(JOB),
    "time_entry": Layout(JOB, ENDS), "assignment_status": Layout("job_assignment_id"),
}


def store(rows: DataFrame, table: str, path: str, layout: Layout, buckets: int, unit: str = "month") -> DataFrame:
    """Write ``rows`` as ``table`` with files below ``path``, and read it back with its folder columns.

    Each bucket is written by one task, as one file per folder.
    """
    folders = {f"{FOLDERS[c]}_{unit}": F.trunc(F.col(c).cast("date"), unit) for c in layout.cut}
    writer = rows.withColumns(folders).repartition(buckets, layout.key).write.option("path", path).mode("overwrite")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.bucketBy(buckets, layout.key).sortBy(layout.key).saveAsTable(table)
    return rows.sparkSession.table(table)


def store_all(up: Upstream, prefix: str, folder: str, buckets: int, unit: str = "month") -> Upstream:
    """All histories of ``up`` as tables ``<prefix>_<name>`` below ``folder``; small tables stay as they are.

    Some are written at a time, so that one's tasks fill the cores while another commits its files.
    """
    given = {name: getattr(up, name) for name in LAYOUTS}
    write = inheritable_thread_target(up.job.sparkSession)(
        lambda name: store(given[name], f"{prefix}_{name}", f"{folder}/{name}", LAYOUTS[name], buckets, unit))
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return replace(up, **dict(zip(LAYOUTS, pool.map(write, LAYOUTS))))
