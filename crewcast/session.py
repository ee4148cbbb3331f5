"""Session settings and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Instants are stored as zone-less UTC, so the session must not shift them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot work order, district or product is split here instead of filling one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split it even between joins on the same key, at the price of one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that lie by one key are not moved to be joined or summed by that key and others.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.requireAllClusterKeysForDistribution": "false",
    # Small dimensions are broadcast only after AQE has measured them.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    # A re-run of a month replaces that month instead of counting it twice.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording a call site for every column expression costs more than planning most queries.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "crewcast", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new sub-folder of the cluster's shared folder, ``spark.checkpoint.dir``.

    Where it is unset, a folder in the warehouse is taken, which all nodes reach as well. On a cluster a warehouse that
    nobody has set lies on the driver's disk, so that is an error.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not base:
        if not conf.get("spark.master", "").startswith("local") and not conf.get("spark.sql.warehouse.dir"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes reach")
        base = spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/crewcast-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


#: Folders that this driver has made.
_made: list[str] = []


def remove_copies(spark: SparkSession) -> int:
    """Delete the copies that this driver has made in the shared folder, once no frame reads them; returns how many there were."""
    count = 0
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        count += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return count
