"""Spark session settings shared by jobs, tests and the bench.

Every job runs with ANSI SQL on (decimal → string is plain, overflow is an
error), the session time zone pinned to UTC, and adaptive query execution
on so that joins against dimensions pick broadcast or sort-merge at run time
from measured sizes (the broadcast threshold is the size check).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for correct results.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Codec of the large tables written for later steps: smaller than the default at little more CPU.
WRITTEN_CODEC = "zstd"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "storemart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a
    cluster they come from the submit configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("STOREMART_DRIVER_MEMORY", "16g"),
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


_shipped: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers (pandas UDFs, mapInPandas):
    zip it once and register it with ``addPyFile`` (what ``--py-files`` does at submit)."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _shipped:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="storemart-py-"), "storemart.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _shipped.add(key)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)  # a setting that cannot be changed raises: results depend on it
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset, a scratch
    folder is made only for a single-process ``local[...]`` master (tests), whose
    executor is this process; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="storemart-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current
