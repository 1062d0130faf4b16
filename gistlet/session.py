"""Spark session and shared work-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long articles: keep Arrow batches small enough for one Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    # Text work is bound by the CPU: more and smaller scan tasks than the default gives.
    "spark.sql.files.maxPartitionBytes": "64m",
}


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``gistlet`` importable in the Python workers (as ``--py-files`` would).

    UDFs are pickled by reference to this package's modules; workers only see the
    interpreter's own path, so the package is zipped once per application and added with
    ``addPyFile``: Spark serves the driver's file to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="gistlet-pyfiles-"), f"gistlet-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def get_spark(master: str | None = None, app: str = "gistlet",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults this library expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


#: Bytes of an Arrow batch sent to a Python worker.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that a worker's memory grows neither with the rows nor with their texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_LOCAL_DIRS: dict = {}


def work_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables: the one in ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a temporary folder of its own; on a
    cluster that would be a different disk for each executor, so there it is an error.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {sc.master} share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="gistlet-work-")
    return _LOCAL_DIRS[sc.applicationId]


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a file: scheme for the few places that use the local filesystem."""
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_dir(path: str) -> str:
    os.makedirs(local_path(path), exist_ok=True)
    return path
