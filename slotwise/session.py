"""Session settings the pipeline relies on, and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job needs. They are runtime SQL confs, so they can be applied to
# a session someone else built (the driver's, a notebook's) without a restart.
RUNTIME_CONF = {
    # event_ts / ingest_ts are instants; event_date is their UTC date.
    "spark.sql.session.timeZone": "UTC",
    # overwrite only the partitions a write produces (silver dt, gold event_date)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "slotwise") -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, small shuffle count)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SLOTWISE_DRIVER_MEMORY", "8g"))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local-mode session without one gets a fresh temporary folder — on a cluster a
    machine-local folder would be invisible to the executors, so that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if sc.applicationId in _LOCAL_FOLDERS:
        return _LOCAL_FOLDERS[sc.applicationId]
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="slotwise-")
    sc.setCheckpointDir(folder)  # checkpoint() then works too
    _LOCAL_FOLDERS[sc.applicationId] = folder
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder (one per run, never reused)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    A worker that runs one of its functions imports the package; on a cluster its
    folder is on the driver only. The archive is made in the driver's temporary folder
    and served by Spark. A session without a context (a remote one) ships by its own means.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  # remote sessions raise their own kind of error
        return
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="slotwise-package-")
    name = os.path.basename(package)
    sources = shutil.copytree(package, f"{folder}/sources/{name}", ignore=shutil.ignore_patterns("__pycache__", "*.pyc"))
    sc.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", os.path.dirname(sources)))
