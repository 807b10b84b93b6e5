"""Spark session construction and shared scratch locations.

Library code never invents a machine-local folder: intermediate tables and
checkpoints go under ``spark.checkpoint.dir`` (a shared filesystem on a
cluster).  Only a local-mode session without that setting (tests, laptops)
gets a fresh folder of its own.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def _default_driver_memory() -> str:
    """Local mode runs everything in the driver JVM: up to 16g, but never more than
    60 % of the machine's physical memory."""
    try:
        total_mb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (1024 * 1024)
        return f"{max(1024, min(16384, int(total_mb * 0.6)))}m"
    except (ValueError, OSError, AttributeError):
        return "4g"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tabforge", extra: dict | None = None) -> SparkSession:
    """Session with the settings every operator here assumes (UTC, AQE, no UI)."""
    master = master or os.environ.get("TABFORGE_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("TABFORGE_DRIVER_MEMORY", _default_driver_memory())))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only when the setting is absent and the session runs in local mode do we
    create one (the test situation); on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    path = current or configured
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"{_CKPT_KEY} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="tabforge-ckpt-")
        spark.conf.set(_CKPT_KEY, path)
    if not current:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers once per application, so that code in tasks
    also runs where it is not installed on the executors."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        top = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tabforge-code-")), "tabforge.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        z.write(file, os.path.relpath(file, os.path.dirname(top)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return spark


_scratch: dict[str, list[str]] = {}


def _delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Remove an application's scratch tables when the program ends."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)
    except Exception:  # the session has ended before: the folder is left to the cluster's cleaner
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location for an intermediate table under the shared folder,
    deleted when the program ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tabforge-scratch/{name}-{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = []
        atexit.register(_delete_scratch, spark, _scratch[app])
    _scratch[app].append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: downstream branches do
    not recompute, a lost executor costs only its own running tasks, and the size of
    the table is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` into the shared checkpoint folder (set up first
    when the session has none, local mode only).  Cuts lineage so that a lost
    executor does not force recomputation of everything upstream."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
