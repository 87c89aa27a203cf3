"""Session construction and the few settings the operators rely on."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "tabulon", cpus: int | str = "*", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the cluster's session."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TABULON_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names this folder. Where it is unset, a local session (tests,
    bench) gets a folder of its own; any other master is an error, because
    executors cannot read each other's local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tabulon-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python unless they find it by PYTHONPATH.

    Once per context. A cluster that installs the wheel on its nodes sets
    ``spark.tabulon.installed`` to true instead.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if (sc.applicationId in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(os.pathsep)
            or spark.conf.get("spark.tabulon.installed", "false") == "true"):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tabulon-ship-"), "tabulon_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "tabulon")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def give_back() -> None:
    """Return this process's free memory to the system. Python workers are kept
    between tasks, and what each once needed would count until they end."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc only
    if trim:
        trim(0)


_SHIPPED: set[str] = set()
