"""Session and scratch-space helpers.

The library never invents storage locations on a cluster: lineage cuts and
staged tables live under the folder the cluster names in
``spark.checkpoint.dir``.  Only a ``local[...]`` session without that setting
(tests, laptops) gets a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "tessera", driver_memory: str = "16g") -> SparkSession:
    """Session with the settings the operators assume (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set up on first use.

    Order: an already active checkpoint dir, then ``spark.checkpoint.dir``,
    then (local mode only) a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the checkpoint folder for a staged table."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the Python workers (pandas UDFs and
    ``mapInPandas`` functions are pickled by module reference).

    The package is zipped once per SparkContext and added with
    ``addPyFile``, which ships it to every executor.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
