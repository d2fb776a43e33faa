"""Spark session helpers.

Library code never creates a session on its own; callers pass one in. ``local_session`` is for tests, the bench and
examples. ``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and only sets a private folder in
local mode when none is configured (on a cluster the setting must point at shared storage).
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "giniflow",
                  driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a private one only in local mode when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder on shared storage when running on a cluster")
    folder = tempfile.mkdtemp(prefix="giniflow-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``giniflow`` importable in the Python workers of a local session (grouped-map and mapInPandas functions are
    pickled by reference): the package is zipped once per application and distributed with ``addPyFile``. On a
    cluster the package is deployed with the job (wheel or ``--py-files``), so nothing is written here."""
    import os
    import zipfile

    import giniflow
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or not sc.master.startswith("local"):
        return
    pkg = os.path.dirname(giniflow.__file__)
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="giniflow-pyfiles-"), "giniflow.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def prepare_session(spark: SparkSession) -> str:
    """Checkpoint folder + package shipped to the workers; returns the checkpoint folder."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: the plan runs once however often the
    result is used, and lost executors cost a reread of the copy."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver's JVM collect garbage: Spark removes the files of shuffles that no plan refers to any more (it would do
    so at its next collection only, half an hour later if need be)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
