"""Session settings used by tests, the benchmark and examples."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_shipping = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run inside tasks are found by module name, so executors need the
    package also when the driver was started from another folder.
    """
    sc = spark.sparkContext
    with _shipping:  # models are fitted from several threads
        if sc.applicationId in _shipped:
            return
        root = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="riskframe-"), "riskframe.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.join("riskframe", os.path.relpath(path, root)))
        sc.addPyFile(target)
        _shipped.add(sc.applicationId)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the cluster's shared folder (``spark.checkpoint.dir``).

    A folder of our own is taken only on a local master, where driver and
    executors are one machine.  On a cluster an unset folder is an error: data
    checkpointed to one machine would be lost together with that machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the checkpoint folder, which all executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Cut the lineage of a frame that an iteration reads again and again."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, purpose: str):
    """``df`` as a Parquet table in the shared folder: computed once, read by column."""
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
