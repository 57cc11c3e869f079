"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every operator assumes. All can be set on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows go to Python workers in batches of at most so much, however long they are
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # HotSpot leaves methods over 8000 bytes uncompiled; below that Spark splits wide projections instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Where whole rows are sorted and stored: files are read in small splits, shuffles are cut finely and Spark puts parts together
# up to this size, so a task's memory depends neither on the table's size nor on the session's number of partitions.
FINE = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

_scratch: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("txnwatch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built, and send this package to its Python workers."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        spark.sparkContext.addPyFile(_package_archive())
        _shipped.add(app)
    return spark


@contextmanager
def fine_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside get tasks of bounded size; afterwards the session is as it was."""
    before = {key: spark.conf.get(key, None) for key in FINE}
    try:
        for key, value in FINE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _package_archive() -> str:
    """This package as a zip that Spark hands to every executor."""
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="txnwatch-package-"), "txnwatch.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    return archive


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` starts executors of their own)."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application's own inside the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder on a cluster. Where it is unset, a temporary folder
    stands in for it under a local master only; executors on other machines could not see that folder.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not is_local(spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            shared = tempfile.mkdtemp(prefix="txnwatch-")
            spark.sparkContext.setCheckpointDir(f"{shared}/checkpoints")
        _scratch[app] = f"{shared.rstrip('/')}/txnwatch-{app}"
    return _scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used before, so nothing ever needs clearing."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
