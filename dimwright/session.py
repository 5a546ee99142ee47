"""Session helpers.

Library code never creates its own session settings on a cluster; it reads what
the session carries.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dimwright") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC).

    Partition discovery of a folder with many partitions (the date-partitioned
    fact) runs as a listing job with up to 10,000 tasks by default - sized for
    a large cluster; locally it is capped at twice the core count.
    """
    n_cores = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(2 * (n_cores or 8)))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    used as is.  Only a local-mode session without one (tests) gets a folder
    under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage before running mart jobs"
        )
    path = tempfile.mkdtemp(prefix="dimwright-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Open scratch blocks; each lists the work folders made since it began.
_scratch: list[list[str]] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for written tables, under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/dimwright/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    for block in _scratch:
        block.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system behind it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, with everything below it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


@contextmanager
def scratch(spark: SparkSession):
    """Work folders made inside the block are removed at its end.

    For steps whose result is a published table: nothing lazy may outlive the block.
    """
    made: list[str] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.remove(made)
        for path in made:
            delete_path(spark, path)
