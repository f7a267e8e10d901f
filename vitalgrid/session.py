"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles begin with many parts and are put together to about this size. So a task's share, and the memory of its
    # sorts, follows this size and not the input divided by the cores.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Split an oversized join partition even where that costs one more shuffle: a
    # patient may own a large share of all rows. A chunked window after a join on
    # the patient relies on it, as it would otherwise stay on the join's partitions.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this package is planned for."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def _shared_base(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or a temporary one in a local session.

    Only in a local session, where driver and executors are one process, is a
    folder of this machine visible to every task.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by the whole cluster")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    path = tempfile.mkdtemp(prefix=f"vitalgrid-{application}-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


#: Folders given out inside open ``scratch`` blocks.
_given: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach."""
    path = f"{_shared_base(spark)}/run-{uuid.uuid4().hex}"
    for block in _given:
        block.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the shared folders that are given out inside the block when it ends.

    For work that has written its result elsewhere by then: results are computed when they are
    read, so a frame must not leave the block unwritten.
    """
    block: list[str] = []
    _given.append(block)
    try:
        yield
    finally:
        _given[:] = [b for b in _given if b is not block]
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in block:
            at = hadoop.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once what a plan reads several times, by a reliable checkpoint.

    Meant for small tables between large ones (ids, visit facts): the stored
    copy survives lost executors and is the same for every reader.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_base(spark))
    return df.checkpoint(eager=True)
