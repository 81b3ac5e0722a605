"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shopmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        # Joins of facts with dimensions lean on adaptive execution: it turns
        # a join into a broadcast only when the measured side is small, and
        # splits a partition that one hot key has blown up.
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach; a private one only where none is named."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shopmart-"))
    return sc.getCheckpointDir()


FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = Lock()
_writes: Counter[SparkSession] = Counter()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends, not when the driver happens to collect its garbage.

    What is written is read from its files, so a job of many steps takes the disk of its largest step and of what it
    has written. Several threads may write; the setting goes back when the last one is done.
    """
    with _lock:
        if not _writes[spark]:
            spark.conf.set(FREES_SHUFFLES, "true")
        _writes[spark] += 1
    try:
        yield
    finally:
        with _lock:
            _writes[spark] -= 1
            if not _writes[spark]:
                del _writes[spark]
                spark.conf.unset(FREES_SHUFFLES)


def cut_lineage(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write `df` once to the shared folder and go on from the written columns.

    For results that are read several times: later plans neither repeat the
    work nor lose it with an executor. The shuffles behind it are freed.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
