"""Session helpers: a local session for tests/bench and reliable checkpointing.

Library functions never build their own session; they take the caller's.
The only session-level thing they need is a *reliable* checkpoint directory
for the iterative graph jobs, which must live on storage every executor and
the driver can see (the cluster names it in ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Seconds that steps take whose shuffle files are worth a collection of the driver's garbage.
RELEASE_S = 8
# Paths written inside the innermost owned_tables().
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Delete superseded checkpoints (iteration rounds) once unreferenced;
        # a context-level setting, so clusters set it in their defaults.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    Order: the SparkContext's directory, else the session's
    ``spark.checkpoint.dir``. With neither, a local session (tests, local
    bench) gets a private temp folder; on a cluster this is an error, because
    no folder can be guessed that the driver and all executors share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and "
                               "all executors share (HDFS or an object store)")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shuffle_partitions(spark: SparkSession) -> int:
    """The cluster's configured shuffle width; iterative state is kept at it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table_path(spark: SparkSession, label: str) -> str:
    """A new path below the checkpoint directory; owned_tables() sees to it."""
    path = f"{ensure_checkpoint_dir(spark)}/tables/{label}-{uuid.uuid4().hex}"
    if (mine := _written.get()) is not None:
        mine.append(path)
    return path


def write_table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet below the checkpoint directory; return the
    re-read table and its path (for :func:`drop_table`).

    Cuts lineage like ``checkpoint()``, with compressed files, column pruning
    and exact sizes for the planner: a small table is broadcast only because
    its files are known to be small, a large one is joined by a shuffle.
    """
    spark = df.sparkSession
    path = table_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`write_table`, on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if (mine := _written.get()) is not None and path in mine:
        mine.remove(path)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """:func:`write_table` for a table that lives as long as its result, or
    until the end of the surrounding :func:`owned_tables`."""
    return write_table(df, label)[0]


def release_shuffles(spark: SparkSession, began: float) -> None:
    """Have Spark delete the shuffle files of steps that ended. It does so once the driver's
    garbage is collected, which else may be when the next steps have written theirs.

    Python's frames are let go of within a second, so after steps that took little time since
    ``began`` (of ``time.monotonic()``), whose files are small, nothing is done."""
    if time.monotonic() - began > RELEASE_S:
        for _ in range(2):                  # what the first collection lets go of holds the shuffles
            gc.collect()
            time.sleep(1.2)
            spark._jvm.System.gc()


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside belong to the job and are deleted at its end; the
    yielded function writes one that stays (its result, which must read no other).

    Scopes nest: what an inner job keeps belongs to the outer one."""
    outer, mine, kept = _written.get(), [], []
    token = _written.set(mine)

    def keep(df: DataFrame, label: str) -> DataFrame:
        out, path = write_table(df, label)
        mine.remove(path)
        kept.append(path)
        return out

    try:
        yield keep
    finally:
        _written.reset(token)
        for path in mine:
            drop_table(spark, path)
        if outer is not None:
            outer.extend(kept)
