"""Session helpers and the scratch tables of a run.

The library never creates a session on its own; ``build_session`` exists for
tests, the bench and the command-line entry points.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for. ``codegen.maxFields`` must exceed the
# number of MinHash columns (120 by default) or whole-stage codegen is switched
# off for the signature aggregation.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "200",
    # A shuffled hash join only where every partition of the built side was measured to fit.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "corate",
    driver_memory: str | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """A session with the recommended settings.

    Master, partitions, memory and the checkpoint directory are the submitter's
    (``spark-submit``, spark-defaults) unless passed here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without that setting (tests, the
    driver's smoke runs) gets a fresh scratch directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared directory; "
            "machine-local scratch space is not safe on a cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="corate-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


# Scratch tables written and not yet deleted; a scope owns those from its mark on.
_written: list[str] = []


def _hadoop_path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(sc._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint directory, which its owner (see ``materialize``) deletes."""
    path = f"{ensure_checkpoint_dir(spark)}/corate-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete a written path when the application ends."""
    found, system = _hadoop_path(spark, path)
    system.deleteOnExit(found)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint directory and read it back.

    Used where a derived table feeds many branches of a plan: the branches
    scan the written copy (with column pruning and file statistics for AQE)
    instead of re-running and re-planning its lineage, and the copy lives on
    the shared file system, so it survives executor loss.  One write job; an
    eager ``checkpoint()`` would compute its input twice.

    The table belongs to the innermost ``scratch_scope``, which deletes it; outside
    of any scope to the application, at whose end the file system deletes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    delete_at_exit(spark, path)
    return spark.read.parquet(path)


def release_scratch(spark: SparkSession, keep: int = 0) -> None:
    """Delete the scratch tables but for the first ``keep`` of those written."""
    while len(_written) > keep:
        found, system = _hadoop_path(spark, _written[-1])
        system.delete(found, True)
        system.cancelDeleteOnExit(found)
        _written.pop()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables of a ``with`` block at its end.

    Results that are still lazy read those tables: write or collect them inside.
    """
    mark = len(_written)
    try:
        yield
    finally:
        release_scratch(spark, mark)
