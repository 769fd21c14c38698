"""Session construction and the shared scratch location.

On a cluster the operator of the job sets ``spark.checkpoint.dir`` to a
shared, durable folder; every lineage cut and intermediate table of this
package goes below it.  Only when it is unset and the master is local (tests,
local runs) is it a private folder under the system temp dir; on a cluster, where
executors would not see that folder, a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files of per-round state once it is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # state of unbounded streams is kept on disk, not in the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # plans with long regular expressions render to large strings; keep the
    # driver's execution history small in long sessions
    "spark.sql.maxPlanStringLength": "65536",
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def build_session(master: str | None = None, app: str = "sitelens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``sitelens`` importable in executors' Python workers (UDTFs,
    ``mapInPandas`` helpers) by shipping it as a zip once per context."""
    try:
        sc = spark.sparkContext
    except Exception:          # a session without a classic context: nothing to ship to
        return
    if getattr(sc, "_sitelens_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="sitelens-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._sitelens_shipped = True


def prepare(spark: SparkSession) -> str:
    """Checkpoint folder + shipped package: call once before running jobs."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one only
    when the cluster did not name one."""
    try:
        sc = spark.sparkContext
    except Exception:
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sitelens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint computed once: persist, checkpoint (its writing job
    then reads the persisted blocks instead of recomputing the plan), drop the
    persisted copy.  The result reads from the checkpoint folder, keeps the
    input's partitioning, and survives the loss of any executor."""
    from pyspark import StorageLevel
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = df.checkpoint(eager=True)
    finally:
        df.unpersist()
    return out


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables
    (per-round frontier state, stream sinks and their checkpoints)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str):
    """``df`` written to a scratch folder and read back: the plan is cut there.  Unlike a
    checkpoint's, the partitions are few if the rows are, so a loop that keeps a small
    table a round doesn't pay for empty tasks."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
