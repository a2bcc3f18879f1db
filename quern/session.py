"""Session settings, and the shared folder that written tables and checkpoints go to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Partitions that a shuffle starts with before AQE merges small ones.
INITIAL_PARTITIONS = "4000"

#: The setting that names the store of stream state, and the one of Spark's stores that takes `transformWithState`.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "quern", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings this library is tuned for; `conf` overrides any of them.

    A shuffle starts with many partitions and AQE merges the small ones, so one setting serves a small and a
    very large input. Local runs pass a small number of shuffle partitions to save task start-up.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.checkpoint.compress": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        STATE_STORE: ROCKSDB,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if "spark.sql.shuffle.partitions" not in conf:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = INITIAL_PARTITIONS
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    It is only made up on a local master, where driver and executors share one disk. A cluster without the
    setting is refused, since a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        # Spark appends a folder of its own to the directory it is given.
        return os.path.dirname(current.rstrip("/"))
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(made)
    return made


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else writes to."""
    return f"{shared_dir(spark)}/tables/{label}-{uuid.uuid4().hex}"


def new_name(label: str) -> str:
    """A name for a view or table that no other run of a query uses."""
    return f"{label}_{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    Reliable checkpoint files survive a lost executor.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str = "round") -> DataFrame:
    """Write the rows as a table in the shared folder and go on from there.

    A checkpoint keeps the optimizer's estimates, and a join multiplies those of its sides: after some rounds of joins of a
    table with itself they are numbers of millions of digits. A table has the size of its files.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
