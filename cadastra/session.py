"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # No call-site capture for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "cadastra", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects.

    On a cluster leave ``master`` unset and pass ``spark.sql.shuffle.partitions``
    for the data size (2-3 times the executor cores); AQE merges what is too small.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder, because there driver and executors share the disk.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cadastra-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder, so that every later use sees the
    same rows even when executors are lost.

    It is kept as a Parquet table: later uses read only the columns they need, and its file size
    lets Spark judge whether it can be broadcast.
    """
    folder = ensure_checkpoint_dir(df.sparkSession)
    if any(isinstance(f.dataType, NullType) for f in df.schema.fields):
        return df.checkpoint()
    path = f"{folder}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
