"""Session settings the library relies on, and lineage cutting that survives executor loss."""

from __future__ import annotations

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Functions of this package travel to the executors whole; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# Runtime SQL settings that results or hot-key handling depend on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when a later operator wanted the same partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "weirflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's checkpoint folder, or a test folder where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="weirflow-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to the checkpoint folder, so that a lost executor replays files and not the whole history."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
