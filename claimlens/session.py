"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML bodies are large: keep Arrow batches small for the parsing jobs.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def build_session(master: str | None = None, app_name: str = "claimlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session.  Where it is unset, a local session
    (tests) gets a folder of its own; a cluster raises, since a machine-local
    folder would be lost with its machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="claimlens-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str):
    """``df`` written once as Parquet beside the checkpoints, and read from
    there: for a table of which several others are made."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Set by a user whose input has too few splits for its CPU-heavy row-local work.
INPUT_PARTITIONS = "spark.claimlens.inputPartitions"


def spread(df, partitions: int | None = None):
    """Round-robin repartition to ``partitions``, or else to the session's
    ``INPUT_PARTITIONS``.  With neither, as by default, nothing moves and rows
    are worked on in the splits of their files."""
    partitions = partitions or df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    if partitions is None or df.isStreaming:          # micro-batches are planned per trigger
        return df
    return df.repartition(int(partitions))
