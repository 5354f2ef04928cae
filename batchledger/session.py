"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "batchledger", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; cluster settings win where set."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Keyed state of the streams; Python reaches it over a socket file, not a port.
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    key = "spark.checkpoint.dir"
    named = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    named = named or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named


def ensure_shared_dir(spark: SparkSession) -> None:
    """For tests and benches: where nothing is set and all tasks run in this process, a folder of
    its own. On a cluster the setting stays required."""
    try:
        shared_dir(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="batchledger-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing exists there yet.

    What is written there is deleted when the driver ends.
    """
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: iterative plans stay short and survive lost executors."""
    spark = df.sparkSession
    directory = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(directory)
    return df.checkpoint(eager=True)
