"""Session helpers: one place for the configuration the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator assumes.  Event time is UTC; AQE re-plans joins and
# partition counts at runtime from real shuffle statistics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

STATE_STORE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tidepool", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides; in tests
    a ``local[N]`` master is passed.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event-time arithmetic in this library is defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in spark.checkpoint.dir.

    A session without one gets a fresh folder only in local mode (one process, as in tests); on a
    cluster a machine-local folder would not be seen by the executors, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df, name: str = "materialized"):
    """Compute ``df`` once and cut its lineage: write it as a parquet table under
    the shared ``spark.checkpoint.dir`` and read it back (never a local
    checkpoint).  Use it where several branches of a plan read the same
    expensive intermediate; unlike ``checkpoint()``, the input is computed
    once and stored columnar."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir.

    Used for data Spark writes and reads back (CSV round trips, stream replay
    files, streaming checkpoints).  Never a machine-local folder on a cluster.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidepool-{name}-{uuid.uuid4().hex[:12]}"


STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"




__all__ = ["build_session", "ensure_utc", "ensure_checkpoint_dir", "scratch_path", "materialize",
           "DEFAULT_CONF", "STATE_STORE_KEY", "STATE_STORE_PROVIDER"]
