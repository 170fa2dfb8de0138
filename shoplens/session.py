"""Session defaults shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on; cluster sizing is left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join may be split even when that costs one more exchange above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "shoplens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to a session someone else created."""
    for key, value in DEFAULTS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark
