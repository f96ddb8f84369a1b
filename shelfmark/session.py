"""Session settings that suit these jobs; everything else is left to the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings.  Page text is large, so batches to Python are kept small in rows and bytes.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream state with timers needs the store on disk.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings a session takes only when it starts.
AT_START = {
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site capture per expression
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "shelfmark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | AT_START | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
