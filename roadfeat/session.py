"""Spark session defaults for the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed partitions also where that costs the aggregation above another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lets the CSV reader decode cp949 / euc-kr.
    "spark.sql.legacy.javaCharsets": "true",
    # Checkpoint files go when the frames that read them do.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Lets Python data sources take conditions; shapefiles meet those on the box of a record.
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Parquet sizes on disk understate what a broadcast holds in memory; the
    # planner's size checks work on this multiple of the file size.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Largest table, by the planner's estimate, that is sent to every task.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "roadfeat", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    settings = dict(DEFAULTS)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            settings["spark.driver.host"] = "127.0.0.1"
            settings["spark.driver.bindAddress"] = "127.0.0.1"
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
