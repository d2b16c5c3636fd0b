"""Session settings the engine relies on, and the shared scratch location."""

import uuid

from pyspark.sql import SparkSession

# Everything that renders or parses a timestamp assumes UTC. Small post-shuffle partitions are
# kept apart down to 64 kB because the cost of a partitioned write is per file, not per byte.
# HotSpot does not compile methods above 8,000 bytes, so larger generated ones are split instead.
# Senders repeat keys inside free values; the last one counts. The secret's padded keys are
# literals of exactly one SHA-256 block, which explain() and the UI must not show.
# Folders are listed by at most 64 tasks a level: with Spark's default of one task each, a table of many days
# spends more on starting tasks than on listing.
SESSION_SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.redaction.string.regex": "0x[0-9A-Fa-f]{128}|X'[0-9A-Fa-f]{128}'",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "slugline", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings the engine relies on to a session made elsewhere."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own, never used before, in the folder all executors share.

    The folder is the one the cluster names in `spark.checkpoint.dir`. A session without that
    setting uses its warehouse folder; where executors are on other machines and that is a local path, it raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local_path = base.startswith(("file:", "/")) or ":" not in base
        if local_path and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/slugline-{uuid.uuid4().hex}/{name}"
