"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Results depend only on the first two; the rest shape execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs a later step one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows of one task: shuffles start with many partitions, which adaptive execution joins up to the advised size;
    # scans are cut finer, as a file's rows grow when they are read and must fit the buffer of a shuffle's writer.
    # So a task's rows do not grow with the tables, and neither does its memory.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "4m",
    # Encoded columns take many times their file's size in memory: broadcasts are judged by the latter.
    "spark.sql.sources.fileCompressionFactor": "16",
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    # Pivots keep this many small groups in a task's hash table before they sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chartloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
