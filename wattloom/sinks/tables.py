"""Parquet, JSON and message sinks. Base paths may be any URI Spark can write (s3a, hdfs, file)."""

from pyspark.sql import DataFrame, SparkSession, functions as F


# Fixed layout below the base path.
LAYOUT = {
    "raw_readings": "raw/power_consumption",
    "raw_weather": "raw/weather",
    "cleaned": "processed/power_cleaned",
    "hourly": "batch/hourly_patterns",
    "daily": "batch/daily_totals",
    "monthly": "batch/monthly_summary",
    "submetering": "batch/submetering_daily",
    "daily_weather": "batch/daily_with_weather",
    "features": "ml/features",
    "predictions": "serving/predictions",
    "predictions_monthly": "serving/predictions_monthly",
    "monitoring": "serving/monitoring/rolling_metrics",
    "drift": "serving/monitoring/drift_report",
    "registry": "model-registry",
    "stream": "streaming",
}
PARTITIONS = {
    "cleaned": ("Year", "Month"),
    "daily": ("Year", "Month"),
    "monthly": ("Year",),
    "submetering": ("Year", "Month"),
    "daily_weather": ("Year", "Month"),
}


def location(base: str, dataset: str) -> str:
    return f"{base.rstrip('/')}/{LAYOUT[dataset]}"


def write_parquet(df: DataFrame, path: str, partition_by=(), rows_per_file: int = 0) -> None:
    """Overwrite a Parquet table, Hive-partitioned if columns are given.

    The rebalance hint groups rows by partition value to bound the number of files, and lets
    adaptive execution split a value that holds too much for one task. ``rows_per_file`` bounds
    the rows of a file: few bytes may be much work, and a small file is read by one task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by) -> None:
    """Write the partitions that ``df`` has rows of anew, and leave all others as they are.

    Running it again gives the same table. New files are written aside and moved in place when
    all tasks are done, so a write that fails leaves the old partitions readable. Without rows
    nothing changes; a table that does not exist yet is made.
    """
    (df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


class JavaFolder:
    """A folder of any file system that Spark can write, into which others can be moved."""

    def __init__(self, spark: SparkSession, path: str):
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.as_path, self.path = jvm.org.apache.hadoop.fs.Path, path
        self.store = self.as_path(path).getFileSystem(conf)
        self.store.mkdirs(self.as_path(path))

    def take(self, folder: str) -> None:
        """Move a folder with all its files in here, in one step where the store can rename.

        The new path is told in full: moved to a folder that has files already, it would be copied
        file by file on a local disk, and a stream would take up a part of it.
        """
        source = self.as_path(folder)
        if not self.store.rename(source, self.as_path(self.path, source.getName())):
            raise OSError(f"{folder} could not be moved to {self.path}")


def land(df: DataFrame, base: str, dataset: str) -> str:
    """Write a dataset to its place in the layout."""
    path = location(base, dataset)
    write_parquet(df, path, PARTITIONS.get(dataset, ()))
    return path


def validate_counts(spark: SparkSession, path: str, expected: int, label: str) -> DataFrame:
    """(label, expected_rows, actual_rows, status) from reading the table back."""
    actual = F.count(F.lit(1))
    return spark.read.parquet(path).agg(
        F.lit(label).alias("label"), F.lit(expected).cast("bigint").alias("expected_rows"),
        actual.alias("actual_rows"),
        F.when(actual == expected, "PASS").otherwise("FAIL").alias("status"))


def sample_rows(spark: SparkSession, path: str, n=3) -> DataFrame:
    return spark.read.parquet(path).limit(n)


def write_report(report: DataFrame, path: str) -> None:
    """Append one-row reports as JSON lines."""
    report.write.mode("append").json(path)


def as_messages(df: DataFrame, limit: int | None = None, time="Datetime",
                stamp=None, keep=()) -> DataFrame:
    """(key, value): all rows as keyed JSON objects, or the first ``limit`` in time order.

    NaN and NULL become JSON null, timestamps text; ``event_timestamp`` is the sending time in
    milliseconds.
    """
    text_time = F.date_format(time, "yyyy-MM-dd HH:mm:ss")
    columns = []
    for name, dtype in df.dtypes:
        col = F.col(name)
        if dtype in ("double", "float"):
            col = F.when(~F.isnan(col), col)
        elif dtype.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        columns.append(col.alias(name))
    stamp = F.unix_millis(F.current_timestamp()) if stamp is None else stamp
    body = F.to_json(F.struct(*columns, stamp.alias("event_timestamp")),
                     {"ignoreNullFields": "false"})
    if limit is not None:
        df = df.orderBy(time).limit(limit)
    return df.select(*keep, text_time.alias("key"), body.alias("value"))


def publish(messages: DataFrame, servers: str | None = None, topic: str | None = None,
            path: str | None = None) -> None:
    """Send messages to a Kafka topic, or write them as JSON lines."""
    if topic:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
    else:
        messages.write.mode("append").json(path)
