"""Message streams: JSON objects from a Kafka topic or from files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattloom.schemas import MESSAGE_FIELDS

_CORRUPT = "_corrupt"


def kafka_options(servers: str, topic: str, group: str | None = None,
                  max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka source, reading the topic from its beginning."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_messages(spark: SparkSession, **options) -> DataFrame:
    """(key, value) text messages. Needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))


def file_messages(spark: SparkSession, path, max_files: int | None = None) -> DataFrame:
    """(key, value) messages from JSON-lines files as ``publish`` writes them, oldest first."""
    reader = spark.readStream.schema("key string, value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def table_stream(spark: SparkSession, path, schema, max_files: int | None = None,
                 nested=False) -> DataFrame:
    """Rows of the Parquet files at ``path`` (a directory or a glob) as a stream; with ``nested``
    also of those in folders below it, whatever their names."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", nested)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def parse_messages(messages: DataFrame, fields=tuple(MESSAGE_FIELDS), keep=()) -> DataFrame:
    """Fields of JSON-object messages as text; every other message is skipped.

    Absent fields are NULL. Numbers stay text here, because one unreadable number must not cost
    the message; readers cast what they use. ``event_time`` is NULL if it cannot be parsed.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, _CORRUPT]])
    body = F.from_json("value", schema, {"mode": "PERMISSIVE",
                                         "columnNameOfCorruptRecord": _CORRUPT})
    # A generator, because a filter on a plain column of from_json would be pushed below the
    # projection and parse every message again.
    parsed = messages.select(*keep, F.inline(F.array_compact(F.array(body))))
    out = parsed.where(F.col(_CORRUPT).isNull()).select(*keep, *fields)
    if "event_timestamp" in fields:
        out = out.withColumn("event_timestamp", F.col("event_timestamp").try_cast("bigint"))
    if "Datetime" in fields:
        out = out.withColumn("event_time", F.col("Datetime").try_cast("timestamp"))
    return out
