"""Text to cleaned, partitioned Parquet, with counts and read-back validation."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wattloom.operators.clean import clean_readings, clean_weather
from wattloom.schemas import RAW_SCHEMA
from wattloom.sinks.tables import land, location, validate_counts, write_parquet
from wattloom.sources.readings import read_readings
from wattloom.sources.weather import read_weather


def ingest(spark: SparkSession, readings_path, weather_path, base: str) -> DataFrame:
    """Land raw readings, raw weather and cleaned readings; return the validation report.

    Row counts are observed while the tables are written, so nothing is scanned just to count.
    The text is parsed once: cleaning starts from the landed raw table.
    """
    write_parquet(read_readings(spark, readings_path), location(base, "raw_readings"))
    raw = spark.read.schema(RAW_SCHEMA).parquet(location(base, "raw_readings"))
    weather = read_weather(spark, weather_path)

    def counted(df, dataset):
        seen = Observation(dataset)
        land(df.observe(seen, F.count(F.lit(1)).alias("rows")), base, dataset)
        return validate_counts(spark, location(base, dataset), seen.get["rows"], dataset)

    return (counted(clean_readings(raw), "cleaned")
            .unionByName(counted(weather, "raw_weather")))


def land_clean_weather(spark: SparkSession, base: str) -> DataFrame:
    return clean_weather(spark.read.parquet(location(base, "raw_weather")))
