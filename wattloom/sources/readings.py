"""Delimited-text readings and Parquet tables."""

from pyspark.sql import DataFrame, SparkSession

from wattloom.operators.clean import conform_types
from wattloom.schemas import FIELD_SEPARATOR, MISSING_TOKEN, RAW_SCHEMA


def read_readings(spark: SparkSession, path, null_token: str | None = None,
                  schema=RAW_SCHEMA) -> DataFrame:
    """Raw readings, every column as text.

    ``null_token`` turns that token into NULL at the scan (profiling); ingestion leaves it in
    place and cleans it with the other missing forms.
    """
    reader = (spark.read.schema(schema).option("header", True).option("sep", FIELD_SEPARATOR))
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    return reader.csv(path)


def read_readings_for_profiling(spark: SparkSession, path) -> DataFrame:
    return read_readings(spark, path, null_token=MISSING_TOKEN)


def read_table(spark: SparkSession, path) -> DataFrame:
    """A Parquet table with its well-known columns conformed.

    Filters on ``Year``/``Month`` reach the scan as partition filters: those columns are not
    re-cast when partition discovery has already typed them.
    """
    df = spark.read.parquet(path)
    wanted = {"Year": "int", "Month": "int", "Date": "date", "Datetime": "timestamp"}
    typed = dict(df.dtypes)
    if all(typed[c] == t for c, t in wanted.items() if c in typed):
        return df
    return conform_types(df)
