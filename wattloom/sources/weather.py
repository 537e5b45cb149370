"""Daily weather from a CSV export with a preamble above its header."""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.schemas import WEATHER_DATE_FORMAT


def normal_name(header: str) -> str:
    """Header text up to its unit, trimmed, lower case, blanks and dashes as underscores."""
    return re.sub(r"[ -]", "_", header.partition("(")[0].strip()).lower()


def read_weather(spark: SparkSession, path) -> DataFrame:
    """Weather rows under normalised names: ``time`` as text, all other columns as numbers.

    Each file is read under its own header, the first line whose first field is ``time``; what
    stands above it is a preamble. Files may order or choose their columns differently; a file
    without a header is a further part of the export if all others have the same one, and an
    error if not. Rows
    whose date is unreadable stay; ``unreadable_dates`` counts them. Files can be split between
    tasks: a line's place is the block it was read from and its order there.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    is_header = F.lower(F.trim(F.split("value", ",")[0])) == "time"
    first = F.min(F.struct("_block", "_line", "value")).alias("h")
    headers = lines.where(is_header).groupBy("_file").agg(first).select(
        "_file", F.col("h._block").alias("_from"), F.col("h._line").alias("_after"),
        F.col("h.value").alias("_header"))
    layouts = [r[0] for r in headers.select("_header").distinct().orderBy("_header").collect()]
    if not layouts:
        raise ValueError(f"no header line starting with 'time' in {path}")
    names = {h: [normal_name(n) for n in h.split(",")] for h in layouts}  # a few layouts
    width = max(map(len, names.values()))
    below = F.col("_from").isNull() | (F.col("_block") > F.col("_from")) | (
        (F.col("_block") == F.col("_from")) & (F.col("_line") > F.col("_after")))
    usual = F.lit(layouts[0]) if len(layouts) == 1 else F.raise_error(
        F.lit("a weather file has no header")).cast("string")
    fields = F.from_csv("value", ", ".join(f"_{i} string" for i in range(width)))
    rows = (lines.join(headers, "_file", "left")
            .where(below & (F.trim("value") != "") & ~is_header)
            .select(F.coalesce("_header", usual).alias("_header"), fields.alias("_f")))

    def cell(name):
        value = F.lit(None).cast("string")
        for header, columns in names.items():
            if name in columns:
                value = F.when(F.col("_header") == header, F.col(f"_f._{columns.index(name)}")
                               ).otherwise(value)
        return value

    others = dict.fromkeys(n for columns in names.values() for n in columns if n != "time")
    return rows.select(cell("time").alias("time"),
                       *[cell(n).try_cast("double").alias(n) for n in others])


def unreadable_dates(weather: DataFrame) -> DataFrame:
    """(rows, unreadable): how many rows have no readable ``time``."""
    bad = F.try_to_date("time", WEATHER_DATE_FORMAT).isNull()
    return weather.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("unreadable"))
