"""Exact order statistics (running counts, medians) without sorting a column in one task.

Values are first collapsed to distinct ones with their counts, and these are range-partitioned
and stored with the number of their range. Running counts inside a range are a window over that
range; what comes before it is read from a table of one row per feature and range. A value with
many copies is one row, and the ranges are cut to hold about equally many distinct values.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.session import written


def unpivot_columns(df: DataFrame, columns, keep=()) -> DataFrame:
    """One row per column and row: the kept columns, ``feature``, ``value`` (may be NULL)."""
    # -0.0 and 0.0 are one value; adding 0.0 makes them one group as well.
    typed = df.select(*keep, *[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in columns])
    return typed.unpivot(list(keep), list(columns), "feature", "value")


def unpivot_doubles(df: DataFrame, columns, keep=()) -> DataFrame:
    """As ``unpivot_columns``, without missing values."""
    return unpivot_columns(df, columns, keep).where("value IS NOT NULL AND NOT isnan(value)")


def running_counts(counts: DataFrame, measures, only: Column | None = None) -> DataFrame:
    """Add ``<measure>_before``, ``_upto`` and ``_total``: sums over smaller, smaller or equal,
    and all values of the feature.

    ``counts`` has one row per (feature, value). ``only`` drops ranges nobody asks for: it may
    use ``<measure>_offset`` and ``<measure>_end``, the sums before and up to the end of a range.
    """
    # Written, not cached: which range a row fell into must stay the same for all that follows,
    # also if executors are lost.
    ranged = written(counts.repartitionByRange("feature", "value")
                     .withColumn("_range", F.spark_partition_id()), "ranges")
    per_range = ranged.groupBy("feature", "_range").agg(
        *[F.sum(m).alias(f"_{m}") for m in measures])
    whole = Window.partitionBy("feature")
    upto = (whole.orderBy("_range")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = per_range.select("feature", "_range", *[
        c for m in measures for c in (
            F.sum(f"_{m}").over(upto).alias(f"{m}_end"),
            (F.sum(f"_{m}").over(upto) - F.col(f"_{m}")).alias(f"{m}_offset"),
            F.sum(f"_{m}").over(whole).alias(f"{m}_total"))])
    inside = (Window.partitionBy("feature", "_range").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = ranged.join(ends if only is None else ends.where(only), ["feature", "_range"])
    out = out.withColumns({
        f"{m}_upto": F.col(f"{m}_offset") + F.sum(m).over(inside) for m in measures})
    return out.select("feature", "value", *measures, *[
        c for m in measures for c in (F.col(f"{m}_total"), F.col(f"{m}_upto"),
                                      (F.col(f"{m}_upto") - F.col(m)).alias(f"{m}_before"))])


def exact_medians(df: DataFrame, columns) -> DataFrame:
    """(feature, median): the middle value, or the mean of the two middle values."""
    counts = (unpivot_doubles(df, columns).groupBy("feature", "value")
              .agg(F.count(F.lit(1)).alias("n")))
    # Ranks of the two middle rows, counted from 0; the same one if the count is odd.
    lower, upper = F.expr("(n_total - 1) div 2"), F.expr("n_total div 2")

    def holds(rank):
        return ((F.col("n_before") <= rank) & (rank < F.col("n_upto"))).cast("int")

    middle = (F.col("n_offset") <= upper) & (lower < F.col("n_end"))
    hits = (running_counts(counts, ["n"], middle)
            .withColumn("_hits", holds(lower) + holds(upper)).where("_hits > 0"))
    return hits.groupBy("feature").agg(
        (F.sum(F.col("value") * F.col("_hits")) / 2).alias("median"))


def impute_medians(df: DataFrame, columns, fitted_on: DataFrame | None = None) -> DataFrame:
    """Fill NULLs with the exact medians of ``fitted_on`` (by default the table itself)."""
    medians = exact_medians(df if fitted_on is None else fitted_on, columns)
    table = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), table[c]) for c in columns})
