"""Chronological train/test split and expanding-window folds.

Both cut at a date found from row counts per date, a table bounded by the calendar; the data
itself is never sorted or numbered. With one row per date the cut falls exactly on the wanted
position. If several rows share the boundary date they stay together, on the test side.
"""

from pyspark.sql import DataFrame, Window, functions as F

from wattloom.schemas import CV_SPLITS, TRAIN_RATIO


def _date_positions(df: DataFrame, date: str) -> DataFrame:
    """Per date: rows before it, rows up to and including it, rows in total."""
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (counts.withColumn("_upto", F.sum("_n").over(upto))
            .withColumn("_total", F.sum("_n").over(Window.partitionBy()))
            .withColumn("_before", F.col("_upto") - F.col("_n")))


def split_point(df: DataFrame, ratio=TRAIN_RATIO, date="Date") -> DataFrame:
    """(n_rows, n_train, cutoff): the first date of the test side."""
    train = F.floor(F.col("_total") * F.lit(float(ratio)))
    cut = _date_positions(df, date).withColumn("_train", train)
    is_test = F.col("_upto") > F.col("_train")
    return cut.agg(
        F.max("_total").alias("n_rows"),
        F.coalesce(F.sum(F.when(~is_test, F.col("_n"))), F.lit(0)).alias("n_train"),
        F.min(F.when(is_test, F.col(date))).alias("cutoff"))


def time_split(df: DataFrame, ratio=TRAIN_RATIO, date="Date") -> DataFrame:
    """Add ``split``: 'train' for the first ``ratio`` of the rows, 'test' for the rest."""
    cutoff = split_point(df, ratio, date).select("cutoff").scalar()
    return df.withColumn(
        "split", F.when(cutoff.isNull() | (F.col(date) < cutoff), "train").otherwise("test"))


def fold_of_dates(df: DataFrame, n_splits=CV_SPLITS, date="Date") -> DataFrame:
    """(date, fold, _n): the fold each date is tested in; 0 for the dates only trained on."""
    size = F.floor(F.col("_total") / (n_splits + 1))
    first = F.col("_total") - size * n_splits
    fold = F.when(F.col("_before") < first, F.lit(0)).otherwise(
        F.floor((F.col("_before") - first) / size) + 1)
    return _date_positions(df, date).select(date, fold.cast("int").alias("fold"), "_n")


def cv_folds(df: DataFrame, n_splits=CV_SPLITS, date="Date") -> DataFrame:
    """Add ``fold``. Fold k tests the rows with ``fold == k`` and trains on ``fold < k``."""
    return df.join(fold_of_dates(df, n_splits, date).drop("_n"), date)


def fold_summary(df: DataFrame, n_splits=CV_SPLITS, date="Date") -> DataFrame:
    """Size and date range of every fold."""
    folds = fold_of_dates(df, n_splits, date).groupBy("fold").agg(
        F.sum("_n").alias("n_test"), F.min(date).alias("test_from"), F.max(date).alias("test_to"))
    before = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    return (folds.withColumn("n_train", F.sum("n_test").over(before)).where(F.col("fold") > 0)
            .select("fold", "n_train", "n_test", "test_from", "test_to"))
