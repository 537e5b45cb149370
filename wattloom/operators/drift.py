"""Feature drift between two sides of a table: PSI and the two-sample KS test.

All features are handled together, unpivoted to (feature, value) and collapsed per feature and
bin (PSI) or per feature and distinct value (KS) before any shuffle.
"""

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.classes import psi_class
from wattloom.functions.numbers import steady_round
from wattloom.operators.order_stats import running_counts, unpivot_doubles
from wattloom.schemas import (DRIFT_FEATURES, DRIFT_MIN_ROWS, KS_ALPHA, PSI_BINS, PSI_EDGE,
                              PSI_EMPTY)


def _sides(df: DataFrame, features, split: str) -> DataFrame:
    """(split, feature, value) of the features present."""
    return unpivot_doubles(df, [f for f in features if f in df.columns], keep=(split,))


def _is(split: str, side: str) -> Column:
    return F.col(split) == side


def _bin_no(bins: int) -> str:
    """SQL: the bin of ``value`` among equal-width bins over [lo, hi], NULL if in none.

    The outer edges reach slightly further than the range.
    """
    inner = " + ".join(f"cast(value >= {i} * ((hi - lo) / {bins}) + lo as int)"
                       for i in range(1, bins))
    edge = f"{PSI_EDGE!r}D"
    return f"CASE WHEN value BETWEEN lo - {edge} AND hi + {edge} THEN {inner} END"


def psi(df: DataFrame, features=tuple(DRIFT_FEATURES), split="split", bins=PSI_BINS,
        min_rows=DRIFT_MIN_ROWS) -> DataFrame:
    """(feature, psi, psi_status) of train against test.

    Bins span the train range. Test values outside it fall in no bin but count in the share's
    denominator. Features with fewer than ``min_rows`` values on a side are left out.
    """
    values = _sides(df, features, split)
    train, test = _is(split, "train"), _is(split, "test")
    # One row per feature: at most as many rows as the table has columns.
    ranges = (values.groupBy("feature")
              .agg(F.min(F.when(train, F.col("value"))).alias("_min"),
                   F.max(F.when(train, F.col("value"))).alias("_max"),
                   F.count_if(train).alias("n_train"), F.count_if(test).alias("n_test"))
              .where((F.col("n_train") >= min_rows) & (F.col("n_test") >= min_rows))
              # A constant feature gets a range of width one around its value.
              .withColumn("lo", F.when(F.col("_min") == F.col("_max"), F.col("_min") - 0.5)
                          .otherwise(F.col("_min")))
              .withColumn("hi", F.when(F.col("_min") == F.col("_max"), F.col("_max") + 0.5)
                          .otherwise(F.col("_max")))
              .drop("_min", "_max"))
    binned = values.join(F.broadcast(ranges), "feature").select(
        "feature", F.col(split).alias("side"), "n_train", "n_test",
        F.expr(_bin_no(bins)).alias("bin"))
    counts = binned.groupBy("feature", "n_train", "n_test").agg(*[
        F.expr(f"count_if(side = '{side}' AND bin = {i}) AS {side}_{i}")
        for i in range(bins) for side in ("train", "test")])

    def share(side, i):
        return f"if({side}_{i} = 0, {PSI_EMPTY!r}D, {side}_{i} / n_{side})"

    terms = [f"({share('test', i)} - {share('train', i)})"
             f" * ln({share('test', i)} / {share('train', i)})" for i in range(bins)]
    return (counts.select("feature", F.expr(" + ".join(terms)).alias("psi"))
            .withColumn("psi_status", psi_class(F.col("psi"))))


def kolmogorov_p(statistic: str, n1: str, n2: str, terms=60) -> Column:
    """Asymptotic two-sided p-value: 2 * sum of (-1)**(k-1) * exp(-2 k**2 lambda**2)."""
    lam2 = f"({statistic} * {statistic} * {n1} * {n2} / ({n1} + {n2}))"
    series = (f"aggregate(sequence(1, {terms}), 0D, (s, k) -> "
              f"s + if(k % 2 = 1, 2D, -2D) * exp(-2D * k * k * {lam2}))")
    # Below lambda = 0.2 the sum is 1 to twelve digits, but converges too slowly to show it.
    return F.expr(f"CASE WHEN {lam2} < 0.04 THEN 1D ELSE least(1D, greatest(0D, {series})) END")


def ks(df: DataFrame, features=tuple(DRIFT_FEATURES), split="split",
       min_rows=DRIFT_MIN_ROWS) -> DataFrame:
    """(feature, ks_statistic, ks_pvalue, ks_result): largest gap of the two distributions."""
    counts = _sides(df, features, split).groupBy("feature", "value").agg(
        F.count_if(_is(split, "train")).alias("train"),
        F.count_if(_is(split, "test")).alias("test"))
    gap = F.abs(F.col("train_upto") / F.col("train_total")
                - F.col("test_upto") / F.col("test_total"))
    return (running_counts(counts, ["train", "test"])
            .where((F.col("train_total") >= min_rows) & (F.col("test_total") >= min_rows))
            .groupBy("feature", F.col("train_total").alias("n_train"),
                     F.col("test_total").alias("n_test"))
            .agg(F.max(gap).alias("ks_statistic"))
            .withColumn("ks_pvalue", kolmogorov_p("ks_statistic", "n_train", "n_test"))
            .withColumn("ks_result", F.when(F.col("ks_pvalue") < KS_ALPHA, "drift detected")
                        .otherwise("no drift")))


def drift_table(df: DataFrame, features=tuple(DRIFT_FEATURES), split="split") -> DataFrame:
    """PSI and KS side by side, rounded."""
    return psi(df, features, split).join(ks(df, features, split), "feature").select(
        "feature", steady_round("psi", 4).alias("psi"), "psi_status",
        steady_round("ks_pvalue", 4).alias("ks_pvalue"), "ks_result")


def drift_report(df: DataFrame, version, run_at: Column | None = None,
                 features=tuple(DRIFT_FEATURES), split="split") -> DataFrame:
    """One row with the results as an array of structs (one per feature)."""
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if run_at is None else run_at
    result = F.struct("feature", "psi", "psi_status", "ks_pvalue", "ks_result")
    return drift_table(df, features, split).agg(
        when.alias("run_at"), F.lit(version).alias("model_version"),
        F.count(F.lit(1)).alias("features_checked"),
        F.sort_array(F.collect_list(result)).alias("results"))
