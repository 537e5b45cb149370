"""What the physical plans must and must not contain."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from wattloom.operators import aggregates, order_stats, sketches
from wattloom.plans import catalog, standins

PACKAGE = pathlib.Path(catalog.__file__).parents[1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark, sf):
    text = plan(aggregates.daily_totals(standins.readings(spark, sf)))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,value:double>", text)


def test_date_filter_reaches_the_scan(spark, sf):
    orders = standins.table(spark, sf, "orders").where("o_orderkey > 100")
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,100)]" in plan(orders)


STREAMS_AND_MODELS = ("stream_", "train_", "best_", "cv_forest", "cv_boosted", "forest_", "permutation",
                      "score_forest", "model_registry", "session_report")


@pytest.mark.parametrize("name", [q for q in catalog.QUERIES
                                  if not q.startswith(STREAMS_AND_MODELS)])
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(catalog.QUERIES[name](spark, sf))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert word not in text


def test_feature_table_sorts_a_series_once(spark, sf):
    text = plan(standins.features(spark, sf, ("o_orderstatus",)))
    assert len(re.findall(r"\bWindow \[", text)) <= 3  # one per frame
    assert len(re.findall(r"Sort \[o_orderstatus", text)) <= 1


def test_raw_size_series_never_meet_in_one_task(spark, sf):
    text = plan(catalog.QUERIES["reading_lags"](spark, sf))
    singles = [line for line in text.splitlines() if "SinglePartition" in line]
    # The one gathering left is of the row counts per range.
    assert len(singles) == 1
    readings = standins.readings(spark, sf)
    for df in (order_stats.exact_medians(readings, ["Global_active_power"]),
               sketches.bloom_report(standins.table(spark, sf, "orders"), "o_custkey", "o_orderkey")):
        for part in re.split(r"Exchange SinglePartition", plan(df))[1:]:
            assert "partial_" in part.splitlines()[1] or "HashAggregate" in part


def test_library_has_no_forbidden_calls():
    source = "\n".join(p.read_text() for p in PACKAGE.rglob("*.py") if p.parent.name != "llm")
    for call in ("toPandas", "localCheckpoint", "crossJoin", ".rdd", "applyInPandas", "udf("):
        assert call not in source, call


def test_partial_sums_before_the_shuffle(spark, sf):
    text = plan(aggregates.hourly_patterns(standins.readings(spark, sf)))
    assert text.index("partial_avg") > text.index("Exchange hashpartitioning")


def test_written_tables_cut_the_lineage(spark, sf):
    from wattloom.session import written
    df = written(standins.daily_series(spark, sf).select("Date", F.col("total_kwh")), "t")
    assert "Exchange" not in plan(df)
