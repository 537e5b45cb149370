"""What Spark does underneath: pruned scans, filtered shuffles, replaced partitions, sketches in
columns, stream state and reports, stored pipelines."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattloom.operators import joins, learning, registry, sketches, splits
from wattloom.plans import standins
from wattloom.plans.catalog import QUERIES
from wattloom.session import fresh_path, written
from wattloom.sinks.tables import replace_partitions, write_parquet
from wattloom.sources.messages import table_stream
from wattloom.streaming import runs


def moved(spark, work):
    """(rows read, bytes shuffled) by the stages of a piece of work."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def stages():
        none = gateway.new_array(gateway.jvm.double, 0)
        found = store.stageList(None, False, False, none, None)
        return {(s.stageId(), s.attemptId()): (s.inputRecords(), s.shuffleWriteBytes())
                for s in (found.apply(i) for i in range(found.size()))}
    before = stages()
    result = work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    new = [v for k, v in stages().items() if k not in before]
    return result, sum(v[0] for v in new), sum(v[1] for v in new)


@pytest.fixture
def by_month(spark):
    path = fresh_path(spark, "by-month")
    rows = spark.range(24_000).select(
        "id", (F.col("id") % 2 + 2006).cast("int").alias("Year"),
        (F.floor(F.col("id") / 2) % 12 + 1).cast("int").alias("Month"))
    write_parquet(rows, path, ("Year", "Month"))
    return path


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if "=" in d}


def test_a_filtered_calendar_prunes_the_scan(spark, by_month):
    calendar = written(spark.read.parquet(by_month).select("Year", "Month").distinct()
                       .withColumn("season", F.floor(F.col("Month") / 4)), "calendar")
    stored = spark.read.parquet(by_month)
    joined = joins.join_calendar(stored, calendar.where("season = 0 AND Year = 2007"))
    n, read, _ = moved(spark, lambda: len(joined.collect()))
    assert n == 3_000 and read <= 3_000 + 24
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()


def test_one_month_is_replaced(spark, by_month):
    before = files_of(by_month)
    march = spark.read.parquet(by_month).where("Year = 2007 AND Month = 3")
    fixed = written(march.withColumn("id", -F.col("id")), "march")
    for _ in range(2):
        replace_partitions(fixed, by_month, ("Year", "Month"))
        after = files_of(by_month)
        same = {f: t for f, t in before.items() if "Year=2007/Month=3/" not in f}
        assert {f: t for f, t in after.items() if "Year=2007/Month=3/" not in f} == same
        stored = spark.read.parquet(by_month)
        assert stored.count() == 24_000 and stored.where("id < 0").count() == 1_000
    bad = fixed.withColumn("id", F.when(F.col("id") < -20_000, F.raise_error("broken")).otherwise(1))
    with pytest.raises(PySparkException):
        replace_partitions(bad, by_month, ("Year", "Month"))
    assert spark.read.parquet(by_month).where("id < 0").count() == 1_000
    replace_partitions(fixed.limit(0), by_month, ("Year", "Month"))
    assert spark.read.parquet(by_month).count() == 24_000


@pytest.mark.parametrize("how", ["inner", "leftsemi"])
def test_a_bloom_filter_cuts_the_shuffle(spark, how):
    large = written(spark.range(200_000).select(
        (F.col("id") % 50_000).alias("k"), F.rand(1).alias("x")), "large")
    small = written(spark.range(50_000).select(F.col("id").alias("key"), (F.col("id") % 500)
                                               .alias("kind")), "small").where("kind = 7")
    old = {name: spark.conf.get(name, None) for name in (
        "spark.sql.autoBroadcastJoinThreshold", *sketches.RUNTIME_FILTER)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    try:
        plain = large.join(small, F.col("k") == F.col("key"), how)
        expected, _, whole = moved(spark, lambda: sorted(map(tuple, plain.collect())))
        joined = sketches.bloom_join(large, small, "k", "key", how)
        got, _, cut = moved(spark, lambda: sorted(map(tuple, joined.collect())))
        assert "might_contain" in joined._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert got == expected and len(got) == 400 and cut < whole / 4
    with pytest.raises(ValueError):
        sketches.bloom_join(large, small, "k", "key", "left")


# ---- sketches in columns -----------------------------------------------------------------

def test_native_sketches(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.zipf(1.3, 20_000) % 5_000, [-5, -5, 2 ** 62, -2 ** 63]])
    rows = spark.createDataFrame(pd.DataFrame({"k": values, "day": np.arange(len(values)) % 5}))
    rows = rows.union(spark.createDataFrame([(None, 0)], "k long, day long"))
    eps = 0.005
    daily = sketches.cms_native(rows, "k", ["day"], eps=eps)
    merged = sketches.cms_native_merge(daily.repartition(3))
    whole = sketches.cms_native(rows, "k", eps=eps)
    assert merged.first()["sketch"] == whole.first()["sketch"]
    exact = rows.groupBy("k").agg(F.count("k").alias("n"))
    out = sketches.cms_native_query(exact.join(F.broadcast(merged)), "k").collect()
    errors = [r.cms_estimate - r.n for r in out]
    assert min(errors) >= 0 and len(out) == exact.count()
    assert np.mean([e > eps * len(values) for e in errors]) <= 1 - 0.9921875
    # The same counters as the JVM's own class answers with.
    stream = spark._jvm.java.io.ByteArrayInputStream(bytes(whole.first()["sketch"]))
    own = spark._jvm.org.apache.spark.util.sketch.CountMinSketch.readFrom(stream)
    for r in out[:200]:
        if r.k is not None:
            assert own.estimateCount(int(r.k)) == r.cms_estimate
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan
    by_day = sketches.cms_native_merge(daily.union(daily), ["day"])
    assert by_day.count() == 5
    assert sum(sketches.opened_sketch(r.sketch)[0] for r in by_day.collect()) == 2 * len(values)
    other = sketches.cms_native(rows, "k", eps=eps, seed=1)
    with pytest.raises(PySparkException):
        sketches.cms_native_merge(whole.union(other)).collect()
    assert sketches.cms_native_merge(daily.limit(0)).count() == 0


# ---- streams -----------------------------------------------------------------------------

def write_keys(spark, path, batches):
    for keys in batches:
        spark.createDataFrame([(k,) for k in keys], "key string").coalesce(1).write.mode(
            "append").parquet(path)


def deduplicated(spark, path, out, check, **options):
    stream = table_stream(spark, path, "key string", max_files=1)
    unique = runs.drop_near_duplicates(stream, "key", **options)
    query = runs.start(unique, runs.per_trigger_sink(out), check, "append", available_now=True)
    runs.finish(query, log=f"{out}-log")
    return sorted(r["key"] for r in spark.read.parquet(out).collect())


def test_dedup_state_is_the_filter(spark):
    """Same outcome as the batch filter, in one go or stopped in between; bounded state."""
    rng = np.random.default_rng(4)
    batches = [[str(k) for k in rng.integers(0, 900, 150)] for _ in range(5)]
    batches[2] += [None, "x", "x"]
    options = dict(capacity=150, shards=3)
    whole, parts = fresh_path(spark, "whole"), fresh_path(spark, "parts")
    write_keys(spark, f"{whole}/in", batches)
    once = deduplicated(spark, f"{whole}/in", f"{whole}/out", f"{whole}/check", **options)
    rows = spark.createDataFrame([(k, i) for i, b in enumerate(batches) for k in b],
                                 "key string, i int")
    batch = sketches.bloom_first_seen(rows, "key", "i", **options)
    assert once == sorted(r["key"] for r in batch.where("is_new").collect())
    assert len(once) < rows.select("key").where("key IS NOT NULL").distinct().count()
    write_keys(spark, f"{parts}/in", batches[:2])
    deduplicated(spark, f"{parts}/in", f"{parts}/out", f"{parts}/check", **options)
    write_keys(spark, f"{parts}/in", batches[2:])
    again = deduplicated(spark, f"{parts}/in", f"{parts}/out", f"{parts}/check", **options)
    assert again == once
    words = 3 * -(-sketches.bloom_shape(50, 0.01)[0] // 64)
    most = runs.progress_report(spark, f"{whole}/out-log").agg(F.max("state_rows")).first()[0]
    assert 0 < most <= words


def test_dedup_state_in_a_session_with_another_store(spark):
    """The stream gets the store its state asks for; the session keeps its own."""
    path, plain = fresh_path(spark, "store"), spark.newSession()
    plain.conf.set(runs.STATE_STORE, "org.apache.spark.sql.execution.streaming.state."
                                     "HDFSBackedStateStoreProvider")
    before = plain.conf.get(runs.STATE_STORE)
    write_keys(plain, f"{path}/in", [["a", "b", "a"], ["b", "c"]])
    stream = table_stream(plain, f"{path}/in", "key string", max_files=1)
    query = runs.start(runs.drop_near_duplicates(stream, "key", shards=2),
                       runs.per_trigger_sink(f"{path}/out"), f"{path}/check", "append",
                       available_now=True, state_store=runs.ROCKS_DB)
    runs.finish(query)
    assert sorted(r["key"] for r in plain.read.parquet(f"{path}/out").collect()) == [
        "a", "b", "c"]
    assert plain.conf.get(runs.STATE_STORE) == before != runs.ROCKS_DB


def test_stream_dedup_state_in_a_plain_session(spark, sf):
    plain = spark.newSession()
    plain.conf.set(runs.STATE_STORE, "org.apache.spark.sql.execution.streaming.state."
                                     "HDFSBackedStateStoreProvider")
    plain.conf.set("spark.sql.shuffle.partitions", "4")
    found = QUERIES["stream_dedup_state"](plain, sf).collect()
    assert sorted(found) == sorted(QUERIES["stream_dedup_state"](spark, sf).collect()) != []


def test_dedup_state_with_a_time_limit(spark):
    path = fresh_path(spark, "ttl")
    write_keys(spark, f"{path}/in", [["a", "b", "a"], ["b", "c"]])
    # State that expires asks for triggers without data, so a bounded run has to do without them.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        found = deduplicated(spark, f"{path}/in", f"{path}/out", f"{path}/check", ttl="7 days")
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert found == ["a", "b", "c"]


def test_every_fast_trigger_is_reported(spark):
    path = fresh_path(spark, "fast")
    spark.range(0, 300, 1, 150).write.parquet(f"{path}/in")
    stream = runs.observed(table_stream(spark, f"{path}/in", "id long", max_files=1))
    # What the stream received is counted before rows are dropped.
    query = runs.start(stream.where("id % 2 = 0"),
                       lambda batch, n: batch.write.format("noop").mode("overwrite").save(),
                       f"{path}/check", "append", available_now=True)
    runs.finish(query, log=f"{path}/log", poll=3600.0)
    log = runs.progress_report(spark, f"{path}/log").orderBy("batch_id").collect()
    assert [r.batch_id for r in log] == list(range(150))
    assert len(query.recentProgress) <= 101
    assert runs.live_summary(spark, f"{path}/log").first()["total_received"] == 300


# ---- stored pipelines --------------------------------------------------------------------

@pytest.fixture(scope="module")
def table(spark, sf):
    features = standins.features(spark, sf)
    target = F.col("temp_mean_c") * 2 + F.col("day_of_week")
    known = features.where(F.col("temp_mean_c").isNotNull()).withColumn("total_kwh", target)
    holes = F.when(F.dayofmonth("Date") % 3 == 0, F.lit(None)).otherwise(F.col("precip_mm"))
    return written(splits.time_split(known.withColumn("precip_mm", holes)), "features")


@pytest.mark.parametrize("estimator", [lambda: learning.forest(numTrees=5, maxDepth=4),
                                       lambda: learning.boosted(maxIter=4, maxDepth=3)])
def test_a_stored_pipeline_scores_like_the_training(spark, table, estimator):
    features = ["temp_mean_c", "day_of_week", "precip_mm"]
    fitted = learning.train_and_test(estimator(), table.withColumn(
        "nothing", F.lit(None).cast("double")), "m", features=[*features, "nothing"])
    base = fresh_path(spark, "registry")
    registry.register(spark, base, fitted, "v1", ("", ""), ("", ""), now="2024-01-01 00:00:00")
    registry.register(spark, base, fitted, "v2", ("", ""), ("", ""), now="2024-01-01 00:00:00")
    assert registry.latest(spark, base).first()["latest_version"] == "v2"
    pipeline = registry.load_pipeline(base, "v1")
    given = table.withColumn("nothing", F.lit(None).cast("double"))
    scored = pipeline.transform(given)
    pick = lambda df: {r.Date: r.prediction for r in df.select("Date", "prediction").collect()}
    assert pick(scored) == pick(fitted.predict(given))
    assert pick(scored) == pick(fitted.model.transform(
        learning.assemble(given, fitted.features, fitted.medians)))
    assert not [c for c in scored.columns if c.startswith("_")]
    assert given.where("precip_mm IS NULL").count() > 0
    with pytest.raises(ValueError, match="precip_mm"):
        pipeline.transform(table.drop("precip_mm"))
