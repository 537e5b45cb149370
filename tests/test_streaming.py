import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wattloom.operators.sketches import bloom_summary
from wattloom.plans import catalog
from wattloom.session import fresh_path
from wattloom.sinks.tables import JavaFolder, as_messages, publish
from wattloom.sources.messages import file_messages, kafka_options, parse_messages, table_stream
from wattloom.streaming import runs, windows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_time timestamp, Global_active_power double, key string"


def write_files(spark, path, batches):
    """One file per batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def minute(m, kw=60.0, key="a"):
    return (T0 + dt.timedelta(minutes=m), float(kw), key)


def run(spark, stream, mode="update", sink=None):
    path = fresh_path(spark, "test-stream")
    query = runs.start(stream, sink or runs.per_trigger_sink(f"{path}/out"), f"{path}/check", mode,
                       available_now=True)
    runs.finish(query, log=f"{path}/log")
    return f"{path}/out", f"{path}/log"


def test_messages_that_are_not_objects_are_skipped(spark):
    values = ['{"Datetime": "2024-01-01 00:00:00", "Global_active_power": 1.5}',
              '{"Datetime": "2024-01-01 00:01:00", "Global_active_power": "abc"}',
              '{"Datetime": "not a time", "Global_active_power": 2}',
              '{"Datetime": "2024-01-01 00:02:00"}', "5", "[1]", "null", "{broken", None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    parsed = parse_messages(df)
    assert parsed.count() == 4
    live = windows.live_readings(parsed).collect()
    assert sorted(r["Global_active_power"] for r in live) == [0.0, 0.0, 1.5]


def test_publish_and_read_back_as_stream(spark):
    readings = spark.createDataFrame(
        [(T0 + dt.timedelta(minutes=i), float("nan") if i == 3 else float(i)) for i in range(20)],
        "Datetime timestamp, Global_active_power double")
    messages = as_messages(readings, limit=10)
    first = json.loads(messages.orderBy("key").first()["value"])
    assert first["Datetime"] == "2024-01-01 00:00:00" and first["event_timestamp"] > 0
    assert json.loads(messages.orderBy("key").collect()[3]["value"])["Global_active_power"] is None
    path = fresh_path(spark, "topic")
    publish(messages, path=path)
    out, _ = run(spark, parse_messages(file_messages(spark, path), keep=("key",)), "append")
    assert spark.read.parquet(out).count() == 10


def test_kafka_options():
    options = kafka_options("host:9092", "energy", max_per_trigger=5000)
    assert options == {"kafka.bootstrap.servers": "host:9092", "subscribe": "energy",
                       "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5000"}


def test_stream_equals_batch_over_many_triggers(spark):
    path = fresh_path(spark, "in")
    batches = [[minute(b * 7 + i, kw=b + i) for i in range(10)] for b in range(4)]
    write_files(spark, path, batches)
    batch = spark.read.parquet(path)
    stream = table_stream(spark, path, batch.schema, max_files=1)
    for build, keys in [(windows.tumbling, ["window_start"]), (windows.sliding, ["window_start"])]:
        out, query = run(spark, build(stream))
        assert len(spark.read.parquet(out).select("trigger_id").distinct().collect()) == 4
        got = runs.latest(spark, out, keys)
        want = build(batch).select(*got.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_late_rows(spark):
    path = fresh_path(spark, "in")
    write_files(spark, path, [
        [minute(0), minute(30)],
        [minute(31)],
        [minute(24, kw=1.0), minute(2, kw=1.0)],  # 7 and 29 minutes behind
        [minute(40)],
    ])
    stream = table_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    out, log = run(spark, windows.tumbling(stream, watermark="10 minutes"))
    got = {r["window_start"]: r["count"] for r in runs.latest(spark, out, ["window_start"]).collect()}
    at = lambda m: T0 + dt.timedelta(minutes=m)
    assert got[at(0)] == 1 and got[at(20)] == 1 and got[at(30)] == 2
    assert runs.live_summary(spark, log).first()["dropped_late"] == 1


def test_sliding_start_in_batch(spark):
    df = spark.createDataFrame([minute(7), minute(12)], SCHEMA)
    plain = windows.sliding(df)
    assert plain.count() == 3
    starts = sorted(r["window_start"] for r in windows.from_first_slide(plain, df).collect())
    assert starts == [T0 + dt.timedelta(minutes=5), T0 + dt.timedelta(minutes=10)]


def test_exact_dedup_across_triggers(spark):
    path = fresh_path(spark, "in")
    write_files(spark, path, [[minute(0, key="a"), minute(1, key="b"), minute(2, key="a")],
                              [minute(3, key="b"), minute(4, key="c")]])
    stream = table_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    out, _ = run(spark, runs.drop_duplicates(stream.select("key"), ["key"]), "append")
    assert sorted(r["key"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    out, _ = run(spark, runs.drop_duplicates(stream, ["key"], within="10 minutes"), "append")
    assert sorted(r["key"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("compact_every", [2, 50])
def test_bloom_dedup_across_triggers(spark, compact_every):
    path = fresh_path(spark, "in")
    write_files(spark, path, [[minute(b, key=str(k)) for k in range(b * 5, b * 5 + 10)]
                              for b in range(5)])
    stream = table_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    sink = runs.BloomDedup(fresh_path(spark, "bloom"), "key", compact_every=compact_every)
    run(spark, stream.select("key"), "append", sink)
    row = bloom_summary(sink.report(spark)).first()
    assert (row["processed"], row["unique_keys"], row["duplicates_caught"]) == (50, 30, 20)
    # A batch that is run again changes nothing.
    sink(spark.createDataFrame([(str(k),) for k in range(20, 30)], "key string"), 4)
    again = bloom_summary(sink.report(spark)).first()
    assert again == row


def test_progress(spark):
    path = fresh_path(spark, "in")
    write_files(spark, path, [[minute(0)], [minute(1), minute(2)]])
    stream = table_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    _, log = run(spark, stream.select("key"), "append")
    assert runs.progress_report(spark, log).count() == 2
    summary = runs.live_summary(spark, log).first()
    assert (summary["total_received"], summary["total_triggers"]) == (3, 2)


def test_session_summary(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", 60.0, 900), ("2024-01-01 01:00:00", None, None),
         ("2024-01-02 00:00:00", 30.0, 2000)],
        "Datetime string, Global_active_power double, event_timestamp bigint")
    row = windows.session_summary(df, F.lit(1000)).first()
    assert row.asDict() == {"total_received": 3, "avg_latency_ms": 33.33, "total_kwh": 1.5,
                            "unique_days": 2}


def test_a_limit_that_is_hit_raises(spark):
    path = fresh_path(spark, "in")
    write_files(spark, path, [[minute(0)]])
    stream = table_stream(spark, path, spark.read.parquet(path).schema)
    query = runs.start(stream, runs.per_trigger_sink(f"{path}-out"), f"{path}-check", "append",
                       every="1 second")
    with pytest.raises(TimeoutError):
        runs.finish(query, timeout=6, poll=1)
    assert not query.isActive
    # The processing-time trigger took up the file before that.
    assert spark.read.parquet(f"{path}-out").count() == 1


def test_bloom_dedup_counts_null_keys(spark):
    sink = runs.BloomDedup(fresh_path(spark, "bloom"), "key")
    sink(spark.createDataFrame([("a",), (None,), ("a",)], "key string"), 0)
    row = sink.report(spark).first()
    assert (row["processed"], row["unique_keys"]) == (3, 1)


@pytest.mark.parametrize("name", ["tumbling", "watermark"])
def test_catalog_streams_take_several_triggers(spark, sf, name):
    from wattloom.plans import catalog
    if name == "watermark":
        out = catalog._feed(spark, sf, F.dayofmonth("ts") % 3, lambda e: e.select("user_id"), "t",
                            "append")
    else:
        out = catalog._run(spark, catalog._event_stream(spark, sf).select("user_id"), "t", "append")
    assert spark.read.parquet(out).select("trigger_id").distinct().count() == 3


def test_a_group_of_many_files_is_one_trigger(spark, sf, monkeypatch):
    """Files are small, so that many tasks read them, and a group of them arrives as a whole."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 20)
    out = catalog._feed(spark, sf, catalog._ten_days(),
                        lambda e: e.select("event_id", F.input_file_name().alias("file")),
                        "many", "append")
    rows = spark.read.parquet(out)
    groups = events.select(catalog._ten_days().alias("n")).distinct().count()
    assert rows.select("trigger_id").distinct().count() == groups > 1
    assert rows.count() == events.count() > 20 * groups
    assert rows.groupBy("file").count().agg(F.max("count")).first()[0] <= 20


def test_a_folder_is_moved_not_copied(spark, tmp_path):
    """Also into a folder that has files already."""
    folder = JavaFolder(spark, str(tmp_path / "in"))
    for name in "ab":
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.parquet").write_text(name)
        before = (tmp_path / name / "x.parquet").stat().st_ino
        folder.take(str(tmp_path / name))
        assert (tmp_path / "in" / name / "x.parquet").stat().st_ino == before


def test_larger_streams_have_more_files_and_as_many_triggers(spark, sf, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 50)
    stream = catalog._event_stream(spark, sf).select("event_id", F.input_file_name().alias("file"))
    rows = spark.read.parquet(catalog._run(spark, stream, "files", "append"))
    assert rows.select("trigger_id").distinct().count() == catalog.TRIGGERS
    assert rows.select("file").distinct().count() > 2 * catalog.TRIGGERS
    assert rows.count() == spark.read.parquet(f"{sf}/events.parquet").count()


def test_events_without_a_time_come_last(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 25)), (2, None), (3, dt.datetime(2024, 1, 5)), (1, None)]
    spark.createDataFrame(rows, "user_id long, ts timestamp_ntz").write.parquet(
        str(tmp_path / "events.parquet"))
    out = spark.read.parquet(catalog._feed(spark, str(tmp_path), catalog._ten_days(),
                                           lambda e: e.select("user_id"), "times", "append"))
    assert [sorted(r.user_id for r in out.where(F.col("trigger_id") == i).collect())
            for i in range(3)] == [[3], [1], [1, 2]]
