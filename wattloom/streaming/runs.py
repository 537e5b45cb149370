"""Running streaming queries: per-trigger output, latest state, deduplication, progress."""

import sys
import threading
import time
from collections import defaultdict
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from wattloom.functions.hashing import bloom_digests, bloom_shape
from wattloom.operators.sketches import (WORD_BITS, _positions, bloom_merge, bloom_words,
                                         shard_of)
from wattloom.schemas import BLOOM_CAPACITY, BLOOM_FPP, TRIGGER
from wattloom.session import ENGINE_CONF

# Functions of this module go to the executors by value; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Seconds to wait for the last reports of a query that has ended.
LAST_REPORTS = 300.0


#: Name of the observation that counts the rows a stream receives.
RECEIVED = "received"


def observed(df: DataFrame) -> DataFrame:
    """Count the rows that pass here, for the progress log; to be put at a stream's source."""
    return df.observe(RECEIVED, F.count(F.lit(1)).alias("rows"))


class ProgressLog(StreamingQueryListener):
    """Collects one row for every trigger that processed a batch, as Spark reports it.

    Reports arrive on their own, so none is missed however fast triggers follow each other. Rows
    wait here until ``take`` fetches them.
    """

    def __init__(self):
        self.lock, self.rows, self.ended = threading.Lock(), defaultdict(list), set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if "addBatch" not in p.durationMs:
            return
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        seen = p.observedMetrics.get(RECEIVED)
        row = (p.batchId, p.numInputRows if seen is None else seen["rows"],
               float(p.processedRowsPerSecond or 0), p.durationMs.get("triggerExecution", 0),
               dropped, sum(op.numRowsTotal for op in p.stateOperators))
        with self.lock:
            self.rows[str(p.runId)].append(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.lock:
            self.ended.add(str(event.runId))

    def take(self, run_id):
        with self.lock:
            return self.rows.pop(run_id, [])

    def has_ended(self, run_id):
        with self.lock:
            return run_id in self.ended


_listening: dict[str, ProgressLog] = {}


#: The setting that names the provider of streams' state.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = ENGINE_CONF[STATE_STORE]


@contextmanager
def _set(spark: SparkSession, name: str, value: str | None):
    """A setting of the session for as long as this lasts; without a value it stays as it is."""
    before = spark.conf.get(name, None)
    if value is not None:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        if value is not None and before is None:
            spark.conf.unset(name)
        elif value is not None:
            spark.conf.set(name, before)


def start(df: DataFrame, sink, checkpoint: str, mode="update", available_now=False,
          every=TRIGGER, state_store: str | None = None) -> StreamingQuery:
    """Start a query whose batches go to ``sink(batch, batch_id)``.

    ``state_store`` is the provider of this query's state; without it the session's is used.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    log, streams = ProgressLog(), df.sparkSession.streams
    streams.addListener(log)
    try:
        # A query keeps the settings it was started with.
        with _set(df.sparkSession, STATE_STORE, state_store):
            query = (df.writeStream.outputMode(mode).foreachBatch(sink)
                     .option("checkpointLocation", checkpoint).trigger(**trigger).start())
    except Exception:
        streams.removeListener(log)
        raise
    _listening[str(query.runId)] = log
    return query


PROGRESS = ("batch_id bigint, input_rows bigint, rows_per_second double, duration_ms bigint, "
            "dropped_late bigint, state_rows bigint")


def finish(query: StreamingQuery, timeout: float | None = None, log: str | None = None,
           poll=2.0) -> None:
    """Wait until the query ends by itself; its failure is raised here.

    There is no limit unless ``timeout`` (seconds) sets one; if it is hit, the query is stopped
    and ``TimeoutError`` raised, so a part of the input never passes for the whole. With ``log``,
    one row per trigger is kept at that path, from what a listener has been told: no trigger is
    left out.
    """
    start_ = time.monotonic()
    spark, run_id = SparkSession.active(), str(query.runId)
    listener = _listening.get(run_id)
    try:
        while True:
            ended = query.awaitTermination(poll)
            if ended and listener:
                # Reports come a little later than the end itself.
                late = time.monotonic() + LAST_REPORTS
                while not listener.has_ended(run_id) and time.monotonic() < late:
                    time.sleep(0.02)
            if log and listener:
                _keep_progress(spark, listener.take(run_id), log)
            if ended:
                return
            if timeout is not None and time.monotonic() - start_ > timeout:
                query.stop()
                raise TimeoutError(f"the stream did not end within {timeout} s")
    finally:
        if not query.isActive and _listening.pop(run_id, None):
            spark.streams.removeListener(listener)


def _keep_progress(spark: SparkSession, rows: list, log: str) -> None:
    if rows:
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(log)


def per_trigger_sink(path: str):
    """Sink that keeps each trigger's rows in a directory of its own.

    A batch that is run again after a failure overwrites its directory, so no row appears twice.
    """
    def sink(batch: DataFrame, batch_id: int):
        batch.withColumn("written_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{path}/trigger_id={batch_id}")
    return sink


def latest(spark: SparkSession, path: str, keys) -> DataFrame:
    """Per key the row of its most recent trigger."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "trigger_id", "written_at")]
    newest = F.max_by(F.struct(*values), "trigger_id").alias("v")
    grouped = rows.groupBy(*keys) if keys else rows.groupBy()
    return grouped.agg(newest).select(*keys, "v.*")


def drop_duplicates(df: DataFrame, keys, within: str | None = None) -> DataFrame:
    """Exact deduplication of a stream.

    With ``within`` only duplicates that arrive closer than that in event time are recognised
    and state is dropped afterwards; without it every key is remembered.
    """
    if within is None:
        return df.dropDuplicates(list(keys))
    return df.withWatermark("event_time", within).dropDuplicatesWithinWatermark(list(keys))


class _ShardFilter(StatefulProcessor):
    """The filter of one shard of keys: its set words, by their number, as stream state."""

    def __init__(self, bits, hashes, ttl_ms):
        self.bits, self.hashes, self.ttl_ms = bits, hashes, ttl_ms

    def init(self, handle):
        self.words = handle.getMapState("words", "word int", "bits long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        keys = {}
        for batch in rows:
            keys.update(zip(batch["key"], zip(batch["first"], batch["step"])))
        new, added, read = [], {}, {}

        def word(n):
            if n not in read:
                old = self.words.getValue((n,))
                read[n] = old[0] & (2 ** WORD_BITS - 1) if old else 0
            return read[n]

        for name, (first, step) in keys.items():
            at = [divmod((int(first) + i * int(step)) % self.bits, WORD_BITS)
                  for i in range(self.hashes)]
            if not all(word(w) >> b & 1 for w, b in at):
                new.append(name)
                for w, b in at:
                    added[w] = added.get(w, 0) | 1 << b
        for w, bits in added.items():
            bits |= word(w)
            self.words.updateValue((w,), (bits - (bits >> 63 << 64),))
        if new:
            yield pd.DataFrame({"key": pd.Series(new, dtype=object)})

    def close(self):
        pass


def drop_near_duplicates(df: DataFrame, key: str, capacity=BLOOM_CAPACITY, fpp=BLOOM_FPP,
                         shards=8, ttl: str | None = None) -> DataFrame:
    """(key): the keys of a stream that a Bloom filter has not seen, each once.

    The filter is the state of the stream, kept by its checkpoint in the state store: a filter
    for each of ``shards`` groups of keys, sized for its part of ``capacity``, so its words are
    spread over tasks and the state never exceeds the filter's words, whatever the stream brings.
    Keys of one trigger are told apart exactly; later ones may be taken for known with the
    filter's rate. NULL keys are dropped. With ``ttl`` (such as "7 days") words that were not set
    again in that time are forgotten; such state asks for triggers without data, so a run that
    is to end by itself needs ``spark.sql.streaming.noDataMicroBatches.enabled`` off. A stream
    that is stopped goes on where it was. Such state asks for the RocksDB state store: in a session
    with another one, ``start`` the stream with ``state_store=ROCKS_DB``.
    """
    bits, hashes = bloom_shape(-(-capacity // shards), fpp)
    first, step = bloom_digests(key, bits)
    milliseconds = None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)
    keyed = df.where(F.col(key).isNotNull()).select(
        shard_of(key, shards).alias("shard"), F.col(key).alias("key"), first.alias("first"),
        step.alias("step"))
    kind = dict(df.dtypes)[key]
    return keyed.groupBy("shard").transformWithStateInPandas(
        _ShardFilter(bits, hashes, milliseconds), f"key {kind}", "Append",
        "None" if ttl is None else "ProcessingTime").withColumnRenamed("key", key)


class BloomDedup:
    """Approximate deduplication of a stream, as a ``foreachBatch`` sink.

    The filter lives in the shared folder as a table of its set words: batch ``b`` reads what
    batches before ``b`` wrote and adds the words its new keys set, and its counts. Keys
    themselves are not kept.
    Re-running a batch gives the same result. Rows are collapsed to distinct keys first, so a
    key with many copies costs one probe. Within a batch keys are told apart exactly; across
    batches a key may be taken for a duplicate with the filter's false-positive rate.
    """

    def __init__(self, path: str, key: str, capacity=BLOOM_CAPACITY, fpp=BLOOM_FPP,
                 compact_every=50):
        self.path, self.key, self.compact_every = path, key, compact_every
        self.bits, self.hashes = bloom_shape(capacity, fpp)

    def _words_before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        if batch_id == 0:
            return None
        # A batch whose id is a multiple of `compact_every` rewrites the filter in full.
        base = (batch_id - 1) // self.compact_every * self.compact_every
        words = spark.read.parquet(f"{self.path}/words").where(
            (F.col("batch_id") < batch_id) & (F.col("batch_id") >= base))
        return bloom_merge(words.select("word", "bits"))

    def __call__(self, batch: DataFrame, batch_id: int):
        spark, key = batch.sparkSession, self.key
        keys = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        positions = _positions(keys.where(F.col(key).isNotNull()), key, self.bits, self.hashes
                               ).withColumn("word", F.floor(F.col("bit") / WORD_BITS))
        before = self._words_before(spark, batch_id)
        if before is None:
            hit = F.lit(False)
        else:
            positions = positions.join(before, "word", "left")
            hit = F.coalesce(
                F.getbit("bits", (F.col("bit") % WORD_BITS).cast("int")) == 1, F.lit(False))
        probed = (positions.groupBy(key)
                  .agg(F.bool_and(hit).alias("known"),
                       F.collect_list("bit").alias("set_bits")))  # `hashes` entries
        added = bloom_words(probed.where(~F.col("known")).select(F.explode("set_bits").alias("bit")))
        if before is not None and batch_id % self.compact_every == 0:
            added = bloom_merge(before, added)
        added.write.mode("overwrite").parquet(f"{self.path}/words/batch_id={batch_id}")
        total = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("processed"))
        new = probed.agg(F.count_if(~F.col("known")).alias("unique_keys"))
        total.select("processed", F.lit(None).cast("bigint").alias("unique_keys")).unionByName(
            new.select(F.lit(None).cast("bigint").alias("processed"), "unique_keys")).write.mode(
            "overwrite").parquet(f"{self.path}/counts/batch_id={batch_id}")

    def report(self, spark: SparkSession) -> DataFrame:
        """(processed, unique_keys) over all batches; records of NULL key count as processed."""
        return spark.read.parquet(f"{self.path}/counts").agg(
            F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
            F.coalesce(F.sum("unique_keys"), F.lit(0)).alias("unique_keys"))


def progress_report(spark: SparkSession, log: str) -> DataFrame:
    """(batch_id, input_rows, rows_per_second, duration_ms, dropped_late) of every trigger."""
    return spark.read.schema(PROGRESS).parquet(log)


def live_summary(spark: SparkSession, log: str) -> DataFrame:
    """Totals over all triggers: records, triggers, seconds, records per second."""
    rows, seconds = F.sum("input_rows"), F.sum("duration_ms") / 1000.0
    return progress_report(spark, log).agg(
        F.coalesce(rows, F.lit(0)).alias("total_received"),
        F.count_if(F.col("input_rows") > 0).alias("total_triggers"),
        F.round(seconds, 1).alias("elapsed_sec"),
        F.round(rows / F.greatest(seconds, F.lit(0.001)), 2).alias("throughput_rps"),
        F.coalesce(F.sum("dropped_late"), F.lit(0)).alias("dropped_late"))
