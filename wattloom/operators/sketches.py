"""Bloom filter and Count-Min sketch as relations.

A sketch is a table of its non-empty cells, so building is a grouping that merges partial cells
before the shuffle, merging two sketches is the same grouping over their union, and probing is a
join. Neither the bits nor the counters pass through the driver.
"""

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from wattloom.functions.classes import power_class
from wattloom.functions.hashing import bloom_digests, bloom_positions, bloom_shape, cms_cells
from wattloom.functions.numbers import steady_round
from wattloom.schemas import (BLOOM_CAPACITY, BLOOM_FPP, BYTES_PER_KEY, CMS_DEPTH, CMS_WIDTH,
                              NATIVE_CMS, POWER_CLASSES, TOP_CLASS, UNKNOWN_CLASS)

# Functions of this module go to the executors by value; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD_BITS = 64
#: Merged sketches that a task holds; each takes about depth * width * 8 bytes.
MOST_SKETCHES = 256


# ---- Bloom filter -----------------------------------------------------------------------

def _positions(keys: DataFrame, key: str, bits: int, hashes: int, *carry) -> DataFrame:
    """One row per key and hash; ``keys`` must hold distinct keys."""
    first, step = bloom_digests(key, bits)
    # The digests get a projection of their own, so that each is computed once per key.
    return keys.select(key, *carry, first.alias("_first"), step.alias("_step")).select(
        key, *carry, F.explode(bloom_positions("_first", "_step", bits, hashes)).alias("bit"))


def bloom_build(df: DataFrame, key: str, capacity=BLOOM_CAPACITY, fpp=BLOOM_FPP) -> DataFrame:
    """(word, bits): the set bits of the filter, 64 to a word."""
    bits, hashes = bloom_shape(capacity, fpp)
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return bloom_words(_positions(keys, key, bits, hashes))


def bloom_words(positions: DataFrame) -> DataFrame:
    word = F.floor(F.col("bit") / WORD_BITS)
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                           (F.col("bit") % WORD_BITS).cast("int"))
    return positions.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))


def bloom_merge(*filters: DataFrame) -> DataFrame:
    """Union of filters of the same shape."""
    out = filters[0]
    for other in filters[1:]:
        out = out.unionByName(other)
    return out.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def bloom_probe(keys: DataFrame, key: str, words: DataFrame, capacity=BLOOM_CAPACITY,
                fpp=BLOOM_FPP) -> DataFrame:
    """(key, maybe_present) per distinct key; false means certainly absent."""
    bits, hashes = bloom_shape(capacity, fpp)
    probes = _positions(keys.select(key).where(F.col(key).isNotNull()).distinct(), key, bits,
                        hashes).withColumn("word", F.floor(F.col("bit") / WORD_BITS))
    hit = F.call_function("getbit", F.col("bits"), (F.col("bit") % WORD_BITS).cast("int")) == 1
    return (probes.join(words, "word", "left")
            .groupBy(key).agg(F.bool_and(F.coalesce(hit, F.lit(False))).alias("maybe_present")))


def shard_of(key: str, shards: int):
    """The shard of a key: the head of its MD5 digest modulo the number of shards."""
    text = F.col(key).cast("string").cast("binary")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % shards


def bloom_first_seen(df: DataFrame, key: str, order: str, capacity=BLOOM_CAPACITY,
                     fpp=BLOOM_FPP, shards=1) -> DataFrame:
    """(key, n, first_seen, is_new): what a filter fed row by row in ``order`` reports per key.

    A key is reported new at its first row unless other keys had set all its bits before. A
    falsely recognised key sets no new bit, so the first time a bit is set is the earliest first
    row among all keys that have it, and the row-by-row outcome follows from two groupings.
    ``order`` must be unique per row; rows that share it are fed together and do not hide each
    other. With ``shards`` there is a filter for each shard, sized for its part of the keys.
    """
    bits, hashes = bloom_shape(-(-capacity // shards), fpp)
    keys = (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen")))
    positions = _positions(keys, key, bits, hashes, "n", "first_seen")
    if shards > 1:
        positions = positions.withColumn("bit", F.col("bit") + shard_of(key, shards) * bits)
    set_at = positions.groupBy("bit").agg(F.min("first_seen").alias("set_at"))
    return (positions.join(set_at, "bit").groupBy(key)
            .agg(F.first("n").alias("n"), F.first("first_seen").alias("first_seen"),
                 F.bool_or(F.col("set_at") >= F.col("first_seen")).alias("is_new")))


def bloom_join(large: DataFrame, small: DataFrame, large_key: str, small_key: str,
               how="inner") -> DataFrame:
    """An inner or left-semi join that sends only rows of ``large`` through the shuffle whose key a
    Bloom filter of ``small``'s keys knows. The result is that of the plain join.

    Spark builds the filter while the query runs and applies it at the scan of the large side. By
    itself it only does so for very large scans; here it is asked for at any size, for the
    queries of this session, since the caller knows that ``small`` is selective.
    """
    if how not in ("inner", "leftsemi"):
        raise ValueError("only joins that drop rows without a match can filter first")
    spark = large.sparkSession
    for name, value in RUNTIME_FILTER.items():
        spark.conf.set(name, value)
    return large.join(small, F.col(large_key) == F.col(small_key), how)


#: Settings under which a shuffled join filters its large side, whatever the scan's size.
RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


def bloom_report(df: DataFrame, key: str, order: str, capacity=BLOOM_CAPACITY,
                 fpp=BLOOM_FPP) -> DataFrame:
    """Deduplication report of one run over the rows in ``order``; NULL keys count as processed."""
    seen = bloom_first_seen(df, key, order, capacity, fpp)
    processed = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return bloom_summary(
        seen.agg(F.count_if(F.col("is_new")).alias("unique_keys"))
        .select(processed.alias("processed"), "unique_keys"), capacity, fpp)


def bloom_summary(counts: DataFrame, capacity=BLOOM_CAPACITY, fpp=BLOOM_FPP) -> DataFrame:
    """Complete a (processed, unique_keys) row with the filter's size and error figures."""
    bits, hashes = bloom_shape(capacity, fpp)
    kilobytes = math.ceil(bits / 8) / 1024
    unique = F.col("unique_keys")
    fill = F.pow(1 - F.exp(unique * F.lit(-hashes / bits)), F.lit(hashes))
    saving = F.col("processed") * F.lit(BYTES_PER_KEY / 1024) / F.lit(max(kilobytes, 0.001))
    return counts.select(
        "processed",
        (F.col("processed") - unique).alias("duplicates_caught"),
        unique,
        steady_round(fill, 6).alias("est_fp_rate"),
        F.round(F.lit(kilobytes), 2).alias("memory_kb"),
        steady_round(saving, 1).alias("memory_saving_factor"),
        F.lit(capacity).cast("bigint").alias("capacity"),
        F.lit(float(fpp)).alias("target_fp_rate"),
        F.round(F.lit(kilobytes), 2).alias("bit_array_kb"),
        F.lit(hashes).alias("hash_functions"),
        unique.alias("n_inserted"),
    )


# ---- Count-Min sketch -------------------------------------------------------------------

def _cells(items: DataFrame, item: str, width: int, depth: int, *carry) -> DataFrame:
    """One row per item and sketch row; ``items`` must hold distinct items."""
    return items.select(item, *carry, F.inline(cms_cells(item, width, depth)))


def item_counts(df: DataFrame, item: str) -> DataFrame:
    return df.groupBy(item).agg(F.count(F.lit(1)).alias("n"))


def cms_build(df: DataFrame, item: str, width=CMS_WIDTH, depth=CMS_DEPTH) -> DataFrame:
    """(row, col, count): the non-zero counters. Items are counted before they are hashed."""
    counted = item_counts(df.where(F.col(item).isNotNull()), item)
    return (_cells(counted, item, width, depth, "n")
            .groupBy("row", "col").agg(F.sum("n").alias("count")))


def cms_update(df: DataFrame, item: str, width=CMS_WIDTH, depth=CMS_DEPTH) -> DataFrame:
    """(row, col, count) of a stream's records, one grouping as streams allow."""
    cells = _cells(df.where(F.col(item).isNotNull()), item, width, depth)
    return cells.groupBy("row", "col").agg(F.count(F.lit(1)).alias("count"))


def cms_merge(*sketches: DataFrame) -> DataFrame:
    out = sketches[0]
    for other in sketches[1:]:
        out = out.unionByName(other)
    return out.groupBy("row", "col").agg(F.sum("count").alias("count"))


def cms_query(items: DataFrame, item: str, sketch: DataFrame, width=CMS_WIDTH,
              depth=CMS_DEPTH) -> DataFrame:
    """(item, cms_estimate): the smallest of the item's counters, 0 for an empty one."""
    return (_cells(items.select(item).distinct(), item, width, depth)
            .join(sketch, ["row", "col"], "left")
            .groupBy(item)
            .agg(F.min(F.coalesce("count", F.lit(0))).alias("cms_estimate")))


def cms_summary(sketch: DataFrame, width=CMS_WIDTH, depth=CMS_DEPTH) -> DataFrame:
    return sketch.where(F.col("row") == 0).agg(
        F.lit(width).alias("width"), F.lit(depth).alias("depth"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_updates"),
        F.lit(round(width * depth * 4 / 1024, 2)).alias("memory_kb"),
        F.lit(round(math.e / width, 6)).alias("error_bound_epsilon"),
        F.lit(round(0.5 ** depth, 6)).alias("error_prob_delta"))


# The library's own sketch: one binary value per group, built by a single partial aggregation.

def cms_native(df: DataFrame, item: str, by=(), eps=NATIVE_CMS["eps"],
               confidence=NATIVE_CMS["confidence"], seed=NATIVE_CMS["seed"]) -> DataFrame:
    """(by..., sketch): a Count-Min sketch of an integer column as one binary value per group.

    Counters are updated row by row where the rows are; only sketches are shuffled, and no row is
    multiplied by the depth. NULL items are not counted; a group without any has an empty sketch.
    """
    sketch = F.count_min_sketch(F.col(item).cast("bigint"), F.lit(float(eps)),
                                F.lit(float(confidence)), F.lit(seed)).alias("sketch")
    return df.groupBy(*by).agg(sketch)


def opened_sketch(raw: bytes):
    """(total, multipliers, counters) of a serialized sketch.

    Fixed layout, numbers big-endian: version (int, 1), total (long), depth and width (ints), a
    multiplier per row (longs), then the counters row by row (longs).
    """
    if int.from_bytes(raw[:4], "big") != 1:
        raise ValueError("not a Count-Min sketch of version 1")
    depth, width = (int.from_bytes(raw[i:i + 4], "big") for i in (12, 16))
    numbers = np.frombuffer(raw, ">i8", offset=20).astype(np.int64)
    if len(numbers) != depth * (width + 1):
        raise ValueError("a Count-Min sketch of another size")
    return (int.from_bytes(raw[4:12], "big"), numbers[:depth],
            numbers[depth:].reshape(depth, width))


def _added(raws):
    """One sketch from several of the same shape, read one at a time."""
    head = total = multipliers = counters = None
    for raw in raws:
        n, m, c = opened_sketch(raw)
        if head is None:
            head, total, multipliers, counters = raw[12:20], n, m, c.copy()
        elif raw[12:20] != head or (m != multipliers).any():
            raise ValueError("sketches of different shape or seed cannot be merged")
        else:
            total, counters = total + n, counters + c
    return (b"\0\0\0\1" + total.to_bytes(8, "big") + head + multipliers.astype(">i8").tobytes()
            + counters.astype(">i8").tobytes())


def cms_native_merge(sketches: DataFrame, by=()) -> DataFrame:
    """(by..., sketch): the sums of sketches, of days or of other partial tables.

    Tasks add up what they hold before it is shuffled, so a group of very many sketches is one
    sketch per task by then.
    """
    kinds = dict(sketches.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in by) + "sketch binary"

    def table(held):
        columns = [pa.array([k[i] for k in held]) for i in range(len(by))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.binary())],
                                          [*by, "sketch"])

    def partly(batches):
        held = {}
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in by]) if by else [()] * len(batch)
            for key, raw in zip(keys, batch.column("sketch").to_pylist()):
                if raw is not None:
                    held[key] = _added([held[key], raw] if key in held else [raw])
            if len(held) > MOST_SKETCHES:
                yield table(held)
                held = {}
        if held:
            yield table(held)

    def wholly(key, rows):
        return pa.Table.from_batches([table({tuple(k.as_py() for k in key): _added(
            x.as_py() for x in rows["sketch"])})])

    return sketches.select(*by, "sketch").mapInArrow(partly, schema).groupBy(*by).applyInArrow(
        wholly, schema)


def cms_native_query(items: DataFrame, item: str, sketch: str = "sketch") -> DataFrame:
    """``items`` with ``cms_estimate``, the smallest of the item's counters in the row's sketch.

    Items and sketches meet in a row by whatever join the caller needs. NULL items count 0.
    """
    kinds = dict(items.dtypes)
    schema = ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", cms_estimate long"

    def run(batches):
        for batch in batches:
            asked = batch.column("_item")
            known = asked.is_valid().to_numpy(zero_copy_only=False)
            values = asked.fill_null(0).to_numpy()
            raws, out = batch.column(sketch).dictionary_encode(), np.zeros(len(batch), np.int64)
            which = raws.indices.fill_null(-1).to_numpy()
            for n, one in enumerate(raws.dictionary.to_pylist()):
                at = np.flatnonzero(known & (which == n))
                _, multipliers, counters = opened_sketch(one)
                with np.errstate(over="ignore"):
                    h = values[at][:, None] * multipliers
                    h = (h + (h >> 32)) & 0x7FFFFFFF
                out[at] = counters[np.arange(len(multipliers)), h % counters.shape[1]].min(axis=1)
            rest = batch.drop_columns(["_item"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(out)],
                                             [*rest.schema.names, "cms_estimate"])

    return items.withColumn("_item", F.col(item).cast("bigint")).mapInArrow(run, schema)


def power_classes(spark) -> DataFrame:
    """All consumption classes, the unknown one included."""
    names = [name for _, name in POWER_CLASSES] + [TOP_CLASS, UNKNOWN_CLASS]
    return spark.createDataFrame([(n,) for n in names], "bucket string")


def with_power_class(df: DataFrame, power="Global_active_power") -> DataFrame:
    return df.withColumn("bucket", power_class(F.col(power)))


def cms_vs_exact(df: DataFrame, width=CMS_WIDTH, depth=CMS_DEPTH) -> DataFrame:
    """Estimate and exact count per consumption class; ``df`` has the ``bucket`` column."""
    counted = item_counts(df, "bucket")
    sketch = (_cells(counted, "bucket", width, depth, "n")
              .groupBy("row", "col").agg(F.sum("n").alias("count")))
    classes = power_classes(df.sparkSession)
    exact = classes.join(counted, "bucket", "left").select(
        "bucket", F.coalesce("n", F.lit(0)).alias("exact"))
    error = F.col("cms_estimate") - F.col("exact")
    return (cms_query(classes, "bucket", sketch, width, depth).join(exact, "bucket")
            .select("bucket", "cms_estimate", "exact", error.alias("error"),
                    F.round(error * 100.0 / F.greatest("exact", F.lit(1)), 2).alias("error_pct")))


def cms_error_rate(comparison: DataFrame) -> DataFrame:
    """Total absolute error over all classes, relative to the number of rows."""
    error, rows = F.sum(F.abs("error")), F.sum("exact")
    return comparison.agg(error.alias("total_abs_error"),
                          F.round(error * 100.0 / F.greatest(rows, F.lit(1)), 4)
                          .alias("error_rate_pct"))
