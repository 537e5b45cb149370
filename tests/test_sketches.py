import hashlib
import struct

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wattloom.functions.hashing import bloom_shape, cms_seeds, hex_modulo
from wattloom.operators import sketches


def positions(key, bits, hashes):
    a = int(hashlib.sha256(key.encode()).hexdigest(), 16) % bits
    b = int(hashlib.md5(key.encode()).hexdigest(), 16) % bits
    return [(a + i * b) % bits for i in range(hashes)]


def test_shape():
    assert bloom_shape(5000, 0.01) == (47926, 7)


@pytest.mark.parametrize("modulus", [97, 47926, 2 ** 31 - 1, 2 ** 31 + 11, 2 ** 46 + 3])
def test_hex_modulo(spark, modulus):
    df = spark.range(50).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    for r in df.select("h", F.expr(hex_modulo("h", 64, modulus)).alias("m")).collect():
        assert r["m"] == int(r["h"], 16) % modulus


def test_bloom_words_match_brute_force(spark):
    keys = [f"2007-01-01 00:{i:02d}:00" for i in range(60)] * 3
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    words = {}
    for k in set(keys):
        for p in positions(k, 47926, 7):
            words[p // 64] = words.get(p // 64, 0) | (1 << (p % 64))
    got = {r["word"]: r["bits"] % 2 ** 64 for r in sketches.bloom_build(df, "k").collect()}
    assert got == words


def test_no_false_negatives_and_merge(spark):
    left = spark.range(0, 300).select(F.col("id").cast("string").alias("k"))
    right = spark.range(200, 600).select(F.col("id").cast("string").alias("k"))
    whole = sketches.bloom_build(left.union(right), "k")
    merged = sketches.bloom_merge(sketches.bloom_build(right, "k"), sketches.bloom_build(left, "k"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    probe = sketches.bloom_probe(left.union(right), "k", merged)
    assert probe.where("NOT maybe_present").count() == 0
    absent = spark.range(10_000, 12_000).select(F.col("id").cast("string").alias("k"))
    false_rate = sketches.bloom_probe(absent, "k", merged).where("maybe_present").count() / 2000
    assert false_rate < 0.02


@pytest.mark.parametrize("capacity", [10, 60, 5000])
def test_row_by_row_outcome(spark, capacity):
    """The grouped form gives exactly what feeding a filter one row at a time gives."""
    keys = [str((i * i) % 211) for i in range(800)]
    bits, hashes = bloom_shape(capacity, 0.01)
    seen, new, duplicates = set(), set(), 0
    for k in keys:
        p = positions(k, bits, hashes)
        if all(x in seen for x in p):
            duplicates += 1
        else:
            seen.update(p)
            new.add(k)
    df = spark.createDataFrame(list(enumerate(keys)), "i int, k string").repartition(8)
    got = sketches.bloom_first_seen(df, "k", "i", capacity)
    assert {r["k"] for r in got.where("is_new").collect()} == new
    report = sketches.bloom_report(df, "k", "i", capacity).first()
    assert (report["processed"], report["duplicates_caught"]) == (800, duplicates)


def test_cms_cells_match_brute_force(spark):
    items = ["0-0.5kW"] * 5 + ["5+kW"] * 2 + ["unknown"]
    df = spark.createDataFrame([(k,) for k in items], "k string")
    want = {}
    for k in items:
        for row, seed in enumerate(cms_seeds(7)):
            head = hashlib.sha256(struct.pack(">I", seed) + k.encode()).digest()[:4]
            cell = (row, int.from_bytes(head, "big") % 2000)
            want[cell] = want.get(cell, 0) + 1
    got = {(r["row"], r["col"]): r["count"] for r in sketches.cms_build(df, "k").collect()}
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=80), st.integers(5, 40))
def test_estimates_never_fall_short(spark, values, width):
    df = spark.createDataFrame([(str(v),) for v in values], "k string")
    sketch = sketches.cms_build(df, "k", width=width, depth=3)
    for r in sketches.cms_query(df, "k", sketch, width=width, depth=3).collect():
        assert values.count(int(r["k"])) <= r["cms_estimate"] <= len(values)
    summary = sketches.cms_summary(sketch, width, 3).first()
    assert summary["total_updates"] == len(values)


def test_cms_merge(spark):
    df = spark.createDataFrame([(str(i % 7),) for i in range(50)], "k string")
    a, b = df.limit(20), df.exceptAll(df.limit(20))
    merged = sketches.cms_merge(sketches.cms_build(a, "k"), sketches.cms_build(b, "k"))
    assert sorted(map(tuple, merged.collect())) == sorted(
        map(tuple, sketches.cms_build(df, "k").collect()))
