"""Boosted trees against a plain numpy version, and what their training may look at."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wattloom.operators import boosting, learning
from wattloom.session import fresh_path, written

SCHEMA = "series int, target double, held_out boolean, features array<double>"


def plain(x, y, held, max_iter, step, depth, min_rows, l2, max_leaves, bins, patience):
    """(base, trees as {node: (feature, value)}, losses) by exact sums and full searches."""
    unit = 2.0 ** (np.ceil(np.log2(2 * abs(y).max())) - 30)
    train = ~held
    edges = []
    for f in range(x.shape[1]):
        v = np.sort(x[train, f])
        q = [v[max(int(np.ceil((i + 1) / bins * len(v) - 1e-9)) - 1, 0)] for i in range(bins - 1)]
        edges.append(sorted({e for e in q if e < v[-1]}))
    base = y[train].mean()
    score, trees, losses = np.full(len(y), base), [], []
    for _ in range(max_iter):
        losses.append(((score - y)[held] ** 2).mean() / 2 if held.any() else 0)
        if patience and len(losses) > patience and min(losses[-patience:]) >= losses[-patience - 1] - 1e-7:
            break
        g = np.rint((score - y) / unit) * unit
        splits, rows_of = {}, {1: np.flatnonzero(train)}
        for node in range(1, 1 << depth):
            rows = rows_of.get(node, [])
            best = None
            for f, at in enumerate(edges):
                for e in at:
                    left = x[rows, f] <= e if len(rows) else np.zeros(0, bool)
                    n, nl = len(rows), int(left.sum())
                    if nl < min_rows or n - nl < min_rows:
                        continue
                    s, sl = g[rows].sum(), g[rows][left].sum()
                    gain = sl ** 2 / (nl + l2) + (s - sl) ** 2 / (n - nl + l2) - s ** 2 / (n + l2)
                    if gain > 1e-9 and (best is None or gain > best[2] + 1e-9):
                        best = f, e, gain
            if best:
                splits[node] = best
                left = x[rows, best[0]] <= best[1]
                rows_of[2 * node], rows_of[2 * node + 1] = rows[left], rows[~left]
        kept, waiting = {}, [1] if 1 in splits else []
        while waiting and len(kept) < max_leaves - 1:
            node = max(waiting, key=lambda n: splits[n][2])
            waiting.remove(node)
            kept[node] = splits[node]
            waiting += [c for c in (2 * node, 2 * node + 1) if c in splits]
        node = np.ones(len(y), int)
        for _ in range(depth):
            for i, n in enumerate(node):
                if n in kept:
                    node[i] = 2 * n + (x[i, kept[n][0]] > kept[n][1])
        values = {n: -step * g[train & (node == n)].sum() / ((train & (node == n)).sum() + l2)
                  for n in set(node[train])}
        score = score + np.array([values.get(n, 0) for n in node])
        trees.append({n: (f, e) for n, (f, e, _) in kept.items()})
    return base, trees, losses, score


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)).round(2)
    x[:, 2] = rng.integers(0, 3, 400)
    x[:, 3] = 1.0
    y = 3 * x[:, 0] + x[:, 2] * (x[:, 1] > 0) + rng.normal(size=400)
    return x, y, rng.random(400) < 0.15


def frame(spark, sample, series=0):
    return spark.createDataFrame([(series, float(t), bool(h), [float(v) for v in r])
                                  for r, t, h in zip(*sample)], SCHEMA)


@pytest.mark.parametrize("options", [
    dict(max_iter=6, step=0.3, depth=3, min_rows=10, l2=0.1, max_leaves=31, bins=32, patience=None),
    dict(max_iter=3, step=0.5, depth=4, min_rows=5, l2=0.0, max_leaves=6, bins=255, patience=None),
    dict(max_iter=40, step=0.9, depth=3, min_rows=2, l2=1.0, max_leaves=31, bins=16, patience=3)])
def test_trees_equal_a_plain_version(spark, sample, options, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    base, trees, losses, score = plain(*sample, **options)
    mine = boosting.grow(frame(spark, sample).repartition(3), **options)[0]
    assert mine[0] == pytest.approx(base)
    assert [{n: s[:2] for n, s in splits.items()} for splits, _ in mine[1]] == trees
    assert len(trees) < 40
    if options["patience"]:
        assert mine[2] == pytest.approx(losses, abs=1e-6)
    model = boosting.BoostedTreesModel.of(mine, 4)
    rows = frame(spark, sample).select(array_to_vector("features").alias("features"))
    assert [r.prediction for r in model.transform(rows).collect()] == pytest.approx(list(score))


def test_partitions_do_not_matter_and_series_do_not_mix(spark, sample, monkeypatch):
    options = dict(max_iter=5, step=0.2, depth=3, min_rows=5, l2=0.1, patience=None)
    alone = boosting.grow(frame(spark, sample).repartition(1), **options)[0]
    half = tuple(a[:200] for a in sample)
    monkeypatch.setattr(boosting, "ROWS_PER_PART", 60)
    both = boosting.grow(frame(spark, sample, 1).union(frame(spark, half, 2)).repartition(7),
                         **options)
    assert both[1] == alone
    assert both[2] == boosting.grow(frame(spark, half, 9), **options)[9]


def test_bad_input_and_small_input(spark, sample):
    options = dict(max_iter=2, step=0.5, depth=3, min_rows=5, l2=0.1)
    with pytest.raises(ValueError):
        boosting.grow(frame(spark, sample).limit(0), **options)
    with pytest.raises(ValueError):
        boosting.HistogramBoosting(maxBins=1000)
    same = spark.createDataFrame([(0, 2.0, False, [1.0, 2.0])] * 30, SCHEMA)
    base, trees, _ = boosting.grow(same, **options)[0]
    assert base == 2.0 and [t[0] for t in trees] == [{}, {}]
    zero = spark.createDataFrame([(0, 0.0, False, [1.0])] * 3, SCHEMA)
    assert boosting.grow(zero, **options)[0][0] == 0.0


def test_model_is_saved_and_loaded(spark, sample):
    table = frame(spark, sample).withColumn("features", array_to_vector("features"))
    estimator = boosting.HistogramBoosting(labelCol="target", maxIter=4, patience=2,
                                           validationIndicatorCol="held_out")
    model = estimator.fit(table)
    path = fresh_path(spark, "boosted")
    model.write().overwrite().save(path)
    again = boosting.BoostedTreesModel.load(path)
    pick = lambda m: [r.prediction for r in m.transform(table).collect()]
    assert pick(again) == pick(model) and again.getNumTrees == model.getNumTrees
    shares = again.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares.argmax() == 0 and shares[3] == 0


@pytest.mark.parametrize("estimator", [
    lambda: learning.boosted(maxIter=5, maxDepth=3), lambda: learning.forest(numTrees=5, maxDepth=4)])
def test_folds_do_not_see_later_rows(spark, sample, estimator):
    """Other values in the last fold change its own scores only."""
    x, y, _ = sample
    days = spark.createDataFrame(
        [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
        "i int, a double, b double, c double, d double, total_kwh double").select(
        F.date_add(F.lit("2020-01-01"), F.col("i")).alias("Date"), "a", "b", "c", "d", "total_kwh")
    late = F.col("Date") >= F.date_add(F.lit("2020-01-01"), 400 - 400 // 4)
    other = days.withColumns({c: F.when(late, F.col(c) * 50 + 7).otherwise(F.col(c))
                              for c in ("a", "b", "total_kwh")})
    first, second = ({r["fold"]: (r["MAE"], r["R2"]) for r in learning.cross_validate(
        estimator(), written(t, "days"), ["a", "b", "c", "d"], 3).collect()} for t in (days, other))
    assert set(first) == {1, 2, 3}
    assert all(first[k] == pytest.approx(second[k]) for k in (1, 2)) and first[3] != second[3]
