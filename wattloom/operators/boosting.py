"""Boosted regression trees on histograms, with an L2 term and early stopping, grown on Spark.

Features are cut into bins once, at distributed quantiles. A level of a tree is one job: tasks sum
gradients and rows per (series, node, feature, bin), one shuffle adds the sums, and the best split
of each node, a row, is all that comes back. Several series (the folds of a validation) grow their
trees side by side in the same jobs.

Gradients are rounded to multiples of a fixed unit and summed as whole numbers, so the trees do
not depend on how the rows are partitioned, nor on tasks that are run again.
"""

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol,
                                     HasStepSize, HasValidationIndicatorCol)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from wattloom.session import written

# Functions of this module go to the executors by value; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Quantiles are exact to one part in this many.
ACCURACY = 100_000
#: Bits of a gradient in units; sums of 2**32 rows still fit a long.
GRADIENT_BITS = 30
#: Scores are stored every so many trees; in between, tasks replay the trees since.
REFRESH = 20
#: Rows of a training table for each of its partitions.
ROWS_PER_PART = 50_000
#: A tree counts as a gain if it lowers the mean loss by more than this.
TOLERANCE = 1e-7
MAX_BINS = 255


def bin_edges(rows: DataFrame, bins=MAX_BINS) -> dict[tuple[int, int], list[float]]:
    """{(series, feature): ascending values}, at most ``bins - 1``; bin i holds values up to the
    i-th, the last bin all above.

    They are quantiles of a series' training rows, found in one distributed pass. What comes to
    the driver is bounded by the number of series, features and bins.
    """
    shares = [(i + 1) / bins for i in range(bins - 1)]
    edges = (rows.where("NOT held_out").select("series", F.posexplode("features").alias("f", "x"))
             .groupBy("series", "f")
             .agg(F.percentile_approx("x", shares, ACCURACY).alias("at"), F.max("x").alias("top"))
             .select("series", "f", F.array_sort(F.array_distinct(
                 F.filter("at", lambda v: v < F.col("top")))).alias("at")))
    return {(r["series"], r["f"]): list(r["at"]) for r in edges.collect()}


class Tree:
    """Splits and leaf values by node number: the children of node n are 2n and 2n + 1."""

    def __init__(self):
        self.splits = {}  # node: (feature, bin, gain)
        self.sums = {}  # node: (gradients in units, rows)
        self.leaves = {}  # node: value

    def arrays(self, depth):
        """(feature, bin, value) by node number; feature -1 is a leaf or nothing."""
        size = 2 << depth
        feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        for node, (f, b, _) in self.splits.items():
            feature[node], cut[node] = f, b
        for node, v in self.leaves.items():
            value[node] = v
        return feature, cut, value

    def close(self, unit, step, l2, max_leaves):
        """Keep the splits that best-first growth makes until there are ``max_leaves`` leaves, and
        give every leaf its value, -G / (n + l2) times the step."""
        kept, waiting = {}, [1] if 1 in self.splits else []
        while waiting and len(kept) < max_leaves - 1:
            node = max(waiting, key=lambda n: (self.splits[n][2], -n))
            waiting.remove(node)
            kept[node] = self.splits[node]
            waiting += [c for c in (2 * node, 2 * node + 1) if c in self.splits]
        self.splits = kept
        for node in [1] if not kept else [c for n in kept for c in (2 * n, 2 * n + 1)]:
            if node not in kept:
                g, n = self.sums[node]
                self.leaves[node] = -step * g * unit / (n + l2)


def nodes_of(bins, tree, depth):
    """The node in which each row of a matrix of bins ends."""
    feature, cut, _ = tree
    node = np.ones(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        f = feature[node]
        down = f >= 0
        right = bins[rows, np.maximum(f, 0)] > cut[node]
        node = np.where(down, 2 * node + right, node)
    return node


#: The best split of every node from partial histograms. One exchange by feature serves the sums
#: and the running sums over bins; what is left for the second is a row per node and feature.
BEST_SPLITS = """
WITH sums AS (
  SELECT series, node, feature, bin, sum(sum_g) AS sum_g, sum(sum_n) AS sum_n FROM {cells}
  GROUP BY series, node, feature, bin),
running AS (
  SELECT *, sum(sum_g) OVER upto AS gl, sum(sum_n) OVER upto AS nl,
         sum(sum_g) OVER feature AS g, sum(sum_n) OVER feature AS n
  FROM sums WINDOW feature AS (PARTITION BY series, node, feature),
    upto AS (PARTITION BY series, node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING)),
scored AS (
  SELECT *, CASE WHEN nl >= :min_rows AND n - nl >= :min_rows THEN
         pow(gl * :unit, 2) / (nl + :l2) + pow((g - gl) * :unit, 2) / (n - nl + :l2)
         - pow(g * :unit, 2) / (n + :l2) END AS gain FROM running),
best AS (
  SELECT series, node, first(g) AS g, first(n) AS n, max(CASE WHEN gain > 0 THEN
           struct(gain, -feature AS f, -bin AS b, gl, nl) END) AS x
  FROM scored GROUP BY series, node)
SELECT series, node, g, n, x.gain, -x.f AS feature, -x.b AS bin, x.gl, x.nl FROM best
"""


def best_splits(cells: DataFrame, unit: float, l2: float, min_rows: int) -> DataFrame:
    """(series, node, g, n, gain, feature, bin, gl, nl): a node's sums and its best split, if any.

    ``cells`` holds sums sum_g, in units, and sum_n per (series, node, feature, bin), in parts. A
    split sends bins up to ``bin`` (sums gl, nl) to the left; its gain is what it takes off the
    loss. Ties go to the smaller feature, then to the smaller bin.
    """
    return cells.sparkSession.sql(
        BEST_SPLITS, args={"unit": unit, "l2": float(l2), "min_rows": min_rows},
        cells=cells.repartition("series", "node", "feature"))


def _replayed(batch, since, depth, width):
    """(series, target, score, held out, bins) of a batch, scores brought up to date."""
    series = batch.column("series").to_numpy(zero_copy_only=False)
    target = batch.column("target").to_numpy(zero_copy_only=False)
    score = batch.column("score").to_numpy(zero_copy_only=False).copy()
    held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8
                         ).reshape(len(series), width).astype(np.int64)
    for s, trees in since.items():
        at = np.flatnonzero(series == s)
        if len(at):
            mine, change = bins[at], score[at]
            for tree in trees:
                change = change + tree[2][nodes_of(mine, tree, depth)]
            score[at] = change
    return series, target, score, held_out, bins


def _histograms(shared, width, many):
    """Sums of a level's nodes; at the root also, as node 0, the loss of the held-out rows."""
    def run(batches):
        since, growing, depth, unit, loss_unit, level = shared.value
        first, nodes = 1 << level, 1 << level
        size = nodes * width * many
        sums, losses = {}, {}
        for batch in batches:
            series, target, score, held_out, bins = _replayed(batch, since, depth, width)
            error = score - target
            gradient = np.rint(error / unit).astype(np.int64)
            for s, tree in growing.items():
                mine = series == s
                if not level and (mine & held_out).any():
                    loss = np.rint(error[mine & held_out] ** 2 / loss_unit).astype(np.int64)
                    total, n = losses.get(s, (0, 0))
                    losses[s] = total + int(loss.sum()), n + len(loss)
                at = np.flatnonzero(mine & ~held_out)
                node = nodes_of(bins[at], tree, depth) - first
                at, node = at[node >= 0], node[node >= 0]  # the others lie in leaves above
                if not len(at):
                    continue
                cell = ((node[:, None] * width + np.arange(width)) * many + bins[at]).ravel()
                n = np.bincount(cell, minlength=size)
                # Whole numbers in two halves, each exact as a double.
                total = np.zeros(size, np.int64)
                for part, scale in zip(np.divmod(gradient[at], 1 << 15), (1 << 15, 1)):
                    total += scale * np.bincount(cell, np.repeat(part, width).astype(float), size
                                                 ).astype(np.int64)
                old = sums.get(s, (0, 0))
                sums[s] = n + old[0], total + old[1]
        columns = [[] for _ in range(6)]
        for s, (n, total) in sums.items():
            at = np.flatnonzero(n)
            place, b = np.divmod(at, many)
            node, f = np.divmod(place, width)
            for c, x in zip(columns, (np.full(len(at), s), node + first, f, b, total[at], n[at])):
                c.append(x)
        for s, (total, n) in losses.items():
            for c, x in zip(columns, (s, 0, -1, 0, total, n)):
                c.append([x])
        if columns[0]:
            kinds = [pa.int32()] * 4 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds)],
                ["series", "node", "feature", "bin", "sum_g", "sum_n"])
    return run


def _refreshed(shared, width):
    def run(batches):
        since, depth = shared.value
        for batch in batches:
            score = _replayed(batch, since, depth, width)[2]
            at = batch.schema.get_field_index("score")
            yield batch.set_column(at, "score", pa.array(score))
    return run


def _binned(shared, width):
    def run(batches):
        edges = shared.value
        for batch in batches:
            series = batch.column("series").to_numpy(zero_copy_only=False)
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            x = x.reshape(-1, width)
            bins = np.zeros(x.shape, np.uint8)
            for s in np.unique(series).tolist():
                mine = series == s
                for f in range(width):
                    bins[mine, f] = np.searchsorted(edges.get((s, f), []), x[mine, f])
            rest = batch.drop_columns(["features"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([r.tobytes() for r in bins], pa.binary())],
                [*rest.schema.names, "bins"])
    return run


def _stopped(losses, patience):
    """None of the last ``patience`` losses is better than the one before them."""
    if not patience or len(losses) <= patience:
        return False
    before = losses[-patience - 1] - TOLERANCE
    return not any(x < before for x in losses[-patience:])


def grow(rows: DataFrame, max_iter: int, step: float, depth: int, min_rows: int, l2=0.0,
         max_leaves=31, bins=MAX_BINS, patience=None) -> dict:
    """{series: (base, trees, losses)} for all series of a table at once.

    ``rows`` has series (int), target, held_out and features (an array of doubles without NULLs),
    a row for each series that it takes part in. A series starts from the mean of its training
    rows and grows ``max_iter`` trees, or stops after ``patience`` trees none of which lowered
    the loss of its held-out rows (half the mean squared error, listed in ``losses`` from before
    the first tree on); all trees grown are kept. A tree is (splits, leaves) by node number: node
    n has children 2n and 2n + 1, a split is (feature, value, gain) and sends values up to
    ``value`` to the left. Held-out rows give no bins, gradients or means. No features or no
    training rows at all raise a ValueError.

    Memory of a task: a batch, and per series a histogram of nodes, features and bins. To the
    driver come the bin edges and, per level, one row a node. Rows with their bins are a written
    table, and so are their scores, renewed every ``REFRESH`` trees, so lineage stays short; the
    executors cache the table, and read again what a lost one had.
    """
    spark = rows.sparkSession
    size = rows.agg(F.max(F.abs("target")).alias("most"),
                    F.max(F.size("features")).alias("width")).first()
    width = size["width"] or 0
    scale = math.ceil(math.log2(2 * (size["most"] or 0) or 1.0))
    unit, loss_unit = 2.0 ** (scale - GRADIENT_BITS), 2.0 ** (2 * scale - GRADIENT_BITS)
    train = F.when(~F.col("held_out"), F.rint(F.col("target") / unit).cast("long"))
    facts = {r["series"]: r for r in rows.groupBy("series").agg(
        (F.sum(train) / F.count(train) * unit).alias("base"), F.count("*").alias("n"))
        .where("base IS NOT NULL").collect()}  # a row per series
    if width < 1 or not facts:
        raise ValueError("there are no training rows, or no features")
    parts = max(1, -(-sum(r["n"] for r in facts.values()) // ROWS_PER_PART))
    rows = rows.where(F.col("series").isin(list(facts)))
    edges = bin_edges(rows, bins)
    many = max((len(e) for e in edges.values()), default=0) + 1
    base = F.create_map(*[F.lit(x) for s, r in facts.items() for x in (s, r["base"])])
    kind = "series int, target double, held_out boolean, score double, bins binary"
    state = rows.select(
        F.col("series").cast("int").alias("series"), F.col("target").cast("double").alias("target"),
        "held_out", base[F.col("series")].alias("score"), "features")
    state = written(state.repartition(parts).mapInArrow(
        _binned(spark.sparkContext.broadcast(edges), width), kind), "binned").persist()
    trees, losses, stored = {s: [] for s in facts}, {s: [] for s in facts}, 0
    active = sorted(facts)

    def since():
        return {s: [t.arrays(depth) for t in trees[s][stored:]] for s in trees}

    for _ in range(max_iter):
        new, live = {s: Tree() for s in active}, set(active)
        for level in range(depth):
            shared = spark.sparkContext.broadcast(
                (since(), {s: new[s].arrays(depth) for s in live}, depth, unit, loss_unit, level))
            cells = state.mapInArrow(
                _histograms(shared, width, many),
                "series int, node int, feature int, bin int, sum_g long, sum_n long")
            found = best_splits(cells, unit, l2, min_rows).collect()  # a row per node
            shared.destroy()
            live = set()
            for r in found:
                s, node = r["series"], r["node"]
                if not node:
                    losses[s].append(r["g"] * loss_unit / r["n"] / 2)
                    continue
                new[s].sums[node] = r["g"], r["n"]
                if r["gain"] is not None:
                    new[s].splits[node] = r["feature"], r["bin"], r["gain"]
                    new[s].sums[2 * node] = r["gl"], r["nl"]
                    new[s].sums[2 * node + 1] = r["g"] - r["gl"], r["n"] - r["nl"]
                    live.add(s)
            active = [s for s in active if not _stopped(losses[s], patience)]
            live &= set(active)
            if not live:
                break
        for s in active:
            new[s].close(unit, step, l2, max_leaves)
            trees[s].append(new[s])
        if not active:
            break
        if max(len(t) for t in trees.values()) - stored >= REFRESH:
            shared = spark.sparkContext.broadcast((since(), depth))
            old, state = state, written(state.mapInArrow(_refreshed(shared, width), kind),
                                        "scores").persist()
            old.unpersist()
            stored += REFRESH
    state.unpersist()
    value = lambda s, f, b: edges[s, f][b]
    return {s: (facts[s]["base"], [
        ({n: (f, value(s, f, b), gain) for n, (f, b, gain) in t.splits.items()}, t.leaves)
        for t in trees[s]], losses[s]) for s in facts}


class BoostedTreesModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable,
                        DefaultParamsWritable):
    """A sum of trees over the ``features`` vector.

    Saved and loaded like any other ``pyspark.ml`` stage. ``trees`` are rows of numbers, as
    bounded as the model: per tree its (node, feature, value, gain) of splits, feature -1 and
    value being those of a leaf.
    """

    trees = Param(Params._dummy(), "trees", "nodes of each tree", TypeConverters.toList)
    base = Param(Params._dummy(), "base", "prediction before the first tree",
                 TypeConverters.toFloat)
    losses = Param(Params._dummy(), "losses", "held-out loss before each tree",
                   TypeConverters.toListFloat)
    numFeatures = Param(Params._dummy(), "numFeatures", "size of the vector",
                        TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(losses=[])

    @classmethod
    def of(cls, grown, width, features="features", prediction="prediction"):
        base, trees, losses = grown
        rows = [[[n, f, v, gain] for n, (f, v, gain) in sorted(splits.items())]
                + [[n, -1, v, 0.0] for n, v in sorted(leaves.items())] for splits, leaves in trees]
        return cls()._set(trees=rows, base=float(base), losses=[float(x) for x in losses],
                          numFeatures=width, featuresCol=features, predictionCol=prediction)

    @property
    def getNumTrees(self):
        return len(self.getOrDefault(self.trees))

    @property
    def featureImportances(self):
        """Each feature's share of all gains."""
        gains = np.zeros(self.getOrDefault(self.numFeatures))
        for tree in self.getOrDefault(self.trees):
            for _, f, _, gain in tree:
                if f >= 0:
                    gains[int(f)] += gain
        return Vectors.dense(gains / (gains.sum() or 1.0))

    def _arrays(self):
        """Nodes of all trees by tree and node number, and the depth."""
        trees = self.getOrDefault(self.trees)
        top = max((int(r[0]) for t in trees for r in t), default=1)
        feature = np.full((len(trees), top + 1), -1)
        value = np.zeros(feature.shape)
        for i, t in enumerate(trees):
            for n, f, v, _ in t:
                feature[i, int(n)], value[i, int(n)] = int(f), v
        return feature, value, max(top.bit_length() - 1, 0)

    def _transform(self, df):
        feature, value, depth = self._arrays()
        rows = [([int(f) for f in fs], [float(v) for v in vs]) for fs, vs in zip(feature, value)]
        # The trees come from a one-row subquery; rows fold over them without leaving the JVM.
        trees = df.sparkSession.createDataFrame(
            [(rows,)], "trees array<struct<f:array<int>,v:array<double>>>").scalar()
        x = vector_to_array(self.getFeaturesCol())

        def leaf(tree):
            def below(node, _):
                f = F.get(tree["f"], node)
                right = F.when(F.get(F.col("_x"), f) <= F.get(tree["v"], node), 0).otherwise(1)
                return F.when(f < 0, node).otherwise(node * 2 + right)
            return F.aggregate(F.array(*[F.lit(i) for i in range(max(depth, 1))]), F.lit(1), below)

        total = F.aggregate("_trees", F.lit(self.getOrDefault(self.base)),
                            lambda a, tree: a + F.get(tree["v"], leaf(tree)))
        return df.withColumns({"_x": x, "_trees": trees}).withColumn(
            self.getPredictionCol(), total).drop("_x", "_trees")


class HistogramBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter,
                        HasStepSize, HasValidationIndicatorCol, DefaultParamsReadable,
                        DefaultParamsWritable):
    """Estimator over ``grow``: squared loss, leaf values -G / (n + l2), early stopping.

    Rows whose ``validationIndicatorCol`` is true are held out; without that column, or without
    ``patience``, all ``maxIter`` trees are grown.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "splits above a leaf", TypeConverters.toInt)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "leaves of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most 255",
                    TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a leaf",
                                TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "added to the rows of a leaf", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "trees without gain before the end; 0: no end",
                     TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 validationIndicatorCol=None, maxIter=100, stepSize=0.1, maxDepth=5, maxLeaves=31,
                 maxBins=MAX_BINS, minInstancesPerNode=20, l2=0.0, patience=0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        for name, value in dict(featuresCol="features", labelCol="label", maxIter=100,
                                predictionCol="prediction", stepSize=0.1, maxDepth=5, maxLeaves=31,
                                maxBins=MAX_BINS, minInstancesPerNode=20, l2=0.0, patience=0).items():
            self._setDefault(**{name: value})
        if not 2 <= self.getOrDefault(self.maxBins) <= MAX_BINS:
            raise ValueError(f"maxBins must be from 2 to {MAX_BINS}")

    def settings(self):
        get = lambda p: self.getOrDefault(p)
        return dict(max_iter=get(self.maxIter), step=get(self.stepSize), depth=get(self.maxDepth),
                    min_rows=get(self.minInstancesPerNode), l2=get(self.l2),
                    max_leaves=get(self.maxLeaves), bins=get(self.maxBins),
                    patience=get(self.patience) or None)

    def rows_of(self, df, series=0):
        """The rows of a table with a ``features`` vector as ``grow`` takes them."""
        held = (F.coalesce(F.col(self.getValidationIndicatorCol()), F.lit(False))
                if self.isDefined(self.validationIndicatorCol) else F.lit(False))
        return df.where(F.col(self.getLabelCol()).isNotNull()).select(
            F.lit(series).alias("series"), F.col(self.getLabelCol()).alias("target"),
            held.alias("held_out"), vector_to_array(self.getFeaturesCol()).alias("features"))

    def fit_series(self, rows) -> dict[int, BoostedTreesModel]:
        """A model for each series of stacked ``rows_of`` tables, all grown in the same jobs."""
        width = rows.agg(F.max(F.size("features"))).first()[0]
        return {s: BoostedTreesModel.of(g, width, self.getFeaturesCol(), self.getPredictionCol())
                for s, g in grow(rows, **self.settings()).items()}

    def _fit(self, df):
        return self.fit_series(self.rows_of(df))[0]
