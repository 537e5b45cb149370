"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one per group.

Every label has cells of its own, as only vectors of equal label are compared. A vector is compared in its own cell. It is a guest of another cell if a vector there could be
similar to it: for unit vectors x of cell A and y of cell B at a distance of at most d, the
gaps ``x.cA - x.cB`` and ``y.cB - y.cA`` are not negative and add up to at most ``d |cA - cB|``,
so one of the two is at most half of that and its vector visits the other's cell. No pair is
lost, however the cells were fitted.
"""

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import (DRAWS, broadcast, components, drawn_below, list_array, opened,
                                 written)

#: Rows of a block, and numbers in it; a task compares two blocks of a cell.
BLOCK, NUMBERS = 4096, 1 << 20
#: Rows whose products with all others are held at once.
STRIP = 256


def spherical_kmeans(x, k, rounds=12, seed=3):
    """Unit centroids of unit rows; an empty cell takes the row farthest from its centroid."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = x @ centers.T
        cell = near.argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, cell, x)
        for c in np.flatnonzero(np.linalg.norm(sums, axis=1) < 1e-9):
            sums[c] = x[near.max(1).argmin()]
        centers = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centers


def _matrix(column):
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _visits(x, centers, threshold):
    """(cell of every row, which other cells it visits) of rows of one label."""
    apart = np.sqrt(np.maximum(0, 2 - 2 * (centers @ centers.T)))
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) / 2 * apart + 1e-7
    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ centers.T
    rows, best = np.arange(len(x)), near.argmax(1)
    visit = near[rows, best][:, None] - near <= reach[best]
    visit[rows, best] = False
    return best, visit


def _assign(shared, threshold, dim):
    def run(batches):
        centers = opened(shared)
        for batch in batches:
            home = np.zeros(len(batch), np.int64)
            guests = [[] for _ in range(len(batch))]
            usual = batch.column("e").value_lengths().to_numpy() == dim
            coded = batch.column("label").dictionary_encode()
            codes = coded.indices.to_numpy()
            for code, label in enumerate(coded.dictionary.to_pylist()):
                at = np.flatnonzero(usual & (codes == code))
                if label not in centers or not len(at):
                    continue
                home[at], visit = _visits(_matrix(batch.column("e").take(pa.array(at))),
                                          centers[label], threshold)
                for row, cells in zip(at.tolist(), visit):
                    guests[row] = np.flatnonzero(cells).tolist()
            rows = np.repeat(np.arange(len(batch)), [1 + len(g) for g in guests])
            cells = [c for h, g in zip(home.tolist(), guests) for c in (h, *g)]
            taken = batch.take(pa.array(rows))
            of = [guests[r] for r in rows.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(home[rows], pa.int32()), pa.array(cells, pa.int32()),
                 list_array([c for g in of for c in g], [len(g) for g in of], pa.int32())],
                [*taken.schema.names, "home", "cell", "guests"])
    return run


def _pairs(x, norm, rows, columns, threshold, ordered):
    """Strips (row, column) of the similar pairs; of ``ordered`` ones the column is the later."""
    if not len(rows) or not len(columns):
        return
    other, other_norm = x[columns], norm[columns]
    for low in range(0, len(rows), STRIP):
        some = rows[low:low + STRIP]
        a, b = np.nonzero((x[some] @ other.T) / (norm[some][:, None] * other_norm) >= threshold)
        a, b = some[a], columns[b]
        yield (a[a < b], b[a < b]) if ordered else (a, b)


class Forest:
    """Grows a spanning forest from pairs, of which those within a tree add nothing."""

    def __init__(self, nodes):
        self.root, self.edges = np.arange(nodes), []

    def add(self, a, b):
        fresh = np.flatnonzero(self.root[a] != self.root[b])
        while len(fresh):
            # All trees that the first open row is linked with become one.
            at = a[fresh[0]]
            mine = fresh[a[fresh] == at]
            roots, first = np.unique(self.root[b[mine]], return_index=True)
            self.edges += [(at, b[mine[i]]) for i in first.tolist()]
            self.root[np.isin(self.root, roots)] = self.root[at]
            fresh = fresh[self.root[a[fresh]] != self.root[b[fresh]]]


def _tile(threshold):
    def run(table):
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        cell = table.column("cell")[0].as_py()
        away = table.column("home").to_numpy() != cell
        # Rows at home first, within each block.
        order = np.lexsort((table.column("rep").to_numpy(), away, table.column("at").to_numpy()))
        table = table.take(pa.array(order)).combine_chunks()
        x = _matrix(table.column("e").combine_chunks())
        norm = np.linalg.norm(x, axis=1)
        rep, many = table.column("rep").to_numpy(), table.column("many").to_numpy()
        home, at = table.column("home").to_numpy(), table.column("at").to_numpy()
        own, every = home == cell, np.arange(len(x))
        guests = table.column("guests").combine_chunks()
        # (row, cell visited) as sorted numbers.
        visits = (np.repeat(every, guests.value_lengths().to_numpy()) << 32) + (
            guests.flatten().to_numpy())

        def visited(row, other):
            key = (row << 32) + other
            place = np.searchsorted(visits, key)
            return (place < len(visits)) & (np.append(visits, -1)[place] == key)

        # Two guests meet elsewhere.
        if i == j:
            strips = _pairs(x, norm, np.flatnonzero(own), every, threshold, True)
        else:
            left, right = np.flatnonzero(at == i), np.flatnonzero(at == j)
            strips = chain(_pairs(x, norm, left[own[left]], right, threshold, False),
                           _pairs(x, norm, left[~own[left]], right[own[right]], threshold, False))
        degree, forest = np.zeros(len(x)), Forest(len(x))
        for a, b in strips:
            forest.add(a, b)
            # A pair of two cells that visit each other is counted in the lower cell alone.
            twice = np.zeros(len(a), bool)
            for g, h in ((a, b), (b, a)):
                low = np.flatnonzero(home[g] < cell)
                twice[low] |= visited(h[low], home[g[low]])
            a, b = a[~twice], b[~twice]
            degree += np.bincount(a, many[b], len(x)) + np.bincount(b, many[a], len(x))
        edges = np.array(forest.edges, np.int64).reshape(-1, 2)
        some = np.flatnonzero(degree)
        return pa.table({
            "a": np.concatenate((rep[some], rep[edges[:, 0]])).astype(np.int64),
            "b": pa.array(np.concatenate((0 * some, rep[edges[:, 1]])).astype(np.int64),
                          mask=np.arange(len(some) + len(edges)) < len(some)),
            "links": np.concatenate((degree[some], np.zeros(len(edges)))).astype(np.int64)})
    return run


def _centers(classes, dim, sample_rows, cell_rows, max_cells):
    """{label: unit centroids} of the labels that have enough classes for two cells or more.

    If that were over ``max_cells``, cells are larger.
    """
    usual = classes.where(F.size("e") == dim)
    sizes = usual.groupBy("label").agg(F.count("*").alias("n"))
    rows = sizes.agg(F.sum("n")).first()[0]
    wide = max(cell_rows, math.ceil(rows / max_cells))
    large = sizes.where(F.col("n") >= 2 * wide)
    drawn = usual.where(F.pmod(F.xxhash64("label", "e"), F.lit(DRAWS))
                        < drawn_below(sample_rows, rows))
    sample = drawn.join(large, "label").orderBy("label", "e").select("label", "n", "e").toArrow()
    coded = sample.column("label").combine_chunks().dictionary_encode()
    codes, counts = coded.indices.to_numpy(), sample.column("n").to_numpy()
    x = _matrix(sample.column("e").combine_chunks())
    out = {}
    for code, label in enumerate(coded.dictionary.to_pylist()):
        at = np.flatnonzero(codes == code)
        k = min(int(counts[at[0]]) // wide, len(at))
        if k > 1:
            out[label] = spherical_kmeans(
                x[at] / np.linalg.norm(x[at], axis=1, keepdims=True), k)
    return out


def near_vectors(vectors: DataFrame, id="vec_id", vector="embedding", label="label",
                 threshold=0.93, cell_rows=1024, max_cells=512, sample_rows=20_000) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Rows of equal label link if the cosine of their vectors, in double precision, is at least
    ``threshold``. ``n_links`` counts the rows linked directly, ``component_id`` is the smallest
    id that links reach, and the row of that id is kept. All such links are found.

    Rows with NULL id, label or vector, or whose vector is empty, all zero, or has a NULL or
    non-finite part, link with nothing and are kept. Vectors of different length never link;
    those that are not of the usual length share one cell per label. Equal vectors are one class
    with a count; rows of one id are vectors of their own. An empty table gives no rows.

    A label has about one centroid per ``cell_rows`` classes, all labels at most ``max_cells``,
    fitted on a sample of at most about ``sample_rows`` vectors and broadcast. A cell of many rows is cut
    into blocks, and every pair of blocks is a task of its own, so a large group has no hot
    task; a task returns counts and a spanning forest, not pairs.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"),
                          F.col(f"`{label}`").alias("label"),
                          F.col(f"`{vector}`").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    square = F.aggregate("e", F.lit(0.0), lambda s, v: s + v * v)
    fit = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull())
    fit = fit.where(finite).where((square > 0) & (square < float("inf")))
    # A class has a number of its own, fixed once written: ids may repeat across classes.
    classes = written(fit.groupBy("label", "e").agg(
        F.min("id").alias("least"), F.count("*").alias("many")).withColumn(
        "rep", F.monotonically_increasing_id()), "vectors")
    lengths = classes.groupBy(F.size("e").alias("dim")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "dim").first()
    dim = lengths[0] if lengths else 1
    centers = _centers(classes, dim, sample_rows, cell_rows, max_cells) if lengths else {}
    kind = dict(rows.dtypes)["label"]
    placed = written(classes.select("label", "e", "rep", "many").mapInArrow(
        _assign(broadcast(spark, centers), threshold, dim),
        f"label {kind}, e array<double>, rep long, many long, home int, cell int, "
        "guests array<int>").withColumn("dim", F.size("e")), "cells")
    cell = ["label", "dim", "cell"]
    fill = F.least(F.lit(BLOCK), F.greatest(F.lit(STRIP), F.floor(NUMBERS / F.col("dim"))))
    blocks = placed.groupBy(*cell).agg(F.ceil(F.count("*") / fill).alias("blocks"))
    tiles = (placed.join(blocks, cell)
             .withColumn("at", F.pmod(F.xxhash64("rep"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"),
                                                       F.col("blocks") - 1)))
             .withColumn("i", F.least("at", "other")).withColumn("j", F.greatest("at", "other")))
    found = written(tiles.drop("blocks", "other").groupBy(*cell, "i", "j").applyInArrow(
        _tile(threshold), "a long, b long, links long"), "links")
    degree = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(
        F.sum("links").alias("links"))
    groups = components(found.where("b IS NOT NULL").select("a", "b"), "groups")
    rooted = (classes.join(groups, F.col("rep") == F.col("node"), "left")
              .withColumn("root", F.coalesce("component", "rep")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = (rooted.drop("component").join(least, "root").join(degree, "rep", "left")
             .select("label", "e", "component",
                     (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links")))
    usable = (F.col("id").isNotNull() & finite & (square > 0) & (square < float("inf")))
    out = rows.withColumn("usable", F.coalesce(usable, F.lit(False))).alias("r").join(
        named.alias("c"), F.col("usable") & (F.col("r.label") == F.col("c.label"))
        & (F.col("r.e") == F.col("c.e")), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id), F.coalesce("links", F.lit(0)).cast("long").alias(
        "n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
