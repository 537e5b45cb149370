"""Quality classifier by positive-unlabelled learning with the non-negative risk.

The trusted positives and the unlabelled web text give the risk
``p * E+[l(f)] + max(0, Eu[l(-f)] - p * E+[l(-f)])`` with class prior ``p``; the part in ``max``
is the risk on negatives, which flexible models otherwise push below zero. ``f`` is a network
of one hidden layer over counts of what a text is written with.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import (DRAWS, WordHasher, broadcast, crc32_of, drawn_below, free_name,
                                 lower_map, opened, text_chunks, word_spans, written)

#: Byte classes whose pairs are counted.
CLASSES = [b" ", b"\n\r", bytes(range(ord("a"), ord("z") + 1)),
           bytes(range(ord("A"), ord("Z") + 1)), b"0123456789", b".,;:", b"!?", b"'\"()[]{}",
           b"#$%&*@^~|\\/=+<>_-`", bytes(range(0x80, 0x100))]
KINDS = len(CLASSES) + 1
CLASS_OF = np.zeros(256, np.int64)
for _number, _members in enumerate(CLASSES, 1):
    CLASS_OF[list(_members)] = _number
WIDTH = KINDS * KINDS + 6
SPACES = lower_map([*range(9, 14), 32])


def features(column) -> np.ndarray:
    """One row per text, NULL as empty: shares of byte-class pairs, repeats, lengths."""
    out, hasher = np.zeros((len(column), WIDTH), np.float32), WordHasher()
    for row, raw, offsets in text_chunks(column):
        n = len(offsets) - 1
        text_of = np.repeat(np.arange(n), np.diff(offsets))
        kind = CLASS_OF[raw]
        cell = text_of[1:] * KINDS * KINDS + kind[:-1] * KINDS + kind[1:]
        cell = cell[text_of[1:] == text_of[:-1]]
        pairs = np.bincount(cell, minlength=n * KINDS * KINDS).reshape(n, -1)
        size = np.maximum(np.diff(offsets), 1)[:, None]
        part = out[row:row + n]
        part[:, :KINDS * KINDS] = np.sqrt(pairs / size)
        mapped = SPACES[raw]
        starts, ends = word_spans(mapped, offsets)
        h = hasher(mapped, starts, ends)
        of = text_of[starts]
        words = np.bincount(of, minlength=n)
        for back, place in ((1, 0), (2, 1)):
            same = (h[back:] == h[:-back]) & (of[back:] == of[:-back])
            part[:, KINDS * KINDS + place] = np.bincount(of[back:][same], minlength=n) / np.maximum(
                words, 1)
        part[:, -4] = np.log1p(np.diff(offsets))
        part[:, -3] = np.log1p(words)
        part[:, -2] = size[:, 0] / np.maximum(words, 1) / 10
        part[:, -1] = np.bincount(text_of[raw == 10], minlength=n) / np.maximum(words, 1)
    return out


def _features(batches):
    for batch in batches:
        flat = features(batch.column("text"))
        vectors = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel(), pa.float32()), WIDTH)
        yield pa.RecordBatch.from_arrays(
            [batch.column("y"), vectors.cast(pa.list_(pa.float32()))], ["y", "x"])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Network:
    """Standardised input, a hidden layer, one output; trained by Adam."""

    def __init__(self, mean, scale, hidden, rng):
        self.mean, self.scale = mean, scale
        self.w = [rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), hidden)), np.zeros(hidden),
                  rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        self.slope, self.shift = 1.0, 0.0

    def ready(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def forward(self, z):
        hidden = np.tanh(z @ self.w[0] + self.w[1])
        return hidden, hidden @ self.w[2] + self.w[3]

    def gradient(self, z, hidden, d):
        back = d[:, None] * self.w[2] * (1 - hidden ** 2)
        return [z.T @ back, back.sum(0), hidden.T @ d, np.array([d.sum()])]

    def score(self, x):
        return _sigmoid(self.slope * self.forward(self.ready(x))[1] + self.shift)


def fit_nnpu(positives, unlabelled, prior, hidden=16, epochs=60, batch=512, rate=3e-3,
             decay=1e-4, seed=7) -> Network:
    """Minimises the non-negative risk, with the sigmoid loss l(f) = 1 / (1 + exp(f)).

    Where the negatives' risk of a batch is below zero, the step goes back up on that part.
    """
    rng = np.random.default_rng(seed)
    both = np.concatenate([positives, unlabelled])
    net = Network(both.mean(0), both.std(0) + 1e-3, hidden, rng)
    p, u = net.ready(positives), net.ready(unlabelled)
    m, v, t = [0 * w for w in net.w], [0 * w for w in net.w], 0
    for _ in range(epochs):
        order = rng.permutation(len(u))
        for low in range(0, len(u), batch):
            zu = u[order[low:low + batch]]
            zp = p[rng.integers(0, len(p), min(batch, len(p)))]
            (hp, fp), (hu, fu) = net.forward(zp), net.forward(zu)
            sp, su = _sigmoid(fp), _sigmoid(fu)
            negative = su.mean() - prior * sp.mean()  # l(-f) is the sigmoid of f
            dp, du = sp * (1 - sp), su * (1 - su)
            if negative >= 0:
                gp, gu = -prior * dp - prior * dp, du
            else:
                gp, gu = prior * dp, -du
            steps = [a / len(zp) + b / len(zu) + decay * w for a, b, w in zip(
                net.gradient(zp, hp, gp), net.gradient(zu, hu, gu), net.w)]
            t += 1
            for i, g in enumerate(steps):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net.w[i] = net.w[i] - rate * (m[i] / (1 - 0.9 ** t)) / (
                    np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return net


def calibrate(net: Network, x, y, rounds=50):
    """Turns outputs into probabilities by a logistic curve over labelled rows (Platt)."""
    f = net.forward(net.ready(x))[1]
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    if not n1 or not n0:
        return
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([f, np.ones_like(f)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        q = _sigmoid(design @ w)
        curve = (design * (q * (1 - q))[:, None]).T @ design + 1e-6 * np.eye(2)
        w = w - np.clip(np.linalg.solve(curve, design.T @ (q - target)), -2, 2)
    if w[0] > 0:
        net.slope, net.shift = w


def train(documents: DataFrame, labels: DataFrame, id="doc_id", text="text", label="quality",
          folds=5, held_fold=0, max_rows=30_000) -> Network | None:
    """A classifier from rows whose crc32 of the id, mod ``folds``, is not ``held_fold``.

    It is fitted on a sample of at most about ``max_rows`` such documents, half of them with and
    half without a label: of each kind those with the smallest hashes of id and text among
    distinct ones (equal rows count once). So the driver's part has a fixed size, and few labels
    among many rows are all found. Sampled rows labelled 1
    are the trusted positives, rows without a label the unlabelled text; the prior is the share
    of 1 among the labelled; rows labelled 0 take part in prior and calibration alone. A
    document with labels of both kinds, or NULL, is unlabelled. Without positives there is no
    model (None); without any unlabelled row the labelled ones are the text to tell them from.
    """
    known = (labels.where(f"{label} IS NOT NULL AND {id} IS NOT NULL").groupBy(F.col(id).alias("id"))
             .agg(F.min(label).alias("low"), F.max(label).alias("high"))
             .select("id", F.when(F.col("low") == F.col("high"), F.col("low")).alias("y")))
    rows = documents.where(F.pmod(crc32_of(id), F.lit(folds)) != held_fold).select(
        F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    key = F.xxhash64("id", "text").alias("key")
    # Ids meet the labels, without texts; the rows picked are at most about max_rows.
    drawn = rows.select("id", key).distinct().join(known.where("y IS NOT NULL"), "id", "left")
    counts = drawn.agg(F.count("*"), F.count("y")).first()
    seen, unseen = (drawn_below(max_rows // 2, n) for n in (counts[1], counts[0] - counts[1]))
    picked = written(drawn.where(
        F.pmod("key", F.lit(DRAWS)) < F.when(F.col("y").isNotNull(), seen).otherwise(unseen))
        .select("key", "y"), "picked")
    sample = rows.select("id", "text", key).join(F.broadcast(picked), "key").distinct()
    sample = sample.select(F.col("y").cast("double"), "text").mapInArrow(
        _features, "y double, x array<float>")
    found = sample.toArrow()
    x = np.array(found.column("x").combine_chunks().flatten(), np.float64).reshape(-1, WIDTH)
    y = np.array(found.column("y").to_pylist(), object)
    y = np.where(y == None, np.nan, y).astype(float)  # noqa: E711
    order = np.lexsort(x.T[:12])  # the same order, however the rows arrived
    x, y = x[order], y[order]
    positive, seen = y == 1, ~np.isnan(y)
    if not positive.any():
        return None
    prior = min(0.99, max(0.01, positive.sum() / seen.sum()))
    unlabelled = x[~seen] if not seen.all() else x
    net = fit_nnpu(x[positive], unlabelled, prior)
    calibrate(net, x[seen], y[seen])
    return net


def score(documents: DataFrame, net: Network | None, id="doc_id", text="text", keep=(),
          name="score") -> DataFrame:
    """``id``, ``keep`` and the probability, 0 to 1, of quality for every row by its whole text.

    NULL and empty texts get the score of an empty text; without a model all rows get 0.5.
    Equal texts get equal scores; rows are scored one by one.
    """
    shared = broadcast(documents.sparkSession, net)
    kept = [id, *keep]
    read = list(dict.fromkeys([*kept, text]))
    kinds = dict(documents.dtypes)

    def run(batches):
        model = opened(shared)
        for batch in batches:
            column = batch.column(text)
            scores = np.full(len(column), 0.5) if model is None else model.score(features(column))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in kept], pa.array(scores, pa.float64())], [*kept, name])

    return documents.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(
        run, ", ".join([*(f"`{k}` {kinds[k]}" for k in kept), f"`{name}` double"]))


def drop_low_quality(documents: DataFrame, labels: DataFrame, threshold=0.3, id="doc_id",
                     text="text", **options) -> DataFrame:
    """The rows of ``documents`` that score at least ``threshold``, with all their columns."""
    net = train(documents, labels, id, text, **options)
    name = free_name(documents, "score")
    keep = [c for c in documents.columns if c != id]
    scored = score(documents, net, id, text, keep, name)
    return scored.where(F.col(name) >= threshold).select(*documents.columns)
