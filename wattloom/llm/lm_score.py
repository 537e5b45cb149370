"""LM scoring by a log-bilinear model, trained in numpy with noise-contrastive estimation.

The model predicts a token's symbol from the symbols of the two tokens before it. Every word of
the lexicon is a symbol with vectors of its own; words beyond it share symbols by their last two
bytes, and a word's share of its symbol is its smoothed count. Symbols are the leaves of a tree
of FAN children a node, in the order of their endings. Nodes have vectors too, trained at each
depth by noise-contrastive estimation, which needs no normaliser; a score is the product of the
probabilities of the children on the way to the leaf, each normalised over its siblings, so that
a context costs a few times FAN products instead of one for each word.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import (broadcast, crc32_of, list_array, lower_map, offsets_of, opened,
                                 text_chunks, word_spans, written)

LOWER = lower_map([])
LOWER[0] = 0
#: Byte table: 0 for white space, 1 for what words consist of.
INSIDE = np.ones(256, np.uint8)
INSIDE[[0x20, *range(0x09, 0x0E)]] = 0
#: Children of a node of the tree of symbols, as a power of two.
FAN_BITS = 6
FAN = 1 << FAN_BITS
#: The token after a text's last word. Words hold no white space, so it is none of them.
END = b"\n"
SMOOTH = 0.1


def tokens_of(column):
    """Yields (distinct tokens, place among them of each token, last place of each text).

    For slices of an Arrow column; a text's tokens are its words and END.
    """
    lower, inside = LOWER.tobytes(), INSIDE.tobytes()
    for _, raw, offsets in text_chunks(column):
        data = raw.tobytes().translate(lower)
        mapped = np.frombuffer(data.translate(inside), np.uint8)
        starts, ends = word_spans(mapped, offsets)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(offsets_of(ends - starts).astype(np.int32)),
            pa.py_buffer(np.frombuffer(data, np.uint8)[mapped.view(bool)])]).dictionary_encode()
        sizes = np.diff(np.searchsorted(starts, offsets))
        flat = np.zeros(len(starts) + len(sizes), np.int64)
        flat[np.arange(len(starts)) + np.repeat(np.arange(len(sizes)), sizes)] = np.frombuffer(
            words.indices.buffers()[1], np.int32, len(starts)) + 1
        yield [END, *_slices(words.dictionary)], flat, np.cumsum(sizes + 1) - 1


def _slices(words):
    """A new binary Arrow array as a list; faster than its own way."""
    if not len(words):
        return []
    _, places, data = words.buffers()
    places, data = np.frombuffer(places, np.int32, len(words) + 1).tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(places, places[1:])]


def _count(limit):
    def run(batches):
        seen = Counter()
        for batch in batches:
            for tokens, flat, _ in tokens_of(batch.column("text")):
                seen.update(dict(zip(tokens, np.bincount(flat).tolist())))
                if len(seen) > limit:
                    yield rows(seen)
                    seen = Counter()
        if seen:
            yield rows(seen)

    def rows(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                           pa.array(list(seen.values()), pa.int64())],
                                          ["token", "n"])
    return run


class Symbols:
    """Symbols of words, and what a word's share of its symbol is."""

    def __init__(self, lexicon, endings, words, groups):
        #: lexicon: [(token, count)], most frequent first; endings: [(last bytes, sum, distinct)]
        self.tokens = [t for t, _ in lexicon]
        self.counts = np.array([n for _, n in lexicon], np.float64)
        named = [t for t in self.tokens if t != END][:None if words is None else words - 1]
        named = [END, *sorted(named, key=lambda t: t[::-1])]
        self.named = {t: i for i, t in enumerate(named)}
        left = {e: [s, d] for e, s, d in endings}
        counted = dict(lexicon)
        for t in named:
            if t in counted:
                left[t[-2:]][0] -= counted[t]
                left[t[-2:]][1] -= 1
        common = sorted(left, key=lambda e: (-left[e][0], e))[:groups - 1]
        self.groups = {e: len(named) + i for i, e in enumerate(common)}
        self.other = len(named) + len(common)
        self.size = self.other + 1
        total, distinct = np.zeros(self.size), np.zeros(self.size)
        for e, (s, d) in left.items():
            total[self.groups.get(e, self.other)] += s
            distinct[self.groups.get(e, self.other)] += d
        #: log10 of the denominator of shares; 0 where the symbol is one word.
        self.share = np.log10(total + SMOOTH * (distinct + 1))
        self.share[:len(named)] = 0
        self.sums = total
        for t, i in self.named.items():
            self.sums[i] = counted.get(t, 0)

    def of(self, token):
        found = self.named.get(token)
        return self.groups.get(token[-2:], self.other) if found is None else found

    def table(self):
        """({token: place in the lexicon}, symbol of each lexicon token and one more)."""
        return ({t: i for i, t in enumerate(self.tokens)},
                np.array([self.of(t) for t in self.tokens] + [0], np.int64))


def contexts(symbols, ends):
    """The two symbols before each; before a text both are END (symbol 0). ``ends``: last places."""
    first = np.zeros_like(symbols)
    second = np.zeros_like(symbols)
    first[1:] = symbols[:-1]
    second[2:] = symbols[:-2]
    begins = ends[:-1] + 1
    first[begins] = 0
    second[begins] = 0
    later = begins + 1
    second[later[later < len(symbols)]] = 0
    return first, second


def _order(places):
    """What sorts places under 2 ** 32: numpy has a fast stable sort of 16 bits only."""
    order = np.argsort(places.astype(np.uint16), kind="stable")
    high = places >> 16
    if high.any():
        order = order[np.argsort(high[order].astype(np.uint16), kind="stable")]
    return order


#: Chances of a node's children as noise are multiples of 1 / SLOTS.
SLOTS = 4 * FAN


def _noise(share):
    """(child of each slot of a parent, log of each node's chance among its siblings)."""
    parents = -(-len(share) >> FAN_BITS) if len(share) > 1 else 1
    padded = np.zeros(parents * FAN)
    padded[:len(share)] = share
    padded = padded.reshape(parents, FAN)
    children = (np.arange(parents * FAN) < len(share)).reshape(parents, FAN)
    # One slot for each child; the others follow the shares.
    free = SLOTS - children.sum(1)
    ends = np.cumsum(padded, 1)
    ends = np.rint(ends / ends[:, -1:] * free[:, None]) + np.cumsum(children, 1)
    slots = np.diff(ends, axis=1, prepend=0).astype(np.int64)
    table = np.repeat(np.arange(parents * FAN), slots.ravel()).reshape(parents, SLOTS)
    return table.astype(np.int32), np.log(np.maximum(slots, 1) / SLOTS).ravel().astype(np.float32)


def _whole(rows):
    """Rows as single values, which numpy puts at places much faster than numbers of rows."""
    return rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1])))[:, 0]


def _summed(places, factors, rows, owner, few=10):
    """(distinct places, the sum of factor times row ``owner`` at each); most come once or twice."""
    order = _order(places)
    ordered, factors, owner = places[order], factors[order], owner[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(starts, len(order)))
    # The most frequent first, so that those with one more are always the first of the others.
    by = np.argsort(-np.minimum(sizes, few + 1).astype(np.int16), kind="stable")
    starts, sizes = starts[by], sizes[by]
    many = int((sizes > few).sum())
    out = np.empty((len(starts), rows.shape[1]), np.float32)
    for i, (a, n) in enumerate(zip(starts[:many].tolist(), sizes[:many].tolist())):
        out[i] = factors[a:a + n] @ rows.take(owner[a:a + n], axis=0)
    for i in range(few):
        at = starts[many:many + int((sizes[many:] > i).sum())] + i
        part = rows.take(owner[at], axis=0)
        part *= factors[at][:, None]
        if i:
            out[many:many + len(at)] += part
        else:
            out[many:] = part
    return ordered[starts], out


class LogBilinear:
    """Logit of w after (first, second): (R[first] C1 + R[second] C2) . T[w] + bias[w].

    ``depths`` holds T, with the bias as its last column, of the nodes of each depth of the tree,
    the last those of the symbols; a symbol's node is the symbol shifted by the depth's bits.
    """

    def __init__(self, size, dim, noise, seed=11):
        rng = np.random.default_rng(seed)
        levels = 1
        while size > 1 << FAN_BITS * levels:
            levels += 1
        self.size, self.shifts = size, [FAN_BITS * i for i in range(levels)][::-1]
        self.noise, self.depths = [], []
        for shift in self.shifts:
            cuts = np.arange(0, size, 1 << shift)
            share = np.add.reduceat(np.asarray(noise, float) + 1, cuts)
            self.noise.append(share)
            among = np.add.reduceat(share, np.arange(0, len(share), FAN))
            vectors = rng.normal(0, 0.1, (len(cuts), dim + 1)).astype(np.float32)
            vectors[:, -1] = np.log(share / among[np.arange(len(share)) >> FAN_BITS])
            self.depths.append(vectors)
        self.r = rng.normal(0, 0.3, (size, dim)).astype(np.float32)
        self.c = [(np.eye(dim) * x).astype(np.float32) for x in (0.7, 0.4)]

    def learner(self):
        """Sets up what only training needs: sums of squares, and how often a row was moved."""
        self.square = [np.full(len(w), 1e-3, np.float32) for w in self.moved()]
        self.times = [np.zeros(len(w), np.float32) for w in self.moved()]
        self.drawn = [_noise(share) for share in self.noise]

    def moved(self):
        return [self.r, *self.c, *self.depths]

    def _move(self, which, places, g, n, rate):
        """An Adagrad step of the named rows, with one sum of squares a row."""
        w, square = self.moved()[which], self.square[which]
        squares = square[places] + np.vecdot(g, g) / np.float32(n * g.shape[1])
        square[places] = squares
        g *= (rate / np.float32(n ** 0.5) / np.sqrt(squares))[:, None]
        g += w.take(places, axis=0)
        _whole(w)[places] = _whole(g)
        self.times[which][places] += 1

    def step(self, first, second, target, rng, noises=5, rate=0.12):
        """One step of noise-contrastive estimation at each depth, with siblings as the noise.

        Few parents see the expected noise of all their children, many parents drawn noise.
        """
        if not hasattr(self, "square"):
            self.learner()
        (c1, c2), n, rate = self.c, len(target), np.float32(rate)
        r1, r2 = self.r.take(first, axis=0), self.r.take(second, axis=0)
        q = np.ones((n, len(c1) + 1), np.float32)
        q[:, :-1] = r1 @ c1 + r2 @ c2
        dq = np.zeros_like(q)
        for i, (shift, t, (table, chance)) in enumerate(zip(self.shifts, self.depths, self.drawn)):
            if len(table) <= FAN:
                self._move(3 + i, *self._expected(i, target >> shift, q, dq, noises), n, rate)
                continue
            places = np.empty((n, 1 + noises), np.int64)
            places[:, 0] = target >> shift
            places[:, 1:] = table.ravel().take((places[:, :1] >> FAN_BITS) * SLOTS
                                               + rng.integers(0, SLOTS, (n, noises)))
            places = places.ravel()
            rows = t.take(places, axis=0).reshape(n, 1 + noises, -1)
            odds = np.einsum("nkd,nd->nk", rows, q)
            odds -= chance.take(places).reshape(odds.shape) + np.float32(math.log(noises))
            back = -1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            back[:, 0] += 1
            dq += np.einsum("nk,nkd->nd", back, rows)
            self._move(3 + i, *_summed(places, back.ravel(), q,
                                       np.repeat(np.arange(n), 1 + noises)), n, rate)
        dq = dq[:, :-1]
        self._move(0, *_summed(np.concatenate([first, second]), np.ones(2 * n, np.float32),
                               np.concatenate([dq @ c1.T, dq @ c2.T]), np.arange(2 * n)), n, rate)
        for i, r in ((1, r1), (2, r2)):
            self._move(i, np.arange(len(c1)), r.T @ dq, n, rate)

    def _expected(self, i, node, q, dq, noises):
        """Gradient of one depth with few parents: of all siblings, for the expected noise."""
        t, chance = self.depths[i], self.drawn[i][1][:len(self.depths[i])]
        order = _order(node)
        node = node[order]
        parent = node >> FAN_BITS
        starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        runs = list(zip(starts.tolist(), [*starts[1:].tolist(), len(node)],
                        (parent[starts] << FAN_BITS).tolist()))
        mine = q.take(order, axis=0)
        # Chances of all children to be noise, from the negative odds.
        against = -t
        against[:, -1] += chance + np.float32(math.log(noises))
        back = np.zeros((len(node), min(FAN, len(t))), np.float32)
        for a, b, base in runs:
            some = against[base:base + FAN]
            np.matmul(mine[a:b], some.T, out=back[a:b, :len(some)])
        for a in range(0, len(node), 512):
            x = back[a:a + 512]
            np.minimum(x, 30, out=x)
            np.exp(x, out=x)
            x += 1
            np.reciprocal(x, out=x)
        # The gradient of the odds is -weight * back, and 1 - chance more for the child that is.
        weight = noises * np.exp(chance)
        own = (np.arange(len(node)), node & (FAN - 1))
        real = back[own]
        back[own] = real - (1 - real) / weight[node]
        weighted = t * -weight[:, None]
        ways = np.empty_like(mine)
        places, sums = [], []
        for a, b, base in runs:
            some = weighted[base:base + FAN]
            x = back[a:b, :len(some)]
            np.matmul(x, some, out=ways[a:b])
            places.append(np.arange(base, base + len(some)))
            sums.append(x.T @ mine[a:b])
        again = np.empty_like(order)
        again[order] = np.arange(len(order))
        dq += ways.take(again, axis=0)
        places = np.concatenate(places)
        return places, np.concatenate(sums) * -weight[places][:, None]

    def tables(self):
        """(first part, second part + bias, log normaliser) of all logits of one depth, base e."""
        (c1, c2), t = self.c, self.depths[0]
        a = (self.r @ c1) @ t[:, :-1].T
        b = (self.r @ c2) @ t[:, :-1].T + t[:, -1]
        high_a, high_b = a.max(1), b.max(1)
        product = np.exp(a - high_a[:, None]) @ np.exp(b - high_b[:, None]).T
        z = np.log(np.maximum(product, 1e-300)) + high_a[:, None] + high_b[None, :]
        return a.astype(np.float32), b.astype(np.float32), z.astype(np.float32)

    def ready(self):
        """Sets up what scoring needs: the two parts of every context."""
        self.parts = [self.r @ c for c in self.c]

    def logs(self, first, second, target, block=1 << 16):
        """Log probability, base e, of each target after its context, over all symbols."""
        out = np.empty(len(target))
        for low in range(0, len(target), block):
            at = slice(low, low + block)
            out[at] = self._logs(first[at], second[at], target[at])
        return out

    def _logs(self, first, second, target):
        order = _order(target)
        target = target[order]
        q = np.ones((len(target), self.parts[0].shape[1] + 1), np.float32)
        np.add(self.parts[0].take(first[order], axis=0), self.parts[1].take(second[order], axis=0),
               out=q[:, :-1])
        total, logits = np.zeros(len(target)), np.empty((len(target), FAN), np.float32)
        powers, ones = np.empty((1024, FAN), np.float32), np.ones(FAN, np.float32)
        for shift, t in zip(self.shifts, self.depths):
            node = target >> shift
            parent = node >> FAN_BITS
            starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            for a, b, base in zip(starts.tolist(), [*starts[1:].tolist(), len(target)],
                                  (parent[starts] << FAN_BITS).tolist()):
                some = t[base:base + FAN]
                np.matmul(q[a:b], some.T, out=logits[a:b, :len(some)])
                if len(some) < FAN:
                    logits[a:b, len(some):] = -np.inf
            for a in range(0, len(target), 1024):
                x = logits[a:a + 1024]
                e = powers[:len(x)]
                if x.max() > 60 or (np.exp(x, out=e) @ ones).min() < 1e-25:
                    x -= x.max(1)[:, None]
                    np.exp(x, out=e)
                total[a:a + 1024] += (x[np.arange(len(x)), node[a:a + 1024] & (FAN - 1)]
                                      - np.log(e @ ones))
        out = np.empty(len(target))
        out[order] = total
        return out


#: Rows of a model that travel together.
BLOCK_ROWS = 1024
PARTS = "which int, block int, places binary, times binary, value binary"


def _parts(net, start):
    """How far this task moved which rows, by blocks, and how often it did."""
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          ["which", "block", "places", "times", "value"])

    out = []
    for which, (w, old, times) in enumerate(zip(net.moved(), start, net.times)):
        at = np.flatnonzero(times)
        cuts = np.flatnonzero(np.append(True, at[1:] // BLOCK_ROWS != at[:-1] // BLOCK_ROWS))
        for a, b in zip(cuts, [*cuts[1:], len(at)]):
            some = at[a:b]
            if len(some):
                out.append((which, int(some[0]) // BLOCK_ROWS, some.astype(np.int32).tobytes(),
                            times[some].tobytes(),
                            (w[some] - old[some]).astype(np.float16).tobytes()))
            if len(out) == 64:
                yield batch(out)
                out = []
    if out:
        yield batch(out)


def _mean(table):
    """The mean way of a block's rows, over the tasks that moved them, weighted by how often."""
    sums, weights = np.zeros(0), np.zeros(BLOCK_ROWS)
    base = table.column("block")[0].as_py() * BLOCK_ROWS
    # In the order of their bytes, however they arrived.
    for places, times, value in sorted(zip(*(table.column(c).to_pylist()
                                             for c in ("places", "times", "value")))):
        at = np.frombuffer(places, np.int32) - base
        times = np.frombuffer(times, np.float32).astype(float)
        value = np.frombuffer(value, np.float16).reshape(len(at), -1)
        if not sums.size:
            sums = np.zeros((BLOCK_ROWS, value.shape[1]))
        sums[at] += value * times[:, None]
        weights[at] += times
    at = np.flatnonzero(weights)
    mean = (sums[at] / weights[at, None]).astype(np.float16)
    return pa.table([table.column("which")[:1], table.column("block")[:1],
                     pa.array([(at + base).astype(np.int32).tobytes()]),
                     pa.array([weights[at].astype(np.float32).tobytes()]),
                     pa.array([mean.tobytes()])], ["which", "block", "places", "times", "value"])


def _symbols_of(tokens, lexicon, symbol, symbols):
    """Lexicon places (-1: none) and symbols of distinct tokens."""
    places = np.fromiter((lexicon.get(t, -1) for t in tokens), np.int64, len(tokens))
    out = symbol[places]
    for i in np.flatnonzero(places < 0).tolist():
        out[i] = symbols.of(tokens[i])
    return places, out


def _plan(total, task_tokens, replicas):
    """(rounds, tasks of each): so many that a task learns from about ``task_tokens`` tokens."""
    rounds = max(1, math.ceil(math.log2(max(1, total / task_tokens))),
                 math.ceil(total / task_tokens / replicas))
    return rounds, max(1, math.ceil(total / task_tokens / rounds))


def _train(shared, start, batch_tokens):
    def run(batches):
        net = None
        count, held = 0, []

        def learn():
            first, second, target = (np.concatenate(x) for x in zip(*held))
            order = rng.permutation(len(target))
            for low in range(0, len(order), batch_tokens):
                at = order[low:low + batch_tokens]
                net.step(first[at], second[at], target[at], rng)

        for batch in batches:
            for tokens, flat, ends in tokens_of(batch.column("text")):
                if net is None:
                    symbols, net = opened(shared), opened(start)
                    lexicon, symbol = symbols.table()
                    net.learner()
                    before = [w.copy() for w in net.moved()]
                    rng = np.random.default_rng(5)
                found = _symbols_of(tokens, lexicon, symbol, symbols)[1][flat]
                held.append((*contexts(found, ends), found))
                count += len(found)
                if count >= 64 * batch_tokens:
                    learn()
                    count, held = 0, []
        if held:
            learn()
        if net is not None:
            yield from _parts(net, before)
    return run


def _score(shared, fitted):
    def run(batches):
        symbols, (net, total, distinct) = opened(shared), opened(fitted)
        lexicon, symbol = symbols.table()
        net.ready()
        del net.r  # only its two parts are needed
        base_of = math.log10(total + SMOOTH * (distinct + 1))
        logs = np.append(np.log10(symbols.counts + SMOOTH), 0.0)
        known = np.append(symbols.counts > 0, False)
        one_word = np.arange(symbols.size) < len(symbols.named)
        part, row_number = TaskContext.get().partitionId(), 0
        for batch in batches:
            n, n_known, base, score, outside_of = [], [], [], [], []
            for tokens, flat, ends in tokens_of(batch.column("text")):
                places, found = (x[flat] for x in _symbols_of(tokens, lexicon, symbol, symbols))
                outside = np.flatnonzero(places < 0)
                first, second = contexts(found, ends)
                seen = logs[places]
                model = net.logs(first, second, found) / math.log(10)
                model = model + np.where(one_word[found], 0, seen - symbols.share[found])
                starts = np.append(0, ends[:-1] + 1)
                size = ends + 1 - starts
                n.append(size)
                n_known.append(np.add.reduceat(known[places].astype(np.int64), starts))
                base.append(np.add.reduceat(seen, starts) - size * base_of)
                score.append(np.add.reduceat(model, starts))
                cuts = np.searchsorted(outside, np.append(starts, len(flat))).tolist()
                names = [tokens[i] for i in flat[outside].tolist()]
                outside_of += [names[x:y] for x, y in zip(cuts[:-1], cuts[1:])]
            rows = len(batch.column("text"))
            key = (part << 40) + row_number + np.arange(rows)
            row_number += rows
            joined = [np.concatenate(x) if x else np.zeros(0) for x in (n, n_known, base, score)]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(key, pa.int64()),
                 *[pa.array(x, k) for x, k in zip(joined, [pa.int64()] * 2 + [pa.float64()] * 2)],
                 list_array([t for x in outside_of for t in x], [len(x) for x in outside_of],
                            pa.binary())],
                [*kept, "row", "n_tokens", "n_known", "base_score", "score", "outside"])
    return run


def score_texts(documents: DataFrame, id="doc_id", text="text", folds=10, held_fold=0, words=None,
                groups=128, dim=32, lexicon=200_000, batch_tokens=4096, replicas=1024,
                task_tokens=4_000_000
                ) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A text's tokens are its words (A-Z lower-cased) and one end. Counts, and the model, come
    from all whole texts whose crc32 of the id, mod ``folds``, is not ``held_fold``.
    ``base_score`` is the log10 probability by smoothed counts, ``score`` that by the model.

    NULL and empty texts are one end token. A row of NULL id counts as one of empty id. Equal
    rows are scored, and learnt from, each. Without training texts both scores are 0 per token.
    Long texts are whole; they only share slices with fewer others.

    Words are counted before the shuffle. The ``lexicon`` most frequent words, at most, are
    broadcast; the few tokens beyond are joined with their counts, and as none of those is
    frequent, no key is hot. The model has vectors for all words of the lexicon (or the ``words``
    most frequent), and one each for the ``groups`` endings of the words beyond. Texts are
    dealt by the hash of id and text to rounds, whose number grows with the logarithm of the
    training tokens, and to at most ``replicas`` tasks of a round, of about ``task_tokens`` tokens
    each; how the input lies in files does not matter. A round starts from the means of the last.
    Each row of the model goes the mean way of the tasks that moved it, weighted by how often.
    Tasks tell those ways in half precision, which at ``task_tokens`` is less than their text.
    """
    spark = documents.sparkSession
    kind = dict(documents.dtypes)[id]
    docs = documents.select(F.col(f"`{id}`").alias("id"),
                            F.col(f"`{text}`").cast("string").alias("text"))
    held = F.pmod(crc32_of("id"), F.lit(folds)) == held_fold
    train = docs.where(~held)
    counts = written(train.select("text").mapInArrow(_count(1_000_000), "token binary, n long")
                     .groupBy("token").agg(F.sum("n").alias("n")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Words of a count, in steps of a sixteenth of a power of two: how many are frequent enough.
    step = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    least, sum_so_far = math.inf, 0
    for at, n in sorted(sizes, reverse=True):
        sum_so_far += n
        if sum_so_far > lexicon:
            break
        least = at
    frequent = counts.where(step >= (least if sizes else 0)) if least < math.inf else counts.limit(0)
    frequent = frequent.select("token", "n").toArrow().sort_by(
        [("n", "descending"), ("token", "ascending")])
    frequent = list(zip(frequent["token"].to_pylist(), frequent["n"].to_pylist()))
    endings = [(bytes(e), s, d) for e, s, d in counts.groupBy(
        F.substring("token", -2, 2).alias("e")).agg(F.sum("n"), F.count("*")).collect()]
    symbols = Symbols(frequent, endings, words, groups)
    shared = broadcast(spark, symbols)
    net = LogBilinear(symbols.size, dim, symbols.sums)
    del frequent, symbols  # the driver holds nothing but the model while tasks learn
    if total:
        rounds, tasks = _plan(total, task_tokens, replicas)
        slot = F.xxhash64("id", "text")
        for i in range(rounds):
            start = broadcast(spark, net)
            some = train.where(F.pmod(slot, F.lit(rounds)) == i).select(
                "text", F.pmod(F.floor(slot / rounds), F.lit(tasks)).alias("task"), slot.alias("slot"))
            # A partition for each task, which adaptive execution doesn't merge; the texts of a
            # task in the order of their hashes, however they arrived.
            moved = (some.repartitionById(tasks, F.col("task").cast("int"))
                     .sortWithinPartitions("slot").select("text")
                     .mapInArrow(_train(shared, start, batch_tokens), PARTS))
            # Arrow batches pass the driver's JVM as tasks end, rows would all be there at once.
            moved = moved.groupBy("which", "block").applyInArrow(_mean, PARTS).toArrow()
            for which, places, value in zip(*(moved[c] for c in ("which", "places", "value"))):
                at = np.frombuffer(places.as_buffer(), np.int32)
                net.moved()[which.as_py()][at] += np.frombuffer(
                    value.as_buffer(), np.float16).reshape(len(at), -1)
            del moved
            start.destroy()  # in the driver too, which would keep the model of every round
    parts = written(docs.withColumn("held_out", held).mapInArrow(
        _score(shared, broadcast(spark, (net, total, distinct))),
        f"id {kind}, held_out boolean, row long, n_tokens long, n_known long, "
        "base_score double, score double, outside array<binary>"), "scored")
    seen = F.coalesce("n", F.lit(0))
    rest = (parts.select("row", F.explode("outside").alias("token"))
            .join(counts, "token", "left").groupBy("row")
            .agg(F.sum(F.log10(seen + SMOOTH)).alias("more"), F.sum((seen > 0).cast("long"))
                 .alias("more_known")))
    more = F.coalesce("more", F.lit(0.0))
    return parts.drop("outside").join(rest, "row", "left").select(
        F.col("id").alias(id), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))
