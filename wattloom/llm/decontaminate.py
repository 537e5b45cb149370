"""Benchmark decontamination: Wu-Manber search for windows of consecutive words.

Words are the alphabet, hashed to 64 bits. A table over blocks of two words tells how far a
search may skip; blocks that end a window lead to the bucket of windows with that ending, and
the words of a bucket's windows are compared one by one, at last as bytes.
"""

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import (WordHasher, broadcast, list_array, lower_map, opened,
                                 text_chunks, word_spans, written)

#: ASCII bytes that are neither digits nor letters part words; bytes over 0x7F never do.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
LOWER = lower_map(SEPARATORS)
#: Each lane searches this many words of a slice, all lanes of a slice at once.
LANE = 64
U64 = np.uint64


def words_of(text: str) -> list[bytes]:
    return (text or "").encode().translate(LOWER.tobytes()).replace(b"\0", b" ").split(b" ")


class Patterns:
    """Shift table and suffix buckets of all windows of one length."""

    def __init__(self, length, windows):
        #: windows: {tuple of words: set of item ids}
        self.length = length
        self.block = min(2, length)
        self.words = list(windows)
        self.items = [sorted(windows[w]) for w in self.words]
        joined = b"\0".join(b"\0".join(w) for w in self.words)
        raw = np.frombuffer(joined, np.uint8)
        starts, ends = word_spans(raw, np.array([0, len(raw)]))
        hashes = WordHasher()(raw, starts, ends).reshape(len(self.words), length)
        bits = max(10, int(np.ceil(np.log2(8 * hashes.size))))
        self.drop = U64(64 - bits)
        self.shift = np.full(1 << bits, length - self.block + 1, np.int64)
        for end in range(self.block, length + 1):
            cells = self.blocks(hashes[:, end - self.block], hashes[:, end - 1]) >> self.drop
            np.minimum.at(self.shift, cells, length - end)
        suffix = self.blocks(hashes[:, length - self.block], hashes[:, length - 1])
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.order, self.hashes = suffix[order], order, hashes

    def blocks(self, first, last):
        return (first * U64(0xFF51AFD7ED558CCD) + last) * U64(0xC4CEB9FE1A85EC53)

    def ends(self, h):
        """Places whose block may end a window, found by skipping."""
        n = len(h)
        at = np.arange(0, n, LANE)
        stop = np.minimum(at + LANE, n)
        at = np.maximum(at, self.length - 1)
        found = []
        while True:
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
            if not len(at):
                break
            skip = self.shift[self.blocks(h[at - self.block + 1], h[at]) >> self.drop]
            found.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def search(self, h, first_of_text, word_at):
        """(end, window) pairs of occurrences in the words hashed in ``h``."""
        ends = self.ends(h)
        ends = ends[ends - self.length + 1 >= first_of_text[ends]]
        suffix = self.blocks(h[ends - self.block + 1], h[ends])
        low = np.searchsorted(self.suffix, suffix, "left")
        many = np.searchsorted(self.suffix, suffix, "right") - low
        ends = np.repeat(ends, many)
        within = np.arange(len(ends)) - np.repeat(np.cumsum(many) - many, many)
        window = self.order[np.repeat(low, many) + within]
        for back in range(self.length):
            if not len(ends):
                break
            same = h[ends - back] == self.hashes[window, self.length - 1 - back]
            ends, window = ends[same], window[same]
        same = np.fromiter((all(word_at(e - self.length + 1 + i) == w
                                for i, w in enumerate(self.words[p]))
                            for e, p in zip(ends.tolist(), window.tolist())), bool, len(ends))
        return ends[same], window[same]


def build_patterns(rows, window) -> list[Patterns]:
    """One table per window length from (item id, text) rows; items without words have none."""
    by_length = defaultdict(lambda: defaultdict(set))
    for item, text in rows:
        words = [w for w in words_of(text) if w]
        length = min(window, len(words))
        for i in range(len(words) - length + 1 if length else 0):
            found = by_length[length][tuple(words[i:i + length])]
            if item is not None:
                found.add(str(item))
    return [Patterns(length, windows) for length, windows in sorted(by_length.items())]


def _pass(shared, resumed, text, dropped):
    def run(batches):
        patterns, hasher = opened(shared), WordHasher()
        for batch in batches:
            counts, spans, items = [], [], []
            old = batch.column("spans").to_pylist() if resumed else None
            old_items = batch.column("items").to_pylist() if resumed else None
            for row, raw, offsets in text_chunks(batch.column(text)):
                mapped = LOWER[raw]
                starts, ends = word_spans(mapped, offsets)
                h = hasher(mapped, starts, ends)
                bounds = np.searchsorted(starts, offsets)
                text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
                cover = np.zeros(len(h) + 1, np.int32)
                found = defaultdict(set)
                for p in patterns:
                    at, which = p.search(
                        h, bounds[text_of],
                        lambda i: mapped[starts[i]:ends[i]].tobytes())
                    np.add.at(cover, at - p.length + 1, 1)
                    np.add.at(cover, at + 1, -1)
                    for t, w in set(zip(text_of[at].tolist(), which.tolist())):
                        found[t].update(p.items[w])
                covered = np.cumsum(cover[:-1]) > 0
                for t in range(len(offsets) - 1):
                    here = covered[bounds[t]:bounds[t + 1]].copy()
                    names = found.get(t, set())
                    if resumed:
                        flat = old[row + t]
                        for a, b in zip(flat[::2], flat[1::2]):
                            here[a:b] = True
                        names = names | set(old_items[row + t])
                    counts.append(len(here))
                    items.append(sorted(names))
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], here, [0]))))
                    spans.append(edges.tolist() if here.any() else [])
            names = [n for n in batch.schema.names if n not in dropped]
            columns = [batch.column(n) for n in names]
            if not resumed:
                columns.append(pa.array(counts, pa.int64()))
                names.append("n_words")
            yield pa.RecordBatch.from_arrays(
                [*columns, list_array(sum(spans, []), [len(s) for s in spans], pa.int32()),
                 list_array([i for x in items for i in x], [len(x) for x in items], pa.string())],
                [*names, "spans", "items"])
    return run


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, id="doc_id", text="text",
                   item="item_id", item_text="text", window=13, keep=(),
                   block_bytes=16 << 20) -> DataFrame:
    """For every document: ``id``, ``keep``, n_words, spans and items.

    ``spans`` is a flat array of word positions (start, end, start, ...), merged, end exclusive,
    of words inside any occurrence of an item's window; ``items`` the ids of such items, as text,
    sorted. A window is ``window`` consecutive words of an item, or all words of a shorter one.

    NULL or empty texts have no words and no hits; items without words have no windows; items
    with NULL id are searched but not listed; repeated rows are judged one by one; without items
    nothing is hit. Long texts are searched whole. The items are searched in blocks of about
    ``block_bytes`` of text, measured first, so what is broadcast is bounded; each further block
    is one more pass over the documents with the hits so far, and no row is ever joined.
    """
    spark = documents.sparkSession
    entries = benchmark.select(F.col(item).cast("string").alias("item"),
                               F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t"))
    size = entries.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    kinds = dict(documents.dtypes)
    kept = [id, *keep]
    if {"n_words", "spans", "items"} & {k.lower() for k in (*kept, text)}:
        raise ValueError("no column read may be called n_words, spans or items")
    carried = list(dict.fromkeys([*kept, text]))
    state = documents.select(*carried)
    for block in range(blocks):
        part = entries.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == block)
        patterns = build_patterns(part.toLocalIterator(), window)
        if block:
            state = written(state, "decontaminate")
        names = carried if block < blocks - 1 else kept
        left = ", ".join(f"`{k}` {kinds[k]}" for k in names)
        state = state.mapInArrow(
            _pass(broadcast(spark, patterns), block > 0, text,
                  {"spans", "items", *carried} - set(names)),
            f"{left}, n_words long, spans array<int>, items array<string>")
    return state


def n_hit(spans="spans"):
    """Words inside the spans: the sum of ends less the sum of starts."""
    return F.aggregate(F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(words, hit, percent=5):
    """A document is contaminated if words were hit, and at least ``percent`` of its words."""
    return (hit > 0) & (hit * 100 >= words * percent)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, text="text", **options
                      ) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with all their columns.

    Each row is judged by its own text, without a join. Names of its columns do not matter.
    """
    kept = {f"c{i}": c for i, c in enumerate(documents.columns)}
    plain = documents.select(*[F.col(f"`{c}`").alias(k) for k, c in kept.items()])
    searched = next(k for k, c in kept.items() if c == text)
    judged = benchmark_hits(plain, benchmark, id="c0", text=searched, keep=list(kept)[1:],
                            **options)
    clean = judged.where(~contaminated(F.col("n_words"), n_hit()))
    return clean.select(*[F.col(k).alias(c) for k, c in kept.items()])
