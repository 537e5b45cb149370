"""Suffix-array dedup: bytes covered by a long string that also starts anywhere else.

Every string of ``length`` bytes is assigned to its anchor, the 64-byte gram in it of the
smallest hash (the leftmost of equals), so equal strings have equal anchors at equal offsets.
Successive strings with one anchor form a block. Equal strings lie in blocks of one anchor;
blocks that occur twice are repeated as a whole, and the different blocks of an anchor meet in a
shard whose suffix array, by induced sorting, and permuted common prefixes show what they share.

An anchor whose different blocks would overfill a shard is split. A string has ``length - 64``
bytes beside the anchor, so it has either many on its left or many on its right. The strings of
a block with many on the left hold the same bytes there as any equal string, and those bytes
name a smaller group; likewise on the right. Groups that still overfill a shard are halved
again, and what has become equal in halving is counted as one.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import WordHasher, list_array, mix64, text_chunks, written
from wattloom.llm.suffix_array import repeated

U64 = np.uint64
GRAM = 64
#: Bytes of blocks in one suffix array.
SHARD = 1 << 19
#: Different blocks of a group up to which they go to one shard, which they then about fill; the
#: groups of more are split.
CROWD = 600
#: Ranges of places by which a shard's strings are looked over before they are sorted.
RANGES = 8


class Roller:
    """Hashes of all substrings of a slice from running sums."""

    def __init__(self, hasher, raw):
        up, self.down = hasher.powers(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, U64)
        np.cumsum((raw.astype(U64) + U64(1)) * up[:len(raw)], out=self.total[1:])

    def __call__(self, start, end):
        return mix64((self.total[end] - self.total[start]) * self.down[start]
                     + (np.asarray(end) - start).astype(U64))


def sliding_argmin(values, width):
    """Place of the smallest value, the leftmost of equals, of every ``width`` successive ones.

    Compares the upper 33 bits of values, then places.
    """
    n = len(values) - width + 1
    packed = (values & ~U64((1 << 31) - 1)) | np.arange(len(values), dtype=U64)
    rows = -(-len(values) // width)
    padded = np.full(rows * width, ~U64(0))
    padded[:len(values)] = packed
    padded = padded.reshape(rows, width)
    left = np.minimum.accumulate(padded, 1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    best = np.minimum(right[:n], left[width - 1:width - 1 + n])
    return (best & U64((1 << 31) - 1)).astype(np.int64)


def blocks_of(hasher, raw, offsets, length):
    """(row, first start, number of strings, anchor's place, anchor, block hash) of every block."""
    if len(raw) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, U64),) * 2
    roll = Roller(hasher, raw)
    at = np.arange(len(raw) - GRAM + 1)
    grams = roll(at, at + GRAM)
    anchor = sliding_argmin(grams, length - GRAM + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(anchor)]
    whole = np.arange(len(anchor)) + length <= offsets[row + 1]
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    stops = whole.copy()
    stops[:-1] &= ~whole[1:] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    name = roll(start, stop - 1 + length) ^ mix64((anchor[start] - start).astype(U64))
    place = anchor[start] - start
    return row[start], start - offsets[row[start]], stop - start, place, grams[anchor[start]], name


def _blocks(length):
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for first, raw, offsets in text_chunks(batch.column("text")):
                row, start, many, place, anchor, name = blocks_of(hasher, raw, offsets, length)
                taken = pa.array(first + row)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(taken) for c in ("id", "k1", "k2")],
                     pa.array(anchor.view(np.int64)), pa.array(name.view(np.int64)),
                     pa.array(start, pa.int32()), pa.array(many, pa.int32()),
                     pa.array(place, pa.int32())],
                    ["id", "k1", "k2", "anchor", "block", "start", "many", "place"])
    return run


def _runs(flags):
    """Flat (start, end, ...) of runs of true flags."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))


SHOWN = ["grp", "part", "place", "low", "high", "bytes"]
SPANS = ["grp", "part", "spans"]


def _open(hasher, held, length):
    """(part, first string, bytes) of what of a shard's parts may be repeated.

    Equal strings of a group have equal bytes on the anchor's left. Strings with ``a`` to ``b`` of
    those share what all of them cover, so where nothing else covers the same, none is repeated.
    """
    group, place, low, high, size = (np.array(x, np.int64) for x in zip(*(
        (h[0], h[2], h[3], h[4], len(h[5])) for h in held)))
    roll = Roller(hasher, np.frombuffer(b"".join(h[5] for h in held), np.uint8))
    anchor = np.cumsum(size) - size + place
    least, most = np.maximum(low, place + length - size), np.minimum(high, place)
    start, stop = most + 1, least - 1
    for i in range(RANGES):
        a = low + (high - low + 1) * i // RANGES
        b = low + (high - low + 1) * (i + 1) // RANGES - 1
        lower, upper = np.maximum(a, least), np.minimum(b, most)
        some = np.flatnonzero(lower <= upper)
        common = roll(anchor[some] - a[some], anchor[some] - b[some] + length)
        _, kind, copies = np.unique(common ^ mix64(group[some].view(U64)), return_inverse=True,
                                    return_counts=True)
        some = some[copies[kind] > 1]
        start[some] = np.minimum(start[some], lower[some])
        stop[some] = np.maximum(stop[some], upper[some])
    for i in np.flatnonzero(start <= stop).tolist():
        first = int(place[i] - stop[i])
        yield i, first, held[i][5][first:int(place[i] - start[i]) + length]


def _shards(length):
    """The starts of repeated strings of each part, from shards of whole groups."""
    hasher = WordHasher()

    def solve(held):
        some = list(_open(hasher, held, length))
        found = repeated([t for *_, t in some], length) if some else []
        spans = [_runs(f) + first for f, (_, first, _) in zip(found, some)]
        keep = [(held[i], s) for (i, _, _), s in zip(some, spans) if len(s)]
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h, _ in keep], pa.int64()),
             pa.array([h[1] for h, _ in keep], pa.int64()),
             list_array(np.concatenate([s for _, s in keep]) if keep else [],
                        [len(s) for _, s in keep], pa.int32())], SPANS)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in SHOWN)):
                if held and held[-1][:2] == row[:2]:
                    continue  # fetched from another row of equal id and text
                if size >= SHARD and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield solve(held)
    return run


#: A part of a block: its strings from ``shift`` on. ``place`` is the anchor's in ``bytes``; its
#: group's strings have ``low`` to ``high`` bytes on the anchor's left.
PARTS = ("anchor long, block long, grp long, part long, shift int, place int, low int, high int, "
         "bytes binary")


def _halves(length):
    """The two halves of every part, by the bytes on the anchor's left."""
    def halved(hasher, batch):
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        out = []
        for anchor, block, group, _, shift, place, low, high, data in zip(*columns):
            raw = np.frombuffer(data, np.uint8)
            roll = Roller(hasher, raw)
            middle = (low + high + 1) // 2
            for side, (a, b) in enumerate(((low, middle - 1), (middle, high))):
                # Strings of the half: their starts are the anchor's place less what is left of it.
                first = max(0, place - b)
                last = min(len(raw) - length, place - a)
                if first > last or a > b:
                    continue
                common = roll(place - a, place - b + length)
                whole = roll(first, last + length)
                group_of = mix64(mix64(U64(group & 0xFFFFFFFFFFFFFFFF) + U64(side)) ^ common)
                out.append((anchor, block, int(group_of.view(np.int64)),
                            int((whole ^ mix64(U64(place - first))).view(np.int64)),
                            shift + first, place - first, a, b,
                            raw[first:last + length].tobytes()))
        return out

    def run(batches):
        hasher = WordHasher()
        kinds = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()]
        names = [c.split()[0] for c in PARTS.split(", ")]
        for batch in batches:
            for low in range(0, len(batch), 1024):
                with np.errstate(over="ignore"):
                    rows = halved(hasher, batch.slice(low, 1024))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    return run


def _cut(length):
    def run(batches):
        for batch in batches:
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            all_spans, kept = [], []
            for text, starts, spans in zip(texts, batch.column("starts").to_pylist(),
                                           batch.column("repeats").to_pylist()):
                covered = np.zeros(len(text) + 1, np.int32)
                for start, flat in zip(starts or (), spans or ()):
                    flat = np.array(flat).reshape(-1, 2) + start
                    np.add.at(covered, flat[:, 0], 1)
                    np.add.at(covered, flat[:, 1] - 1 + length, -1)
                gone = np.cumsum(covered[:-1]) > 0
                flat = _runs(gone)
                all_spans.append(flat)
                if len(flat):
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                kept.append(text)
            names = [n for n in batch.schema.names if n not in ("text", "starts", "repeats")]
            flat = np.concatenate(all_spans) if all_spans else []
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names],
                 list_array(flat, [len(s) for s in all_spans], pa.int32()),
                 pa.array(kept, pa.binary())], [*names, "spans", "kept"])
    return run


def _in_shards(parts, length):
    return parts.select(*SHOWN).repartition("grp").sortWithinPartitions(
        "grp", "part").mapInArrow(_shards(length), "grp long, part long, spans array<int>")


def cut_repeats(documents: DataFrame, id="doc_id", text="text", length=400) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row.

    ``spans`` is a flat array (start, end, start, ...) of byte runs, end exclusive, that strings
    of ``length`` bytes cover which also start anywhere else, in any row or the same one;
    ``kept`` is what is left. Strings are judged on the texts as given and never cross rows.

    NULL and empty texts keep nothing and lose nothing. Rows with equal texts lose them whole if
    they have ``length`` bytes or more. A NULL or repeated id changes nothing but the name of
    the row. Long texts are whole. ``length`` is at least twice the anchor's 64 bytes.

    Blocks are counted before the shuffle, so passages with many copies are a few rows. Only
    different blocks with a common anchor are fetched. Anchors with very many of those overfill
    a shard and are halved, at most as often as ``length`` can be; of parts with equal bytes one
    goes on, so copies of a passage become fewer rows with every halving.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    docs = documents.select(F.col(f"`{id}`").alias("id"),
                            F.col(f"`{text}`").cast("string").alias("text"))
    docs = docs.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.hash("text"))
    kind = dict(docs.dtypes)["id"]
    blocks = written(docs.where(F.octet_length("text") >= length).mapInArrow(
        _blocks(length), f"id {kind}, k1 long, k2 int, anchor long, block long, start int, "
                         "many int, place int"), "blocks")
    classes = blocks.groupBy("anchor", "block").agg(
        F.count("*").alias("copies"), F.first("many").alias("many"),
        F.first("place").alias("place"), *[F.first(c).alias(c) for c in ("id", "k1", "k2", "start")])
    classes = written(classes.withColumn("alone", F.col("copies") == 1), "classes")
    crowds = classes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = classes.join(crowds, "anchor")
    # How many blocks are fetched has no bound, so they are not broadcast.
    wanted = wanted.select(F.col("id").alias("of"), F.col("k1").alias("w1"),
                           F.col("k2").alias("w2"), "anchor", "block", "start", "many", "place",
                           "kinds").hint("merge")
    same = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & F.col("id").eqNullSafe(
        F.col("of"))
    fetched = written(docs.join(wanted, same).select(
        "anchor", "block", "kinds", F.col("anchor").alias("grp"), F.col("block").alias("part"),
        F.lit(0).alias("shift"), "place", F.lit(0).alias("low"),
        F.lit(length - GRAM).alias("high"), F.substring(
            F.col("text").cast("binary"), F.col("start") + 1, F.col("many") + length - 1
        ).alias("bytes")), "fetched")
    shown = [_in_shards(fetched.where(F.col("kinds") <= CROWD), length).select(
        F.col("grp").alias("anchor"), F.col("part").alias("block"), "spans")]
    crowded = fetched.where(F.col("kinds") > CROWD).dropDuplicates(["anchor", "block"]).drop(
        "kinds")
    while not crowded.isEmpty():
        parts = written(crowded.select(*[c.split()[0] for c in PARTS.split(", ")]).mapInArrow(
            _halves(length), PARTS), "parts")
        kinds = parts.groupBy("grp", "part").agg(F.count("*").alias("copies"), *[
            F.first(c).alias(c) for c in ("anchor", "block", "shift", "place", "low", "high",
                                          "bytes")])
        kinds = written(kinds, "kinds")
        sizes = written(kinds.groupBy("grp").agg(F.count("*").alias("kinds")), "sizes")
        # Parts that occur twice are repeated whole; the others need a suffix array or halving.
        many = F.octet_length("bytes") - (length - 1)
        solved = kinds.where("copies > 1").select("grp", "part", F.array(
            F.lit(0), many).alias("spans")).union(_in_shards(
                kinds.join(sizes.where((F.col("kinds") > 1) & (F.col("kinds") <= CROWD)), "grp"),
                length))
        shown.append(parts.select("anchor", "block", "grp", "part", "shift").join(
            solved, ["grp", "part"]).select("anchor", "block", F.expr(
                "transform(spans, x -> x + shift)").alias("spans")))
        # One of equal parts is enough to show that others are repeated.
        crowded = kinds.join(sizes.where(F.col("kinds") > CROWD), "grp")
    shown = reduce(DataFrame.union, shown)
    whole = classes.where("NOT alone").select(
        "anchor", "block", F.array(F.lit(0), F.col("many")).alias("spans"))
    alone = classes.where("alone").select("anchor", "block")
    found = whole.union(shown.join(alone, ["anchor", "block"], "left_semi"))
    found = written(found, "found")
    hits = blocks.join(found, ["anchor", "block"]).select("k1", "k2", "start", "spans")
    hits = hits.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "spans")).alias("hits"))
    hits = hits.select(F.col("k1").alias("h1"), F.col("k2").alias("h2"),
                       F.col("hits.start").alias("starts"), F.col("hits.spans").alias("repeats"))
    joined = docs.join(hits.hint("merge"), (F.col("k1") == F.col("h1"))
                       & (F.col("k2") == F.col("h2")), "left")
    return joined.select(
        F.col("id").alias(id), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
        .alias("n_bytes"), "text", "starts", "repeats").mapInArrow(
        _cut(length), f"`{id}` {kind}, n_bytes long, spans array<int>, kept binary")
