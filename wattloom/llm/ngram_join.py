"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, sorted-array intersection.

Two sets of sizes a and b with Jaccard similarity of at least p percent differ in at most
``D = (a + b) * (100 - p) / (100 + p)`` elements. Within a band of sizes the hash space is cut
into more segments than D can be, so such sets agree in at least one whole segment: sets meet in
the tile of that band, segment and content. Of tiles with the same members one is kept. Tiles
that share members form a group, and all links lie within groups. A group of few members is
compared in one task. In larger groups all are compared with a few of the group. A tile then goes
by the part most of its members may lie in: sets outside of that part are compared with it once
for all tiles. Only tiles whose members are then still apart compare those outside, block by
block, but for pairs that are together already. Sets travel to a block as sorted arrays. Bitmaps
rule pairs out; those they admit are intersected exactly, and a task returns a spanning forest.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import (WordHasher, components, list_array, lower_map, mix64,
                                 text_chunks, word_spans, written)

SPACES = lower_map([*range(9, 14), 32])
#: U+0000 is part of words, and 0 parts them: it becomes a byte that UTF-8 never uses.
SPACES[0] = 0xFF
U64 = np.uint64
BITS = 1024
#: Groups of tiles up to this many sets are compared in one task, larger ones in many.
SMALL = 128
#: Sizes of a band lie within this factor.
BAND = 1.4
#: Members of a tile that one task compares with as many others at once, about, and the elements
#: of their sets.
BLOCK, ELEMENTS = 256, 1 << 20
#: The members of a large group that are compared with all: the smallest after flipping these.
FLIPS = [int(x) for x in (np.arange(1, 9, dtype=U64) * U64(0x9E3779B97F4A7C15)).view(np.int64)]
#: Rows that a task combines before they are shuffled.
COMBINE = 1 << 19


def shingle_hashes(column, words):
    """Yields (row, sorted distinct hashes of the row's shingles) for every text."""
    hasher = WordHasher()
    steps = [U64(int(x) | 1) for x in mix64(np.arange(1, words + 1, dtype=U64) << U64(32))]
    for row, raw, offsets in text_chunks(column):
        mapped = SPACES[raw]
        starts, ends = word_spans(mapped, offsets)
        h = hasher(mapped, starts, ends)
        joined = np.zeros(max(0, len(h) - words + 1), U64)
        for i in range(words):
            joined += h[i:i + len(joined)] * steps[i]
        joined = mix64(joined)
        bounds = np.searchsorted(starts, offsets)
        for t in range(len(offsets) - 1):
            low, high = bounds[t], bounds[t + 1]
            if high - low >= words:
                yield row + t, np.unique(joined[low:high - words + 1])
            elif high > low:
                weighted = h[low:high] * np.array(steps[:high - low])
                size = np.array([high - low], U64)
                yield row + t, mix64(weighted.sum(keepdims=True) + size)
            else:
                yield row + t, np.zeros(0, U64)


def most_different(a, b, percent):
    return (a + b) * (100 - percent) // (100 + percent)


class Bands:
    """Bands of set sizes and the cuts of the hash space in each."""

    def __init__(self, percent):
        self.percent, self.high, self.cuts = percent, [1], {}

    def of(self, size):
        while self.high[-1] < size:
            self.high.append(max(self.high[-1] + 1, int(self.high[-1] * BAND)))
        return int(np.searchsorted(self.high, size))

    def edges(self, band):
        if band not in self.cuts:
            high = self.high[band]
            count = most_different(high, high, self.percent) + 1
            count += -(-count // 4)  # some to spare: the smallest segments tell least
            self.cuts[band] = np.array([i * 2 ** 64 // count for i in range(1, count)], U64)
        return self.cuts[band]

    def keys(self, s, mixed):
        """Tile keys of a set: one for each segment of its band and of its larger partners'."""
        n, out = len(s), []
        total = np.zeros(n + 1, U64)
        np.cumsum(mixed, out=total[1:])
        largest = 100 * n // self.percent
        for band in range(self.of(n), self.of(largest) + 1):
            most = most_different(n, min(largest, self.high[band]), self.percent)
            if not most:
                continue  # partners are equal sets, which are one class anyway
            at = np.concatenate(([0], np.searchsorted(s, self.edges(band)), [n]))
            names = np.arange(len(at) - 1, dtype=U64) + U64(band << 32)
            keys = mix64(total[at[1:]] - total[at[:-1]] + mix64(names))
            # Similar sets agree in more than `spare` segments. Up to so many of the smallest
            # are left out: of two such sets, the one that leaves out larger segments still
            # has a common one that both keep.
            sizes = at[1:] - at[:-1]
            spare = len(sizes) - 1 - most
            least = np.searchsorted(np.cumsum(np.bincount(sizes)), spare, "right")
            out.append(keys[sizes >= least])
        return np.concatenate(out) if out else np.zeros(0, U64)


def bitmap(s):
    bits = np.zeros(BITS, np.uint8)
    bits[(s % U64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _digests(s):
    first, second = mix64(s ^ U64(0x5851F42D4C957F2D)), mix64(s ^ U64(0x14057B7EF767814F))
    size = np.array([len(s)], U64)
    return first, first.sum(dtype=U64), mix64(second.sum(dtype=U64, keepdims=True) + size)[0]


def _signed(values):
    return np.array(values, U64).view(np.int64)


def _sign(words):
    def run(batches):
        for batch in batches:
            n, d1, d2 = [], [], []
            for _, s in shingle_hashes(batch.column("text"), words):
                _, first, second = _digests(s)
                n.append(len(s))
                d1.append(first)
                d2.append(second)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(n, pa.int64()),
                 pa.array(_signed(d1)), pa.array(_signed(d2))], ["id", "text_key", "n", "d1", "d2"])
    return run


def _by_key(keys, sets):
    """Sorted distinct (key, set) pairs, the first place of each key, and its index per pair."""
    order = np.lexsort((sets, keys))
    keys, sets = keys[order], sets[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
    keys, sets = keys[new], sets[new]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys, sets, np.flatnonzero(first), np.cumsum(first) - 1


MEMBER = ["key", "d1", "pivot"]
PACKED = "bucket int, who binary, many binary, keys binary, rest binary"


def _pack(words, percent, buckets):
    """Before the shuffle: tile keys by bucket, six bytes each, a set's keys together.

    Of the sets of a key in one task only the first goes to the key's bucket; the others are
    (key, set, first set) in ``rest`` of any bucket, so a key of very many sets is no hot one.
    Keys are cut to 48 bits besides the bucket: chance meetings are compared and found apart.
    """
    def flush(held):
        keys = np.concatenate([k for k, _ in held])
        sets = np.concatenate([np.full(len(k), d, U64) for k, d in held])
        keys, sets, first, group = _by_key(keys, sets)
        head = np.zeros(len(keys), bool)
        head[first] = True
        size = np.diff(np.append(first, len(keys)))
        several = head & (size[group] > 1)
        rest = np.stack([keys[~head], sets[~head], sets[first][group][~head]], 1)
        # The first set of several is in `rest` too, which tells that its key has more.
        rest = np.concatenate([rest, np.stack([keys[several], sets[several], sets[several]], 1)])
        keys, sets = keys[head], sets[head]
        bucket = keys % U64(buckets)
        order = np.lexsort((sets, bucket))
        keys, sets, bucket = keys[order], sets[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))
        shares = np.array_split(np.arange(len(rest)), buckets)
        out = {n: [] for n in ("bucket", "who", "many", "keys", "rest")}
        for b in range(buckets):
            k, d = keys[cuts[b]:cuts[b + 1]], sets[cuts[b]:cuts[b + 1]]
            if not len(k) and not len(shares[b]):
                continue
            who, many = np.unique(d, return_counts=True)
            cut = ((k // U64(buckets)) & U64((1 << 48) - 1))
            planes = cut.view(np.uint8).reshape(-1, 8)[:, :6]
            for name, value in (("bucket", b), ("who", who.tobytes()), ("keys", planes.tobytes()),
                                ("many", many.astype(np.uint32).tobytes()),
                                ("rest", rest[shares[b]].tobytes())):
                out[name].append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(out["bucket"], pa.int32()),
             *[pa.array(out[n], pa.binary()) for n in ("who", "many", "keys", "rest")]],
            ["bucket", "who", "many", "keys", "rest"])

    def run(batches):
        bands, held, rows = Bands(percent), [], 0
        for batch in batches:
            for _, s in shingle_hashes(batch.column("text"), words):
                if len(s):
                    mixed, first, _ = _digests(s)
                    keys = bands.keys(s, mixed)
                    held.append((keys, first))
                    rows += len(keys)
                    if rows >= COMBINE:
                        yield flush(held)
                        held, rows = [], 0
        if rows:
            yield flush(held)
    return run


def _meet(buckets):
    """After the shuffle: all (key, set, first set of the key) of keys with several sets."""
    def cut(keys):
        return (keys // U64(buckets)) & U64((1 << 48) - 1)

    def run(batches):
        keys, sets, several = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                bucket = row["bucket"]
                planes = np.frombuffer(row["keys"], np.uint8).reshape(-1, 6)
                k = np.zeros((len(planes), 8), np.uint8)
                k[:, :6] = planes
                keys.append(k.view(U64)[:, 0] * U64(buckets) + U64(bucket))
                sets.append(np.repeat(np.frombuffer(row["who"], U64),
                                      np.frombuffer(row["many"], np.uint32)))
                rest = np.frombuffer(row["rest"], U64).reshape(-1, 3)
                if len(rest):
                    at = cut(rest[:, 0]) * U64(buckets) + rest[:, 0] % U64(buckets)
                    yield members(at, rest[:, 1], rest[:, 2])
        if keys:
            keys, sets, first, group = _by_key(np.concatenate(keys), np.concatenate(sets))
            keep = np.diff(np.append(first, len(keys)))[group] > 1
            yield members(keys[keep], sets[keep], sets[first][group][keep])

    def members(*columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns], MEMBER)
    return run


def _arrays(words):
    """(component, d1, n, s) of the texts whose set, as sorted array s, is the one they stand for."""
    def run(batches):
        for batch in batches:
            wanted = batch.column("d1").to_numpy().view(U64)
            at, n, arrays = [], [], []
            for row, s in shingle_hashes(batch.column("text"), words):
                if len(s) and _digests(s)[1] == wanted[row]:
                    at.append(row)
                    n.append(len(s))
                    arrays.append(s.tobytes())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("component").take(at), batch.column("d1").take(at),
                 pa.array(n, pa.int64()), pa.array(arrays, pa.binary())],
                ["component", "d1", "n", "s"])
    return run


def _alike(a, b, percent):
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    both = np.sort(np.concatenate((a, b)), kind="stable")  # merges two sorted runs
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _allowed(x, nx, y, ny, percent):
    """Which pairs sizes and bitmaps allow: each bit of one set alone is an element of its own."""
    both = x @ y.T
    most = np.minimum(nx[:, None] - (x.sum(1)[:, None] - both),
                      ny[None, :] - (y.sum(1)[None, :] - both))
    return 100 * most >= percent * (nx[:, None] + ny[None, :] - most)


def _unpacked(bits):
    return np.unpackbits(np.frombuffer(b"".join(bits), np.uint8)).reshape(-1, BITS).astype(
        np.float32)


def _small_groups(words, percent):
    """(node, component) of whole groups, whose rows follow each other."""
    def solve(names, texts):
        found = {}
        for row, s in shingle_hashes(pa.array(texts, pa.string()), words):
            if len(s) and _digests(s)[1] == U64(names[row] & (1 << 64) - 1):
                found.setdefault(names[row], s)
        names, sets = list(found), list(found.values())
        if len(names) < 2:
            return
        root = list(range(len(names)))

        def top(i):
            while root[i] != i:
                i = root[i]
            return i
        bits, n = _unpacked([bitmap(s) for s in sets]), np.array([len(s) for s in sets])
        good = np.triu(_allowed(bits, n, bits, n, percent), 1)
        for i, j in np.argwhere(good).tolist():
            a, b = top(i), top(j)
            if a != b and _alike(sets[i], sets[j], percent):
                root[max(a, b)] = min(a, b)
        groups = {}
        for i, name in enumerate(names):
            groups.setdefault(top(i), []).append(name)
        for members in groups.values():
            least = min(members)
            yield from ((m, least) for m in members if m != least)

    def run(batches):
        now, names, texts = None, [], []
        for batch in batches:
            out = []
            for group, name, text in zip(*(batch.column(c).to_pylist()
                                           for c in ("component", "d1", "text"))):
                if group != now:
                    out += solve(names, texts)
                    now, names, texts = group, [], []
                names.append(name)
                texts.append(text)
            yield rows(out)
        yield rows(list(solve(names, texts)))

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()),
                                           pa.array([b for _, b in out], pa.int64())], ["a", "b"])
    return run


def _tile(percent):
    """Links of a tile that join sets with different ``c``, as a spanning forest.

    Sets that are ``near`` are compared with all others; if i = j, all are near.
    """
    def run(table):
        near = table.column("near").to_numpy()
        c, d1 = table.column("c").to_numpy(), table.column("d1").to_numpy()
        sets = [np.frombuffer(x, U64) for x in table.column("s").to_pylist()]
        n, bits = np.array([len(x) for x in sets]), _unpacked([bitmap(x) for x in sets])
        p, same = np.flatnonzero(near), table.column("i")[0] == table.column("j")[0]
        q = p if same else np.flatnonzero(~near)
        good = _allowed(bits[p], n[p], bits[q], n[q], percent) & (c[p][:, None] != c[q][None, :])
        if same:
            good = np.triu(good, 1)
        root, a, b = {}, [], []

        def top(x):
            while root.get(x, x) != x:
                x = root[x]
            return x
        for at, row in zip(p.tolist(), good):
            for other in q[row].tolist():
                x, y = top(c[at]), top(c[other])
                if x != y and _alike(sets[at], sets[other], percent):
                    root[max(x, y)] = min(x, y)
                    a.append(d1[at])
                    b.append(d1[other])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _blocks(size, elements):
    """In how many blocks a tile of ``size`` sets with so many elements is cut."""
    return F.ceil(F.greatest(size / F.lit(BLOCK), elements / F.lit(ELEMENTS)))


def _place(at, near):
    return F.struct(at.cast("long").alias("at"), F.lit(near).alias("near"))


def _few_with_all(rows, few, blocks):
    """Rows in tiles (i, j) in which those that are ``few`` meet each block of the others."""
    own = F.array(_place(F.pmod(F.xxhash64("d1"), blocks), False))
    each = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda b: _place(b, True))
    rows = rows.withColumn("place", F.explode(F.when(few, F.concat(each, own)).otherwise(own)))
    return rows.select("key", F.lit(-1).cast("long").alias("i"), F.col("place.at").alias("j"),
                       F.col("place.near").alias("near"), "d1", "c")


def _outside_with_parts(outside, known):
    """Rows in tiles (i, j) in which ``dense`` sets meet all of a part, others one set of it."""
    # The two kinds of tiles have names of their own.
    outside = outside.select(F.when(F.col("dense"), F.col("top")).otherwise(
        F.bitwise_not("pivot")).alias("key"), "dense", "top", "pivot", "d1", "size", "c")
    names = outside.groupBy("key").agg(
        F.min("dense").alias("dense"), F.min("top").alias("top"), F.min("pivot").alias("pivot"),
        _blocks(F.count("*"), F.sum("size")).alias("few"))
    inside = names.where("dense").select("key", "few", F.col("top").alias("c")).join(
        known, "c").select("key", "few", "d1", "size", "c").union(
        names.where("NOT dense").select("key", "few", F.col("pivot").alias("d1")).join(
            known, "d1").select("key", "few", "d1", "size", "c"))
    rest = inside.groupBy("key").agg(
        F.max("few").alias("few"), _blocks(F.count("*"), F.sum("size")).alias("rest"))
    zero, last = F.lit(0).cast("long"), F.lit(-1).cast("long")
    outer = outside.join(rest, "key").select(
        "key", F.pmod(F.xxhash64("d1"), "few").alias("i"),
        F.explode(F.sequence(-F.col("rest"), last)).alias("j"), F.lit(True).alias("near"), "d1", "c")
    inner = inside.join(rest.select("key", "rest"), "key").select(
        "key", F.explode(F.sequence(zero, F.col("few") - 1)).alias("i"),
        (-F.pmod(F.xxhash64("d1"), "rest") - 1).alias("j"), F.lit(False).alias("near"), "d1", "c")
    return outer.union(inner)


def similar_sets(documents: DataFrame, id="doc_id", text="text", words=5, percent=80
                 ) -> DataFrame:
    """(id, n_shingles, component_id) of every row: which texts are near copies of which.

    A text's set holds its distinct shingles of ``words`` words, A-Z lower-cased; a shorter
    text has one shingle, all its words. Two sets link if 100 times the size of their
    intersection is at least ``percent`` times the size of their union. ``component_id`` is the
    smallest id that links reach from a row. Shingles are compared as 64-bit hashes.

    NULL and empty texts have an empty set, link with nothing and are components of their own;
    so are rows of NULL id, which keep NULL. Rows of one id are judged one by one. Ids are
    integers. Copies of a set are one class: they cost a row each and are never paired.
    No link between different sets is lost: see the module. Nothing is capped.
    """
    return _judged(documents, id, text, words, percent).select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id")


def _text_key(text):
    return F.xxhash64(F.col(f"`{text}`").cast("string"))


def _judged(documents, id, text, words, percent):
    """(id, text_key, n, component_id, component) of every row; ``component`` is of its sets."""
    spark = documents.sparkSession
    docs = documents.select(F.col(f"`{id}`").cast("long").alias("id"),
                            F.col(f"`{text}`").cast("string").alias("text"),
                            _text_key(text).alias("text_key"))
    usable = docs.where("id IS NOT NULL")
    signed = written(docs.mapInArrow(_sign(words), "id long, text_key long, n long, d1 long, d2 long"), "signed")
    classes = (signed.where("n > 0 AND id IS NOT NULL").groupBy("d1", "d2")
               .agg(F.min("id").alias("rep"), F.max("n").alias("size")))
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = ", ".join(f"{c} long" for c in MEMBER)
    met = written(usable.select("text").mapInArrow(_pack(words, percent, buckets), PACKED)
                  .repartition("bucket").mapInArrow(_meet(buckets), members), "tiles")
    stars = met.where("d1 <> pivot").select("d1", "pivot")
    grouped = components(stars, "candidates")
    grouped = grouped.union(grouped.select(F.col("component").alias("node"), "component")
                            .distinct())
    sizes = grouped.groupBy("component").agg(F.count("*").alias("many"))
    placed = grouped.join(sizes, "component").select(
        F.col("node").alias("d1"), "component", (F.col("many") > SMALL).alias("large"))
    reps = written(classes.join(placed, "d1"), "classes")

    # One text of each class that met any other; how many has no bound, so no side is broadcast.
    ids = reps.select(F.col("rep").alias("id"), "d1", "component", "large").hint("merge")
    texts = written(usable.join(ids, "id").select("component", "large", "d1", "text"), "texts")
    solved = texts.where("NOT large").repartition("component").sortWithinPartitions(
        "component").mapInArrow(_small_groups(words, percent), "a long, b long")
    solved = written(solved, "small")
    sets = written(texts.where("large").select("component", "d1", "text").mapInArrow(
        _arrays(words), "component long, d1 long, n long, s binary"), "arrays")

    def compared(tiles):
        """Links of tiles; sets come as arrays, once for each block they meet."""
        return written(tiles.join(sets.select("d1", "s"), "d1").groupBy("key", "i", "j")
                       .applyInArrow(_tile(percent), "a long, b long"), "links")

    def joined(groups, links):
        stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(stars.union(links), "groups")

    # A few members of a group are compared with all others: of near copies they join most.
    flipped = [F.min(F.col("d1").bitwiseXOR(F.lit(x))).bitwiseXOR(F.lit(x)) for x in FLIPS]
    pivots = sets.groupBy(F.col("component").alias("key")).agg(
        F.array(*flipped).alias("pivots"), _blocks(F.count("*"), F.sum("n")).alias("blocks"))
    inside = _few_with_all(
        sets.select(F.col("component").alias("key"), "d1", F.col("d1").alias("c")).join(
            pivots, "key"), F.array_contains("pivots", F.col("d1")), F.col("blocks"))
    first = components(compared(inside), "stars")

    def known_of(groups):
        """What the members of large groups are together with."""
        return written(reps.where("large").join(groups.select(
            F.col("node").alias("d1"), F.col("component").alias("g")), "d1", "left").select(
            "d1", "size", F.coalesce("g", "d1").alias("c")), "known")

    # What a set is together with is looked up once for all of its tiles, whose number its size
    # bounds. Tiles whose members are together are done with. Of tiles with the same members one
    # is enough; they are told by two sums of 64-bit hashes.
    known = known_of(first)
    whole = known.groupBy(F.col("c").alias("top")).agg(F.count("*").alias("part"))
    met = met.groupBy("d1").agg(F.collect_set("key").alias("keys")).join(known, "d1").select(
        F.explode("keys").alias("key"), "d1", "size", "c")
    met = written(met, "tiles")
    alike = met.groupBy("key").agg(
        F.count("*").alias("many"), *[x.alias(f"pivot{i}") for i, x in enumerate(flipped)],
        *[F.sum(F.xxhash64("d1", F.lit(x)).cast("decimal(38,0)")).alias(f"who{x}")
          for x in (1, 2)], F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    pivots = [f"pivot{i}" for i in range(len(flipped))]
    alike = alike.groupBy("many", "who1", "who2").agg(
        F.min("key").alias("key"), *[F.min(x).alias(x) for x in pivots])
    # A tile goes by the largest part that any of a few members lies in.
    alike = alike.withColumn("pivot", F.explode(F.array_distinct(F.array(*pivots)))).join(
        known.select(F.col("d1").alias("pivot"), F.col("c").alias("top")), "pivot").join(
        whole, "top").groupBy("key").agg(
        F.max("many").alias("many"), F.max(F.struct("part", "top", "pivot")).alias("by"))
    # A member of another part is outside; only those go on.
    strange = written(met.join(alike.select("key", "many", "by.*"), "key").where("c <> top"),
                      "strange")
    # In how many tiles one met a part does not matter to the comparison with the part, so only
    # pairs are looked up. One that is outside in tiles of as many members as the part
    # has is compared with the whole part, once, and no more with what of it lies in each tile.
    outside = written(strange.groupBy("d1", "top").agg(
        (F.sum("many") >= F.max("part")).alias("dense"), F.min("pivot").alias("pivot"),
        F.max("size").alias("size"), F.max("c").alias("c")), "outside")
    groups = joined(first, compared(_outside_with_parts(outside, known)))

    known = known_of(groups)
    outside = outside.select("d1", "top", "dense").join(known, "d1").join(
        known.select(F.col("d1").alias("top"), F.col("c").alias("now")), "top")
    members = written(strange.select("key", "d1", "top").join(outside, ["d1", "top"]), "outside")
    still = members.where("c <> now").groupBy("key").agg(F.min("dense").alias("dense"))
    still = written(still, "still")
    # Those outside meet each other in their tiles; what is inside meets the others than the dense.
    rows = members.join(still.where("dense"), "key", "left_semi").select(
        "key", "d1", "size", "c").union(
        met.join(still.where("NOT dense"), "key", "left_semi").select("key", "d1").join(
            known, "d1").select("key", "d1", "size", "c"))
    rows = written(rows, "members")

    def apart(rows):
        """The tiles of several parts."""
        parts = rows.groupBy("key", "c").agg(
            F.count("*").alias("many"), F.sum("size").alias("of"), F.min("d1").alias("least"))
        keys = parts.groupBy("key").agg(
            F.count("*").alias("parts"), F.max(F.struct("many", "of", "c")).alias("top"),
            F.sum("many").alias("many"), F.sum("of").alias("of"),
            F.min(F.struct("least", "c")).alias("first")).where("parts > 1")
        # Two blocks' worth are compared at once, in one place; there is no rest then.
        split = (F.col("many") > 2 * BLOCK) | (F.col("of") > 2 * ELEMENTS)
        rest = _blocks(F.col("top.many"), F.col("top.of"))
        blocks = _blocks(F.col("many") - F.col("top.many"), F.col("of") - F.col("top.of"))
        return written(keys.select(
            "key", F.when(split, F.col("top.c")).alias("top"), "first",
            F.when(split, rest).otherwise(0).alias("rest"),
            F.when(split, blocks).otherwise(1).alias("blocks")), "apart")

    # In tiles that are not together yet all but the largest part are compared with all. Where
    # that part is more than a block, all are compared with the smallest member before, and with
    # that once for all tiles.
    keys = apart(rows)
    wide = keys.where("blocks > 1")
    if not wide.isEmpty():
        some = rows.join(wide.select("key", "first"), "key").where("c <> first.c").groupBy(
            "d1", F.col("first.least").alias("pivot")).agg(
            F.max("size").alias("size"), F.max("c").alias("c"))
        links = compared(_outside_with_parts(some.select(
            "d1", F.col("pivot").alias("top"), F.lit(False).alias("dense"), "pivot", "size", "c"),
            known))
        if not links.isEmpty():
            groups = joined(groups, links)
            again = rows.join(wide, "key", "left_semi").select("key", "d1").join(
                known_of(groups), "d1").select("key", "d1", "size", "c")
            rows = written(rows.join(wide, "key", "left_anti").union(again), "members")
            keys = apart(rows)
    tiles = rows.join(keys, "key").withColumn("few", F.coalesce(
        F.col("c") != F.col("top"), F.lit(True)))
    zero, last = F.lit(0).cast("long"), F.col("blocks") - 1
    tiles = tiles.withColumn("at", F.pmod(F.xxhash64("d1"), F.when(F.col("few"), F.col("blocks")).otherwise(
        F.col("rest")))).withColumn("other", F.explode(F.when(F.col("few"), F.concat(
            F.sequence(zero, last), F.transform(F.array_repeat(zero, F.col("rest").cast("int")),
                                                lambda x, i: -i.cast("long") - 1))).otherwise(
            F.sequence(zero, last))))
    both = F.col("few") & (F.col("other") >= 0)  # blocks of the rest count down from -1
    tiles = tiles.select(
        "key", "d1", "c", "few", "at",
        F.when(both, F.least("at", "other")).when(F.col("few"), F.col("at")).otherwise(
            F.col("other")).alias("i"),
        F.when(both, F.greatest("at", "other")).when(F.col("few"), F.col("other")).otherwise(
            -F.col("at") - 1).alias("j"))
    tiles = tiles.select("key", "i", "j", (F.col("few") & (F.col("at") == F.col("i"))).alias("near"),
                         "d1", "c")
    left = compared(tiles)
    groups = joined(groups, left).union(
        solved.select(F.col("a").alias("node"), F.col("b").alias("component")))

    # From sets to documents: the smallest id of a component's sets.
    ids = reps.groupBy("d1").agg(F.min("rep").alias("rep")).join(
        groups.select(F.col("node").alias("d1"), "component"), "d1", "left").withColumn(
        "component", F.coalesce("component", "d1"))
    smallest = ids.groupBy("component").agg(F.min("rep").alias("smallest"))
    known = ids.join(smallest, "component").select("d1", "smallest", "component")
    named = classes.join(known, "d1", "left").select(
        F.col("d1").alias("k1"), F.col("d2").alias("k2"),
        F.coalesce("smallest", "rep").alias("found"),
        F.coalesce("component", "d1").alias("component"))
    out = signed.select("id", "text_key", "n", "d1", "d2").join(
        named, (F.col("n") > 0) & (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2")),
        "left")
    return out.select("id", "text_key", "n", F.when(F.col("id").isNotNull(), F.coalesce("found", "id"))
                      .alias("component_id"), "component")


def drop_near_copies(documents: DataFrame, id="doc_id", text="text", words=5, percent=80
                     ) -> DataFrame:
    """One text of each component of near copies, of the row with the smallest id.

    Rows are judged one by one, also those of one id; of several texts of the kept id in a
    component one stays. Rows of empty text or NULL id stay, and so do all rows that equal the
    kept one in id and text.
    """
    found = _judged(documents, id, text, words, percent).where("id IS NOT NULL AND n > 0")
    kept = found.where("id = component_id")
    several = kept.groupBy("component").agg(
        F.min("text_key").alias("low"), F.max("text_key").alias("high")).where("low < high")
    gone = found.where("id <> component_id").select("id", "text_key").union(
        kept.join(several, "component").where("text_key <> low").select("id", "text_key"))
    gone = gone.select(F.col("id").alias("gone"), F.col("text_key").alias("gone_key")).distinct()
    return documents.join(gone, (F.col(f"`{id}`") == F.col("gone"))
                          & (_text_key(text) == F.col("gone_key")), "left_anti")
