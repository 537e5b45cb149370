"""Helpers shared by the operators: Arrow text as numpy bytes, word hashes, components."""

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from wattloom.session import fresh_path, written

__all__ = ["CHUNK_BYTES", "DRAWS", "broadcast", "components", "crc32_of", "drawn_below", "free_name", "fresh_path", "list_array",
           "lower_map", "mix64", "offsets_of", "opened", "text_chunks", "texts_of", "word_spans",
           "written", "WordHasher"]

#: Texts are worked on in slices of about this many bytes; one text is never cut.
CHUNK_BYTES = 1 << 20

U64 = np.uint64


def broadcast(spark, value):
    """A broadcast variable that carries this package's classes by value; see ``opened``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shared):
    return cloudpickle.loads(shared.value)


#: Draws by hash are numbers below this; fine enough for any number of rows.
DRAWS = 1 << 62


def drawn_below(wanted, rows):
    """The bound below which a row's draw must be for about ``wanted`` of ``rows`` to be taken."""
    return DRAWS if rows <= wanted else int(DRAWS * wanted / rows)


def crc32_of(column):
    """crc32 of a column's text; NULL counts as empty."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def texts_of(column) -> list:
    """An Arrow string column as Python strings, NULL as empty."""
    return [x or "" for x in column.to_pylist()]


def offsets_of(lengths) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def list_array(flat, lengths, kind) -> pa.Array:
    """A list column from its flat values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(offsets_of(lengths).astype(np.int32)),
                                    pa.array(flat, kind))


def utf8_of(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without copying; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(column, size=CHUNK_BYTES):
    """Yields (first row, bytes, offsets) for runs of rows of about ``size`` bytes."""
    raw, offsets = utf8_of(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        end = min(end, rows)
        yield row, raw[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def lower_map(separators) -> np.ndarray:
    """Byte table: A-Z lower-cased, separators 0, all else as it is."""
    out = np.arange(256, dtype=np.uint8)
    out[ord("A"):ord("Z") + 1] += 32
    out[list(separators)] = 0
    return out


def mix64(x):
    """Finalizer of a 64-bit hash (multiply and shift), elementwise on uint64."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def word_spans(mapped, offsets):
    """(start, end) of each word, a run of non-zero bytes within one text."""
    inside = mapped != 0
    before = np.zeros(len(mapped), bool)
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(mapped)]
    before[begins] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(mapped), bool)
    after[:-1] = inside[1:]
    ends_at = offsets[1:] - 1
    after[ends_at[ends_at >= 0]] = False
    return starts, np.flatnonzero(inside & ~after) + 1


class WordHasher:
    """64-bit hashes of all words of a slice from one running polynomial sum."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def powers(self, n):
        if len(self.up) < n:
            n = 1 << n.bit_length()
            base = np.full(n, self.BASE, U64)
            base[0] = 1
            self.up = np.cumprod(base)
            base = np.full(n, pow(self.BASE, -1, 1 << 64), U64)
            base[0] = 1
            self.down = np.cumprod(base)
        return self.up, self.down

    def __call__(self, mapped, starts, ends):
        if not len(starts):
            return np.zeros(0, U64)
        up, down = self.powers(len(mapped) + 1)
        total = np.zeros(len(mapped) + 1, U64)
        np.cumsum(mapped * up[:len(mapped)], out=total[1:])
        return mix64((total[ends] - total[starts]) * down[starts]
                     + (ends - starts).astype(U64))


#: Nodes that a task contracts at once.
HELD = 1 << 20


def _local_stars(batches):
    """Union-find over edges of one partition; yields (node, smallest known node).

    What it holds is bounded: beyond ``HELD`` nodes it yields what it knows and starts anew.
    """
    parent = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def stars():
        nodes = [x for x in parent if parent[x] != x]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())],
            ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= HELD:
            yield stars()
            parent.clear()
    yield stars()


def _are_stars(links):
    """Whether every node has one smaller node at most, and that one none."""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("up")).union(
        links.select(F.col("b").alias("x"), F.lit(0).alias("up")))
    ends = ends.groupBy("x").agg(F.sum("up").alias("n"), F.min("up").alias("low"))
    return ends.where("n > 1 OR n = 1 AND low = 0").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, name="components") -> DataFrame:
    """(node, component): the smallest node that links (a, b) of two longs reach from ``node``.

    Each partition first contracts its own links to stars. Then small-star and large-star steps
    alternate until only stars are left; each round is a written table. Every step is a
    grouped minimum, summed before the shuffle, and a join that adaptive execution can split, so
    a node with very many links is no hot task. Nodes without a link are not returned; links
    with a NULL end and loops are ignored.
    """
    links = (edges.select(F.col(edges.columns[0]).cast("long").alias("a"),
                          F.col(edges.columns[1]).cast("long").alias("b"))
             .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .mapInArrow(_local_stars, "a long, b long"))
    links = written(links.distinct(), name)
    while not _are_stars(links):
        # The smaller ends of a node are linked with the smallest of them, then the larger ends
        # of a node with the smallest around it.
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        small = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"),
                                                              F.col("m").alias("b"))
        small = written(small.union(least.select("a", F.col("m").alias("b"))), name)
        both = small.union(small.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a")
        links = written(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
