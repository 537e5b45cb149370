"""Best-fit packing of documents into sequences: large items are matched, small ones fill gaps.

Items of equal length are alike, so packing needs only how many items each length has: a
histogram of ``capacity`` numbers, whatever the size of the corpus. It is packed on the driver
into runs of sequences; items then find their place by their rank within their length.
"""

import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wattloom.llm.common import broadcast, list_array, opened, text_chunks, texts_of, written

#: Split of a text into pre-tokens, as public byte-level BPE vocabularies use it (fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level BPE files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level BPE file; special tokens stay out."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["id"] for t in data.get("added_tokens", []) if t.get("special")}
    symbols = byte_symbols()
    return {bytes(symbols[c] for c in token): i for token, i in data["model"]["vocab"].items()
            if i not in special}


def read_added(path: str) -> dict[str, int]:
    """The added tokens of a file, which stand for themselves wherever a text has them."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}


def encoder(ranks: dict[bytes, int], added: dict[str, int] | None = None):
    """Text to ids. The ids equal those of the `tokenizers` library, in a quarter of its time;
    without ``added`` those it gives if told to take added tokens for ordinary text."""
    import tiktoken
    coder = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks,
                              special_tokens=added or {})
    if not added:
        return coder.encode_ordinary
    special = set(added)

    def encode(text):
        if any(t in text for t in special):
            return coder.encode(text, allowed_special=special, disallowed_special=())
        return coder.encode_ordinary(text)
    return encode


def _cut(shared, capacity, end_id):
    def run(batches):
        encode = encoder(*opened(shared))
        part = TaskContext.get().partitionId()
        seen = defaultdict(int)

        def pieces(batch):
            out = defaultdict(list)
            rows = []
            for row, text in enumerate(texts_of(batch.column("text"))):
                ids = np.array([*encode(text), end_id], np.uint32)
                ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity)
                start = 0
                for piece, end in enumerate(ends):
                    length = end - start
                    rows.append(row)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[start:end].astype("<u4").tobytes()))
                    out["nth"].append(seen[length])
                    out["ids"].append(ids[start:end])
                    seen[length] += 1
                    start = end
            kept = [n for n in batch.schema.names if n != "text"]
            taken = pa.array(rows, pa.int64())
            ids = out["ids"]
            columns = [batch.column(n).take(taken) for n in kept]
            columns += [pa.array(out["piece"], pa.int32())]
            columns += [pa.array(out[n], pa.int64()) for n in ("start", "length", "ids_crc32")]
            columns += [pa.array([part] * len(rows), pa.int32()), pa.array(out["nth"], pa.int64())]
            columns += [list_array(np.concatenate(ids).astype(np.int32) if ids else [],
                                   [len(x) for x in ids], pa.int32())]
            return pa.RecordBatch.from_arrays(columns, [
                *kept, "piece", "start", "length", "ids_crc32", "part", "nth", "ids"])

        # Ids are several times their text: a slice of a batch is cut at once.
        for batch in batches:
            for row, _, offsets in text_chunks(batch.column("text")):
                yield pieces(batch.slice(row, len(offsets) - 1))
    return run


def pack_counts(counts: dict[int, int], capacity: int):
    """Packs ``counts[length]`` items of each length; returns (runs, number of sequences).

    A run (length, first rank, items, first sequence, offset) puts so many items of a length,
    from that rank on, one each into consecutive sequences at that offset.
    """
    counts = {n: c for n, c in counts.items() if c}
    ranks, runs, used = defaultdict(int), [], 0
    gaps = defaultdict(list)  # room left: [(first sequence, number of sequences)]

    def put(length, first, many, offset):
        runs.append((length, ranks[length], many, first, offset))
        ranks[length] += many
        counts[length] -= many

    large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
    for length in large:
        while counts[length]:
            mate = next((m for m in large if m <= capacity - length and counts[m]
                         and (m != length or counts[m] > 1)), None)
            many = counts[length] if mate is None else (
                counts[length] // 2 if mate == length else min(counts[length], counts[mate]))
            put(length, used, many, 0)
            if mate is not None:
                put(mate, used, many, length)
            room = capacity - length - (mate or 0)
            if room:
                gaps[room].append((used, many))
            used += many
    small = sorted((n for n in counts if 3 * n <= capacity), reverse=True)
    for length in small:
        while counts[length]:
            room = min((g for g, groups in gaps.items() if g >= length and groups), default=None)
            if room is None:
                room = capacity
                many = -(-counts[length] // (capacity // length))
                gaps[room].append((used, many))
                used += many
            first, size = gaps[room].pop()
            many = min(size, counts[length])
            put(length, first, many, capacity - room)
            if room > length:
                gaps[room - length].append((first, many))
            if many < size:
                gaps[room].append((first + many, size - many))
    return runs, used


def _place(shared):
    def run(batches):
        runs = opened(shared)
        key = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, (length << 44) + rank, "right") - 1
            found = runs[at] if len(at) else np.zeros((0, 5), np.int64)
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(found[:, 3] + rank - found[:, 1]),
                 pa.array(found[:, 4])], [*names, "sequence_id", "offset"])
    return run


def pack(documents: DataFrame, vocabulary: str, text="text", keep=("doc_id",), capacity=1024,
         end_id=2, with_ids=False) -> DataFrame:
    """One row per piece of a document: ``keep``, piece, start, length, ids_crc32, sequence_id,
    offset and, with ``with_ids``, the piece's token ids.

    A document is its ids and then ``end_id``. Longer ones than ``capacity`` are cut into pieces
    of that length, the first of which may be shorter. NULL and empty texts are one piece of one
    id. Equal rows are packed each. An empty table gives no rows. Sequences are numbered from 0
    and filled from offset 0 without gaps.

    ``vocabulary`` is the path of a byte-level BPE file; its 50,000 entries are broadcast. Texts
    are encoded once; the pieces are a written table, in which each task numbers its pieces of
    a length. Counts per task and length give every piece its rank within its length: a hot
    length is no hot task, and nothing but ``capacity`` counts comes to the driver.
    """
    spark = documents.sparkSession
    kinds = dict(documents.dtypes)
    made = {"text", "piece", "start", "length", "ids_crc32", "part", "nth", "ids", "rank",
            "sequence_id", "offset", "first"}
    if made & {k.lower() for k in keep}:
        raise ValueError("keep has names of result columns")
    left = "".join(f"`{k}` {kinds[k]}, " for k in keep)
    pieces = documents.select(*keep, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        _cut(broadcast(spark, (read_vocabulary(vocabulary), read_added(vocabulary))), capacity,
             end_id),
        left + "piece int, start long, length long, ids_crc32 long, part int, nth long, "
               "ids array<int>")
    pieces = written(pieces if with_ids else pieces.drop("ids"), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = counts.withColumn("first", F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    totals = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count("*")).collect()}
    runs, _ = pack_counts(totals, capacity)
    runs = np.array(sorted(runs) or np.zeros((1, 5)), np.int64).reshape(-1, 5)
    ranked = (pieces.join(counts.select("part", "length", "first"), ["part", "length"])
              .withColumn("rank", F.coalesce("first", F.lit(0)) + F.col("nth"))
              .drop("part", "nth", "first"))
    order = [*keep, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return ranked.select(*order, "rank").mapInArrow(
        _place(broadcast(spark, runs)),
        left + "piece int, start long, length long, ids_crc32 long, "
        + ("ids array<int>, " if with_ids else "") + "sequence_id long, offset long")
