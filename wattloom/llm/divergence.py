"""Source divergence audit: how far the word use of each source of a language is from the others.

Counts of kept terms become per source and slice of the terms a sorted array of (term id, count).
For every unordered pair of sources the two sides' arrays meet in one task per slice, which
merges them: ids in both, ids in one, and terms in neither are priced exactly.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from wattloom.llm.common import lower_map, offsets_of, text_chunks, word_spans, written

#: Bytes that are no part of a term: all of ASCII but the letters.
TERM = lower_map([b for b in range(0x80) if not chr(b).isalpha()])
#: Different (group, term) cells that a task holds before it hands them on.
CELLS = 1 << 20
#: Terms of a language are dealt to blocks: as many as the text has pieces of this size.
BLOCK_BYTES = 32 << 20
MIN_BLOCKS = 256
#: About so many terms of a language make a slice, the part of a pair that one task merges.
SLICE_TERMS = 1 << 18
SCALE = 1_000_000_000


def term_counts(raw, offsets):
    """(terms, text of each, term of each, count) of a slice of texts: its different terms as an
    Arrow array and, for every text and term in it, how often it occurs."""
    mapped = TERM[raw]
    starts, ends = word_spans(mapped, offsets)
    flat, places = mapped[mapped != 0], offsets_of(ends - starts)
    wide = places[-1] > np.iinfo(np.int32).max
    kind = (pa.large_binary(), np.int64) if wide else (pa.binary(), np.int32)
    words = pa.Array.from_buffers(kind[0], len(starts), [
        None, pa.py_buffer(places.astype(kind[1])), pa.py_buffer(flat)]).dictionary_encode()
    many = max(1, len(words.dictionary))
    text_of = np.searchsorted(offsets, starts, "right") - 1
    key, n = np.unique(text_of * many + words.indices.to_numpy(), return_counts=True)
    return words.dictionary, key // many, key % many, n


def _cells(limit):
    def summed(held):
        whole = pa.concat_tables(held).group_by(["group", "term"]).aggregate(
            [("n", "sum"), ("docs", "sum")])
        return pa.table([whole["group"], whole["term"], whole["n_sum"], whole["docs_sum"]],
                        ["group", "term", "n", "docs"])

    def given(table, names):
        at = table["group"].combine_chunks()
        lang, source = (pa.array([x[i] for x in names], pa.string()) for i in (0, 1))
        return pa.table([lang.take(at), source.take(at), table["term"].cast(pa.string()),
                         table["n"], table["docs"]], ["lang", "source", "term", "n", "docs"]
                        ).combine_chunks().to_batches()

    def numbers(batch, groups):
        pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        return np.array([groups.setdefault(x, len(groups)) for x in pairs], np.int64)

    def run(batches):
        groups, held, rows = {}, [], 0
        for batch in batches:
            of = numbers(batch, groups)
            for row, raw, offsets in text_chunks(batch.column("text")):
                terms, text, term, n = term_counts(raw, offsets)
                if not len(n):
                    continue
                key, at, docs = np.unique(of[row + text] * len(terms) + term,
                                          return_inverse=True, return_counts=True)
                sums = np.bincount(at, n, len(key)).astype(np.int64)
                held.append(pa.table(
                    [pa.array(key // len(terms)), terms.cast(pa.large_binary()).take(
                        pa.array(key % len(terms))), pa.array(sums),
                     pa.array(docs.astype(np.int64))], ["group", "term", "n", "docs"]))
                rows += len(key)
                if rows > limit:
                    held = [summed(held)]
                    rows = len(held[0])
                    if rows > limit // 2:
                        yield from given(held[0], list(groups))
                        groups, held, rows = {}, [], 0
                        of = numbers(batch, groups)
        if held:
            yield from given(summed(held), list(groups))
    return run


def share(count, total, terms):
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)) of numpy counts.

    A long division in three steps of a thousand: exact below 9 * 10**15 counts.
    """
    below = total + 2 * terms
    out, rest = np.divmod(count + 2, below)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + step
    return out + 1


def share_sql(count, total, terms) -> str:
    """The same as an expression over columns."""
    return (f"1 + ((CAST({count} + 2 AS DECIMAL(20, 0)) * {SCALE}BD) "
            f"div CAST({total} + 2 * {terms} AS DECIMAL(20, 0)))")


def gap(p, q):
    """floor((p - q)**2 / (p + q)); below 10**18 before the division."""
    return (p - q) ** 2 // (p + q)


def _array(table):
    """(term ids, counts) of one side, sorted by id, from its blocks in any order."""
    table = table.filter(pc.is_valid(table["block"])).sort_by("block").combine_chunks()
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, n = (table[c].combine_chunks() for c in ("ids", "n"))
    block = np.repeat(table["block"].to_numpy(), np.diff(ids.offsets.to_numpy()))
    return (block << 32) | ids.flatten().to_numpy(), n.flatten().to_numpy()


def priced(ids_a, n_a, total_a, ids_b, n_b, total_b, terms, kept):
    """The sum of gaps over one slice, of which ``kept`` of the language's ``terms`` terms are.

    The shorter side's ids gallop through the longer side's: the search for a sorted run of ids
    goes on from where the last one ended. Terms on one side only meet the other side's share
    of count 0, and those on neither are all alike.
    """
    if not kept:
        return 0
    if len(ids_a) > len(ids_b):
        ids_a, n_a, total_a, ids_b, n_b, total_b = ids_b, n_b, total_b, ids_a, n_a, total_a
    nothing = np.zeros(1, np.int64)
    zero_a, zero_b = share(nothing, total_a, terms), share(nothing, total_b, terms)
    p, q = share(n_a, total_a, terms), share(n_b, total_b, terms)
    at = np.searchsorted(ids_b, ids_a)
    both = np.zeros(len(ids_a), bool)
    inside = at < len(ids_b)
    both[inside] = ids_b[at[inside]] == ids_a[inside]
    only_b = np.ones(len(ids_b), bool)
    only_b[at[both]] = False
    absent = kept - len(ids_a) - int(only_b.sum())
    return int(gap(p[both], q[at[both]]).sum() + gap(p[~both], zero_b).sum()
               + gap(zero_a, q[only_b]).sum() + absent * gap(zero_a, zero_b)[0])


def _merge(key, left, right):
    """One pair of sources in one slice, seen from both."""
    lang, a, b, _ = (x.as_py() for x in key)
    first = left.slice(0, 1).to_pylist()[0]
    value = priced(*_array(left), first["total_a"], *_array(right), first["total_b"],
                   first["terms"], first["kept"])
    return pa.table([pa.array([lang, lang]), pa.array([a, b]), pa.array([b, a]),
                     pa.array([value, value], pa.int64())], ["lang", "source", "item", "value"])


def kept_cells(documents: DataFrame, lang, source, text, min_docs, cells=CELLS) -> DataFrame:
    """(lang, block, id, term, source, n, of): the counts of kept terms in sources that have them.

    ``id`` numbers the kept terms of a block of a language from 1 in their order; ``of`` is the
    term's count in the whole language.
    """
    named = documents.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                               for n, c in (("lang", lang), ("source", source), ("text", text))])
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(MIN_BLOCKS, -(-size // BLOCK_BYTES))
    counted = (named.mapInArrow(_cells(cells), "lang string, source string, term string, n long, "
                                               "docs long")
               .withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)))
               .repartition("lang", "block")
               .groupBy("lang", "block", "source", "term")
               .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    # The partitioning by block serves the sums, both windows and the order within a block.
    of_term = Window.partitionBy("lang", "block", "term")
    return (counted.withColumn("seen", F.sum("docs").over(of_term))
            .withColumn("of", F.sum("n").over(of_term))
            .where(F.col("seen") >= min_docs)
            .withColumn("id", F.dense_rank().over(
                Window.partitionBy("lang", "block").orderBy("term")))
            .select("lang", "block", "id", "term", "source", "n", "of"))


def divergence(documents: DataFrame, lang="lang", source="source", text="text", min_docs=10,
               top=10, slice_terms=SLICE_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every source of every language.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased. A language keeps
    the terms that at least ``min_docs`` of its documents have. The share of a kept term in a
    source or language is 1 + floor(10**9 * (count + 2) / (N + 2 V)), N being the count of all
    kept terms there and V their number. Part ``pair`` gives for each other source of the
    language the sum of floor((p - q)**2 / (p + q)) over all kept terms; part ``term`` the
    ``top`` kept terms that the source has and that are more frequent there than in the language.
    Ranks go by value, largest first, then by the item's bytes.

    NULL languages, sources and texts count as empty ones. A source without kept terms is
    compared all the same; without any kept term in the language all its pairs have value 0. A
    language of one source has no pairs. Equal rows are documents of their own. An empty table
    gives no rows. Long texts are counted whole; other columns are not looked at.

    A task hands on one row per source and term, so frequent terms and large sources are summed
    before the shuffle; from then on a source is as large as its different terms. The arrays are
    cut into slices of about ``slice_terms`` terms of a language, which bounds what a task merges,
    and are sent once to each of their pairs: the result has a row for each.
    """
    cells = written(kept_cells(documents, lang, source, text, min_docs), "kept-terms")
    named = documents.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                               for n, c in (("lang", lang), ("source", source))])
    blocks = cells.groupBy("lang", "block").agg(F.max("id").cast("long").alias("kept"))
    most = (blocks.groupBy("lang").agg(F.sum("kept").alias("terms"))
            .agg(F.max("terms")).first()[0] or 0)
    slices = max(1, -(-most // slice_terms))
    in_slice = F.pmod("block", F.lit(slices)).alias("slice")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = blocks.groupBy("lang").agg(F.sum("kept").alias("terms"))
    language = totals.groupBy("lang").agg(F.sum("total").alias("of_lang"))
    groups = written(
        named.distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
        .join(language, "lang", "left").na.fill(0, ["total", "terms", "of_lang"]), "sources")

    p, q = share_sql("n", "total", "terms"), share_sql("of", "of_lang", "terms")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    single = (cells.join(groups, ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), F.expr(p).alias("p"),
                      F.expr(q).alias("q")).where("p > q")
              .select("lang", "source", "item",
                      F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
              .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))

    sizes = (groups.groupBy("lang").agg(F.first("terms").alias("terms"))
             .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"),
                                                       F.lit(slices - 1).cast("long"))))
             .join(blocks.groupBy("lang", in_slice).agg(F.sum("kept").alias("kept")),
                   ["lang", "slice"], "left").na.fill(0, ["kept"]))
    one, other = (groups.select("lang", F.col("source").alias(s), F.col("total").alias(f"total_{s}"))
                  for s in "ab")
    pairs = one.join(other, "lang").where("a < b").join(sizes, "lang")
    arrays = written(
        cells.groupBy("lang", "source", "block")
        .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("x"))
        .select("lang", "source", in_slice, "block", F.col("x.id").alias("ids"),
                F.col("x.n").alias("n")), "term-arrays")
    left = pairs.join(arrays.withColumnRenamed("source", "a"), ["lang", "a", "slice"], "left")
    right = pairs.select("lang", "a", "b", "slice").join(
        arrays.withColumnRenamed("source", "b"), ["lang", "b", "slice"])
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own
    on = ["lang", "a", "b", "slice"]
    merged = left.groupBy(on).cogroup(right.groupBy(on)).applyInArrow(
        _merge, "lang string, source string, item string, value long")
    both = (merged.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(best)))
    order = ["lang", "source", "part", "item", "value", "rank"]
    return (both.withColumn("part", F.lit("pair")).select(order)
            .union(single.withColumn("part", F.lit("term")).select(order)))
