"""Line dedup by site-relative frequency: lines on too many pages of one host go."""

from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import free_name, written

#: Blank lines separate paragraphs and are never boilerplate.
BLANK = r"^[\x20\x09-\x0D]*$"


def lines_of(column):
    return F.split(F.coalesce(column, F.lit("")), "\n", -1)


def _key(line):
    """A line as two hashes, 96 bits together: short enough to shuffle, and no chance hits."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(pages: DataFrame, host="source", text="text", ratio=0.08, min_pages=5) -> DataFrame:
    """(host, lines, n_pages): for every host the keys of its boilerplate lines, if any.

    A line is boilerplate on a host if the pages of the host that contain it, divided by all its
    pages, exceed ``ratio``, and at least ``min_pages`` pages contain it: on a host of few pages
    any line exceeds a small ratio. With 1 the ratio alone decides. As the ratios of all
    lines of a host add up to its mean number of different lines per page, a host has at most
    that number divided by ``ratio`` such lines, however many pages it has.
    """
    each = pages.select(F.col(host).alias("host"), F.filter(
        F.array_distinct(lines_of(F.col(text))), lambda x: ~x.rlike(BLANK)).alias("lines"))
    # A row per line, and one without a line that counts the page: one pass for both counts.
    exploded = each.select("host", F.explode(F.concat(
        F.array(F.lit(None).cast("struct<a:bigint,b:int>")),
        F.transform("lines", _key))).alias("line"))
    counts = exploded.groupBy("host", "line").agg(F.count("*").alias("n"))
    totals = counts.where("line IS NULL").select(F.col("host").alias("h"), F.col("n").alias("of"))
    common = (counts.where((F.col("n") >= min_pages) & F.col("line").isNotNull())
              .join(totals, F.col("host").eqNullSafe(F.col("h")))
              .where(F.col("n") > F.col("of") * F.lit(ratio)))
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"),
                                      F.first("of").alias("n_pages"))


def drop_lines(pages: DataFrame, host="source", text="text", ratio=0.08, min_pages=5,
               removed=None) -> DataFrame:
    """``pages`` with boilerplate lines cut from ``text``; all rows and columns stay.

    Rows of NULL host are one host. NULL text stays NULL and counts as a page without lines. A
    line repeated within a page counts once for it, and all its copies go if it is boilerplate.
    Equal rows are pages of their own. Blank lines stay. A page whose lines all go keeps an
    empty text. An empty table gives an empty one. ``removed`` names a column, added if given,
    with the number of lines cut.

    Lines are counted as hashes, summed before the shuffle. The boilerplate of a host is one
    short array. These are written first, so their size is known: Spark broadcasts them if they
    are small, without a shuffle of the pages, and otherwise joins on the host and splits the
    pages of a large one over tasks.
    """
    common = written(boilerplate(pages, host, text, ratio, min_pages), "boilerplate")
    at, found, kept = (free_name(pages, n) for n in ("host_", "boilerplate_", "kept_"))
    common = common.select(F.col("host").alias(at), F.col("lines").alias(found))
    joined = pages.join(common, F.col(f"`{host}`").eqNullSafe(F.col(at)), "left")
    lines = lines_of(F.col(f"`{text}`"))
    keep = F.filter(lines, lambda x: x.rlike(BLANK) | ~F.array_contains(F.col(found), _key(x)))
    joined = joined.withColumn(kept, F.when(F.col(found).isNotNull(), keep))
    cleaned = F.when(F.col(f"`{text}`").isNull() | F.col(kept).isNull(), F.col(f"`{text}`")
                     ).otherwise(F.array_join(F.col(kept), "\n"))
    columns = [cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns]
    if removed:
        columns.append(F.when(F.col(kept).isNull(), 0).otherwise(
            F.size(lines) - F.size(F.col(kept))).cast("long").alias(removed))
    return joined.select(*columns)
