"""Filter interaction audit: what each filter removes in every order of applying all of them.

A document counts only by the set of filters it fails, its mask. Per part there are at most
2**filters masks, so the orders are played through on counts of masks, with SQL folds alone.
"""

from itertools import permutations

from pyspark.sql import DataFrame, Window, functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: The filter that the texts of other documents decide; it is applied to every text.
COPY = "E"
LOSSES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(text):
    """Failure conditions of a text by filter, as columns (fixed values)."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.size(words)
    return {"A": n < 200,
            "B": F.size(F.array_distinct(words)) * 100 < n * 50,
            "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 2,
            "D": text.rlike("[#$%&*|]")}


def masked(documents: DataFrame, labels: DataFrame, filters=text_filters, id="doc_id",
           text="text", part="source", label_id="doc_id", good="quality", toxic="toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters they fail, as bits.

    Bit i is the i-th filter, and the last bit that of copies: a text fails it if a smaller id
    has the same text anywhere. Equal texts fail the same other filters, so copies are counted
    and never joined: per text, part and label there is one row with its count and smallest id,
    summed before the shuffle, and the smallest id of a text is a minimum over those rows.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    plain = documents.select(
        F.col(f"`{id}`").alias("id"), body.alias("text"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(
        filters(F.col("text")).values())), F.lit(0))
    # Rows without id are spread by their text; they match no label.
    rows = (plain.select("id", "part", mask.alias("mask"),
                         F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
            .withColumn("at", F.when(F.col("id").isNull(), F.xxhash64("key")).otherwise(0)))
    marks = (labels.where(F.col(f"`{label_id}`").isNotNull())
             .groupBy(F.col(f"`{label_id}`").alias("id"))
             .agg(F.max(F.col(f"`{good}`") == 1).alias("good"),
                  F.max(F.col(f"`{toxic}`") == 1).alias("toxic"))
             .withColumn("at", F.lit(0).cast("long")))
    rows = rows.join(marks, ["id", "at"], "left").na.fill(False, ["good", "toxic"])
    kind = ["key", "part", "good", "toxic", "mask"]
    each = rows.groupBy("id", "at", *kind).agg(F.count("*").alias("n"))
    copies = each.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("least").over(Window.partitionBy("key"))
    passed = F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("at_least")
                                        ).otherwise(0)
    bit = 1 << len(filters(F.col("text")))
    split = copies.withColumn("first", first).withColumn("passed", passed).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("passed").alias("n")),
            F.struct((F.col("mask") + bit).alias("mask"),
                     (F.col("n") - F.col("passed")).alias("n")))).alias("x"))
    return split.where("x.n > 0").groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic"))


def played(cell, orders):
    """The steps of all orders for one cell of documents, as one array of structs.

    ``orders`` is an array of arrays of filter numbers. A fold goes through an order with whether
    the cell is still there; a step's numbers are the cell's counts where they apply.
    """
    nothing = F.lit(0).cast("long")

    def step(state, number):
        fails = F.getbit(cell["mask"], number) == 1
        here = state["there"]
        alone = cell["mask"] == F.call_function("shiftleft", F.lit(1), number)
        count = lambda when, what="n": F.when(when, cell[what]).otherwise(nothing)
        numbers = F.struct(
            number.alias("filter"), count(here & ~fails).alias("kept"),
            count(here & fails).alias("removed"), count(~here & fails).alias("redundant"),
            count(alone).alias("unique_fails"), count(here & fails, "good").alias("good_lost"),
            count(here & fails, "toxic").alias("toxic_lost"))
        return F.struct((here & ~fails).alias("there"),
                        F.concat(state["steps"], F.array(numbers)).alias("steps"))

    kind = "array<struct<filter:int," + ",".join(f"{c}:bigint" for c in LOSSES) + ">>"
    start = F.struct(F.lit(True).alias("there"), F.array().cast(kind).alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(
        order, start, step, lambda state: state["steps"])))


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, ...): every step of every order, from counts of masks.

    The orders are one constant array, 120 of five filters. Each cell of a part is played
    through all of them, and the arrays of its cells, at most 2**filters, are added element by
    element. Parts are independent of each other.
    """
    every = list(permutations(range(len(letters))))
    orders = F.array(*[F.array(*[F.lit(i) for i in order]) for order in every])
    names = F.array(*[F.lit("".join(letters[i] for i in order)) for order in every])
    one = F.struct(F.lit(0).alias("mask"), *[F.lit(0).cast("long").alias(c)
                                             for c in ("n", "good", "toxic")])

    def add(x, y):
        return F.struct(x["filter"].alias("filter"), *[(x[c] + y[c]).alias(c) for c in LOSSES])

    of_part = cells.groupBy("part").agg(F.collect_list(
        F.struct("mask", "n", "good", "toxic")).alias("cells")).withColumn("orders", orders)
    steps = of_part.select("part", "orders", F.aggregate(
        "cells", played(one, F.col("orders")), lambda total, cell: F.zip_with(
            total, played(cell, F.col("orders")), add)).alias("steps"))
    removed = steps.withColumn("shapley", F.transform(
        F.sequence(F.lit(0), F.lit(len(letters) - 1)), lambda f: F.aggregate(
            "steps", F.lit(0).cast("long"), lambda a, x: a + F.when(x["filter"] == f, x["removed"]
                                                                    ).otherwise(0))))
    return removed.select("part", "shapley", F.posexplode("steps").alias("at", "x")).select(
        "part", F.get(names, F.floor(F.col("at") / len(letters)).cast("int")).alias("filter_order"),
        (F.col("at") % len(letters) + 1).alias("step"), *[F.col(f"x.{c}").alias(c) for c in LOSSES],
        F.get("shapley", F.col("x.filter")).alias("shapley"))


def audit(documents: DataFrame, labels: DataFrame, filters=text_filters, **options) -> DataFrame:
    """Per part, order and step: documents kept, removed, redundant, failing this filter only,
    good and toxic ones lost, and the filter's removals summed over all orders.

    NULL texts are empty texts, and a NULL part is the empty one. A text is a copy if a smaller
    id has the same text in any part; rows of the same id are no copies of each other, and rows
    without id are never copies nor make others so. Equal rows count each. A document is good, or
    toxic, if any row of its id in ``labels`` says 1. An empty table gives no rows. Names of
    other columns do not matter.
    """
    letters = "".join(filters(F.lit(""))) + COPY
    return interactions(masked(documents, labels, filters, **options), letters)
