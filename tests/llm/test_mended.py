"""Repeated ids of vectors, added tokens in packed texts, draws, few labels, rules in blocks."""

import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattloom.llm import embedding_dedup, line_dedup, packing, quality, url_filter
from wattloom.llm.common import DRAWS, drawn_below

from . import brute

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_classes_of_one_id_do_not_share_their_counts(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (1, [0.0, 1.0], 1), (1, [0.0, 1.0], 0),
            (2, [0.0, 1.0], 0), (3, [5.0, 0.2], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_vectors(frame.repartition(3)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == [
        (1, 0, 1, True), (1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 1, 1, False),
        (3, 2, 1, False)]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(12, 8))
    rows = [(i, (centers[i % 12] + rng.normal(scale=0.25, size=8)).tolist(), i % 3)
            for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id)
             for r in embedding_dedup.near_vectors(frame).collect()}
    assert found == brute.near_vectors([(i, np.array(x), k) for i, x, k in rows], 0.93)


def test_packed_ids_equal_the_tokenizer_as_it_comes(spark):
    coder = Tokenizer.from_file(VOCABULARY)
    encode = packing.encoder(packing.read_vocabulary(VOCABULARY), packing.read_added(VOCABULARY))
    rng = random.Random(6)
    texts = ["abc<|endoftext|>def", "<|endoftext|><|endoftext|> x", "<|endoftext", ""]
    texts += ["".join(rng.choice(["the ", "  ", "\n", "don't", "é", "日本", "😀", "123", "<|endoftext|>",
                                  "A", "<|", "'ll"]) for _ in range(30)) for _ in range(200)]
    for text in texts:
        assert encode(text) == coder.encode(text, add_special_tokens=False).ids
    frame = spark.createDataFrame(list(enumerate(texts[:4])), "doc_id long, text string")
    packed = {r.doc_id: r.ids for r in packing.pack(frame, VOCABULARY, with_ids=True).collect()}
    assert packed[0] == [39305, 50256, 4299, 2] and packed[3] == [2]


def test_draws_never_round_to_nothing():
    for rows in (10, 30_000, 3 * 10 ** 10, 10 ** 15):
        below = drawn_below(30_000, rows)
        assert 0 < below <= DRAWS and abs(below / DRAWS * rows - min(rows, 30_000)) < 1


def test_few_labels_among_many_rows_are_learnt_from(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(
        F.when(F.col("id") % 2 == 0, "Plain words of text ").otherwise("%%%% ### 11 "),
        F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(100, 120)],
                                   "doc_id long, quality int")
    net = quality.train(docs, labels, max_rows=80)
    scores = {r.doc_id: r.score for r in quality.score(docs, net).collect()}
    assert min(scores[i] for i in range(0, 2000, 2)) > max(scores[i] for i in range(1, 2000, 2))


def test_rules_in_blocks_judge_as_at_once(spark):
    rules = [("allow", "org/"), ("block", "a.org/x/"), ("allow", "a.org/x/y"), ("block", "org/x"),
             ("block", "org/"), ("allow", "b.a.org/"), ("block", "/x")]
    urls = [f"http://{h}{p}" for h in ("org", "a.org", "b.a.org", "c.org", "com")
            for p in ("", "/", "/x", "/x/", "/x/y", "/x/yz?q")] + [None, "none"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    whole, parts = (sorted(map(tuple, url_filter.filter_urls(pages, rules, block_rules=n).collect()),
                           key=lambda r: r[0]) for n in (100, 2))
    assert whole == parts


def test_a_line_on_most_of_few_pages_goes(spark):
    pages = spark.createDataFrame([("h", f"menu\npage {i}") for i in range(4)] + [(
        "g", "menu")], "source string, text string")
    kept = line_dedup.drop_lines(pages, ratio=0.5, min_pages=1).collect()
    assert sorted(r.text for r in kept) == ["", *[f"page {i}" for i in range(4)]]
