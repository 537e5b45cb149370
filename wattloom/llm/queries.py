"""The registered queries of the operators, with production parameters, over whole tables."""

import public_tokenizers
from pyspark.sql import functions as F

from wattloom.llm import (bpe, decontaminate, divergence, embedding_dedup, filter_audit, line_dedup,
                          lm_score, ngram_join, packing, pii, quality, substring_dedup, url_filter)
from wattloom.llm.common import crc32_of
from wattloom.plans.standins import table

#: Fixed values of the URL rules.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def op1_quality(spark, sf):
    """Every document's quality score; the fold with remainder 0 is never learnt from."""
    docs = table(spark, sf, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", (F.pmod(crc32_of("doc_id"), F.lit(5)) == 0).alias("held_out"),
                         "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_pii(spark, sf):
    """Personal data in every document: the patterns' spans, and those the field adds."""
    docs = table(spark, sf, "documents")
    found = pii.find_pii(docs, pii.train(docs))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
              for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listing("base"), 256).alias("base_sha256"),
        pii.listing(pii.in_order(F.concat("base", "added"))).alias("spans"))


def op3_url_filter(spark, sf):
    """The rule and verdict of every page's url; urls that no rule fits are allowed."""
    return url_filter.filter_urls(table(spark, sf, "pages"), URL_RULES)


def op4_decontaminate(spark, sf):
    """Words and benchmark items hit in every document by 13-word windows."""
    hits = decontaminate.benchmark_hits(table(spark, sf, "documents"),
                                        table(spark, sf, "benchmark"))
    hit = decontaminate.n_hit()
    return hits.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), hit).alias("contaminated"))


def op5_suffix_array_dedup(spark, sf):
    """What is left of every document without its repeated strings of 400 bytes."""
    cut = substring_dedup.cut_repeats(table(spark, sf, "documents"))
    sizes = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return cut.select(
        "doc_id", "n_bytes", F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
        .alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op6_lm_score(spark, sf):
    """Every document's log10 probability by counts and by the log-bilinear model."""
    return lm_score.score_texts(table(spark, sf, "documents"))


def op7_embedding_dedup(spark, sf):
    """Near copies among all vectors of equal label, and the one of each group that is kept."""
    return embedding_dedup.near_vectors(table(spark, sf, "embeddings"))


def op8_line_dedup(spark, sf):
    """Every document without lines over its source's ratio, and how many lines went."""
    cleaned = line_dedup.drop_lines(table(spark, sf, "documents"), min_pages=1,
                                    removed="n_removed")
    return cleaned.select("doc_id", "source", "text", "n_removed")


def op9_best_fit_packing(spark, sf):
    """All documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def op10_ngram_jaccard(spark, sf):
    """Components of documents whose sets of 3-word shingles have Jaccard 0.9 or more."""
    return ngram_join.similar_sets(table(spark, sf, "documents"), words=3, percent=90)


def op11_source_divergence(spark, sf):
    """How far every source of a language is from the others, and its own most telling terms."""
    return divergence.divergence(table(spark, sf, "documents"))


def op12_filter_interaction(spark, sf):
    """What five filters remove in each of their 120 orders, by source."""
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_bpe(spark, sf):
    """Digests of every document's token ids and of the text that they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode_texts(table(spark, sf, "documents"), path, packed=True)
    return bpe.decode_ids(encoded, path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {q.__name__: q for q in (
    op1_quality, op2_pii, op3_url_filter, op4_decontaminate, op5_suffix_array_dedup, op6_lm_score,
    op7_embedding_dedup, op8_line_dedup, op9_best_fit_packing, op10_ngram_jaccard,
    op11_source_divergence, op12_filter_interaction, op13_bpe)}
