"""A training corpus from raw documents: five stages, each one of the package's operators.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all
but the last return the columns of ``docs``. Rows are judged by ``text``; ``source`` is the host
of line dedup, ``doc_id`` the id of near copies and labels.
"""

import public_tokenizers

from wattloom.llm import decontaminate, line_dedup, ngram_join, packing, quality
from wattloom.plans.standins import table
from wattloom.session import written


def quality_classifier(spark, docs, sf_dir):
    """Rows that the positive-unlabelled classifier scores at 0.3 or more.

    It learns from the documents at hand; NULL and empty texts are scored as empty ones.
    """
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def boilerplate_lines(spark, docs, sf_dir):
    """All rows, without lines that more than 8 % of their source's pages, and five, contain.

    Without the five, a source of a dozen pages would lose every line of clean documents.
    """
    return line_dedup.drop_lines(docs, min_pages=5)


def near_copies(spark, docs, sf_dir):
    """One row of each group of near copies: 5-word shingles, Jaccard 0.8 or more.

    Rows without words or id are no copies of each other and stay.
    """
    return ngram_join.drop_near_copies(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Rows of which less than a twentieth of the words lie in benchmark windows."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark, docs, sf_dir):
    """Pieces of at most 1024 tokens, with their ids and places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [("quality classifier", quality_classifier), ("line dedup", boilerplate_lines),
          ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", benchmark_decontamination),
          ("best-fit packing", best_fit_packing)]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages in order over ``documents``, each written to the shared folder and read."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
