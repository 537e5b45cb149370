"""NULLs, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattloom.llm import (decontaminate, embedding_dedup, line_dedup, lm_score, ngram_join,
                          packing, pii, quality, substring_dedup, url_filter)
from wattloom.plans.standins import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = "word " * 60_000
PASSAGE = " ".join(f"w{i}" for i in range(120))
#: Names that the operators use themselves.
CLASH = ["id", "text_", "n", "d1", "k1", "score", "host", "lines", "found", "row", "part", "length",
         "spans", "items", "component", "kept", "base", "rank", "h1", "x", "label", "rep", "Score"]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(1, PASSAGE, "a"), (1, PASSAGE, "a"), (2, PASSAGE + " end", "a"), (3, None, "a"),
            (4, "", None), (5, LONG, None), (None, PASSAGE, "a"), (6, "one two", "b"),
            (7, "one two", "b"), (8, "\0 \ufffd é😀 \n\n\t", "b"), (None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in dict.fromkeys(c.lower() for c in CLASH):
        frame = frame.withColumn(c, F.lit(None).cast("string"))
    return frame.withColumn("lang", F.lit("en"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (5, 0), (6, None), (None, 1), (7, 0), (7, 1)],
                                 "doc_id long, quality int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "one two"), (1, "one two"), (2, None), (None, "w7 w8 w9"),
                                  (3, "")], "item_id long, text string")


def texts(frame):
    return sorted((r.doc_id, r.text) for r in frame.where("doc_id IS NOT NULL").collect())


def test_quality(documents, labels):
    net = quality.train(documents, labels)
    rows = quality.score(documents, net).collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r.score)
    assert by_id[1][0] == by_id[1][1] and by_id[3] == by_id[4]
    assert quality.train(documents, labels.limit(0)) is None
    assert {r.score for r in quality.score(documents, None).collect()} == {0.5}
    kept = quality.drop_low_quality(documents, labels)
    assert kept.columns == documents.columns and kept.count() <= documents.count()
    assert quality.score(documents.limit(0), net).count() == 0
    assert quality.train(documents.limit(0), labels) is None


def test_pii(documents):
    model = pii.train(documents)
    rows = pii.find_pii(documents, model).collect()
    assert len(rows) == documents.count() and all(r.base == r.added == [] for r in rows)
    assert pii.find_pii(documents.limit(0), pii.train(documents.limit(0))).count() == 0
    with pytest.raises(ValueError):
        pii.find_pii(documents, model, keep=("base",))


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Org", "x://a.org?q=/x", "x://B.ORG/p#f",
            "x://a.org/p", "x://a.org/p", "http://Ä.org/é", "x://" + "a." * 5000 + "org/p"]
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)],
                                  "page_id long, url string, host int, rule int")
    rows = {r.page_id: r for r in url_filter.filter_urls(pages, [("block", "org/p")]).collect()}
    assert [(rows[i].host, rows[i].path) for i in range(8)] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("a.org", ""), ("a.org", ""), ("b.org", "/p"),
        ("a.org", "/p")]
    assert [rows[i].verdict for i in range(8)] == ["allow"] * 6 + ["block"] * 2
    assert rows[8].rule == rows[10].rule == "org/p" and rows[9].host == "Ä.org"
    assert url_filter.filter_urls(pages.limit(0), []).count() == 0
    with pytest.raises(ValueError):
        url_filter.filter_urls(pages, [], keep=("host",))
    with pytest.raises(ValueError):
        url_filter.filter_urls(pages, [("deny", "org/")])


def test_decontamination(documents, benchmark):
    rows = decontaminate.benchmark_hits(documents, benchmark).collect()
    assert len(rows) == documents.count()
    found = {r.doc_id: r for r in rows}
    assert found[6]["items"] == ["1"] and found[6].spans == [0, 2] and found[3].n_words == 0
    assert found[2]["items"] == [] and found[2].spans == [7, 10]
    assert found[5].n_words == 60_000 and found[5].spans == []
    clean = decontaminate.drop_contaminated(documents, benchmark)
    assert clean.columns == documents.columns
    assert {r.doc_id for r in clean.collect()} == {1, 2, 3, 4, 5, 8, None}
    assert decontaminate.drop_contaminated(documents, benchmark.limit(0)).count() == 11
    assert decontaminate.drop_contaminated(documents.limit(0), benchmark).count() == 0


def test_substrings(documents):
    rows = substring_dedup.cut_repeats(documents, length=200).collect()
    assert len(rows) == documents.count()
    for r in rows:
        if r.doc_id == 1:
            assert r.spans == [0, len(PASSAGE)] and bytes(r.kept) == b""
        if r.doc_id == 2:
            assert bytes(r.kept) == b" end"
        if r.doc_id == 5:  # the string itself repeats at its own later places
            assert bytes(r.kept) == b""
        if r.doc_id in (3, 4):
            assert (r.n_bytes, r.spans) == (0, [])
    assert substring_dedup.cut_repeats(documents.limit(0)).count() == 0


def test_lm(documents):
    rows = lm_score.score_texts(documents).collect()
    assert len(rows) == documents.count()
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {1}
    assert all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert lm_score.score_texts(documents.limit(0)).count() == 0
    alone = lm_score.score_texts(documents.where("doc_id = 5"), folds=1).collect()[0]
    assert (alone.train_tokens, alone.n_known, alone.base_score) == (0, 0, 0)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0),
            (4, [0.0, 0.0], 0), (5, [nan, 1.0], 0), (6, [None, 1.0], 0), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 1), (9, [inf, 1.0], 0), (10, [1.0], 0), (11, [], 0),
            (None, [1.0, 0.0], 0), (12, [1.0, 0.2], 0)]
    frame = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>,"
                                  " label int, rep int, cell int")
    found = embedding_dedup.near_vectors(frame).collect()
    assert len(found) == len(rows)
    links = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert links[1] == (3, 1, True) and links[2] == (3, 1, False) and links[12] == (3, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert links[i] == (0, i, True)
    assert links[None] == (0, None, True)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_lines(spark):
    pages = spark.createDataFrame(
        [(i, f"menu\nown {i}\n\nmenu", "a") for i in range(20)] + [(20, None, "a"), (21, "", "a")]
        + [(22, "menu", None), (23, "menu\nx", "b")] + [(24, "menu\ny", None)] * 6,
        "doc_id long, text string, source string").withColumn("lines", F.lit(1)).withColumn(
        "host_", F.lit(2)).withColumn("kept_", F.lit(3))
    cleaned = line_dedup.drop_lines(pages, ratio=0.5, removed="gone")
    assert cleaned.columns == [*pages.columns, "gone"]
    rows = {r.doc_id: r for r in cleaned.collect()}
    assert rows[3].text == "own 3\n" and rows[3].gone == 2
    assert rows[20].text is None and rows[21].text == "" and rows[23].text == "menu\nx"
    assert rows[22].text == "" and rows[24].text == "" and cleaned.count() == pages.count()
    assert line_dedup.drop_lines(pages.limit(0)).count() == 0


def test_packing(documents):
    rows = packing.pack(documents, VOCABULARY,
                        with_ids=True).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        assert len(r.ids) == r.length
    assert [r.length for r in pieces[3]] == [1] and [r.length for r in pieces[4]] == [1]
    assert len(pieces[1]) == 2 and sum(r.length for r in pieces[5]) > 60_000
    assert packing.pack(documents.limit(0), VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents, VOCABULARY, keep=("length",))


def test_near_copies(documents):
    rows = ngram_join.similar_sets(documents).collect()
    assert len(rows) == documents.count()
    found = {r.doc_id: r for r in rows}
    assert [found[i].component_id for i in (1, 2, 3, 4, 5, 6, 7)] == [1, 1, 3, 4, 5, 6, 6]
    assert found[3].n_shingles == 0 and found[6].n_shingles == 1 and found[5].n_shingles == 1
    assert found[None].component_id is None
    kept = ngram_join.drop_near_copies(documents)
    assert kept.columns == documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        ["1", "1", "3", "4", "5", "6", "8", "None", "None"])
    assert ngram_join.similar_sets(documents.limit(0)).count() == 0


@pytest.fixture(scope="module")
def folder(spark, documents, labels, benchmark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    documents.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_columns_and_take_anything(spark, documents, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
        "best-fit packing"]
    for docs in (documents, documents.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns and out.count() <= docs.count()
    plain = documents.select("doc_id", "text", "source")
    assert corpus_pipeline.STAGES[-1][1](spark, plain, folder).count() > 0


def test_the_pipeline_is_its_stages(spark, sf):
    docs = table(spark, sf, "documents")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf).cache()
        sizes.append(docs.count())
        assert docs.columns == before.columns
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] >= sizes[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    result = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, result.select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, last.select("doc_id", "piece", "ids_crc32").collect()))
