"""The registered queries and operators against plain versions, on small tables."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattloom.llm import (decontaminate, embedding_dedup, lm_score, ngram_join, packing, pii,
                          quality, substring_dedup, suffix_array, url_filter)
from wattloom.llm.common import components
from wattloom.llm.queries import QUERIES
from wattloom.plans.standins import table

from . import brute

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


# ---- 1 quality -------------------------------------------------------------------------

def test_quality_on_the_held_out_fold(spark, sf):
    sf = sf.replace("0.001", "0.01")
    rows = QUERIES["op1_quality"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows} == {True}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([q == r.predicted for q, r in held]) > 0.95
    good, bad = ([r.score for q, r in held if q == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98


def drawn_first(spark, values):
    """The value that a draw by the smallest hashes takes before the others."""
    frame = spark.createDataFrame([(v,) for v in values], ["v"])
    return frame.orderBy(F.pmod(F.xxhash64("v"), F.lit(1 << 20))).first().v


def test_training_samples_hold_their_bound(spark, monkeypatch):
    """A text, or an id, of most rows does not fill the sample, also if it is drawn."""
    sizes = []
    texts = [f"mail a{i}@b.org" for i in range(200)]
    hot = drawn_first(spark, texts)
    monkeypatch.setattr(pii, "fit", lambda fields: sizes.append(len(fields)))
    pii.train(spark.createDataFrame([(t,) for t in texts + [hot] * 300], "text string"), max_docs=20)
    assert 0 < sizes.pop() <= 40
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    hot = drawn_first(spark, ids)
    monkeypatch.setattr(quality, "fit_nnpu", lambda x, u, prior: sizes.append(len(x)))
    monkeypatch.setattr(quality, "calibrate", lambda *args: None)
    docs = [(i, f"text {i}") for i in ids] + [(hot, f"other text {i}") for i in range(300)]
    quality.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        [(i, 1) for i in ids], "doc_id long, quality int"), max_rows=20)
    assert 0 < sizes.pop() <= 40


def test_negative_risk_is_held_at_zero():
    """On two clouds the fitted output separates them although negatives are never named."""
    rng = np.random.default_rng(0)
    positive, negative = rng.normal(1.5, 1, (600, 4)), rng.normal(-1.5, 1, (600, 4))
    net = quality.fit_nnpu(positive[:200], np.concatenate([positive[200:], negative]), 0.4)
    outputs = [net.forward(net.ready(x))[1] > 0 for x in (positive, negative)]
    assert outputs[0].mean() > 0.9 and outputs[1].mean() < 0.1


# ---- 2 personal data -------------------------------------------------------------------

def test_base_spans_of_the_table(spark, sf, docs):
    rows = {r.doc_id: r for r in QUERIES["op2_pii"](spark, sf).collect()}
    for d, text in docs:
        spans = brute.pii(text)
        listed = ",".join(f"{brute.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert rows[d].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(rows[d].spans.split(",")) | {""}
        assert rows[d].n_phone == sum(k == 3 for _, k, _ in spans)


def test_base_spans_of_random_texts():
    rng = random.Random(4)
    parts = ["a@b.co", "x.y@", "@", "a@b", ".", "+", "-", " ", "(", ")", "1", "12", "255", "256",
             "4111 1111 1111 1111", "+1 (988) 555-2485", "1.2.3.4", "ü", "é9", "a_b@c.d.e_f@g.h",
             "0000000000", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == brute.pii(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " * 60_000, "a@" * 100_000):
        pii.base_spans(text)


def test_field_labels_repeated_mentions_alike():
    texts = [f"call +1 ({n}) 555-{n}1 or 4111111111111111, mail me{n}@mail.com" for n in
             range(200, 260)]
    fields = [pii.Field(t, pii.base_spans(t), pii.loose_mentions(t, pii.base_spans(t)))
              for t in texts]
    model = pii.fit(fields)
    text = "first +1 (988) 555-2485, much later 988-555-2485, but 31-12-19 99 is none"
    base, added = pii.find(text, model)
    assert [(k, text[a:b]) for a, k, b in base] == [(3, "+1 (988) 555-2485")]
    assert [(k, text[a:b]) for a, k, b in added] == [(3, "988-555-2485")]
    text = "ann.lee@mail.com wrote; ann.lee (at) mail.com too"
    assert [(k, text[a:b]) for a, k, b in pii.find(text, model)[1]] == [
        (0, "ann.lee (at) mail.com")]


# ---- 3 urls ----------------------------------------------------------------------------

def test_longest_rule_wins():
    trie = url_filter.build_trie([("allow", "org/"), ("block", "a.org/x/"), ("allow", "a.org/x/y"),
                                  ("block", "a.org/x/"), ("block", "org/x/y/z")])
    judge = url_filter.judge
    assert judge(trie, "b.org", "/x") == ("org/", "allow")
    assert judge(trie, "c.a.org", "/x/1") == ("a.org/x/", "block")
    assert judge(trie, "a.org", "/x/yes") == ("a.org/x/y", "allow")
    assert judge(trie, "a.org", "/xx") == ("org/", "allow")
    assert judge(trie, "borg", "/") == (None, None)
    assert judge(trie, "a.org", "") == (None, None)


# ---- 4 decontamination -----------------------------------------------------------------

def test_windows_in_random_words(spark):
    rng = random.Random(2)
    words = "a b c d".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 5, 6, 9, 0, 6)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block_bytes in (1 << 20, 8):
        rows = decontaminate.benchmark_hits(documents, bench, window=5,
                                            block_bytes=block_bytes).collect()
        for r in rows:
            w, hit, found = texts[r.doc_id].split(), set(), set()
            for k, item in enumerate(items):
                v = item.split()
                m = min(5, len(v))
                for i in range(len(v) - m + 1 if m else 0):
                    for j in range(len(w) - m + 1):
                        if w[j:j + m] == v[i:i + m]:
                            hit.update(range(j, j + m))
                            found.add(str(k))
            at = [x for a, b in zip(r.spans[::2], r.spans[1::2]) for x in range(a, b)]
            assert (r.n_words, at, r["items"]) == (len(w), sorted(hit), sorted(found))


# ---- 5 suffix arrays -------------------------------------------------------------------

def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randint(1, rng.choice([1, 2, 3, 200])) for _ in range(rng.randint(1, 60))] + [0]
        expected = sorted(range(len(s)), key=lambda i: s[i:])
        for level in (0, 1):
            found = suffix_array.suffix_array(np.array(s), 201, level)
            assert found.tolist() == expected
        lcp = suffix_array.permuted_lcp(np.array(s, np.uint8), found, 20)
        for a, b in zip(expected, expected[1:]):
            n = 0
            while n < 20 and max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert lcp[b] == n


def test_repeats_of_the_table(spark, sf, docs):
    rows = {r.doc_id: r for r in QUERIES["op5_suffix_array_dedup"](spark, sf).collect()}
    for (d, text), (n, runs, kept) in zip(docs, brute.repeats([t for _, t in docs], 400)):
        r = rows[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(text.encode()), n, runs, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("crowd", [20, 1000])
def test_repeats_of_a_crowd(spark, monkeypatch, crowd):
    """One passage in many texts, between different neighbours, in shards and string by string."""
    monkeypatch.setattr(substring_dedup, "CROWD", crowd)
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdef ") for _ in range(300))
    texts = ["".join(rng.choice("xyz ") for _ in range(rng.randint(0, 90))) + passage
             + "".join(rng.choice("uvw ") for _ in range(rng.randint(0, 90))) for _ in range(260)]
    texts += texts[:3] + [passage * 3, None, ""]
    rows = substring_dedup.cut_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                       length=200).collect()
    expected = list(brute.repeats(texts, 200))
    for r in rows:
        n, runs, kept = expected[r.doc_id]
        assert (sum(r.spans[1::2]) - sum(r.spans[::2]), len(r.spans) // 2, bytes(r.kept)) == (
            n, runs, kept)


# ---- 6 language model ------------------------------------------------------------------

def test_scores_of_the_table(spark, sf, docs):
    rows = {r.doc_id: r for r in QUERIES["op6_lm_score"](spark, sf).collect()}
    train = [zlib.crc32(str(d).encode()) % 10 != 0 for d, _ in docs]
    expected, total = brute.base_scores([t for _, t in docs], train)
    for (d, _), use, (n, known, base) in zip(docs, train, expected):
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not use, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_tokens_beyond_the_lexicon_are_joined(spark, sf, docs):
    documents = table(spark, sf, "documents")
    small = {r.doc_id: r for r in lm_score.score_texts(documents, lexicon=300, words=50,
                                                       groups=20).collect()}
    expected, _ = brute.base_scores([t for _, t in docs],
                                    [zlib.crc32(str(d).encode()) % 10 != 0 for d, _ in docs])
    for (d, _), (n, known, base) in zip(docs, expected):
        assert small[d].base_score == pytest.approx(base, rel=1e-9) and small[d].n_known == known


def test_probabilities_add_up_to_one():
    net = lm_score.LogBilinear(30, 8, np.arange(30.0))
    rng = np.random.default_rng(1)
    for _ in range(50):
        x = rng.integers(0, 30, 500)
        net.step(x[:-2], x[1:-1], x[2:], rng)
    a, b, z = net.tables()
    for first, second in ((0, 0), (3, 29), (17, 5)):
        assert np.exp(a[first] + b[second] - z[first, second]).sum() == pytest.approx(1, abs=1e-4)


def test_words_of_one_ending_are_told_apart_by_their_context(spark):
    """Words beyond the most frequent 895 have vectors, and so have they as context."""
    rng = random.Random(3)
    common = " ".join(f"f{i}" for i in range(1000))
    pairs = [(f"l{i}", f"w{i}zz") for i in range(40)]
    docs = [(2 * i, common) for i in range(30)]
    docs += [(100_000 + i, " ".join(f"{a} {b}" for a, b in rng.sample(pairs, 20)))
             for i in range(50)]
    right = " ".join(f"{a} {b}" for a, b in pairs)
    wrong = " ".join(f"{a} {pairs[i - 7][1]}" for i, (a, _) in enumerate(pairs))
    held = [i for i in range(1000) if zlib.crc32(str(-i).encode()) % 10 == 0][:2]
    docs += [(-held[0], right), (-held[1], wrong)]
    rows = {r.doc_id: r for r in lm_score.score_texts(spark.createDataFrame(
        docs, "doc_id long, text string").coalesce(1), batch_tokens=256).collect()}
    a, b = rows[-held[0]], rows[-held[1]]
    assert a.held_out and b.held_out and a.base_score == pytest.approx(b.base_score)
    assert a.score > b.score + 4


def test_scores_do_not_depend_on_partitions(spark, sf):
    documents = table(spark, sf, "documents")
    one, many = ({r.doc_id: r.score for r in lm_score.score_texts(
        documents.repartition(n), batch_tokens=512, task_tokens=6000).collect()} for n in (1, 7))
    assert one == pytest.approx(many, rel=1e-4)


def test_training_deepens_with_the_corpus():
    assert lm_score._plan(10, 1000, 8) == (1, 1)
    plans = [lm_score._plan(n * 1000, 1000, 8) for n in (4, 64, 1000)]
    assert plans == [(2, 2), (8, 8), (125, 8)]


def test_a_tree_of_several_depths_adds_up_to_one():
    rng = np.random.default_rng(1)
    net = lm_score.LogBilinear(5000, 8, np.arange(5000.0)[::-1])
    for _ in range(20):
        x = rng.integers(0, 5000, 500)
        net.step(x[:-2], x[1:-1], x[2:], rng)
    net.ready()
    for first, second in ((0, 0), (3, 4999), (700, 5)):
        logs = net.logs(np.full(5000, first), np.full(5000, second), np.arange(5000))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


# ---- 7 embeddings ----------------------------------------------------------------------

@pytest.mark.parametrize("cell_rows", [4096, 40])
def test_links_of_vectors(spark, sf, cell_rows):
    rows = [(r.vec_id, np.array(r.embedding, float), r.label)
            for r in table(spark, sf, "embeddings").collect()]
    rng = np.random.default_rng(5)
    rows += [(10_000 + i, rows[i % 7][1] + rng.normal(0, 0.03, len(rows[0][1])), rows[i % 7][2])
             for i in range(120)]
    frame = spark.createDataFrame([(i, x.tolist(), k) for i, x, k in rows],
                                  "vec_id long, embedding array<double>, label int")
    expected = brute.near_vectors(rows, 0.93)
    for r in embedding_dedup.near_vectors(frame, cell_rows=cell_rows).collect():
        assert (r.n_links, r.component_id) == expected[r.vec_id]
        assert r.kept == (r.vec_id == r.component_id)


# ---- 9 packing -------------------------------------------------------------------------

def test_pieces_of_the_table(spark, sf, docs):
    coder = Tokenizer.from_file(VOCABULARY)
    rows = QUERIES["op9_best_fit_packing"](spark, sf).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for d, text in docs:
        ids = np.array([*coder.encode(text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for n, r in enumerate(sorted(by_doc[d], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at)
            assert r.length == 1024 or n == 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_sequence) <= 1.02 * sum(r.length for r in rows) / 1024 + 1


def test_encoder_equals_the_tokenizer():
    coder = Tokenizer.from_file(VOCABULARY)
    coder.encode_special_tokens = True
    encode = packing.encoder(packing.read_vocabulary(VOCABULARY))
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice(["the ", "  ", "\n", "don't", "é", "日本", "😀", "123", "!?", "\t",
                                   "<|endoftext|>", "A", "​", "'ll"]) for _ in range(30))
        assert encode(text) == coder.encode(text, add_special_tokens=False).ids


def test_packing_of_counts():
    rng = random.Random(7)
    for _ in range(60):
        counts = {n: rng.randint(1, 50) for n in rng.sample(range(1, 101), rng.randint(1, 60))}
        runs, used = packing.pack_counts(dict(counts), 100)
        room, seen = {}, {}
        for length, rank, many, first, offset in runs:
            for i in range(many):
                room.setdefault(first + i, []).append((offset, length))
                seen.setdefault(length, []).append(rank + i)
        assert {n: sorted(r) for n, r in seen.items()} == {n: list(range(c))
                                                           for n, c in counts.items()}
        assert set(room) == set(range(used))
        for pieces in room.values():
            at = 0
            assert sum(3 * n > 100 for _, n in pieces) <= 2
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            assert at <= 100


# ---- 10 near copies --------------------------------------------------------------------

@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (2, 50)])
def test_near_copies_of_the_table(spark, sf, docs, words, percent):
    expected = brute.near_sets(docs, words, percent)
    for r in ngram_join.similar_sets(table(spark, sf, "documents"), words=words,
                                     percent=percent).collect():
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_the_null_character_is_part_of_words(spark):
    texts = ["a\0b", "a b", "\0", "x \0 y z", "x y z", "p q\0 r s t", "p q\0 r s t u", "p q r s t"]
    docs = list(enumerate(texts))
    expected = brute.near_sets(docs, 3, 60)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for r in ngram_join.similar_sets(frame, words=3, percent=60).collect():
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_near_copies_of_a_repeated_id_go_row_by_row(spark):
    base = [f"w{i}" for i in range(60)]
    copy, other = " ".join(base), " ".join(f"v{i}" for i in range(60))
    docs = [(1, copy), (2, copy + " end"), (2, other), (3, other + " x"), (1, copy + " more"),
            (4, "alone in the world of words"), (4, ""), (4, None)]
    rows = [tuple(r) for r in ngram_join.drop_near_copies(spark.createDataFrame(
        docs, "doc_id long, text string"), words=3).collect()]
    assert len([r for r in rows if r[0] == 1]) == 1 and (2, copy + " end") not in rows
    assert [r for r in rows if r[0] in (2, 3)] == [(2, other)]
    assert len([r for r in rows if r[0] == 4]) == 3


@pytest.mark.parametrize("small", [128, 4])
def test_near_copies_of_a_large_group(spark, monkeypatch, small):
    """Chains of edits: groups whose members are not all alike, in one task and in many."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(8)
    docs, text = [], [rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(60)]
    for i in range(150):
        if i % 40 == 0:
            text = [rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(60)]
        text = list(text)
        text[rng.randrange(60)] = f"x{rng.randint(0, 999)}"
        docs.append((i * 7 % 150, " ".join(text)))
    expected = brute.near_sets(docs, 3, 80)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for r in ngram_join.similar_sets(frame, words=3, percent=80).collect():
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_members_of_tiles_that_are_together_are_not_joined(spark, monkeypatch):
    """A large group of near copies meets in many tiles; once together, none is looked at again."""
    rng, stored, keep = random.Random(3), [], ngram_join.written
    base = [f"w{i}" for i in range(80)]
    docs = []
    for i in range(160):
        text = list(base)
        text[rng.randrange(80)] = f"x{i}"
        docs.append((i, " ".join(text)))

    def noted(df, name):
        out = keep(df, name)
        stored.append((name, out))
        return out
    monkeypatch.setattr(ngram_join, "written", noted)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = ngram_join.similar_sets(frame, words=3, percent=80).collect()
    expected = brute.near_sets(docs, 3, 80)
    assert all((r.n_shingles, r.component_id) == expected[r.doc_id] for r in found)
    assert [df.count() for name, df in stored if name == "members"] == [0]
    assert max(df.count() for name, df in stored if name == "tiles") > 160 * 5


def test_sets_outside_of_a_large_part_meet_it_once(spark, monkeypatch):
    """Near copies about the threshold and strangers with a common passage meet in many tiles."""
    monkeypatch.setattr(ngram_join, "SMALL", 16)
    rng, stored, keep = random.Random(5), [], ngram_join.written
    base, docs = [f"w{i}" for i in range(120)], []
    for i in range(150):
        text = list(base)
        for j in range(rng.choice([1, 3, 4, 5])):
            text[rng.randrange(120)] = f"x{i}y{j}"
        docs.append((i, " ".join(text)))
    for i in range(150, 200):
        docs.append((i, " ".join(base[:80] + [f"s{i}z{j}" for j in range(40)])))

    def noted(df, name):
        out = keep(df, name)
        stored.append((name, out))
        return out
    monkeypatch.setattr(ngram_join, "written", noted)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = ngram_join.similar_sets(frame, words=3, percent=80).collect()
    expected = brute.near_sets(docs, 3, 80)
    assert all((r.n_shingles, r.component_id) == expected[r.doc_id] for r in found)
    links = [df.count() for name, df in stored if name == "links"]
    assert sum(links) <= 2 * len(docs), links


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    union = brute.Union({x for e in edges for x in e})
    for a, b in edges:
        union.join(a, b)
    frame = spark.createDataFrame(edges, "x long, y long").repartition(7)
    found = {r.node: r.component for r in components(frame).collect()}
    for node in union.parent:
        assert found.get(node, node) == union.root(node)
