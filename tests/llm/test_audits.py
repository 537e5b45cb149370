"""Divergence, filter interaction and byte-pair coding: plain versions and odd input."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattloom.llm import bpe, divergence, filter_audit
from wattloom.llm.queries import QUERIES
from wattloom.plans.standins import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CLASH = ["term", "n", "docs", "block", "id", "part", "item", "mask", "key", "at", "good", "cells",
         "orders", "ids", "decoded", "Rank", "kept", "total", "slice"]


def crowded(frame):
    for c in CLASH:
        if c.lower() not in map(str.lower, frame.columns):
            frame = frame.withColumn(c, F.lit(1))
    return frame


# ---- 11 source divergence ----------------------------------------------------------------

def plain_divergence(rows, min_docs, top):
    """{(lang, source, part, item): (value, rank)} of (lang, source, text) rows."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = {}
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(c):
            below = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // below for t in kept}
        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in sources - {s}}
            term = {t: f(p[s][t], q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]}
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(ranked[:top if part == "term" else None], 1):
                    out[lang, s, part, item] = value, rank
    return out


def found_divergence(frame, **options):
    return {(r.lang, r.source, r.part, r.item): (r.value, r["rank"])
            for r in divergence.divergence(frame, **options).collect()}


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(5)
    words = [f"w{c}{d}" for c in "abcdefgh" for d in "xyzäÖß日"]
    rows = [(rng.choice(["en", "de"]), rng.choice("abc"), " 1".join(
        rng.choices(words[i % 5:i % 20 + 20], k=rng.randrange(60)))) for i in range(120)]
    rows += [("en", "a", "THE the The_the-thé")] * 40 + [("en", "void", None), ("en", "", "?!"),
             (None, None, "one two"), ("fr", "x", ""), ("fr", "y", "seul"), ("it", "z", "solo")]
    return rows + [("de", "b", "lang " * 30_000)]


@pytest.mark.parametrize("min_docs, slice_terms", [(3, 1 << 18), (1, 7), (1000, 5)])
def test_divergence(spark, sources, min_docs, slice_terms):
    frame = crowded(spark.createDataFrame(sources, "lang string, source string, text string"))
    expected = plain_divergence(sources, min_docs, 4)
    assert found_divergence(frame, min_docs=min_docs, top=4, slice_terms=slice_terms) == expected
    if min_docs == 1:
        # A language's only source has no other, and no term more often than the language.
        assert not {("it", "z"), ("", "")} & {k[:2] for k in expected}
    if min_docs == 1000:
        assert {v[0] for v in expected.values()} == {0}
    assert found_divergence(frame.limit(0)) == {}


def test_cells_are_the_same_however_often_a_task_hands_them_on(spark, sources):
    frame = spark.createDataFrame(sources, "lang string, source string, text string").coalesce(1)
    pick = lambda limit: sorted(map(tuple, divergence.kept_cells(
        frame, "lang", "source", "text", 2, limit).collect()))
    assert pick(10) == pick(1 << 20)


def test_shares_are_exact_for_huge_counts():
    for count, total, terms in [(0, 0, 1), (10 ** 13, 3 * 10 ** 13, 10 ** 9), (7, 7, 1)]:
        got = divergence.share(np.array([count], np.int64), total, terms)
        assert got[0] == 1 + 10 ** 9 * (count + 2) // (total + 2 * terms)


# ---- 12 filter interaction ---------------------------------------------------------------

def plain_audit(docs, labels):
    """{(part, order, step): numbers} of (id, source, text) rows and (id, quality, toxic) rows."""
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    first = {}
    for i, _, text in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    kinds = defaultdict(list)
    for i, source, text in docs:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        kinds[source or ""].append((i, {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and first[text] < i}))
    out = {}
    for part, members in kinds.items():
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                gone = [m for m in left if m[1][x]]
                fails = [m for m in members if m[1][x]]
                total[x] += len(gone)
                left = [m for m in left if not m[1][x]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(fails) - len(gone),
                    sum(sum(m[1].values()) == 1 for m in fails), sum(m[0] in good for m in gone),
                    sum(m[0] in toxic for m in gone)]
        for (p, order, step), numbers in out.items():
            if p == part:
                numbers.append(total[order[step - 1]])
    return out


def test_filter_audit(spark):
    many = " ".join(f"w{i}" for i in range(250))
    docs = [(1, "a", many), (2, "a", many), (3, "b", many), (3, "b", many), (4, "b", None),
            (5, "b", ""), (6, None, "X" * 50), (7, "", "a # b"), (None, "a", many),
            (None, "c", "word " * 300), (8, "c", "word " * 300), (9, "c", "word " * 60_000),
            (10, "c", "É\x0bé \0 %"), (11, "a", many + " END"), (0, "d", many)]
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 0), (None, 1, 1), (7, None, 1), (6, 0, None)]
    frame = crowded(spark.createDataFrame(docs, "doc_id long, source string, text string"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn(
        "source", F.lit("x"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = {(r.part, r.filter_order, r.step): [r[n] for n in names]
             for r in filter_audit.audit(frame, marks).collect()}
    assert found == plain_audit(docs, labels)
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    assert filter_audit.audit(frame, marks.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_audit_of_other_filters(spark):
    """Any number of filters can be audited; a single one has one order beside the copies."""
    frame = spark.createDataFrame([(1, "a", "x"), (2, "a", "xy")], "doc_id long, source string, "
                                  "text string")
    marks = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(frame, marks, lambda t: {"L": F.length(t) < 2}).collect()
    assert {r.filter_order for r in rows} == {"LE", "EL"} and len(rows) == 4
    assert {(r.removed, r.good_lost) for r in rows if r.filter_order[r.step - 1] == "L"} == {(1, 1)}


# ---- 13 byte-pair coding -----------------------------------------------------------------

@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.Vocabulary(VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def odd_texts():
    rng = random.Random(1)
    pool = "aàáâ AbBcC'’sSt<|>endoftext0123 \t\ń̀ͅΣσςßſİıÅÅ각日本\U0001f600‍.,!?-_"
    texts = ["", "  ", "abc<|endoftext|>DEF", "<|endoftext|><|startoftext|> x", "<|EndOfText|>",
             "ΣΑΣ ὈΔΥΣΣΕΎΣ. İstanbul ǅ", "don't we'll 'S I'M ''s", "\x1c\x1d\x85  x　y​",
             "\0a\0", "a" * 3001, "Ᲊ \U0003d000x a՘b <|endoftext|>՘", "ha" * 5000,
             "한국어 日本語の文字列 ไทย عربى हिन्दी 👩‍👩‍👧", "½²³①१२३४५ Ⅷ",
             "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30_000))]
    texts += ["".join(rng.choices(pool, k=rng.randrange(40))) for _ in range(1500)]
    return texts + ["".join(chr(rng.choice([rng.randrange(0x20, 0xd800), rng.randrange(0xe000, 0x30000)]))
                            for _ in range(rng.randrange(30))) for _ in range(1500)]


def test_ids_equal_the_library(coder, library):
    texts = odd_texts()
    ids, sizes = coder.encode(texts)
    mine = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    other = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert mine == other
    assert [coder.decode(x) for x in mine] == [library.decode(x, skip_special_tokens=False)
                                               for x in other]


def test_every_character(coder, library):
    texts = [f"a{chr(c)}1{chr(c)}-" for c in range(0x110000) if not 0xd800 <= c < 0xe000][::7]
    ids, sizes = coder.encode(texts)
    mine = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert mine == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_runs_and_memory_do_not_change_ids(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "RUN_CHARS", 7)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 20)
    small = bpe.Coder(coder.v)
    for text in odd_texts()[:200]:
        assert small.encode([text])[0].tolist() == library.encode(
            text, add_special_tokens=False).ids


def test_pairs_out_of_order_are_merged_one_by_one(coder):
    """A vocabulary whose later pairs make earlier pairs' parts gives the left-to-right result."""
    class Odd:
        inner = last = np.arange(256, dtype=np.int32)
        joined = np.ones((256, 256), bool)
        ordered = False
        added = {}
        keys = np.array([(97 << 32) | 98, (300 << 32) | 97])  # ab -> 300, 300 a -> 301
        rank_of = np.array([1, 0], np.int32)
        made = np.array([301, 300], np.int32)
    odd = bpe.Coder.__new__(bpe.Coder)
    odd.v = Odd()
    symbols, sizes = odd.merge(["ababab"])
    assert symbols.tolist() == [301, 98, 300] and sizes.tolist() == [3]


def test_query_and_edges(spark, sf, library):
    rows = {r.doc_id: r for r in QUERIES["op13_bpe"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert tuple(rows[d.doc_id])[1:] == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())
    frame = crowded(spark.createDataFrame(
        [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "word " * 50_000)],
        "doc_id long, text string"))
    plain = bpe.encode_texts(frame, VOCABULARY, keep=("doc_id", "mask"))
    back = bpe.decode_ids(plain, VOCABULARY, keep=("doc_id",)).collect()
    assert sorted((str(r.doc_id), len(r["ids"])) for r in back) == [
        ("1", 0), ("2", 0), ("3", 2), ("3", 2), ("None", 50_000)]
    assert {r.decoded for r in back if r.doc_id == 3} == {"a</w> b</w>"}
    assert bpe.encode_texts(frame.limit(0), VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_texts(frame, VOCABULARY, keep=("ids",))
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
