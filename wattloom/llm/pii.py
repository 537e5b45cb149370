"""Personal data: fixed patterns, and a skip-chain conditional random field for the rest.

Nodes of a document's field are its pattern matches, whose labels are fixed, and looser
mentions: numbers of seven digits or more, and addresses with a written-out at sign. Successive
nodes form a chain; nodes with the same or a similar key (last seven digits, letters of an
address) are joined by skip edges however far apart they are. Loopy belief propagation carries
labels along both, so that a number written once as a phone number is one wherever it recurs.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import DRAWS, broadcast, drawn_below, opened, texts_of

KINDS = ["email", "ip", "card", "phone"]
LABELS = len(KINDS) + 1  # the last label: nothing
NONE = len(KINDS)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A digit run is entered at its start: if that fails, so do its later digits.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![0-9A-Za-z.+])[0-9(][0-9().\x20/-]{5,}[0-9](?![0-9A-Za-z])")
ADDRESS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?"
                     r"[A-Za-z0-9.-]{1,255}")
DIGIT = re.compile("[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str):
    """Leftmost matches: from each at sign back over its local part, then on over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches, in order of start and kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
                if all(map(_small, m.groups()))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "") if len(m[0]) >= 12 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                    if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


def loose_mentions(text: str, base) -> list[tuple[int, int]]:
    """(start, end) of mentions that only resemble personal data and touch no base span."""
    out = []
    if DIGIT.search(text):
        out += [m.span() for m in NUMBER.finditer(text)
                if 7 <= len(NOT_DIGIT.sub("", m[0])) <= 19]
    if "(at)" in text or "[at]" in text:
        out += [m.span() for m in ADDRESS.finditer(text)]
    taken, free, at = sorted((a, b) for a, _, b in base), [], 0
    last = -1
    for a, b in sorted(out):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a >= last and not (at < len(taken) and taken[at][0] < b):
            free.append((a, b))
            last = b
    return free


FEATURES = 20


def describe(text: str) -> tuple[str, list[int]]:
    """(key of skip edges, features) of a mention."""
    digits = NOT_DIGIT.sub("", text)
    at = "@" in text or "(at)" in text or "[at]" in text
    if at:
        key = re.sub(r"[^a-z0-9@]", "", re.sub(r"[(\[]at[)\]]", "@", text.lower()))
    else:
        key = digits[-7:]
    size = int(np.searchsorted([7, 9, 12, 16, 20], len(digits), "right"))
    marks = [at, "@" in text, text.count(".") == 3, text[:1] == "+", "(" in text, "-" in text,
             " " in text, "/" in text, 12 <= len(digits) <= 19 and luhn(digits),
             any(c.isalpha() for c in text),
             bool(re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text)), text.isdigit()]
    return key, [0, 1 + size, *(7 + i for i, m in enumerate(marks) if m)]


class Field:
    """A document's nodes: spans, fixed labels (NONE where free), features, and edges."""

    def __init__(self, text, base, loose):
        nodes = sorted([(a, b, k) for a, k, b in base] + [(a, b, NONE) for a, b in loose])
        self.spans = [(a, b) for a, b, _ in nodes]
        self.fixed = np.array([k for *_, k in nodes], np.int64)
        self.x = np.zeros((len(nodes), FEATURES))
        last, skip = {}, []
        for i, (a, b, _) in enumerate(nodes):
            key, marks = describe(text[a:b])
            self.x[i, marks] = 1
            if key in last:
                skip.append((last[key], i))
            last[key] = i
        chain = [(i, i + 1) for i in range(len(nodes) - 1)]
        self.edges = np.array(chain + skip, np.int64).reshape(-1, 2)
        self.is_skip = np.arange(len(self.edges)) >= len(chain)


def beliefs(field: Field, model, rounds=30, damping=0.3) -> np.ndarray:
    """Label probabilities of every node by loopy sum-product message passing."""
    weights, chain, skip = model
    own = field.x @ weights
    fixed = np.flatnonzero(field.fixed != NONE)
    own[fixed] = -40.0
    own[fixed, field.fixed[fixed]] = 0.0
    pair = np.where(field.is_skip[:, None, None], skip, chain)
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    source = np.concatenate([field.edges[:, 0], field.edges[:, 1]])
    target = np.concatenate([field.edges[:, 1], field.edges[:, 0]])
    back = np.roll(np.arange(len(source)), len(field.edges))
    messages = np.zeros((len(source), LABELS))

    def gathered():
        total = own.copy()
        np.add.at(total, target, messages)
        return total

    for _ in range(rounds if len(source) else 0):
        out = gathered()[source] - messages[back]
        new = np.logaddexp.reduce(out[:, :, None] + pair, axis=1)
        new -= np.logaddexp.reduce(new, axis=1)[:, None]
        moved = np.abs(new - messages).max()
        messages = damping * messages + (1 - damping) * new
        if moved < 1e-5:
            break
    total = gathered()
    return np.exp(total - np.logaddexp.reduce(total, axis=1)[:, None])


def fit(fields: list[Field], steps=300, rate=0.3, decay=1e-3):
    """(weights, chain, skip) that maximise the pseudo-likelihood of the fields' labels.

    Pattern matches carry their kind, loose mentions NONE; but a loose mention that a skip edge
    joins to a match is of unknown label and is left out. Skip potentials start from agreement.
    """
    weights = np.zeros((FEATURES, LABELS))
    chain, skip = np.zeros((LABELS, LABELS)), 2.0 * np.eye(LABELS)
    if fields:
        sizes = np.array([len(f.fixed) for f in fields])
        base = np.repeat(np.cumsum(sizes) - sizes, [len(f.edges) for f in fields])
        x, y = np.concatenate([f.x for f in fields]), np.concatenate([f.fixed for f in fields])
        edges = np.concatenate([f.edges for f in fields]) + base[:, None]
        kind = np.concatenate([f.is_skip for f in fields])
        mixed = edges[kind & ((y[edges[:, 0]] == NONE) != (y[edges[:, 1]] == NONE))].ravel()
        known = np.ones(len(y), bool)
        known[mixed[y[mixed] == NONE]] = False
        usable = known[edges].all(1)
        (ca, cb), (sa, sb) = edges[usable & ~kind].T, edges[usable & kind].T
        one = np.eye(LABELS)[y]
        squares = [np.full_like(w, 1e-3) for w in (weights, chain, skip)]
        for _ in range(steps):
            logit = x @ weights
            for a, b, w in ((ca, cb, chain), (sa, sb, skip)):
                np.add.at(logit, b, one[a] @ w)
                np.add.at(logit, a, one[b] @ w.T)
            p = np.exp(logit - np.logaddexp.reduce(logit, axis=1)[:, None])
            miss = (one - p) * known[:, None]
            grads = [x.T @ miss, one[ca].T @ miss[cb] + miss[ca].T @ one[cb],
                     one[sa].T @ miss[sb] + miss[sa].T @ one[sb]]
            for w, g, s, start in zip((weights, chain, skip), grads, squares,
                                      (0, 0, 2.0 * np.eye(LABELS))):
                g = g / len(y) - decay * (w - start)
                s += g * g
                w += rate * g / np.sqrt(s) * 0.1
    return weights, chain, skip


def _squeeze(text):
    """The mentions of a text alone, a line each: all that training needs of it."""
    base = base_spans(text)
    spans = [(a, b, k) for a, k, b in base] + [(a, b, NONE) for a, b in loose_mentions(text, base)]
    return [(text[a:b], k) for a, b, k in sorted(spans)]


def _graphs(batches):
    for batch in batches:
        rows = [_squeeze(t) for t in texts_of(batch.column("text"))]
        rows = [r for r in rows if r]
        kind = pa.list_(pa.struct([("t", pa.string()), ("k", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([[{"t": t, "k": k} for t, k in r] for r in rows], kind)], ["nodes"])


def train(documents: DataFrame, text="text", max_docs=20_000):
    """A model fitted to the mentions of at most about ``max_docs`` documents that have any.

    The documents are those whose texts have the smallest hashes among the distinct texts with a
    digit or an at sign; copies of a text count once. The sample bounds the driver's part; scoring
    covers every text.
    """
    some = documents.select(F.col(f"`{text}`").cast("string").alias("text")).where(
        F.col("text").rlike("[0-9@]"))
    key = F.xxhash64("text")
    below = drawn_below(max_docs, some.select(key.alias("h")).distinct().count())
    picked = some.where(F.pmod(key, F.lit(DRAWS)) < below).distinct()
    rows = picked.mapInArrow(_graphs, "nodes array<struct<t string, k int>>").collect()
    fields = []
    for nodes in sorted([(n.t, n.k) for n in r.nodes] for r in rows):
        joined, base, loose, at = "", [], [], 0
        for t, k in nodes:
            (loose.append((at, at + len(t))) if k == NONE else base.append((at, k, at + len(t))))
            joined += t + "\n"
            at += len(t) + 1
        fields.append(Field(joined, base, loose))
    return fit(fields)


def find(text: str, model, least=0.8):
    """(base spans, spans that the field adds), both (start, kind, end) in order."""
    base = base_spans(text)
    loose = loose_mentions(text, base)
    if not loose:
        return base, []
    field = Field(text, base, loose)
    p = beliefs(field, model)
    best = p.argmax(1)
    added = [(a, int(k), b) for (a, b), k, f, q in zip(field.spans, best, field.fixed, p.max(1))
             if f == NONE and k != NONE and q >= least]
    return base, added


def find_pii(documents: DataFrame, model, text="text", keep=("doc_id",), least=0.8) -> DataFrame:
    """``keep``, base and added spans of every row: arrays of struct<kind, start, end>.

    Offsets count code points, end exclusive; spans are in order of start, then kind. NULL and
    empty texts have none. Rows are searched one by one, long texts whole. Other columns of
    ``documents`` are not read; ``keep`` must not hold the names base, added or text.
    """
    if {"base", "added", "text"} & {k.lower() for k in keep}:
        raise ValueError("keep has names of result columns")
    shared = broadcast(documents.sparkSession, model)
    kinds = dict(documents.dtypes)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def named(spans):
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    def run(batches):
        model = opened(shared)
        for batch in batches:
            found = [find(t, model, least) for t in texts_of(batch.column("text"))]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names],
                 pa.array([named(b) for b, _ in found], pa.list_(span)),
                 pa.array([named(a) for _, a in found], pa.list_(span))],
                [*names, "base", "added"])

    spans = "array<struct<kind string, start bigint, end bigint>>"
    return documents.select(*keep, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), f"base {spans}", f"added {spans}"]))


def listing(spans):
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def in_order(spans):
    """Spans by start, then by kind as listed."""
    place = {k: i for i, k in enumerate(KINDS)}
    ranks = F.create_map(*[F.lit(x) for p in place.items() for x in p])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), ranks[s["kind"]].alias("rank"), s["kind"].alias("kind"),
        s["end"].alias("end"))))
    return F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"),
                                                   s["start"].alias("start"),
                                                   s["end"].alias("end")))
