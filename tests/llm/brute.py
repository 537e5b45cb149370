"""Plain versions of the operators, for small inputs."""

import math
import re
from collections import Counter, defaultdict

import numpy as np

SPACE = re.compile("[\x20\x09-\x0d]+")
KINDS = ["email", "ip", "card", "phone"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return [w for w in SPACE.split(lower(text)) if w]


class Union:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def near_sets(docs, words, percent):
    """{id: (set size, component)} of (id, text) pairs with distinct ids."""
    sets = {}
    for d, text in docs:
        w = space_words(text)
        grams = [tuple(w[i:i + words]) for i in range(len(w) - words + 1)]
        sets[d] = set(grams) if grams else {tuple(w)} if w else set()
    union, of = Union(sets), defaultdict(list)
    for d, s in sets.items():
        shared = Counter(o for g in s for o in of[g])
        for g in s:
            of[g].append(d)
        for o, common in shared.items():
            if 100 * common >= percent * (len(s) + len(sets[o]) - common):
                union.join(d, o)
    return {d: (len(s), union.root(d)) for d, s in sets.items()}


def repeats(texts, length):
    """(removed, runs, kept bytes) of every text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        yield int(gone.sum()), runs, bytes(x for x, g in zip(b, gone) if not g)


def base_scores(texts, train):
    """(tokens, known, score) of every text, and the number of training tokens."""
    tokens = [[*space_words(t), "\n"] for t in texts]
    counts = Counter(w for t, use in zip(tokens, train) if use for w in t)
    total = sum(counts.values())
    below = total + 0.1 * (len(counts) + 1)
    return [(len(t), sum(counts[w] > 0 for w in t),
             sum(math.log10((counts[w] + 0.1) / below) for w in t)) for t in tokens], total


def near_vectors(rows, threshold):
    """{id: (links, component)} of (id, vector, label) rows that are all usable."""
    links, union = Counter(), Union([r[0] for r in rows])
    for i, (a, x, p) in enumerate(rows):
        for b, y, q in rows[:i]:
            if p == q and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                union.join(a, b)
    return {r[0]: (links[r[0]], union.root(r[0])) for r in rows}
