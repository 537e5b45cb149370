"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The first level has a byte alphabet: a bucket at a time is induced, all its suffixes at once.
Deeper levels have about a third of the symbols each, of a large alphabet, and are induced one
by one.
"""

import numpy as np


def s_types(s) -> np.ndarray:
    """Which suffixes are smaller than the next one (type S). The last symbol is the smallest."""
    step = np.sign(np.diff(s.astype(np.int64)))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(len(s), bool)
    out[:-1] = np.append(step, 1)[nxt] > 0
    return out


def leftmost_s(types) -> np.ndarray:
    """Places of S suffixes right after an L suffix."""
    return np.flatnonzero(types[1:] & ~types[:-1]) + 1


def _bounds(s, size):
    ends = np.cumsum(np.bincount(s, minlength=size))
    return np.append(0, ends[:-1]), ends


def _induce_bytes(s, types, order, size):
    """All suffixes, from S-leftmost ones in ``order``, bucket by bucket."""
    starts, ends = _bounds(s, size)
    sa = np.full(len(s), -1, np.int64)
    marks = s[order]
    by = np.argsort(marks, kind="stable")
    count = np.bincount(marks, minlength=size)
    tails = ends - count
    sa[np.repeat(tails - np.cumsum(count) + count, count) + np.arange(len(order))] = order[by]

    def spread(pred, fill, up):
        """Puts suffixes into their buckets in the order given, up or down from ``fill``."""
        c = s[pred]
        by = np.argsort(c, kind="stable")
        count = np.bincount(c, minlength=size)
        within = np.arange(len(pred)) - np.repeat(np.cumsum(count) - count, count)
        place = np.repeat(fill, count) + (within if up else -within)
        sa[place] = pred[by]
        fill += count if up else -count

    present = np.flatnonzero(ends > starts)
    heads = starts.copy()
    for c in present:
        low = starts[c]
        while low < heads[c]:
            high = heads[c]
            wave = sa[low:high]
            low = high
            pred = wave[wave > 0] - 1
            spread(pred[~types[pred]], heads, True)
        wave = sa[tails[c]:ends[c]]
        pred = wave[wave > 0] - 1
        spread(pred[~types[pred]], heads, True)
    # The S suffixes anew, from the right; a bucket's L suffixes end where its head stopped.
    fill = ends - 1
    for c in present[::-1]:
        high = ends[c] - 1
        while high > fill[c]:
            low = fill[c]
            wave = sa[low + 1:high + 1][::-1]
            high = low
            pred = wave[wave > 0] - 1
            spread(pred[types[pred]], fill, False)
        wave = sa[starts[c]:heads[c]][::-1]
        pred = wave[wave > 0] - 1
        spread(pred[types[pred]], fill, False)
    sa[0] = len(s) - 1
    return sa


def _induce_list(s, types, order, size):
    """The same, suffix by suffix, for large alphabets."""
    starts, ends = (x.tolist() for x in _bounds(s, size))
    s, types = s.tolist(), types.tolist()
    sa = [-1] * len(s)
    tail = ends[:]
    for i in reversed(order.tolist()):
        c = s[i]
        tail[c] -= 1
        sa[tail[c]] = i
    head = starts
    for i in sa:  # the list grows to the right of what has been read
        if i > 0 and not types[i - 1]:
            c = s[i - 1]
            sa[head[c]] = i - 1
            head[c] += 1
    tail = ends
    for at in range(len(sa) - 1, -1, -1):
        i = sa[at]
        if i > 0 and types[i - 1]:
            c = s[i - 1]
            tail[c] -= 1
            sa[tail[c]] = i - 1
    sa[0] = len(s) - 1
    return np.array(sa, np.int64)


def _names(s, marks, ordered):
    """Ranks of the substrings between leftmost S suffixes, given them in order."""
    length = np.ones(len(s), np.int64)
    length[marks[:-1]] = np.diff(marks) + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    open_ = np.flatnonzero(same)
    depth = 0
    while len(open_):
        differ = s[a[open_] + depth] != s[b[open_] + depth]
        same[open_[differ]] = False
        depth += 1
        open_ = open_[~differ]
        open_ = open_[length[a[open_]] > depth]
    return np.append(0, np.cumsum(~same))


def suffix_array(s, size, level=0) -> np.ndarray:
    """Starts of all suffixes of ``s`` in order. Its last symbol is 0 and occurs nowhere else."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    induce = _induce_bytes if level == 0 else _induce_list
    types = s_types(s)
    marks = leftmost_s(types)
    first = induce(s, types, marks, size)
    is_mark = np.zeros(len(s), bool)
    is_mark[marks] = True
    ordered = first[is_mark[first]]
    names = _names(s, marks, ordered)
    if names[-1] + 1 < len(marks):
        place = np.zeros(len(s), np.int64)
        place[ordered] = names
        ordered = marks[suffix_array(place[marks], int(names[-1]) + 1, level + 1)]
    return induce(s, types, ordered, size)


def _words_at(data):
    """The eight bytes from every place on as one number, most significant byte first."""
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i:i + len(data)]
    return out


def permuted_lcp(data, sa, cap) -> np.ndarray:
    """For every place the length, ``cap`` at most, it shares with the suffix ordered before it.

    Successive places lose one at most, so values at every 64th place bound those between;
    the gaps are halved, and only what the bounds leave open is compared.
    """
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = _words_at(data)
    out = np.zeros(n, np.int64)

    def extend(at, low):
        """Common lengths at the places ``at``, known to be ``low`` at least."""
        value = low.copy()
        open_ = np.flatnonzero((before[at] >= 0) & (value < cap))
        while len(open_):
            a, b = at[open_] + value[open_], before[at[open_]] + value[open_]
            inside = np.maximum(a, b) < n
            open_, a, b = open_[inside], a[inside], b[inside]
            differ = words[a] ^ words[b]
            same = np.full(len(a), 8)
            some = np.flatnonzero(differ)
            # Leading equal bytes: by the highest bit that differs.
            high = np.floor(np.log2((differ[some] >> np.uint64(8)).astype(np.float64) + 0.5))
            same[some] = np.clip(7 - (high.astype(np.int64) + 8) // 8, 0, 7)
            value[open_] += same
            open_ = open_[(same == 8) & (value[open_] < cap)]
        return np.minimum(value, cap)

    stride = 64
    at = np.arange(0, n, stride)
    out[at] = extend(at, np.zeros(len(at), np.int64))
    while stride > 1:
        half = stride // 2
        at = np.arange(half, n, stride)
        low = np.maximum(out[at - half] - half, 0)
        right = at + half
        high = np.full(len(at), cap + n)
        known = right < n
        seen = out[right[known]]
        high[known] = np.where(seen < cap, seen + half, cap + n)
        out[at] = low
        open_ = np.flatnonzero(low < np.minimum(high, cap))
        out[at[open_]] = extend(at[open_], low[open_])
        stride = half
    return out


def repeated(blocks: list[bytes], length: int) -> list[np.ndarray]:
    """For every block, which of its starts begin a string of ``length`` bytes found elsewhere.

    Blocks are UTF-8: none has the byte 0xFF, which stands between them.
    """
    data = np.frombuffer(b"\xff".join([*blocks, b""]), np.uint8)
    sizes = np.array([len(b) for b in blocks], np.int64)
    starts = np.append(0, np.cumsum(sizes + 1))
    s = data.astype(np.int64) + 2
    s[starts[1:] - 1] = 1
    s = np.append(s, 0)
    sa = suffix_array(s, 258)
    # Places at which a block ends within `length` are left out.
    lcp = permuted_lcp(np.append(data, np.uint8(0xFE)), sa, length)
    whole = np.zeros(len(s), bool)
    for a, n in zip(starts[:-1].tolist(), sizes.tolist()):
        whole[a:a + max(0, n - length + 1)] = True
    after = np.zeros(len(s), np.int64)
    after[sa[:-1]] = lcp[sa[1:]]
    near = np.full(len(s), -1, np.int64)
    near[sa[:-1]] = sa[1:]
    prior = np.full(len(s), -1, np.int64)
    prior[sa[1:]] = sa[:-1]
    hit = whole & (((lcp >= length) & whole[prior]) | ((after >= length) & whole[near]))
    return [hit[a:a + n] for a, n in zip(starts[:-1].tolist(), sizes.tolist())]
