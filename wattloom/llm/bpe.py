"""Byte-pair encoding and decoding of texts in batched numpy merge rounds.

The different words of a batch lie in one flat array of symbols. A round looks up the ranks of
all adjacent pairs by binary search over the sorted pair keys, finds the lowest of each word and
merges it in all words at once.
"""

import itertools
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import broadcast, offsets_of, opened, texts_of
from wattloom.llm.packing import byte_symbols

#: Rank of a pair that is never merged.
NEVER = np.int32(np.iinfo(np.int32).max)
#: Texts are encoded in runs of about this many characters, and long ones cut at spaces.
RUN_CHARS = 1 << 19
#: Words whose ids a task remembers; beyond it, it starts afresh.
KNOWN_WORDS = 1 << 18


def _steps_of(data):
    """The settings that this module knows to follow; others are an error, not a wrong result."""
    def steps(name, many):
        part = data[name] or {}
        return part.get(many) or [part]

    normal = [(s.get("type"), s.get("pattern"), s.get("content"))
              for s in steps("normalizer", "normalizers")]
    cut = steps("pre_tokenizer", "pretokenizers")
    split, level = cut if len(cut) == 2 else ({}, {})
    model = data["model"]
    known = (
        normal == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "),
                   ("Lowercase", None, None)]
        and [split.get(k) for k in ("type", "behavior", "invert")] == ["Split", "Removed", True]
        and [level.get(k) for k in ("type", "add_prefix_space", "use_regex")]
        == ["ByteLevel", False, False]
        and model["type"] == "BPE" and not data["decoder"]
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                           "byte_fallback", "ignore_merges"))
        and not any(t[k] for t in data["added_tokens"]
                    for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if not known:
        raise ValueError("this vocabulary file has settings that are not supported")
    return split["pattern"]["Regex"]


class Vocabulary:
    """Symbols, pairs and tokens of a file, as arrays; small, and broadcast to the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.file = f.read()
        data = json.loads(self.file)
        self.pattern = _steps_of(data)
        model = data["model"]
        ids, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token = {i: t for t, i in [*ids.items(), *self.added.items()]}
        byte_of = byte_symbols()
        self.inner, self.last = (np.zeros(256, np.int32) for _ in range(2))
        for c, b in byte_of.items():
            self.inner[b], self.last[b] = ids[c], ids[c + end]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array(x, np.int32) for x in zip(*[
            (ids[a], ids[b], ids[a + b]) for a, b in pairs]))
        keys = _key(left, right)
        order = np.argsort(keys)
        self.keys, self.rank_of, self.made = keys[order], order.astype(np.int32), made
        # If no pair comes before the pairs that make its parts, all its places in a word can be
        # merged in one round: none of the pairs that arise could have come first.
        made_by = np.full(max(self.token) + 1, -1)
        np.maximum.at(made_by, made, np.arange(len(made)))
        self.ordered = bool((np.maximum(made_by[left], made_by[right])
                             < np.arange(len(made))).all())
        # Bytes that follow each other in no token: no merge ever crosses such a place.
        self.joined = np.zeros((256, 256), bool)
        for t in ids:
            raw = [byte_of[c] for c in t.removesuffix(end)] if end else [byte_of[c] for c in t]
            self.joined[raw[:-1], raw[1:]] = True


def _key(left, right):
    return (left.astype(np.int64) << 32) | right


class Coder:
    """Encodes and decodes with a vocabulary, and remembers the words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        import regex
        self.v = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        self.space = regex.compile(r"\s+")
        self.assigned = set()
        self.added = regex.compile("(" + "|".join(map(regex.escape, vocabulary.added)) + ")"
                                   ) if vocabulary.added else None
        self.library = None
        self.forget()

    def forget(self):
        self.known, self.ids, self.sizes = {}, np.zeros(0, np.int32), np.zeros(0, np.int64)
        if self.v.added:
            self._keep(list(self.v.added), np.array(list(self.v.added.values()), np.int32),
                       np.ones(len(self.v.added), np.int64))

    def _keep(self, words, ids, sizes):
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.ids = np.concatenate([self.ids, ids])
        self.sizes = np.concatenate([self.sizes, sizes])

    def split(self, text):
        """Yields lists of the words of a text, in order; added tokens are words of their own."""
        if self.added is not None and any(t in text for t in self.v.added):
            for n, part in enumerate(self.added.split(text)):
                if n % 2:
                    yield [part]
                elif part:
                    yield from self._plain(part)
        else:
            yield from self._plain(text)

    def _plain(self, text):
        if not text.isascii():
            if not self._assigned(text):
                yield self._by_library(text)
                return
            # Lower case is a matter of single characters: no final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        begin = 0
        while begin < len(text):
            end = begin + RUN_CHARS
            if end < len(text):
                cut = self.space.search(text, end)
                end = cut.start() if cut else len(text)
            yield self.words.findall(text, begin, end)
            begin = end

    def _assigned(self, text):
        """Whether this Python's Unicode tables know all characters; other tables may know more,
        so other texts are left to the file's own library."""
        new = set(text) - self.assigned
        if any(unicodedata.category(c) == "Cn" for c in new):
            return False
        self.assigned |= new
        return True

    def _by_library(self, text):
        if self.library is None:
            from tokenizers import Tokenizer, pre_tokenizers
            whole = Tokenizer.from_str(self.v.file)
            self.library = whole.normalizer, pre_tokenizers.Split(
                _onig(self.v.pattern), "removed", invert=True)
        normal, splitter = self.library
        return [w for w, _ in splitter.pre_tokenize_str(normal.normalize_str(text))]

    def encode(self, texts):
        """(ids of all texts, number of ids of each)."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        codes, counts, waiting, held = [], [], [], 0
        for text in texts:
            n = 0
            for words in self.split(text):
                waiting.append(words)
                n += len(words)
                held += len(words)
                if held > RUN_CHARS:
                    codes.append(self._codes(waiting, held))
                    waiting, held = [], 0
            counts.append(n)
        codes = np.concatenate([*codes, self._codes(waiting, held)])
        sizes = self.sizes[codes]
        begins = offsets_of(self.sizes)[codes]
        at = offsets_of(sizes)
        ids = self.ids[np.repeat(begins - at[:-1], sizes) + np.arange(at[-1])]
        return ids, np.diff(at[offsets_of(counts)])

    def _codes(self, lists, many):
        """The numbers of all words under which their ids are kept; new ones are merged first."""
        new = {w for words in lists for w in words if w not in self.known}
        if new:
            new = list(new)
            self._keep(new, *self.merge(new))
        every = itertools.chain.from_iterable(lists)
        return np.fromiter(map(self.known.__getitem__, every), np.int64, many)

    def merge(self, words):
        """(ids of all words, number of ids of each) by merge rounds over one flat array."""
        v = self.v
        raw = [w.encode() for w in words]
        sizes = np.array([len(b) for b in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes) - 1
        symbols = v.inner[flat]
        symbols[ends] = v.last[flat[ends]]
        # Work is done by pieces of words that no merge can cross.
        first = np.ones(len(flat), bool)
        first[1:] = ~v.joined[flat[:-1], flat[1:]]
        first[ends[:-1] + 1] = True
        at, symbols = self._rounds(symbols, np.cumsum(first))
        word = np.repeat(np.arange(len(words)), sizes)[at]
        return symbols, np.bincount(word, minlength=len(words))

    def ranks(self, left, right):
        keys = _key(left, right)
        at = np.minimum(np.searchsorted(self.v.keys, keys), len(self.v.keys) - 1)
        return np.where(self.v.keys[at] == keys, self.v.rank_of[at], NEVER)

    def _rounds(self, symbols, piece):
        """Merges until no piece has a pair left; returns (places, symbols) in order."""
        place = np.arange(len(symbols))
        rank = np.full(len(symbols), NEVER, np.int32)
        inside = np.flatnonzero(piece[:-1] == piece[1:])
        rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        done = []
        while len(symbols):
            begins = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            sizes = np.diff(np.append(begins, len(symbols)))
            low = np.minimum.reduceat(rank, begins)
            live = low != NEVER
            if not live.all():
                left = np.repeat(live, sizes)
                done.append((place[~left], symbols[~left]))
                symbols, piece, place, rank = (x[left] for x in (symbols, piece, place, rank))
                low, sizes = low[live], sizes[live]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(low, sizes))
            if self.v.ordered:
                # In a run of one symbol every second pair is free, counted from the left.
                n = np.arange(len(at))
                run = np.concatenate(([True], at[1:] != at[:-1] + 1))
                at = at[(n - np.maximum.accumulate(np.where(run, n, 0))) % 2 == 0]
            else:
                at = at[np.unique(piece[at], return_index=True)[1]]
            symbols[at] = self.v.made[rank[at]]
            left = np.ones(len(symbols), bool)
            left[at + 1] = False
            symbols, piece, place, rank = (x[left] for x in (symbols, piece, place, rank))
            at = at - np.arange(len(at))
            rank[at] = NEVER
            touched = np.zeros(len(symbols) + 1, bool)
            touched[at] = touched[at - 1] = True
            near = np.flatnonzero(touched[:len(symbols) - 1])
            near = near[piece[near] == piece[near + 1]]
            rank[near] = self.ranks(symbols[near], symbols[near + 1])
        places = np.concatenate([p for p, _ in done] or [place])
        symbols = np.concatenate([s for _, s in done] or [symbols])
        order = np.argsort(places)
        return places[order], symbols[order]

    def decode(self, ids) -> str:
        """The tokens of ids with a space between; ids outside the vocabulary are left out."""
        token = self.v.token
        try:
            return " ".join([token[i] for i in ids])
        except KeyError:
            return " ".join([token[i] for i in ids if i in token])


def _onig(pattern):
    from tokenizers import Regex
    return Regex(pattern)


def _left(frame, keep, made):
    if set(made) & {k.lower() for k in keep}:
        raise ValueError(f"keep has one of {', '.join(made)}")
    kinds = dict(frame.dtypes)
    return "".join(f"`{k}` {kinds[k]}, " for k in keep)


def _runs(lengths):
    """(first, end) of runs of rows of about ``RUN_CHARS`` together, at least one row each."""
    ends, row = np.cumsum(lengths), 0
    while row < len(ends):
        before = ends[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(ends, before + RUN_CHARS, "right")))
        yield row, end
        row = end


def _encode(shared, packed):
    def run(batches):
        coder = Coder(opened(shared))
        for batch in batches:
            column = batch.column("text")
            left = batch.drop_columns(["text"])
            lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for row, end in _runs(lengths):
                ids, sizes = coder.encode(texts_of(column.slice(row, end - row)))
                at = offsets_of(sizes)
                if packed:
                    raw = ids.astype("<u4").tobytes()
                    out = pa.array([raw[4 * a:4 * b] for a, b in zip(at, at[1:])], pa.binary())
                else:
                    out = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*left.slice(row, end - row).columns, out],
                                                 [*left.schema.names, "ids"])
    return run


def encode_texts(documents: DataFrame, vocabulary: str, text="text", keep=("doc_id",),
                 packed=False) -> DataFrame:
    """One row per document: ``keep`` and ``ids``, the token ids of its whole text.

    Ids are an array, or with ``packed`` a binary of little-endian unsigned 32-bit numbers. They
    equal those that the `tokenizers` library gives for the file at path ``vocabulary`` without
    special tokens around a text; added tokens that stand in a text become their ids. Files with
    other settings than lower-cased, byte-level pairs with word ends raise a ValueError.

    NULL and empty texts have no ids. Equal rows give a row each. An empty table gives no rows.
    Long texts are cut at spaces while they are encoded, never their result. Each row is encoded
    by itself, so no rows are shuffled, and a lost task is only run again.
    """
    left = _left(documents, keep, ("ids", "text"))
    return documents.select(*keep, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        _encode(broadcast(documents.sparkSession, Vocabulary(vocabulary)), packed),
        left + ("ids binary" if packed else "ids array<int>"))


def _decode(shared):
    def run(batches):
        coder = Coder(opened(shared))
        for batch in batches:
            column = batch.column("ids")
            packed = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
            lengths = pc.fill_null(pc.binary_length(column) if packed else
                                   pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            left = batch.drop_columns(["ids"])
            for row, end in _runs(lengths):
                here = column.slice(row, end - row)
                # One row at a time: ids as Python numbers take many times their bytes.
                rows = (np.frombuffer(x.as_py() or b"", "<u4").tolist() if packed
                        else x.as_py() or () for x in here)
                text = pa.array([coder.decode(x) for x in rows], pa.string())
                yield pa.RecordBatch.from_arrays([*left.slice(row, end - row).columns, here, text],
                                                 [*left.schema.names, "ids", "decoded"])
    return run


def decode_ids(encoded: DataFrame, vocabulary: str, ids="ids", keep=("doc_id",)) -> DataFrame:
    """One row per row of ids: ``keep``, ``ids`` as they are and ``decoded``, their text.

    ``ids`` are an array or packed. As the vocabulary names no decoder, the text is that of the
    tokens with spaces between. NULL or no ids give an empty text; unknown ids are left out.
    """
    left = _left(encoded, keep, ("ids", "decoded"))
    kind = dict(encoded.dtypes)[ids]
    return encoded.select(*keep, F.col(f"`{ids}`").alias("ids")).mapInArrow(
        _decode(broadcast(encoded.sparkSession, Vocabulary(vocabulary))),
        f"{left}ids {kind}, decoded string")
