"""BPE encoding and decoding with the merges of a public tokenizer's file.

The merging is done here: a word is a contiguous array of parts with the rank of each
neighbouring pair beside it. The array is scanned for the smallest rank (the leftmost of
equal ones), the boundary inside that pair is deleted, and the ranks of the merged part with
its two neighbours are looked up anew, until no pair has a rank. Words are short, so a scan
is quicker than a queue; a word of more than ``SHORT`` bytes is merged by a heap of the same
pairs in the same order instead, as its scans would cost the square of its length.

Every word is merged once as long as a worker remembers it (``WORDS_KEPT`` at least, twice as
many at most). Texts of plain characters are split into words here; any other text is
normalised and split by the library's own normaliser and splitter, since classes of rare
characters differ between Unicode versions. The library's BPE model is not used.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.textbytes import blocks

#: Bytes of a word that are merged by scanning.
SHORT = 256
#: Words, and their longest length, that a worker remembers (about 250 bytes each).
WORDS_KEPT = 150_000
WORD_KEPT_BYTES = 64
#: Bytes of text that a batch holds, or one text.
BATCH_BYTES = 2 << 20
NO_RANK = 1 << 60
SHIFT = 20
_PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7e\xc0-į]*")
#: The file's word pattern, after lower-casing, for plain characters (fixed value).
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it is
    visible in Latin-1, else the next one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(others)) for b in range(256)]


class Merges:
    """The merge table of a vocabulary file and the merging of one word."""

    def __init__(self, model: dict):
        for name in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"):
            if model.get(name):
                raise ValueError(f"a BPE model with {name} is not supported")
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        if max(vocabulary.values()) >= 1 << SHIFT:
            raise ValueError("too many tokens")
        letters = byte_characters()
        #: id of each byte inside a word, and at its end; None if the vocabulary has none
        self.inner = [vocabulary.get(c) for c in letters]
        self.final = [vocabulary.get(c + suffix) for c in letters]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocabulary[left] << SHIFT | vocabulary[right]] = len(self.made)
            self.made.append(vocabulary[left + right])

    def word(self, data: bytes) -> tuple[list[int], list[int]]:
        """Ids of one word's bytes, and where each part starts; bytes without an id are left out."""
        ids = [self.inner[b] for b in data[:-1]] + [self.final[b] for b in data[-1:]]
        cuts = [i for i, x in enumerate(ids) if x is not None]
        if len(cuts) < len(ids):
            ids = [ids[i] for i in cuts]
        return self._scanned(ids, cuts) if len(ids) <= SHORT else self._by_heap(ids, cuts)

    def _scanned(self, ids: list[int], cuts: list[int]) -> tuple[list[int], list[int]]:
        rank = self.rank.get
        ranks = [rank(a << SHIFT | b, NO_RANK) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            at = ranks.index(low)
            ids[at] = self.made[low]
            del ids[at + 1], cuts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(ids[at - 1] << SHIFT | ids[at], NO_RANK)
            if at < len(ranks):
                ranks[at] = rank(ids[at] << SHIFT | ids[at + 1], NO_RANK)
        return ids, cuts

    def _by_heap(self, ids: list[int], cuts: list[int]) -> tuple[list[int], list[int]]:
        rank, n = self.rank.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < n:
                pair = ids[at] << SHIFT | ids[after[at]]
                low = rank(pair)
                if low is not None:
                    heapq.heappush(heap, (low, at, pair))

        for i in range(n - 1):
            offer(i)
        while heap:
            low, at, pair = heapq.heappop(heap)
            right = after[at]
            if right >= n or ids[at] < 0 or ids[at] << SHIFT | ids[right] != pair:
                continue  # one of its parts has become another since
            ids[at], ids[right] = self.made[low], -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        left = [i for i in range(n) if ids[i] >= 0]
        return [ids[i] for i in left], [cuts[i] for i in left]


class Remembered(dict):
    """Ids of each word, merged when it is first asked for; words not met for long go."""

    def __init__(self, merges: Merges, kept: int):
        super().__init__()
        self.merges, self.kept, self.before = merges, kept, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.before.get(word)
        if ids is None:
            ids = tuple(self.merges.word(word.encode("utf-8", "surrogatepass"))[0])
        if len(word) <= WORD_KEPT_BYTES:
            if len(self) >= self.kept:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Texts to ids and back, as the file at ``path`` says."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        if file.get("decoder"):
            raise ValueError("only files without a decoder are supported")
        self.path = path
        self.words = Remembered(Merges(file["model"]), words_kept)
        self.tokens = {i: t for t, i in file["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.mark = re.compile("|".join(map(re.escape, longest_first)) or "(?!)")

    @property
    def library(self):
        if not hasattr(self, "_library"):
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(self.path)
            self._library = whole.normalizer, whole.pre_tokenizer[0]
        return self._library

    def _split(self, text: str) -> list[str]:
        if _PLAIN_TEXT.fullmatch(text):
            return _WORD.findall(text.lower())
        normaliser, splitter = self.library
        return [word for word, _ in splitter.pre_tokenize_str(normaliser.normalize_str(text))]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids (int32) of a whole text; a null text has none. The names of special tokens
        stand for their ids."""
        text, out, at = text or "", [], 0
        for mark in self.mark.finditer(text):
            out += chain.from_iterable(map(self.words.__getitem__, self._split(text[at:mark.start()])))
            out.append(self.special[mark.group()])
            at = mark.end()
        rest = chain.from_iterable(map(self.words.__getitem__, self._split(text[at:])))
        return np.fromiter(chain(out, rest) if out else rest, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids, special ones too, between spaces; unknown ids are left out."""
        try:
            return " ".join(map(self.tokens.__getitem__, ids.tolist()))
        except KeyError:
            return " ".join(t for t in map(self.tokens.get, ids.tolist()) if t is not None)


@cache
def codec(path: str) -> Codec:
    """One per Python worker, so that its words serve all of the worker's tasks."""
    return Codec(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text), by the file at ``path``.

    Null and empty texts have no ids; a text of any length is taken whole. Repeated rows and
    null doc_ids are encoded one by one; other columns are left behind. Nothing is shuffled.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks((len(t or "") for t in texts), BATCH_BYTES):
                ids = [codec(path).encode(t) for t in texts[a:b]]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id bigint, ids array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with the text of the ids, ``decoded``; a null list gives an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy().tolist()
            values = lists.values.fill_null(-1).to_numpy()
            for a, b in blocks((4 * (y - x) for x, y in zip(at, at[1:])), BATCH_BYTES):
                texts = [codec(path).decode(values[x:y]) for x, y in zip(at[a:b], at[a + 1:b + 1])]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns), pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "decoded"])

    rows = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(decode, "doc_id bigint, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document: hashes of its ids in
    decimal, one space between, and of the text decoded from them."""
    return decoded(encoded(docs, path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
