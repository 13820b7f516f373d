"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut one byte string; where tokens of both end, a group ends, and a token of
one is linked to every token of the other whose bytes it shares. The ends of the two lie in
two rising rows, which are merged along a merge path: on equally spaced diagonals a binary
search finds how many ends of each side come before, so the path falls into pieces of the same
number of steps that know nothing of each other. A piece gives its overlaps; a link or group
that a diagonal cuts is stitched where two pieces meet.

Over the corpus, the documents that hold a pair of ids linked are counted. Texts are taken in
chunks: a chunk's distinct pairs with their counts are added up over all chunks, the sums go
back to the chunks that have the pair, and meet its documents there. So what is exchanged
follows the distinct pairs of a chunk, not the links, and nothing passes the driver.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.bpe import byte_characters
from siftline.llm.textbytes import blocks
from siftline.session import written

#: Bytes of text whose tokens are aligned at once, and of a chunk's texts.
BLOCK_BYTES = 1 << 20
CHUNK_BYTES = 8 << 20
#: Steps of a piece of the merge path.
STEPS = 1 << 16
_B = np.int64(1) << 32  # a pair of ids is a * 2**32 + b
#: Characters whose classes leave no room for doubt between Unicode versions.
_PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7e\xc0-į]*")


def diagonals(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """How many of ``a`` the merge of two rising rows has taken after 0, steps, 2 * steps, ...
    and all elements; of equal ones that of ``a`` comes first."""
    total = len(a) + len(b)
    at = np.append(np.arange(0, total, steps), total)
    low, high = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        i = np.where(open_, middle, 0)
        j = np.where(open_, at - 1 - middle, 0)
        first = a[i] <= b[j]
        low, high = np.where(open_ & first, middle + 1, low), np.where(open_ & ~first, middle, high)


def piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """One piece of the path: at each step the token of each side that lies there, whether the
    step's end differs from the one before in the piece, and its first and last end."""
    x, y = a[i0:i1], b[j0:j1]
    from_a = np.zeros(len(x) + len(y), bool)
    from_a[np.arange(len(x)) + np.searchsorted(y, x, "left")] = True
    ends = np.empty(len(from_a), np.int64)
    ends[from_a], ends[~from_a] = x, y
    taken = np.cumsum(from_a)
    new = np.ones(len(ends), bool)
    new[1:] = ends[1:] != ends[:-1]
    return i0 + taken - from_a, j0 + np.arange(len(ends)) - taken + from_a, new, ends[0], ends[-1]


def overlaps(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlaps of the tokens that end at ``a`` and at ``b`` (both from 0 to the same end):
    the token of each side, and whether both end with it, which ends a group."""
    cut = diagonals(a, b, steps)
    at = np.append(np.arange(0, len(a) + len(b), steps), len(a) + len(b))
    of_a, of_b, news, last = [], [], [], None
    for (i0, i1), (d0, d1) in zip(zip(cut, cut[1:]), zip(at, at[1:])):
        i, j, new, first, end = piece(a, b, i0, i1, d0 - i0, d1 - i1)
        new[0] = first != last  # a diagonal between two equal ends: the step before had this link
        of_a.append(i)
        of_b.append(j)
        news.append(new)
        last = end
    if not news:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    new = np.concatenate(news)
    closes = ~np.append(new[1:], True)  # the step after has the same end
    return np.concatenate(of_a)[new], np.concatenate(of_b)[new], closes[new]


class ByteTable:
    """Byte strings by number, for many numbers at once."""

    def __init__(self, strings: Sequence[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of all numbers in a row, and where each ends."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) + np.repeat(self.starts[numbers] - ends + sizes, sizes)
        return self.flat[index], ends


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive values, as many as ``counts`` says."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens.

    If A's merges are in the order of its ids, as in a vocabulary of ranks, texts of plain
    characters are encoded by a quicker library with the same vocabulary and word pattern.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            file = json.load(f)
        byte = {c: i for i, c in enumerate(byte_characters())}
        a = {i: bytes(byte[c] for c in t) for t, i in file["model"]["vocab"].items()}
        self.quick = _by_ranks(file, a)
        a |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
        self.a_bytes = ByteTable([a.get(i, b"") for i in range(max(a) + 1)])
        self.b_bytes = ByteTable([
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())
        ])
        #: an id in decimal and the mark after it
        most = max(len(self.a_bytes.sizes), len(self.b_bytes.sizes))
        self.written = ByteTable([b"%d%c" % (i, mark) for i in range(most) for mark in b",|;"])

    def _a_ids(self, text: str) -> np.ndarray:
        if self.quick and _PLAIN_TEXT.fullmatch(text):
            return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of space + text by A, and of the text by B, which adds the space; how many of
        each a text has. None where the text is null or empty or the bytes of either differ
        from space + text."""
        own = [" " + t if t else "" for t in texts]
        by_a = [self._a_ids(t) for t in own]
        by_b = self.b.encode([t[1:] for t in own], num_threads=1)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (by_a, by_b))
        a = np.concatenate([*by_a, np.empty(0, np.int64)])
        b = np.fromiter(chain.from_iterable(by_b), np.int64, int(n_b.sum()))
        data = [t.encode() for t in own]
        sizes = np.array([len(d) for d in data], np.int64)
        whole = np.frombuffer(b"".join(data), np.uint8)
        good = (_sums(self.a_bytes.sizes[a], n_a) == sizes) & (_sums(self.b_bytes.sizes[b], n_b) == sizes)
        while True:  # only texts whose sizes fit are compared, so that all bytes stand at their places
            if not good.all():
                a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
                whole = whole[np.repeat(good, sizes)]
                n_a, n_b, sizes = (np.where(good, x, 0) for x in (n_a, n_b, sizes))
            other = (self.a_bytes.joined(a)[0] != whole) | (self.b_bytes.joined(b)[0] != whole)
            if not other.any():
                return a, b, n_a, n_b
            good = _sums(other, sizes) == 0


def _by_ranks(file: dict, token_bytes: dict[int, bytes]):
    """The quicker encoder, if each merge's token follows the one of the merge before it."""
    split = file.get("pre_tokenizer") or {}
    if split.get("type") != "ByteLevel" or not split.get("use_regex") or file.get("normalizer"):
        return None
    first, vocabulary = 256, file["model"]["vocab"]
    for k, pair in enumerate(file["model"]["merges"]):
        if vocabulary["".join(pair.split(" ") if isinstance(pair, str) else pair)] != first + k:
            return None
    import tiktoken
    from public_tokenizers import PATTERN

    return tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks={t: i for i, t in token_bytes.items()}, special_tokens={})


@cache
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    """One per Python worker."""
    return Vocabularies(a_path, b_path)


class Aligned:
    """Some texts aligned: ids and ends of both sides in a row, links and groups over all."""

    def __init__(self, texts: list[str | None], v: Vocabularies, steps: int = STEPS):
        self.a, self.b, self.n_a, self.n_b = v.tokens(texts)
        self.v = v
        # every text's last ends are equal, so no link or group reaches over texts
        self.of_a, self.of_b, self.closes = overlaps(
            np.cumsum(v.a_bytes.sizes[self.a]), np.cumsum(v.b_bytes.sizes[self.b]), steps)
        self.text = np.repeat(np.arange(len(texts)), self.n_a)[self.of_a]
        self.n_links = np.bincount(self.text, minlength=len(texts))
        self.n_groups = np.bincount(self.text[self.closes], minlength=len(texts))
        group = np.cumsum(self.closes) - self.closes
        self.group_a = group[np.searchsorted(self.of_a, np.arange(len(self.a)))]
        self.group_b = group[np.searchsorted(self.of_b, np.arange(len(self.b)))]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair of ids, how often linked there), sorted."""
        keys, which = np.unique(self.a[self.of_a] * _B + self.b[self.of_b], return_inverse=True)
        both, times = np.unique(self.text * max(len(keys), 1) + which, return_counts=True)
        return both // max(len(keys), 1), keys[both % max(len(keys), 1)], times

    def digests(self) -> list[str]:
        """Hashes of ``a1,a2|b1;a3|b2,b3``: the ids of each text's groups; '' without tokens."""
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)[:len(self.a)]
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)[:len(self.b)]
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a, "left")] = self.a * 3 + last_a
        codes[np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, "right")] = self.b * 3 + 2 * last_b
        written, ends = self.v.written.joined(codes)
        whole = written.tobytes()
        ends = np.append(0, ends)[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [hashlib.sha256(whole[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:])]

    def groups(self) -> pa.Array:
        """Of each text: list of groups, each with the ids of A and of B."""
        n = int(self.closes.sum())
        a_at, b_at = (np.searchsorted(g, np.arange(n + 1)).astype(np.int32) for g in (self.group_a, self.group_b))
        sides = [pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32)))
                 for at, ids in ((a_at, self.a), (b_at, self.b))]
        ends = np.concatenate([[0], np.cumsum(self.n_groups)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(sides, ["a", "b"]))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str | None]]]:
    texts = batch.column(1).to_pylist()
    for x, y in blocks((len(t or "") for t in texts), BLOCK_BYTES):
        yield x, y, texts[x:y]


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, groups array<struct<a: array<int>, b: array<int>>>) of every row of ``docs``."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, texts in _texts(batch):
                found = Aligned(texts, vocabularies(a_path, b_path)).groups()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), found], names=["doc_id", "groups"])

    return _rows(docs).mapInArrow(group, "doc_id bigint, groups array<struct<a: array<int>, b: array<int>>>")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: A row of each document (which: places in the chunk's list of pairs; times: how often), and
#: one of each chunk (pair, docs: its documents with the pair).
CHUNKS = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()),
    ("which", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("pair", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))])
_CHUNKS = (
    f"chunk bigint, doc_id bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, groups_sha256 string, "
    "which array<int>, times array<int>, pair array<bigint>, docs array<int>"
)


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values.astype(np.int32)))


class Chunk:
    """The rows of one chunk's texts."""

    def __init__(self, number: int):
        self.number, self.bytes, self.rows = number, 0, 0
        self.plain: list[tuple[pa.Array, Aligned | None]] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: pa.Array, found: Aligned, size: int) -> None:
        text, pair, times = found.pairs()
        self.pairs.append((text + self.rows, pair, times))
        self.plain.append([ids, *(pa.array(getattr(found, c)) for c in COUNTS), pa.array(found.digests(), pa.string())])
        self.rows, self.bytes = self.rows + len(ids), self.bytes + size

    def take(self) -> Iterator[pa.RecordBatch]:
        text, pair, times = (np.concatenate(x) for x in zip(*self.pairs))
        known, which, docs = np.unique(pair, return_inverse=True, return_counts=True)
        ends = np.searchsorted(text, np.arange(1, self.rows + 1))
        columns = [pa.concat_arrays(x) for x in zip(*self.plain)]
        nothing = [pa.nulls(self.rows, f.type) for f in list(CHUNKS)[-2:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(self.rows, self.number)), *columns, _lists(ends, which), _lists(ends, times), *nothing], schema=CHUNKS)
        if len(known):
            own = [pa.array([known], CHUNKS.field("pair").type), pa.array([docs], CHUNKS.field("docs").type)]
            nothing = [pa.nulls(1, f.type) for f in list(CHUNKS)[1:-2]]
            yield pa.RecordBatch.from_arrays([pa.array([self.number]), *nothing, *own], schema=CHUNKS)


def aligned(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Every row of ``docs`` (doc_id, text) aligned, and the pairs of ids linked in the corpus.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is one of the most
    frequent of its A id, ties included), count_sum (of the pairs' counts, over links),
    groups_sha256. Pairs: a_id, b_id, documents (rows that hold the pair linked), best.

    Texts that are null, empty or not covered byte by byte by both tokenizers have no tokens:
    zeros and an empty hash. Texts are taken whole, repeated rows and null doc_ids one by one;
    other columns are left behind.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v = vocabularies(a_path, b_path)
        chunk = Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for x, y, texts in _texts(batch):
                chunk.add(batch.column(0).slice(x, y - x), Aligned(texts, v), sum(len(t or "") for t in texts))
                if chunk.bytes >= chunk_bytes:
                    yield from chunk.take()
                    chunk = Chunk(chunk.number + 1)
        if chunk.rows:
            yield from chunk.take()

    stage = written(_rows(docs).mapInArrow(chunks, _CHUNKS), "alignment-chunks")
    held = stage.filter(F.col("pair").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("pair", "docs")).alias("at", "x"))
    held = held.select("chunk", "at", F.col("x.pair").alias("pair"), F.col("x.docs").alias("docs"))
    a_id = F.shiftright("pair", 32)
    sums = held.groupBy("pair").agg(F.sum("docs").alias("documents")).withColumn("a_id", a_id)
    # an A id has no more pairs than B has ids
    most = F.max("documents").over(Window.partitionBy("a_id"))
    counts = written(sums.select("pair", "a_id", "documents", (F.col("documents") == most).alias("best")), "alignment-pairs")
    answers = held.drop("docs").join(counts.drop("a_id"), "pair").select(
        F.col("chunk").alias("of_chunk"), "at", "documents", "best")
    rows = stage.filter(F.col("pair").isNull()).drop("pair", "docs")
    found = rows.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(_summed, _SUMMED)
    pairs = counts.select(
        F.col("a_id").cast("int").alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"),
        "documents", "best")
    return found, pairs


_SUMMED = f"doc_id bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, n_best bigint, count_sum bigint, groups_sha256 string"


def _summed(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """One chunk's documents with the sums over their links."""
    at = answers.column("at").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at] = answers.column("documents").to_numpy()
    best[at] = answers.column("best").to_numpy(zero_copy_only=False)
    rows = rows.combine_chunks()
    which, times = (rows.column(c).combine_chunks().flatten().to_numpy() for c in ("which", "times"))
    sizes = np.array(rows.column("which").combine_chunks().value_lengths(), np.int64)

    def over_links(values: np.ndarray) -> pa.Array:
        return pa.array(_sums(values[which] * times, sizes))

    return pa.table({
        **{c: rows.column(c) for c in ("doc_id", *COUNTS)}, "n_best": over_links(best), "count_sum": over_links(count),
        "groups_sha256": rows.column("groups_sha256")})
