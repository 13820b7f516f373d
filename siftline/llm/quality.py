"""Quality classifier: random-indexing vectors, pooled per document, into a two-layer network.

Every term has a fixed sparse random index vector; a term's context vector is the sum of
the index vectors of the terms beside it, over the whole corpus. A document is the mean
and deviation of its terms' vectors, rarer terms weighing more. A small network trained on
the labelled documents gives a log-odds, which a temperature fitted on other labelled
documents turns into a calibrated probability.

Two sorts of terms are pooled beside each other:

- Every distinct word, by 48 bits of its letters' hash. Its sums are gathered by word over the
  corpus and go back to the blocks of documents that have it, so the table of words grows
  with the corpus and never meets in one place.
- The form of a word: its own letters if it has four bytes or fewer, else the kinds of its
  first and last characters (punctuation marks each of their own kind) and its length.
  Forms fall into a fixed number of buckets.

A word that repeats the one before it is a term of its own in both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.columns import neutral, restored
from siftline.llm.textbytes import BLOCK_BYTES, Words, blocks, give_back, mixed
from siftline.session import fresh_path, small_batches, written

BUCKETS = 4096
SIZE = 64
NONZERO = 4
#: The vectors of words are shorter than those of forms, as they travel; their index vectors
#: have one component that isn't zero.
WORD_SIZE = 32
AGAIN = np.uint64(1)
REACH = 2
#: Steps of a word's weight, from 0 to 1.
WEIGHTS = 4095
#: Bytes of text whose words are summed before they are sent; words of the corpus for each part of the table.
CHUNK_BYTES = 24 << 20
PART_WORDS = 4_000_000
#: Rows of vectors that a step takes at once; words of whole texts that a step of a chunk takes.
SLAB = 50_000
STEP = 400_000
#: Terms of whole texts that are pooled at once, few enough for a core's cache.
POOLED = 1_000
#: Labelled documents that the network is fitted on, at most: those with the smallest id hashes.
SAMPLE = 20_000
#: Rejected rows that are broadcast, counted before; more are joined as Spark chooses.
BROADCAST_ROWS = 1_000_000
HIDDEN = 24
PREDICTED_FROM = 0.3
FOLDS = 5


def _kinds() -> np.ndarray:
    kind = np.arange(256)
    kind[ord("a"):ord("z") + 1], kind[ord("A"):ord("Z") + 1] = 1, 2
    kind[ord("0"):ord("9") + 1], kind[0x80:] = 3, 1
    return kind.astype(np.uint64)


KIND = _kinds()


def index_vectors(seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket: the places of its nonzero components, and their signs."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((BUCKETS, SIZE)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def own_components(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index vector of each word: where its one component is, and its sign, from the bits of its code."""
    bits = mixed(codes ^ np.uint64(0x9E3779B97F4A7C15))
    return (bits % np.uint64(WORD_SIZE)).astype(np.int64), np.where(bits >> np.uint64(40) & np.uint64(1), 1.0, -1.0)


def _repeated(words: Words, whole: np.ndarray) -> np.ndarray:
    """Whether each word is the one before it in the same text."""
    out = np.zeros(len(whole), bool)
    text = np.repeat(np.arange(len(words.per_text)), words.per_text)
    out[1:] = (whole[1:] == whole[:-1]) & (text[1:] == text[:-1])
    return out


def word_codes(words: Words) -> np.ndarray:
    """48 bits of each word, as the high bits of 64; AGAIN if it repeats the one before."""
    code = words.hashes() & ~np.uint64(0xFFFF)
    return np.where(_repeated(words, code), AGAIN, code)


def terms(words: Words) -> np.ndarray:
    """The bucket of each word's form."""
    if not len(words):
        return np.empty(0, np.int64)
    length = (words.ends - words.starts).astype(np.int64)
    code = np.minimum(length, 15).astype(np.uint64)
    for at in (words.starts, np.minimum(words.starts + 1, words.ends - 1),
               np.maximum(words.ends - 2, words.starts), words.ends - 1):
        code = code * np.uint64(256) + KIND[words.bytes[at]]
    whole = words.hashes()
    code = np.where(_repeated(words, whole), AGAIN, np.where(length <= 4, whole, code))
    return (mixed(code) % np.uint64(BUCKETS)).astype(np.int64)


def _text_blocks(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    texts = [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]
    for a, b in blocks(map(len, texts)):
        yield a, b, Words(texts[a:b])


def context_table(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(context vectors, counts) of all buckets, over every word of every document.

    Sums of whole numbers, so the same in any order. What reaches the driver is of fixed
    size; each task sends one row for each bucket that it met.
    """
    schema = "part int, bucket int, n bigint, sums binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = (np.ascontiguousarray(x.T) for x in index_vectors())
        total, seen = np.zeros(BUCKETS * SIZE), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                for _, _, words in _text_blocks(batch.column(0).slice(k, 512)):
                    b = terms(words)
                    seen += np.bincount(b, minlength=BUCKETS)
                    text = np.repeat(np.arange(len(words.per_text)), words.per_text)
                    pairs = []
                    for step in range(1, REACH + 1):
                        beside = text[step:] == text[:-step]
                        x, y = b[:-step][beside], b[step:][beside]
                        pairs += [(x, y), (y, x)]
                    of, by = (np.concatenate(side) for side in zip(*pairs))
                    of *= SIZE
                    for i in range(NONZERO):
                        total += np.bincount(of + places[i][by], signs[i][by], BUCKETS * SIZE)
        met = np.flatnonzero(seen)
        sums = total.reshape(BUCKETS, SIZE)[met].astype("<i8")
        yield pa.RecordBatch.from_arrays([
            pa.array((met % 64).astype(np.int32)), pa.array(met.astype(np.int32)), pa.array(seen[met]),
            pa.array([row.tobytes() for row in sums], pa.binary())], names=["part", "bucket", "n", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket").to_numpy()
        own, which = np.unique(bucket, return_inverse=True)
        sums, n = np.zeros((len(own), SIZE), np.int64), np.zeros(len(own), np.int64)
        values = np.frombuffer(b"".join(rows.column("sums").to_pylist()), "<i8").reshape(-1, SIZE)
        np.add.at(sums, which, values)
        np.add.at(n, which, rows.column("n").to_numpy())
        return pa.table({
            "part": pa.array(own % 64, pa.int32()), "bucket": pa.array(own, pa.int32()), "n": pa.array(n),
            "sums": pa.array([row.tobytes() for row in sums], pa.binary())})

    table, counts = np.zeros((BUCKETS, SIZE)), np.zeros(BUCKETS)
    for row in docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect():
        table[row["bucket"]] = np.frombuffer(row["sums"], "<i8")
        counts[row["bucket"]] = row["n"]
    return table, counts


def _unsigned(values: np.ndarray) -> np.ndarray:
    """Whole numbers with the sign as the lowest bit."""
    v = np.array(values, np.int64).ravel()
    sign = v >> 63
    v <<= 1
    v ^= sign
    return v.view(np.uint64)


def _signed(v: np.ndarray) -> np.ndarray:
    """The numbers of ``_unsigned``, in its place."""
    sign = (v & np.uint64(1)).view(np.int64)
    v >>= np.uint64(1)
    out = v.view(np.int64)
    out ^= np.negative(sign, out=sign)
    return out


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers of up to 64 bits, small ones in few bytes."""
    v = _unsigned(values)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(v.max(initial=0)) < 1 << 8 * w)
    planes = v.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return len(v).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, "zstd", asbytes=True)


def _bits_packed(values: np.ndarray) -> bytes:
    """The same, for numbers that are nearly all 0 or 1 away from it: a plane for each bit."""
    v = _unsigned(values)
    planes = [np.packbits((v >> np.uint64(k) & np.uint64(1)).astype(bool)).tobytes()
              for k in range(int(v.max(initial=0)).bit_length())]
    return len(v).to_bytes(8, "little") + bytes([len(planes)]) + pa.compress(b"".join(planes), "zstd", asbytes=True)


def _bits_unpacked(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    size = -(-n // 8)
    planes = np.frombuffer(pa.decompress(data[9:], size * width, "zstd", asbytes=True), np.uint8)
    v = np.zeros(n, np.uint64)
    for k in range(width):
        v |= np.unpackbits(planes[k * size:(k + 1) * size], count=n).astype(np.uint64) << np.uint64(k)
    return _signed(v)


def _unpacked(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    planes = pa.decompress(data[9:], n * width, "zstd", asbytes=True)
    v = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(f"<u{width}").ravel().astype(np.uint64)
    return _signed(v)


def _context_sums(
    codes: np.ndarray, which: np.ndarray, n: np.ndarray, text: np.ndarray, own: slice = slice(None),
    order: np.ndarray | None = None, index: tuple[np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """Of each word (of those in ``own``): the sum of the index vectors beside its places.

    which: the word at each place; order: the places by word; index: the words' components.
    """
    places, signs = own_components(codes) if index is None else index
    order = np.argsort(which, kind="stable") if order is None else order
    begin, end, _ = own.indices(len(codes))
    upto = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros((end - begin, WORD_SIZE), np.int32)
    for k in range(upto[begin], upto[end], SLAB):
        at = order[k:min(k + SLAB, upto[end])]
        first, last = which[at[0]], which[at[-1]]
        of, of_text = (which[at] - first).astype(np.int64) * WORD_SIZE, text[at]
        cells, weights = [], []
        for step in (*range(-REACH, 0), *range(1, REACH + 1)):
            other = np.clip(at + step, 0, len(text) - 1)
            beside = np.flatnonzero((other == at + step) & (text[other] == of_text))
            by = which[other[beside]]
            cells.append(of[beside] + places[by])
            weights.append(signs[by])
        # one table of all steps: most of its rows are of words with few places
        sums = np.bincount(np.concatenate(cells), np.concatenate(weights), (last - first + 1) * WORD_SIZE)
        out[first - begin:last + 1 - begin] += sums.reshape(-1, WORD_SIZE).astype(np.int32)
    return out


FRAMES = "key bigint, block bigint, part int, a binary, b binary, c binary"


def _frames(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)], names=["key", "block", "part", "a", "b", "c"])


class Chunk:
    """The words of some texts, as codes and forms; the texts themselves are held only block by block."""

    def __init__(self, block: int):
        self.block, self.size = block, 0
        self.ids: list = []
        self.hashes: list = []
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.codes: list[np.ndarray] = []
        self.buckets: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def add(self, doc_id: int | None, text_hash: int, text: bytes) -> None:
        self.ids.append(doc_id)
        self.hashes.append(text_hash)
        self.held.append(text)
        self.size += len(text)
        self.held_bytes += len(text)
        if self.held_bytes >= BLOCK_BYTES:
            self._settle()

    def _settle(self) -> None:
        words = Words(self.held)
        self.codes.append(word_codes(words))
        self.buckets.append(terms(words).astype(np.int16))
        self.sizes.append(words.per_text)
        self.held, self.held_bytes = [], 0

    def frames(self, parts: int) -> Iterator[tuple]:
        """Rows of FRAMES: of each part of the table the chunk's words, their counts and sums, and
        under a key of its own (-1 - block) which words every document has. Empties the chunk."""
        if self.held:
            self._settle()
        sizes, codes = np.concatenate(self.sizes), np.concatenate(self.codes)
        self.codes = []
        # the places by word, in one sort for all that follows
        order = np.argsort(codes, kind="stable").astype(np.int32)
        codes = codes[order]
        new = np.ones(len(codes), bool)
        new[1:] = codes[1:] != codes[:-1]
        starts = np.flatnonzero(new)
        found, n = codes[starts], np.diff(starts, append=len(codes))
        del codes
        which = np.empty(len(order), np.int32)
        which[order] = np.cumsum(new, dtype=np.int32) - 1
        bucket = np.concatenate(self.buckets)[order[starts]]
        self.buckets = []
        del new, starts
        text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        part = ((found >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(part, np.arange(parts + 1)).tolist()
        index = own_components(found)
        for p in np.unique(part).tolist():
            own = slice(edges[p], edges[p + 1])
            sums = _context_sums(found, which, n, text, own, order, index)
            steps = np.diff(found[own], prepend=np.uint64(0)).view(np.int64)
            yield p, self.block, p, _packed(steps), _packed(n[own]), _bits_packed(sums)
        del order, index, part, text
        # frequent words get small numbers, and a text's are sent as steps
        many = max(len(found), 1)
        place = np.empty(len(found), np.int32)
        place[np.argsort(-n, kind="stable")] = np.arange(len(found), dtype=np.int32)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        per_text, pairs, times = [], [], []
        for a, b in blocks(sizes.tolist(), STEP):
            own = np.repeat(np.arange(b - a), sizes[a:b]) * many + place[which[upto[a]:upto[b]]]
            pair, time = np.unique(own, return_counts=True)
            per_text.append(np.bincount(pair // many, minlength=b - a))
            pairs.append((pair % many).astype(np.int32))
            times.append(time.astype(np.int32))
        del which
        common = np.argsort(-np.bincount(bucket, minlength=BUCKETS), kind="stable")  # frequent forms, too
        data = [_packed(x) for x in (
            np.concatenate(per_text), np.diff(np.concatenate(pairs), prepend=np.int32(0)), np.concatenate(times), n,
            np.argsort(common)[bucket], common, np.array(self.hashes, np.int64),
            np.array([i or 0 for i in self.ids], np.int64), np.array([i is None for i in self.ids]))]
        lengths = np.array([len(x) for x in data], "<i8").tobytes()
        yield -1 - self.block, self.block, -1, lengths, b"".join(data), None


def _answered(rows: pa.Table, total: int) -> pa.Table:
    """Of each block's words of one part: their weights and context vectors over the corpus, under the block's key."""
    rows = [r for r in rows.to_pylist() if r["part"] >= 0]
    if not rows:
        return pa.Table.from_batches([_frames([])])
    asked = [np.cumsum(_unpacked(r["a"]).view(np.uint64)) for r in rows]
    found, which = np.unique(np.concatenate(asked), return_inverse=True)
    n, sums, at = np.zeros(len(found), np.int64), np.zeros((len(found), WORD_SIZE), np.int64), 0
    for r, codes in zip(rows, asked):  # a block has a word once
        own = which[at:at + len(codes)]
        n[own] += _unpacked(r["b"])
        sums[own] += _bits_unpacked(r["c"]).reshape(-1, WORD_SIZE)
        at += len(codes)
    # only the direction counts: large sums in steps of a 127th of the largest
    most = np.maximum(np.abs(sums).max(1, keepdims=True), 1)
    sums = np.where(most > 127, np.rint(sums * (127 / most)), sums).astype(np.int8)
    weight = np.rint(_rarity(n / total) * WEIGHTS).astype(np.int64)
    out, at = [], 0
    for r, codes in zip(rows, asked):
        own = which[at:at + len(codes)]
        out.append((-1 - r["block"], r["block"], r["part"], None, _packed(weight[own]), _bits_packed(sums[own])))
        at += len(codes)
    return pa.Table.from_batches([_frames(out)])


def _mean_and_deviation(vectors, of, weight, per_text) -> np.ndarray:
    """Of each text: the weighted mean and deviation of its terms' vectors."""
    size = vectors.shape[1]
    out = np.zeros((len(per_text), 2 * size))
    weight = weight.astype(float)
    upto = np.cumsum(per_text)
    at = 0
    while at < len(per_text):
        before = upto[at] - per_text[at]
        end = max(at + 1, int(np.searchsorted(upto, before + POOLED, side="right")))
        some = of[before:upto[end - 1]]
        both = np.empty((len(some), 2 * size))  # components and their squares
        both[:, :size] = vectors[some]
        np.multiply(both[:, :size], both[:, :size], out=both[:, size:])
        a = 0
        for k, b in enumerate((upto[at:end] - before).tolist(), at):
            if b > a:
                own = weight[before + a:before + b]
                np.dot(own, both[a:b], out=out[k])
                out[k] /= own.sum()
            a = b
        at = end
    out[:, size:] = np.sqrt(np.maximum(out[:, size:] - out[:, :size] ** 2, 0))
    return out.astype(np.float32)


COUNT_AT = 4 * SIZE


def _narrow(x: np.ndarray) -> pa.Array:
    """Rows of features: the number of words' as float16, all others (from -1 to 1) by their root in a byte."""
    rest = np.delete(x, COUNT_AT, axis=1)
    rest = np.rint(np.copysign(np.sqrt(np.minimum(np.abs(rest), 1)), rest) * 127).astype(np.int8)
    rows = np.hstack([np.ascontiguousarray(x[:, COUNT_AT:COUNT_AT + 1].astype("<f2")).view(np.int8), rest])
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _wide(column: pa.Array) -> np.ndarray:
    """The rows of ``_narrow`` as float16 in their first order."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1)
    rest = rows[:, 2:] / np.float32(127)
    wide = np.insert(rest * np.abs(rest), COUNT_AT, np.ascontiguousarray(rows[:, :2]).view("<f2")[:, 0], axis=1)
    return wide.astype("<f2")


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 2048):
            doc_id, hashes, x = batch.slice(k, 2048).columns
            yield pa.RecordBatch.from_arrays(
                [doc_id, hashes, pa.array([row.tobytes() for row in _wide(x)], pa.binary())], names=["doc_id", "hash", "x"])


def _rarity(share: np.ndarray) -> np.ndarray:
    return (0.002 / (0.002 + share)).astype(np.float32)


FEATURES = "doc_id bigint, hash bigint, x binary"


def features(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, part_words: int = PART_WORDS) -> DataFrame:
    """(doc_id bigint, hash, x): of every row of ``docs`` (doc_id, text) the pooled vectors, as float16.

    x: mean and deviation of the forms' vectors, the logarithm of the number of words, mean and
    deviation of the words' vectors. ``hash`` is of the text.
    """
    return narrow_features(docs, chunk_bytes, part_words).mapInArrow(_widened, FEATURES)


def narrow_features(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, part_words: int = PART_WORDS) -> DataFrame:
    """The rows of ``features`` as they are written once, in a byte each. What is fitted and scored
    reads these, so that no second Python worker widens them beside the one that scores."""
    small_batches(docs.sparkSession)
    context, counts = context_table(docs)
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, SIZE))
    np.put_along_axis(own, places, signs / np.sqrt(NONZERO), 1)
    total = max(counts.sum(), 1)
    forms = np.hstack([context / np.maximum(norm, 1e-9), own]).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast((forms, _rarity(counts / total)))
    parts = 16 + int(total) // part_words

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.slice(k, 512).columns)):
                    chunk.add(doc_id, text_hash, (text or "").encode("utf-8", "surrogatepass"))
                    if chunk.size >= chunk_bytes:
                        yield _frames(list(chunk.frames(parts)))
                        chunk = Chunk(chunk.block + 1)
                        give_back()
        if chunk.ids:
            yield _frames(list(chunk.frames(parts)))
        del chunk
        give_back()

    features_schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("x", pa.binary())])

    def answered(rows: pa.Table) -> pa.Table:
        out = _answered(rows, int(total))
        give_back()
        return out

    def pooled(answers: pa.Table, block: pa.Table) -> pa.Table:
        out = pool(answers, block)
        give_back()
        return out

    def pool(answers: pa.Table, block: pa.Table) -> pa.Table:
        if block.column("part")[0].as_py() >= 0:  # a part of the table of words, not a block
            return features_schema.empty_table()
        forms, form_weights = sent.value
        own, held = block.to_pylist()[0], sorted(answers.select(["part", "b", "c"]).to_pylist(), key=lambda r: r["part"])
        ends = np.cumsum(np.frombuffer(own["a"], "<i8")).tolist()
        per_text, pairs, times, n, form, common, hashes, ids, nameless = (
            _unpacked(own["b"][a:b]) for a, b in zip([0, *ends], ends))
        bucket = common[form]
        weight = np.concatenate([_unpacked(r["b"]) for r in held] or [np.empty(0)])
        sums = np.concatenate([_bits_unpacked(r["c"]).astype(np.int8) for r in held] or [np.empty(0, np.int8)])
        if len(weight) != len(n):
            raise RuntimeError("a block's words and their answers differ")
        weight = (weight / np.float32(WEIGHTS)).astype(np.float32)
        vectors = sums.reshape(-1, WORD_SIZE).astype(np.float32)
        vectors /= np.maximum(np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), 1e-9)[:, None]
        del held, sums
        words = np.argsort(-n, kind="stable").astype(np.int32)[np.cumsum(pairs, out=pairs)]
        del pairs
        upto = np.concatenate([[0], np.cumsum(per_text)])
        rows = []
        for a, b in blocks(per_text.tolist(), STEP):
            word, often, sizes = words[upto[a]:upto[b]], times[upto[a]:upto[b]], per_text[a:b]
            form_of = bucket[word]
            rows.append(_narrow(np.hstack([
                _mean_and_deviation(forms, form_of, form_weights[form_of] * often, sizes),
                np.log1p(np.bincount(np.repeat(np.arange(b - a), sizes), often, b - a))[:, None],
                _mean_and_deviation(vectors, word, weight[word] * often, sizes),
            ])))
        return pa.table({
            "doc_id": pa.array(ids, mask=nameless.astype(bool)), "hash": pa.array(hashes), "x": pa.chunked_array(rows, pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    # one exchange, read twice: by part for the answers, by block where these meet which document has which word
    frames = rows.mapInArrow(asked, FRAMES).repartition("key")
    answers = frames.groupBy("key").applyInArrow(answered, FRAMES)
    found = answers.groupBy("key").cogroup(frames.groupBy("key")).applyInArrow(pooled, FEATURES)
    path = fresh_path(docs.sparkSession, "quality-features")
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(FEATURES).parquet(path)


@dataclass
class Model:
    network: tuple | None = None  # centre, scale, first layer, second layer, temperature
    base: float = 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(x), self.base)
        *layers, temperature = self.network
        return 1 / (1 + np.exp(-np.clip(_forward(layers, x)[1] / temperature, -30, 30)))


def _forward(layers, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    centre, scale, first, second = layers
    hidden = np.tanh(((x - centre) / scale) @ first[:-1] + first[-1])
    return hidden, hidden @ second[:-1] + second[-1]


def train(x: np.ndarray, y: np.ndarray, rounds: int = 60, seed: int = 3) -> tuple:
    """(centre, scale, first layer, second layer, temperature).

    Four fifths of the rows fit the layers (logistic loss, Adam steps over small batches);
    the temperature, from 1 to 16, is the one with the least loss on the other fifth. It never
    sharpens: rows that part cleanly would otherwise always ask for the sharpest.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    apart, own = order[: len(x) // 5], order[len(x) // 5:]
    centre, scale = x[own].mean(0), x[own].std(0) + 1e-3
    first = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1] + 1, HIDDEN))
    second = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN + 1)
    layers = [first, second]
    means, squares, step = [0, 0], [0, 0], 0
    for turn in range(rounds):
        for rows in np.array_split(rng.permutation(own), max(1, len(own) // 128)):
            hidden, logit = _forward((centre, scale, *layers), x[rows])
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, layers[1][:-1]) * (1 - hidden ** 2)
            plain = (x[rows] - centre) / scale
            slopes = [np.vstack([plain.T @ back, back.sum(0)]) + 1e-4 * layers[0],
                      np.append(hidden.T @ error, error.sum()) + 1e-4 * layers[1]]
            step += 1
            rate = 0.01 * (1 - turn / rounds)
            for i, slope in enumerate(slopes):
                means[i] = 0.9 * means[i] + 0.1 * slope
                squares[i] = 0.999 * squares[i] + 0.001 * slope ** 2
                layers[i] = layers[i] - rate * (means[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(squares[i] / (1 - 0.999 ** step)) + 1e-8)
    check = apart if len(apart) else own
    logit = _forward((centre, scale, *layers), x[check])[1]
    loss = lambda t: np.logaddexp(0, np.where(y[check] == 1, -logit, logit) / t).mean()
    temperature = min(np.geomspace(1, 16, 65), key=loss)
    return centre, scale, *layers, temperature


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def fit(pooled: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of a corpus, by its ``narrow_features``, and labels (doc_id, quality).

    The network sees labels of rows outside fold 0
    only, at most ``sample`` of them (the smallest id hashes), and of rows with one doc_id
    the one of the smallest text hash. Labels other than 0 and 1,
    ids with both labels and labels without a document are passed over; with fewer than ten
    rows of either label every score is the share of label 1 (one half without any).
    """
    clear = (
        labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(fold() != 0)
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.min("quality").cast("int").alias("label"), F.max("quality").alias("_other"))
        .filter("label = _other").select("_id", "label")
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )
    rows = pooled.join(
        F.broadcast(clear), F.col("doc_id") == F.col("_id")  # at most ``sample`` rows
    ).groupBy("doc_id", "label").agg(F.min_by("x", "hash").alias("x"))
    model = Model()
    found = rows.toPandas().sort_values("doc_id", kind="stable")
    y = found["label"].to_numpy(float)
    if min((y == 0).sum(), (y == 1).sum()) < 10:
        model.base = float(y.mean()) if len(y) else 0.5
        return model
    model.network = train(_wide(pa.array(found["x"], pa.binary())).astype(float), y)
    return model


def scored(pooled: DataFrame, model: Model) -> DataFrame:
    """(doc_id, hash, quality_score) of every row of ``narrow_features``: 0 to 1, higher is better; no shuffle.

    A null or empty text has no terms and is scored as such.
    """
    sent = pooled.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                p = sent.value.scores(_wide(some.column(2)).astype(float))
                yield pa.RecordBatch.from_arrays([*some.columns[:2], pa.array(p)], names=["doc_id", "hash", "quality_score"])

    return pooled.select("doc_id", "hash", "x").mapInArrow(score, "doc_id bigint, hash bigint, quality_score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row doc_id, held_out, score and predicted (1 from a score of PREDICTED_FROM on).

    Repeated rows are scored alike, one by one. A null doc_id counts as an empty one for
    held_out. Other columns are left behind.
    """
    pooled = narrow_features(docs)
    return scored(pooled, fit(pooled, labels)).select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        (fold() == 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= PREDICTED_FROM).cast("int").alias("predicted"),
    )


def without_rejected(docs: DataFrame, labels: DataFrame, least: float = PREDICTED_FROM) -> DataFrame:
    """``docs`` without the rows scored below ``least``; same columns."""
    rows, names = neutral(docs)
    doc_id, text = names["doc_id"], names["text"]
    pooled = narrow_features(rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    rejected = written(scored(pooled, fit(pooled, labels)).filter(F.col("quality_score") < least).select(
        F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct(), "quality-rejected")
    if rejected.count() <= BROADCAST_ROWS:
        rejected = F.broadcast(rejected)
    found = rows.join(
        rejected, F.col(doc_id).cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash")), "left_anti")
    return restored(found, names)
