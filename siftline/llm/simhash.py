"""SimHash fingerprints and their near-duplicate groups, by equal pairs of bit blocks.

The 64 bits are cut into two blocks more than bits may differ: fingerprints that link are
equal in two blocks at least. So each distinct fingerprint is dealt once for every pair of
blocks, by what it has there, and only fingerprints with an equal pair are compared. Keys
share buckets; a bucket with too many fingerprints is cut into parts that each meet the
others. A task links the few fingerprints of a usual key by comparing them all. Those of a
key that many have are linked with their neighbours in order first; what is still apart is
found by a binary trie of them: four pairs of children, one more bit of the error budget
spent where they differ, and a pair is dropped as soon as the budget is exceeded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.columns import neutral, restored
from siftline.llm.components import components
from siftline.llm.textbytes import blocks, give_back
from siftline.session import small_batches, written

SHINGLE = 4
SEED = 42
MOST_BITS = 4
#: Fingerprints of a bucket that is not cut, and the most bits of a bucket's number.
NODE = 16_384
LEVELS = 16
#: Pairs of trie nodes that a task looks at together; pairs of leaves compared at once.
TOGETHER = 1 << 17
SMALL = 48
#: Neighbours in order that fingerprints of a frequent key are linked with before the trie.
NEIGHBOURS = 8


def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """One uint64 per text: each bit is set if it is in over half of the shingles' hashes."""
    sizes, hashes = [], []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        plain = b" ".join(words)
        if len(words) <= shingle:
            own = [xxhash.xxh64_intdigest(plain, SEED)] if words else []
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            digest, raw = xxhash.xxh64_intdigest, memoryview(plain)
            own = [digest(raw[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())]
        sizes.append(len(own))
        hashes.append(np.array(own, np.uint64))
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        counts = np.array(sizes)[some]
        bits = np.unpackbits(np.concatenate(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, np.cumsum(counts) - counts, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the 64 bits as ``fingerprint`` (bigint) of every row's whole text."""
    small_batches(docs.sparkSession)
    rows = docs.select(*columns, "text")
    schema = rows.drop("text").withColumn("fingerprint", F.lit(0).cast("long")).schema
    n = len(columns)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                texts = some.column(n).to_pylist()
                found = [fingerprints_of(texts[a:b]) for a, b in blocks(len(t or "") for t in texts)]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:n], pa.array(np.concatenate(found).view(np.int64))],
                    names=[*columns, "fingerprint"])
        give_back()

    return rows.mapInArrow(compute, schema)


def walk(a: np.ndarray, b: np.ndarray, depth: int, spent: int, most: int = MOST_BITS) -> Iterator[tuple]:
    """(index in a, index in b) of all pairs within ``most`` bits, in parts.

    Both arrays are sorted and distinct; each lies under one node of the given depth, and
    ``spent`` bits of the nodes differ. If both are the same object, each pair comes once.
    """
    itself = a is b
    one = lambda n: np.array([n], np.int64)
    todo = [(depth, one(0), one(len(a)), one(0), one(len(b)), one(spent))]
    while todo:
        depth, a0, a1, b0, b1, bits = todo.pop()
        if len(a0) > TOGETHER:
            half = len(a0) // 2
            todo += [(depth, *(x[:half] for x in (a0, a1, b0, b1, bits))),
                     (depth, *(x[half:] for x in (a0, a1, b0, b1, bits)))]
            continue
        width = b1 - b0
        pairs = (a1 - a0) * width
        last = (pairs <= SMALL) | (depth == 64)
        if last.any():
            n = pairs[last]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w = np.repeat(width[last], n)
            i, j = np.repeat(a0[last], n) + at // w, np.repeat(b0[last], n) + at % w
            near = np.bitwise_count(a[i] ^ b[j]) <= most
            if itself:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            keep = ~last
            a0, a1, b0, b1, bits = (x[keep] for x in (a0, a1, b0, b1, bits))
        if not len(a0):
            continue
        bit = np.uint64(1 << (63 - depth))
        above = ~np.uint64(bit + bit - np.uint64(1)) if depth else np.uint64(0)
        am = np.clip(np.searchsorted(a, (a[a0] & above) | bit), a0, a1)
        bm = np.clip(np.searchsorted(b, (b[b0] & above) | bit), b0, b1)
        mirrored = itself & (a0 == b0)
        children = [(a0, am, b0, bm, bits, True), (am, a1, bm, b1, bits, True),
                    (a0, am, bm, b1, bits + 1, True), (am, a1, b0, bm, bits + 1, ~mirrored)]
        parts = []
        for c0, c1, d0, d1, spent_now, valid in children:
            ok = (c1 > c0) & (d1 > d0) & (spent_now <= most) & valid
            parts.append([x[ok] for x in (c0, c1, d0, d1, spent_now)])
        todo.append((depth + 1, *(np.concatenate(x) for x in zip(*parts))))


class Groups:
    """Connected groups of 0..n-1; ``root`` ends as the smallest index of each one's group."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            p, q = self.root[i], self.root[j]
            apart = p != q
            if not apart.any():
                return
            i, j, p, q = i[apart], j[apart], p[apart], q[apart]
            np.minimum.at(self.root, np.maximum(p, q), np.minimum(p, q))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def block_masks(most: int = MOST_BITS) -> list[int]:
    """Of each pair of blocks the bits, as signed numbers of 64 bits."""
    cuts = [64 * k // (most + 2) for k in range(most + 3)]
    blocks_of_bits = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    both = [x | y for x, y in combinations(blocks_of_bits, 2)]
    return [m - (m >> 63 << 64) for m in both]


def dealt(prints: DataFrame, most: int = MOST_BITS, node: int = NODE) -> tuple[int, DataFrame]:
    """(depth, rows): every fingerprint under the bucket q (of ``depth`` bits) of each pair of blocks p.

    A bucket of more than ``node`` fingerprints is cut into parts by hash; each pair of its
    parts (i, j) is a group, so no group has more than about two parts.
    """
    depth = min(LEVELS, max(0, int(2 * prints.count() // node).bit_length()))
    masks = F.lit(block_masks(most)).cast("array<bigint>")
    placed = prints.select("fingerprint", "id", F.posexplode(masks).alias("p", "mask")).select(
        "fingerprint", "id", "p",
        F.pmod(F.xxhash64(F.col("fingerprint").bitwiseAND(F.col("mask"))), F.lit(1 << depth)).alias("q"))
    cut = placed.groupBy("p", "q").count().filter(F.col("count") > node).select(
        "p", "q", F.ceil(F.col("count") / node).alias("parts"))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    met = placed.join(F.broadcast(cut), ["p", "q"], "left").select(
        "fingerprint", "id", "p", "q", F.pmod(F.xxhash64("fingerprint"), parts).alias("mine"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
    return depth, met.select(
        "p", "q", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fingerprint", "id")


def linked(value: np.ndarray, mask: int, most: int = MOST_BITS) -> Groups:
    """Groups of distinct fingerprints by links of which both ends are equal under ``mask``."""
    groups = Groups(len(value))
    key = value & np.array([mask], np.int64).view(np.uint64)
    order = np.lexsort((value, key))
    value, key = value[order], key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    size = np.diff(start, append=len(key))
    at, end = np.arange(len(key)), np.repeat(start + size, size)
    for d in range(1, SMALL):
        # of a small key all pairs, of a frequent one the neighbours
        at = at[at + d < end[at]]
        if d == NEIGHBOURS + 1:
            at = at[np.repeat(size, size)[at] <= SMALL]
        if not len(at):
            break
        near = at[np.bitwise_count(value[at] ^ value[at + d]) <= most]
        groups.link(order[near], order[near + d])
    for a, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        own, run = order[a:a + n], value[a:a + n]
        roots, which, counts = np.unique(groups.root[own], return_inverse=True, return_counts=True)
        rest = np.flatnonzero(which != counts.argmax())  # a link inside the largest group is no use
        if len(rest):
            for i, j in walk(run[rest], run, 0, 0, most):
                groups.link(own[rest[i]], own[j])
    return groups


def links(prints: DataFrame, most: int = MOST_BITS, node: int = NODE) -> DataFrame:
    """(a, b): edges that connect all ids whose fingerprints differ in ``most`` bits or fewer.

    ``prints`` has distinct fingerprints, each with one id. A group gives at most one edge
    for each fingerprint (a spanning forest of its links), not all pairs.
    """
    masks = block_masks(most)
    _, placed = dealt(prints, most, node)

    def join(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy()
        root = linked(rows.column("fingerprint").to_numpy().view(np.uint64), masks[key[0].as_py()], most).root
        away = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[away]), "b": pa.array(ids[root[away]])})

    return placed.groupBy("p", "q", "i", "j").applyInArrow(join, "a bigint, b bigint")


def grouped(prints: DataFrame, most: int = MOST_BITS, node: int = NODE) -> DataFrame:
    """``prints`` (doc_id, fingerprint, ...) with component_id.

    Rows link if their fingerprints differ in ``most`` bits or fewer; the component is the
    smallest doc_id that a row can reach, itself included. Rows with a null doc_id lend no
    id: they get their fingerprint's component, null if only such rows have it.
    """
    one = written(
        prints.filter("doc_id IS NOT NULL").groupBy("fingerprint")
        .agg(F.min("doc_id").cast("long").alias("id")), "simhash-distinct",
    )
    found = components(links(one, most, node), "simhash")
    classes = one.join(found, one["id"] == found["node"], "left").select(
        F.col("fingerprint").alias("_print"), F.coalesce("component", "id").alias("component_id"))
    return prints.join(classes, prints["fingerprint"] == classes["_print"], "left").drop("_print")


def near_duplicates(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """Per row doc_id, fingerprint (16 lowercase hex digits) and component_id.

    A null or empty text has the fingerprint zero, which links like any other; repeated
    rows are in one component. Other columns are left behind.
    """
    prints = written(fingerprints(docs, ["doc_id"]), "simhash-prints")
    return grouped(prints, most).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def without_duplicates(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that of the smallest doc_id.

    Of rows with that doc_id the one with the smallest text hash stays. Rows with a null
    doc_id in a component without any other are kept, one for each text.
    """
    rows, names = neutral(docs)
    keyed = rows.withColumn("hash", F.xxhash64(names["text"]))
    texts = keyed.select(F.col(names["doc_id"]).cast("long").alias("doc_id"), "hash", F.col(names["text"]).alias("text"))
    prints = written(fingerprints(texts, ["doc_id", "hash"]), "simhash-prints")
    keep = (
        grouped(prints, most).filter("doc_id <=> component_id")
        .withColumn("text", F.when(F.col("doc_id").isNull(), F.col("hash")))
        .groupBy(F.col("doc_id").alias("id"), "text").agg(F.min("hash").alias("least"))
    )
    same = F.col(names["doc_id"]).eqNullSafe(F.col("id")) & (F.col("hash") == F.col("least"))
    return restored(keyed.join(keep, same, "left_semi").dropDuplicates([names["doc_id"], "hash"]), names)
