"""Exact top-k by inner product, pruned by segment means and deviations, coarse to fine.

A vector cut into segments of m components has in each a mean a and a deviation s (root of
the mean square around a). For two vectors the inner product of a segment is at most
m * (a * a' + s * s'), so sums over segments bound the score from above; equally the squared
distance, |x|^2 + |y|^2 - 2<x, y>, from below. Finer segments bound tighter. Every task
goes through its rows in blocks: a block's scores are bounded with one segment, those that
may still enter a query's best k with four, then with sixteen, and the survivors are
computed exactly in whole numbers: in float64 or 64-bit integers as long as no sum can leave
what these hold exactly, else in integers of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
SEGMENTS = (1, 4, 16)
QUERY_BLOCK = 2048
ROW_BLOCK = 4096
#: Sums of whole numbers up to it are exact in float64, and in 64-bit integers.
FLOAT_SUMS, INTEGER_SUMS = 2.0 ** 52, 2.0 ** 62
#: Vectors whose products reach it are compared without bounds, which could overflow.
NO_BOUNDS = 1e200
RESULT = "query_id bigint, vec_id bigint, score bigint, place binary"


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x). Finite components too large for that in float64 stand for the largest
    there are; only their exact scores are used then, from ``integers``."""
    with np.errstate(over="ignore"):
        out = np.floor(SCALE * values.astype(np.float64))
    return np.nan_to_num(out, posinf=np.finfo(float).max, neginf=np.finfo(float).min)


def integers(values: np.ndarray) -> list[int]:
    """floor(SCALE * x) as integers of any size."""
    return [math.floor(v * SCALE) if abs(v) < 2.0 ** 60 else int(v) * SCALE for v in values.tolist()]


def place(score: int) -> bytes:
    """Bytes that sort as the scores do."""
    size = (abs(score).bit_length() + 7) // 8
    data = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\1" + data if score >= 0 else b"\0" + bytes(255 - b for b in data)


def summaries(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, scaled so that a product of two rows bounds the score."""
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(int)
    out = []
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            part = x[:, a:b]
            mean = part.mean(1)
            out += [mean * math.sqrt(b - a), np.sqrt(((part - mean[:, None]) ** 2).sum(1))]
    return np.stack(out, 1) if out else np.zeros((len(x), 1))


class Best:
    """The best k of each query so far: scores descending, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, k: int):
        x = whole(raw)
        self.ids, self.raw, self.x, self.k = ids, raw, x, k
        self.most = float(np.abs(x).max(initial=0))
        self.levels = [summaries(x, s) for s in SEGMENTS]
        self.least = np.full(len(ids), -np.inf)  # a score below it can't enter
        self.scores: list[list[int]] = [[] for _ in ids]
        self.found: list[np.ndarray] = [np.empty(0, np.int64)] * len(ids)

    def see(self, ids: np.ndarray, raw: np.ndarray) -> None:
        y = whole(raw)
        most = float(np.abs(y).max(initial=0))
        with np.errstate(over="ignore"):
            largest = np.float64(most) * self.most * max(y.shape[1], 1)  # of any sum of products
        if max(largest, most ** 2 if most < 1e100 else np.inf, self.most ** 2 if self.most < 1e100 else np.inf) < NO_BOUNDS:
            q, r = self._may_enter(y, 1e-6 * (float(largest) + 1))
        else:
            q, r = (x.ravel() for x in np.indices((len(self.ids), len(ids))))
        other = self.ids[q] != ids[r]
        q, r = q[other], r[other]
        if not len(q):
            return
        score = self._scores(q, r, y, raw, largest)
        keep = np.flatnonzero(np.array([s >= least for s, least in zip(score, self.least[q].tolist())]) if score.dtype == object
                              else score >= self.least[q])
        q, r, score = q[keep], r[keep], score[keep]
        first = np.searchsorted(q, np.arange(len(self.ids) + 1))
        for i in np.unique(q):
            some = slice(first[i], first[i + 1])
            own, of = score[some], ids[r[some]]
            if own.dtype != object:
                top = np.lexsort((of, -own))[:self.k]
                own, of = own[top], of[top]
            both = sorted(zip([-int(s) for s in own] + [-s for s in self.scores[i]], of.tolist() + self.found[i].tolist()))[:self.k]
            self.scores[i], self.found[i] = [-s for s, _ in both], np.array([v for _, v in both], np.int64)
            if len(both) == self.k:
                self.least[i] = self._below(self.scores[i][-1])

    @staticmethod
    def _below(score: int) -> float:
        """A float that is not above the score."""
        try:
            near = float(score)
        except OverflowError:
            return np.finfo(float).max if score > 0 else -np.inf
        return near if abs(score) < FLOAT_SUMS else near - abs(near) * 1e-15

    def _may_enter(self, y: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a row whose bounds leave them a chance, coarse to fine."""
        levels = [summaries(y, s) for s in SEGMENTS]
        q, r = np.nonzero(self.levels[0] @ levels[0].T + slack >= self.least[:, None])
        for mine, theirs in zip(self.levels[1:], levels[1:]):
            if len(q) > len(self.ids) * len(y) // 8:  # most remain: one product is quicker
                may = np.zeros((len(self.ids), len(y)), bool)
                may[q, r] = True
                q, r = np.nonzero(may & (mine @ theirs.T + slack >= self.least[:, None]))
            else:
                bound = np.concatenate([
                    np.einsum("ij,ij->i", mine[q[i:i + 65536]], theirs[r[i:i + 65536]])
                    for i in range(0, len(q), 65536)] or [np.empty(0)])
                keep = bound + slack >= self.least[q]
                q, r = q[keep], r[keep]
        return q, r

    def _scores(self, q: np.ndarray, r: np.ndarray, y: np.ndarray, raw: np.ndarray, largest: float) -> np.ndarray:
        """Exact scores of pairs; ``largest``: what no sum exceeds."""
        if largest >= INTEGER_SUMS:
            mine = {i: integers(self.raw[i]) for i in np.unique(q).tolist()}
            theirs = {i: integers(raw[i]) for i in np.unique(r).tolist()}
            out = np.empty(len(q), object)
            out[:] = [sum(map(mul, mine[i], theirs[j])) for i, j in zip(q.tolist(), r.tolist())]
            return out
        if largest < FLOAT_SUMS and len(q) > len(self.ids) * len(y) // 8:
            return (self.x @ y.T)[q, r]
        x, y = (self.x, y) if largest < FLOAT_SUMS else (self.x.astype(np.int64), y.astype(np.int64))
        return np.concatenate([
            np.einsum("ij,ij->i", x[q[i:i + 65536]], y[r[i:i + 65536]]) for i in range(0, len(q), 65536)])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")
    ).filter(
        "vec_id IS NOT NULL AND x IS NOT NULL AND "
        "forall(x, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity'))"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, components) of the batch's vectors, those of one length together."""
    ids = batch.column(0).to_numpy()
    offsets = batch.column(1).offsets.to_numpy()
    lengths, flat = np.diff(offsets), batch.column(1).values.to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield ids[rows], flat[offsets[rows][:, None] + np.arange(n)].astype(np.float64)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its ``k`` best rows of ``vectors``.

    Both tables have vec_id and embedding. Components become floor(1024 * x); the score is
    their inner product. Ranks start at 1, ties go to the smaller vec_id, a query is never
    its own result, and it gets all rows if there are fewer than ``k``. Vectors that are
    null or hold a null or non-finite component take no part, nor do rows without vec_id;
    only vectors of the same length meet. Repeated query rows are one query. Scores are exact for
    finite components of any size; one that leaves 64 bits is ranked by its value, and is null.

    The stated queries go to the tasks in blocks of at most ``query_block`` rows, one scan of the
    vectors each; a task sends back at most ``k`` rows per query.
    """
    asked = usable(queries).dropDuplicates(["vec_id"])
    blocks = max(1, -(-asked.count() // query_block))
    bucket = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    parts = []
    for i in range(blocks):
        parts.append(_scan(usable(vectors), asked.filter(bucket == i).toArrow(), k))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _scan(rows: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    groups = {}
    for batch in asked.combine_chunks().to_batches():
        for ids, x in _by_length(batch):
            groups[x.shape[1]] = (ids, x)
    sent = rows.sparkSession.sparkContext.broadcast(groups)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {n: Best(ids, x, k) for n, (ids, x) in sent.value.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, ROW_BLOCK):
                for ids, y in _by_length(batch.slice(at, ROW_BLOCK)):
                    if y.shape[1] in best:
                        best[y.shape[1]].see(ids, y)
        for b in best.values():
            n, scores = [len(f) for f in b.found], [s for own in b.scores for s in own]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(b.ids, n)), pa.array(np.concatenate([*b.found, np.empty(0, np.int64)])),
                pa.array([s if -2**63 <= s < 2**63 else None for s in scores], pa.int64()),
                pa.array(map(place, scores), pa.binary()),
            ], names=["query_id", "vec_id", "score", "place"])

    return rows.mapInArrow(search, RESULT)
