import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from conftest_llm import rows_of

from siftline.llm import nearest as N
from siftline.llm import sharding as H
from siftline.llm.ranks import ranked


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(6)
    rows = [(k, [rng.uniform(-1, 1) ** 3 for _ in range(24)]) for k in range(400)]
    rows += [(1000 + k, rows[7][1]) for k in range(30)]  # ties
    rows += [(2000, None), (2001, [0.5, None]), (2002, [float("nan")] * 24), (2003, [float("inf")] * 24), (None, rows[0][1]),
             (2004, []), (2005, [0.5] * 3), (2006, [-0.25] * 3), (100, rows[100][1])]
    return spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id bigint, embedding array<double>, rank int").repartition(4), rows


def brute(rows, k):
    ok = [(i, [math.floor(1024 * Fraction(v)) for v in x]) for i, x in rows
          if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for q, x in dict(p for p in ok if p[0] % 100 == 0).items():
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(x) == len(y))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [2048, 2])
def test_nearest_equals_brute_force(vectors, block):
    df, rows = vectors
    got = N.nearest(df, df.filter("vec_id % 100 = 0"), 10, query_block=block)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == brute(rows, 10)


def test_nearest_of_few_and_none(spark, vectors):
    df, rows = vectors
    few = df.filter("vec_id IN (0, 1, 2)")
    assert N.nearest(few, few.filter("vec_id = 0"), 10).count() == 2
    assert N.nearest(df.limit(0), df.limit(0), 10).count() == 0
    assert N.nearest(df, df.limit(0), 10).count() == 0


@pytest.mark.parametrize("size", [4096.0, 5000.0, 1e6, 3e9, 1e19, 1e120, 1.7e308])
def test_nearest_of_large_values(spark, size):
    rng = random.Random(int(math.log(size)))
    rows = [(k, [rng.uniform(-1, 1) * (size if rng.random() < 0.3 else 1) for _ in range(6)]) for k in range(230)]
    rows += [(1000 + k, [size] * 6) for k in range(3)] + [(2000, [1e-9] * 6), (2100, [-size] * 6), (2001, [float("inf")] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    want = [(q, n, i, s if abs(s) < 2**63 else None) for q, n, i, s in brute(rows, 10)]
    assert rows_of(N.nearest(df, df.filter("vec_id % 100 = 0"), 10, query_block=2), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)


def test_places_sort_as_scores():
    rng = random.Random(1)
    scores = [0, 1, -1, 255, 256, -255, -256] + [rng.choice([-1, 1]) * rng.getrandbits(rng.randrange(1, 200)) for _ in range(300)]
    assert sorted(scores, key=N.place) == sorted(scores)



def test_shards_match_the_mixture(documents, document_rows):
    got = H.sharded_documents(documents, 4).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in document_rows), key=repr)
    count = Counter(r.shard for r in got)
    assert set(count) == set(range(4)) and max(count.values()) - min(count.values()) <= 1
    for shard in count:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(count[shard]))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_mixture_of_strata(spark):
    rng = random.Random(3)
    sources = ["hot"] * 700 + ["b"] * 200 + [None] * 80 + ["rare"] * 20
    rng.shuffle(sources)
    df = spark.createDataFrame([(k, s, 0) for k, s in enumerate(sources)], "id bigint, src string, slot int")
    got = H.interleaved(df, "src", "id", 10).collect()
    per = Counter((r.src, r.shard) for r in got)
    for s, n in Counter(sources).items():
        for shard in range(10):
            assert abs(per[(s, shard)] - n / 10) <= 1
    again = H.interleaved(df.repartition(7), "src", "id", 10).collect()
    assert {r.id: (r.shard, r.slot) for r in got} == {r.id: (r.shard, r.slot) for r in again}


def test_shards_of_few_rows(documents, no_documents):
    assert H.sharded_documents(no_documents, 8).count() == 0
    three = H.sharded_documents(documents.limit(3), 8).collect()
    assert sorted((r.shard, r.slot) for r in three) == [(0, 0), (1, 0), (2, 0)]


def test_ranks_in_groups_of_any_size(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(40)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    got = ranked(df, ["g"], ["v"], "rank", "test-ranks").collect()
    for g in ("a", "b", None):
        own = sorted((r["rank"], r.v) for r in got if r.g == g)
        assert [x[0] for x in own] == list(range(len(own)))
        assert [x[1] for x in own] == sorted(x[1] for x in own)
