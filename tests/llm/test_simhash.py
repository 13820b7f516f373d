import random

import numpy as np
import xxhash

from conftest_llm import rows_of
from siftline.llm import simhash as S
from siftline.llm.components import components


def fingerprint(t):
    w = (t or "").encode().lower().split()
    shingles = [b" ".join(w[k:k + 4]) for k in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(items, linked):
    """Smallest item that each reaches."""
    least = {i: i for i in items}
    changed = True
    while changed:
        changed = False
        for a in items:
            for b in items:
                if least[b] < least[a] and linked(a, b):
                    least[a] = least[b]
                    changed = True
    return least


def test_equals_brute_force(documents, document_rows):
    prints = [(r[0], fingerprint(r[1])) for r in document_rows]
    own = {}
    for i, p in prints:
        if i is not None:
            own[p] = min(i, own.get(p, i))
    of = {i: p for p, i in own.items()}
    least = groups(list(of), lambda a, b: (of[a] ^ of[b]).bit_count() <= 4)
    want = sorted(((i, f"{p:016x}", least[own[p]] if p in own else None) for i, p in prints), key=repr)
    assert rows_of(S.near_duplicates(documents), "doc_id", "fingerprint", "component_id") == want


def prints_near(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n)]
    return sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(7))) for b in base for _ in range(3)})


def test_walk_finds_each_pair_once():
    a = np.array(prints_near(150, 1), np.uint64)
    b = np.array(sorted({*prints_near(150, 1)[::2], *prints_near(50, 2)}), np.uint64)
    for other in (a, b):
        want = {(i, j) for i in range(len(a)) for j in range(len(other))
                if (int(a[i]) ^ int(other[j])).bit_count() <= 4 and (other is b or i < j)}
        got = [(int(i), int(j)) for p, q in S.walk(a, other, 0, 0) for i, j in zip(p, q)]
        assert len(got) == len(set(got)) and set(got) == want


def test_small_nodes_give_the_same_components(spark):
    values = prints_near(120, 3) + [0, 1, 2**63, 2**64 - 1]
    rows = [(k, int(np.uint64(v).astype(np.int64))) for k, v in enumerate(sorted(set(values)))]
    df = spark.createDataFrame(rows, "id bigint, fingerprint bigint")
    of = {k: v & (2**64 - 1) for k, v in rows}
    want = groups(list(of), lambda a, b: (of[a] ^ of[b]).bit_count() <= 4)
    prints = df.select(df.id.alias("doc_id"), "fingerprint")
    got = {r.doc_id: r.component_id for r in S.grouped(prints, node=20).collect()}
    assert got == want
    assert {r.doc_id: r.component_id for r in S.grouped(prints, node=10**6).collect()} == want


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40, 60)] + [(7, k) for k in range(100, 130)] + [(3, 100), (9, 9), (60, 41)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {k: 40 for k in range(40, 61)} | {k: 3 for k in [3, 7, *range(100, 130)]}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(documents, document_rows, no_documents):
    got = S.without_duplicates(documents)
    assert got.columns == documents.columns
    found = S.near_duplicates(documents).collect()
    kept = [r.doc_id for r in got.collect() if r.doc_id is not None]
    assert sorted(kept) == sorted({r.component_id for r in found if r.component_id is not None})
    assert S.near_duplicates(no_documents).count() == 0 and S.without_duplicates(no_documents).count() == 0


def test_a_full_node_is_cut(spark):
    """Half of the fingerprints share 24 bits: their groups stay bounded, and don't drive the depth."""
    rng = random.Random(8)
    hot = {(0xABCDEF << 40) | rng.getrandbits(12) << 20 for _ in range(900)}
    rows = [(v - (v >> 63 << 64), k) for k, v in enumerate(sorted(hot | {rng.getrandbits(64) for _ in range(len(hot))}))]
    prints = spark.createDataFrame(rows, "fingerprint bigint, id bigint")
    depth, placed = S.dealt(prints, node=64)
    assert depth < S.LEVELS and max(r["count"] for r in placed.groupBy("p", "q", "i", "j").count().collect()) < 4 * 64
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for x, y in S.links(prints, node=64).select("a", "b").collect():
        root[max(top(x), top(y))] = min(top(x), top(y))
    got = [top(k) for k in range(len(rows))]
    want = list(range(len(rows)))
    values = [v % 2**64 for v, _ in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if (values[i] ^ values[j]).bit_count() <= S.MOST_BITS]
    root[:] = want
    for x, y in links:
        root[max(top(x), top(y))] = min(top(x), top(y))
    assert got == [top(k) for k in range(len(rows))] and len(links) > 10_000


def test_rows_sent_do_not_grow_with_the_table(spark):
    """A fingerprint is sent once for each pair of blocks, however small the buckets are beside the table."""
    rng = random.Random(9)
    rows = [(k, rng.getrandbits(63)) for k in range(2000)]
    _, placed = S.dealt(spark.createDataFrame(rows, "id bigint, fingerprint bigint"), node=16)
    assert placed.count() < 17 * len(rows)


def test_a_frequent_key_links_all_its_near_pairs():
    """More fingerprints under one key than are compared pair by pair, in one near group and far from it."""
    values = np.array(sorted({7 ^ (1 << k) for k in range(64)} | {*prints_near(40, 5)} | {0b111 << 40 ^ 7}), np.uint64)
    got = S.linked(values, 0).root
    of = {k: int(v) for k, v in enumerate(values)}
    want = groups(list(of), lambda a, b: (of[a] ^ of[b]).bit_count() <= 4)
    assert len(values) > S.SMALL and len({*want.values()}) > 2
    assert [{*np.flatnonzero(got == r).tolist()} for r in np.unique(got)] == [
        {k for k in want if want[k] == r} for r in sorted({*want.values()})]
