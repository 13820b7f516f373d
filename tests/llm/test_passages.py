import hashlib
import random

from conftest_llm import rows_of
from siftline.llm import passages as P


def brute(rows):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in split:
        if i is not None:
            for k in range(len(w) - 12):
                g = tuple(w[k:k + 13])
                least[g] = min(i, least.get(g, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and least[tuple(w[k:k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_equals_brute_force(documents, document_rows):
    want = brute([r[:2] for r in document_rows])
    assert sum(0 < r[2] < r[1] for r in want) > 3
    assert rows_of(P.digest(documents), *COLUMNS) == want


def test_few_words_many_repeats(spark, monkeypatch):
    """A vocabulary of three words: nearly every window recurs, inside documents too."""
    rng = random.Random(2)
    rows = [(rng.randrange(30), " ".join(rng.choice("ab c".split()) for _ in range(rng.randrange(60)))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert rows_of(P.digest(docs), *COLUMNS) == brute(rows)


def test_ids_of_64_bits(spark):
    shared = " ".join(f"word{k}" for k in range(20))
    ids = [2**63 - 1, 2**43, -(2**63), -5, 2**62 + 1, 2**50]
    rows = [(i, f"own start {k} {shared} own end {k}") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert rows_of(P.digest(docs), *COLUMNS) == brute(rows)


def test_small_chunks_give_the_same(document_rows):
    """An anchor's segments over several chunks: the shard keeps what it needs."""
    rng = random.Random(3)
    words = [rng.choice("abcd") for _ in range(40)]
    rows = sorted((7, rng.randrange(9), 0, 0, 0, " ".join(words[k:k + 15])) for k in (0, 1, 0, 2, 1, 0, 2, 5, 1, 0) for _ in range(2))
    rows = [(a, d, h, k * 100, k * 100 + 2, w) for k, (a, d, h, _, _, w) in enumerate(rows)]
    whole = P.Shard(13).scan(rows)
    parts, shard = [], P.Shard(13)
    for k in range(0, len(rows), 3):
        parts += shard.scan(rows[k:k + 3])
    assert [tuple(x) for x in whole] == [tuple(x) for x in parts] and whole


def test_stage_keeps_columns_and_untouched_texts(documents, document_rows, no_documents):
    got = P.without_passages(documents)
    assert got.columns == documents.columns
    removed = {(r[0], r[1]): r[2] for r in brute([r[:2] for r in document_rows])}
    texts = [r.text for r in got.collect()]
    for r in document_rows:
        if removed[(r[0], len((r[1] or "").encode().split()))] == 0:
            assert r[1] in texts
    assert got.filter("n_chars <> char_length(coalesce(text, ''))").count() == 0
    assert P.digest(no_documents).count() == 0 and P.without_passages(no_documents).count() == 0


def test_segments_without_a_recurring_window_are_left_out():
    """Anchors recur far more often than windows: only segments that may share one are looked at as words."""
    import pyarrow as pa

    rng = random.Random(6)
    rows = []
    for anchor in range(40):
        shared = [f"w{rng.randrange(10**6)}" for _ in range(14)]
        for doc in range(10):
            words = shared if doc in (2, 5) else shared[:6] + [f"x{rng.randrange(10**6)}" for _ in range(9)]
            rows.append((anchor, doc, doc, 0, len(words) - 13, " ".join(words)))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["anchor", "doc_id", "hash", "at", "until", "words"])
    got = P._candidates([batch.slice(0, 150), batch.slice(150)], 13)
    assert [r for r in rows if r[0] in (0, 39) or r[1] in (2, 5)] == got
    assert P.Shard(13).scan(got) == P.Shard(13).scan(rows) and len(got) < len(rows) / 3
