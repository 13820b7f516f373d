import hashlib
import re

from conftest_llm import rows_of
from siftline.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(docs, items):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add("null" if i is None else str(i))
    out = []
    for doc_id, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[g]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_equals_brute_force(documents, benchmark, document_rows, benchmark_texts):
    want = brute([r[:2] for r in document_rows], benchmark_texts)
    assert any(r[5] for r in want) and any(r[2] and not r[5] for r in want)
    assert rows_of(D.contamination(documents, benchmark), *COLUMNS) == want


def test_without_broadcast(documents, benchmark):
    small = D.find_hits(documents.select("doc_id", "text"), benchmark)
    large = D.find_hits(documents.select("doc_id", "text"), benchmark, broadcast_bytes=0)
    columns = ("doc.doc_id", "n_words", "n_hit", "items", "spans")
    assert rows_of(small, *columns) == rows_of(large, *columns)


def test_empty_tables(documents, benchmark, no_documents):
    assert D.contamination(no_documents, benchmark).count() == 0
    clean = D.contamination(documents, benchmark.limit(0))
    assert clean.filter("contaminated OR n_hit > 0").count() == 0 and clean.count() == documents.count()


def test_documents_go_and_others_stay(documents, benchmark, document_rows, benchmark_texts):
    bad = {r[:2] for r, v in zip(document_rows, [None] * len(document_rows))
           if brute([r[:2]], benchmark_texts)[0][5]}
    kept = D.without_documents(documents, benchmark)
    assert kept.columns == documents.columns
    assert rows_of(kept, "doc_id", "text") == sorted((r[:2] for r in document_rows if r[:2] not in bad), key=repr)


def test_spans_are_cut(spark, benchmark, benchmark_texts):
    item = benchmark_texts[2][1]
    docs = spark.createDataFrame([(1, f"Before It {item} and After", "x"), (2, "Left, as is.", "y")], "doc_id int, text string, n_hit string")
    got = {r.doc_id: r.text for r in D.without_spans(docs, benchmark).collect()}
    assert got == {1: "Before It and After", 2: "Left, as is."}
