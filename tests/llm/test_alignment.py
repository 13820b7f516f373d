import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest_llm import rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftline.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain_overlaps(a, b):
    """Tokens byte by byte."""
    links, closes, x, y = [], [], 0, 0
    for byte in range(1, (a[-1] if len(a) else 0) + 1):
        if not links or links[-1] != (x, y):
            links.append((x, y))
            closes.append(False)
        ends = a[x] == byte, b[y] == byte
        closes[-1] = all(ends)
        x, y = x + ends[0], y + ends[1]
    return links, closes


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 1000])
def test_pieces_of_any_length(steps):
    rng = random.Random(steps)
    for n in (*range(1, 25), 200):
        for density in (0.2, 0.8):
            a, b = (np.array(sorted({n, *(i for i in range(1, n) if rng.random() < density)})) for _ in range(2))
            cut = alignment.diagonals(a, b, steps)
            order = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
            assert cut.tolist() == [sum(side == 0 for _, side in order[:d]) for d in (*range(0, len(order), steps), len(order))]
            of_a, of_b, closes = alignment.overlaps(a, b, steps)
            links, ends = plain_overlaps(a.tolist(), b.tolist())
            assert list(zip(of_a.tolist(), of_b.tolist())) == links and closes.tolist() == ends
    assert [len(x) for x in alignment.overlaps(np.empty(0, np.int64), np.empty(0, np.int64))] == [0, 0, 0]


def expected(rows):
    """The query's rows, token by token."""
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(alignment.byte_characters())}
    names = {i: t for t, i in json.load(open(A))["model"]["vocab"].items()}
    found = []
    for doc_id, text in rows:
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        a_bytes = [bytes(letters[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:-1], 16)]) if b_lib.is_byte(i) else
                   b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append((doc_id, [], [], [], []))
            continue
        links, closes = plain_overlaps(np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist())
        groups, left = [], []
        for link, close in zip(links, closes):
            left.append(link)
            if close:
                groups.append(([a[i] for i in sorted({x for x, _ in left})], [b[j] for j in sorted({y for _, y in left})]))
                left = []
        found.append((doc_id, a, b, groups, [(a[x], b[y]) for x, y in links]))
    count = Counter(p for f in found for p in set(f[4]))
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out, count, most, {f[0]: f[3] for f in found}


@pytest.fixture(scope="module")
def given(document_rows):
    rng = random.Random(9)
    rows = [(i, t) for i, t, *_ in document_rows]
    odd = list("aB'sт1²<|endoftext|>\n\t \x85  éÉß!…▁ΣσİıÀǅ\x00​日本語🙂")
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["  two  spaces ", "▁", "<s>", "<0x41>", " ", "\n", "<|endoftext|>", "é" * 300, "🙂👍🏽 日本語テキスト"]
    return rows + [(5000 + k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("chunk_bytes", [alignment.CHUNK_BYTES, 1])
def test_query_against_plain_python(spark, given, chunk_bytes, monkeypatch):
    if chunk_bytes == 1:
        given = [r for r in given if len(r[1] or "") < 2000]
    df = spark.createDataFrame([(*r, 1, "x") for r in given], "doc_id bigint, text string, chunk int, pair string").repartition(3)
    found, pairs = alignment.aligned(df, A, B, chunk_bytes)
    want, count, most, _ = expected(given)
    assert sum(r[7] == "" for r in want) > 4 and sum(r[3] for r in want) > 1000
    assert rows_of(found, *COLUMNS) == sorted(want, key=repr)
    assert rows_of(pairs, "a_id", "b_id", "documents", "best") == sorted(
        ((a, b, n, n == most[a]) for (a, b), n in count.items()), key=repr)


def test_groups(spark, given):
    some = [r for r in given if r[0] is not None and r[0] >= 5000]
    got = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups]
           for r in alignment.groups(spark.createDataFrame(some, "doc_id bigint, text string"), A, B).collect()}
    assert got == expected(some)[3]


def test_no_documents(spark, no_documents):
    found, pairs = alignment.aligned(no_documents, A, B)
    assert found.count() == 0 and pairs.count() == 0
    found, pairs = alignment.aligned(no_documents.unionByName(spark.range(3).select(
        F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")), allowMissingColumns=True), A, B)
    assert rows_of(found, *COLUMNS) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(3)] and pairs.count() == 0
