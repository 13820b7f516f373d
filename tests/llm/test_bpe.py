import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftline.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("words_kept", [20, 100_000])
def test_ids_and_texts_are_the_library_s(library, document_rows, words_kept):
    rng = random.Random(2)
    odd = list("aB'sт1²<|endoftext|>\n\t \x85  éÉß!…-_ΣσİıÀǅ\x00​×÷ªº")
    plain = list("aB'_s1retll \n\r\tÉßā!-.,'d")
    texts = [r[1] for r in document_rows] + [None, "", "''s's'S", "<|startoftext|>x", "a<|endoftext|><|startoftext|>", "_a__b 1_2"]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for pool in (odd, plain) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdeétion") for _ in range(n)) for n in (250, 255, 256, 257, 300, 5000)]
    codec = bpe.Codec(PATH, words_kept)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = [codec.encode(t) for t in texts]
    assert [g.tolist() for g in got] == want
    assert [codec.decode(g) for g in got] == library.decode_batch(want, skip_special_tokens=False)
    assert len(codec.words) <= words_kept


def test_every_single_character(library):
    texts = [f"a{chr(c)}B {chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    codec = bpe.Codec(PATH)
    assert [codec.encode(t).tolist() for t in texts] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_scan_and_heap_agree():
    rng = random.Random(3)
    merges = bpe.codec(PATH).words.merges
    for n in (*range(1, 40), 120, 200, 400):
        word = "".join(rng.choice("aeinrsté") for _ in range(n)).encode()
        ids = [merges.inner[b] for b in word[:-1]] + [merges.final[word[-1]]]
        scanned = merges._scanned(list(ids), list(range(len(ids))))
        assert scanned == merges._by_heap(list(ids), list(range(len(ids))))
        cuts = [*scanned[1], len(word)]  # boundaries and ids say the same
        letters = bpe.byte_characters()
        assert [bpe.codec(PATH).tokens[i] for i in scanned[0]] == [
            "".join(letters[b] for b in word[x:y]) + ("</w>" if y == len(word) else "") for x, y in zip(cuts, cuts[1:])]


def test_query_columns(spark, library, documents, document_rows, no_documents):
    got = bpe.round_trip(documents, PATH)
    want = []
    for i, t, *_ in document_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bpe.round_trip(no_documents, PATH).count() == 0
    clash = documents.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    assert rows_of(bpe.encoded(clash, PATH), "doc_id") == rows_of(documents, "doc_id")


def test_decoding_of_other_lists(spark, library):
    rows = [(1, None), (2, []), (3, [320, None, 70_000, 49407]), (None, [5])]
    got = {r.doc_id: r.decoded for r in bpe.decoded(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"), PATH).collect()}
    assert got == {1: "", 2: "", 3: library.decode([320, 70_000, 49407], skip_special_tokens=False),
                   None: library.decode([5])}
    assert bpe.Codec(PATH).decode(np.array([], np.int32)) == ""


def test_models_that_are_not_supported():
    with pytest.raises(ValueError):
        bpe.Merges({"vocab": {"a": 0}, "merges": [], "byte_fallback": True})
