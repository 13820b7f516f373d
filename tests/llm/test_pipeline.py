"""Every registered query without SQL, and each stage of the pipeline, against brute force."""

import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import brute as brute_hits
from test_passages import brute as brute_passages
from test_simhash import fingerprint, groups
from test_tokens import check_pieces
from tokenizers import Tokenizer

import corpus_pipeline as P
from siftline.llm import packing, quality, simhash
from siftline.llm import queries as Q
from siftline.llm.textbytes import give_back
from siftline.session import ARROW_ROWS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in Q.table(spark, SF, "documents").collect()]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(Q.WORD_BPE))


def ids_of(library, text, end):
    return library.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def components(rows):
    of = {}
    for i, t in rows:
        p = fingerprint(t)
        of[p] = min(i, of.get(p, i))
    prints = {i: p for p, i in of.items()}
    least = groups(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    return {i: least[of[fingerprint(t)]] for i, t in rows}


def test_op4(spark, texts, library):
    got = {r.doc_id: tuple(r)[1:] for r in Q.op4_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()}
    at, want = 0, {}
    for i, t in sorted(texts):
        ids = ids_of(library, t, 2)
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    assert got == want


def test_op5(spark, texts):
    got = {r.doc_id: r.component_id for r in Q.op5_simhash(spark, SF).collect()}
    assert got == components(texts)


def test_op6(spark, texts):
    got = Q.op6_quality(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in texts) and all(0 <= r.score <= 1 for r in got)


def test_op7(spark, texts):
    got = Q.op7_sharding(spark, SF).collect()
    sizes = Counter(r.shard for r in got)
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in texts)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_op8(spark):
    table = Q.table(spark, SF, "conversations").collect()
    got = Q.op8_quotes(spark, SF).collect()
    assert sorted((r.conv_id, r.turn, r.role) for r in got) == sorted((r.conv_id, r.turn, r.role) for r in table)
    heads = {}
    for r in table:
        heads[r.conv_id] = min(r.turn, heads.get(r.conv_id, r.turn))
    for r in got:  # no quotes here: every message answers the first of its conversation
        assert (r.thread_conv, r.thread_turn) == (r.conv_id, heads[r.conv_id])


def test_op10(spark, texts, library):
    got = Q.op10_packing(spark, SF).collect()
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.length
    assert tokens == {i: len(ids_of(library, t, 1)) for i, t in texts}
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and sum(filled.values()) > 0.97 * 2048 * len(filled)


def test_stages(spark, texts, library):
    docs = Q.table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    tables = {}
    for name, stage in P.STAGES:
        docs = tables[name] = P.written(stage(spark, docs, SF), "test-stage")
        if name != "packing":
            assert docs.columns == columns
            kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
            assert docs.filter("n_chars <> char_length(text)").count() == 0
    whole = Q.table(spark, SF, "documents")
    scores = quality.judged(whole, Q.table(spark, SF, "labels")).filter("predicted = 1").collect()
    assert sorted(i for i, _ in kept["quality classifier"]) == sorted(r.doc_id for r in scores)
    rows = kept["quality classifier"]
    assert sorted(i for i, _ in kept["simhash near-dedup"]) == sorted(set(components(rows).values()))
    rows = kept["simhash near-dedup"]
    cut = {r[0]: r for r in brute_passages(rows)}
    assert sorted(i for i, _ in kept["substring dedup"]) == sorted(
        i for i, _ in rows if cut[i][2] == 0 or cut[i][2] < cut[i][1])
    for i, t in kept["substring dedup"]:
        assert len(t.split()) == cut[i][1] - cut[i][2]
    rows = kept["substring dedup"]
    items = [(r.item_id, r.text) for r in Q.table(spark, SF, "benchmark").collect()]
    bad = {r[0] for r in brute_hits(rows, items) if r[5]}
    assert bad and sorted(i for i, _ in kept["benchmark decontamination"]) == sorted(i for i, _ in rows if i not in bad)
    rows = kept["benchmark decontamination"]
    check_pieces(tables["packing"].collect(), [(i, ids_of(library, t, 1)) for i, t in rows], packing.Limits())


def test_run_is_the_stages(spark):
    got = P.run(spark, SF)
    assert "ids" in got.columns and got.count() > 0 and P.ORACLE_SQL is None


def test_stages_of_empty_documents(spark, tmp_path):
    docs = Q.table(spark, SF, "documents").limit(0)
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_texts_reach_python_in_small_batches(spark):
    """A batch of 10,000 texts is held by each task in the JVM and in Python; a size of the user's own stays."""
    docs = spark.range(5000).selectExpr("id AS doc_id", "'some text' AS text").coalesce(1)
    before = spark.conf.get(ARROW_ROWS)
    try:
        for given, used in (("10000", "2048"), ("3000", "3000")):
            for stage in (quality.features, lambda d: simhash.fingerprints(d, ["doc_id"]),
                          lambda d: packing.packed(d, public_tokenizers.path(Q.WORD_BPE), 1)):
                spark.conf.set(ARROW_ROWS, given)
                stage(docs)
                assert spark.conf.get(ARROW_ROWS) == used
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_freed_arrays_are_given_back():
    def held():
        return sum(int(n) for n in re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))

    arrays = [np.ones(1 << 13) for _ in range(2000)]  # 64 KB each, from the heap
    last = np.ones(1 << 13)  # keeps the heap's top
    full = held()
    del arrays
    give_back()
    assert full - held() > 100_000 and last.sum() == 1 << 13
