import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import rows_of
from tokenizers import Tokenizer

from siftline.llm import packing, token_files
from siftline.llm.tokens import _PLAIN, PlainWords, Table, WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("words_kept", [20, 100_000])
def test_ids_are_the_library_s(library, document_rows, words_kept):
    rng = random.Random(1)
    odd = list("aB'sт1²<|endoftext|>\n\t \x85\u00a0 éÉß!…-_ΣσİıÀǅ\x00\u200b")
    plain = list("aB's1retll \n\r\tÉßā!-_.,'d")
    texts = [r[1] for r in document_rows] + [None, "", "''s's'S", "<|startoftext|>x"]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for pool in (odd, plain) for _ in range(1500)]
    ids, counts = WordTokenizer(PATH, words_kept).encode(texts)
    ends = np.cumsum(counts)
    got = [ids[e - n:e].tolist() for e, n in zip(ends, counts)]
    assert got == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_words_are_those_of_the_pattern():
    letters = "".join(c for c in _PLAIN if unicodedata.category(c)[0] == "L")
    pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^\\s{letters}0-9]+")
    rng = random.Random(3)
    for n in range(3000):
        pool = _PLAIN if n % 3 else "''" "''srtevmdlla1 .×÷é\n"
        texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(14))).lower() for _ in range(3)]
        words, want = PlainWords([t.encode() for t in texts]), [pattern.findall(t) for t in texts]
        assert [words.word(i).decode() for i in range(len(words))] == sum(want, [])
        assert words.per_text.tolist() == [len(x) for x in want]


def test_a_word_goes_to_the_library_once_whatever_stands_beside_it(library):
    asked = []

    class Model:
        def tokenize(self, word):
            asked.append(word)
            return library.model.tokenize(word)

    words = WordTokenizer(PATH)
    words.library = type("Library", (), {"model": Model()})
    texts = ["Some word, some (word). someword", "word; it's 'some' word!", "x" * 300 + " y" * 9 + " " + "x" * 300]
    for _ in range(2):
        ids, counts = words.encode(texts)
        assert ids.tolist() == sum((library.encode(t, add_special_tokens=False).ids for t in texts), [])
    assert len(asked) == len(set(asked)) and asked.count("word") == 1


def test_table_grows_and_tells_keys_of_one_hash_apart():
    rng = np.random.default_rng(1)
    table, keys = Table(4), rng.integers(0, 2**63, (5000, 4)).astype(np.uint64)
    keys[:60, 0] = 7
    for a in range(0, 5000, 900):
        some = np.arange(a, min(a + 900, 5000))
        assert (table.find(keys[some]) == -1).all()
        assert (table.add(keys[some], some % 3, np.repeat(some, some % 3)) == some).all()
    sizes, ids = table.lists(table.find(keys))
    assert (sizes == np.arange(5000) % 3).all() and (ids == np.repeat(np.arange(5000), sizes)).all()


def test_files_round_trip(spark, library, documents, document_rows, no_documents, tmp_path):
    token_files.write_tokens(documents, f"{tmp_path}/t", PATH, 2)
    encoded = {t: library.encode(t or "", add_special_tokens=False).ids + [2] for _, t, *_ in document_rows}
    got = token_files.checked(spark, f"{tmp_path}/t").orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = sorted(((r[0], len(encoded[r[1]]), crc(encoded[r[1]])) for r in document_rows), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == want
    index = token_files.read_index(spark, f"{tmp_path}/t")
    assert rows_of(index, "doc_id", "start", "n_tokens") == sorted(((r.doc_id, r.start, r.n_tokens) for r in got), key=repr)
    one = token_files.read_tokens(spark, f"{tmp_path}/t").filter("doc_id = 6").collect()
    assert [r.ids for r in one] == [encoded[t] for i, t, *_ in document_rows if i == 6]
    token_files.write_tokens(no_documents, f"{tmp_path}/none", PATH, 2)
    assert token_files.checked(spark, f"{tmp_path}/none").count() == 0


def test_file_layout(spark, documents, tmp_path):
    import glob

    import pyarrow.parquet as pq

    token_files.write_tokens(documents, f"{tmp_path}/t", PATH, 2)
    column = {}
    for f in glob.glob(f"{tmp_path}/t/tokens/*.parquet"):
        group = pq.ParquetFile(f).metadata
        for g in range(group.num_row_groups):
            for c in range(group.num_columns):
                meta = group.row_group(g).column(c)
                column[meta.path_in_schema] = meta
    assert "DELTA_BINARY_PACKED" in column["doc_id"].encodings
    assert any("DICTIONARY" in e for e in column["ids.list.element"].encodings)
    assert column["doc_id"].has_column_index and column["doc_id"].has_offset_index


def check_pieces(rows, encoded, limits):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length == len(r.ids) > 0 and r.ids_crc32 == crc(r.ids)
            at += r.length
        assert at <= limits.tokens and len(own) <= limits.segments and sum(r.loss_tokens for r in own) <= limits.loss_tokens
    ids = {}
    for key, own in pieces.items():
        for r in sorted(own, key=lambda r: r.start):
            ids.setdefault(key, []).append((r.start, list(r.ids)))
    want = {}
    for key, row in encoded:
        want.setdefault((key, len(row)), []).extend([(k, x) for k, x in enumerate(row)])
    got = {k: sorted((s + n, x) for s, part in v for n, x in enumerate(part)) for k, v in ids.items()}
    assert got == {k: sorted(v) for k, v in want.items()}
    return sequences


def test_packing_keeps_every_id(spark, library, documents, document_rows, no_documents):
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, *_ in document_rows]
    limits = packing.Limits(tokens=256)
    rows = packing.packed(documents.coalesce(1), PATH, 1, limits).collect()
    sequences = check_pieces(rows, encoded, limits)
    short = sum(sum(r.length for r in s) < 256 for s in sequences.values())
    assert short <= 1  # only the last sequence of a task
    check_pieces(packing.packed(documents, PATH, 1, limits).collect(), encoded, limits)
    assert packing.packed(no_documents, PATH, 1).count() == 0
    assert "ids" not in packing.packed(documents, PATH, 1, with_ids=False).columns


def test_packing_under_all_limits():
    """Prompts bear no loss: segments and loss-bearing tokens bind before tokens do."""
    from types import SimpleNamespace

    rng = random.Random(8)
    limits = packing.Limits(tokens=100, segments=4, loss_tokens=30)
    packer = packing.Packer(limits, 5 << 33, waiting=16)
    encoded, prompts = [], {}
    for i in range(400):
        n = rng.choice([1, 2, 5, 20, 60, 350])
        ids = np.array([rng.randrange(50_000) for _ in range(n)], np.int32)
        prompts[i] = rng.randrange(n + 1)
        packer.add(i, ids, prompts[i])
        encoded.append((i, ids.tolist()))
    packer.finish()
    batch = packer.take().to_pylist()
    rows = [SimpleNamespace(**r) for r in batch]
    check_pieces(rows, encoded, limits)
    loss = {}
    for r in rows:
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, prompts[r.doc_id]))
        loss[r.doc_id] = loss.get(r.doc_id, 0) + r.loss_tokens
    assert loss == {i: len(ids) - prompts[i] for i, ids in encoded}


def test_a_worker_s_words_take_few_bytes():
    """Several workers of an executor keep their words from stage to stage."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    words, before = WordTokenizer(PATH), held()
    words.encode([" ".join(word() for _ in range(1000)) for _ in range(120)])
    assert (held() - before) << 10 < 120 * 120_000


def held():
    from pathlib import Path

    from siftline.llm.textbytes import give_back

    give_back()
    return sum(int(n) for n in re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))
