import hashlib
import random
import zlib
from collections import Counter

import pytest
from conftest_llm import rows_of, text

from siftline.llm import quality as Q
from siftline.llm import quotes as C
from siftline.llm import textbytes


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for k in range(700):
        t, good = text(rng, rng.randrange(8, 60)), rng.random() < 0.7
        if not good:
            t = rng.choice([lambda t: " ".join(w + "!!" for w in t.upper().split()), lambda t: " ".join(w + "%%%" for w in t.split()),
                            lambda t: " ".join(w for w in t.split()[:8] for _ in range(9))])(t)
        rows.append((k, t, "en", "s", len(t), "x"))
        labels.append((k, int(good), 0))
    rows += [(None, None, None, None, None, None), (9000, "", "en", "s", 0, "x"), (9001, "x" * 50_000, "en", "s", 1, "x"), rows[0]]
    labels += [(0, 1 - labels[0][1], 0), (1, None, 0), (None, 1, 0), (8888, 0, 0), (3, 7, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, quality_score string")
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows, dict(x[:2] for x in labels[:700])


def test_held_out_accuracy(corpus):
    docs, labels, rows, truth = corpus
    got = Q.judged(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) > 0.97 * len(held)


def test_words_of_one_form_have_vectors_of_their_own(spark):
    rng = random.Random(3)
    words = list({"".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(400)})
    truth = {k: rng.randrange(2) for k in range(500)}
    rows = [(k, " ".join(rng.choice(words[v::2]) for _ in range(rng.randrange(30, 60)))) for k, v in truth.items()]
    got = Q.judged(spark.createDataFrame(rows, "doc_id int, text string").repartition(3),
                   spark.createDataFrame(list(truth.items()), "doc_id int, quality int"))
    assert dict(got.dtypes)["doc_id"] == "int"
    held = [r for r in got.collect() if r.held_out]
    assert len(held) > 60 and sum((r.score >= 0.5) == truth[r.doc_id] for r in held) > 0.95 * len(held)


def own_vectors(codes):
    places, signs = Q.own_components(codes)
    return (Q.np.arange(Q.WORD_SIZE) == places[:, None]) * signs[:, None].astype(int)


def test_word_sums_of_blocks_add_up(monkeypatch):
    rng = random.Random(9)
    texts = [text(rng, rng.randrange(0, 30)).encode() for _ in range(60)] + [b"", b"one"]
    monkeypatch.setattr(Q, "SLAB", 7)
    words = Q.Words(texts)
    codes, which, n = Q.np.unique(Q.word_codes(words), return_inverse=True, return_counts=True)
    of = Q.np.repeat(Q.np.arange(len(texts)), words.per_text)
    own, want = own_vectors(codes), Q.np.zeros((len(codes), Q.WORD_SIZE), int)
    for i in range(len(which)):
        for j in range(max(0, i - 2), min(len(which), i + 3)):
            if i != j and of[i] == of[j]:
                want[which[i]] += own[which[j]]
    assert (Q._context_sums(codes, which, n, of) == want).all()
    for v in (want, Q.np.array([], int), Q.np.array([2**63 - 1, -(2**63), 0])):
        assert (Q._unpacked(Q._packed(v)) == v.ravel()).all() and (Q._bits_unpacked(Q._bits_packed(v)) == v.ravel()).all()


def test_features_over_blocks_and_parts_equal_plain_numpy(spark):
    np, rng = Q.np, random.Random(12)
    rows = [(k, text(rng, rng.randrange(0, 60))) for k in range(120)] + [(500, None), (None, "odd one out"), (501, "same same " * 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: np.frombuffer(r.x, "<f2").astype(float) for r in Q.features(df, chunk_bytes=900, part_words=300).collect()}
    assert len(got) == len(rows)
    sums, count, all_codes, own = {}, Counter(), {}, {}
    for doc, t in rows:
        codes = Q.word_codes(Q.Words([(t or "").encode()])).tolist()
        all_codes[doc] = codes
        own |= {c: own_vectors(np.array([c], np.uint64))[0] for c in codes}
        for i, c in enumerate(codes):
            count[c] += 1
            near = [own[codes[j]] for j in range(max(0, i - Q.REACH), min(len(codes), i + Q.REACH + 1)) if j != i]
            sums[c] = sums.get(c, 0) + sum(near, np.zeros(Q.WORD_SIZE, int))
    total = sum(count.values())
    for doc, codes in all_codes.items():
        x = got[doc]
        assert x[4 * Q.SIZE] == pytest.approx(np.log1p(len(codes)), abs=0.01)
        mean, square = np.zeros(Q.WORD_SIZE), np.zeros(Q.WORD_SIZE)
        if codes:
            weights = np.array([0.002 / (0.002 + count[c] / total) for c in codes])
            units = np.array([sums[c] / max(np.linalg.norm(sums[c]), 1e-9) for c in codes])
            mean, square = (np.average(v, axis=0, weights=weights) for v in (units, units ** 2))
        want = np.hstack([mean, np.sqrt(np.maximum(square - mean ** 2, 0))])
        assert x[4 * Q.SIZE + 1:] == pytest.approx(want, abs=0.01), doc


def test_words_repeat_inside_a_text_only():
    texts = [b"lonely", b"lonely", b"lonely lonely end", b"", b"end of it"]
    together = Q.Words(texts)
    alone = [Q.Words([t]) for t in texts]
    for of in (Q.word_codes, Q.terms):
        assert of(together).tolist() == [x for w in alone for x in of(w).tolist()]
    assert (Q.word_codes(together) == Q.AGAIN).sum() == 1


def test_a_document_id_trains_once(spark, monkeypatch):
    rows = [(k, f"some text number {k}") for k in range(60)] + [(1, f"another text {k}") for k in range(80)]
    labels = [(k, k % 2) for k in range(60)]
    seen, train = [], Q.train
    monkeypatch.setattr(Q, "train", lambda x, y: seen.append(len(x)) or train(x, y))
    Q.judged(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert zlib.crc32(b"1") % 5 and seen == [sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(60))]


def test_held_out_labels_do_not_count(spark, corpus):
    docs, labels, rows, truth = corpus
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    for a, b in zip(*(rows_of(Q.judged(docs, x), "doc_id", "score") for x in (labels, turned))):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-4)


def test_labels_dealt_at_random_teach_nothing(spark, corpus):
    docs, _, rows, truth = corpus
    rng = random.Random(1)
    values = list(truth.values())
    rng.shuffle(values)
    shuffled = dict(zip(truth, values))
    df = spark.createDataFrame(list(shuffled.items()), "doc_id bigint, quality bigint")
    held = [r for r in Q.judged(docs, df).collect() if r.held_out and r.doc_id in truth]
    good, bad = ([r.score for r in held if shuffled[r.doc_id] == v] for v in (1, 0))
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    assert 0.3 < auc < 0.7


def test_few_or_no_labels_and_no_documents(corpus):
    docs, labels, rows, truth = corpus
    assert {r.score for r in Q.judged(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.judged(docs.limit(0), labels).count() == 0
    assert {r.score for r in Q.judged(docs, labels.filter("quality = 1")).collect()} == {1.0}


def test_rejected_documents_go(corpus):
    docs, labels, rows, truth = corpus
    kept = Q.without_rejected(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    good = [k for k, v in truth.items() if v]
    assert len(set(good) & set(ids)) > 0.97 * len(good) and len([k for k in truth if not truth[k] and k in ids]) < 15
    assert {r.quality_score for r in kept.collect()} <= {"x", None}


MESSAGES = [
    (1, 0, "user", "How do I sort a list in place?\n\nThanks for any help."),
    (1, 1, "assistant", "> How do I sort a list IN place?\n\nCall its sort method."),
    (1, 2, "user", "On Monday Bob wrote:\n> Alice wrote:\n>> How do I sort a list in place?\n>\n> Call its sort method.\nThat works, great."),
    (1, 3, "user", "unrelated remark of mine"),
    (2, 0, "user", ">That works, great.\nDoes it work for tuples as well?"),
    (2, 1, "assistant", "> > nothing known\n> Does it work for tuples as well?\nNo."),
    (3, 5, "user", "> No.\nThe last word."),
    (3, 5, "user", "A repeated turn."),
    (3, 6, "user", "> something that nobody ever said\nHm."),
    (4, 0, None, None), (4, 1, "user", ""), (None, 0, "user", "> How do I sort a list in place?\nno conversation"), (5, None, "user", "no turn"),
]


def test_quotes_link_and_go(spark):
    df = spark.createDataFrame([(*m, 1) for m in MESSAGES], "conv_id bigint, turn bigint, role string, text string, position int").repartition(4)
    got = C.conversations(df).collect()
    assert len(got) == len(MESSAGES)
    one = {(r.conv_id, r.turn): r for r in got}
    reply = {k: (r.reply_conv, r.reply_turn) for k, r in one.items()}
    assert reply[(1, 0)] == (None, None) and reply[(1, 1)] == (1, 0) and reply[(1, 2)] == (1, 1)
    assert reply[(1, 3)] == (1, 0)  # quotes nothing: answers the first message
    assert reply[(2, 0)] == (1, 2) and reply[(2, 1)] == (2, 0) and reply[(3, 5)] == (2, 1) and reply[(3, 6)] == (3, 5)
    assert {(r.thread_conv, r.thread_turn) for r in got if r.conv_id in (1, 2, 3) and r.turn is not None} == {(1, 0)}
    assert one[(1, 2)].body == "That works, great." and (one[(1, 2)].n_quotes, one[(1, 2)].n_linked) == (2, 2)
    assert (one[(2, 1)].n_quotes, one[(2, 1)].n_linked) == (2, 1) and one[(3, 6)].n_linked == 0
    thread = sorted((r.position, r.conv_id, r.turn) for r in got if r.thread_conv == 1)
    assert [t[0] for t in thread] == list(range(9)) and [t[1:] for t in thread] == sorted(t[1:] for t in thread)
    assert (one[(4, 0)].thread_conv, one[(4, 0)].body, one[(4, 1)].position) == (4, "", 1)
    assert (one[(None, 0)].thread_conv, one[(None, 0)].position, one[(None, 0)].body) == (None, None, "no conversation")
    assert one[(5, None)].reply_conv is None
    assert all(r.body_sha256 == hashlib.sha256(r.body.encode()).hexdigest() for r in got)


def test_long_reply_chains(spark):
    rows = [(k, 0, "u", (f"> message number {k - 1} of many\n" if k else "") + f"message number {k} of many") for k in range(40)]
    got = C.conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), bodies=False).collect()
    assert {(r.thread_conv, r.thread_turn) for r in got} == {(0, 0)} and sorted(r.position for r in got) == list(range(40))
    assert C.conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


@pytest.mark.parametrize("least", [1, C.LEAST_WORDS])
def test_origins_against_a_naive_search(spark, least):
    rng = random.Random(least)
    vocabulary = ["yes", "no", "maybe so", "the red door is open", "ok ok", "see you at noon", "\u65e5\u672c\u8a9e", "A. b"]
    texts = {}
    for conv in range(9):
        for turn in range(rng.randrange(1, 8)):
            lines = [rng.choice(vocabulary + [""]) for _ in range(rng.randrange(1, 5))]
            for _ in range(rng.randrange(3)):
                if texts:
                    old = rng.choice(list(texts.values())).split("\n")
                    lines += [rng.choice(["> ", ">> "]) + x for x in old[:rng.randrange(1, 4)]] + ["", rng.choice(vocabulary)]
            texts[conv, turn] = "\n".join(lines)
    own = {k: {o["hash"]: o["far"] for o in C.parse(t, least)[4]} for k, t in texts.items()}
    want = set()
    for (conv, turn), t in texts.items():
        for q in C.parse(t, least)[5]:
            here = [k for k in own if k[0] == conv and k[1] < turn and q["hash"] in own[k]]
            far = [k for k in own if q["far"] and k < (conv, turn) and own[k].get(q["hash"])]
            if here or far:
                want.add((conv, turn, q["level"], q["run"], q["whole"], q["paragraph"], q["hash"], *min(here or far)))
    df = spark.createDataFrame([(*k, t) for k, t in texts.items()], "conv_id bigint, turn bigint, text string").repartition(3)
    got = C.origins(C.parsed(df, ["conv_id", "turn"], least)).drop("far").collect()
    assert {tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got} == want and len(want) > 20


def test_levels():
    assert C.levels("a\n> b\n>> c\n > > d\nX wrote:\n> e\nhe wrote:") == [
        (0, "a"), (1, "b"), (2, "c"), (2, "d"), (1, "e"), (0, "he wrote:")]


def test_short_parts_and_paragraphs_link(spark):
    three = "first part of it\nis here\n\nsecond part comes\nnow\n\nthird and last part"
    rows = [
        (1, 0, "shopping list for today\n\napples\npears\nplums\n\n你好世界再见朋友\n你们\n\nbye"),
        (1, 1, "unrelated words between these"),
        (1, 2, "> apples\n> pears plums\nsure"),
        (1, 3, "other words again, unrelated"),
        (1, 4, "> bye\nso soon?"),  # a short paragraph, in its conversation
        (1, 5, "> 你们\nhm"),
        (2, 0, "hello there all\n\nbye\n\nsee you"),
        (2, 1, "> bye\nnot from conversation 1"),
        (3, 0, "nothing of note"), (3, 1, "> bye\nsaid elsewhere only, in a part"),
        (4, 0, "> 你好世界再见朋友\nfrom another conversation"),  # long without spaces
        (5, 0, three), (5, 1, "words unlike all others"),
        (5, 2, "> second part\n> comes now\n>\n> third and\n> last part\nyes"),
        (6, 0, "no relation whatsoever"), (6, 1, "> who knows\nmy own answer runs\nover two lines\n> who else\nand it goes on below"),
        (6, 2, "filler message without quotes"), (6, 3, "> my own answer runs over\n> two lines\nindeed"),
    ]
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id int, turn int, role string, text string").repartition(3)
    got = {(r.conv_id, r.turn): r for r in C.conversations(df).collect()}
    reply = {k: (r.reply_conv, r.reply_turn) for k, r in got.items()}
    assert reply[(1, 2)] == (1, 0) and reply[(1, 4)] == (1, 0) and reply[(1, 5)] == (1, 0)
    assert [got[(1, t)].n_linked for t in (1, 2, 4, 5)] == [0, 1, 1, 1]
    assert got[(2, 1)].n_linked == 1 and reply[(2, 1)] == (2, 0)
    assert got[(3, 1)].n_linked == 0 and reply[(3, 1)] == (3, 0)
    assert reply[(4, 0)] == (1, 0)
    assert reply[(5, 2)] == (5, 0) and got[(5, 2)].n_linked == 1
    assert reply[(6, 3)] == (6, 1) and got[(6, 3)].n_linked == 1


def test_registered_query_returns_the_bodies(spark, tmp_path):
    from siftline.llm.queries import registered

    df = spark.createDataFrame(MESSAGES, "conv_id bigint, turn bigint, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = registered()["op8_quotes"](spark, str(tmp_path)).collect()
    assert len(got) == len(MESSAGES) and all(r.body_sha256 == hashlib.sha256(r.body.encode()).hexdigest() for r in got)
    assert "That works, great." in {r.body for r in got}


def test_scores_take_one_python_worker_a_task(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(k, text(rng, 20)) for k in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, quality int")
    plan = Q.judged(df, labels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_a_chunk_s_words_are_hashed_once(monkeypatch):
    made, numbers = [], textbytes._numbers
    monkeypatch.setattr(textbytes, "_numbers", lambda: made.append(1) or numbers())
    chunk = Q.Chunk(0)
    chunk.add(1, 2, b"some words, some more")
    assert len(list(chunk.frames(4))) > 1 and len(made) == 1


def test_pooling_equals_plain_numpy_whatever_the_texts_lengths():
    np = Q.np
    rng = np.random.default_rng(2)
    vectors, sizes = rng.normal(size=(50, 6)).astype(np.float32), np.array([0, 3, 2500, 0, 1, 40, 999, 0])
    of, weight = rng.integers(0, 50, sizes.sum()), rng.random(sizes.sum())
    got, at = Q._mean_and_deviation(vectors, of, weight, sizes), 0
    for row, n in zip(got, sizes.tolist()):
        x, w = vectors[of[at:at + n]].astype(float), weight[at:at + n]
        mean = np.average(x, axis=0, weights=w) if n else np.zeros(6)
        square = np.average(x ** 2, axis=0, weights=w) if n else np.zeros(6)
        assert row == pytest.approx(np.hstack([mean, np.sqrt(np.maximum(square - mean ** 2, 0))]), abs=1e-6)
        at += n
