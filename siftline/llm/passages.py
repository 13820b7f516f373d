"""Substring dedup: recurring passages found by anchors, confirmed by sharded phrase automata.

0. Copies. Of documents with equal texts all but the smallest lose every window; they need no
   further look, and do not make a passage recur.
1. Anchors. Of every 13 consecutive words the run of ANCHOR words with the least hash is
   chosen. Equal windows choose equal anchors, so a passage of 13 words that two texts
   share shows as an anchor that both have.
2. Recurring anchors: those of two or more texts, by the hashes of anchors and texts.
3. Segments. A document's windows whose anchor recurs are cut out as short runs of words,
   one run for each place of an anchor, and dealt out by anchor.
4. Automata. Each shard takes its segments by anchor and document; the windows of a chunk of
   anchors, with the smallest document that has each, are compiled into an Aho-Corasick
   automaton over word numbers, and the chunk's segments are streamed through it to locate
   every occurrence. The words themselves are compared: hashes only leave out segments of
   which no window has the hash of another window of the chunk.
5. Every document drops the words of the windows that a smaller document has too.

A window of a block of documents that a smaller document of the same block has too is
settled at once; only the first document of a block with given words goes on. A phrase
that a third of all documents share thus costs a row for each block, not for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.columns import neutral, restored
from siftline.llm.ranks import shuffle_partitions
from siftline.llm.textbytes import Words, blocks, give_back, grams, mixed

WINDOW = 13
ANCHOR = 5
#: Bytes of text that send an anchor once; texts of a block of segments; segments of an automaton.
FIRST_BYTES = 8 << 20
TEXTS = 512
CHUNK = 20_000
ALL = -1
RESULT = ("n_words", "n_removed", "kept")
SPAN = ["doc_id", "hash", "at", "until"]


def _text_words(texts: list[str | None]) -> Words:
    return Words([(t or "").encode("utf-8", "surrogatepass") for t in texts])


def chosen(words: Words, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, their anchors' places, anchor hashes by place): the places are of words.

    A window is given by its first word; only windows inside one text count.
    """
    none = np.empty(0, np.int64)
    if len(words) < window:
        return none, none, np.empty(0, np.uint64)
    h = grams(words.hashes(), anchor)
    least = sliding_window_view(h, window - anchor + 1).argmin(1)
    first = np.arange(len(least))
    text = np.repeat(np.arange(len(words.per_text)), words.per_text)
    inside = text[first] == text[first + window - 1]
    return first[inside], (first + least)[inside], h


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """(key, anchor, hash, again): the anchors of every text (by its hash), dealt out by ``key``.

    Of a block of texts one with an anchor comes under the anchor as key (and null
    anchor), the others under keys of their own. ``again``: the anchor recurs for certain,
    as the block has it in two texts.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            a, d = (np.concatenate(x) if held else np.empty(0, t)
                    for x, t in zip(zip(*held) if held else ((), ()), (np.uint64, np.int64)))
            order = np.lexsort((d, a))
            a, d = a[order], d[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
            a, d = a[new], d[new]
            first = np.ones(len(a), bool)
            first[1:] = a[1:] != a[:-1]
            recurs = ~first
            recurs[:-1] |= ~first[1:]
            key = np.where(first, a, mixed(a ^ mixed(d.view(np.uint64))))
            return pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(a.view(np.int64), mask=first), pa.array(d), pa.array(recurs)],
                names=["key", "anchor", "hash", "again"])

        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                some = batch.slice(k, TEXTS)
                ids, texts = some.column(0).to_numpy(), some.column(1).to_pylist()
                for a, b in blocks(len(t or "") for t in texts):
                    words = _text_words(texts[a:b])
                    _, places, h = chosen(words, window)
                    places = np.unique(places)
                    of = np.repeat(ids[a:b], words.per_text)
                    held.append((h[places], of[places]))
                    size += len(words.raw)
                    if size >= FIRST_BYTES:
                        yield flush()
                        held, size = [], 0
        yield flush()
        held = []
        give_back()

    return docs.select("hash", "text").mapInArrow(
        find, "key bigint, anchor bigint, hash bigint, again boolean")


def _recurring(docs: DataFrame, window: int) -> DataFrame:
    """(hash, anchors): the recurring anchors of each text that has some."""
    found = _anchors(docs, window).withColumn("settled", F.col("anchor").isNotNull())
    group = Window.partitionBy("key", "settled")  # a row for each block of texts at most
    return (
        found.withColumns({"least": F.min("hash").over(group), "most": F.max("hash").over(group),
                           "ever": F.max("again").over(group)})
        .filter("ever OR least <> most")
        .groupBy("hash").agg(F.collect_set(F.coalesce("anchor", "key")).alias("anchors"))
    )


def _segments(rows: DataFrame, window: int) -> DataFrame:
    """Runs of words around recurring anchors, and windows settled inside a block of texts.

    A run (words) begins at word ``at`` of the document; its windows begin there up to
    ``until``. Settled windows have no words, and keys of their own instead of the anchor.
    """
    schema = "anchor bigint, doc_id bigint, hash bigint, at int, until int, words string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                yield _cut_block(batch.slice(k, TEXTS), window)
        give_back()

    first = ["doc_id", "hash", "text", "anchors", "of"]
    return rows.select(*first, *[c for c in rows.columns if c not in first]).mapInArrow(cut, schema)


def _cut_block(some: pa.RecordBatch, window: int) -> pa.RecordBatch:
    ids, hashes, texts = some.column(0).to_numpy(), some.column(1).to_numpy(), some.column(2).to_pylist()
    # the anchors of another text with the same doc_id are no use
    texts = [t if own else None for t, own in zip(texts, hashes == some.column(4).to_numpy())]
    lists = some.column(3)
    bounds = lists.offsets.to_numpy()
    wanted = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    seen: dict[bytes, list] = {}
    for a, b in blocks(len(t or "") for t in texts):
        words = _text_words(texts[a:b])
        first, places, h = chosen(words, window)
        upto = np.cumsum(words.per_text)
        begin = upto - words.per_text
        text = np.searchsorted(upto, first, side="right")
        ranges = np.searchsorted(text, np.arange(b - a + 1))
        keep = np.zeros(len(first), bool)
        for i in range(b - a):
            own = slice(ranges[i], ranges[i + 1])
            keep[own] = np.isin(h[places[own]], wanted[bounds[a + i]:bounds[a + i + 1]])
        first, places, text = first[keep], places[keep], text[keep]
        if not len(first):
            continue
        # consecutive windows of one anchor's place make one run
        new = np.ones(len(first), bool)
        new[1:] = (places[1:] != places[:-1]) | (first[1:] != first[:-1] + 1)
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(first)) - 1
        of, at, until = text[start], first[start], first[end]
        raw = words.raw
        for left, right, doc, hashed, anchor, f, l in zip(
            words.starts[at].tolist(), words.ends[until + window - 1].tolist(), ids[a + of].tolist(),
            hashes[a + of].tolist(), h[places[start]].view(np.int64).tolist(),
            (at - begin[of]).tolist(), (until - begin[of]).tolist(),
        ):
            seen.setdefault(b" ".join(raw[left:right].split()), []).append((doc, hashed, anchor, f, l))
    out: list[tuple] = []
    for run, found in seen.items():
        least = min(found)[0]
        for doc, hashed, anchor, f, l in found:
            if doc > least:
                out.append((anchor, doc, hashed, f, l, None))
            else:
                out.append((anchor, doc, hashed, f, l, run.decode("utf-8", "surrogatepass")))
    columns = list(zip(*out)) if out else [()] * 6
    anchor, doc, at = (np.array(columns[i], np.int64).view(np.uint64) for i in (0, 1, 3))
    settled = np.array([c is None for c in columns[5]], bool)
    columns[0] = np.where(settled, mixed(anchor ^ mixed(doc ^ mixed(at))), anchor).view(np.int64)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)],
        names=["anchor", "doc_id", "hash", "at", "until", "words"])


class Shard:
    """Chunks of segments in the order of anchor and document.

    Keeps the windows of the chunk before that belong to its last anchor, with their
    smallest documents: an anchor's segments may go on in the next chunk.
    """

    def __init__(self, window: int):
        self.window, self.anchor, self.open = window, None, {}

    def scan(self, rows: list[tuple]) -> list[tuple]:
        """Compiles the chunk's windows and streams its segments: (doc_id, hash, at, until)."""
        size, number = self.window, {}
        runs = [tuple(number.setdefault(w, len(number)) for w in row[5].split(" ")) for row in rows]
        smallest: dict[tuple, int] = {}
        if self.open and rows[0][0] == self.anchor:
            for words, doc in self.open.items():
                smallest[tuple(number.setdefault(w, len(number)) for w in words)] = doc
        for row, run in zip(rows, runs):
            for i in range(len(run) - size + 1):
                smallest.setdefault(run[i:i + size], row[1])  # documents come in ascending order
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, doc in smallest.items():
            automaton.add_word(key, doc)
        automaton.make_automaton()
        out = []
        for (_, doc, hashed, at, until, _), run in zip(rows, runs):
            repeats = [at + end - size + 1 for end, least in automaton.iter(run) if least < doc]
            for i, f in enumerate(repeats):
                if i and f == repeats[i - 1] + 1:
                    out[-1][3] = f
                else:
                    out.append([doc, hashed, f, f])
        last, name = rows[-1][0], list(number)
        kept = self.open if last == self.anchor else {}
        for row, run in zip(rows, runs):
            if row[0] == last:
                for i in range(len(run) - size + 1):
                    kept.setdefault(tuple(name[w] for w in run[i:i + size]), row[1])
        self.anchor, self.open = last, kept
        return out


def _candidates(held: list[pa.RecordBatch], window: int) -> list[tuple]:
    """The segments of a chunk that may share a window: those with a window of which the hash
    recurs, and all of the first and the last anchor, which go on in other chunks."""
    rows = pa.Table.from_batches(held)
    anchor = rows.column(0).to_numpy()
    keep = (anchor == anchor[0]) | (anchor == anchor[-1])
    texts = rows.column(5).cast(pa.binary()).to_pylist()
    hashes, of = [], []
    for a, b in blocks(map(len, texts)):
        words = Words(texts[a:b])
        h = grams(words.hashes(), window)
        text = np.repeat(np.arange(a, b), words.per_text)
        inside = text[:len(h)] == text[len(text) - len(h):]
        hashes.append(h[inside])
        of.append(text[:len(h)][inside])
    h, of = np.concatenate(hashes), np.concatenate(of)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    keep[of[order[1:][same]]] = True
    keep[of[order[:-1][same]]] = True
    return list(zip(*(c.to_pylist() for c in rows.filter(pa.array(keep)).columns)))


def _located(segments: DataFrame, window: int) -> DataFrame:
    """(doc_id, hash, at, until): runs of windows that a smaller document has too."""
    shards = segments.repartition(shuffle_partitions(segments), "anchor").sortWithinPartitions("anchor", "doc_id")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size = Shard(window), [], 0
        for batch in batches:
            with_words = batch.column(5).is_valid()
            yield batch.filter(pc.invert(with_words)).select(SPAN)
            held.append(batch.filter(with_words))
            size += held[-1].num_rows
            if size >= CHUNK:
                yield found(shard.scan(_candidates(held, window)))
                held, size = [], 0
                give_back()
        if size:
            yield found(shard.scan(_candidates(held, window)))
        del shard, held
        give_back()

    def found(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=SPAN)

    return shards.mapInArrow(locate, "doc_id bigint, hash bigint, at int, until int")


def removals(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, spans): by document the runs (hash, at, until) of windows to take out.

    ``texts`` has doc_id, hash, text and maybe others; ``hash`` tells rows with the same doc_id apart. A
    copy of a smaller document has the run from 0 to ALL.
    """
    exact = texts.select("doc_id", "hash", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("sha"))
    first = exact.groupBy("sha", "hash").agg(F.min("doc_id").alias("first"))
    copies = exact.distinct().join(first, ["sha", "hash"]).filter("doc_id > first").select(
        "doc_id", "hash", F.lit(0).alias("at"), F.lit(ALL).alias("until"))
    anchors = _recurring(texts, window).join(first, "hash").select(
        F.col("first").alias("id"), F.col("hash").alias("of"), "anchors")
    segments = _segments(texts.join(anchors, F.col("doc_id") == F.col("id")).drop("id"), window)
    return _located(segments, window).unionAll(copies).groupBy(F.col("doc_id").alias("id")).agg(
        F.collect_list(F.struct("hash", "at", "until")).alias("spans"))


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_removed and kept (the words left, joined by one space).

    Columns of these names are replaced.

    A word goes if a window of ``window`` words that covers it also starts in a document
    with a smaller doc_id; windows are judged on the texts as given. Null and empty texts
    have no words. Rows with the same doc_id don't judge each other; each is judged by its
    own text. A null doc_id is smaller than none and loses nothing. An untouched text's
    ``kept`` is its words joined by one space.
    """
    rows, names = neutral(docs.drop(*RESULT))
    return _judged(rows, names, window).select(*[F.col(new).alias(old) for old, new in names.items()], *RESULT)


def _judged(docs: DataFrame, names: dict[str, str], window: int) -> DataFrame:
    """``docs`` under neutral names, with the columns of RESULT."""
    columns = docs.columns
    others = [c for c in columns if c not in (names["doc_id"], names["text"])]
    keyed = docs.select(
        F.col(names["doc_id"]).cast("long").alias("doc_id"), F.xxhash64(names["text"]).alias("hash"),
        F.col(names["text"]).alias("text"), *others,
    )
    named, nameless = keyed.filter("doc_id IS NOT NULL"), keyed.filter("doc_id IS NULL")
    # both joins with the texts are by doc_id alone and take all columns, so that they share one exchange
    spans = removals(named, window)
    rows = named.join(spans, F.col("doc_id") == F.col("id"), "left").drop("id").unionAll(
        nameless.withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    ).select(F.col("doc_id").cast(docs.schema[names["doc_id"]].dataType).alias(names["doc_id"]),
             F.col("text").alias(names["text"]), *others, "hash", "spans").select(*columns, "hash", "spans")
    schema = docs.withColumns(dict(zip(RESULT, (F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(""))))).schema
    n, at = len(columns), columns.index(names["text"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                some = batch.slice(k, TEXTS)
                left = [
                    _rest(text, [s for s in spans or () if s["hash"] == hashed], window)
                    for text, hashed, spans in zip(*(some.column(i).to_pylist() for i in (at, n, n + 1)))
                ]
                totals, gone, kept = zip(*left)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:n], pa.array(totals, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(kept, pa.string())], names=[*columns, *RESULT])
        give_back()

    return rows.mapInArrow(take, schema)


def _rest(text: str | None, spans: list[dict], window: int) -> tuple[int, int, str]:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if any(s["until"] == ALL for s in spans):
        kept = words if len(words) < window else []
    elif spans:
        edge = np.zeros(len(words) + 1, np.int64)
        for s in spans:
            edge[s["at"]] += 1
            edge[s["until"] + window] -= 1
        kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    else:
        kept = words
    return len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row doc_id, n_words, n_removed and the SHA-256 of the words kept."""
    return deduplicated(docs.select("doc_id", "text"), window).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def without_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without recurring passages: same columns, n_chars of the new text.

    Untouched texts stay as they are; documents of which nothing is left go.
    """
    rows, names = neutral(docs)
    text = names["text"]
    out = _judged(rows, names, window).filter("n_removed = 0 OR n_removed < n_words").withColumn(
        text, F.when(F.col("n_removed") == 0, F.col(text)).otherwise(F.col("kept")))
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return restored(out, names)
