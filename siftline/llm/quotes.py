"""Quotation linking: quoted passages joined to the messages they come from.

A message's lines are split by their quote level (leading '>' marks). Each run of lines of
one level, each of its paragraphs and each of its lines is normalised and hashed; so is a
message's own text as a whole. A quoted passage comes from the first message that wrote it, in
the same conversation if there is one before, else in any before. Short parts of a text are
looked for in the same conversation only. A message answers the
one that its outermost quotes come from; without any, the first of its conversation.
Answers always point backwards, so following them gives threads, which may join several
conversations, and (conv_id, turn) puts every message after the one it answers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.ranks import ranked
from siftline.session import written

MARKS = re.compile(r"^(?:[ \t]*>)+[ \t]?")
SAID = re.compile(r"\bwrote:\s*$", re.IGNORECASE)
#: Parts of a text of fewer words link inside their conversation only; 1 lets every part link everywhere.
LEAST_WORDS = 3
#: Letters of scripts without spaces between words; each counts as a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

PARSED = (
    "body string, n_words bigint, body_sha256 string, n_quotes bigint, own array<struct<hash:binary,far:boolean>>, "
    "quoted array<struct<level:int,run:binary,whole:boolean,paragraph:boolean,far:boolean,hash:binary>>"
)


def levels(text: str) -> list[tuple[int, str]]:
    """(quote level, the rest) of every line; level 0 is the message's own.

    A line that ends in 'wrote:' right above a deeper quote belongs to that quote and is
    left out.
    """
    out = []
    for line in text.splitlines():
        marks = MARKS.match(line)
        out.append((marks.group().count(">"), line[marks.end():]) if marks else (0, line))
    return [
        (level, line) for i, (level, line) in enumerate(out)
        if not (i + 1 < len(out) and out[i + 1][0] > level and SAID.search(line))
    ]


def normal(text: str) -> str:
    """Words in lower case with one space between; other characters part words."""
    return " ".join(re.findall(r"\w+", text.casefold()))


def _hash(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def _long(words: str, least: int) -> bool:
    """Whether a normalised text is long enough to link to other conversations."""
    return words.count(" ") + 1 >= least or len(UNSPACED.findall(words)) >= least


def _paragraphs(lines: list[str]) -> set[str]:
    """The normalised paragraphs of some lines; empty lines part them."""
    out, held = set(), []
    for line in [*lines, ""]:
        if line.strip():
            held.append(line)
        else:
            out.add(normal(" ".join(held)))
            held = []
    return out - {""}


def parse(text: str | None, least_words: int = LEAST_WORDS) -> tuple:
    """A row of PARSED.

    ``far``: the passage may link to another conversation.
    """
    lines = levels(text or "")
    own_lines = [line.rstrip() for level, line in lines if level == 0]
    body = re.sub(r"\n{3,}", "\n\n", "\n".join(own_lines)).strip()
    own = {*_paragraphs(own_lines), *map(normal, own_lines)}
    quoted, runs, i = [], 0, 0
    while i < len(lines):
        level, j = lines[i][0], i
        while j < len(lines) and lines[j][0] == level:
            j += 1
        part = [line for _, line in lines[i:j]]
        run, paragraphs = normal(" ".join(part)), _paragraphs(part)
        if not level:
            own |= {run, *paragraphs}
        elif run:
            runs += 1
            quoted.append((level, _hash(run), True, True, True, _hash(run)))
            for one in sorted({*paragraphs, *map(normal, part)} - {run, ""}):
                quoted.append((level, _hash(run), False, one in paragraphs, _long(one, least_words), _hash(one)))
        i = j
    whole = normal(body)
    return (
        body, len(body.split()), hashlib.sha256(body.encode("utf-8", "surrogatepass")).hexdigest(), runs,
        [{"hash": _hash(t), "far": t == whole or _long(t, least_words)} for t in sorted({*own, whole} - {""})],
        [dict(zip(("level", "run", "whole", "paragraph", "far", "hash"), q)) for q in quoted],
    )


def parsed(messages: DataFrame, columns: list[str], least_words: int = LEAST_WORDS) -> DataFrame:
    """``columns`` of the messages and those of PARSED, written once for all who read it."""
    rows = messages.select(*columns, "text")
    spark, n = messages.sparkSession, len(columns)
    extra = spark.createDataFrame([], PARSED).schema
    schema = rows.drop("text").schema
    for field in extra:
        schema = schema.add(field)
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in extra]
    names = [*columns, *extra.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                found = list(zip(*(parse(t, least_words) for t in some.column(n).to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:n], *(pa.array(c, t) for c, t in zip(found, kinds))], names=names)

    return written(rows.mapInArrow(run, schema), "quotes-parsed")


def origins(parse_of: DataFrame) -> DataFrame:
    """From what ``parsed`` gives: (conv_id, turn, level, run, whole, paragraph, far, hash, from_conv, from_turn): the quoted passages with an origin.

    Firsts are found by aggregation, so a passage that many messages have is one row of
    the join for each conversation that quotes it, and one for all others.
    """
    known = parse_of.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    keys = ["conv_id", "turn"]
    quoted = known.select(*keys, F.explode("quoted").alias("q")).select(*keys, "q.*").distinct()
    first = (
        known.select(*keys, F.explode("own").alias("o")).select(*keys, "o.*")
        .groupBy("hash", F.col("conv_id").alias("c")).agg(
            F.min("turn").alias("t"), F.min(F.when(F.col("far"), F.col("turn"))).alias("far_t"))
    )
    here = first.join(quoted.select("hash", F.col("conv_id").alias("c")).distinct(), ["hash", "c"], "left_semi").select(
        F.col("hash").alias("_g"), F.col("c").alias("_c"), F.col("t").alias("_t"))
    anywhere = (
        first.filter("far_t IS NOT NULL").groupBy(F.col("hash").alias("_h"))
        .agg(F.min(F.struct("c", F.col("far_t").alias("t"))).alias("one"))
        .join(quoted.filter("far").select(F.col("hash").alias("_h")).distinct(), "_h", "left_semi")
    )
    before = F.struct(F.col("conv_id").alias("c"), F.col("turn").alias("t"))
    return (
        quoted
        .join(here, (F.col("hash") == F.col("_g")) & (F.col("conv_id") == F.col("_c")) & (F.col("_t") < F.col("turn")), "left")
        .join(anywhere, F.col("far") & (F.col("hash") == F.col("_h")) & (F.col("one") < before), "left")
        .filter("_t IS NOT NULL OR one IS NOT NULL")
        .select(*keys, "level", "run", "whole", "paragraph", "far", "hash",
                F.when(F.col("_t").isNotNull(), F.col("_c")).otherwise(F.col("one.c")).alias("from_conv"),
                F.coalesce("_t", "one.t").alias("from_turn"))
    )


def threads(parse_of: DataFrame) -> DataFrame:
    """From what ``parsed`` gives: (conv_id, turn, reply_conv, reply_turn, thread_conv, thread_turn, n_linked) of every message id.

    A thread is named by the message at its start, which answers none (nulls).
    """
    found = written(origins(parse_of), "quotes-origins")
    outer = found.filter("level = 1").groupBy("conv_id", "turn").agg(F.max(F.struct(
        "whole", "far", "paragraph", (F.col("from_conv") == F.col("conv_id")).alias("own"), "from_conv", "from_turn")).alias("best"))
    linked = (found.filter("whole OR paragraph").select("conv_id", "turn", "level", "run").distinct()
              .groupBy("conv_id", "turn").agg(F.count("*").alias("n_linked")))
    ids = parse_of.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("_"))
    heads = ids.groupBy("conv_id").agg(F.min("turn").alias("head"))
    hung = (
        ids.join(heads, "conv_id").join(outer, ["conv_id", "turn"], "left").join(linked, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                F.when(F.col("best").isNotNull(), F.struct(F.col("best.from_conv").alias("c"), F.col("best.from_turn").alias("t")))
                .when(F.col("turn") > F.col("head"), F.struct(F.col("conv_id").alias("c"), F.col("head").alias("t")))
                .alias("reply"))
    )
    here = F.struct(F.col("conv_id").alias("c"), F.col("turn").alias("t"))
    state = written(hung.withColumn("top", F.coalesce("reply", here)), "quotes-threads")
    while True:  # every round doubles the steps that ``top`` has taken
        above = state.select(here.alias("id"), F.col("top").alias("next"))
        jumped = state.join(above, state["top"] == above["id"]).select(
            *[c for c in state.columns if c != "top"], F.col("next").alias("top"), (F.col("next") != F.col("top")).alias("_moved"))
        state = written(jumped, "quotes-threads")
        moved = state.filter("_moved").limit(1).count()
        state = state.drop("_moved")
        if not moved:
            break
    return state.select("conv_id", "turn", F.col("reply.c").alias("reply_conv"), F.col("reply.t").alias("reply_turn"),
                        F.col("top.c").alias("thread_conv"), F.col("top.t").alias("thread_turn"), "n_linked")


def conversations(messages: DataFrame, bodies: bool = True, least_words: int = LEAST_WORDS) -> DataFrame:
    """The messages in reply order: thread_conv, thread_turn, position, and each one's data.

    Per row conv_id, turn, role, body (own text, without quotes; left out if ``bodies`` is
    false), n_words and body_sha256 of the body, n_quotes (quoted passages), n_linked
    (those with an origin, of the whole or of a paragraph), reply_conv and reply_turn. Positions count from 0 in a thread,
    by conv_id, turn and body. Rows with the same conv_id and turn are one message for
    links, and keep their own rows. Rows without conv_id or turn, and null texts, stay: the
    former without thread, reply and position, the latter with an empty body. Other columns
    are left behind. Parts of fewer than ``least_words`` words link inside their conversation
    only. No thread or conversation is gathered in one task.
    """
    own = ["body", "n_words", "body_sha256", "n_quotes"]
    parse_of = parsed(messages, ["conv_id", "turn", "role"], least_words)
    rows = parse_of.select("conv_id", "turn", "role", *(own if bodies else own[1:]))
    linked = threads(parse_of)
    joined = rows.join(linked, ["conv_id", "turn"], "left")
    placed = ranked(joined.withColumn("n_linked", F.coalesce("n_linked", F.lit(0))), ["thread_conv", "thread_turn"],
                    ["conv_id", "turn", "body_sha256"], "position", "quotes-order")
    return placed.withColumn("position", F.when(F.col("thread_conv").isNotNull(), F.col("position")))
