"""URL rules, and a character language-model ratio for the URLs that no rule covers.

The URLs that rules accept and those that they reject train one smoothed variable-order
Markov model each. All of it is DataFrame functions: character windows are counted over
all pages at once, both models' probabilities are worked out per distinct window, and a
page's score is the mean log ratio of its windows. Log ratios are whole millionths, so
sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.decontaminate import lower_ascii
from siftline.session import written

#: (host and path prefix, verdict)
RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"),
)
ORDER = 4  # characters of a window: one and up to three before it
SYMBOLS = 97  # printable ASCII, one for every other character, the end mark
BEFORE, END, OTHER = "\x02", "\x03", "\x7f"
FOLDS = 5  # one of so many labelled URLs is kept from training, for the threshold
BIN = 10_000  # threshold bins, in millionths
#: Rows of the window table up to which it is broadcast (about 100 bytes each).
BROADCAST_ROWS = 500_000


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path; both empty for a null url and one without ``://``."""
    url = F.coalesce(pages["url"], F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"^(?s:.*?)://", "")).otherwise("")
    return pages.withColumns({
        "host": lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    })


def rule_columns(rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of host and path: the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def windows(url: Column, order: int = ORDER) -> Column:
    """Array of the url's character windows, the last one ending in the end mark."""
    plain = F.regexp_replace(lower_ascii(F.coalesce(url, F.lit(""))), r"[^\x20-\x7E]", OTHER)
    chars = F.split(F.concat(F.lit(BEFORE * (order - 1)), plain, F.lit(END)), "")
    return F.transform(
        F.sequence(F.lit(1), F.char_length(plain) + 1),
        lambda i: F.array_join(F.slice(chars, i, order), ""),
    )


def ratios(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): log of accepted over rejected probability of the last character, in millionths.

    ``grams`` has gram, allow, block: every window of the pages and how often each model
    saw it. With n and t the counts and kinds of characters seen after a context, the
    probability is (count + t * that of the context without its first character) /
    (n + t): contexts with much evidence speak for themselves, unseen ones pass the
    question on, down to a uniform guess.
    """
    table = None
    for k in range(1, order + 1):
        tail = F.substring("gram", order - k + 1, k)
        level = grams.groupBy(tail.alias("tail")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = Window.partitionBy(F.substring("tail", 1, k - 1))
        level = level.withColumn("shorter", F.substring("tail", 2, k - 1))
        if table is None:
            level = level.withColumns({"p_allow": F.lit(1 / SYMBOLS), "p_block": F.lit(1 / SYMBOLS)})
        else:
            level = level.join(table, "shorter")
        p = {}
        for side in ("allow", "block"):
            n = F.sum(side).over(context)
            kinds = F.sum((F.col(side) > 0).cast("int")).over(context)
            p[side] = F.when(n > 0, (F.col(side) + kinds * F.col(f"p_{side}")) / (n + kinds)).otherwise(F.col(f"p_{side}"))
        table = level.select(F.col("tail").alias("shorter"), p["allow"].alias("p_allow"), p["block"].alias("p_block"))
    return table.select(
        F.col("shorter").alias("gram"),
        F.round(1e6 * (F.log("p_allow") - F.log("p_block"))).cast("long").alias("ratio"),
    )


def threshold(scored: DataFrame) -> float:
    """The mean log ratio, in millionths, that best parts the labelled URLs kept from training.

    Taken from counts per bin and label (a few thousand rows at most): the middle of the
    cuts with the least sum of both error rates; 0 if one label has no such URL.
    """
    bins = (
        scored.filter("said IS NOT NULL AND kept_out")
        .groupBy(F.floor(F.col("mean") / BIN).alias("bin"))
        .agg(F.sum((F.col("said") == "allow").cast("int")).alias("allow"),
             F.sum((F.col("said") == "block").cast("int")).alias("block"))
        .orderBy("bin").collect()
    )
    allow, block = sum(b["allow"] for b in bins), sum(b["block"] for b in bins)
    if not allow or not block:
        return 0.0
    best, cuts, wrong_allow, right_block = 3.0, [], 0, 0
    for b in bins:  # cut below this bin
        error = wrong_allow / allow + 1 - right_block / block
        if error < best - 1e-12:
            best, cuts = error, []
        if error < best + 1e-12:
            cuts.append(b["bin"])
        wrong_allow, right_block = wrong_allow + b["allow"], right_block + b["block"]
    return cuts[len(cuts) // 2] * float(BIN)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
           broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict and score.

    The verdict is the fitting rule's; without one it is 'allow' if the score (mean log
    ratio per character, accepted over rejected) reaches the calibrated threshold. A null
    url is scored as an empty one. Repeated rows are judged one by one; other columns are
    left behind. The table of windows is bounded by SYMBOLS ** ORDER; up to
    ``broadcast_rows`` (counted) it is broadcast, beyond it is joined as Spark chooses.
    """
    rule, said = rule_columns(rules)
    known = parsed(pages.select("page_id", "url")).select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", "host", "path",
        rule.alias("rule"), said.alias("said"),
        (F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0).alias("kept_out"),
    )
    seen = known.withColumn("gram", F.explode(windows(F.col("url"))))
    counted = lambda side: F.sum(((F.col("said") == side) & ~F.col("kept_out")).cast("int"))
    grams = written(seen.groupBy("gram").agg(
        F.coalesce(counted("allow"), F.lit(0)).alias("allow"),
        F.coalesce(counted("block"), F.lit(0)).alias("block"),
    ), "url-windows")
    table = written(ratios(grams), "url-ratios")
    if table.count() <= broadcast_rows:
        table = F.broadcast(table)
    scored = written(
        seen.join(table, "gram").groupBy("row").agg(
            F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
            F.first("rule").alias("rule"), F.first("said").alias("said"), F.first("kept_out").alias("kept_out"),
            (F.sum("ratio") / F.count("*")).alias("mean"),
        ), "url-scores",
    )
    least = threshold(scored)
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("mean") >= least, "allow").otherwise("block")).alias("verdict"),
        (F.col("mean") / 1e6).alias("score"),
    )
