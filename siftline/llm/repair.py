"""Conversation repair: the cheapest edits that give user and assistant in turn.

The edit lattice of a conversation has a node for each number of rows read and each state of
the wanted order ``(s?(ua)+)?`` of role initials. Keep costs 0, Rerole (to user or assistant)
3, Delete 4, Insert (an empty user or assistant row) 3; blank and repeated rows can only be
deleted, and a truncated row that stays costs 3 more. It is searched by Dijkstra from both
ends: a forward and a reverse heap meet, every crossing of equal cost is finished, and of those
the edits whose initials, joined, come first in ASCII order are taken. (Of two paths with the
same rows read and the same cost neither's initials begin the other's, so the least label of
every node is enough.)

No conversation meets in one task. Rows are ranked by range, cut into segments of ``SEGMENT``
rows, and each segment is searched for every pair of states before and after it; a
conversation of one segment, as nearly all are, is done with that. A longer one is a walk over
its segments' small tables, without texts, which keeps only what is not yet decided; the edits
then go back to the segments by key.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.ranks import ranked, shuffle_partitions
from siftline.session import written

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: Rows of a conversation that are searched at once.
SEGMENT = 64
WHITE = " \t\n\v\f\r"
ENDS = ".!?"
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
GOALS = (START, ASSISTANT)
#: The state after a user or assistant row put in where the state allows one.
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
#: The state after a row that keeps its role, by its initial.
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
LEGAL = {"su", "ua", "au"}
SOUND, UNUSABLE, TRUNCATED = range(3)


def _edges(rows: list[tuple[str, int]], i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, rows read, state) of every edit at a node. ``rows``: initial and fault of each."""
    yield INSERT, INSERT_COST, i, NEXT[q]
    if i < len(rows):
        initial, fault = rows[i]
        yield DELETE, DELETE_COST, i + 1, q
        if fault != UNUSABLE:
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            yield REROLE, REROLE_COST + more, i + 1, NEXT[q]
            if (initial, q) in KEPT:
                yield KEEP, more, i + 1, KEPT[initial, q]


def _edges_back(rows: list[tuple[str, int]], i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
    """The same edges, of those that lead to a node, with where they come from."""
    for p in STATES:
        if NEXT[p] == q:
            yield INSERT, INSERT_COST, i, p
    if i > 0:
        initial, fault = rows[i - 1]
        yield DELETE, DELETE_COST, i - 1, q
        if fault != UNUSABLE:
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            for p in STATES:
                if NEXT[p] == q:
                    yield REROLE, REROLE_COST + more, i - 1, p
                if KEPT.get((initial, p)) == q:
                    yield KEEP, more, i - 1, p


class Side:
    """One direction of the search: its heap, the least (cost, edits) of each node, settled nodes.

    Nodes of equal cost leave the heap in the order of the rows between them and the side's
    start, as Keep costs nothing and an edit put before others can sort before them.
    """

    def __init__(self, rows: list, starts: list[tuple[int, int]], back: bool):
        self.rows, self.back, self.edges = rows, back, _edges_back if back else _edges
        self.label: dict[tuple[int, int], tuple[int, str]] = {}
        self.done: set[tuple[int, int]] = set()
        self.heap: list[tuple[int, int, str, int]] = []
        for i, q in starts:
            self.offer(i, q, 0, "")

    def offer(self, i: int, q: int, cost: int, edits: str) -> bool:
        if (i, q) in self.label and self.label[i, q] <= (cost, edits):
            return False
        self.label[i, q] = cost, edits
        heapq.heappush(self.heap, (cost, len(self.rows) - i if self.back else i, edits, q))
        return True

    def least(self) -> int | None:
        """The cost at the top of the heap."""
        while self.heap:
            cost, far, edits, q = self.heap[0]
            node = (len(self.rows) - far if self.back else far, q)
            if node not in self.done and self.label[node] == (cost, edits):
                return cost
            heapq.heappop(self.heap)
        return None

    def settle(self) -> Iterator[tuple[int, int]]:
        """Takes the top; gives every node whose label got less by it."""
        cost, far, edits, q = heapq.heappop(self.heap)
        i = len(self.rows) - far if self.back else far
        self.done.add((i, q))
        for edit, more, j, p in self.edges(self.rows, i, q):
            joined = edit + edits if self.back else edits + edit
            if (j, p) not in self.done and self.offer(j, p, cost + more, joined):
                yield j, p


def cheapest(rows: list[tuple[str, int]], before: int, after: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest way through all rows from a state to one of others."""
    ahead = Side(rows, [(0, before)], back=False)
    behind = Side(rows, [(len(rows), q) for q in after], back=True)
    best = 0 if not rows and before in after else None
    while True:
        a, b = ahead.least(), behind.least()
        # beyond this sum no path is left that both sides haven't met, those of equal cost included
        if a is None or b is None or (best is not None and a + b > best):
            break
        side, other = (ahead, behind) if a <= b else (behind, ahead)
        for node in side.settle():
            if node in other.label:
                cost = side.label[node][0] + other.label[node][0]
                best = cost if best is None else min(best, cost)
    if best is None:
        return None
    return best, min(
        edits + behind.label[node][1] for node, (cost, edits) in ahead.label.items()
        if node in behind.label and cost + behind.label[node][0] == best
    )


def applied(rows: list[tuple[str, str]], edits: str, state: int) -> list[tuple[str, str, str]]:
    """(role, text, edit) of the rows that the edits leave or put in, from a state on."""
    out, at = [], 0
    for edit in edits:
        if edit == KEEP:
            out.append((*rows[at], edit))
            state = KEPT[rows[at][0][:1], state]
        elif edit != DELETE:
            state = NEXT[state]
            out.append(("user" if state == USER else "assistant", rows[at][1] if edit == REROLE else "", edit))
        at += edit != INSERT
    return out


def state_after(initials: list[str], edits: str, state: int) -> int:
    at = 0
    for edit in edits:
        if edit == KEEP:
            state = KEPT[initials[at], state]
        elif edit != DELETE:
            state = NEXT[state]
        at += edit != INSERT
    return state


ROWS = "array<struct<position:bigint,role:string,text:string>>"
TABLE = "array<struct<before:int,after:int,cost:bigint,edits:string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal")
SOLVED = (
    f"conv_id bigint, segment bigint, rows {ROWS}, first string, last string, "
    f"{', '.join(f'{c} bigint' for c in COUNTS)}, table {TABLE}"
)


def _faults(texts: list[str], repeated: list[bool]) -> tuple[list[int], list[int]]:
    """Of each row what the search must know; and how many are blank, duplicate and truncated."""
    kinds, n = [], [0, 0, 0]
    for text, again in zip(texts, repeated):
        end = text.rstrip(WHITE)[-1:]
        fault = 0 if not end else 1 if again else 2 if end not in ENDS else None
        if fault is not None:
            n[fault] += 1
        kinds.append(SOUND if fault is None else TRUNCATED if fault == 2 else UNUSABLE)
    return kinds, n


def _solve(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for s in batch.to_pylist():
            rows, firsts = s["rows"], set(s["firsts"])
            kinds, n = _faults([r["text"] for r in rows], [r["position"] not in firsts for r in rows])
            initials = [r["role"][:1] for r in rows]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            lattice = list(zip(initials, kinds))
            table = []
            if s["segment"] == 0 and len(rows) < size:  # the whole conversation
                cost, edits = cheapest(lattice, START, GOALS)
                table.append((START, state_after(initials, edits, START), cost, edits))
            else:
                for before in STATES if s["segment"] else (START,):
                    for after in STATES:
                        found = cheapest(lattice, before, (after,))
                        if found:
                            table.append((before, after, *found))
            out.append({
                "conv_id": s["conv_id"], "segment": s["segment"], "rows": rows, "first": initials[0], "last": initials[-1],
                **dict(zip(COUNTS, (*n, illegal))),
                "table": [dict(zip(("before", "after", "cost", "edits"), t)) for t in table]})
        yield pa.RecordBatch.from_pylist(out, SOLVED_ARROW)


_ROW = pa.struct([("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_ENTRY = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])
SOLVED_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("rows", pa.list_(_ROW)), ("first", pa.string()), ("last", pa.string()),
    *((c, pa.int64()) for c in COUNTS), ("table", pa.list_(_ENTRY))])


@dataclass
class Walk:
    """One conversation's segments in order: the least (cost, edits) for each state so far.

    Edits and the way back are kept only from the last state on that all labels have in
    common.
    """

    labels: dict[int, tuple[int, str]] = field(default_factory=lambda: {START: (0, "")})
    open: list[tuple[int, dict, dict]] = field(default_factory=list)  # segment, its table, state before by state after
    look_at: int = 64

    def add(self, segment: int, table: list[dict]) -> Iterator[tuple[int, int, str]]:
        """Takes a segment; gives (segment, state before, edits) of those now decided."""
        best: dict[int, tuple[tuple[int, str], int]] = {}
        entries = {(t["before"], t["after"]): (t["cost"], t["edits"]) for t in table}
        for (before, after), (cost, edits) in entries.items():
            if before in self.labels:
                label = self.labels[before][0] + cost, self.labels[before][1] + edits
                if after not in best or label < best[after][0]:
                    best[after] = label, before
        self.labels = {q: label for q, (label, _) in best.items()}
        # what follows these costs no more from ASSISTANT, but for a kept system row, which is
        # a Delete there; without this, having deleted everything would stay open for ever
        if ASSISTANT in best:
            for state, more in ((START, DELETE_COST), (SYSTEM, 0)):
                if state in best and self.labels[state][0] > self.labels[ASSISTANT][0] + more:
                    del self.labels[state]
        self.open.append((segment, entries, {q: before for q, (_, before) in best.items()}))
        if len(self.open) >= self.look_at:
            yield from self._decided()
            self.look_at = max(64, 2 * len(self.open))

    def _decided(self) -> Iterator[tuple[int, int, str]]:
        states = set(self.labels)
        for k in range(len(self.open) - 1, -1, -1):
            states = {self.open[k][2][q] for q in states}
            if len(states) == 1:
                settled = list(self._back(k, states.pop()))
                yield from settled
                length = sum(len(edits) for _, _, edits in settled)
                self.labels = {q: (cost, edits[length:]) for q, (cost, edits) in self.labels.items()}
                del self.open[:k]
                return

    def _back(self, k: int, state: int) -> Iterator[tuple[int, int, str]]:
        out = []
        for segment, entries, back in reversed(self.open[:k]):
            out.append((segment, back[state], entries[back[state], state][1]))
            state = back[state]
        return reversed(out)

    def end(self) -> tuple[int, list[tuple[int, int, str]]]:
        """The cost of the whole, and what was still open."""
        (cost, _), state = min((self.labels[q], q) for q in GOALS if q in self.labels)
        return cost, list(self._back(len(self.open), state))


DECIDED = (
    "conv_id bigint, segment bigint, before int, edits string, cost bigint, audit string, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
)
_DECIDED_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("before", pa.int32()), ("edits", pa.string()), ("cost", pa.int64()),
    ("audit", pa.string()), *((c, pa.int64()) for c in COUNTS)])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of DECIDED from segments in order; the last row of a conversation has its totals."""
    out, conv, walk, parts, totals, last = [], None, None, [], None, ""

    def take(decided) -> None:
        for segment, before, edits in decided:
            parts.append(edits)
            out.append({"conv_id": conv, "segment": segment, "before": before, "edits": edits})

    def end() -> None:
        if walk:
            cost, decided = walk.end()
            take(decided)
            out[-1] |= {"cost": cost, "audit": "".join(parts), **totals}

    for batch in batches:
        for s in batch.to_pylist():
            if walk is None or s["conv_id"] != conv:
                end()
                conv, walk, parts, totals, last = s["conv_id"], Walk(), [], dict.fromkeys(COUNTS, 0), ""
            for c in COUNTS:
                totals[c] += s[c]
            if s["segment"]:
                totals["illegal"] += last + s["first"] not in LEGAL
            last = s["last"]
            take(walk.add(s["segment"], s["table"]))
        # the last row of a conversation may still get its totals
        yield pa.RecordBatch.from_pylist(out[:-1], _DECIDED_ARROW)
        del out[:-1]
    end()
    yield pa.RecordBatch.from_pylist(out, _DECIDED_ARROW)


_LINE = pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
_LINES_ARROW = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("lines", pa.list_(_LINE))])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for s in batch.to_pylist():
            rows = [(r["role"], r["text"]) for r in s["rows"]]
            lines = [dict(zip(("role", "text", "edit"), x)) for x in applied(rows, s["edits"], s["before"])]
            out.append({"conv_id": s["conv_id"], "segment": s["segment"], "lines": lines})
        yield pa.RecordBatch.from_pylist(out, _LINES_ARROW)


def repaired(conversations: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Every conversation of (conv_id, turn, role, text) repaired. Two tables:

    ``report``: conv_id, blank, duplicate, truncated (rows by their first fault), illegal
    (neighbouring rows whose initials aren't su, ua or au), cost, audit (initials of the
    edits). ``lines``: conv_id, segment, lines: the repaired rows (role, text, edit) of each
    segment, in order.

    Rows are taken by turn, nulls first, ties by role and text. Null roles and texts are one
    space, null conv_ids one conversation; repeated rows are duplicates of the first one.
    Other columns are left behind. Texts of any length are taken whole.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    placed = ranked(rows, ["conv_id"], ["turn", "role", "text"], "position", "repair-rows")
    number = F.floor(F.col("position") / segment).cast("long")
    # the first of equal rows, however many there are, by a hash of the text
    firsts = placed.groupBy("conv_id", "role", F.unhex(F.sha2("text", 256)).alias("sha")).agg(
        F.min("position").alias("position"))
    both = placed.select("conv_id", "position", "role", "text", F.lit(None).cast("long").alias("first")).unionByName(
        firsts.select("conv_id", "position", F.lit(None).cast("string").alias("role"),
                      F.lit(None).cast("string").alias("text"), F.col("position").alias("first")))
    segments = both.groupBy("conv_id", number.alias("segment")).agg(
        F.array_sort(F.collect_list(F.when(F.col("role").isNotNull(), F.struct("position", "role", "text")))).alias("rows"),
        F.collect_list("first").alias("firsts"))
    solved = written(segments.mapInArrow(lambda b: _solve(b, segment), SOLVED), "repair-segments")
    in_order = _in_order(solved.drop("rows"))
    decided = written(in_order.mapInArrow(_walk, DECIDED), "repair-edits")
    report = decided.filter(F.col("cost").isNotNull()).select("conv_id", *COUNTS, "cost", "audit")
    edits = decided.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "before", "edits")
    lines = solved.select("conv_id", "segment", "rows").join(
        edits, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("segment") == F.col("_segment"))
    ).select("conv_id", "segment", "rows", "before", "edits").mapInArrow(
        _apply, "conv_id bigint, segment bigint, lines array<struct<role:string,text:string,edit:string>>")
    return report, lines


def _in_order(segments: DataFrame) -> DataFrame:
    """A conversation's segments one after the other in one task."""
    return segments.repartition(shuffle_partitions(segments), "conv_id").sortWithinPartitions("conv_id", "segment")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order are hashed as they come; none but the present one is kept."""
    conv, hashed, empty = None, None, True
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    for batch in batches:
        out = []
        for s in batch.to_pylist():
            if hashed is None or s["conv_id"] != conv:
                if hashed:
                    out.append((conv, hashed.hexdigest()))
                conv, hashed, empty = s["conv_id"], hashlib.sha256(), True
            for line in s["lines"]:
                hashed.update(("" if empty else "\n").encode() + f"{line['role']}:{line['text']}".encode())
                empty = False
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema)
    if hashed:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": hashed.hexdigest()}], schema)


DAMAGES = 20


def damage(conv_id: Column, turn: Column) -> Column:
    """The damage of a row, 0 to 19, of which 0 to 4 are faults."""
    parts = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    return (F.crc32(F.concat_ws(":", *parts).cast("binary")) % DAMAGES).cast("int")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped (damage 0), emptied (1), without sentence ends (2), repeated (3) or made the user's (4)."""
    kind = F.col("_damage")
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), damage(F.col("conv_id"), F.col("turn")).alias("_damage")
    ).filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def repaired_after_damage(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Of every conv_id: gaps in its turns after damage, the report, and a hash of the repaired rows.

    A hash runs over the whole conversation, so its segments pass one task, one at a time.
    Gaps that don't fit a long are null.
    """
    report, lines = repaired(damaged(conversations), segment)
    hashes = _in_order(lines).mapInArrow(_hashed, "conv_id bigint, repaired_sha256 string")
    left = F.when(damage(F.col("conv_id"), F.col("turn")) != 0, F.col("turn").cast("long"))
    wide = "decimal(38,0)"
    turns = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.max(left).alias("high"), F.min(left).alias("low"), F.count_distinct(left).alias("n"))
    gaps = (F.col("high").cast(wide) - F.col("low").cast(wide) + 1 - F.col("n")).try_cast("long")
    out = turns.select("conv_id", F.when(F.col("high").isNull(), 0).otherwise(gaps).alias("gaps"))
    for name, other in (("r", report), ("h", hashes)):
        other = other.withColumnRenamed("conv_id", f"_{name}")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col(f"_{name}")), "left")
    return out.select(
        "conv_id", "gaps", *[F.coalesce(c, F.lit(0)).alias(c) for c in (*COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
