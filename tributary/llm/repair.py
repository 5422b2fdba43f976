"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation should read ``s?(ua)+`` in the initials of its roles (system, user, assistant), or be
empty.  A row is kept, given another role, or deleted, and empty user or assistant rows are inserted; the cheapest
edits are wanted, and of those the ones whose initials (D, I, K, R) are least in ASCII order.

What was said so far leaves one of four states: nothing, system, user, assistant.  For every row and every pair
of states there is one cheapest way from the state before it to the state behind it (inserts, then the
row's own edit), so a row is a 4 x 4 table.  Costs from the front (``forward``, with the order of the least
edits that lead to each state) and from the back (``backward``) are vectors of four numbers that meet in the
middle of the conversation; the crossing with the least sum, and among those the one that the least
edits lead to, splits it into two smaller ones.  Two edit strings that reach the same row by different
states end in that row's own edit, so neither begins the other and their order holds whatever follows.  Memory
is linear in the rows: one byte a row and the edits, never a table of rows by states.

Spark sorts the rows of a conversation; a task streams them twice, first a byte a row, then, with the
edits known, the texts, which are passed on and not kept.  So a conversation of any length needs no more
memory than its bytes and edits.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
WHITE = " \t\n\x0b\x0c\r"
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a row; the first that applies counts.
SOUND, BLANK, DUPLICATE, CUT_SHORT = range(4)


def _said(state: int, initial: str) -> int | None:
    """The state after a row of this initial, None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _next(state: int) -> int:
    """The state after an inserted row, or one that was given another role: whichever may stand there."""
    return ASSISTANT if state == USER else USER


def _row_table(initial: str, fault: int) -> list[list[tuple[int, str] | None]]:
    """[state before][state behind] -> (cost, edits) of one row and the inserts before it."""
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    kept = fault in (SOUND, CUT_SHORT)
    extra = TRUNCATED if fault == CUT_SHORT else 0
    for before in range(4):
        state = before
        for inserts in range(3):  # more only come back to a state that fewer reach
            ways = [(DELETE, "D", state)]
            if kept:
                ways.append((REROLE + extra, "R", _next(state)))
                if (behind := _said(state, initial)) is not None:
                    ways.append((KEEP + extra, "K", behind))
            for cost, edit, behind in ways:
                way = (cost + inserts * INSERT, "I" * inserts + edit)
                if table[before][behind] is None or way < table[before][behind]:
                    table[before][behind] = way
            state = _next(state)
    return table


INITIALS = ["s", "u", "a", ""]  # the last: any other
TABLES = [_row_table(initial, fault) for initial in INITIALS for fault in range(4)]
ENDS = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]  # inserts after the last row
END_COSTS = [cost for cost, _ in ENDS]


def code(initial: str, fault: int) -> int:
    return 4 * (INITIALS.index(initial) if initial in INITIALS else 3) + fault


def forward(rows: bytes, lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least cost from ``start`` over rows lo..hi to each state, and the order of the least edits that lead there."""
    costs, order = [NEVER] * 4, [0] * 4
    costs[start] = 0
    for i in range(lo, hi):
        table, best = TABLES[rows[i]], [(NEVER, 0, "")] * 4
        for before in range(4):
            if costs[before] >= NEVER:
                continue
            for behind, way in enumerate(table[before]):
                if way and (new := (costs[before] + way[0], order[before], way[1])) < best[behind]:
                    best[behind] = new
        ranks = sorted({b[1:] for b in best if b[0] < NEVER})
        costs = [b[0] for b in best]
        order = [ranks.index(b[1:]) if b[0] < NEVER else 0 for b in best]
    return costs, order


def backward(rows: bytes, lo: int, hi: int, ends: list[int]) -> list[int]:
    """Least cost from each state over rows lo..hi to an end, where the end's states have the costs ``ends``."""
    for i in range(hi - 1, lo - 1, -1):
        ends = [min((way[0] + ends[behind] for behind, way in enumerate(ways) if way), default=NEVER) for ways in TABLES[rows[i]]]
    return ends


def _crossing(costs: list[int], order: list[int], ends: list[int]) -> int:
    return min(range(4), key=lambda s: (min(NEVER, costs[s] + ends[s]), order[s]))


def _edits(rows: bytes, lo: int, hi: int, start: int, end: int) -> Iterator[str]:
    if hi - lo == 1:
        yield TABLES[rows[lo]][start][end][1]
        return
    middle = (lo + hi) // 2
    ends = [NEVER] * 4
    ends[end] = 0
    state = _crossing(*forward(rows, lo, middle, start), backward(rows, middle, hi, ends))
    yield from _edits(rows, lo, middle, start, state)
    yield from _edits(rows, middle, hi, state, end)


def cheapest(rows: bytes) -> tuple[int, str]:
    """(cost, edits) of a conversation, given as one ``code`` a row."""
    if not rows:
        return 0, ""
    costs, order = forward(rows, 0, len(rows), NOTHING)
    last = _crossing(costs, order, END_COSTS)
    return costs[last] + ENDS[last][0], "".join(_edits(rows, 0, len(rows), NOTHING, last)) + ENDS[last][1]


# ---- conversations as tables -------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) after damage by crc32(``conv_id:turn``) modulo 20; a null counts as one space.

    0 drops the row (it stays, marked, so that its conversation is not forgotten), 1 empties the text,
    2 takes its ``.!?`` out, 3 repeats the row, 4 makes it the user's.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    twice = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return out.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                      (F.col("kind") == 0).alias("dropped"), twice.alias("copy")).drop("copy")


def _faults(role: Column, text: Column, seen: Column) -> Column:
    last = F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)
    return (F.when(F.trim(text, F.lit(WHITE)) == "", BLANK).when(seen, DUPLICATE)
            .when(~last.isin(".", "!", "?"), CUT_SHORT).otherwise(SOUND))


def _streamed(rows: DataFrame) -> DataFrame:
    """Every row twice, conversation by conversation: (conv_id, part 0, code, turn) and (conv_id, part 1, role, text)."""
    if "dropped" not in rows.columns:
        rows = rows.withColumn("dropped", F.lit(False))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.coalesce("dropped", F.lit(False)).alias("dropped"))
    # rows of one turn stand in the order of role and text, so equal ones stand together
    by = [F.col("turn").asc_nulls_first(), "role", "text"]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("dropped", *by))
    seen = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    initial = F.substring("role", 1, 1)
    letter = F.coalesce(*(F.when(initial == x, 4 * k) for k, x in enumerate(INITIALS[:3])), F.lit(12))
    rows = rows.withColumn("place", place).withColumn("fault", _faults(F.col("role"), F.col("text"), seen)).withColumn("letter", letter)
    none = F.lit(None)
    parts = F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.when(~F.col("dropped"), F.col("letter") + F.col("fault")).alias("code"), F.col("turn").alias("turn"),
                 none.cast("string").alias("role"), none.cast("string").alias("text")),
        F.struct(F.lit(1).alias("part"), F.when(~F.col("dropped"), F.lit(0)).alias("code"), none.cast("long").alias("turn"),
                 F.col("role").alias("role"), F.col("text").alias("text"))))
    out = rows.select("conv_id", "place", parts.alias("p")).select("conv_id", "p.part", "place", "p.code", "p.turn", "p.role", "p.text")
    return out.sortWithinPartitions("conv_id", "part", "place").select("conv_id", "part", "code", "turn", "role", "text")


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            yield from zip(*(c.to_pylist() for c in batch.slice(lo, 1024).columns))


class Report:
    """What the first part of a conversation tells: its faults, its cost and its edits."""

    def __init__(self, rows: Iterator[tuple]):
        codes, low, high, turns, before = bytearray(), None, None, 0, None
        for _, _, row, turn, _, _ in rows:
            if row is None:
                continue
            codes.append(row)
            if turn is not None:
                low = turn if low is None else low
                turns += turn != high
                high = turn
        self.codes = bytes(codes)
        self.gaps = 0 if low is None else high - low + 1 - turns
        self.counts = [sum(c % 4 == f for c in self.codes) for f in range(4)]
        initials = [INITIALS[c // 4] for c in self.codes]
        self.illegal = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials))
        self.cost, self.audit = cheapest(self.codes)


def _repaired(audit: str, rows: Iterator[tuple]) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of every edit; a deleted row keeps its role and text."""
    state = NOTHING
    rows = (r for r in rows if r[2] is not None)
    for edit in audit:
        if edit == "I":
            state = _next(state)
            yield edit, ROLES[state], ""
            continue
        _, _, _, _, role, text = next(rows)
        if edit == "R":
            state = _next(state)
            role = ROLES[state]
        elif edit == "K":
            state = _said(state, role[:1])
        yield edit, role, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, report, edits) of every conversation; the edits must be taken before the next one."""
    report = None
    for (conv_id, part), rows in itertools.groupby(_flat(batches), key=lambda r: (r[0], r[1])):
        if part == 0:
            report = Report(rows)
        else:
            yield conv_id, report, _repaired(report.audit, rows)
            for _ in rows:  # dropped rows stand last
                pass


def _written(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]], size: int = 2_000) -> Iterator[pa.RecordBatch]:
    while held := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], names=[n for n, _ in fields])


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the edits of every conversation in order; what is not deleted is the repaired one.

    ``rows`` has conv_id, turn, role and text, and may have ``dropped``; other columns are left out.
    A null role or text is one space, a null turn comes first, a null conv_id is a conversation of its own.  Rows
    of one turn stand by role and text.  A role counts by its first character; one that is neither
    s, u nor a (an empty one too) can't be kept as it is.  An empty table gives no rows.
    """
    own = rows.schema["conv_id"].dataType
    fields = [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ((conv_id, k, *edit) for conv_id, _, edits in _conversations(batches) for k, edit in enumerate(edits))
        return _written(out, fields)

    streamed = _streamed(rows.withColumn("conv_id", F.col("conv_id").cast("long")))
    out = streamed.mapInArrow(task, "conv_id long, place long, edit string, role string, text string")
    return out.withColumn("conv_id", F.col("conv_id").cast(own))


def repair_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    The counts are of the rows as given (``repair``); the digest is that of the repaired rows, ``role:text``
    joined by newlines.  A conversation whose rows were all dropped has zeros, no edits and the digest of nothing.
    """
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    fields = [("conv_id", pa.int64()), *((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def one(conv_id, report, edits):
        digest, first = hashlib.sha256(), True
        for edit, role, text in edits:
            if edit != "D":
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        blank, duplicate, truncated = report.counts[BLANK], report.counts[DUPLICATE], report.counts[CUT_SHORT]
        return conv_id, report.gaps, blank, duplicate, truncated, report.illegal, report.cost, report.audit, digest.hexdigest()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written((one(*c) for c in _conversations(batches)), fields)

    schema = "conv_id long, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string"
    return _streamed(rows.withColumn("conv_id", F.col("conv_id").cast("long"))).mapInArrow(task, schema)
