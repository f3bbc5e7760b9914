"""Conversation structure repair by a checkpointed dynamic programme over the turns.

The cheapest edits that give a conversation the role pattern ``(s?(ua)+)?`` are a shortest
path over four states: nothing yet, after ``s``, after ``u``, after ``a``. The programme runs
backward over the rows and keeps the vector of the four costs at every k-th row only, k being
the square root of their number. Walking forward, the rows of one block at a time are gone
over again from its checkpoint, and of the edits that stay on a cheapest path the one with the
ASCII-least initial is taken.

All rows are range-partitioned by conversation and turn and sorted, so a conversation lies in
one place or in places next to each other. Conversations that lie within one range, and are of
a bounded size, are repaired there, as they stream by. The first and the last one of a range,
and longer ones, are handed on with their rows, and the programme is distributed over them:
segments of ``SEGMENT_ROWS`` rows are the blocks. The costs of crossing a segment make a
four-by-four table; these are chained backward to the vectors at the ends of segments, each
segment walks its rows from every state it may be entered in, and the ends are chained forward.
Each of the two chains has one small row per segment and holds one vector at a time. The
digest of a repaired text needs its bytes in order and so reads a conversation in one
stream; nothing of it is held.

Defined cases: a null role or text is one space, as is a null in the key of the damage; null
turns come first; rows of equal turn stand in the order of role, of the first ``PREFIX``
characters of the text, of a hash of it, and of the place at which they were read, so that
equal rows are told apart; a null conversation is one of its own; an empty table gives an
empty result; a role is judged by its first character, an empty one is
never legal; other columns are not looked at; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicecheck.llm.common import BATCH_ROWS, ship, stored, to_arrow

# Costs of the edits, and the characters of the rules.
KEEP, REROLE, DELETE, INSERT, MEND = 0, 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
LEGAL_PAIRS = {"su", "ua", "au"}
# Rows of a segment, a power of two; longer conversations are distributed.
SEGMENT_BITS = 12
SEGMENT_ROWS = 1 << SEGMENT_BITS
# Characters of one conversation that a task holds.
HELD_CHARS = 4_000_000
# Characters that order the texts of one turn and role.
PREFIX = 32

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STATES = range(4)
# The state after an inserted or rewritten role; the role itself is the one that fits.
NEXT = (2, 2, 3, 2)
FITTING = ("user", "user", "assistant", "user")
# The state after a kept row, by its initial; -1 where it does not fit.
KEPT = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
NEVER = (-1, -1, -1, -1)
FAR = 1 << 60
# Costs at the end of a conversation.
AT_END = (0, 2 * INSERT, INSERT, 0)

# A row in the programme is one letter: x must go; s, u, a, o (no legal role) may stay, in
# upper case if the row is truncated.
GONE = "x"


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copy, lost``: rows after damage by the checksum of
    conversation and turn. Dropped rows stay, marked ``lost``, so that their conversations do."""
    def plain(c: str) -> Column:
        return F.coalesce(rows[c].cast("string"), F.lit(" "))

    key = F.concat(plain(conv), F.lit(":"), plain(turn))
    marked = rows.select(
        rows[conv].alias("conv"),
        rows[turn].alias("turn"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
        plain(role).alias("role"),
        plain(text).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    return marked.select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.expr("CASE kind WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text"),
        "place",
        (F.col("kind") == 0).alias("lost"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def undamaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same columns for rows as they are."""
    return rows.select(
        rows[conv].alias("conv"),
        rows[turn].alias("turn"),
        F.coalesce(rows[role], F.lit(" ")).alias("role"),
        F.coalesce(rows[text], F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("place"),
        F.lit(False).alias("lost"),
        F.lit(0).alias("copy"),
    )


def letter_of(role: str, text: str, seen: bool) -> tuple[str, str]:
    """The letter of a row, and its fault: blank, duplicate, truncated or none."""
    end = text.rstrip(BLANKS)[-1:]
    if not end:
        return GONE, "blank"
    if seen:
        return GONE, "duplicate"
    letter = role[0] if role[:1] in KEPT else "o"
    return (letter, "") if end in ".!?" else (letter.upper(), "truncated")


def before(letter: str, after) -> tuple:
    """The costs from before a row, given those from after it. Rows may be inserted first."""
    if letter == GONE:
        base = [DELETE + v for v in after]
    else:
        mend = MEND if letter.isupper() else 0
        kept = KEPT.get(letter.lower(), NEVER)
        base = [
            min(DELETE + after[s], REROLE + mend + after[NEXT[s]], KEEP + mend + after[kept[s]] if kept[s] >= 0 else FAR)
            for s in STATES
        ]
    # At most two inserts in a row: after them the state is one that was left before.
    return tuple(
        min(base[s], INSERT + base[NEXT[s]], 2 * INSERT + base[NEXT[NEXT[s]]]) for s in STATES
    )


def crossing(letters: str) -> list[tuple]:
    """For each state at the end of a segment, the costs of reaching it from every state."""
    out = []
    for end in STATES:
        costs = tuple(0 if s == end else FAR for s in STATES)
        for letter in reversed(letters):
            costs = tuple(min(c, FAR) for c in before(letter, costs))
        out.append(costs)
    return out


def walk(letters: str, at_end, state: int) -> tuple[list[str], int]:
    """The edits of each row (with inserts before it), and the state at the end. Vectors
    are kept at checkpoints, and block by block in between."""
    n = len(letters)
    block = isqrt(n) + 1
    checkpoints = {}
    costs = at_end
    for i in range(n - 1, -1, -1):
        if (i + 1) % block == 0 or i == n - 1:
            checkpoints[i // block] = costs
        costs = before(letters[i], costs)
    edits = []
    for number, low in enumerate(range(0, n, block)):
        high = min(low + block, n)
        vectors = [checkpoints[number]]
        for i in range(high - 1, low - 1, -1):
            vectors.append(before(letters[i], vectors[-1]))
        vectors.reverse()
        for i in range(low, high):
            edit, state = _edits(letters[i], vectors[i - low], vectors[i - low + 1], state)
            edits.append(edit)
    return edits, state


def _edits(letter: str, here, after, state: int) -> tuple[str, int]:
    mend = MEND if letter.isupper() else 0
    kept = KEPT.get(letter.lower(), NEVER)
    out = ""
    while True:
        cost = here[state]
        if cost == DELETE + after[state]:
            return out + "D", state
        if cost == INSERT + here[NEXT[state]]:
            out, state = out + "I", NEXT[state]
        elif letter != GONE and kept[state] >= 0 and cost == KEEP + mend + after[kept[state]]:
            return out + "K", kept[state]
        else:
            return out + "R", NEXT[state]


class Record:
    """What is told of a conversation, built up row by row in order."""

    def __init__(self, conv):
        self.conv = conv
        self.audit: list[str] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
        self.turns = self.least = self.last = None
        self.role = None
        self.state = 0
        self.digest, self.lines = hashlib.sha256(), 0

    def add(self, turn, role: str, letter: str, fault: str, edits: str, text: str) -> None:
        counts = self.counts
        if fault:
            counts[fault] += 1
        if self.role is not None and self.role[:1] + role[:1] not in LEGAL_PAIRS:
            counts["illegal"] += 1
        self.role = role
        if turn is not None:
            if self.turns is None:
                self.turns, self.least, self.last = 1, turn, turn
            elif turn != self.last:
                self.turns, self.last = self.turns + 1, turn
        for edit in edits:
            if edit == "I":
                self._insert()
            elif edit == "D":
                counts["cost"] += DELETE
            else:
                counts["cost"] += (KEEP if edit == "K" else REROLE) + (MEND if letter.isupper() else 0)
                self._line(role if edit == "K" else FITTING[self.state], text)
                self.state = KEPT[letter.lower()][self.state] if edit == "K" else NEXT[self.state]
        self.audit.append(edits)

    def _insert(self) -> None:
        self.counts["cost"] += INSERT
        self._line(FITTING[self.state], "")
        self.state = NEXT[self.state]

    def _line(self, role: str, text: str) -> None:
        if self.lines:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.lines += 1

    def close(self) -> dict:
        while self.state in (1, 2):
            self._insert()
            self.audit.append("I")
        gaps = 0 if self.turns is None else self.last - self.least + 1 - self.turns
        return {
            "conv": self.conv, "gaps": gaps, **self.counts,
            "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
        }


RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def repaired(conv, rows: list[tuple]) -> dict:
    """The record of a conversation whose rows (turn, role, text, lost) are all here."""
    rows = [r for r in rows if not r[3]]
    seen, letters, faults = set(), [], []
    for _, role, text, _ in rows:
        letter, fault = letter_of(role, text, (role, text) in seen)
        seen.add((role, text))
        letters.append(letter)
        faults.append(fault)
    edits, _ = walk("".join(letters), AT_END, 0)
    record = Record(conv)
    for (turn, role, text, _), letter, fault, edit in zip(rows, letters, faults, edits):
        record.add(turn, role, letter, fault, edit, text)
    return record.close()


def repair(rows: DataFrame) -> DataFrame:
    """``conv`` and the columns of ``RESULT``, one row per conversation of ``rows`` (as
    ``damaged`` gives them)."""
    spark = rows.sparkSession
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conv_type, turn_type = rows.schema["conv"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    # Not the whole text: bounds of ranges pass through the driver.
    order = ["conv", "turn", "role", "head", "hash", "place", "copy"]
    ranged = (
        rows.select("*", F.substring("text", 1, PREFIX).alias("head"), F.xxhash64("text").alias("hash"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv", "turn", "role", "text", "lost", F.monotonically_increasing_id().alias("row"))
    )
    handed = f"turn {turn_type}, role string, text string, lost boolean, row long"
    # Every row is a record, or a row that is handed on (row is set).
    passed = stored(_local(ranged, f"conv {conv_type}, {RESULT}, {handed}"))
    done = passed.where("row IS NULL").drop(*[c.split(" ")[0] for c in handed.split(", ")])
    left = passed.where("row IS NOT NULL").select("conv", *[c.split(" ")[0] for c in handed.split(", ")])
    return done.unionByName(_distributed(left, f"conv {conv_type}, {RESULT}"))


def _batches(lines: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for line in lines:
        held.append(line)
        size += len(line.get("text") or "") + len(line.get("audit") or "")
        if len(held) >= BATCH_ROWS or size >= HELD_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _streamed(batches) -> Iterator[list]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _local(ranged: DataFrame, schema: str) -> DataFrame:
    arrow = to_arrow(ranged.sparkSession, schema)
    names = ["conv", "turn", "role", "text", "lost", "row"]

    def handed(held: list) -> Iterator[dict]:
        return (dict(zip(names, r)) for r in held)

    def lines(batches) -> Iterator[dict]:
        number, conv, on, held, size = 0, None, False, [], 0
        for row in _streamed(batches):
            if not number or row[0] != conv:
                if held:
                    yield repaired(conv, [r[1:5] for r in held])
                number, conv = number + 1, row[0]
                # The first one may have begun in the range before.
                on, held, size = number == 1, [], 0
            held.append(row)
            size += len(row[3])
            on = on or len(held) > SEGMENT_ROWS or size > HELD_CHARS
            if on:
                yield from handed(held)
                held = []
        # The last one may go on in the range behind.
        yield from handed(held)

    return ranged.mapInArrow(lambda batches: _batches(lines(batches), arrow), schema)


def _distributed(left: DataFrame, schema: str) -> DataFrame:
    """Records of conversations in several ranges, or of many rows."""
    spark = left.sparkSession
    # Joins need a key that is never null.
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")).alias("key")
    left = left.select("*", key)
    live = left.where("NOT lost").select(
        "key", "role", "row", F.sha2("text", 256).alias("mark"), F.shiftrightunsigned("row", 33).alias("range"),
        F.expr(f"rtrim('{_sql_text(BLANKS)}', text)").alias("cut"),
    )
    # The first row of a role and text, found by range before it is found overall: no key
    # has more rows than there are ranges.
    of_range = live.groupBy("key", "role", "mark", "range").agg(F.min("row").alias("least"))
    first = F.min("least").over(Window.partitionBy("key", "role", "mark")).alias("first")
    firsts = of_range.select("key", "role", "mark", "range", first)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin(*KEPT), initial).otherwise("o")
    fault = F.expr(
        "CASE WHEN cut = '' THEN 'blank' WHEN row > first THEN 'duplicate' "
        "WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END"
    )
    coded = (
        live.join(firsts, ["key", "role", "mark", "range"])
        .withColumn("fault", fault)
        .select(
            "key",
            "row",
            F.shiftrightunsigned("row", SEGMENT_BITS).alias("segment"),
            "fault",
            F.when(F.col("fault").isin("blank", "duplicate"), GONE)
            .when(F.col("fault") == "truncated", F.upper(letter))
            .otherwise(letter)
            .alias("letter"),
        )
    )
    # A segment has SEGMENT_ROWS rows at most.
    in_order = F.array_sort(F.collect_list(F.struct("row", "letter", "fault"))).alias("rows")
    segments = stored(
        coded.groupBy("key", "segment").agg(in_order).select(
            "key", "segment", "rows.row", "rows.fault", F.array_join("rows.letter", "").alias("letters")
        )
    )
    walked = stored(_walks(segments.join(_end_costs(segments), ["key", "segment"])))
    row = F.explode(F.arrays_zip("row", "fault", F.split("letters", "").alias("letter"), F.split("walk", " ").alias("edits")))
    edits = (
        walked.join(_first_states(walked), ["key", "segment"])
        .withColumn("walk", F.expr("walks[state]"))
        .select(row.alias("e"))
        .select("e.*")
    )
    ordered = (
        left.join(edits, "row", "left")
        .repartition("key")
        .sortWithinPartitions("key", "row")
        .select("conv", "turn", "role", "text", "lost", "fault", "letter", "edits")
    )
    arrow = to_arrow(spark, schema)

    def lines(batches) -> Iterator[dict]:
        record = None
        for conv, turn, role, text, lost, fault, letter, edit in _streamed(batches):
            if record is None or record.conv != conv:
                if record is not None:
                    yield record.close()
                record = Record(conv)
            if not lost:
                record.add(turn, role, letter, fault, edit, text)
        if record is not None:
            yield record.close()

    return ordered.mapInArrow(lambda batches: _batches(lines(batches), arrow), schema)


def _sql_text(chars: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in chars)


def _end_costs(segments: DataFrame) -> DataFrame:
    """``key, segment, at_end``: the costs from the end of each segment on, chained from
    the last one of a conversation to the first."""
    tables = "key string, segment long, tables array<array<long>>"
    out = "key string, segment long, at_end array<long>"
    table_arrow, out_arrow = to_arrow(segments.sparkSession, tables), to_arrow(segments.sparkSession, out)

    def cross(batches):
        for batch in batches:
            key, segment, letters = (batch.column(n) for n in ("key", "segment", "letters"))
            made = [[list(c) for c in crossing(x)] for x in letters.to_pylist()]
            yield pa.RecordBatch.from_arrays([key, segment, pa.array(made, table_arrow.field(2).type)], schema=table_arrow)

    def chain(batches):
        key_now, costs = None, AT_END
        for batch in batches:
            ends = []
            for key, table in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != key_now:
                    key_now, costs = key, AT_END
                ends.append(list(costs))
                costs = tuple(min(min(table[t][s] + costs[t] for t in STATES), FAR) for s in STATES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ends, out_arrow.field(2).type)], schema=out_arrow
            )

    crossed = segments.select("key", "segment", "letters").mapInArrow(cross, tables)
    return crossed.repartition("key").sortWithinPartitions("key", F.desc("segment")).mapInArrow(chain, out)


def _walks(segments: DataFrame) -> DataFrame:
    """Adds the edits of a segment's rows, with spaces between rows, and its last state, for
    each state it may begin in."""
    out = (
        "key string, segment long, row array<long>, fault array<string>, letters string, "
        "walks array<string>, ends array<int>"
    )
    arrow = to_arrow(segments.sparkSession, out)

    def run(batches):
        for batch in batches:
            walks, ends = [], []
            for letters, at_end in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                found = [walk(letters, at_end, s) for s in STATES]
                walks.append([" ".join(edits) for edits, _ in found])
                ends.append([end for _, end in found])
            columns = [batch.column(i) for i in range(5)]
            columns += [pa.array(walks, arrow.field(5).type), pa.array(ends, arrow.field(6).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return segments.select("key", "segment", "row", "fault", "letters", "at_end").mapInArrow(run, out)


def _first_states(walked: DataFrame) -> DataFrame:
    """``key, segment, state``: each segment begins in the state in which the one before ends."""
    out = "key string, segment long, state int"
    arrow = to_arrow(walked.sparkSession, out)

    def run(batches):
        key_now, state = None, 0
        for batch in batches:
            states = []
            for key, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != key_now:
                    key_now, state = key, 0
                states.append(state)
                state = ends[state]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(states, pa.int32())], schema=arrow)

    return (
        walked.select("key", "segment", "ends")
        .repartition("key")
        .sortWithinPartitions("key", "segment")
        .mapInArrow(run, out)
    )


def query(conversations: DataFrame) -> DataFrame:
    """conv_id and the columns of ``RESULT`` for every original conversation, after damage."""
    return repair(damaged(conversations)).withColumnRenamed("conv", "conv_id")
