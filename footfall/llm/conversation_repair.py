"""Conversation structure repair: cheapest edits by a checkpointed dynamic program over the rows.

Edits keep a row, give it another role, delete it, or insert a row without text, so that the initials of the roles read
`(s?(ua)+)?`; an empty role fits nowhere. Blank rows and rows whose role and text came before are always deleted; a
row that stays although it is truncated costs extra. Of equally cheap ways the one whose edits' initials are least wins.

A conversation is in one of four states: nothing yet, after system, user, assistant. The program goes backwards over
the rows with the cost to the end from each state, and keeps that vector at checkpoints only, every square root of
the number of rows. Walking forward it computes the vectors between two checkpoints anew and takes, at each place, the least
edit that is tight. Given a state and an initial, role and next state are fixed, so that initials tell the edits.

Conversations of any length: rows are ordered over all tasks by ranges and cut in pieces of up to PIECE rows. For
those that lie in several pieces, each piece gives its least costs from state to state, one scan over the pieces, last to first, gives
the cost vector at the end of each (the outer checkpoints), every piece is walked from all four states, and one scan, first
to last, tells which walk counts. Equal rows of one place are one row with a number.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.session import materialise

BLANK = r"[\x20\x09-\x0D]"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
PIECE_BITS = 13
COPIES = 4_096
FAR = 1 << 60
#: From each state (nothing, system, user, assistant): the state that a new role leads to.
TURN = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: Inserts that end a conversation from each state.
FINISH = (0, 2 * INSERT, INSERT, 0)


def kept_state(state: int, initial: str) -> int:
    """The state after a row that keeps its role; -1 where it may not."""
    if initial == "s":
        return 1 if state == 0 else -1
    if initial == "u":
        return 2 if state != 2 else -1
    return 3 if initial == "a" and state == 2 else -1


def with_inserts(costs: list[int]) -> list[int]:
    """Costs from each state where inserts may come first."""
    for _ in range(2):
        costs = [min(costs[s], INSERT + costs[TURN[s]]) for s in range(4)]
    return costs


class Row:
    """What the program knows of a row: initial, whether it must go, whether it is truncated, and equal rows after it."""

    __slots__ = ("initial", "forced", "extra", "copies")

    def __init__(self, initial: str, forced: bool, truncated: bool, copies: int):
        self.initial, self.forced, self.extra, self.copies = initial, forced, TRUNCATED if truncated else 0, copies

    def options(self, state: int) -> list[tuple[str, str, int, int]]:
        """(initial, role sign, cost, next state) of this row's edits, the least initial first, without inserts."""
        rest = DELETE * (self.copies - 1)
        found = [("D", "-", DELETE + rest, state)]
        if not self.forced:
            to = kept_state(state, self.initial)
            if to >= 0:
                found.append(("K", "=", self.extra + rest, to))
            found.append(("R", ROLES[TURN[state]][0], REROLE + self.extra + rest, TURN[state]))
        return found

    def before(self, after: list[int]) -> list[int]:
        """Costs before the row from those after it."""
        return with_inserts([min(cost + after[to] for _, _, cost, to in self.options(s)) for s in range(4)])


class Program:
    """The rows of a piece, with cost vectors kept every square root of their number."""

    def __init__(self, rows: list[Row], end: list[int]):
        self.rows, self.step = rows, max(1, math.isqrt(len(rows)))
        self.kept, costs = {len(rows): end}, end
        for i in range(len(rows) - 1, -1, -1):
            costs = rows[i].before(costs)
            if i % self.step == 0:
                self.kept[i] = costs

    def walk(self, state: int, last: bool) -> tuple[list[str], int]:
        """Edits of each row from a state, as pairs of initial and role sign, and the state after them.

        Inserts that follow the last row of a conversation are among that row's edits.
        """
        found: list[str] = []
        for start in range(0, len(self.rows), self.step):
            stop = min(len(self.rows), start + self.step)
            vectors = [self.kept[stop]]
            for i in range(stop - 1, start - 1, -1):
                vectors.append(self.rows[i].before(vectors[-1]))
            vectors.reverse()
            for row, now, after in zip(self.rows[start:stop], vectors, vectors[1:]):
                edits = ""
                while True:
                    options = row.options(state)
                    if options[0][2] + after[state] == now[state]:
                        edits += "D-"
                        break
                    if INSERT + now[TURN[state]] == now[state]:
                        state = TURN[state]
                        edits += "I" + ROLES[state][0]
                        continue
                    sign, role, _, to = next(o for o in options[1:] if o[2] + after[o[3]] == now[state])
                    edits, state = edits + sign + role, to
                    break
                found.append(edits + "D-" * (row.copies - 1))
        while last and state in (1, 2):
            state = TURN[state]
            found[-1] += "I" + ROLES[state][0]
        return found, state


def _blank_as_space(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(" "))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """(ck, conv_id, turn, role, text, copies, fault, more, pos, piece), ordered by `pos`: turn, nulls first, role and text.

    `ck` names the conversation, also one without an id. `fault` is the first row's, the others of `copies` are
    duplicates or, with it, blank.
    """
    base = rows.select(F.to_json(F.struct("conv_id")).alias("ck"), "conv_id", "turn", _blank_as_space("role").alias("role"), _blank_as_space("text").alias("text"))
    same = base.groupBy("ck", "conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("total"))
    same = same.withColumn("key", F.sha2(F.to_json(F.struct("ck", "role", "text")), 256))
    first = same.groupBy("key").agg(F.min(F.struct("turn")).alias("first"))
    found = same.join(first, "key").withColumn("again", ~F.struct("turn").eqNullSafe(F.col("first")))
    # Equal rows in great numbers are dealt in parts, of which all but the first are duplicates.
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("total") - 1) / COPIES).cast("int"))).alias("part")
    found = found.select("*", part).withColumn("copies", F.least(F.lit(COPIES), F.col("total") - F.col("part") * COPIES).cast("int"))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("again") | (F.col("part") > 0), "duplicate")
        .when(~F.col("text").rlike(rf"[.!?]{BLANK}*\z"), "truncated")
    )
    place = [F.col("ck"), F.col("turn"), F.col("role")]
    dealt = found.repartitionByRange(*place, F.substring("text", 1, 64), F.col("part")).sortWithinPartitions(*place, "text", "part")
    pos = F.monotonically_increasing_id()
    dealt = dealt.select("ck", "conv_id", "turn", "role", "text", "copies", fault.alias("fault"), pos.alias("pos"))
    return dealt.withColumn("piece", F.shiftright("pos", PIECE_BITS))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows that follow each other with equal keys."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[k] != held[0][k] for k in keys):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _rows(group: list[dict]) -> list[Row]:
    return [Row(r["initial"], r["forced"], r["truncated"], r["copies"]) for r in group]


def _mapped(table: DataFrame, keys: list[str], order: list, made, schema: str) -> DataFrame:
    """What `made` gives for each group of rows; groups lie whole in a partition, in order."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for group in _groups(batches, keys):
            rows += made(group)
            if len(rows) >= 4_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    types = [kinds[f.split()[1]] for f in schema.split(", ")]
    return table.sortWithinPartitions(*order).mapInArrow(run, schema)


def _matrix(group: list[dict]) -> list[tuple]:
    """Least costs over a piece, from each state (rows) to each (columns)."""
    rows, columns = _rows(group), []
    for to in range(4):
        costs = with_inserts([0 if s == to else FAR for s in range(4)])
        for row in reversed(rows):
            costs = row.before(costs)
        columns.append(costs)
    return [(group[0]["ck"], group[0]["piece"], [min(FAR, columns[t][s]) for s in range(4) for t in range(4)])]


def _ends(group: list[dict]) -> list[tuple]:
    """The cost vector at the end of each piece of a conversation, whose pieces come last to first."""
    costs, found = list(FINISH), []
    for r in group:
        found.append((r["ck"], r["piece"], costs, 1 if r is group[0] else 0))
        costs = [min(r["costs"][4 * s + t] + costs[t] for t in range(4)) for s in range(4)]
    return found


def _walks(group: list[dict]) -> list[tuple]:
    """Edits of each row from each state that the piece may begin in, and the states after it."""
    whole = group[0]["ends"] is None
    program = Program(_rows(group), list(FINISH) if whole else group[0]["ends"])
    walks = [program.walk(s, whole or bool(group[0]["last"])) for s in ((0,) if whole else range(4))]
    after = [w[1] for w in walks]
    return [(r["ck"], r["piece"], r["pos"], [w[0][i] for w in walks], after if r is group[-1] else None) for i, r in enumerate(group)]


def _starts(group: list[dict]) -> list[tuple]:
    """The state that each piece of a conversation begins in."""
    state, found = 0, []
    for r in group:
        found.append((r["ck"], r["piece"], state))
        state = r["after"][state]
    return found


def edits(rows: DataFrame) -> DataFrame:
    """(conv_id, ck, pos, step, edit, turn, old_role, fault, role, text): every edit, in the order of `pos` and `step`.

    `rows` has conv_id, turn, role and text; null roles and texts count as one blank, rows without a conversation id are one
    conversation, and other columns are not read. `edit` is K, R, D or I (keep, new role, delete, insert); `old_role` and `fault`
    (blank, duplicate, truncated or null) are the row's, null for inserts; `role` and `text` are the repaired ones, null for deleted
    rows. Rows of one turn are ordered by role and text. An empty table gives an empty one.
    """
    table = materialise(ordered_rows(rows), "ordered_turns")
    narrow = table.select(
        "ck", "piece", "pos", F.substring("role", 1, 1).alias("initial"), F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False)).alias("forced"),
        F.coalesce(F.col("fault") == "truncated", F.lit(False)).alias("truncated"), "copies",
    )
    pieces = narrow.select("ck", "piece").distinct().groupBy("ck").count().filter(F.col("count") > 1).select("ck")
    pieces = materialise(pieces, "long_conversations")
    cut = narrow.join(pieces, "ck", "left_semi").repartition("piece")
    matrices = _mapped(cut, ["ck", "piece"], ["pos"], _matrix, "ck string, piece long, costs array<long>").repartition("ck")
    ends = _mapped(matrices, ["ck"], ["ck", F.desc("piece")], _ends, "ck string, piece long, ends array<long>, last int")
    ends = materialise(ends, "piece_ends")

    walked = narrow.join(ends, ["ck", "piece"], "left").repartition("piece")
    schema = "ck string, piece long, pos long, walks array<string>, after array<long>"
    walked = materialise(_mapped(walked, ["ck", "piece"], ["pos"], _walks, schema), "walks")
    marks = walked.filter(F.col("after").isNotNull()).join(pieces, "ck", "left_semi").select("ck", "piece", "after").repartition("ck")
    starts = _mapped(marks, ["ck"], ["ck", "piece"], _starts, "ck string, piece long, state int")

    chosen = walked.join(starts, ["ck", "piece"], "left").select("pos", F.get("walks", F.coalesce("state", F.lit(0))).alias("walk"))
    both = table.join(chosen, "pos")
    each = both.select("*", F.explode(F.sequence(F.lit(1), (F.length("walk") / 2).cast("int"))).alias("step"))
    sign = lambda at: F.substring("walk", at, F.lit(1))
    each = each.withColumn("edit", sign(2 * F.col("step") - 1)).withColumn("to", sign(2 * F.col("step")))
    own, inserted = F.col("edit") != "I", F.col("edit") == "I"
    # Of equal rows the first has the first fault; its own edit is the first that is no insert.
    first = F.col("step") == F.length(F.regexp_extract("walk", "^(I.)*", 0)) / 2 + 1
    fault = F.when(own & (first | (F.col("fault") == "blank")), F.col("fault")).when(own, "duplicate")
    role = F.when(F.col("to") == "u", "user").when(F.col("to") == "a", "assistant").when(F.col("to") == "=", F.col("role"))
    text = F.when(inserted, "").when(F.col("edit") != "D", F.col("text"))
    return each.select(
        "conv_id", "ck", "pos", "step", "edit", F.when(own, F.col("turn")).alias("turn"), F.when(own, F.col("role")).alias("old_role"),
        fault.alias("fault"), role.alias("role"), text.alias("text"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, edit, role, text, pos, step) of the repaired conversations' rows, ordered by `pos` and `step`."""
    found = edits(rows).filter("edit != 'D'")
    return found.select("conv_id", "turn", "edit", "role", "text", "pos", "step")


LEGAL = {"su", "ua", "au"}
COSTS = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digest(found: DataFrame) -> DataFrame:
    """(ck, six counts, audit, repaired_sha256) of each conversation, from its edits.

    A hash needs the rows one after the other: they stream through one task, which keeps the audit alone.
    """

    class Tally:
        def __init__(self, ck: str):
            self.ck, self.counts, self.audit, self.hash = ck, dict.fromkeys(COUNTS, 0), [], hashlib.sha256()
            self.least = self.most = self.turn = self.before = None
            self.turns, self.lines = 0, 0

        def add(self, edit, turn, old_role, fault, role, text) -> None:
            self.audit.append(edit)
            self.counts["cost"] += COSTS[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
            if edit != "I":
                if fault:
                    self.counts[fault] += 1
                if self.before is not None:
                    self.counts["illegal"] += self.before + old_role[:1] not in LEGAL
                self.before = old_role[:1]
                if turn is not None and turn != self.turn:  # turns ascend
                    self.least, self.most, self.turn = turn if self.least is None else self.least, turn, turn
                    self.turns += 1
            if edit != "D":
                self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                self.lines += 1

        def row(self) -> tuple:
            if self.turns:
                self.counts["gaps"] = self.most - self.least + 1 - self.turns
            return (self.ck, *self.counts.values(), "".join(self.audit), self.hash.hexdigest())

    names = ["ck", *COUNTS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("edit", "turn", "old_role", "fault", "role", "text")]
            for ck, *values in zip(batch.column("ck").to_pylist(), *columns):
                if now is None or ck != now.ck:
                    rows += [now.row()] if now else []
                    now = Tally(ck)
                now.add(*values)
            if len(rows) > 2_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names)
                rows = []
        rows += [now.row()] if now else []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names)

    dealt = found.drop("conv_id").repartition("ck").sortWithinPartitions("ck", "pos", "step")
    longs = ", ".join(f"{c} long" for c in COUNTS)
    return dealt.mapInArrow(run, f"ck string, {longs}, audit string, repaired_sha256 string")


def summary(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The digest of every conversation of the first table; one without any edit has zeros, an empty audit and the hash of nothing."""
    ids = conversations.select("conv_id").distinct().withColumn("ck", F.to_json(F.struct("conv_id")))
    rows = ids.join(digest(found), "ck", "left")
    nothing = hashlib.sha256().hexdigest()
    return rows.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
