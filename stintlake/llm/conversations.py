"""Cheapest repair of the turn structure of conversations, by depth-first branch-and-bound.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``. Edits go through
its rows in order: Keep (0), Rerole to user or assistant (2), Delete (3), and Insert an empty
user or assistant turn anywhere (2). Blank and repeated rows have to go; a truncated row that
stays adds 1. The cheapest sequence wins, and of equal costs the one whose initials, the audit,
are ASCII-least.

The search holds its nodes on an explicit stack. A node is left when its cost and the lower bound
of the rows after it exceed the incumbent, or reach it with a later audit, and when the table of
its place and state already has a better prefix. Rows are searched ``WINDOW`` at a time: the table
at the end of a window, one entry for each state, holds all roots of the next. Memory is bounded by
a window and by the audit, which is part of the result.

On Spark, short marks of the rows are range-partitioned by conversation and turn, so that a
conversation of any length spreads: a task searches its run of rows from every state that may be
open at its start, and the runs of a conversation, one for each task that it reaches, are joined
up. Texts follow in a stream sorted by turn and are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import stage
from stintlake.operators.grouping import join_same

#: Fixed values of the task: what an edit costs, and what a truncated row that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Space and the five controls that count as blank.
BLANKS = " \t\n\x0b\x0c\r"

#: Rows that are searched at a time.
WINDOW = 32

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
         (USER, "a"): ASSISTANT}
_NEXT = (USER, USER, ASSISTANT, USER)  # the turn that Rerole and Insert can give
_LEGAL_PAIRS = {"su", "ua", "au"}

Mark = tuple[str, bool, bool]  # initial, has to go, truncated
Frontier = dict[int, tuple[int, str]]  # by state: cost and audit of the best prefix


def suffix_bounds(marks: list[Mark], legal: str) -> list[int]:
    """What the rows from each place on cost at least, if only roles of these initials can stay.

    A row that has to go costs 3, one that stays truncated 1, one of another role 2. Two rows that
    follow each other, those to go left out, and must not, cost 2 more, since one of them is edited or
    something goes between; pairs are counted that share no row.
    """
    bounds, after, total = [0], None, 0
    for initial, gone, cut in reversed(marks):
        if gone:
            total += DELETE
        else:
            total += cut * TRUNCATED
            if initial not in legal:
                total += min(REROLE, DELETE - cut * TRUNCATED)
                after = None
            elif after and initial + after not in _LEGAL_PAIRS:
                total += INSERT
                after = None
            else:
                after = initial
        bounds.append(total)
    return bounds[::-1]


def search(roots: Frontier, marks: list[Mark], final: bool) -> Frontier:
    """The best prefixes after the rows, by state; only complete ones if they are the last rows.

    A final search ends with nothing or after an assistant turn and may insert behind the last row.
    """
    n = len(marks)
    begun = suffix_bounds(marks, "ua")  # a system turn stays at the start only
    bounds = (suffix_bounds(marks, "sua"), begun, begun, begun)
    best: dict[tuple[int, int], tuple[int, int, str]] = {}  # dominance: the best prefix of a node
    ends: dict[int, tuple[int, int, str]] = {}  # incumbents by state; a final search has one
    opens = START in roots and any(m[0] == "s" and not m[1] for m in marks)
    # The ends that a state still leads to: a turn once taken, START is out of reach.
    talk = (0,) if final else (USER, ASSISTANT)
    system = talk if final or not (opens or SYSTEM in roots) else (SYSTEM, *talk)
    goals = (talk if final else (START, *system), system, talk, talk)

    def before(one: tuple[int, int, str], other: tuple[int, int, str]) -> bool:
        if one[0] != other[0]:
            return one[0] < other[0]
        if one[1] == other[1]:
            return one[2] < other[2]
        return roots[one[1]][1] + one[2] < roots[other[1]][1] + other[2]

    def hopeless(state: int, cost: int, root: int, audit: str) -> bool:
        """Whether no end that the state leads to can still become better by what begins so."""
        for goal in goals[state]:
            if goal not in ends:
                return False
            most, its_root, end = ends[goal]
            if cost < most:
                return False
            if cost == most and (root != its_root or audit <= end[:len(audit)]):
                return False
        return True

    stack = [(0, s, cost, s, "") for s, (cost, _) in
             sorted(roots.items(), key=lambda r: r[1], reverse=True)]
    while stack:
        at, state, cost, root, audit = stack.pop()
        node = (cost, root, audit)
        if hopeless(state, cost + bounds[state][at], root, audit):
            continue
        known = best.get((at, state))
        if known is not None and not before(node, known):
            continue
        best[at, state] = node
        moves = []
        if at == n:
            goal = 0 if final else state
            if not final or state in (START, ASSISTANT):
                if goal not in ends or before(node, ends[goal]):
                    ends[goal] = node
        else:
            initial, gone, cut = marks[at]
            moves.append((at + 1, state, cost + DELETE, root, audit + "D"))
            if not gone:
                stays = cost + cut * TRUNCATED
                kept = _KEEP.get((state, initial))
                if kept is not None:
                    moves.append((at + 1, kept, stays, root, audit + "K"))
                moves.append((at + 1, _NEXT[state], stays + REROLE, root, audit + "R"))
        if at < n or final:
            moves.append((at, _NEXT[state], cost + INSERT, root, audit + "I"))
        # The most promising move is taken first, of equal ones the ASCII-least.
        moves.sort(key=lambda m: (m[2] + bounds[m[1]][m[0]], m[4][-1]), reverse=True)
        stack.extend(moves)
    return {s: (cost, roots[root][1] + audit) for s, (cost, root, audit) in ends.items()}


def finish(frontier: Frontier) -> tuple[int, str]:
    """The best complete repair behind the last row."""
    return search(frontier, [], final=True)[0]


class _Run:
    """The rows of one conversation in one task."""

    def __init__(self, conv: int | None, opening: bool):
        self.conv, self.rows, self.illegal = conv, [], 0
        self.first = self.last = None
        # What came before is known only where the conversation begins.
        entries = (START,) if opening else range(4)
        self.tables: dict[int, Frontier] = {e: {e: (0, "")} for e in entries}

    def add(self, mark: Mark) -> None:
        if self.last is None:
            self.first = mark[0]
        elif self.last + mark[0] not in _LEGAL_PAIRS:
            self.illegal += 1
        self.last = mark[0]
        self.rows.append(mark)
        if len(self.rows) == WINDOW:
            self.close()

    def close(self) -> None:
        if self.rows:
            self.tables = {e: search(t, self.rows, final=False) for e, t in self.tables.items()}
            self.rows = []

    def table(self) -> list[tuple]:
        self.close()
        return [
            (self.conv, e, s, cost, audit, self.first, self.last, self.illegal)
            for e, t in self.tables.items() for s, (cost, audit) in t.items()
        ]


_RUN = ("conv_id {id}, entry int, exit int, cost bigint, audit string, first string, last string, "
        "illegal bigint, part int")
_SOLVED = "conv_id {id}, illegal bigint, cost bigint, audit string"


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _schema(conv: pa.DataType, **fields: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", conv), *fields.items()])


def _search_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, run, out, opening, schema = TaskContext.get().partitionId(), None, [], False, None
    for batch in batches:
        text, long, small = pa.string(), pa.int64(), pa.int32()
        schema = schema or _schema(
            batch.schema.field(0).type, entry=small, exit=small, cost=long, audit=text, first=text,
            last=text, illegal=long, part=small,
        )
        for conv, initial, gone, cut, copies in zip(*[c.to_pylist() for c in batch.columns]):
            if run is None or conv != run.conv:
                if run is not None:
                    out += [(*r, part) for r in run.table()]
                    opening = True
                    if len(out) >= 10_000:
                        yield _batches(out, schema)
                        out = []
                run = _Run(conv, opening)
            run.add((initial, gone, cut))
            for _ in range(copies - 1):  # the copies of a row repeat it
                run.add((initial, True, cut))
    if run is not None:
        yield _batches(out + [(*r, part) for r in run.table()], schema)


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a conversation in order, to its cheapest repair."""
    schema, out = None, []
    conv, part, seen, illegal, last = None, None, False, 0, None
    frontier: Frontier = {}
    ahead: dict[int, Frontier] = {}

    def step() -> None:
        """Take the run whose table is complete."""
        nonlocal frontier, ahead
        reached: Frontier = {}
        for entry, table in ahead.items():
            if entry in frontier:
                cost, audit = frontier[entry]
                for s, (more, letters) in table.items():
                    total = (cost + more, audit + letters)
                    reached[s] = min(reached.get(s, total), total)
        frontier, ahead = reached, {}

    def done() -> None:
        step()
        out.append((conv, illegal, *finish(frontier)))

    for batch in batches:
        schema = schema or _schema(
            batch.schema.field(0).type, illegal=pa.int64(), cost=pa.int64(), audit=pa.string()
        )
        for c, entry, exit_, cost, audit, first, end, wrong, p in zip(
            *[x.to_pylist() for x in batch.columns]
        ):
            if not seen or c != conv:
                if seen:
                    done()
                conv, part, seen, illegal, last = c, p, True, wrong, end
                frontier, ahead = {START: (0, "")}, {}
            elif p != part:
                step()
                illegal += wrong + (last + first not in _LEGAL_PAIRS)
                part, last = p, end
            ahead.setdefault(entry, {})[exit_] = (cost, audit)
        if out:
            yield _batches(out, schema)
            out = []
    if seen:
        done()
        yield _batches(out, schema)


def _normal(turns: DataFrame) -> DataFrame:
    """The four columns, NULL roles and texts as one space, with a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256)
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), digest.alias("digest"))


def _order(*extra: str) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *[F.col(e) for e in extra],
            F.col("turn").asc_nulls_first(), F.col("digest")]


def _marks(rows: DataFrame) -> DataFrame:
    """One row for each turn and text of a conversation, with its faults and its copies.

    A row is repeated if its role and text were there at an earlier turn; the copies at its own turn
    are counted. Both are aggregated before any shuffle, so repeats of any number spread.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.when(F.left("role", F.lit(1)) == "", " ").otherwise(F.left("role", F.lit(1)))
    faults = rows.groupBy(
        "conv_id", "turn", "digest", initial.alias("initial"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    ).agg(F.count("*").alias("copies"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = faults.groupBy("conv_id", "digest").agg(F.min(at).alias("_first"))
    return join_same(faults, first, ["conv_id", "digest"]).select(
        "conv_id", "turn", "digest", "initial", "blank", "cut", "copies",
        (F.col("_first.turn").eqNullSafe(F.col("turn"))).alias("new"),
    )


def solve(turns: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, and the cheapest repair.

    ``gaps`` are the turn numbers missing between the least and the largest; ``blank``, ``duplicate``
    and ``truncated`` count rows by their first fault, ``illegal`` the neighbours whose roles must not
    follow each other; ``cost`` and ``audit`` are those of the repair.

    - NULL roles and texts count as one space; rows are taken by turn, NULL first, and rows of one
      turn by a digest of role and text. A NULL conv_id is a conversation like any other.
    - An empty role, or one that begins with no s, u or a, can be reroled or deleted only.
    - An empty table gives no rows; other columns of any name are ignored.
    """
    marks = stage(_marks(_normal(turns)), "conversation-marks")
    kind = marks.schema["conv_id"].dataType.simpleString()
    copies, zero = F.col("copies"), F.lit(0).cast("long")
    whole = F.col("new") & ~F.col("blank")
    counts = marks.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), zero)
        .cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), copies).otherwise(zero)).alias("blank"),
        F.sum(F.when(F.col("blank"), zero).otherwise(copies - F.col("new").cast("long"))).alias("duplicate"),
        F.sum((whole & F.col("cut")).cast("long")).alias("truncated"),
    )
    order = _order()
    runs = marks.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "initial", (~whole).alias("gone"), "cut", "copies"
    ).mapInArrow(_search_runs, _RUN.format(id=kind))
    joined = runs.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "part"
    ).mapInArrow(_join_runs, _SOLVED.format(id=kind))
    return join_same(counts, joined, ["conv_id"])


def _follow(
    rows: Iterable[tuple],
) -> Iterator[tuple[int | None, str | None, str, str]]:
    """Conversation, edit, role and text of each turn; a new conversation comes with no edit."""
    audit, at, state = "", 0, START

    def insert(conv):
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state = _NEXT[state]
            at += 1
            yield conv, "I", "user" if state == USER else "assistant", ""

    conv = None
    for conv_id, kind, role, text in rows:
        if kind == 0:
            yield from insert(conv)
            conv, audit, at, state = conv_id, text, 0, START
            yield conv, None, "", ""
            continue
        yield from insert(conv)
        edit = audit[at]
        at += 1
        if edit == "R":
            state = _NEXT[state]
            yield conv, "R", "user" if state == USER else "assistant", text
        elif edit == "K":
            state = _KEEP[state, role[:1]]
            yield conv, "K", role, text
    yield from insert(conv)


def _stream(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows behind the audit of their conversation, each conversation in the stream of one task."""
    audits = solved.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("digest"), F.lit("").alias("role"), F.col("audit").alias("text"),
    )
    rows = _normal(turns).select(
        "conv_id", F.lit(1).alias("kind"), F.col("turn").cast("bigint"), "digest", "role", "text"
    )
    return audits.unionByName(rows).repartition("conv_id").sortWithinPartitions(
        *_order("kind")
    ).select("conv_id", "kind", "role", "text")


def repaired_turns(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, place from 0, role, text and edit (K, R or I).

    ``solved`` is what :func:`solve` gave for the same rows. Texts pass in a stream sorted by turn.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, place, size = None, [], 0, 0

        def rows() -> Iterator[tuple]:
            nonlocal schema
            for batch in batches:
                schema = schema or _schema(
                    batch.schema.field(0).type, place=pa.int64(), role=pa.string(),
                    text=pa.string(), edit=pa.string(),
                )
                yield from zip(*[c.to_pylist() for c in batch.columns])

        for conv, edit, role, text in _follow(rows()):
            if edit is None:
                place = 0
                continue
            out.append((conv, place, role, text, edit))
            place, size = place + 1, size + len(text)
            if len(out) == 2_000 or size > 1 << 24:
                yield _batches(out, schema)
                out, size = [], 0
        if out:
            yield _batches(out, schema)

    return _stream(turns, solved).mapInArrow(
        run, f"conv_id {kind}, place bigint, role string, text string, edit string"
    )


def repaired_digests(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired turns as lines ``role:text``, fed turn by turn."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                types[:] = types or [batch.schema.field(0).type]
                yield from zip(*[c.to_pylist() for c in batch.columns])

        out, digest, conv, first = [], None, None, True
        for conv_id, edit, role, text in _follow(rows()):
            if edit is None:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                    if len(out) == 10_000:
                        yield _batches(out, _schema(types[0], repaired_sha256=pa.string()))
                        out = []
                conv, digest, first = conv_id, hashlib.sha256(), True
                continue
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if digest is not None:
            yield _batches([*out, (conv, digest.hexdigest())], _schema(types[0], repaired_sha256=pa.string()))

    return _stream(turns, solved).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows harmed by a checksum of conversation and turn, to try the repair on.

    Of the remainders by 20, 0 drops a row, 1 empties its text, 2 removes its ends of sentences,
    3 repeats it at the same turn, 4 gives it the role user. NULLs count as one space.
    """
    words = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(words["conv_id"], F.lit(":"), words["turn"]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(
        kind == 2, F.translate(words["text"], ".!?", "")
    ).otherwise(words["text"])
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(words["role"]).alias("role"),
        text.alias("text"), kind.alias("_kind"),
    ).filter("_kind <> 0")
    twice = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.withColumn("_copy", twice).drop("_kind", "_copy")
