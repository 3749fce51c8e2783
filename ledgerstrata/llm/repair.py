"""Cheapest repair of conversations: a Viterbi search that emits edits once its survivors agree.

A repaired conversation is an optional system turn and then pairs of a user and an assistant turn, or
nothing. Turns are kept (K), given another role (R) or deleted (D), and empty turns are inserted (I).
The search reads a conversation in order and holds, for each state of that grammar, the cheapest edits
so far; among equally cheap ones the edits whose initials are least in ASCII order.

Survivors share a tree of backpointers. A node has the edits of a stretch without branches and the
number of survivors' paths that go through it; a node that no path needs any more is freed, and one that
is left with one child takes up the child, so the tree never has more than a few nodes. What all
survivors share is emitted at once and forgotten. What is not yet shared stays as one byte per edit and
the turns that wait for it. Ties are decided by comparing the whole unresolved paths: from where they part.

A survivor that cannot win any more is dropped: where another one, even with the most that its state can
cost in excess, stays cheaper.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States: nothing yet, after a system, a user, an assistant turn. Initials of roles; 3 is any other.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
S, U, A, OTHER = range(4)
# Faults of a turn.
SOUND, BLANK, DUPLICATE, CUT = range(4)

# What a completion from one state can cost beyond a completion from another, at most: EXCESS[t][s] is
# the bound of cost(from t) - cost(from s) over all rests of a conversation. A system turn that only a
# start can keep is deleted, a missing user or assistant turn is inserted, a lone start gets a pair.
EXCESS = (
    (0, 0, INSERT, 0),
    (2 * INSERT, 0, INSERT, 2 * INSERT),
    (INSERT + DELETE, INSERT, 0, INSERT),
    (DELETE, 0, INSERT, 0),
)
# Edits that end a conversation, by state.
ENDING = {NOTHING: b"", SYSTEM: b"II", USER: b"I", ASSISTANT: b""}


def _steps(state: int, initial: int, fault: int) -> Iterator[tuple[int, int, bytes]]:
    """(next state, cost, edits) of one turn; insertions come right before a turn that stays."""
    yield state, DELETE, b"D"
    if fault in (BLANK, DUPLICATE):
        return
    extra = TRUNCATED if fault == CUT else 0
    if state == NOTHING and initial == S:
        yield SYSTEM, extra, b"K"
    for wanted, target in ((U, USER), (A, ASSISTANT)):
        edit, cost = (b"K", extra) if initial == wanted else (b"R", extra + REROLE)
        if (state == USER) == (wanted == A):
            yield target, cost, edit
        else:
            yield target, cost + INSERT, b"I" + edit


class Node:
    """A stretch of edits without branches; ``children`` are the branches that paths still need."""

    __slots__ = ("parent", "children", "edits")

    def __init__(self, parent: Node | None = None, edits: bytes = b""):
        self.parent = parent
        self.children: list[Node] = []
        self.edits = bytearray(edits)


# What a turn does to survivors with given relative costs; few are possible, as costs are bounded.
_known: dict = {}


def _turn(costs: tuple[tuple[int, int], ...], initial: int, fault: int) -> tuple:
    """Added cost, new relative costs, and for each new state its equally cheap (old state, edits)."""
    best: dict[int, tuple[int, list]] = {}
    for state, cost in costs:
        for target, more, edits in _steps(state, initial, fault):
            total = cost + more
            if target not in best or total < best[target][0]:
                best[target] = total, []
            if total == best[target][0]:
                best[target][1].append((state, edits))
    alive = [
        s for s, (cost, _) in best.items()
        if all(cost <= other + EXCESS[t][s] for t, (other, _) in best.items())
    ]
    least = min(best[s][0] for s in alive)
    return least, tuple((s, best[s][0] - least) for s in alive), tuple((s, best[s][1]) for s in alive)


class Survivors:
    """The search over one conversation: ``turn`` for each turn, then ``end``; both return edits."""

    def __init__(self):
        self.base = 0
        self.costs: tuple = ((NOTHING, 0),)
        self.leaves = {NOTHING: Node()}

    def _path(self, node: Node) -> list[Node]:
        path = [node]
        while node.parent is not None:
            node = node.parent
            path.append(node)
        return path[::-1]

    def _least(self, choices: list[tuple[int, bytes]]) -> tuple[int, bytes]:
        """The choice whose whole unresolved path is least. No path begins with all of another one:
        both have an edit for each turn, and what follows the last of these costs extra."""
        best = choices[0]
        for other in choices[1:]:
            for a, b in zip(self._path(self.leaves[best[0]]), self._path(self.leaves[other[0]])):
                if a is not b:
                    if b.edits < a.edits:
                        best = other
                    break
        return best

    def _merge(self, node: Node) -> None:
        """Take up the only child."""
        (child,) = node.children
        node.edits += child.edits
        node.children = child.children
        for x in node.children:
            x.parent = node
        if not node.children:
            for state, leaf in self.leaves.items():
                if leaf is child:
                    self.leaves[state] = node

    def _free(self, leaves: list[Node]) -> None:
        """Drop leaves that no path needs any more, and stretches that are left with one child."""
        for node in leaves:
            while node.parent is not None and not node.children:
                node.parent.children.remove(node)
                node = node.parent
        for leaf in list(self.leaves.values()):
            node = leaf
            while node is not None:
                if len(node.children) == 1:
                    self._merge(node)
                node = node.parent

    def _resolved(self) -> bytes:
        """Edits that all survivors share, taken off the root of the tree."""
        root = next(iter(self.leaves.values()))
        while root.parent is not None:
            root = root.parent
        shared = bytes(root.edits)
        if shared:
            root.edits.clear()
        return shared

    def turn(self, initial: int, fault: int) -> bytes:
        key = self.costs, initial, fault
        if key not in _known:
            _known[key] = _turn(*key)
        more, self.costs, picks = _known[key]
        self.base += more
        chosen = [
            (target, *(choices[0] if len(choices) == 1 else self._least(choices)))
            for target, choices in picks
        ]
        uses: dict[int, int] = {}
        for _, state, _ in chosen:
            uses[state] = uses.get(state, 0) + 1
        old, self.leaves = self.leaves, {}
        for target, state, edits in chosen:
            node = old[state]
            if uses[state] == 1:
                node.edits += edits
            else:
                node.children.append(child := Node(node, edits))
                node = child
            self.leaves[target] = node
        if len(uses) < len(old):
            self._free([node for state, node in old.items() if state not in uses])
        return self._resolved()

    def end(self) -> tuple[int, bytes]:
        """Cost of the repair, and the edits that were still open."""
        totals = {s: cost + INSERT * len(ENDING[s]) for s, cost in self.costs}
        least = min(totals.values())
        state, _ = self._least([(s, b"") for s, total in totals.items() if total == least])
        rest = b"".join(bytes(n.edits) for n in self._path(self.leaves[state]))
        return self.base + least, rest + ENDING[state]


class Conversation:
    """One conversation on its way through the search; ``emit`` gets each edit with its turn."""

    def __init__(self, emit: Callable[[int, bytes | None, bytes | None], None]):
        self.emit = emit
        self.search = Survivors()
        self.waiting: deque = deque()
        self.audit = bytearray()
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.last: int | None = None
        self.next_is_user = True
        self.started = False
        self.low: int | None = None
        self.high: int | None = None
        self.numbers = 0

    def add(self, number: int | None, initial: int, fault: int, role: bytes, text: bytes) -> None:
        if number is not None and number != self.high:  # numbers come in order
            self.low = number if self.low is None else self.low
            self.high = number
            self.numbers += 1
        if self.last is not None and (self.last, initial) not in ((S, U), (U, A), (A, U)):
            self.illegal += 1
        self.last = initial
        self.counts[fault] += 1
        self.waiting.append(None if fault in (BLANK, DUPLICATE) else (initial, role, text))
        edits = self.search.turn(initial, fault)
        if edits:
            self._apply(edits)

    def _apply(self, edits: bytes) -> None:
        self.audit += edits
        for edit in edits:
            turn = None if edit == 73 else self.waiting.popleft()  # I
            if edit == 68:  # D
                self.emit(edit, None, None)
                continue
            if edit == 75 and turn[0] == S and not self.started:  # K
                self.emit(edit, turn[1], turn[2])
            else:
                role = b"user" if self.next_is_user else b"assistant"
                self.next_is_user = not self.next_is_user
                self.emit(edit, turn[1] if edit == 75 else role, turn[2] if turn else b"")
            self.started = True

    def end(self) -> int:
        cost, rest = self.search.end()
        self._apply(rest)
        return cost

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.numbers


# Rows or bytes of text that a task collects before it sends them on.
_SEND_ROWS, _SEND_BYTES = 10_000, 8_000_000


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        # A few rows at a time, as Python objects take more memory than the batch.
        for i in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(i, 1000).columns))


def _reports(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row for each conversation."""
    rows, size = [], 0
    key, now, digest, first = None, None, None, True

    def emit(edit: int, role: bytes | None, text: bytes | None) -> None:
        nonlocal first
        if edit != 68:
            digest.update(role + b":" + text if first else b"\n" + role + b":" + text)
            first = False

    def report() -> tuple:
        cost = now.end()
        _, *faults = now.counts
        return (key, now.gaps, *faults, now.illegal, cost, now.audit.decode(), digest.hexdigest())

    for conv, number, present, initial, fault, role, text in _each(batches):
        if now is None or conv != key:
            if now is not None:
                rows.append(report())
                size += len(rows[-1][-2])
                if len(rows) >= _SEND_ROWS or size > _SEND_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            key, now, digest, first = conv, Conversation(emit), hashlib.sha256(), True
        if present:
            now.add(number, initial, fault, role, text)
    if now is not None:
        rows.append(report())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _edits(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row for each edit, in order."""
    rows, size, position = [], 0, 0
    key, now = None, None

    def emit(edit: int, role: bytes | None, text: bytes | None) -> None:
        nonlocal position, size
        position += 1
        shown = [x if x is None else x.decode() for x in (role, text)]
        rows.append((key, position, chr(edit), *shown))
        size += len(text or b"")

    def batch() -> pa.RecordBatch:
        nonlocal rows, size
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        rows, size = [], 0
        return out

    for conv, number, present, initial, fault, role, text in _each(batches):
        if now is None or conv != key:
            if now is not None:
                now.end()
            key, now, position = conv, Conversation(emit), 0
        if present:
            now.add(number, initial, fault, role, text)
        if len(rows) >= _SEND_ROWS or size > _SEND_BYTES:
            yield batch()
    if now is not None:
        now.end()
    if rows:
        yield batch()


_BLANKS = " \t\n\x0b\x0c\r"


def faulty_turns(turns: DataFrame, present: str | None = None) -> DataFrame:
    """Turns in order, each with its first fault: conv_id, turn, present, initial, fault, role, text.

    ``turns`` has conv_id, turn, role and text. A conversation lies in one partition, sorted by turn
    (NULL first), role and text; a NULL role or text is one space, a NULL conv_id is a conversation. A
    turn is blank without a character other than blanks, a duplicate if an earlier one has its role and
    text, and cut if its last such character is none of ``.!?``. Rows where the column ``present`` is
    not true only name their conversation. Texts that will be deleted are not passed on.

    One shuffle by conversation serves duplicates and the search; both sorts spill to disk.
    """
    there = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    filled = lambda name: F.when(there, F.coalesce(F.col(name), F.lit(" ")))
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), there.alias("present"),
        filled("role").alias("role"), filled("text").alias("text"),
    ).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    place = F.row_number().over(earlier)
    shown = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = (
        F.when(shown == "", BLANK)
        .when(F.col("place") > 1, DUPLICATE)
        .when(~F.substring(shown, -1, 1).isin(".", "!", "?"), CUT)
        .otherwise(SOUND)
    )
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")]
    sent: Column = F.when(~F.col("fault").isin(BLANK, DUPLICATE), F.col("text").cast("binary"))
    return (
        rows.withColumn("place", place)
        .withColumns({"fault": fault, "initial": initial})
        .sortWithinPartitions("conv_id", *order, "place")
        .select("conv_id", "turn", "present", "initial", "fault", F.col("role").cast("binary"), sent.alias("text"))
    )


def _searched(turns: DataFrame, present: str | None, function: Callable, columns: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = turns.sparkSession.createDataFrame([], f"conv_id {kind}, {columns}").schema
    arrow = to_arrow_schema(schema)
    return faulty_turns(turns, present).mapInArrow(lambda b: function(b, arrow), schema)


def repair_reports(turns: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation: its faults and the cheapest repair.

    ``gaps`` is the number of missing turn numbers between the first and the last; ``blank``,
    ``duplicate`` and ``truncated`` count turns by their first fault; ``illegal`` counts neighbours whose
    roles may not follow each other; ``cost`` and ``audit`` (initials of the edits in order) are those of
    the cheapest repair; ``repaired_sha256`` is the digest of its turns as ``role:text`` lines.

    Keeping a turn costs 0, another role 2, deletion 3 (blank and repeated turns must go), insertion 2,
    a truncated turn that stays 1 more. A conversation without present rows has zeros, an empty audit
    and the digest of nothing; an empty table gives no rows. Rows that are repeated are duplicates.
    Other columns are not read. See ``faulty_turns`` for NULLs and order.

    A conversation is read by one task, as its digest is over its whole text in order, but it is
    streamed: memory holds unresolved edits, the turns that wait for them and the audit.
    """
    columns = (
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
        " audit string, repaired_sha256 string"
    )
    return _searched(turns, present, _reports, columns)


def repaired_turns(turns: DataFrame, present: str | None = None) -> DataFrame:
    """The edits of the cheapest repair: conv_id, position (from 1), edit (K, R, D or I), role, text.

    Deleted turns have neither role nor text. The rows without them, by position, are the repaired
    conversation. Costs and order are those of ``repair_reports``.
    """
    return _searched(turns, present, _edits, "position long, edit string, role string, text string")
