"""Structure repair of conversations by a Viterbi search that forgets what is settled.

The cheapest edits that make the roles of a conversation alternate are found by dynamic
programming over its turns. The paths to the four states form a tree of back-pointers; a
reference count on every node tells when all surviving paths share an ancestor, and the
edits up to there are emitted at once. A task holds what is unsettled, never a conversation.

Rows are brought into order by a range partitioning, which cuts long conversations; the
search reads them as chunks of a few bytes a row, and texts only meet the edits by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import shuffle_parts, stage_for

#: Rows of a conversation that the search reads as one value, and such values at a time.
CHUNK_BITS = 9
CHUNKS_AT_ONCE = 64
#: Rows that a task hands on together.
ROWS_OUT = 4096

# --- fixed values: costs, states and white space of the repair -----------------
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
WHITE = " \t\n\x0b\f\r"
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# -------------------------------------------------------------------------------

#: State after a turn of the next role, by state before it.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: States that a kept turn of a role may follow.
BEFORE = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
LEGAL_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
BLANK, AGAIN, CUT = 1, 2, 4

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Node:
    """One edit on the way to one or more surviving states."""

    __slots__ = ("letter", "state", "parent", "kids", "refs")

    def __init__(self, letter: str, state: int, parent: "Node | None") -> None:
        self.letter, self.state, self.parent = letter, state, parent
        self.kids: set[Node] = set()
        self.refs = 0
        if parent is not None:
            parent.kids.add(self)
            parent.refs += 1


def release(node: Node | None) -> None:
    """Drop one reference; nodes that nothing needs leave the tree, up to one that is needed."""
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        parent = node.parent
        if parent is not None:
            parent.kids.discard(node)
        node = parent


class Search:
    """Survivors of one conversation, fed row by row.

    Each state has its cheapest path: cost, last node, and its rank among the survivors'
    whole unsettled edits in ASCII order. Equal costs are decided by these ranks and the
    letters added: since no survivor's edits begin another's, the order of two extended paths is
    that of the paths, or for one and the same path that of the letters. So complete
    tied suffixes are compared without walking them.
    """

    def __init__(self) -> None:
        self.root = Node("", START, None)
        self.root.refs = 1
        self.alive: dict[int, tuple[int, int, Node]] = {START: (0, 0, self.root)}

    def _with_inserts(self) -> dict[int, tuple[int, int, str, Node]]:
        """Cheapest way into each state when turns may be inserted after the last row."""
        ways = {q: (cost, rank, "", node) for q, (cost, rank, node) in self.alive.items()}
        into = [(c + INSERT, r, "I", n) for q, (c, r, n) in self.alive.items() if NEXT[q] == USER]
        if USER in ways:
            into.append(ways[USER])
        if into:
            ways[USER] = cost, rank, letters, node = min(into, key=lambda w: w[:3])
            more = (cost + INSERT, rank, letters + "I", node)
            ways[ASSISTANT] = min(more, ways.get(ASSISTANT, more), key=lambda w: w[:3])
        return ways

    def feed(self, role: int, must_go: bool, cut: bool) -> None:
        """Take one row: kept, given another role, or deleted, after any inserted turns."""
        best: dict[int, tuple[int, int, str, Node]] = {}

        def offer(state: int, cost: int, rank: int, letters: str, node: Node) -> None:
            old = best.get(state)
            if old is None or (cost, rank, letters) < old[:3]:
                best[state] = (cost, rank, letters, node)

        extra = TRUNCATED if cut else 0
        for q, (cost, rank, letters, node) in self._with_inserts().items():
            offer(q, cost + DELETE, rank, letters + "D", node)
            if must_go:
                continue
            offer(NEXT[q], cost + extra + RELABEL, rank, letters + "R", node)
            if role and q in BEFORE[role]:
                offer(role, cost + extra, rank, letters + "K", node)

        made: dict[tuple[int, str], Node] = {}
        alive = {}
        order = sorted(best, key=lambda q: best[q][1:3])
        for rank, q in enumerate(order):
            cost, _, letters, node = best[q]
            alive[q] = (cost, rank, self._grown(made, node, letters, q))
        for _, _, node in alive.values():
            node.refs += 1
        for _, _, node in self.alive.values():
            release(node)
        self.alive = alive

    @staticmethod
    def _grown(made: dict, node: Node, letters: str, last: int) -> Node:
        """The node that ``letters`` lead to; paths that add the same letters share nodes."""
        start = id(node)
        for k, letter in enumerate(letters, 1):
            state = last if k == len(letters) else NEXT[node.state]
            if (start, letters[:k]) not in made:
                made[start, letters[:k]] = Node(letter, state, node)
            node = made[start, letters[:k]]
        return node

    def settled(self) -> Iterator[Node]:
        """Edits that all survivors share and that were not handed out yet."""
        while self.root.refs == 1 and self.root.kids:
            (child,) = self.root.kids
            child.parent, self.root.kids = None, set()
            self.root = child
            yield child

    def finish(self) -> tuple[int, list[Node]]:
        """Cost of the cheapest whole path, and its edits that were not handed out yet."""
        ends = [w for q, w in self._with_inserts().items() if q in (START, ASSISTANT)]
        cost, _, letters, node = min(ends, key=lambda w: w[:3])
        tail = [] if not letters else [Node("I", NEXT[node.state], None)]
        if len(letters) == 2:
            tail.append(Node("I", NEXT[tail[0].state], None))
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        return cost, path[::-1] + tail


class Conversation:
    """Search, counts and the rows whose edits are not settled yet, of one conversation."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.search = conv_id, Search()
        self.low = self.high = self.turn = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.waiting: list[list[int]] = []  # position and copies whose edits are not handed out
        self.first = self.sub = 0

    def row(self, position: int, turn: int | None, role: int, faults: int, copies: int) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1
        if faults & BLANK:
            self.blank += copies
        else:
            own = copies if faults & AGAIN else copies - 1
            self.duplicate += own
            self.truncated += bool(faults & CUT) and own < copies
        self.illegal += (self.before is not None and (self.before, role) not in LEGAL_PAIRS) + copies - 1
        self.before = role
        self.waiting.append([position, copies])

    def edits(self, nodes: Iterable[Node]) -> Iterator[tuple]:
        """Rows ``conv_id, position, sub, edit, role, counts`` of settled edits.

        An inserted turn stands with the next row, after the last one with that.
        """
        for node in nodes:
            at, left = self.waiting[min(self.first, len(self.waiting) - 1)]
            role = ROLE_OF[node.state] if node.letter in "RI" else None
            yield self.conv_id, at, self.sub, node.letter, role, None
            self.sub += 1
            if node.letter != "I":
                self.waiting[self.first][1] = left - 1
                self.first += left == 1
        if self.first > ROWS_OUT:
            del self.waiting[: self.first - 1]
            self.first = 1

    def end(self) -> Iterator[tuple]:
        cost, nodes = self.search.finish()
        yield from self.edits(nodes)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = [gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost]
        yield self.conv_id, None, None, None, None, counts


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``conv_id`` and the columns of its next chunk, in order."""
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNKS_AT_ONCE):
            piece = batch.slice(a, CHUNKS_AT_ONCE)
            conv_ids, chunks = piece.column("conv_id").to_pylist(), piece.column("rows")
            for k, conv_id in enumerate(conv_ids):
                values = chunks[k].values
                yield conv_id, [values.field(f).to_pylist() for f in ("pos", "turn", "initial", "faults", "copies")]


def _searched(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    now = None
    for conv_id, columns in _rows(batches):
        if now is None or now.conv_id != conv_id:
            if now is not None:
                yield from now.end()
            now = Conversation(conv_id)
        for position, turn, role, faults, copies in zip(*columns):
            now.row(position, turn, role, faults, copies)
            must_go = bool(faults & (BLANK | AGAIN))
            for k in range(copies):
                now.search.feed(role, must_go or k > 0, bool(faults & CUT))
                yield from now.edits(now.search.settled())
    if now is not None:
        yield from now.end()


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_OUT:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Different rows of each conversation, in order, with their faults, as a written table.

    ``pos`` rises with ``conv_id, turn, role, text`` (null turns first) over the whole table; ``copies``
    counts equal rows, so a hot row is one. ``again`` marks rows whose role and text an earlier
    turn has; the first turn of every role and text is an aggregate, joined by the whole key.
    """
    spark = turns.sparkSession
    staging = stage_for(spark)
    space = F.lit(" ")
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)))
    rows = staging.table(rows, "rows")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    firsts = rows.groupBy("conv_id", "role", "digest").agg(first.alias("first")).select(
        "conv_id", "role", "digest", "first.turn", F.lit(True).alias("is_first")
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("conv_id", "turn", "role", "digest")]
    rows = rows.alias("l").join(firsts.alias("r"), same, "left").select("l.*", "r.is_first")
    end = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    initial = F.substring("role", 1, 1)
    order = ["conv_id", "turn", "role"]
    rows = rows.select(
        *order, "text", "copies",
        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
        .otherwise(START).alias("initial"),
        (end == "").alias("blank"), F.col("is_first").isNull().alias("again"),
        (~end.isin(".", "!", "?")).alias("cut"),
    )
    spread = rows.repartitionByRange(shuffle_parts(spark), *order, F.substring("text", 1, 64))
    spread = spread.sortWithinPartitions(*order, "text")
    ordered = staging.table(spread.withColumn("pos", F.monotonically_increasing_id()), "ordered")
    staging.drop("rows")
    return ordered


def repair_edits(ordered: DataFrame) -> DataFrame:
    """``conv_id, pos, sub, edit, role, counts`` of :func:`ordered_turns`, as a written table.

    Per row and copy one edit ``K`` (keep), ``R`` (other role) or ``D`` (delete), per inserted turn
    an ``I``; ordered by ``pos, sub``. ``role`` is the new one. One more row per conversation, without
    ``pos``, has its ``COUNTS``.
    """
    faults = (
        F.col("blank").cast("int") * BLANK + F.col("again").cast("int") * AGAIN
        + F.col("cut").cast("int") * CUT
    )
    cells = F.struct("pos", "turn", "initial", faults.alias("faults"), "copies")
    chunks = ordered.groupBy("conv_id", F.shiftright("pos", CHUNK_BITS).alias("chunk")).agg(
        F.array_sort(F.collect_list(cells)).alias("rows")
    )
    kind = ordered.schema["conv_id"].dataType.simpleString()
    out = f"conv_id {kind}, pos long, sub long, edit string, role string, counts array<long>"
    spark = ordered.sparkSession
    chunks = chunks.repartition(shuffle_parts(spark), "conv_id").sortWithinPartitions("conv_id", "chunk")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, first = iter(batches), next(batches, None)
        if first is None:
            return
        schema = pa.schema([
            first.schema.field("conv_id"), pa.field("pos", pa.int64()), pa.field("sub", pa.int64()),
            pa.field("edit", pa.string()), pa.field("role", pa.string()),
            pa.field("counts", pa.list_(pa.int64())),
        ])
        yield from _batched(_searched(_chained(first, rows)), schema)

    return stage_for(spark).table(chunks.mapInArrow(search, out), "edits")


def _chained(first: pa.RecordBatch, rest: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def repaired_turns(ordered: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits with the turns they leave: ``conv_id, pos, sub, edit, role, text``; deleted ones have neither."""
    own = ordered.select("pos", F.col("role").alias("own"), F.col("text").alias("words"))
    rows = edits.where(F.col("pos").isNotNull()).join(own, "pos")
    kept = F.col("edit").isin("K", "R")
    return rows.select(
        "conv_id", "pos", "sub", "edit",
        F.when(F.col("edit") == "K", F.col("own")).otherwise(F.col("role")).alias("role"),
        F.when(kept, F.col("words")).when(F.col("edit") == "I", F.lit("")).alias("text"),
    )


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Counts, audit and hash per conversation, from its rows in order, the counts first."""
    open_, conv, counts, audit, digest, some = False, None, None, [], hashlib.sha256(), False
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNKS_AT_ONCE):
            piece = batch.slice(a, CHUNKS_AT_ONCE)
            cells = [piece.column(c).to_pylist() for c in ("conv_id", "counts", "edit", "role", "text")]
            for conv_id, has, edit, role, text in zip(*cells):
                if has is not None:
                    if open_:
                        yield conv, *counts, "".join(audit), digest.hexdigest()
                    open_, conv, counts, audit = True, conv_id, has, []
                    digest, some = hashlib.sha256(), False
                    continue
                audit.append(edit)
                if edit != "D":
                    digest.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
    if open_:
        yield conv, *counts, "".join(audit), digest.hexdigest()


def repair_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, the ``COUNTS``, ``audit`` and ``repaired_sha256`` of each conversation of ``turns``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not looked at. Turns are ordered
    by ``turn`` (null first), then role and text; equal rows are rows of their own. A null role or text
    counts as one space; a null ``conv_id`` is a conversation too. Blank and repeated turns must
    go; all others are kept, given the role that fits, or deleted, and turns without text may be
    inserted, so that the roles read ``(s?(ua)+)?`` by their initials at the least cost; of
    equal costs the ASCII-least ``audit`` (initials of the edits) wins. ``repaired_sha256`` is over
    ``role:text`` of what is left, joined by newlines; a hash is computed in order, so the texts of one
    conversation pass one task, row by row. An empty table gives an empty result.
    """
    ordered = ordered_turns(turns)
    edits = repair_edits(ordered)
    counts = edits.where(F.col("pos").isNull()).select(
        "conv_id", "pos", "sub", "counts", *[F.lit(None).cast("string").alias(c) for c in ("edit", "role", "text")]
    )
    rows = repaired_turns(ordered, edits).withColumn("counts", F.lit(None).cast("array<long>"))
    both = counts.unionByName(rows)
    both = both.repartition(shuffle_parts(turns.sparkSession), "conv_id")
    both = both.sortWithinPartitions("conv_id", F.col("pos").asc_nulls_first(), "sub")
    kind = ordered.schema["conv_id"].dataType.simpleString()
    out = ", ".join([f"conv_id {kind}", *[f"{c} long" for c in COUNTS], "audit string", "repaired_sha256 string"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([
            first.schema.field("conv_id"), *[pa.field(c, pa.int64()) for c in COUNTS],
            pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string()),
        ])
        yield from _batched(_digested(_chained(first, batches)), schema)

    return both.mapInArrow(digest, out)
