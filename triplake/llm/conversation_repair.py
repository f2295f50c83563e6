"""Repair of the turn structure of conversations by a search over the edit lattice.

A conversation's rows, in order, and the states of the pattern ``(s?(ua)+)?`` of role
initials span a lattice: node (i, state) says that i rows are dealt with and that what
is kept so far has led to ``state``. An arc keeps, reroles or deletes the next row, or
inserts a row. Bidirectional Dijkstra finds the cheapest way through: a heap forward from
the start and one in reverse from the ends settle nodes by cost, and by least audit among
equal costs, until no better meeting is possible; then every crossing of that cost has
been finished, and the least concatenated audit is taken. Of two ways of one cost between
the same nodes neither audit is a proper prefix of the other (they deal with equally many
rows, so the longer one would insert more), which is why least parts make a least whole.

Conversations of up to ``LONG_ROWS`` rows meet in one task each, sorted by the shuffle
and streamed. Longer ones are cut into blocks by a range sort: each block is searched
between every pair of states, and what it costs from state to state is an arc of a
coarser lattice, one column a block, that the same search goes through. So no task holds
a long conversation's rows; only its audit, which is one value of the result, and its
hash, which has to see the texts in order (streamed, a batch at a time), are whole.

Defined cases: a NULL conversation id, role, text or turn in a damage key counts as one
space; a NULL turn comes first; rows of one turn are ordered by role, then by the hash of
their text; equal rows are duplicates of the first of them; an empty role has no initial,
so it can only be reroled or deleted; conversations without rows after damage have zeros,
an empty audit and the hash of an empty string; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import stored

# What an edit costs, by the initial that the audit has for it.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3

# The pattern as an automaton: state -> {initial: state}. A row that is reroled or
# inserted can be a user's or an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ENDS = (START, ASSISTANT)
STATES = tuple(STEPS)
FREE = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

# Faults of a row, as one character of a conversation's signature.
FINE, BLANK, DUPLICATE, TRUNCATED = ".", "b", "d", "t"
# A role whose initial the pattern does not know.
OTHER = "-"

LONG_ROWS = 4096
# No more conversations than this are long, so that their ids can be broadcast.
MOST_LONG = 1 << 20

Node = tuple[int, int]
Arc = tuple[Node, int, str]


class Rows:
    """Lattice of single rows, from their signature: two characters each, role initial
    and fault."""

    def __init__(self, signature: str):
        self.signature = signature
        self.length = len(signature) // 2

    def _edits(self, i: int) -> Iterator[tuple[int, int, int, str]]:
        """(from state, to state, cost, audit) of what can be done with row i."""
        initial, fault = self.signature[2 * i], self.signature[2 * i + 1]
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        for state in STATES:
            yield state, state, COSTS[DELETE], DELETE
            if fault in (BLANK, DUPLICATE):
                continue
            for given, target in STEPS[state].items():
                if given == initial:
                    yield state, target, COSTS[KEEP] + more, KEEP
                if given in FREE:
                    yield state, target, COSTS[REROLE] + more, REROLE

    def after(self, node: Node) -> Iterator[Arc]:
        i, state = node
        if i < self.length:
            for source, target, cost, audit in self._edits(i):
                if source == state:
                    yield (i + 1, target), cost, audit
        for given, target in STEPS[state].items():
            if given in FREE:
                yield (i, target), COSTS[INSERT], INSERT

    def before(self, node: Node) -> Iterator[Arc]:
        i, state = node
        if i > 0:
            for source, target, cost, audit in self._edits(i - 1):
                if target == state:
                    yield (i - 1, source), cost, audit
        for source in STATES:
            for given, target in STEPS[source].items():
                if given in FREE and target == state:
                    yield (i, source), COSTS[INSERT], INSERT


class Blocks:
    """Lattice of blocks, from what each costs between two states."""

    def __init__(self, blocks: list[dict[tuple[int, int], tuple[int, str]]]):
        self.blocks = blocks
        self.length = len(blocks)

    def after(self, node: Node) -> Iterator[Arc]:
        i, state = node
        if i < self.length:
            for (source, target), (cost, audit) in self.blocks[i].items():
                if source == state:
                    yield (i + 1, target), cost, audit

    def before(self, node: Node) -> Iterator[Arc]:
        i, state = node
        if i > 0:
            for (source, target), (cost, audit) in self.blocks[i - 1].items():
                if target == state:
                    yield (i - 1, source), cost, audit


class _Side:
    """One of the two searches. At equal costs nodes are settled in the order of their
    rows, so that all ways of that cost have reached a node before it is settled."""

    def __init__(self, starts: Iterable[Node], arcs: Callable, joined: Callable, ahead: int):
        self.arcs, self.joined, self.ahead = arcs, joined, ahead
        self.seen = {node: (0, "") for node in starts}
        self.heap = [(0, ahead * node[0], node) for node in self.seen]

    def least(self) -> float:
        while self.heap and self.heap[0][0] > self.seen[self.heap[0][2]][0]:
            heapq.heappop(self.heap)  # a cheaper way was found since
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> Iterator[Node]:
        """Take the next node; gives the nodes that it leads to by a better way."""
        cost, _, node = heapq.heappop(self.heap)
        audit = self.seen[node][1]
        for other, more, edit in self.arcs(node):
            way = cost + more, self.joined(audit, edit)
            known = self.seen.get(other)
            if known is None or way < known:
                self.seen[other] = way
                if known is None or way[0] < known[0]:
                    heapq.heappush(self.heap, (way[0], self.ahead * other[0], other))
                yield other


def search(lattice: Rows | Blocks, start: int = START, ends: Iterable[int] = ENDS) -> tuple[int, str] | None:
    """The least cost from ``start`` to any of ``ends``, and the least audit of that
    cost; None where there is no way."""
    forward = _Side([(0, start)], lattice.after, lambda audit, edit: audit + edit, 1)
    reverse = _Side([(lattice.length, e) for e in ends], lattice.before, lambda audit, edit: edit + audit, -1)

    def crossing(node: Node) -> tuple[float, str]:
        (there, first), (back, last) = forward.seen[node], reverse.seen[node]
        return there + back, first + last

    none: tuple[float, str] = (float("inf"), "")
    best = min(map(crossing, forward.seen.keys() & reverse.seen.keys()), default=none)
    while True:
        there, back = forward.least(), reverse.least()
        # What neither side has settled costs more than the best crossing.
        if there + back > best[0] or there + back == float("inf"):
            break
        side, other = (forward, reverse) if there <= back else (reverse, forward)
        for node in side.settle():
            if node in other.seen:
                best = min(best, crossing(node))
    return None if best == none else (int(best[0]), best[1])


@lru_cache(1 << 15)
def _short_search(signature: str) -> tuple[int, str]:
    return search(Rows(signature))


def repair(signature: str) -> tuple[int, str]:
    """Cost and audit; signatures that come often are searched once a worker."""
    return _short_search(signature) if len(signature) <= 64 else search(Rows(signature))


def state_after(kept: int, total: int) -> int:
    """The state after ``kept`` of ``total`` rows: the pattern has but one word of each
    length."""
    if kept == 0:
        return START
    if total % 2:
        kept -= 1
    return SYSTEM if kept == 0 else (USER if kept % 2 else ASSISTANT)


def edited(audit: str, state: int, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """``role:text`` of the rows that an audit leaves, from the state before them. Only
    one of the roles that can be given leads on from any state."""
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        initial = role[:1]
        if edit != KEEP:
            initial = next(given for given in FREE if given in STEPS[state])
            role = FREE[initial]
        state = STEPS[state][initial]
        yield f"{role}:{text}"


# --- rows after damage -------------------------------------------------------

# What the remainder of a row's key does to it.
DROP, EMPTY, STRIP, REPEAT, AS_USER = range(5)
DAMAGE_OF = 20
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SENTENCE_ENDS = ".!?"


def _or_space(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows that are left, repeated ones twice."""
    key = F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn")))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _or_space(F.col("role")).alias("role"),
        _or_space(F.col("text")).alias("text"),
        (F.crc32(key) % DAMAGE_OF).alias("damage"),
    )
    text = (
        F.when(F.col("damage") == EMPTY, "")
        .when(F.col("damage") == STRIP, F.translate("text", SENTENCE_ENDS, ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("damage") == AS_USER, "user").otherwise(F.col("role"))
    copies = F.when(F.col("damage") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.filter(F.col("damage") != DROP)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return rows.drop("copy")


def _light(rows: DataFrame) -> DataFrame:
    """Rows with what the search needs to know of them in two characters, and a hash
    that stands for the text where texts are compared."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit(OTHER))
    fault = F.when(last == "", BLANK).when(last.isin(*SENTENCE_ENDS), FINE).otherwise(F.lit(TRUNCATED))
    return rows.select(
        "conv_id", "turn", "role", "text", F.sha2("text", 256).alias("text_key"), F.concat(known, fault).alias("sign")
    )


ORDER = ("turn", "role", "text_key")
RESULT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def repaired_hash(rows: Iterable[tuple[str, str]], audit: str) -> str:
    """Hash of the rows that an audit leaves, joined by line ends."""
    return hashlib.sha256("\n".join(edited(audit, START, iter(rows))).encode()).hexdigest()


def illegal_pairs(initials: Iterable[str]) -> int:
    initials = list(initials)
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _repaired(rows: list[tuple]) -> tuple:
    """All of a result row but its id, from (turn, role, text, text_key, sign) in order."""
    seen, signature = set(), []
    for _, role, _, text_key, sign in rows:
        if sign[1] != BLANK:
            if (role, text_key) in seen:
                sign = sign[0] + DUPLICATE
            seen.add((role, text_key))
        signature.append(sign)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0
    faults = [s[1] for s in signature]
    cost, audit = repair("".join(signature))
    return (
        gaps,
        faults.count(BLANK),
        faults.count(DUPLICATE),
        faults.count(TRUNCATED),
        illegal_pairs(s[0] for s in signature),
        cost,
        audit,
        repaired_hash(((r[1], r[2]) for r in rows), audit),
    )


_NO_ROWS = object()


def _stream(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Result rows of sorted rows; a conversation may go on in the next batch."""
    held: object = _NO_ROWS
    rows: list[tuple] = []
    for batch in batches:
        out = []
        columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
        for conv_id, *row in zip(*columns):
            if conv_id != held or held is _NO_ROWS:
                if rows:
                    out.append((held, *_repaired(rows)))
                held, rows = conv_id, []
            rows.append(tuple(row))
        if out:
            yield _batch(out, schema)
    if rows:
        yield _batch([(held, *_repaired(rows))], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _result_schema(id_type: pa.DataType) -> pa.Schema:
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    fields = [("conv_id", id_type), *((n, pa.int64()) for n in names)]
    return pa.schema([*fields, ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _short(rows: DataFrame) -> DataFrame:
    """Results of conversations that fit a task."""
    id_type = rows.schema["conv_id"].dataType
    ordered = rows.select("conv_id", "turn", "role", "text", "text_key", "sign")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = _result_schema(batch.schema.field("conv_id").type)
            yield from _stream(_with(batch, batches), schema)

    return ordered.mapInArrow(run, RESULT.format(id=id_type.simpleString()))


def _with(first: pa.RecordBatch, more: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from more


# --- long conversations ------------------------------------------------------

ARC = pa.struct([("source", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
BLOCK = (
    "conv_id {id}, part long, n long, illegal long, first string, last string, "
    "arcs array<struct<source:int,target:int,cost:long,audit:string>>"
)
CHOSEN = "conv_id {id}, part long, state int, piece string, cost long, illegal long, audit string"


def _searched_block(key: tuple, rows: pa.Table) -> pa.Table:
    """What a block costs between every pair of states, and the pairs within it."""
    signs = rows.sort_by("place").column("sign").to_pylist()
    lattice, arcs = Rows("".join(signs)), []
    for source in STATES:
        for target in STATES:
            way = search(lattice, source, [target])
            if way:
                arcs.append({"source": source, "target": target, "cost": way[0], "audit": way[1]})
    return pa.table(
        {
            "conv_id": pa.array([key[0].as_py()], rows.schema.field("conv_id").type),
            "part": pa.array([key[1].as_py()], pa.int64()),
            "n": pa.array([len(signs)], pa.int64()),
            "illegal": pa.array([illegal_pairs(s[0] for s in signs)], pa.int64()),
            "first": pa.array([signs[0][0]], pa.string()),
            "last": pa.array([signs[-1][0]], pa.string()),
            "arcs": pa.array([arcs], pa.list_(ARC)),
        }
    )


def pieces(audit: str, sizes: list[int]) -> Iterator[tuple[int, str]]:
    """(state before it, edits) of each block of ``sizes`` rows; inserted rows between
    two blocks go to the later one, those behind the last row to the last."""
    total, kept, at = sum(edit != DELETE for edit in audit), 0, 0
    for i, size in enumerate(sizes):
        end, left = at, size
        while left:
            left -= audit[end] != INSERT
            end += 1
        piece = audit[at:] if i == len(sizes) - 1 else audit[at:end]
        yield state_after(kept, total), piece
        kept += sum(edit != DELETE for edit in piece)
        at = end


def _through_blocks(_: tuple, blocks: pa.Table) -> pa.Table:
    """The least way through a conversation's blocks, as a piece for each of them; what
    holds for the whole way stands with the first."""
    blocks = blocks.sort_by("part")
    lattice = Blocks(
        [
            {(a["source"], a["target"]): (a["cost"], a["audit"]) for a in arcs}
            for arcs in blocks.column("arcs").to_pylist()
        ]
    )
    cost, audit = search(lattice)
    found = list(pieces(audit, blocks.column("n").to_pylist()))
    borders = zip(blocks.column("last").to_pylist(), blocks.column("first").to_pylist()[1:])
    illegal = sum(blocks.column("illegal").to_pylist()) + sum(a + b not in LEGAL for a, b in borders)
    rest = [None] * (blocks.num_rows - 1)
    return pa.table(
        {
            "conv_id": blocks.column("conv_id"),
            "part": blocks.column("part"),
            "state": pa.array([state for state, _ in found], pa.int32()),
            "piece": pa.array([piece for _, piece in found], pa.string()),
            "cost": pa.array([cost, *rest], pa.int64()),
            "illegal": pa.array([illegal, *rest], pa.int64()),
            "audit": pa.array([audit, *rest], pa.string()),
        }
    )


class _Hashing:
    """Hash of one long conversation, whose rows come in order, each block's piece of
    the audit before its rows."""

    def __init__(self):
        self.digest, self.piece, self.state, self.first = hashlib.sha256(), "", START, True

    def block(self, state: int, piece: str) -> None:
        self.flush()
        self.state, self.piece = state, piece

    def _add(self, edits: str, rows: Iterator) -> None:
        for line in edited(edits, self.state, rows):
            self.digest.update(line.encode() if self.first else b"\n" + line.encode())
            self.first = False

    def row(self, role: str, text: str) -> None:
        inserted = len(self.piece) - len(self.piece.lstrip(INSERT))
        edits, self.piece = self.piece[: inserted + 1], self.piece[inserted + 1 :]
        self._add(edits, iter([(role, text)]))
        for edit in edits:
            if edit in (REROLE, INSERT):
                self.state = next(STEPS[self.state][g] for g in FREE if g in STEPS[self.state])
            elif edit == KEEP:
                self.state = STEPS[self.state][role[:1]]

    def flush(self) -> None:
        """Rows that are inserted behind the last one."""
        self._add(self.piece, iter(()))
        self.piece = ""


def _hashed_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: object = _NO_ROWS
    now = _Hashing()
    schema = None

    def result() -> pa.RecordBatch:
        now.flush()
        return _batch([(held, now.digest.hexdigest())], schema)

    for batch in batches:
        schema = pa.schema([batch.schema.field("conv_id"), ("repaired_sha256", pa.string())])
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "state", "piece", "role", "text"))
        for conv_id, state, piece, role, text in zip(*columns):
            if conv_id != held or held is _NO_ROWS:
                if held is not _NO_ROWS:
                    yield result()
                held, now = conv_id, _Hashing()
            if piece is not None:
                now.block(state, piece)
            else:
                now.row(role, text)
    if held is not _NO_ROWS:
        yield result()


def _long(rows: DataFrame, block_rows: int) -> DataFrame:
    """Results of conversations that no task may hold."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    ranged = rows.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    # Ids of this kind ascend within a partition, and from one partition to the next.
    placed = ranged.withColumn("place", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("part", F.floor(F.col("place") / block_rows)), "long-rows")
    # The place is a key that no two rows share, however often a text comes.
    visible = F.substring("sign", 2, 1) != BLANK
    firsts = placed.filter(visible).groupBy("conv_id", "role", "text_key").agg(F.min("place").alias("place"))
    firsts = firsts.select("place", F.lit(True).alias("new"))
    light = placed.select("conv_id", "turn", "place", "part", "sign").join(firsts, "place", "left")
    again = F.concat(F.substring("sign", 1, 1), F.lit(DUPLICATE))
    sign = F.when(visible & F.col("new").isNull(), again).otherwise(F.col("sign"))
    light = stored(light.withColumn("sign", sign), "long-signs")
    blocks = light.select("conv_id", "part", "place", "sign").groupBy("conv_id", "part")
    blocks = stored(blocks.applyInArrow(_searched_block, BLOCK.format(id=id_type)), "long-blocks")
    # One row for each block.
    chosen = stored(blocks.groupBy("conv_id").applyInArrow(_through_blocks, CHOSEN.format(id=id_type)), "long-ways")
    fault = F.substring("sign", 2, 1)
    counts = light.groupBy("conv_id").agg(
        *(F.count_if(fault == f).alias(n) for n, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)))
    )
    turns = light.filter("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id")
    turns = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    texts = placed.select(
        "conv_id", "place", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("piece"), "role", "text"
    )
    none = F.lit(None).cast("string")
    heads = chosen.select(
        "conv_id", (F.col("part") * block_rows).alias("place"), "state", "piece", none.alias("role"), none.alias("text")
    )
    # A block's piece comes before its rows, also where the first one has its place.
    stream = heads.union(texts).repartition("conv_id")
    stream = stream.sortWithinPartitions("conv_id", "place", F.col("piece").isNull())
    hashed = stream.mapInArrow(_hashed_stream, f"conv_id {id_type}, repaired_sha256 string")
    found = chosen.filter("cost is not null").select("conv_id", "cost", "illegal", "audit")
    for more in (counts, turns, hashed):
        more = more.withColumnRenamed("conv_id", "same_id")
        found = found.join(more, F.col("conv_id").eqNullSafe(F.col("same_id")), "left").drop("same_id")
    return found.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def repaired_conversations(
    conversations: DataFrame, long_rows: int = LONG_ROWS, block_rows: int = LONG_ROWS
) -> DataFrame:
    """One row for every conversation id: its faults after damage, and its repair."""
    named = conversations.select("conv_id", "turn", "role", "text")
    key = F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn")))
    remainder = F.crc32(key) % DAMAGE_OF
    left = F.when(remainder == DROP, 0).when(remainder == REPEAT, 2).otherwise(1)
    sizes = stored(named.groupBy("conv_id").agg(F.sum(left).alias("n")), "sizes")
    total, most = sizes.agg(F.sum("n"), F.max("n")).first()
    limit = max(long_rows, (total or 0) // MOST_LONG)
    rows = _light(damaged(named))
    columns = [f.name for f in _result_schema(pa.int64())]
    empty = sizes.filter("n = 0").select(
        "conv_id", *(F.lit(v).cast("string" if isinstance(v, str) else "long").alias(c) for c, v in zip(columns[1:], NOTHING))
    )
    if (most or 0) <= limit:
        return _short(rows).union(empty)
    # At most MOST_LONG ids.
    long_ids = F.broadcast(sizes.filter(F.col("n") > limit).select(F.col("conv_id").alias("long_id")))
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short, long = rows.join(long_ids, same, "left_anti"), rows.join(long_ids, same, "left_semi")
    return _short(short).union(empty).union(_long(long, block_rows).select(*columns))
