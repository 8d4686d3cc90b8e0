"""Repairing the turns of conversations: faults, cheapest edits by branch and bound, repaired turns."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import map_arrow, stage
from curbflow.operators import lookup_join

SPAN = 64
PART_ROWS = 200_000
KNOWN_SHAPES = 100_000

# White space, sentence ends, prices of the edits and the roles they can give.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
RENAME, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
LEGAL_PAIRS = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

# What stands before: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDINGS = (START, ASSISTANT)
NEXT = ("u", "u", "a", "u")  # role that an edit can give in each state
AFTER = {"u": USER, "a": ASSISTANT}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}

# A row's shape in one byte: its initial, whether it is cut short, whether it has to go.
_INITIALS = "sua?"
_CUT, _GONE = 4, 8


def shape(initial: str, cut_short: bool, gone: bool) -> int:
    return (_INITIALS.index(initial) if initial in "sua" and initial else 3) | (_CUT if cut_short else 0) | (_GONE if gone else 0)


def least_cost(code: int) -> int:
    """What a row costs at least, whatever stands before it."""
    if code & _GONE:
        return DELETE
    cut = CUT_SHORT if code & _CUT else 0
    return min(DELETE, cut + (RENAME if code & 3 == 3 else 0))


Best = dict[int, tuple[int, str]]


def search(shapes: bytes, seeds: Best, final: bool) -> Best:
    """The cheapest edits of some rows per state reached, of equal cost the least text; depth first with bounds.

    ``seeds`` gives the states before the rows, each with the cost and edits that led to it. With ``final``
    only the best of the states a conversation may end in is returned. Nodes lie on an explicit stack, the most
    promising on top. A node is left alone if its table entry holds a cheaper prefix, or one of equal cost and lesser text
    (prefixes of one node and cost never begin one another, so the lesser prefix wins with any continuation), or if its cost
    plus the least cost of the rows left, an incumbent at hand, can't win. When the stack is empty the incumbents are optimal.
    """
    n = len(shapes)
    bound = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + least_cost(shapes[i])
    table: dict[int, tuple[int, str]] = {}
    incumbents: Best = {}
    slots = 1 if final else 4
    stack = []
    for state, (cost, edits) in sorted(seeds.items(), key=lambda s: s[1], reverse=True):
        table[state] = (cost, edits)
        stack.append((0, state, cost, edits))
    while stack:
        i, state, cost, edits = stack.pop()
        if table[4 * i + state] != (cost, edits):
            continue  # a better prefix has come since
        if len(incumbents) == slots:
            hope = cost + bound[i]
            for own_cost, own_edits in incumbents.values():
                if hope < own_cost or hope == own_cost and edits <= own_edits[: len(edits)]:
                    break
            else:
                continue
        children = [(i, AFTER[NEXT[state]], cost + INSERT, edits + "I")]
        if i < n:
            code = shapes[i]
            children.append((i + 1, state, cost + DELETE, edits + "D"))
            if not code & _GONE:
                own = cost + (CUT_SHORT if code & _CUT else 0)
                initial = _INITIALS[code & 3]
                if (state, initial) in KEPT:
                    children.append((i + 1, KEPT[state, initial], own, edits + "K"))
                if initial != NEXT[state]:  # to the role it has: dearer than to keep it
                    children.append((i + 1, AFTER[NEXT[state]], own + RENAME, edits + "R"))
        elif not final or state in ENDINGS:
            slot = 0 if final else state
            if slot not in incumbents or (cost, edits) < incumbents[slot]:
                incumbents[slot] = (cost, edits)
        fresh = []
        for child in children:
            node, value = 4 * child[0] + child[1], child[2:]
            known = table.get(node)
            if known is None or value < known:
                table[node] = value
                fresh.append(child)
        fresh.sort(key=lambda c: (c[2] + bound[c[0]], -c[0], c[3]), reverse=True)
        stack.extend(fresh)
    return incumbents


class Repair:
    """Edits of a sequence of rows that comes in spans; holds no more than the states between two spans."""

    def __init__(self, entry: int = START):
        self.states: Best = {entry: (0, "")}
        self.settled: list[str] = []

    def _settle(self) -> None:
        """Move what all states' edits begin with to the side: order among them doesn't change."""
        shared = os.path.commonprefix([edits for _, edits in self.states.values()])
        if shared:
            self.settled.append(shared)
            self.states = {s: (cost, edits[len(shared) :]) for s, (cost, edits) in self.states.items()}

    def pass_over(self, shapes: bytes) -> None:
        for at in range(0, len(shapes), SPAN):
            self.states = search(shapes[at : at + SPAN], self.states, final=False)
            self._settle()

    def exits(self) -> Best:
        before = "".join(self.settled)
        return {state: (cost, before + edits) for state, (cost, edits) in self.states.items()}

    def finish(self, shapes: bytes = b"") -> tuple[int, str]:
        last = (len(shapes) - 1) // SPAN * SPAN if shapes else 0
        self.pass_over(shapes[:last])
        cost, edits = search(shapes[last:], self.states, final=True)[0]
        return cost, "".join(self.settled) + edits


_KNOWN: dict[bytes, tuple[int, str]] = {}


def repair_shapes(shapes: bytes) -> tuple[int, str]:
    """(cost, edits) of a whole conversation; those of short ones are remembered."""
    if len(shapes) > SPAN:
        return Repair().finish(shapes)
    if shapes not in _KNOWN:
        if len(_KNOWN) >= KNOWN_SHAPES:
            _KNOWN.clear()
        _KNOWN[shapes] = Repair().finish(shapes)
    return _KNOWN[shapes]


# --- rows --------------------------------------------------------------


def conversation_key(conv_id: Column) -> Column:
    """A key that is never null: the id as text behind a mark, or nothing."""
    return F.coalesce(F.concat(F.lit("c"), conv_id.cast("string")), F.lit(""))


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    blank = F.lit(" ")
    own = F.coalesce(F.col(text).cast("string"), blank)
    return rows.select(
        conversation_key(F.col(conv)).alias("key"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role).cast("string"), blank).alias("role"),
        own.alias("text"), F.unhex(F.md5(own)).alias("digest"),
    )


def _order() -> list[Column]:
    return [F.col("key").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def _slim(turns: DataFrame) -> DataFrame:
    """One row per (key, turn, role, text) with its number ``n``, its faults and whether the text came in an earlier turn.

    Equal rows are counted before the shuffle. The first turn of a text that comes in several is looked up,
    with frequent texts spread, so that a conversation of any length needs no task of its own here.
    """
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    counted = stage(
        turns.groupBy(
            "key", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), (stripped == "").alias("blank"),
            (~F.right(stripped, F.lit(1)).isin(*ENDS)).alias("cut_short"),
        ).agg(F.count(F.lit(1)).alias("n")), "repair-rows",
    )
    place = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    firsts = counted.groupBy("key", "role", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = stage(firsts.where("first <> last").drop("last"), "repair-again")
    found = lookup_join(counted, again, ["key", "role", "digest"])
    return found.select(*counted.columns, F.coalesce(place != F.col("first"), F.lit(False)).alias("seen"))


_PIECE = [
    ("key", pa.string()), ("part", pa.int32()), ("whole", pa.bool_()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("turns", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string())),
]
_PIECE_SQL = (
    "key string, part int, whole boolean, first_turn long, last_turn long, turns long, first_initial string, last_initial string, "
    "blank long, duplicate long, truncated long, illegal long, costs array<long>, edits array<string>"
)


class _Piece:
    """The rows of a conversation that lie in one partition."""

    def __init__(self, key: str, part: int, opens: bool):
        self.key, self.part, self.opens = key, part, opens
        self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = ""
        self.started = False
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.shapes = bytearray()
        self.repairs: list[Repair] | None = None

    def add(self, turn: int | None, initial: str, blank: bool, cut_short: bool, seen: bool, n: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        if self.started and self.last_initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.illegal += n - 1
        if not self.started:
            self.first_initial, self.started = initial, True
        self.last_initial = initial
        if blank:
            self.blank += n
        else:
            self.duplicate += n - 1 + seen
            self.truncated += not seen and cut_short
        self.shapes.append(shape(initial, cut_short and not blank, blank or seen))
        while n > 1:
            step = min(n - 1, SPAN)
            self.shapes += bytes([shape(initial, False, True)]) * step
            n -= step
            self._pass_over()
        self._pass_over()

    def _pass_over(self) -> None:
        if len(self.shapes) > 16 * SPAN:
            if self.repairs is None:
                self.repairs = [Repair(e) for e in ((START,) if self.opens else range(4))]
            for repair in self.repairs:
                repair.pass_over(bytes(self.shapes[: 16 * SPAN]))
            del self.shapes[: 16 * SPAN]

    def row(self, closes: bool) -> tuple:
        """``closes``: the conversation ends here. Costs and edits go by entry and exit state, or are those of the whole."""
        shapes = bytes(self.shapes)
        if self.opens and closes:
            cost, edits = self.repairs[0].finish(shapes) if self.repairs else repair_shapes(shapes)
            costs, texts = [cost], [edits]
        else:
            costs, texts = [None] * 16, [None] * 16
            entries = (START,) if self.opens else range(4)
            for entry, repair in zip(entries, self.repairs or [Repair(e) for e in entries]):
                repair.pass_over(shapes)
                for state, (cost, edits) in repair.exits().items():
                    costs[4 * entry + state], texts[4 * entry + state] = cost, edits
        return (
            self.key, self.part, self.opens and closes, self.first_turn, self.last_turn, self.turns, self.first_initial, self.last_initial,
            self.blank, self.duplicate, self.truncated, self.illegal, costs, texts,
        )


def _batch(rows: list[tuple], columns: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), columns)], names=[n for n, _ in columns])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation to one piece each; only the first and last of a partition may go on elsewhere."""
    part = TaskContext.get().partitionId()
    names = ("key", "turn", "initial", "blank", "cut_short", "seen", "n")
    piece, out, held, count = None, [], 0, 0
    for batch in batches:
        for key, *row in zip(*(batch.column(c).to_pylist() for c in names)):
            if piece is None or piece.key != key:
                if piece is not None:
                    out.append(piece.row(closes=True))
                    held += 64 + sum(len(e or "") for e in out[-1][-1])
                count += 1
                piece = _Piece(key, part, opens=count > 1)
            piece.add(*row)
        if held > 4 << 20 or len(out) >= 20_000:
            yield _batch(out, _PIECE)
            out, held = [], 0
    if piece is not None:
        out.append(piece.row(closes=False))
    if out:
        yield _batch(out, _PIECE)


_PLAN = [
    ("key", pa.string()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
]
_PLAN_SQL = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Joined:
    """Pieces of a conversation, in order, to its plan."""

    def __init__(self, key: str):
        self.key = key
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last_initial: str | None = None
        self.repair = Repair()

    def add(self, p: dict) -> None:
        self.turns += p["turns"] - (self.last_turn is not None and self.last_turn == p["first_turn"])
        self.first_turn = p["first_turn"] if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if p["last_turn"] is None else p["last_turn"]
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + p[name])
        if self.last_initial is not None and self.last_initial + p["first_initial"] not in LEGAL_PAIRS:
            self.illegal += 1
        self.last_initial = p["last_initial"]
        states: Best = {}
        for entry, (cost, edits) in self.repair.states.items():
            for state in range(4):
                own = p["costs"][4 * entry + state]
                if own is not None:
                    value = (cost + own, edits + p["edits"][4 * entry + state])
                    if state not in states or value < states[state]:
                        states[state] = value
        self.repair.states = states
        self.repair._settle()

    def row(self) -> tuple:
        cost, edits = self.repair.finish()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, edits)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and partition to one plan for each conversation."""
    current = None
    for batch in batches:
        for at in range(0, batch.num_rows, 8):  # the edits of a few pieces at a time
            out = []
            for piece in batch.slice(at, 8).to_pylist():
                if current is None or current.key != piece["key"]:
                    if current is not None:
                        out.append(current.row())
                    current = _Joined(piece["key"])
                current.add(piece)
            if out:
                yield _batch(out, _PLAN)
    if current is not None:
        yield _batch([current.row()], _PLAN)


def repair_plans(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_rows: int = PART_ROWS
) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation in ``rows``.

    ``key`` is :func:`conversation_key` of the id. Rows are taken by turn, null turns first, then role and checksum of the text.
    A row's first fault counts: blank (nothing but white space), duplicate (its role and text came before), truncated (no
    sentence end last). ``gaps`` are turns that lack between the least and the greatest, ``illegal`` neighbours whose initials
    are not su, ua or au. ``audit`` has the initials of the cheapest edits that make the initials of the roles
    `(s?(ua)+)?`, the least text of equally cheap ones: Keep 0, Rerole to user or assistant 2, Delete 3 (must for blank and duplicate
    rows), Insert an empty user or assistant turn 2; a truncated row that stays costs 1.

    Rows without texts are dealt by ranges of (conversation, turn, role, checksum), so a conversation of any length spreads over
    tasks. A task solves the conversations that lie wholly in its range; of its first and last it gives the best edits
    for each pair of states at entry and exit, and those few pieces are joined by conversation.

    A null role, text, conversation or turn: the first two count as one space, rows without a conversation id form one, turns
    without a number come first. Repeated rows are duplicates. An empty table gives no rows; further columns are ignored.
    """
    slim = stage(_slim(_turns(rows, conv, turn, role, text)), "repair-slim")
    shuffles = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffles, -(-slim.count() // part_rows))
    dealt = slim.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
    pieces = stage(map_arrow(dealt.select("key", "turn", "initial", "blank", "cut_short", "seen", "n"), _pieces, _PIECE_SQL), "repair-pieces")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).cast("bigint").alias("gaps")
    whole = pieces.where("whole").select(
        "key", gaps, "blank", "duplicate", "truncated", "illegal", F.col("costs")[0].alias("cost"), F.col("edits")[0].alias("audit")
    )
    cut = pieces.where("not whole").repartition(shuffles, "key").sortWithinPartitions("key", "part")
    return whole.unionByName(map_arrow(cut, _joined, _PLAN_SQL))


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, place, role, text, edit) of every turn that a plan leaves or adds, and (key, None, ...) behind the last of each."""
    key, audit, at, state, place = None, "", 0, START, 0

    def added() -> Iterator[tuple]:
        nonlocal at, state, place
        while at < len(audit) and audit[at] == "I":
            role = NEXT[state]
            yield key, place, ROLES[role], "", "I"
            at, state, place = at + 1, AFTER[role], place + 1

    for batch in batches:
        for own_key, kind, role, text, plan in zip(*(batch.column(c).to_pylist() for c in ("key", "kind", "role", "text", "audit"))):
            if kind == 0:
                if key is not None:
                    yield from added()
                    yield key, None, "", "", ""
                key, audit, at, state, place = own_key, plan, 0, START, 0
                continue
            yield from added()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role, state = ROLES[NEXT[state]], AFTER[NEXT[state]]
            else:
                state = KEPT[state, role[:1]]
            yield key, place, role, text, edit
            place += 1
    if key is not None:
        yield from added()
        yield key, None, "", "", ""


def _dealt(rows: DataFrame, plans: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """Plans and turns of a conversation in one partition, the plan first, the turns in order."""
    none = lambda kind: F.lit(None).cast(kind)
    turns = _turns(rows, *names).select("key", F.lit(1).alias("kind"), "turn", "role", "digest", "text", none("string").alias("audit"))
    heads = plans.select(
        "key", F.lit(0).alias("kind"), none("bigint").alias("turn"), none("string").alias("role"), none("binary").alias("digest"),
        none("string").alias("text"), "audit",
    )
    order = ["key", "kind", F.col("turn").asc_nulls_first(), "role", "digest"]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return heads.unionByName(turns).repartition(partitions, "key").sortWithinPartitions(*order).select("key", "kind", "role", "text", "audit")


def _flushed(rows: Iterator[tuple], columns: list[tuple[str, pa.DataType]], width: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += 64 + width(row)
        if held > 8 << 20:
            yield _batch(out, columns)
            out, held = [], 0
    if out:
        yield _batch(out, columns)


def repaired_turns(rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, place, role, text, edit) of the repaired conversations, ``place`` from 0, by the plans of :func:`repair_plans`.

    Turns stream through the task of their conversation; none is held beyond its batch.
    """
    columns = [("key", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]

    def over(batches):
        yield from _flushed((e for e in _events(batches) if e[1] is not None), columns, lambda e: len(e[3]))

    return map_arrow(_dealt(rows, plans, (conv, turn, role, text)), over, "key string, place long, role string, text string, edit string")


def repaired_digests(rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, repaired_sha256): SHA-256 of the repaired `role:text`, joined by line ends.

    The digest of one conversation can only be taken in order, so its turns stream through one task, unheld.
    """
    def over(batches):
        def digests():
            own = hashlib.sha256()
            for key, place, role_, text_, _ in _events(batches):
                if place is None:
                    yield key, own.hexdigest()
                    own = hashlib.sha256()
                else:
                    own.update((("\n" if place else "") + f"{role_}:{text_}").encode("utf-8", "surrogatepass"))

        yield from _flushed(digests(), [("key", pa.string()), ("repaired_sha256", pa.string())], lambda row: 64)

    return map_arrow(_dealt(rows, plans, (conv, turn, role, text)), over, "key string, repaired_sha256 string")


def damage_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults set on purpose, by crc32 of `conversation:turn` modulo 20 (a null counts as one space).

    0 drops the row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part(conv), F.lit(":"), part(turn)).cast("binary")) % 20
    changed = F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(conv, turn, role, text, fault.alias("_fault")).where("_fault <> 0").select(
        conv, turn, F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col(role)).alias(role), changed.alias(text),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def repair_conversations(original: DataFrame, damaged: DataFrame, conv: str = "conv_id", **names: str) -> DataFrame:
    """One row per conversation of ``original``: the plan for its rows in ``damaged`` and the digest of what it leaves.

    A conversation without rows left has zeros, no edits and the digest of nothing.
    """
    plans = stage(repair_plans(damaged, conv, **names), "repair-plans")
    digests = repaired_digests(damaged, plans, conv, **names)
    ids = original.select(conv).distinct().withColumn("_key", conversation_key(F.col(conv)))
    found = ids.join(plans.withColumnRenamed("key", "_key"), "_key", "left").join(digests.withColumnRenamed("key", "_key"), "_key", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        conv, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
