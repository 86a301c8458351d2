"""Repair of conversation structure: the cheapest edits that make roles alternate, by tables over blocks of rows.

A conversation is a word of row symbols: the initial of the role, and whether the row is sound,
truncated, or blank or repeated. Edits keep a row (K, free), give it the role user or assistant
(R, 2), delete it (D, 3, the only way for blank and repeated rows) or insert an empty row of user or assistant
(I, 2); a truncated row that stays costs 1 more. The initials that result must read ``(s?(ua)+)?``.

The cost still to come from each of the four states of that pattern is a vector. Less its least entry it
takes few forms, since one state is a few edits away from another. So for every form and every
block of ``BLOCK`` symbols a table holds the form before the block and what the block adds (the method
of the Four Russians). A conversation is walked from its end, a lookup per block; then each block is
expanded backward, from the form at its right border, into its single rows, and traced
forward with the ASCII-least edit among those that stay cheapest. An edit fixes the next state, so this
gives the ASCII-least string of all cheapest ones.

Distribution: rows are numbered in the order of conversation, turn, role and text by ranges that cut
a long conversation too. Whether a role and text came before is found by a count per digest (SHA-256) and
conversation, without texts. The codes of rows are packed, a byte each, by equal pieces of the
numbering, so a conversation that holds a third of all rows is dealt over many tasks; only these
bytes, as long as the edit string itself, meet in one place. The texts then stream past the edits in
order, a batch in memory at a time, however long the conversation; a checksum of a whole
conversation is by its nature taken in one task.

Null roles and texts are one space, null turns come first, rows without conv_id are one conversation. Rows of
one turn are ordered by role and text; repeated rows are copies of each other. White space is space and tab to
carriage return. Texts may be empty or of any length, other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.arrays import bound_batches
from tallyframe.operators.ordering import row_position
from tallyframe.session import staged

#: Symbols per block of the tables, and rows per packed piece.
BLOCK, PIECE_ROWS = 4, 8192
RECODE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: States of the pattern: nothing yet, after s, after u, after a.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Where user or assistant, whichever fits, leads.
NEXT = (USER, USER, ASSISTANT, USER)
#: Where a kept row leads, by the kind of its initial: s, u, a, other.
KEPT = ({NONE: SYSTEM}, {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
#: Row codes are kind + 4 * fault; symbols are codes, with one for rows to delete and one for no row.
SOUND, CUT, BLANK, REPEATED = range(4)
LOST, PAD, SYMBOLS = 8, 9, 10

WHITE = " \t\n\x0b\x0c\r"
REPAIRED = "conv_id {id}, place long, edit string, role string, text string"
DIGESTS = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Costs to come, with rows inserted first where that is cheaper."""
    once = [min(c, INSERT + costs[NEXT[p]]) for p, c in enumerate(costs)]
    return tuple(min(c, INSERT + once[NEXT[p]]) for p, c in enumerate(once))


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """What can be done with a row, in ASCII order: edit, cost, next state."""
    if symbol == PAD:
        return [("", 0, state)]
    found = [("D", DELETE, state)]
    if symbol != LOST:
        extra, kept = TRUNCATED * (symbol // 4), KEPT[symbol % 4]
        if state in kept:
            found.append(("K", extra, kept[state]))
        found.append(("R", RECODE + extra, NEXT[state]))
    return found


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to come before a row, from those after it."""
    return _closed([min(c + costs[to] for _, c, to in _choices(symbol, state)) for state in range(4)])


FAR = 1 << 20
END = _closed([0, FAR, FAR, 0])


@cache
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """The forms of cost vectors, and per form and block the form before the block and the cost added.

    The last symbol of a block is the lowest digit of its number.
    """
    forms, known, steps = [END], {END: 0}, []
    while len(steps) < len(forms):
        costs, row = forms[len(steps)], []
        for symbol in range(SYMBOLS):
            found = _before(costs, symbol)
            least = min(found)
            form = tuple(c - least for c in found)
            if form not in known:
                known[form] = len(forms)
                forms.append(form)
            row.append((known[form], least))
        steps.append(row)
    one, add = np.array(steps, np.int64).transpose(2, 0, 1)
    to, cost = one, add
    for _ in range(BLOCK - 1):
        # one more symbol in front of every block so far
        to, cost = (
            np.concatenate([one[to, s] for s in range(SYMBOLS)], axis=1),
            np.concatenate([cost + add[to, s] for s in range(SYMBOLS)], axis=1),
        )
    return forms, to, cost


@lru_cache(maxsize=1 << 16)
def trace(block: int, form: int, state: int) -> tuple[str, int]:
    """The edits of one block with ``form`` at its right border, from ``state``, and the state after it."""
    symbols = [block // SYMBOLS**i % SYMBOLS for i in reversed(range(BLOCK))]
    costs = [tables()[0][form]]
    for symbol in reversed(symbols):
        costs.append(_before(costs[-1], symbol))
    costs.reverse()
    edits = []
    for i, symbol in enumerate(symbols):
        while True:
            found = [(edit, c + costs[i + 1][to], to, True) for edit, c, to in _choices(symbol, state)]
            if symbol != PAD:
                found.append(("I", INSERT + costs[i][NEXT[state]], NEXT[state], False))
            edit, _, state, done = next(f for f in sorted(found) if f[1] == costs[i][state])
            edits.append(edit)
            if done:
                break
    return "".join(edits), state


def cheapest_edits(codes: np.ndarray) -> tuple[int, str]:
    """Cost and ASCII-least edits of a conversation given by the codes of its rows."""
    symbols = np.minimum(codes, LOST).astype(np.int64)
    symbols = np.concatenate([np.full(-len(symbols) % BLOCK, PAD), symbols]).reshape(-1, BLOCK)
    blocks = (symbols @ SYMBOLS ** np.arange(BLOCK)[::-1]).tolist()
    forms, to, cost = tables()
    form, total, borders = 0, 0, []
    for block in reversed(blocks):
        borders.append(form)
        total += int(cost[form, block])
        form = int(to[form, block])
    total += forms[form][NONE]
    state, edits = NONE, []
    for block, border in zip(blocks, reversed(borders)):
        done, state = trace(block, border, state)
        edits.append(done)
    while state not in (NONE, ASSISTANT):
        edits.append("I")
        state = NEXT[state]
    return total, "".join(edits)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the faults that the checksum of id and turn asks for."""
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    faulty = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(named.cast("binary")) % 20).alias("fault"))
    fault = F.col("fault")
    return faulty.filter(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _pack(batch: pa.Table) -> pa.Table:
    """Rows (conv_id, position, code) of one piece as one row per conversation with its codes in order."""
    batch = batch.sort_by("position")
    ids = batch.column("conv_id").combine_chunks().dictionary_encode()
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    keys = ids.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    codes = batch.column("code").to_numpy().astype(np.uint8)
    return pa.table(
        {
            "conv_id": batch.column("conv_id").take(pa.array(cuts[:-1])),
            "position": batch.column("position").take(pa.array(cuts[:-1])),
            "codes": pa.array([codes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
        }
    )


def _stream(rows: DataFrame) -> DataFrame:
    """Per conversation, in one partition and in this order: a mark with its gaps, its packed codes, its rows."""
    spark = rows.sparkSession
    kind = rows.schema["conv_id"].dataType.simpleString()
    hurt = damaged(rows)
    order = ["conv_id", "turn", "role", "text"]
    # written once: everything below is by these positions
    placed = row_position(hurt, order, max(1, 2 * rows.count()))
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.position(F.left("role", F.lit(1)), F.lit(INITIALS))
    kinds = F.when((F.col("role") == "") | (initial == 0), len(INITIALS)).otherwise(initial - 1)
    seen = placed.select(
        "conv_id", "turn", "position", kinds.alias("kind"), (bare == "").alias("blank"), F.right(bare, F.lit(1)).rlike("[.!?]").alias("ended"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
    )
    seen = staged(seen, "turns")
    firsts = seen.groupBy("conv_id", "digest").agg(F.min("position").alias("position")).select("position", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), REPEATED).when(F.col("ended"), SOUND).otherwise(CUT)
    coded = seen.join(firsts, "position", "left").select(
        "conv_id", "position", (F.col("kind") + 4 * fault).cast("int").alias("code"), F.expr(f"position div {PIECE_ROWS}").alias("piece")
    )
    packed = coded.groupBy("piece").applyInArrow(_pack, f"conv_id {kind}, position long, codes binary")

    wide = F.col("turn").cast("decimal(38,0)")
    gaps = F.max(wide) - F.min(wide) + 1 - F.count_distinct("turn")
    spans = seen.groupBy("conv_id").agg(F.least(F.coalesce(gaps, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"))
    marks = rows.select("conv_id", F.lit(0).cast("long").alias("gaps")).unionByName(spans)
    none = {"codes": F.lit(None).cast("binary"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")}
    parts = [
        marks.groupBy("conv_id").agg(F.max("gaps").alias("position")).withColumns({"step": F.lit(0), **none}),
        packed.withColumns({"step": F.lit(1), "role": none["role"], "text": none["text"]}),
        placed.select("conv_id", "position", "role", "text").withColumns({"step": F.lit(2), "codes": none["codes"]}),
    ]
    parts = [p.select("conv_id", "step", "position", "codes", "role", "text") for p in parts]
    bound_batches(spark)
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).repartition("conv_id").sortWithinPartitions("conv_id", "step", "position")


class _Conversation:
    """The edits of one conversation, handed out as its rows pass."""

    def __init__(self, conv_id, gaps: int):
        self.conv_id, self.gaps, self.codes = conv_id, gaps, []
        self.edits, self.cost, self.at, self.state = None, 0, 0, NONE

    def _ready(self) -> None:
        if self.edits is None:
            codes = np.frombuffer(b"".join(self.codes), np.uint8)
            self.codes, (self.cost, self.edits) = codes, cheapest_edits(codes)

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """Rows inserted at this place: edit, role, text."""
        self._ready()
        while self.edits[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield "I", ROLE[self.state], ""

    def passed(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What comes of the next row, inserted rows before it included."""
        yield from self.inserted()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit == "K":
            self.state = KEPT[INITIALS.find(role[:1])][self.state]
        elif edit == "R":
            self.state = NEXT[self.state]
            role = ROLE[self.state]
        if edit != "D":
            yield edit, role, text

    def counts(self) -> list[int]:
        """gaps, blank, duplicate, truncated, illegal, cost."""
        self._ready()
        faults, kinds = self.codes // 4, self.codes % 4
        pairs = kinds[:-1].astype(int) * 4 + kinds[1:]
        legal = np.isin(pairs, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
        return [self.gaps, *(int((faults == f).sum()) for f in (BLANK, REPEATED, CUT)), int((~legal).sum()), self.cost]


def _conversations(batches: Iterator[pa.RecordBatch], rows_of, end_of) -> Iterator[list[tuple]]:
    """Batches of what ``rows_of`` and ``end_of`` say about the passing rows and the ended conversations."""
    now = None
    for batch in batches:
        out: list[tuple] = []
        for conv_id, step, position, codes, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if step == 0:
                if now is not None:
                    out += end_of(now)
                now = _Conversation(conv_id, position)
            elif step == 1:
                now.codes.append(codes)
            else:
                out += rows_of(now, now.passed(role, text))
        yield out
    if now is not None:
        yield end_of(now)


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema(conv_id: pa.DataType, names: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([("conv_id", conv_id), *names])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    places: dict[str, int] = {}

    def rows_of(now: _Conversation, rows: Iterator[tuple[str, str, str]]) -> list[tuple]:
        found = []
        for row in rows:
            places["now"] = places.get("now", 0) + 1
            found.append((now.conv_id, places["now"], *row))
        return found

    def end_of(now: _Conversation) -> list[tuple]:
        found = rows_of(now, now.inserted())
        places.clear()
        return found

    first = next(batches, None)
    if first is not None:
        schema = _schema(first.column(0).type, names)
        for rows in _conversations(_again(first, batches), rows_of, end_of):
            yield _as_batch(rows, schema)


def _again(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    names += [("audit", pa.string()), ("repaired_sha256", pa.string())]
    sums: list = []

    def rows_of(now: _Conversation, rows: Iterator[tuple[str, str, str]]) -> list[tuple]:
        for _, role, text in rows:
            if sums:
                sums[0].update(b"\n")
            else:
                sums.append(hashlib.sha256())
            sums[0].update(f"{role}:{text}".encode())
        return []

    def end_of(now: _Conversation) -> list[tuple]:
        rows_of(now, now.inserted())
        digest = (sums or [hashlib.sha256()])[0].hexdigest()
        sums.clear()
        return [(now.conv_id, *now.counts(), now.edits, digest)]

    first = next(batches, None)
    if first is not None:
        schema = _schema(first.column(0).type, names)
        for rows in _conversations(_again(first, batches), rows_of, end_of):
            yield _as_batch(rows, schema)


def _id_type(conversations: DataFrame) -> str:
    return conversations.schema["conv_id"].dataType.simpleString()


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows of the damaged conversations: conv_id, place from 1, edit (K, R or I), role, text."""
    return _stream(conversations).mapInArrow(_repaired, REPAIRED.format(id=_id_type(conversations)))


def repair_query(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and edits of its repair and the checksum of the result."""
    return _stream(conversations).mapInArrow(_digested, DIGESTS.format(id=_id_type(conversations)))
