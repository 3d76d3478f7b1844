"""Repair of conversation structure by weighted interval parsing.

A conversation's role initials should read ``(s?(ua)+)?``. The grammar has one nonterminal
``[p, q]`` for each pair of states of that pattern (0 nothing yet, 1 after s, 2 after u, 3
after a) and is in Chomsky normal form: ``[p, q] -> [p, r] [r, q]`` for every ``r``, and
terminal rules for the edits of one turn. Inserted turns are unary chains; their closure is
folded into each cell. A cell of the chart holds, for one span of turns and one nonterminal,
the least pair (cost, audit), the audit being the edits' initials in order.

Least pairs may be combined: two audits of one span with equal cost never begin with each
other, because they cover the same turns and an insertion costs something, so the order of
two audits stays when others are put before or after them. And since every derivation can
be cut at every turn, one division of a span gives its exact cells: the chart needs the
spans of lengths 1, 2, 4, ... that halving gives, not all of them. Spark builds the chart bottom-up:
spans of up to ``SPAN`` turns in a task, then ``FAN`` neighbouring spans at a time until a
conversation is one span. No task holds a conversation's rows, only its cells.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import materialize
from textquarry.operators.ordering import numbered
from textquarry.operators.skew import lookup_by_frequency

SPAN = 256
FAN = 64

STATES = 4
FINAL = (0, 3)
BY_ROLE = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
INITIALS = "sua"
FAULTS = ("fine", "blank", "duplicate", "truncated")
ROLES = {2: "user", 3: "assistant"}
_SPACE = " \t\n\x0b\x0c\r"

# Cells of a span: the least (cost, audit) of [p, q] at p * STATES + q, or None.
Cells = tuple


def _least(pairs: list[tuple[int, tuple[int, str]]]) -> Cells:
    cells: list = [None] * (STATES * STATES)
    for at, value in pairs:
        if cells[at] is None or value < cells[at]:
            cells[at] = value
    return tuple(cells)


def joined(left: Cells, right: Cells) -> Cells:
    """The binary rules: the cells of two neighbouring spans taken together."""
    pairs = []
    for p in range(STATES):
        for r in range(STATES):
            a = left[p * STATES + r]
            if a is None:
                continue
            for q in range(STATES):
                b = right[r * STATES + q]
                if b is not None:
                    pairs.append((p * STATES + q, (a[0] + b[0], a[1] + b[1])))
    return _least(pairs)


def _insertions() -> Cells:
    """The closure of inserted turns: the cells of a span without turns."""
    cells = _least([(p * STATES + p, (0, "")) for p in range(STATES)])
    one = _least([(p * STATES + q, (INSERT, "I")) for role in "ua" for p, q in BY_ROLE[role].items()])
    while True:
        longer = joined(cells, one)
        wider = _least([(i, c) for both in (cells, longer) for i, c in enumerate(both) if c is not None])
        if wider == cells:
            return cells
        cells = wider


EMPTY = _insertions()


@lru_cache(maxsize=None)
def turn_cells(initial: str, fault: str) -> Cells:
    """The terminal rules of one turn, with insertions before and after it."""
    pairs = [(p * STATES + p, (DELETE, "D")) for p in range(STATES)]
    if fault in ("fine", "truncated"):
        more = TRUNCATED if fault == "truncated" else 0
        pairs += [(p * STATES + q, (KEEP + more, "K")) for p, q in BY_ROLE.get(initial, {}).items()]
        pairs += [(p * STATES + q, (REROLE + more, "R")) for role in "ua" for p, q in BY_ROLE[role].items()]
    return joined(joined(EMPTY, _least(pairs)), EMPTY)


def halved(spans: list[Cells]) -> Cells:
    """One span from neighbouring ones: pairs of spans, then pairs of those, and so on."""
    while len(spans) > 1:
        spans = [joined(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0] if spans else EMPTY


def cheapest(cells: Cells) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    return min(cells[q] for q in FINAL if cells[q] is not None)


# A turn as one letter: its role's initial (s, u, a, other) and its fault.
_LETTERS = {chr(65 + 4 * i + k): (("sua?")[i], fault) for i in range(4) for k, fault in enumerate(FAULTS)}


@lru_cache(maxsize=4096)
def _of_letters(letters: str) -> Cells:
    return halved([turn_cells(*_LETTERS[x]) for x in letters])


def _key(column: str) -> Column:
    """A conversation's id as a text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _turns(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """``_c, conv_id, turn, role, text, h1, h2``; a NULL role or text is one space."""
    space = F.lit(" ")
    return rows.select(
        _key(names["conv_id"]).alias("_c"),
        F.col(names["conv_id"]).alias("conv_id"),
        F.col(names["turn"]).alias("turn"),
        F.coalesce(F.col(names["role"]).cast("string"), space).alias("role"),
        F.coalesce(F.col(names["text"]).cast("string"), space).alias("text"),
    ).withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(42), "text")})


# The order of turns. Turns of one number follow each other by role, then by their text's hash.
_ORDER = ["turn", "role", "h1", "h2"]
_STANDARD = {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"}


def _letters(rows: DataFrame) -> DataFrame:
    """``_c, pos, letter``: every turn by its place in its conversation (from 0), without its text."""
    last = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
    blank, whole = last == "", last.isin(".", "!", "?")
    groups = materialize(
        rows.select("_c", *_ORDER, blank.alias("blank"), whole.alias("whole"))
        .groupBy("_c", *_ORDER, "blank", "whole")
        .agg(F.count("*").alias("n")),
        "turns",
    )
    # Texts that several turn numbers share; all but those of the first number are duplicates.
    same = F.concat_ws("|", "_c", F.hex(F.col("role").cast("binary")), "h1", "h2")
    groups = groups.withColumn("_same", same)
    again = groups.groupBy("_same").agg(F.count("*").alias("_n"), F.min(F.struct("turn")).alias("_first")).where("_n > 1")
    marked = lookup_by_frequency(groups, again, "_same", "_n", [*_ORDER, "_c"])
    later = F.coalesce(F.struct("turn") != F.col("_first"), F.lit(False))
    each = marked.withColumn("later", later).select(
        "_c", *_ORDER, "blank", "whole", "later", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("copy")
    )
    fault = (
        F.when(F.col("blank"), 1).when(F.col("later") | (F.col("copy") > 0), 2).when(~F.col("whole"), 3).otherwise(0)
    )
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.substring("role", 1, 1) == "") | (initial < 0), 3).otherwise(initial)
    letter = F.chr((65 + 4 * initial + fault).cast("bigint")).alias("letter")
    each = each.select("_c", *_ORDER, "copy", letter)
    each = numbered(each, [*_ORDER, "copy"], "pos", ["_c"])
    return each.select("_c", (F.col("pos") - 1).alias("pos"), "letter")


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_CELL = T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
_SPAN = T.StructType(
    [
        T.StructField("_c", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("cells", T.ArrayType(_CELL)),
        *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("ends", T.StringType()),
    ]
)
_ARROW = pa.schema(
    [
        ("_c", pa.string()),
        ("block", pa.int64()),
        ("cells", pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))),
        *[(c, pa.int64()) for c in _COUNTS],
        ("ends", pa.string()),
    ]
)
_LEGAL = ("su", "ua", "au")


def _packed(cells: Cells) -> list:
    return [None if c is None else {"cost": c[0], "audit": c[1]} for c in cells]


def _leaf_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for c, block, letters in zip(*(batch.column(k).to_pylist() for k in ("_c", "block", "letters"))):
            turns = [_LETTERS[x] for x in letters]
            faults = [fault for _, fault in turns]
            initials = "".join(i for i, _ in turns)
            out.append(
                {
                    "_c": c,
                    "block": block,
                    "cells": _packed(_of_letters(letters)),
                    **{k: faults.count(k) for k in _COUNTS[:3]},
                    "illegal": sum(initials[i : i + 2] not in _LEGAL for i in range(len(initials) - 1)),
                    "ends": initials[0] + initials[-1],
                }
            )
        yield pa.RecordBatch.from_pylist(out, _ARROW)


def _joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            parts = row["parts"]
            cells = [tuple(None if x is None else (x["cost"], x["audit"]) for x in p["cells"]) for p in parts]
            ends = [p["ends"] for p in parts]
            across = sum(a[1] + b[0] not in _LEGAL for a, b in zip(ends, ends[1:]))
            whole = {
                "_c": row["_c"],
                "block": row["block"],
                "cells": _packed(halved(cells)),
                **{k: sum(p[k] for p in parts) for k in _COUNTS},
                "ends": ends[0][0] + ends[-1][1],
            }
            whole["illegal"] += across
            yield pa.RecordBatch.from_pylist([whole], _ARROW)


def _charts(letters: DataFrame, span: int, fan: int) -> DataFrame:
    """One row of cells and counts for each conversation."""
    inside = F.array_sort(F.collect_list(F.struct("pos", "letter")))
    leaves = letters.groupBy("_c", F.floor(F.col("pos") / span).alias("block")).agg(
        F.array_join(F.transform(inside, lambda x: x["letter"]), "").alias("letters")
    )
    spans = materialize(leaves.mapInArrow(_leaf_spans, _SPAN), "spans")
    most = spans.agg(F.max("block")).first()[0] or 0
    while most:
        parts = F.array_sort(F.collect_list(F.struct("block", "cells", *_COUNTS, "ends")))
        groups = spans.groupBy("_c", F.floor(F.col("block") / fan).alias("_wide")).agg(parts.alias("parts"))
        groups = groups.withColumnRenamed("_wide", "block")
        spans, most = materialize(groups.mapInArrow(_joined_spans, _SPAN), "spans"), most // fan
    return spans


def audit_conversations(
    rows: DataFrame, span: int = SPAN, fan: int = FAN, names: dict[str, str] = _STANDARD
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of each conversation.

    ``gaps`` counts the turn numbers missing between the least and the largest. Each turn's
    first fault counts: blank (nothing but white space), duplicate (role and text seen
    earlier), truncated (no ``.!?`` at its end). ``illegal`` counts neighbouring roles that
    aren't system-user, user-assistant or assistant-user. ``audit`` lists the cheapest edits
    (Keep, Rerole to user or assistant, Delete, Insert an empty turn) that give the roles
    ``(system? (user assistant)+)?``; blank and duplicate turns must go, a truncated one
    that stays costs more, and of equally cheap audits the least text is taken.

    A NULL role or text is one space; NULL turns come first and leave no gap; a NULL id is a
    conversation of its own. Repeated rows are duplicates. Turns of one number are ordered by role,
    then by their text's hash. Other columns are left aside; an empty table gives no rows.
    """
    turns = _turns(rows, names)
    per_number = turns.groupBy("_c", "turn").agg(F.min("conv_id").alias("conv_id"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    heads = per_number.groupBy("_c").agg(F.min("conv_id").alias("conv_id"), F.coalesce(gaps, F.lit(0)).alias("gaps"))
    cells = F.filter(F.array(*[F.get("cells", F.lit(q)) for q in FINAL]), lambda c: c.isNotNull())
    best = F.array_min(cells)
    return (
        heads.join(_charts(_letters(turns), span, fan), "_c")
        .withColumn("_best", best)
        .select(
            "conv_id",
            F.col("gaps").cast("bigint").alias("gaps"),
            *_COUNTS,
            F.col("_best.cost").alias("cost"),
            F.col("_best.audit").alias("audit"),
        )
    )


class _Editor:
    """Applies one conversation's audit to its turns as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.place = audit, 0, 0, 0

    def _next_role(self) -> str:
        self.state = 3 if self.state == 2 else 2
        return ROLES[self.state]

    def _out(self, edit: str, turn: int | None, role: str, text: str) -> tuple:
        self.place += 1
        return self.place - 1, edit, turn, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._out("I", None, self._next_role(), "")

    def turn(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = BY_ROLE[role[0]][self.state]
            yield self._out(edit, turn, role, text)
        elif edit == "R":
            yield self._out(edit, turn, self._next_role(), text)


def repair_conversations(
    rows: DataFrame, audits: DataFrame, names: dict[str, str] = _STANDARD
) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: the turns that the audits leave, in order.

    ``audits`` is what ``audit_conversations`` returns for the same rows; inserted turns have a NULL
    ``turn`` and an empty text. Rows of a conversation stand together and in order within a
    partition. Texts are shuffled once; a task streams them and holds one at a time,
    however long a conversation is.
    """
    turns = _turns(rows, names)
    id_type, turn_type = turns.schema["conv_id"].dataType, turns.schema["turn"].dataType
    # The audit comes first, then the turns.
    heads = audits.select(
        _key("conv_id").alias("_c"),
        "conv_id",
        F.lit(0).alias("_kind"),
        F.lit(None).cast(turn_type).alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("h1", "h2")],
    )
    both = heads.union(turns.select("_c", "conv_id", F.lit(1).alias("_kind"), "turn", "role", "text", "h1", "h2"))
    ordered = both.repartition("_c").sortWithinPartitions("_c", "_kind", *_ORDER).select("conv_id", "_kind", "turn", "role", "text")
    fields = [
        T.StructField("conv_id", id_type),
        T.StructField("place", T.LongType()),
        T.StructField("edit", T.StringType()),
        T.StructField("turn", turn_type),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, conv = None, None
        for batch in batches:
            out = []
            for c, kind, turn, role, text in zip(*(x.to_pylist() for x in batch.columns)):
                if kind == 0:
                    if editor:
                        out += [(conv, *x) for x in editor.inserted()]
                    editor, conv = _Editor(text), c
                else:
                    out += [(conv, *x) for x in editor.turn(turn, role, text)]
            yield _rows(out, batch.schema)
        if editor:
            yield _rows([(conv, *x) for x in editor.inserted()], batch.schema)

    def _rows(out: list[tuple], given: pa.Schema) -> pa.RecordBatch:
        kinds = [given.field("conv_id").type, pa.int64(), pa.string(), given.field("turn").type, pa.string(), pa.string()]
        columns = list(zip(*out)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=[f.name for f in fields])

    return ordered.mapInArrow(run, T.StructType(fields))


def digest_conversations(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of repaired turns as ``role:text``, newline-joined.

    Takes ``repair_conversations``' rows as they stand. A digest is sequential by nature, so
    a conversation is read by one task, which keeps the digest's state only.
    """
    given = repaired.schema["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv, kind = None, None, None
        for batch in batches:
            ids, digests = [], []
            kind = batch.schema.field("conv_id").type
            for c, place, role, text in zip(*(x.to_pylist() for x in batch.columns)):
                if place == 0:
                    if state:
                        ids.append(conv)
                        digests.append(state.hexdigest())
                    state, conv = hashlib.sha256(), c
                state.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), pa.array([state.hexdigest()])], names=["conv_id", "repaired_sha256"]
            )

    schema = T.StructType([given, T.StructField("repaired_sha256", T.StringType())])
    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, schema)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that a checksum of id and turn picks for each row.

    NULLs count as one space in the checksum; of 20 rests, five drop a row, empty its text,
    take its ``.!?`` away, repeat it, or make its role user.
    """
    space = F.lit(" ")
    crc = F.crc32(F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in ("conv_id", "", "turn")]))
    rest = crc % 20
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    return (
        rows.withColumn("_rest", rest)
        .where("_rest != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_rest") == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(F.col("_rest") == 1, F.lit("")).when(F.col("_rest") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_rest") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )
