"""Repair of conversation structure by a square-root checkpointed DP.

A conversation is well formed if the initials of its roles read `(s?(ua)+)?`: an
optional system turn, then user and assistant in turns, or nothing at all.  Every
row can be kept, given another role or deleted, and empty turns can be inserted;
the cheapest sequence of edits is wanted, and of equally cheap ones the one whose
initials (D, I, K, R) are least as ASCII.

Four states (nothing yet, after system, after user, after assistant) make it a
shortest path: a backward pass gives each row the cost from each state to the
end, and a forward walk takes the first tight edit.  The walk needs the costs in
the order opposite to the one they are computed in.  A conversation of n rows is
therefore cut into blocks of ⌈√n⌉ rows.  Only the cost vectors at block ends, the
checkpoints, are stored; the walk recomputes a block's vectors from its
checkpoint when it comes to the block.  So √n vectors are stored and √n more are
in memory.

At scale.  Ranks come from a range partitioning, so a conversation with a third of
all rows is cut like any other; what the DP needs of a row is one letter.  A
block's backward pass is a 4 x 4 min-plus matrix, computed for all blocks side by
side; the checkpoints of a conversation chain its √n matrices, a row at a time.
The walk streams the rows of a conversation in order, holding one block's
vectors.  It is one task a conversation because the digest of its repaired text
is one sha256, which is sequential; it holds no group.

Edge cases.  A NULL role or text counts as one space, so its row is blank or has
an unknown role; NULL ids are one conversation.  NULL turns come first; rows that
tie in their turn are ordered by role, by the text's first 64 code points, and by
the text's sha256; rows that repeat in full are adjacent, and all but the first
are duplicates.  Texts of any length are hashed as they stream.  Unknown and
empty roles can only be replaced or deleted.  An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import SPACE, WORD, Scratch
from .ranking import ranked

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
INITIALS = "sua"
FAULTS = ["ok", "blank", "duplicate", "truncated"]
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60
# where an inserted or renamed turn leads from each state, and its role
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
# where a kept role leads from each state; no entry: it can't be kept
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
DONE = (0, 2 * INSERT, INSERT, 0)
READ_ROWS = 256  # rows of an Arrow batch that are Python objects at a time


# --- the recurrence ------------------------------------------------------------

def letter(role_index: int, fault: int) -> str:
    """A row as the DP sees it: its role's place in INITIALS (3: none of them)
    and its fault's in FAULTS."""
    return chr(ord("a") + 4 * role_index + fault)


def _meaning(code: str) -> tuple[str, bool, int]:
    role, fault = divmod(ord(code) - ord("a"), 4)
    return (INITIALS + "-")[role], fault in (1, 2), CUT_OFF if fault == 3 else 0


def step(code: str, after: tuple) -> tuple:
    """The costs from each state before a row, given those after it."""
    role, must_go, extra = _meaning(code)
    here = []
    for q in range(4):
        best = DELETE + after[q]
        if not must_go:
            best = min(best, REROLE + extra + after[NEXT[q]])
            if role in KEPT[q]:
                best = min(best, KEEP + extra + after[KEPT[q][role]])
        here.append(best)
    # up to two insertions before the row: from any state they reach all others that matter
    return tuple(min(here[q], INSERT + here[NEXT[q]], 2 * INSERT + here[NEXT[NEXT[q]]]) for q in range(4))


def transfer(codes: str) -> list[int]:
    """The min-plus matrix of a block, row by row: the cost from each state at its
    start to each state at its end."""
    columns = []
    for end in range(4):
        v = tuple(0 if q == end else FAR for q in range(4))
        for code in reversed(codes):
            v = step(code, v)
        columns.append(v)
    return [min(columns[end][q], FAR) for q in range(4) for end in range(4)]


def edits(code: str, state: int, here: tuple, after: tuple) -> Iterator[tuple[str, int, str]]:
    """The ASCII-least tight edits at a row: (initial, state they lead to, role
    given), insertions first, up to the one that consumes the row."""
    role, must_go, extra = _meaning(code)
    while True:
        if here[state] == DELETE + after[state]:
            yield "D", state, ""
            return
        if here[state] == INSERT + here[NEXT[state]]:
            yield "I", NEXT[state], ROLE[state]
            state = NEXT[state]
            continue
        if not must_go and role in KEPT[state] and here[state] == KEEP + extra + after[KEPT[state][role]]:
            yield "K", KEPT[state][role], ""
            return
        yield "R", NEXT[state], ROLE[state]
        return


# --- rows as letters -----------------------------------------------------------

def _spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def _placed(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows in order: conv_id, turn, role, text, _place, _rank, _block, _len."""
    rows = turns.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("_lead").asc(), F.col("_sha").asc()]
    rows = rows.withColumns({"_lead": F.substring("text", 1, 64), "_sha": F.sha2(F.col("text").cast("binary"), 256)})
    out = ranked(rows, ["conv_id"], order, scratch, "rows").drop("_lead")
    length = F.ceil(F.sqrt("_size")).cast("long")
    return scratch.table(out.withColumn("_block", F.floor(F.col("_rank") / length)), "placed")


def _letters(placed: DataFrame) -> DataFrame:
    """conv_id, _block and codes: the letters of a block's rows, in order."""
    rows = placed.select("conv_id", "_rank", "_block", "role", "_sha",
                         (~F.col("text").rlike(WORD)).alias("blank"), (~F.col("text").rlike(f"[.!?]{SPACE}*\\z")).alias("cut"))
    same = ["conv_id", "role", "_sha"]
    # only what repeats is met again, and by its first place
    first = rows.groupBy(*same).agg(F.min("_rank").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    first = first.select(*[F.col(c).alias(f"_{c}_") for c in same], "_first")
    met = rows.join(first, F.col("conv_id").eqNullSafe(F.col("_conv_id_")) & (F.col("role") == F.col("_role_")) & (F.col("_sha") == F.col("__sha_")), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("_rank") > F.col("_first"), 2).when(F.col("cut"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    met = met.withColumn("code", F.char(F.lit(ord("a")) + 4 * role + fault))
    run = F.sort_array(F.collect_list(F.struct("_rank", "code")))
    return met.groupBy("conv_id", "_block").agg(F.array_join(F.transform(run, lambda x: x["code"]), "").alias("codes"))


# --- checkpoints ---------------------------------------------------------------

def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, READ_ROWS):
            yield from batch.slice(at, READ_ROWS).to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([transfer(c) for c in batch.column("codes").to_pylist()], pa.list_(pa.int64()))],
            [*batch.schema.names, "matrix"])


def _chained(rows: Iterator[dict]) -> Iterator[dict]:
    """Blocks, last first, to checkpoints: the cost vector at the end of each."""
    conv, v = object(), DONE
    for r in rows:
        if r["conv_id"] != conv:
            conv, v = r["conv_id"], DONE
        m = r.pop("matrix")
        yield r | {"costs": list(v)}
        v = tuple(min(m[4 * q + end] + v[end] for end in range(4)) for q in range(4))


def _map_rows(df: DataFrame, shape: str, fn, size: int = 1024) -> DataFrame:
    """df with fn applied to the stream of each partition's rows."""
    schema = to_arrow_schema(StructType.fromDDL(shape))
    return df.mapInArrow(lambda batches: _batches(fn(_rows_of(batches)), schema, size), shape)


def checkpoints(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, _block, codes and costs (the backward vector at the block's end)."""
    kind = placed.schema["conv_id"].dataType.simpleString()
    blocks = _letters(placed).mapInArrow(_matrices, f"conv_id {kind}, _block long, codes string, matrix array<long>")
    blocks = scratch.table(blocks, "blocks").repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("_block").desc())
    return scratch.table(_map_rows(blocks, f"conv_id {kind}, _block long, codes string, costs array<long>", _chained), "checkpoints")


# --- the walk ------------------------------------------------------------------

class _Walk:
    """The forward walk over one conversation, a block after the other."""

    def __init__(self, conv):
        self.conv, self.state, self.audit, self.cost = conv, 0, [], 0
        self.faults = [0, 0, 0, 0]
        self.illegal, self.initial = 0, None
        self.first_turn = self.last_turn = None
        self.turns, self.places = 0, 0
        self.digest = hashlib.sha256()

    def enter(self, codes: str, costs: list[int]) -> None:
        """Recomputes the block's vectors from its checkpoint."""
        self.codes, self.vectors = codes, [tuple(costs)]
        for code in reversed(codes):
            self.vectors.append(step(code, self.vectors[-1]))
        self.vectors.reverse()
        self.at = 0

    def _say(self, role: str, text: str) -> dict:
        self.digest.update(("\n" * (self.places > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.places += 1
        return {"conv_id": self.conv, "place": self.places - 1, "role": role, "text": text}

    def take(self, turn, role: str, text: str) -> Iterator[dict]:
        """The repaired turns that a row gives, with their edit."""
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        code = self.codes[self.at]
        fault = (ord(code) - ord("a")) % 4
        self.faults[fault] += 1
        for initial, state, given in edits(code, self.state, self.vectors[self.at], self.vectors[self.at + 1]):
            self.audit.append(initial)
            self.state = state
            if initial == "D":
                self.cost += DELETE
            elif initial == "I":
                self.cost += INSERT
                yield self._say(given, "") | {"turn": None, "edit": "I"}
            else:
                self.cost += (REROLE if initial == "R" else KEEP) + (CUT_OFF if fault == 3 else 0)
                yield self._say(given or role, text) | {"turn": turn, "edit": initial}
        self.at += 1

    def finish(self) -> Iterator[dict]:
        while self.state in (1, 2):
            self.audit.append("I")
            self.cost += INSERT
            yield self._say(ROLE[self.state], "") | {"turn": None, "edit": "I"}
            self.state = NEXT[self.state]

    def report(self) -> dict:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.first_turn is not None else 0
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.faults[1], "duplicate": self.faults[2], "truncated": self.faults[3],
                "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def _walked(rows: Iterator[dict], turns: bool) -> Iterator[dict]:
    """Checkpoints, each followed by the rows of its block, to repaired turns or reports."""
    walk: _Walk | None = None
    for r in rows:
        if walk is None or r["conv_id"] != walk.conv:
            if walk is not None:
                yield from _ended(walk, turns)
            walk = _Walk(r["conv_id"])
        if r["codes"] is not None:
            walk.enter(r["codes"], r["costs"])
            continue
        for said in walk.take(r["turn"], r["role"], r["text"]):
            if turns:
                yield said
    if walk is not None:
        yield from _ended(walk, turns)


def _ended(walk: _Walk, turns: bool) -> Iterator[dict]:
    last = list(walk.finish())
    yield from last if turns else [walk.report()]


def _walk(turns: DataFrame, scratch: Scratch, as_turns: bool) -> DataFrame:
    placed = _placed(turns, scratch)
    marks = checkpoints(placed, scratch)
    kinds = {c: placed.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    none = F.lit(None)
    rows = placed.select("conv_id", "_block", F.lit(1).alias("_kind"), "_place", "turn", "role", "text",
                         none.cast("string").alias("codes"), none.cast("array<long>").alias("costs"))
    marks = marks.select("conv_id", "_block", F.lit(0).alias("_kind"), F.lit(-1).cast("long").alias("_place"), none.cast(kinds["turn"]).alias("turn"),
                         none.cast("string").alias("role"), none.cast("string").alias("text"), "codes", "costs")
    dealt = rows.unionByName(marks).repartition("conv_id").sortWithinPartitions("conv_id", "_block", "_kind", "_place")
    if as_turns:
        shape = f"conv_id {kinds['conv_id']}, place long, role string, text string, turn {kinds['turn']}, edit string"
    else:
        shape = (f"conv_id {kinds['conv_id']}, gaps long, blank long, duplicate long, truncated long, illegal long, "
                 "cost long, audit string, repaired_sha256 string")

    fields = dealt.select("conv_id", "turn", "role", "text", "codes", "costs")
    return _map_rows(fields, shape, lambda found: _walked(found, as_turns), 256)


def repaired_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text, turn (NULL
    where inserted) and edit (K, R or I)."""
    return _walk(turns, scratch, True)


def repair_report(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """One row for each conversation that has rows: its faults, the cost, the
    audit (the edits' initials) and the digest of the repaired conversation."""
    return _walk(turns, scratch, False)


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with faults planted by the checksum of
    `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes its role user.  NULLs count as one space."""
    kind = F.crc32(F.concat_ws(":", _spaced("conv_id"), _spaced("turn"))) % 20
    rows = turns.select("conv_id", "turn", kind.alias("_k"), _spaced("role").alias("role"), _spaced("text").alias("text")).where("_k <> 0")
    rows = rows.withColumn("text", F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_k", "_copy")
