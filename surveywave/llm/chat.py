"""Chat formatting as prefix trees.

A turn is written as [INST]role[/INST]text</s>; control strings inside role or
text get a backslash after their first character and backslashes are doubled,
which is reversible.  Conversations that share initial turns are merged: a
pack is a prefix tree of turns laid out depth first, each shared turn once.
A turn has position ids that continue its ancestors' (given as the first one),
and the intervals of the pack that it may attend to, namely its ancestors'.
Units are code points.

Scale: turns of a conversation are streamed in order.  Conversations up to
PACK_CHARS are one row, sorted by the hashes of their first turns and dealt by
range, so sharing ones are neighbours while a first turn that a third of all
conversations have is spread over many partitions; packs are cut at a bounded
size, and only there a shared turn is written again.  Longer conversations are
never held whole: they are ranked by the hashes of all their turns, so those that
share turns follow each other depth first, and streamed in chunks.  Each is a chain
of the turns it does not share with the one before, a pack of its own that hangs on
the chains before it in the same tree; offsets, parents and attention count in that
tree.  Where the ranks are cut into tasks a shared turn is written again.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

PACK_CHARS = 1 << 16
PACK_CONVERSATIONS = 1024
RANGE_CHUNKS = 256  # chunks of long conversations that a task lays out, at least
PATH = 8  # first turns whose hashes order the conversations
# The control strings of the template.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
CONTROL = (OPEN, CLOSE, END)
_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_UNESCAPE = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn and where its text lies in it."""
    head = f"{OPEN}{escape(role)}{CLOSE}"
    body = escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def read_turn(turn: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not (turn.startswith(OPEN) and turn.endswith(END)):
        raise ValueError("not a formatted turn")
    role, _, text = turn[len(OPEN):-len(END)].partition(CLOSE)
    return unescape(role), unescape(text)


TURN = pa.struct([("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("hash", pa.binary())])
PACKED = ["tree_id", "pack_id", "chunk", "nodes"]
INTERVAL = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _spark(kind: pa.DataType) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type
    return from_arrow_type(kind)


def _assemble(loss_role: str, limit: int):
    """Turns, sorted by conversation, to conversations of up to `limit` code
    points in one row, or chunks of about `limit`."""
    names = ["conv_id", "chunk", "long", "path", "turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        key, turns, size, chunk, last = object(), [], 0, 0, b""
        rows: list[tuple] = []

        def close(more: bool) -> None:
            nonlocal turns, size, chunk
            is_long = more or chunk > 0
            if turns or not is_long:
                path = [int.from_bytes(t["hash"][:8], "little", signed=True) for t in turns[:PATH]]
                rows.append((key, chunk, is_long, [] if is_long else path, turns))
            turns, size, chunk = [], 0, chunk + 1

        started = False
        for batch in batches:
            kind = batch.column("conv_id").type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if not started or conv != key:
                    if started:
                        close(False)
                    key, started, turns, size, chunk, last = conv, True, [], 0, 0, b""
                role, text = role or "", text or ""
                written, a, b = format_turn(role, text)
                if role != loss_role:
                    a = b = 0
                if turns and size + len(written) > limit:
                    close(True)
                last = hashlib.sha256(last + written.encode("utf-8", "surrogatepass")).digest()[:16]
                turns.append({"text": written, "loss_start": a, "loss_end": b, "hash": last})
                size += len(written)
            if rows:
                yield _batch(rows, names, [kind, pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(TURN)])
                rows = []
        if started:
            close(False)
            yield _batch(rows, names, [kind, pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(TURN)])
    return run


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _node_type(conv: pa.DataType) -> pa.DataType:
    return pa.struct([("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()), ("parent", pa.int64()), ("text", pa.string()),
                      ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attends", pa.list_(INTERVAL)), ("conv_ids", pa.list_(conv))])


def _joined(intervals: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """The intervals with one more after them, neighbours merged."""
    if intervals and intervals[-1][1] == start:
        return [*intervals[:-1], (intervals[-1][0], end)]
    return [*intervals, (start, end)]


class _Tree:
    """The prefix tree of one pack."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.turns: list[dict] = []
        self.children: list[list[int]] = []
        self.leaves: list[list] = []
        self.roots: list[int] = []
        self.size = self.conversations = 0

    def new_chars(self, turns: list[dict]) -> int:
        return sum(len(t["text"]) for t in turns if t["hash"] not in self.known)

    def add(self, conv, turns: list[dict]) -> None:
        self.conversations += 1
        at = None
        for turn in turns:
            node = self.known.get(turn["hash"])
            if node is None:
                node = self.known[turn["hash"]] = len(self.turns)
                self.turns.append(turn)
                self.children.append([])
                self.leaves.append([])
                (self.roots if at is None else self.children[at]).append(node)
                self.size += len(turn["text"])
            at = node
        self.leaves[at].append(conv)

    def laid_out(self) -> list[dict]:
        """Nodes depth first."""
        out: list[dict] = []
        offset = 0
        walk = [(r, -1, 0, []) for r in reversed(self.roots)]
        while walk:
            node, parent, position, attends = walk.pop()
            turn = self.turns[node]
            end = offset + len(turn["text"])
            out.append({"start": offset, "end": end, "position": position, "parent": parent, "text": turn["text"],
                        "loss_start": turn["loss_start"], "loss_end": turn["loss_end"],
                        "attends": [{"start": a, "end": b} for a, b in attends], "conv_ids": self.leaves[node]})
            below = _joined(attends, offset, end)
            walk += [(c, len(out) - 1, position + len(turn["text"]), below) for c in reversed(self.children[node])]
            offset = end
        return out


def _pack_short(limit: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, tree = TaskContext.get().partitionId() << 32, _Tree()
        for batch in batches:
            kind = batch.column("conv_id").type
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(_node_type(kind))]
            rows = []
            for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                if tree.turns and (tree.size + tree.new_chars(turns) > limit or tree.conversations >= most):
                    rows.append((pack, pack, 0, tree.laid_out()))
                    pack, tree = pack + 1, _Tree()
                tree.add(conv, turns)
            if rows:
                yield _batch(rows, PACKED, kinds)
        if tree.turns:
            yield _batch([(pack, pack, 0, tree.laid_out())], PACKED, kinds)
    return run


def _pack_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of long conversations, which come depth first: a conversation shares
    with all before it what it shares with the last one.  A turn that is shared is
    not written again; the others are a chain, whose first turn has the last shared
    one as its parent.  Conversations' ids stand on their last turn, which is known
    when the next one leaves it.  Held are a row and the numbers of one path."""
    pack = tree = (1 << 62) | (TaskContext.get().partitionId() << 32)
    # the path of the last conversation: hash, start, end, number of each turn
    hashes, starts, ends, numbers = [], array("q"), array("q"), array("q")
    offset = number = position = chunk = depth = 0
    attends: list[tuple[int, int]] = []
    held: list = []  # tree, pack, chunk, nodes of the row that is not written yet
    key, started, own = None, False, True  # own: the conversation has turns that it does not share

    def ended() -> None:
        if not own:
            if depth != len(hashes):
                raise ValueError("a long conversation comes after one that goes on from it")
            held[0][3][-1]["conv_ids"].append(key)
        elif held:
            held[0][3][-1]["conv_ids"] = [key]

    for batch in batches:
        kind = batch.column("conv_id").type
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(_node_type(kind))]
        for conv, first, turns in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chunk", "turns"))):
            if first == 0:
                if started:
                    ended()
                key, started, own, depth = conv, True, False, 0
            nodes = []
            for turn in turns:
                if not own and depth < len(hashes) and hashes[depth] == turn["hash"]:
                    depth += 1
                    continue
                if not own:  # the chain begins here
                    own, pack, chunk = True, pack + 1, 0
                    if depth == 0:
                        tree, offset, number = pack, 0, 0
                    del hashes[depth:], starts[depth:], ends[depth:], numbers[depth:]
                    attends, position = [], 0
                    for a, b in zip(starts, ends):
                        if attends and attends[-1][1] == a:
                            attends[-1] = (attends[-1][0], b)
                        else:
                            attends.append((a, b))
                        position += b - a
                size = len(turn["text"])
                nodes.append({"start": offset, "end": offset + size, "position": position, "parent": numbers[-1] if numbers else -1, "text": turn["text"],
                              "loss_start": turn["loss_start"], "loss_end": turn["loss_end"],
                              "attends": [{"start": a, "end": b} for a, b in attends], "conv_ids": []})
                hashes.append(turn["hash"])
                starts.append(offset)
                ends.append(offset + size)
                numbers.append(number)
                attends = _joined(attends, offset, offset + size)
                offset, number, position, depth = offset + size, number + 1, position + size, depth + 1
            if nodes:
                if held:
                    yield _batch(held, PACKED, kinds)
                held = [(tree, pack, chunk, nodes)]
                chunk += 1
    if held:
        ended()
        yield _batch(held, PACKED, kinds)


def _ranked(long: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, at: the conversations' places in the order of their turns' hashes,
    stored, as ranges are sampled anew for each plan.  Only hashes move."""
    path = long.select("conv_id", F.struct("chunk", F.transform("turns", lambda t: F.substring(t["hash"], 1, 8)).alias("path")).alias("c"))
    path = path.groupBy("conv_id").agg(F.flatten(F.sort_array(F.collect_list("c"))["path"]).alias("path"))
    # as many ranges as the chunks fill: AQE would go by the bytes of hashes, which are few
    ranges = min(1 + long.count() // RANGE_CHUNKS, int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    path = path.repartitionByRange(ranges, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return scratch.table(path.select("conv_id", F.monotonically_increasing_id().alias("at")), "ranks")


def format_conversations(turns: DataFrame, scratch: Scratch, loss_role: str = "assistant", pack_chars: int = PACK_CHARS,
                         pack_conversations: int = PACK_CONVERSATIONS) -> DataFrame:
    """Packs of the conversations in turns(conv_id, turn, role, text).

    One row per pack (or chunk of a long chain): tree_id, pack_id, chunk, nodes.  A
    short pack is a tree of its own; the chains of a long tree, in the order of their
    pack_id, continue each other's offsets and node numbers.  A node
    has start and end in the tree, the first position id, its parent's number,
    the formatted text, the loss range in that text, the intervals it attends
    to besides itself, and the conversations that end with it.  Turns are taken
    by turn, role, text (NULLs first); repeated rows are turns of their own;
    NULL roles and texts are empty, rows with a NULL conv_id are one
    conversation.  Other columns are not read.
    """
    rows = turns.select("conv_id", F.col("turn").alias("_n"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    conv = rows.schema["conv_id"].dataType
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "_n", "role", "text").select("conv_id", "role", "text")
    schema = T.StructType([T.StructField("conv_id", conv), T.StructField("chunk", T.LongType()), T.StructField("long", T.BooleanType()),
                           T.StructField("path", T.ArrayType(T.LongType())), T.StructField("turns", _spark(pa.list_(TURN)))])
    held = scratch.table(rows.mapInArrow(_assemble(loss_role, pack_chars), schema), "conversations")
    from pyspark.sql.pandas.types import to_arrow_type
    out = T.StructType([T.StructField("tree_id", T.LongType()), T.StructField("pack_id", T.LongType()), T.StructField("chunk", T.LongType()),
                        T.StructField("nodes", _spark(pa.list_(_node_type(to_arrow_type(conv)))))])
    short = held.where("not long").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    packs = short.select("conv_id", "turns").mapInArrow(_pack_short(pack_chars, pack_conversations), out)
    long = held.where("long").select("conv_id", "chunk", "turns")
    ranks = _ranked(long, scratch).withColumnRenamed("conv_id", "_conv")
    # ranks of one range of hashes meet (33 bits of a rank are its place in the range)
    chains = (long.join(ranks, long["conv_id"].eqNullSafe(ranks["_conv"])).repartition(F.shiftright("at", 33)).sortWithinPartitions("at", "chunk")
              .select("conv_id", "chunk", "turns"))
    return scratch.table(packs.unionByName(chains.mapInArrow(_pack_long, out)), "packs")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    """The stack holds the ancestors of a turn; in a tree of chains only the last turn
    and those that a chain begins after (``forks``: their ends, told by the first row)."""
    tree, stack, forks, kind = None, [], None, None
    for batch in batches:
        kind = batch.schema.field("nodes").type.value_type.field("conv_ids").type.value_type
        rows: list[tuple] = []
        for tree_id, pack_id, nodes, told in zip(*(batch.column(c).to_pylist() for c in ("tree_id", "pack_id", "nodes", "forks"))):
            if tree_id != tree:
                tree, stack, forks = tree_id, [], None if told is None else set(told)
            for node in nodes:
                # the ancestors are what the node's intervals show
                seen = node["attends"]
                while stack and (not seen or stack[-1][1] != seen[-1]["end"]):
                    stack.pop()
                if node["position"] != sum(i["end"] - i["start"] for i in seen) or bool(seen) != bool(stack):
                    raise ValueError(f"positions and attention of pack {pack_id} do not agree")
                if node["end"] - node["start"] != len(node["text"]):
                    raise ValueError(f"a turn of pack {pack_id} is not as long as its range")
                turns, loss, n, chars = (stack[-1][2].copy(), stack[-1][3].copy(), *stack[-1][4:]) if stack else (
                    hashlib.sha256(), hashlib.sha256(), 0, 0)
                role, text = read_turn(node["text"])
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                answer = unescape(node["text"][node["loss_start"]:node["loss_end"]])
                loss.update(answer.encode("utf-8", "surrogatepass"))
                stack.append((node["start"], node["end"], turns, loss, n + 1, chars + len(answer)))
                rows += [(conv, n + 1, turns.hexdigest(), chars + len(answer), loss.hexdigest(), node["position"] + len(node["text"]))
                         for conv in node["conv_ids"]]
                if forks is not None and len(stack) > 1 and stack[-2][1] not in forks:
                    del stack[-2]
        if rows:
            yield _batch(rows, names, [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])


def read_back(packs: DataFrame) -> DataFrame:
    """A row per conversation, from the packs alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    conv = packs.schema["nodes"].dataType.elementType["conv_ids"].dataType.elementType
    schema = T.StructType([T.StructField("conv_id", conv), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType())])
    chain, none = F.col("pack_id") >= 1 << 62, F.lit(None).cast("array<bigint>").alias("forks")
    columns = ["tree_id", "pack_id", "nodes"]
    # a chain that hangs on others begins after the last turn that its first one attends to
    hangs = packs.where(chain & (F.col("chunk") == 0) & (F.col("pack_id") != F.col("tree_id")))
    forks = hangs.groupBy("tree_id").agg(F.collect_set(F.element_at(F.col("nodes")[0]["attends"], -1)["end"]).alias("forks"))
    forks = forks.select(F.col("tree_id").alias("_tree"), "forks")
    long = packs.where(chain)
    # only the first row of a tree carries them
    long = long.join(forks, (long["tree_id"] == forks["_tree"]) & (long["pack_id"] == long["tree_id"]) & (long["chunk"] == 0), "left")
    long = long.repartition("tree_id").sortWithinPartitions("tree_id", "pack_id", "chunk")
    long = long.select(*columns, F.coalesce("forks", F.array().cast("array<bigint>")).alias("forks"))
    return packs.where(~chain).select(*columns, none).mapInArrow(_digests, schema).unionByName(long.mapInArrow(_digests, schema))


def position_ids(nodes: list[dict]) -> list[int]:
    """The position id of every code point of a pack."""
    return [node["position"] + k for node in nodes for k in range(node["end"] - node["start"])]
