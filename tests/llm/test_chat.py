"""Chat formatting: reversible escapes, trees and attention, exact read-back."""

import hashlib
import random

import pytest

from surveywave.llm import chat as C
from surveywave.llm.common import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, pack_id string, path long"
SAID = "</s>[INST] ok [/INST]"


def conversations():
    rng = random.Random(6)
    rows = [(-1, 0, "user", SAID), (-1, 1, "assistant", SAID), (1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, "\\ \\[INST] <\\/s>"),
            (2, None, "assistant", "first, as its turn is null"), (3, 0, "[INST]", "role like a marker"), (4, 5, "assistant", "é😀"), (4, 2, "user", "x"),
            (5, 0, "user", "tie b"), (5, 0, "user", "tie a"), (5, 0, "user", "tie a"), (None, 0, "assistant", "no id")]
    for conv in range(100, 400):  # one first turn for all of these, some share more
        rows += [(conv, 0, "system", "be kind"), (conv, 1, "user", f"question {conv % 7}"), (conv, 2, "assistant", f"answer {conv % 21} " + "y" * rng.randrange(50))]
    rows += [(900 + k, t, "assistant", "same") for k in range(50) for t in range(2)]  # copies of one conversation
    rows += [(1000, t, ("user", "assistant")[t % 2], f"turn {t} " * 40) for t in range(60)]  # longer than a pack
    rows += [(1001, t, ("user", "assistant")[t % 2], f"turn {t} " * 40) for t in range(59)]
    return [(*r, "clash", 1) for r in rows]


def brute(rows):
    groups = {}
    for conv, turn, role, text, *_ in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for conv, turns in groups.items():
        said = [(role, text) for _, _, _, role, _, text in sorted(turns)]
        loss = "".join(t for r, t in said if r == "assistant")
        out.append((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss), sum(len(C.format_turn(r, t)[0]) for r, t in said)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def packs(spark):
    df = spark.createDataFrame(conversations(), SCHEMA).repartition(6)
    return C.format_conversations(df, Scratch(spark, "t"), pack_chars=4000, pack_conversations=20)


@pytest.mark.parametrize("text", ["", "\\", "[INST]", "[\\INST]", "\\[INST]\\\\[/INST]</s><\\/s>", "<</s>/s>", "[[INST]INST]", SAID])
def test_escapes_are_reversible(text):
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROL)
    turn, a, b = C.format_turn(text, text)
    assert C.read_turn(turn) == (text, text) and C.unescape(turn[a:b]) == text


def test_read_back_against_a_plain_loop(packs):
    got = sorted(map(tuple, C.read_back(packs).collect()), key=str)
    assert got == brute(conversations())


def test_trees_share_turns_and_attend_to_ancestors(packs):
    shared = 0
    for pack in (r.asDict(recursive=True) for r in packs.where("pack_id < (1L << 62)").collect()):
        nodes = pack["nodes"]
        assert sum(n["end"] - n["start"] for n in nodes) <= 4000 or len(nodes) == 1
        assert len(C.position_ids(nodes)) == nodes[-1]["end"]
        seen = set()
        for k, node in enumerate(nodes):
            assert node["start"] == (nodes[k - 1]["end"] if k else 0)  # depth first, no gap
            chain, at = [], node["parent"]
            while at >= 0:
                assert at < k
                chain.append(at)
                at = nodes[at]["parent"]
            visible = {p for i in node["attends"] for p in range(i["start"], i["end"])}
            assert visible == {p for a in chain for p in range(nodes[a]["start"], nodes[a]["end"])}
            assert node["position"] == len(visible)
            path = (*(nodes[a]["text"] for a in reversed(chain)), node["text"])
            assert path not in seen  # a shared turn stands once
            seen.add(path)
            shared += max(0, len(node["conv_ids"]) - 1)
    assert shared > 40


def test_a_shared_first_turn_is_written_once_a_pack(packs):
    times = [sum("be kind" in n.text for n in r.nodes) for r in packs.collect()]
    assert max(times) == 1 and sum(times) < 60


def test_long_conversations_are_chains_in_chunks(packs):
    rows = packs.where("pack_id >= (1L << 62)").orderBy("pack_id", "chunk").collect()
    assert len({r.pack_id for r in rows}) == 2 and len(rows) > 4
    assert sorted(c for r in rows for n in r.nodes for c in n.conv_ids) == [1000, 1001]


def test_empty_table(spark):
    packs = C.format_conversations(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"))
    assert C.read_back(packs).count() == 0


@pytest.mark.parametrize("cut", [False, True])
def test_long_conversations_share_their_turns(spark, monkeypatch, cut):
    """Long ones that share turns, in the middle of a chunk and beyond the first turns, copies and
    beginnings of others: every turn is written once (but where ranks are cut), and all are read back."""
    if cut:
        monkeypatch.setattr(C, "RANGE_CHUNKS", 8)
    rng = random.Random(3)
    rows = [(k, t, ("user", "assistant")[t % 2], f"turn {t} " * 9 + str(k * (t >= own))) for k, own in enumerate([99, 70, 70, 41, 12, 99, 0, 0, 55])
            for t in range(99 if k else 60)]
    rows += [(50, t, "user", f"apart {t} " * 20) for t in range(40)]
    rows += [(None, t, "user", f"apart {t} " * 20) for t in range(41)]
    rows += [(51, t, "user", f"apart {t} " * 20) for t in range(41)]
    rng.shuffle(rows)
    rows = [(*r, "clash", 1) for r in rows]
    packs = C.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5), Scratch(spark, "t"), pack_chars=2000)
    assert sorted(map(tuple, C.read_back(packs).collect()), key=str) == brute(rows)
    assert packs.where("pack_id < (1L << 62)").count() == 0
    trees = {}
    for r in packs.orderBy("tree_id", "pack_id", "chunk").collect():
        trees.setdefault(r.tree_id, []).extend(n.asDict(recursive=True) for n in r.nodes)
    said = {}
    for k, t, role, text, *_ in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        said.setdefault(k, []).append((role, text))
    prefixes = {tuple(s[:n + 1]) for s in said.values() for n in range(len(s))}
    written = sum(map(len, trees.values()))
    assert len(prefixes) < 0.65 * len(rows)
    assert written == len(prefixes) if not cut else len(prefixes) <= written < len(rows)
    for nodes in trees.values():
        for k, node in enumerate(nodes):
            assert node["start"] == (nodes[k - 1]["end"] if k else 0)
            chain, at = [], node["parent"]
            while at >= 0:
                assert at < k
                chain.append(at)
                at = nodes[at]["parent"]
            visible = {p for i in node["attends"] for p in range(i["start"], i["end"])}
            assert visible == {p for a in chain for p in range(nodes[a]["start"], nodes[a]["end"])} and node["position"] == len(visible)
