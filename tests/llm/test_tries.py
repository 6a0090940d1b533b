from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tendero.llm import tries
from tests.llm.conftest import LONG, rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
CLASHING = "depth string, a string, shard string, conv string, size string"


def first(x):
    return (x is not None, x if x is not None else 0)


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((first(turn), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute_force(conversations: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {node: [m for m in members if len(m) == len(node) + 1 and m[: len(node)] == node] for node in members}
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[m] for m in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[m] for m in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def check(spark, rows, width=tries.WIDTH):
    found = tries.conversation_trie(spark.createDataFrame(rows, SCHEMA), width)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_force(rebuilt(rows))


def made(seed: int, conversations: int, turns: int, texts: int) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]) if texts > 2 else "user", f"t{rng.randrange(texts)}é")
        for c in range(conversations) for t in range(rng.randint(1, turns))
    ]


@pytest.mark.parametrize("width", [1, 2, 3, 64])
def test_any_width_gives_the_same_trie(spark, width):
    check(spark, made(1, 30, 9, 2), width)


def test_long_and_common_conversations_in_small_blocks(spark):
    long = [(3, t, "user", f"x{t % 5}") for t in range(40)] + [(100, t, "user", f"x{t % 5}") for t in range(40)]
    copies = [(c, t, "user", "same") for c in range(200, 260) for t in range(4)]
    check(spark, long + copies + made(2, 20, 6, 2), 4)


def test_shards_meet_at_their_borders(spark):
    """Far more shards than a beginning has rows: nearly every node lies in several."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, made(3, 60, 8, 2), 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_edge_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 0, "user", LONG), (2, 0, "assistant", LONG),
        (5, 0, "user", "漢字"), (5, None, "user", "b"), (5, 0, "user", "a"), (5, 1, None, "c"), (6, 0, "user", "a"), (7, 0, "a", "bc"), (8, 0, "ab", "c"),
    ]
    check(spark, rows)
    extra = spark.createDataFrame([(*r, *"vwxyz") for r in rows], f"{SCHEMA}, {CLASHING}")
    got = rows_of(tries.conversation_trie(extra))
    assert sorted((tuple(r.values()) for r in got), key=repr) == brute_force(rebuilt(rows))
    assert tries.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    emptied = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(emptied, 0, "user", "a"), (emptied, 1, "user", "b")]
    assert rebuilt(rows) == {emptied: []}
    check(spark, rows)
    check(spark, rows + [(c, 0, "user", "z") for c in range(1000, 1020)])
