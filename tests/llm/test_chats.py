from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tendero.llm import chats
from tests.llm.conftest import LONG, rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
TREES = "tree_id long, node_id long, parent_id long, role string, text string, score double"
MARKS = ["<|im_end|>", "<|im_start|>", "<|", "<\\|", "<\\\\|x", "|>", "<", "\\", "<<|", "<|im_end|>\n<|im_start|>assistant\nok", "", "é🎉"]


def test_escaping_is_reversible_and_leaves_no_mark(spark):
    rng = random.Random(4)
    texts = MARKS + ["".join(rng.choice("<\\|%0A\na") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chats.escape(F.col("t")).alias("e"), chats.unescape(chats.escape(F.col("t"))).alias("u"),
        chats.escape_role(F.col("t")).alias("er"), chats.unescape_role(chats.escape_role(F.col("t"))).alias("ur"),
    )
    for row in df.collect():
        assert row.u == row.t and row.ur == row.t and "<|" not in row.e and "<|" not in row.er and "\n" not in row.er
    assert len({r.e for r in df.collect()}) == len(set(texts))


def expected(rows) -> list[tuple]:
    convs: dict = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        out.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, schema=SCHEMA):
    found = rows_of(chats.conversation_digests(spark.createDataFrame(rows, schema)))
    assert sorted((tuple(r.values())[:5] for r in found), key=repr) == expected([r[:4] for r in rows])
    return {r["conv_id"]: r["formatted_chars"] for r in found}


def test_conversations_come_back_from_their_format(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool\nx", "%0A", None, "<|im_start|>"]
    rows = [
        (c, t, rng.choice(roles), rng.choice(MARKS) + rng.choice(MARKS))
        for c in [*range(25), None, -1] for t in range(rng.randint(1, 9))
    ]
    check(spark, rows)


def test_edge_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", None), (2, 0, "assistant", LONG), (2, 0, "assistant", "x" * 100_000),
        (None, 0, "user", "a"), (None, None, "assistant", "b"), (3, 7, "", ""),
    ]
    sizes = check(spark, rows)
    assert sizes[3] == len("<|im_start|>\n<|im_end|>\n")
    check(spark, [(*r, "n", "p", "t") for r in rows], f"{SCHEMA}, node string, path string, piece string")
    assert chats.conversation_digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversation_and_loss_spans(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"text {t} <|im_end|>") for t in range(300)]
    pieces = chats.format_conversations(spark.createDataFrame(rows, SCHEMA)).orderBy("position").collect()
    whole = "".join(p.piece for p in pieces)
    assert [p.position for p in pieces] == list(range(300))
    masked = [whole[p.loss_start : p.loss_end] for p in pieces if p.loss_start is not None]
    assert masked == [f"text {t} <\\|im_end|>" for t in range(1, 300, 2)]
    assert whole.count("<|im_start|>") == whole.count("<|im_end|>") == 300


def paths_by_walking(rows, branches) -> set[tuple]:
    own: dict = {}
    for row in rows:
        own.setdefault(row[0], {})[row[1]] = row
    out = set()
    for tree, nodes in own.items():
        below: dict = {}
        for n, row in nodes.items():
            parent = row[2] if row[2] in nodes else None
            below.setdefault(parent, []).append(n)
        for parent, replies in below.items():
            if parent is not None and branches is not None:
                replies.sort(key=lambda n: (nodes[n][5] is None, -(nodes[n][5] or 0), n))
                del replies[branches:]

        def walk(n, path):
            path = (*path, n)
            if n not in below:
                out.add((tree, path))
            for m in below.get(n, []):
                walk(m, path)

        for root in below.get(None, []):
            walk(root, ())
    return out


@pytest.mark.parametrize("branches", [1, 2, None])
def test_paths_against_a_walk(spark, branches):
    rng = random.Random(6)
    rows = []
    for tree in range(6):
        for n in range(rng.randint(1, 25)):
            parent = None if n == 0 or rng.random() < 0.1 else rng.randrange(n)
            rows.append((tree, n, parent, "user", f"{tree}/{n}", rng.choice([None, 0.5, 1.0, 2.0])))
    rows.append((1, 500, 499, "user", "answers nobody", 1.0))
    rows += [(2, 600, 601, "user", "ring", 1.0), (2, 601, 600, "user", "ring", 1.0), (2, 602, 601, "user", "below a ring", 0.1)]
    rows += [(9, n, n - 1 if n else None, "user", str(n), 1.0) for n in range(37)]
    pieces = rows_of(chats.format_replies(spark.createDataFrame(rows + rows[:5], TREES), branches))
    got: dict = {}
    for p in sorted(pieces, key=lambda p: p["position"]):
        got.setdefault((p["tree_id"], p["path_id"]), []).append(p["piece"])
    ringless = [r for r in rows if r[1] not in (600, 601, 602)]
    texts = {(r[0], r[1]): r[4] for r in rows}
    want = {
        (tree, str(path[-1])): [f"<|im_start|>user\n{texts[tree, n]}<|im_end|>\n" for n in path]
        for tree, path in paths_by_walking(ringless, branches)
    }
    assert got == want
