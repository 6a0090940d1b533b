"""Reply trees as training conversations.

A reply tree has a row for each message: its tree, its own number, the message it answers, role, text
and a score.  ``reply_paths`` ranks the replies to a message by score, keeps the leading ones, and
enumerates the paths from the roots to the leaves with self-joins whose reach doubles: first every
message meets its ancestors 1, 2, 4, ... steps away; then the leaves take the steps in turn, longest
first, so that each distance is reached once.  A path of n messages needs about 2 log2(n) joins and is n
rows, never one value, so neither a long conversation nor a message with very many replies has to
fit into a task.

``conversation_pieces`` formats the paths: each message is a piece of text with its place in the
conversation and, for what the assistant says, the span that counts for the loss.  The template is

    <|im_start|>ROLE, line break, TEXT<|im_end|>, line break

A control mark inside a text gets a backslash, ``<|`` becomes ``<\\|`` and ``<\\|`` becomes ``<\\\\|``,
so no text holds ``<|``, and taking a backslash away gives the text back.  In roles, a line break
becomes ``%0A`` and a percent sign ``%25``.

Edge cases: null roles and texts are empty.  A null tree is a tree of its own.  A reply to a message
that is not there is a root.  Equal scores are ranked by number; a null score is the lowest.  A
message that comes twice counts once, by score, parent, role and text, the highest.  Messages that answer
each other in a ring have no root and no path.  Turns of a conversation with equal or null numbers are
ordered by number (null first), role and text.  Very long texts are single values; other columns
do not matter, whatever they are called; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.llm.common import materialise
from tendero.llm.ordered import running

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


# ---------------------------------------------------------------- template
def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def conversation_pieces(messages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``messages`` (keys, order, role, text; none null) as formatted pieces: position in the
    conversation, piece, its start there, and the span under the loss mask (null outside it).  All places
    are code points from the start of the conversation, whose text is its pieces in order."""
    opened = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    parts = messages.select(*keys, *order, "role", opened.alias("head"), escape(F.col("text")).alias("body"))
    piece = F.concat("head", "body", F.lit(CLOSE + "\n"))
    pieces = parts.withColumns(
        {"piece": piece, "loss_at": F.when(F.col("role") == LOSS_ROLE, F.char_length("head")), "loss_chars": F.char_length("body")}
    ).drop("head", "body", "role")
    placed = running(
        pieces, keys, order, {"position": F.lit(1), "start": F.char_length("piece")}, "conversation-pieces"
    )
    begins = F.col("start") + F.col("loss_at")
    return placed.select(
        *keys, "position", "piece", "start", begins.alias("loss_start"), (begins + F.col("loss_chars")).alias("loss_end")
    )


def read_back(pieces: DataFrame) -> DataFrame:
    """The role and text of each piece, and the text under the loss mask (null where there is none),
    from the formatted text and the mask alone."""
    piece, line_end = F.col("piece"), F.locate("\n", F.col("piece"))
    size = F.char_length(piece)
    masked = F.substring(piece, F.col("loss_start") - F.col("start") + 1, F.col("loss_end") - F.col("loss_start"))
    body = F.substring(piece, line_end + 1, size - line_end - F.lit(len(CLOSE) + 1))
    return pieces.withColumns(
        {
            "role": unescape_role(F.substring(piece, F.lit(len(OPEN) + 1), line_end - F.lit(len(OPEN) + 1))),
            "text": unescape(body),
            "loss_text": unescape(masked),
        }
    )


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Per conversation: its turns, the hash of them, what is under the loss mask, and its length, read
    back from the formatted pieces.  A hash runs through its input in order, so a conversation is read by one task,
    piece by piece: its memory does not grow with the conversation.  ``keys`` are texts."""
    read = read_back(pieces).select(
        *keys, "position", "role", "text", "loss_text", F.char_length("piece").alias("chars")
    )
    names = [*keys, *[field.split()[0] for field in DIGESTS.split(", ")]]
    schema = ", ".join([*[f"{k} string" for k in keys], DIGESTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = turns = loss = None
        counts = [0, 0, 0]
        done: list[tuple] = []

        def result() -> tuple:
            return (*current, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [*[pa.string()] * len(keys), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in (*keys, "role", "text", "loss_text", "chars")]
            for *key, role, text, masked, chars in zip(*columns):
                if key != current:
                    if current is not None:
                        done.append(result())
                    current, turns, loss, counts = key, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                turns.update(f"{role}\n{text}\n".encode())
                loss.update((masked or "").encode())
                counts[0] += 1
                counts[1] += len(masked or "")
                counts[2] += chars
            if done:
                yield batch_of(done)
                done = []
        if current is not None:
            yield batch_of([result()])

    return read.repartition(*keys).sortWithinPartitions(*keys, "position").mapInArrow(run, schema)


# ---------------------------------------------------------------- paths
def reply_paths(nodes: DataFrame, branches: int | None = 1, purpose: str = "reply-paths") -> DataFrame:
    """``nodes``: tree, node, parent (null: a root), score; (tree, node) unique, neither null.  Gives
    (tree, path, steps, node): ``path`` is the leaf's number and ``steps`` the distance from it.

    Of the replies to a message, the ``branches`` with the highest scores are kept (None: all), so
    with 1 each root begins one path, through the best reply to each message.  All roots are kept."""
    nodes = materialise(nodes.select("tree", "node", "parent", "score"), f"{purpose}-nodes")
    there = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    replies = nodes.filter("parent IS NOT NULL").join(there, ["tree", "parent"], "left")
    roots = nodes.filter("parent IS NULL").select("tree", "node").unionByName(
        replies.filter("there IS NULL").select("tree", "node")
    )
    replies = replies.filter("there")
    if branches is not None:
        # Spark keeps the leading rows of each group before it shuffles: no message is too popular.
        ranked = Window.partitionBy("tree", "parent").orderBy(F.col("score").desc_nulls_last(), "node")
        replies = replies.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= branches)
    hop = materialise(replies.select("tree", "node", F.col("parent").alias("up")), f"{purpose}-1")
    most, hops = nodes.count(), []
    while not hop.isEmpty() and 2 ** len(hops) <= most:
        hops.append(hop)
        onward = hop.select("tree", F.col("node").alias("up"), F.col("up").alias("further"))
        hop = materialise(
            hop.join(onward, ["tree", "up"]).select("tree", "node", F.col("further").alias("up")), f"{purpose}-{2 ** len(hops)}"
        )
    # Whoever still has an ancestor that far away hangs below a ring.
    answered = hops[0].select("tree", F.col("up").alias("node")).distinct() if hops else None
    kept = roots if not hops else roots.unionByName(hops[0].select("tree", "node"))
    leaves = kept if answered is None else kept.join(answered, ["tree", "node"], "left_anti")
    leaves = leaves.join(hop.select("tree", "node"), ["tree", "node"], "left_anti")
    found = leaves.select("tree", F.col("node").alias("path"), F.lit(0).cast("long").alias("steps"), "node")
    for k in reversed(range(len(hops))):
        found = materialise(found, f"{purpose}-from-{k}")
        found = found.unionByName(
            found.join(hops[k], ["tree", "node"]).select(
                "tree", "path", (F.col("steps") + 2**k).alias("steps"), F.col("up").alias("node")
            )
        )
    if branches is None or not hops:
        return found
    # Below a reply that was cut off, paths do not reach a root.
    found = materialise(found, f"{purpose}-found")
    begun = found.join(roots, ["tree", "node"], "left_semi").select("tree", "path")
    return found.join(begun, ["tree", "path"], "left_semi")


def format_replies(rows: DataFrame, branches: int | None = 1) -> DataFrame:
    """Reply trees (tree_id, node_id, parent_id, role, text, score) as formatted conversations: tree_id
    and path_id (the number of the last message, as text) and the columns of
    ``conversation_pieces``."""
    newest = F.max(F.struct("score", F.col("parent_id").alias("parent"), "role", "text")).alias("row")
    empty = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    messages = (
        rows.filter("node_id IS NOT NULL")
        .select(_tree(F.col("tree_id")).alias("tree"), F.col("node_id").alias("node"), "parent_id", *empty, "score")
        .groupBy("tree", "node")
        .agg(newest)
        .select("tree", "node", "row.*")
    )
    messages = materialise(messages, "reply-messages")
    paths = reply_paths(messages, branches)
    pieces = _formatted(messages, paths)
    return pieces.withColumn("tree_id", _tree_id("tree")).withColumnRenamed("path", "path_id").drop("tree")


def _tree(column: Column) -> Column:
    """A text in place of the number: null is a tree as well."""
    return F.coalesce(F.concat(F.lit("t"), column.cast("string")), F.lit("-"))


def _tree_id(column: str) -> Column:
    return F.when(F.col(column) != "-", F.substring(column, 2, 2**31 - 1)).cast("long")


def _formatted(messages: DataFrame, paths: DataFrame) -> DataFrame:
    told = paths.join(messages.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree", F.col("path").cast("string").alias("path"), (-F.col("steps")).alias("nth"), "role", "text"
    )
    return conversation_pieces(told, ["tree", "path"], ["nth"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as reply trees without a fork: each turn answers the
    one before it.  Gives the pieces, with ``tree`` and ``path``."""
    empty = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.select(_tree(F.col("conv_id")).alias("tree"), F.col("turn").cast("long").alias("turn"), *empty)
    numbered = running(rows, ["tree"], ["turn", "role", "text"], {"node": F.lit(1)}, "conversation-turns")
    messages = materialise(
        numbered.select(
            "tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"),
            F.lit(None).cast("double").alias("score"), "role", "text",
        ),
        "conversation-messages",
    )
    return _formatted(messages, reply_paths(messages))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Format ``conversations`` and read the result back, a row for each conversation."""
    found = digests(format_conversations(turns), ["tree", "path"])
    return found.select(_tree_id("tree").alias("conv_id"), *[f.split()[0] for f in DIGESTS.split(", ")])
