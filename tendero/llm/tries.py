"""The prefix trie of conversations: what a cache of shared beginnings would save.

Each distinct beginning of d turns (role and text) is a node at depth d; the conversations that
begin so are its members.  A conversation is a row of turn ids, cut into blocks of ``width`` turns; a block knows
the beginning before it by an id of its own.  Equal blocks after equal beginnings fold into one row with a
count, so copies of a conversation cost nothing.  The rows are sorted into range shards.  A shard, with the last
row of the shard before and the first row of the one behind, is a padded matrix: ``lexsort`` orders it, the
columns in which a row differs from the one before are OR-accumulated from left to right, so that the
marks of a column are where nodes of that depth start, and ``reduceat`` sums each depth.  Nodes that go on
beyond the border of a shard or of a block come out in parts, which are added up by their ids.

Sums over a subtree need no second tree: each node is counted at the row it starts in, and every node above
has that row among its own.  What starts in later blocks of a conversation is summed first, from
the last block to the first.

A shard holds about ``SHARD_ROWS`` rows of at most ``width`` turns, whatever the data; a very long conversation
is many rows, a very common one is one row, a very common beginning lies in many shards.

Edge cases: a null role or text is empty; equal or null turn numbers are ordered by number (null
first), role, text; a turn that comes twice is two turns.  Rows without conv_id belong to no
conversation and are left out.  A conversation that is left without turns is a member of the root alone.
Other columns do not matter, whatever they are called.  An empty table has no nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.llm.common import materialise
from tendero.llm.ordered import running

SHARD_ROWS = 32_768
WIDTH = 64
#: Ids are pairs of remainders by this number; the id of a beginning is the sum of those of its turns.
SPACE = 2**60
#: The contract of the query: how many of the first turns come from which other conversation.
SHARED_TURNS, FAMILY = 9, 5


# ---------------------------------------------------------------- conversations as blocks of turn ids
def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv, pos, x, y, size): the place of each turn from 0, 120 bits of its content, the bytes of
    its text."""
    empty = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), *empty
    )
    numbered = running(rows, ["conv"], ["turn", "role", "text"], {"pos": F.lit(1)}, "trie-turns")
    content = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))
    halves = [F.conv(F.substring(content, at, 15), 16, 10).cast("long") for at in (1, 16)]
    return numbered.select(
        "conv", "pos", halves[0].alias("x"), halves[1].alias("y"), F.octet_length("text").cast("long").alias("size")
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation c anew: the first h turns of conversation c - c % 5, then its own turns after the
    first h, with h = crc32(c) % 9.  Gives the turns (as ``turn_ids``) and (conv, length)."""
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv").cast("string")) % SHARED_TURNS
    family = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    family = (
        family.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left")
        .withColumn("taken", taken)
        .select("conv", "h", "base", "taken", (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("taken")).alias("length"))
    )
    family = materialise(family, "trie-family")
    own = turns.join(family, "conv").filter(F.col("pos") >= F.col("h")).select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "x", "y", "size"
    )
    begun = turns.filter(F.col("pos") < SHARED_TURNS).withColumnRenamed("conv", "base")
    shared = family.select("conv", "base", "taken").join(begun, "base").filter(F.col("pos") < F.col("taken"))
    return own.unionByName(shared.select("conv", "pos", "x", "y", "size")), family.select("conv", "length")


def blocks_of(turns: DataFrame, lengths: DataFrame, width: int) -> DataFrame:
    """(conv, length, block, p, q, ids, sizes, sum_p, sum_q): the turns of each block, and the id (p, q) of
    what is before it.  A conversation without turns is one empty block."""
    # An id holds for a place: the sum of ids tells the order as well.
    placed = turns.select(
        "conv", "pos", "size", F.expr(f"pos div {width}").alias("block"),
        F.pmod(F.xxhash64("pos", "x"), F.lit(SPACE)).alias("a"), F.pmod(F.xxhash64("y", "pos"), F.lit(SPACE)).alias("b"),
    )
    rows = placed.groupBy("conv", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("turns"),
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(f"sum_{name}") for c, name in (("a", "p"), ("b", "q"))],
    )
    rows = rows.select(
        "conv", "block", "sum_p", "sum_q",
        F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"]))).alias("ids"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )
    none, zero = F.array().cast("array<long>"), F.lit(0).cast("decimal(38,0)")
    rows = materialise(
        lengths.join(rows, "conv", "left").select(
            "conv", "length", F.coalesce("block", F.lit(0)).cast("long").alias("block"),
            *[F.coalesce(F.col(c), none).alias(c) for c in ("ids", "sizes")],
            *[F.coalesce(F.col(c), zero).alias(c) for c in ("sum_p", "sum_q")],
        ),
        "trie-blocks",
    )
    short = rows.filter(F.col("length") <= width)
    first = F.lit(0).cast("long")
    long = rows.filter(F.col("length") > width)
    long = running(long, ["conv"], ["block"], {"p": F.col("sum_p"), "q": F.col("sum_q")}, "trie-begins", modulus=SPACE)
    return short.withColumns({"p": first, "q": first}).unionByName(long)


# ---------------------------------------------------------------- shards
PARTIAL = (
    "depth long, a long, b long, up_a long, up_b long, open boolean, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long"
)
STARTED = "conv long, block long, saved long, leaves long"


class Shard:
    """The padded matrix of a shard's rows in order; the neighbours' rows stand first and last."""

    def __init__(self, table: pa.Table):
        column = {n: table.column(n).combine_chunks() for n in table.column_names}
        values = {n: column[n].to_numpy(zero_copy_only=False) for n in column if n not in ("ids", "sizes")}
        ids = column["ids"]
        lengths = (np.asarray(ids.offsets)[1:] - np.asarray(ids.offsets)[:-1]) // 2
        pairs = np.asarray(ids.flatten()).reshape(-1, 2)
        rows, self.width = len(lengths), int(lengths.max(initial=0))
        at = np.repeat(np.arange(rows), lengths), np.arange(len(pairs)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        matrix = np.full((rows, self.width), -1)
        if len(pairs):
            matrix[at] = np.unique(pairs, axis=0, return_inverse=True)[1].reshape(-1)
        begun = np.stack([values[n] for n in ("block", "p", "q")], axis=1)
        group = np.unique(begun, axis=0, return_inverse=True)[1].reshape(-1)
        order = np.lexsort((*matrix.T[::-1], group))
        matrix, group, self.length = matrix[order], group[order], lengths[order]
        # marks[i, d]: row i differs from the row before within its first d turns.
        marks = np.ones((rows, self.width + 1), bool)
        marks[1:, 0] = group[1:] != group[:-1]
        marks[1:, 1:] = matrix[1:] != matrix[:-1]
        self.marks = np.logical_or.accumulate(marks, axis=1)
        self.common = (~self.marks).sum(axis=1) - 1  # turns shared with the row before; -1: nothing
        self.value = {n: v[order] for n, v in values.items()}
        self.own = self.value["side"] == 0

        def filled(flat: np.ndarray) -> np.ndarray:
            out = np.zeros((rows, self.width + 1), np.int64)
            out[at[0], at[1] + 1] = flat
            return out[order]

        # What a neighbour's row weighs does not count, only its ids.
        sizes = np.zeros(len(pairs), np.int64)
        sizes[np.repeat(values["side"] == 0, lengths)] = np.asarray(column["sizes"].flatten())
        self.behind = np.zeros((rows, self.width + 2), np.int64)  # bytes of the turns from d on
        self.behind[:, :-1] = np.cumsum(filled(sizes)[:, ::-1], axis=1)[:, ::-1]
        self.key = [(self.value[n][:, None] + np.cumsum(filled(pairs[:, k]), axis=1)) % SPACE for k, n in enumerate("pq")]
        following = np.append(self.common[1:], -1)
        self.leaf = self.own & (self.value["onward"] == 0) & (following < self.length)

    def started(self) -> pa.Table:
        """Per row: what the nodes that start in it save, and whether it ends in a leaf."""
        v, own, rows = self.value, self.own, np.arange(len(self.own))
        saved = v["members"] * self.behind[:, 1] - self.behind[rows, np.maximum(self.common + 1, 1)]
        return pa.table([v["first"][own], v["block"][own], saved[own], self.leaf[own].astype(np.int64)], names=["conv", "block", "saved", "leaves"])

    def nodes(self, width: int) -> pa.Table:
        """The nodes of all depths, those that may have other parts marked as open."""
        v, found = self.value, []
        above = None  # the nodes of the depth above, by row
        for depth in range(self.width + 1):
            rows = np.flatnonzero(self.own & (self.length >= depth))
            if not len(rows):
                break
            starts = self.marks[rows, depth].copy()
            starts[0] = True
            at = np.flatnonzero(starts)
            top = rows[at]
            sums = lambda x: np.add.reduceat(x, at)  # noqa: E731, B023
            block = v["block"][top]
            # The top of a later block is the last node of the block before it, which counts its members.
            top_again = (block > 0) if depth == 0 else np.zeros(len(top), bool)
            begins = np.maximum(np.maximum(self.common[rows] + 1, depth), 1)
            saved = v["members"][rows] * self.behind[rows, max(depth, 1)] - self.behind[rows, begins] + v["later_saved"][rows]
            children = np.zeros(len(rows), np.int64)
            if depth < self.width:
                children = ((self.length[rows] > depth) & self.marks[rows, depth + 1]).astype(np.int64)
            opened = top_again | (sums(v["onward"][rows]) > 0 if depth == width else False)
            opened[0] |= not self.marks[top[0], depth]
            last = rows[-1] + 1
            if last < len(self.own) and self.length[last] >= depth:
                opened[-1] |= not self.marks[last, depth]
            first = np.minimum.reduceat(v["first"][rows], at)
            count = lambda x: np.where(top_again, 0, sums(x))  # noqa: E731, B023
            node_of = np.full(len(self.own), -1)
            node_of[rows] = np.cumsum(starts) - 1
            parent = np.full(len(top), None, object)
            if above is not None:
                known, of_row, parents_open = above
                place = of_row[top]
                parent = np.where(parents_open[place], None, known[place])
            up = max(depth - 1, 0)
            found.append(
                [
                    block * width + depth, self.key[0][top, depth], self.key[1][top, depth],
                    self.key[0][top, up], self.key[1][top, up], opened, first, parent,
                    count(v["members"][rows]), sums(children), count((self.leaf[rows] + v["later_leaves"][rows])), count(saved),
                ]
            )
            above = first, node_of, opened
        names = [f.split()[0] for f in PARTIAL.split(", ")]
        types = [pa.bool_() if n == "open" else pa.int64() for n in names]
        parts = [pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names) for columns in found]
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], t) for t in types], names=names)


def _sharded(blocks: DataFrame, width: int, work: Callable[[Shard], pa.Table], schema: str, purpose: str) -> DataFrame:
    """Fold equal rows, deal them into range shards and run ``work`` on each with its neighbours' rows."""
    keys = ["block", "p", "q", "ids"]
    onward = F.when((F.col("block") + 1) * width < F.col("length"), 1).otherwise(0)
    sums = {"members": F.lit(1), "onward": onward, "later_saved": F.col("later_saved"), "later_leaves": F.col("later_leaves")}
    folded = blocks.groupBy(*keys).agg(
        F.first("sizes").alias("sizes"), F.min("conv").alias("first"),
        *[F.sum(x).cast("long").alias(name) for name, x in sums.items()],
    )
    folded = materialise(folded, f"{purpose}-folded")
    parts = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-folded.count() // SHARD_ROWS))
    sharded = materialise(
        folded.repartitionByRange(parts, *keys).withColumns({"shard": F.spark_partition_id(), "side": F.lit(0)}),
        f"{purpose}-shards",
    )
    row = F.struct(*keys)
    ends = sharded.groupBy("shard").agg(F.min(row).alias("low"), F.max(row).alias("high"))
    ordered = Window.orderBy("shard")  # a row for each shard
    beside = ends.select("shard", F.lag("high").over(ordered).alias("before"), F.lead("low").over(ordered).alias("behind"))
    zero = F.lit(0).cast("long")
    rest = {"sizes": F.array().cast("array<long>"), "first": zero} | {name: zero for name in sums}
    joined = sharded
    for name, side in (("before", -1), ("behind", 1)):
        neighbour = beside.filter(F.col(name).isNotNull()).select("shard", f"{name}.*", F.lit(side).alias("side"))
        joined = joined.unionByName(neighbour.withColumns(rest))
    return joined.groupBy("shard").applyInArrow(lambda table: work(Shard(table)), schema)


# ---------------------------------------------------------------- the trie
def _ends(blocks: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): the conversations that end in a node.  A hash runs through its input in order:
    one task reads the ids of a node as they come, whatever their number."""
    space = F.lit(SPACE).cast("decimal(38,0)")
    last = blocks.groupBy("conv").agg(
        F.first("length").alias("depth"), *[(F.sum(f"sum_{n}") % space).cast("long").alias(c) for c, n in (("a", "p"), ("b", "q"))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done = None, None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["depth", "a", "b", "ends_sha256"]
            )

        for batch in batches:
            for *key, conv in zip(*[batch.column(n).to_pylist() for n in ("depth", "a", "b", "conv")]):
                if key == current:
                    state.update(f",{conv}".encode())
                    continue
                if current is not None:
                    done.append((*current, state.hexdigest()))
                current, state = key, hashlib.sha256(str(conv).encode())
            if done:
                yield batch_of(done)
                done = []
        if current is not None:
            yield batch_of([(*current, state.hexdigest())])

    ordered = last.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "conv")
    return ordered.select("depth", "a", "b", "conv").mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def _with_later(blocks: DataFrame, width: int) -> DataFrame:
    """To each block, what starts in the later blocks of its conversation."""
    long = blocks.filter(F.col("length") > width)
    zero: dict[str, Column] = {"later_saved": F.lit(0).cast("long"), "later_leaves": F.lit(0).cast("long")}
    if long.isEmpty():
        return blocks.withColumns(zero)
    long = materialise(long, "trie-long")
    tails = long.filter("block > 0").withColumns(zero)
    started = _sharded(tails, width, lambda shard: shard.started(), STARTED, "trie-tails")
    started = started.groupBy("conv", "block").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    own = long.join(started, ["conv", "block"], "left").withColumn("nth", -F.col("block"))
    sums = {"later_saved": F.coalesce("saved", F.lit(0)), "later_leaves": F.coalesce("leaves", F.lit(0))}
    summed = running(own, ["conv"], ["nth"], sums, "trie-later").select(*blocks.columns, *sums)
    return blocks.filter(F.col("length") <= width).withColumns(zero).unionByName(summed)


def prefix_trie(turns: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """Turns (as ``turn_ids``) and (conv, length) of all conversations: a row for each node."""
    blocks = materialise(blocks_of(turns, lengths, width), "trie-placed")
    parts = _sharded(_with_later(blocks, width), width, lambda shard: shard.nodes(width), PARTIAL, "trie")
    parts = materialise(parts, "trie-parts")
    node = ["depth", "a", "b"]
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    opened = parts.filter("open").groupBy(*node).agg(
        # The top of a later block names no parent: the node's other part does.
        F.max_by("up_a", "n_convs").alias("up_a"), F.max_by("up_b", "n_convs").alias("up_b"),
        F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in counts],
    )
    opened = materialise(opened, "trie-open")
    nodes = parts.filter("NOT open").drop("open").unionByName(opened)
    orphan = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    parents = opened.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("above")
    )
    adopted = nodes.filter(orphan).join(parents, ["depth", "up_a", "up_b"], "left").withColumn("parent_conv_id", F.col("above"))
    nodes = nodes.filter(~orphan).unionByName(adopted.drop("above"))
    return nodes.join(_ends(blocks), node, "left").select(
        "conv_id", "depth", "parent_conv_id", *counts, F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    )


def conversation_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of the rebuilt conversations (conv_id, turn, role, text)."""
    return prefix_trie(*rebuilt(turn_ids(conversations)), width)
