"""Sharding by best-fit decreasing bin packing.

Indivisible groups (equal texts) go in descending size into the shard with the least room that
still takes them.  Groups of one size are alike, so the packing runs over a histogram of group
sizes: different sizes d need at least d * d / 2 bytes of text, which bounds what the driver
holds by the square root of the input.  Groups then take their place by joining on their rank
within their size.

Edge cases: a null text counts as empty (size 1); repeated rows each take a slot; a null doc_id
keeps its row; a group larger than a fair share has a shard to itself; an empty table gives an
empty result; columns other than doc_id and text do not matter."""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import materialise, slots, texts


class Rooms:
    """Shards by the room left, in a balanced (randomised) search tree."""

    def __init__(self):
        self.root = None
        self.random = random.Random(1)

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[2], rest = self._split(node[2], key)
            return node, rest
        less, node[1] = self._split(node[1], key)
        return less, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[3] < b[3]:
            a[2] = self._merge(a[2], b)
            return a
        b[1] = self._merge(a, b[1])
        return b

    def add(self, room: int, shard: int) -> None:
        less, rest = self._split(self.root, (room, shard))
        self.root = self._merge(self._merge(less, [(room, shard), None, None, self.random.random()]), rest)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and give the shard with the least room of at least ``size``."""
        less, rest = self._split(self.root, (size, -1))
        found = rest
        if found is None:
            self.root = less
            return None
        while found[1] is not None:
            found = found[1]
        _, rest = self._split(rest, (found[0][0], found[0][1] + 1))
        self.root = self._merge(less, rest)
        return found[0]


def best_fit_decreasing(
    sizes: Iterable[tuple[int, int]], capacity: int, most: int | None = None
) -> tuple[int, list[tuple[int, int, int, int]]] | None:
    """Pack (size, count) into shards of a capacity: how many, and slots (size, rank from, rank to,
    shard).  None if more than ``most`` shards would be needed.  Groups above the capacity get
    shards of their own."""
    rooms, used, plan = Rooms(), 0, []
    for size, count in sorted(sizes, reverse=True):
        rank = 0
        while rank < count:
            found = rooms.take(size)
            if found is None:
                if most is not None and used >= most:
                    return None
                found = max(capacity, size), used
                used += 1
            room, shard = found
            put = min(count - rank, room // size)
            plan.append((size, rank, rank + put, shard))
            rooms.add(room - put * size, shard)
            rank += put
    return used, plan


def even_plan(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Slots for a given number of shards of nearly equal size: the smallest capacity (to a
    hundred-thousandth) that they keep to.  Groups above a fair share of the rest stand alone."""
    left, alone = dict(sizes), []
    total = sum(size * count for size, count in sizes)
    number = shards
    for size in sorted(left, reverse=True):
        while number > 1 and left[size] and size * number > total:
            alone.append((size, len([a for a in alone if a[0] == size]), shards - number))
            left[size] -= 1
            total -= size
            number -= 1
    rest = [(size, count) for size, count in left.items() if count]
    if not rest:
        return [(size, rank, rank + 1, shard) for size, rank, shard in alone]
    low = max(-(-total // number), max(size for size, _ in rest))
    step, high = max(1, low // 100_000), low
    found = best_fit_decreasing(rest, high, number)
    while found is None:
        low, high = high + 1, high + step
        step *= 2
        found = best_fit_decreasing(rest, high, number)
    while high - low > max(0, high // 100_000):
        middle = (low + high) // 2
        tried = best_fit_decreasing(rest, middle, number)
        if tried is None:
            low = middle + 1
        else:
            high, found = middle, tried
    skipped = {size: len([a for a in alone if a[0] == size]) for size, _, _ in alone}
    moved = [
        (size, a + skipped.get(size, 0), b + skipped.get(size, 0), shard + shards - number) for size, a, b, shard in found[1]
    ]
    return [(size, rank, rank + 1, shard) for size, rank, shard in alone] + moved


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32, and the group: a digest of the text."""
    return texts(docs).select(
        "doc_id",
        (F.octet_length("text").cast("long") + 1).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
    )


def best_fit_sharding(docs: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, shard and its slot there, gapless from 0.

    With ``capacity``: as few shards of that many bytes as best fit finds.  With ``shards``: that many
    of nearly equal size."""
    if (shards is None) == (capacity is None):
        raise ValueError("give either the number of shards or their capacity")
    rows = materialise(measured(docs), "shard-rows")
    groups = materialise(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    sizes = [tuple(r) for r in groups.groupBy("bytes").count().toLocalIterator()]
    plan = even_plan(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)[1]
    by_size: dict[int, list] = {}
    for size, *slot in plan:
        by_size.setdefault(size, []).append(tuple(slot))
    planned = docs.sparkSession.createDataFrame(
        list(by_size.items()), "bytes long, slots array<struct<low:long,high:long,shard:int>>"
    )
    ranked = slots(groups, ["bytes"], ["digest"], "rank", buckets=64)
    slot = F.filter("slots", lambda s: (s.low <= F.col("rank")) & (F.col("rank") < s.high))[0]
    placed = ranked.join(planned, "bytes").select("digest", slot.shard.alias("shard"))
    dealt = materialise(rows.join(placed, "digest"), "shard-dealt")
    return slots(dealt, ["shard"], ["doc_id", "digest"], "slot").select("doc_id", "size", "text_crc32", "shard", "slot")
