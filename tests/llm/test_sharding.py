from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

from tendero.llm import sharding
from tests.llm.conftest import EDGES, prose, rows_of


def test_rooms_give_the_tightest():
    rng, rooms, held = random.Random(1), sharding.Rooms(), set()
    for shard in range(300):
        room = rng.randint(0, 50)
        rooms.add(room, shard)
        held.add((room, shard))
        if rng.random() < 0.5:
            size = rng.randint(0, 60)
            want = min((x for x in held if x[0] >= size), default=None)
            assert rooms.take(size) == want
            held.discard(want)


def test_best_fit_decreasing_against_one_by_one():
    rng = random.Random(2)
    for _ in range(60):
        sizes = Counter(rng.randint(1, 30) for _ in range(rng.randint(1, 60)))
        used, plan = sharding.best_fit_decreasing(sizes.items(), 30)
        bins = []
        for size in sorted(sizes.elements(), reverse=True):
            fits = [k for k, room in enumerate(bins) if room >= size]
            if fits:
                bins[min(fits, key=lambda k: bins[k])] -= size
            else:
                bins.append(30 - size)
        assert used == len(bins)
        load = Counter()
        for size, low, high, shard in plan:
            load[shard] += size * (high - low)
        assert max(load.values()) <= 30 and sum(load.values()) == sum(s * n for s, n in sizes.items())


def test_even_shards_stay_together_and_even(corpus):
    rng = random.Random(3)
    rows = [(k, prose(rng, rng.randint(1, 40))) for k in range(500)]
    rows += [(1000 + k, "copies of one text") for k in range(60)] + [r for r in EDGES if len(r[1] or "") < 1000]
    found = rows_of(sharding.best_fit_sharding(corpus(rows, clashing=True), shards=8))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    shards = {}
    for r in found:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    load, slots = Counter(), {}
    for r in found:
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(load) == set(range(8)) and max(load.values()) <= 1.02 * min(load.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_group_above_its_share_stands_alone():
    plan = sharding.even_plan([(1000, 1), (7, 100), (3, 50)], 8)
    load = Counter()
    for size, low, high, shard in plan:
        load[shard] += size * (high - low)
    assert sorted(load.values())[-1] == 1000 and max(sorted(load.values())[:-1]) <= 126


def test_fixed_capacity_and_empty_table(corpus):
    found = rows_of(sharding.best_fit_sharding(corpus(EDGES), capacity=150_000))
    load = Counter()
    for r in found:
        load[r["shard"]] += r["size"]
    assert sorted(load.values(), reverse=True)[0] == 360_001 and len(load) == 2
    assert sharding.best_fit_sharding(corpus([]), shards=8).count() == 0
    with pytest.raises(ValueError):
        sharding.best_fit_sharding(corpus([]))
