"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Each benchmark item is cut into overlapping segments: of 100 characters, and of 13 words (at most 100
characters) from every word and at least every tenth character on.  So a copied quote of 13 whole words,
or of 109 characters, holds a whole segment, wherever it begins.  A place in a text that equals a segment of
length m but for e edits shares at least ``m + 1 - q - q * e`` character q-grams with it, and these
lie within e + 1 neighbouring diagonals.  So hits are counted in overlapping diagonal bands, first for
whole items, then for the segments of those that have enough for one; regions below the bound are passed
over without loss, and the others are verified by banded alignment.

The benchmark is a stated query set: it is read in blocks of at most ``block_chars`` characters, each
of which goes to all texts as one broadcast of bounded size.  The texts are never shuffled.

Letters are compared in lower case and each run of white space as one space.  Items shorter than q match as
they are; they are reported anywhere, but drop a document only where they stand as whole words.  Edge cases: null or empty texts and items match nothing; repeated rows are reported each;
a null doc_id or item_id stays null; an empty table gives an empty result; extra columns do not matter."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tendero.llm.common import BATCH_ROWS, map_batches, texts

BLANKS = re.compile(r"\s+")
NOT_ONE_SPACE = re.compile(r"\s{2,}|[^\S ]")  # what changes when each run of white space becomes a space
WORD = re.compile(r"\S+")
STEP = np.uint64(0x9E3779B97F4A7C15)  # an odd multiplier for rolling hashes


@dataclass(frozen=True)
class Budget:
    """q-gram length, segment length, edits allowed per hundred characters, the words of a short
    segment, and the most characters between the beginnings of two of them."""

    q: int = 10
    segment: int = 100
    edits: int = 8
    words: int = 13
    step: int = 10

    def allowed(self, length: int) -> int:
        """Never so many that the lemma's bound would fall below one shared q-gram."""
        return max(0, min(length * self.edits // 100, (length - self.q) // self.q))


def plain(text: str) -> str:
    """Lower case, and one blank for each run of white space."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    return NOT_ONE_SPACE.sub(" ", lower)


def places(text: str) -> np.ndarray:
    """Where the characters of ``plain(text)`` are in the text."""
    kept = np.ones(len(text), bool)
    for run in BLANKS.finditer(text):
        kept[run.start() + 1 : run.end()] = False
    return np.flatnonzero(kept)


def quotes(text: str, budget: Budget) -> list[tuple[int, int]]:
    """(start, end) of the short segments, both ascending."""
    words = [(w.start(), w.end()) for w in WORD.finditer(text)]
    found = []
    for k, (a, b) in enumerate(words):
        last = min(k + budget.words, len(words)) - 1
        for start in range(a, b, budget.step):
            end = min(words[last][1], start + budget.segment)
            if end == start + budget.segment or last - k + 1 == budget.words:
                found.append((start, end))
    return found


def hashes(text: str, q: int) -> np.ndarray:
    """A hash of the q characters from each position on."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if len(x) < q:
        return np.zeros(0, np.uint64)
    power, size, found, at = int(STEP), 1, None, 0
    n = len(x) - q + 1
    while True:  # put spans of 1, 2, 4, ... characters together as the bits of q say
        if q & size:
            part = x[at : at + n]
            found = part.copy() if found is None else found * np.uint64(power) + part
            at += size
        if size * 2 > q:
            break
        x = x[:-size] * np.uint64(power) + x[size:]
        power, size = power * power % 2**64, size * 2
    return found ^ (found >> np.uint64(29))


@dataclass
class Index:
    """The q-grams of a block's segments: sorted hashes, and for each its segments and places."""

    budget: Budget
    items: list = field(default_factory=list)
    segments: list[tuple[int, int, str]] = field(default_factory=list)  # item, start in it, text
    short: list[tuple[int, str]] = field(default_factory=list)
    held: list[str] = field(default_factory=list)  # texts of the items, until the index is closed
    kinds: tuple[list[int], list[int]] = field(default_factory=lambda: ([], []))  # long and short segments

    def add(self, item, text: str) -> None:
        text, b = plain(text).strip(), self.budget
        self.items.append(item)
        number = len(self.items) - 1
        self.held.append(text if len(text) >= b.q else "")
        if len(text) < b.q:
            if text:
                self.short.append((number, text))
            return
        last = max(0, len(text) - b.segment)
        long = [(start, start + b.segment) for start in sorted({*range(0, last, b.segment // 2), last})]
        for kind, spans in zip(self.kinds, (long, quotes(text, b)), strict=True):
            for start, end in spans:
                kind.append(len(self.segments))
                self.segments.append((number, start, text[start:end]))

    def close(self) -> Index:
        q = self.budget.q
        grams = [hashes(t, q) for t in self.held]
        sizes = np.array([len(g) for g in grams], np.int64)
        before = np.cumsum(sizes) - sizes
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.gram = np.argsort(every, kind="stable")  # its number among the q-grams of all items
        self.item = np.repeat(np.arange(len(grams)), sizes)[self.gram]
        self.place = self.gram - before[self.item]
        self.keys, self.first, self.count = np.unique(every[self.gram], return_index=True, return_counts=True)
        bits = max(16, int(len(self.keys) * 64).bit_length())
        self.shift = np.uint64(64 - min(bits, 24))
        self.maybe = np.zeros(1 << int(64 - self.shift), bool)
        self.maybe[(self.keys * STEP) >> self.shift] = True
        self.lengths = np.array([len(s) for _, _, s in self.segments], np.int64)
        self.allowed = np.array([self.budget.allowed(n) for n in self.lengths], np.int64)
        self.least = self.lengths + 1 - q - q * self.allowed
        owner = np.array([item for item, _, _ in self.segments], np.int64)
        self.fewest = np.full(len(grams), np.iinfo(np.int64).max)
        np.minimum.at(self.fewest, owner, self.least)
        # Of each kind: its segments, and the numbers of the first and last q-gram of each.
        starts = np.array([start for _, start, _ in self.segments], np.int64) + before[owner]
        self.ranges = [(k, starts[k], starts[k] + self.lengths[k] - q) for k in (np.array(x, np.int64) for x in self.kinds)]
        self.shifted = int(sizes.max(initial=0))
        self.held = []
        # Bands overlap by the edits of any segment, so that an alignment lies whole in one of them.
        self.overlap = int(self.allowed.max(initial=0)) + 1
        self.width = 2 * self.overlap
        return self


def regions(index: Index, text: str) -> np.ndarray:
    """(segment, band) of every region that meets the lemma's bound.  Band b holds the diagonals
    (place in the text less place in the item, never negative by ``shifted``) from b * width on,
    width + overlap of them."""
    none = np.zeros((0, 2), np.int64)
    found = hashes(text, index.budget.q)
    at = np.flatnonzero(index.maybe[(found * STEP) >> index.shift])
    if not len(at):
        return none
    key = np.searchsorted(index.keys, found[at])
    key[key == len(index.keys)] = 0
    own = index.keys[key] == found[at]
    at, key = at[own], key[own]
    if len(at) < max(1, int(index.least.min(initial=1))):
        return none
    count = index.count[key]
    at = np.repeat(at, count)
    post = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(index.first[key], count)
    diagonal = at - index.place[post] + index.shifted
    band = diagonal // index.width
    before = (diagonal % index.width < index.overlap) & (band > 0)
    post, bands = np.concatenate([post, post[before]]), np.concatenate([band, band[before] - 1])
    most = int(bands.max()) + 1
    group = index.item[post] * most + bands
    groups, hits = np.unique(group, return_counts=True)
    groups = groups[hits >= index.fewest[groups // most]]
    if not len(groups):
        return none
    near = np.isin(group, groups)
    gram, bands = index.gram[post[near]], bands[near]
    counted = []
    for kind, first, last in index.ranges:
        low = np.searchsorted(last, gram)
        n = np.maximum(np.searchsorted(first, gram, "right") - low, 0)
        held = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        counted.append(kind[held] * most + np.repeat(bands, n))
    pairs, hits = np.unique(np.concatenate(counted), return_counts=True)
    enough = hits >= index.least[pairs // most]
    return np.stack([pairs[enough] // most, pairs[enough] % most], axis=1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def banded_alignments(
    wanted: list[tuple[str, int, int, int]], text: str, rows: int = 2048
) -> list[tuple[int, int] | None]:
    """For each (segment, low, high, most): the fewest edits (at most ``most``) that turn the segment into a
    part of the text, and where this part ends, over diagonals from ``low`` to ``high``.  The segments go
    through their characters together, ``rows`` of them at a time."""
    codes, found = _codes(text), []
    for at in range(0, len(wanted), rows):
        found += _aligned(wanted[at : at + rows], codes)
    return found


def _aligned(wanted: list[tuple[str, int, int, int]], codes: np.ndarray) -> list[tuple[int, int] | None]:
    segments = [_codes(s) for s, *_ in wanted]
    low, high, most = (np.array(x, np.int64) for x in zip(*[w[1:] for w in wanted], strict=True))
    low = low - most
    width = high + most - low + 1
    length = np.array([len(s) for s in segments], np.int64)
    columns, longest = int(width.max()), int(length.max())
    own = np.zeros((len(wanted), longest), np.uint32)
    for row, segment in zip(own, segments, strict=True):
        row[: len(segment)] = segment
    places = low[:, None] + np.arange(longest + columns)  # the text from place ``low`` on; 0 outside it
    inside = (places >= 0) & (places < len(codes))
    padded = np.zeros(places.shape, np.uint32)
    padded[inside] = codes[places[inside]]
    steps = np.arange(columns, dtype=np.int32)
    outside = steps >= width[:, None]
    far = (most + 1).astype(np.int32)[:, None]
    cost = np.where(outside, far, 0).astype(np.int32)  # the part may begin anywhere
    found: list[tuple[int, int] | None] = [None] * len(wanted)
    live = np.flatnonzero((np.maximum(low, 0) < np.minimum(len(codes), low + length + width)) & (length > 0))
    for j in range(longest):
        if not len(live):
            break
        limit, now = far[live], cost[live]
        after = now + (padded[live, j : j + columns] != own[live, j : j + 1])
        np.minimum(after[:, :-1], now[:, 1:] + 1, out=after[:, :-1])
        np.minimum(after[:, -1:], limit + 1, out=after[:, -1:])
        now = np.minimum(np.minimum.accumulate(after - steps, axis=1) + steps, limit)
        now[outside[live]] = np.broadcast_to(limit, now.shape)[outside[live]]
        cost[live] = now
        near = now.min(axis=1) < limit[:, 0]
        ended = length[live] == j + 1
        for row in live[near & ended].tolist():
            k = int(cost[row].argmin())
            found[row] = int(cost[row, k]), min(len(codes), int(low[row]) + k + j + 1)
        live = live[near & ~ended]
    return found


def banded_alignment(segment: str, text: str, low: int, high: int, most: int) -> tuple[int, int] | None:
    return banded_alignments([(segment, low, high, most)], text)[0]


def matches(index: Index, text: str, whole_words: bool = False) -> list[tuple[int, int, int, int, int]]:
    """(item number, start, end, edits, segments) of each item of which a text holds a segment; start
    and end span all its segments, edits are the fewest of one segment.  With ``whole_words``, items
    shorter than q match at word borders only."""
    given, text = text, plain(text)
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    done: set[tuple[int, int]] = set()

    def hold(s: int, hit: tuple[int, int] | None) -> None:
        if hit and (s, hit[1]) not in done:
            done.add((s, hit[1]))
            item, _, segment = index.segments[s]
            found[item].append((max(0, hit[1] - len(segment)), hit[1], hit[0]))

    edited = []
    for s, band in regions(index, text).tolist():
        _, place, segment = index.segments[s]
        low = band * index.width - index.shifted + place
        high = low + index.width + index.overlap
        most = int(index.allowed[s])
        start = text.find(segment, max(0, low - most), max(0, high + most) + len(segment))
        if start >= 0:
            hold(s, (0, start + len(segment)))
        else:
            edited.append((s, (segment, low, high, most)))
    for (s, _), hit in zip(edited, banded_alignments([x for _, x in edited], text), strict=True):
        hold(s, hit)
    for item, short in index.short:
        start = text.find(short)
        if start >= 0 and whole_words:
            whole = re.search(rf"(?<!\w){re.escape(short)}(?!\w)", text)
            start = whole.start() if whole else -1
        if start >= 0:
            found[item].append((start, start + len(short), 0))
    if found and len(text) != len(given):
        at = places(given)
        for hits in found.values():
            hits[:] = [(int(at[a]), int(at[b - 1]) + 1, e) for a, b, e in hits]
    return [
        (item, min(h[0] for h in hits), max(h[1] for h in hits), min(h[2] for h in hits), len(hits))
        for item, hits in sorted(found.items())
    ]


def blocks(benchmark: DataFrame, budget: Budget, block_chars: int) -> Iterator[Index]:
    """Indexes of bounded size; a single item longer than a block is a block of its own."""
    index, held = Index(budget), 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        if held and held + len(row.text) > block_chars:
            yield index.close()
            index, held = Index(budget), 0
        index.add(row.item_id, row.text)
        held += len(row.text)
    yield index.close()


FOUND = "doc_id long, item_id long, start long, end long, edits int, segments int"


def contamination(
    docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), block_chars: int = 1_000_000  # noqa: B008
) -> DataFrame:
    """One row for each document and benchmark item of which it holds a segment."""
    context = docs.sparkSession.sparkContext
    result = None
    for index in blocks(benchmark, budget, block_chars):
        shared = context.broadcast(index)

        def make(shared=shared):
            def work(batch: pa.RecordBatch) -> dict:
                index = shared.value
                rows = [
                    (doc, index.items[item], *rest)
                    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    for item, *rest in matches(index, text)
                ]
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2
                columns = zip(*rows, strict=True) if rows else [()] * 6
                names = [x.split()[0] for x in FOUND.split(", ")]
                return {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}

            return work

        found = map_batches(texts(docs), make, FOUND)
        result = found if result is None else result.unionAll(found)
    return result


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), block_chars: int = 1_000_000  # noqa: B008
) -> DataFrame:
    """The documents that hold no segment of any benchmark item, with all their columns."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    kept = docs
    for index in blocks(benchmark, budget, block_chars):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                held = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([t is None or not matches(shared.value, t, whole_words=True) for t in held], pa.bool_()))

        kept = kept.mapInArrow(run, kept.schema)
    return kept
