"""Removal of repeated byte strings with suffix arrays.

A string of ``length`` bytes that starts anywhere else, in any text, is a repeat; every byte that a
repeat covers is removed.  The work is cut into shards by content, so that equal strings meet:

1. The anchor of a string is its smallest hash of ``gram`` bytes (winnowing).  Equal strings have equal
   anchors at the same place.  The starts of strings with one anchor are a run, whose bytes are cut
   out with the anchor's hash as the shard key.
2. Runs of equal bytes repeat as a whole, and one of each kind goes on.  Anchors that only one kind of
   run has cannot repeat any further.
3. Each shard's runs are put together and sorted by induced sorting: suffixes are classified, the
   leftmost-smaller substrings sorted and named, their order found by recursion, and from it the
   whole array induced in two linear passes.  Permuted common prefixes then say which starts repeat.
   An array takes the anchors that fit into ``ARRAY`` bytes, or one larger anchor (with ``most_kinds``
   runs of under ``2 * length`` bytes at most), so a task's memory does not grow with the input.
4. An anchor with more than ``most_kinds`` kinds of runs is not put into one shard: its strings meet by
   a 128-bit digest of each instead, which Spark aggregates.

Edge cases: a null text is empty; texts shorter than ``length`` stay whole; repeated rows remove each
other; a null doc_id stays null and its row takes part; an empty table gives an empty result; columns
other than doc_id and text do not matter."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import map_batches, materialise, texts

LENGTH, GRAM = 400, 32
MOST_KINDS = 4096
CHUNK = 1 << 22  # bytes of an anchor search and of a shard
ARRAY = 1 << 20  # bytes of a suffix array
PLACE = 24  # bits of a place inside a chunk
NO_ID = -(2**63)


# --- suffix arrays ---------------------------------------------------------------------------


def classify(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it.  The last symbol is the smallest, once."""
    at = np.where(t[1:] != t[:-1], np.arange(len(t) - 1, dtype=np.int32), np.int32(len(t)))
    following = np.minimum.accumulate(at[::-1])[::-1]  # of equal neighbours the first change decides
    smaller = np.ones(len(t), bool)
    known = following < len(t)
    smaller[:-1][known] = (t[1:] > t[:-1])[following[known]]
    return smaller


def _spread(array: np.ndarray, pointer: np.ndarray, found: np.ndarray, symbols: np.ndarray, sign: int) -> None:
    """Append entries, in order, to the buckets of their symbols."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    counts = np.diff(np.r_[first, len(ranked)])
    within = np.arange(len(ranked)) - np.repeat(first, counts)
    array[pointer[ranked] + sign * within] = found[order]
    pointer[ranked[first]] += sign * counts


def induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the leftmost-smaller suffixes in the given order: larger
    suffixes from left to right through the buckets, then smaller ones from right to left."""
    array = np.full(len(t), -1, np.int32)
    ends = np.cumsum(sizes)
    heads, tails = ends - sizes, ends - 1
    own = t[lms]
    per = np.bincount(own, minlength=len(sizes))
    order = np.argsort(own, kind="stable")
    starts = ends - per  # where the leftmost-smaller suffixes of a bucket begin
    array[np.repeat(starts, per) + np.arange(len(lms)) - np.repeat(np.cumsum(per) - per, per)] = lms[order]
    del own, order
    pointer = heads.copy()
    for c in np.flatnonzero(sizes):
        done = heads[c]
        while True:
            block = array[done : pointer[c]]
            last = not len(block)
            if last:
                block = array[starts[c] : ends[c]]
            done += 0 if last else len(block)
            before = block[block > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                _spread(array, pointer, before, t[before], 1)
            if last:
                break
    for c in np.flatnonzero(per):
        array[starts[c] : ends[c]] = -1
    larger_ends = pointer  # one past the larger suffixes of a bucket
    pointer = tails.copy()
    if len(t):
        array[tails[t[-1]]], pointer[t[-1]] = len(t) - 1, tails[t[-1]] - 1
    for c in np.flatnonzero(sizes)[::-1]:
        done = tails[c]
        while True:
            block = array[pointer[c] + 1 : done + 1][::-1]
            last = not len(block)
            if last:
                block = array[heads[c] : larger_ends[c]][::-1]
            done -= 0 if last else len(block)
            before = block[block > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _spread(array, pointer, before, t[before], -1)
            if last:
                break
    return array


def _names(t: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost-smaller substrings, in text order, from them in sorted order."""
    length = np.zeros(len(t), np.int32)
    length[lms] = np.diff(np.r_[lms, len(t)]) + 1
    a, b = ranked[:-1], ranked[1:]
    same = length[a] == length[b]
    active, k = np.flatnonzero(same), 0
    while len(active):
        x, y = a[active] + k, b[active] + k
        inside = (k < length[a[active]]) & (np.maximum(x, y) < len(t))
        active, x, y = active[inside], x[inside], y[inside]
        equal = t[x] == t[y]
        same[active[~equal]] = False
        active, k = active[equal], k + 1
    names = np.zeros(len(t), np.int32)
    names[ranked] = np.r_[0, np.cumsum(~same)]
    found = names[lms]
    return found, int(found.max()) + 1


def _doubling(t: np.ndarray) -> np.ndarray:
    """The suffix order of a string of many different names: by ever longer beginnings."""
    rank, size = t.astype(np.int64), 1
    while True:
        order = np.argsort(rank, kind="stable")
        ranked = rank[order]
        new = np.r_[True, ranked[1:] != ranked[:-1]]
        dense = np.cumsum(new) - 1
        if dense[-1] == len(t) - 1:
            return order
        rank = np.empty(len(t), np.int64)
        rank[order] = dense
        rank = rank * (len(t) + 1) + np.r_[rank[size:] + 1, np.zeros(min(size, len(t)), np.int64)]
        size *= 2


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Suffixes of ``t`` in order.  The last symbol is 0 and occurs once."""
    if len(t) < 2:
        return np.arange(len(t))
    if symbols > 2048:  # too many buckets to go through one by one
        return _doubling(t)
    t = t.astype(np.int16, copy=False)  # few symbols: less memory, and sorted by radix
    smaller = classify(t)
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    sizes = np.bincount(t, minlength=symbols)
    array = induce(t, smaller, lms, sizes)
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    ranked = array[is_lms[array]]
    del array, is_lms
    names, number = _names(t, lms, ranked)
    if number < len(lms):
        ranked = lms[suffix_array(names, number)]
    return induce(t, smaller, ranked, sizes)


def permuted_common_prefixes(t: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By place: the suffix before its own in the array, and the symbols they have in common.

    Where the symbols before both are equal, the prefix is one shorter than that of the place before;
    only the others are compared."""
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[array[1:]] = array[:-1]
    reducible = before > 0
    reducible[1:] &= t[:-1] == t[np.maximum(before[1:], 1) - 1]
    reducible[:1] = False
    compared = np.flatnonzero(~reducible).astype(np.int32)
    del reducible
    common = np.zeros(n, np.int32)
    padded = np.zeros(n + 8, np.uint16)
    padded[:n] = t
    wide = np.zeros(n, np.uint64)
    for k in range(7):  # nine bits a symbol, seven symbols a word
        part = padded[k : k + n].astype(np.uint64)
        part <<= np.uint64(9 * k)
        wide |= part
    del part
    active = compared[before[compared] >= 0]
    x, y = active.copy(), before[active]
    while len(active):
        inside = (x < n) & (y < n)
        active, x, y = active[inside], x[inside], y[inside]
        differs = wide[x] ^ wide[y]
        equal = differs == 0
        part = differs[~equal]
        low = (part & (~part + np.uint64(1))).astype(np.float64)
        common[active[~equal]] += (np.log2(low) // 9).astype(np.int32)
        common[active[equal]] += 7
        active, x, y = active[equal], x[equal] + 7, y[equal] + 7
    del wide
    start = np.zeros(n, np.int32)
    start[compared] = compared
    start = np.maximum.accumulate(start)
    common = common[start]
    common += start
    common -= np.arange(n, dtype=np.int32)
    return before, np.maximum(common, 0)


def repeated_starts(runs: list[bytes], length: int) -> list[np.ndarray]:
    """Of each run: the places at which a string of ``length`` bytes starts that starts at another place too."""
    size = sum(map(len, runs)) + len(runs) + 1
    t = np.ones(size, np.int16)  # 1 parts the runs
    t[-1] = 0
    valid = np.zeros(size, bool)
    begins, at = [], 0
    for run in runs:
        t[at : at + len(run)] = np.frombuffer(run, np.uint8)
        t[at : at + len(run)] += 2
        valid[at : at + len(run) - length + 1] = True
        begins.append(at)
        at += len(run) + 1
    before, common = permuted_common_prefixes(t, suffix_array(t, 258))
    hits = np.flatnonzero((common >= length) & valid)
    repeats = np.zeros(size, bool)
    repeats[hits] = True
    repeats[before[hits]] = True
    return [np.flatnonzero(repeats[b : b + max(0, len(run) - length + 1)]) for b, run in zip(begins, runs, strict=True)]


# --- anchors ---------------------------------------------------------------------------------


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from each place on."""
    h = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    power, size = 0x2545F4914F6CDD1D, 1
    while size < gram:
        h = h[:-size] * np.uint64(power) + h[size:]
        power, size = power * power % 2**64, size * 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by minima from both ends of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    padded = padded.reshape(blocks, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchored_runs(text: bytes, length: int, gram: int):
    """(anchor hash, first start, last start) of each run of starts with the same anchor."""
    x = np.frombuffer(text, np.uint8)
    for begin in range(0, len(x) - length + 1, CHUNK):
        part = x[begin : begin + CHUNK + length - 1]
        h = gram_hashes(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        keyed = (h >> np.uint64(PLACE) << np.uint64(PLACE)) | place
        anchor = (sliding_minimum(keyed, length - gram + 1) & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:] - 1, len(anchor) - 1]
        yield from zip(h[anchor[first]].view(np.int64).tolist(), (first + begin).tolist(), (last + begin).tolist(), strict=True)


def _keyed(docs: DataFrame) -> DataFrame:
    """id (null doc_id: a number of its own) and crc tell texts apart, also where ids repeat."""
    raw = F.col("text").cast("binary")
    return texts(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.crc32(raw).alias("crc"), raw.alias("bytes")
    )


RUNS = "id long, crc long, anchor long, digest long, first int, last int"


def runs(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """Every run of every text: its anchor, a digest of its bytes and its starts."""

    def make():
        digest = xxhash.xxh3_64_intdigest

        def work(batch: pa.RecordBatch) -> dict:
            row, found, content = [], [], []
            for k, text in enumerate(batch.column("bytes").to_pylist()):
                view = memoryview(text)
                for anchor, first, last in anchored_runs(text, length, gram) if len(text) >= length else ():
                    row.append(k)
                    found.append((anchor, first, last))
                    content.append(digest(view[first : last + length]))
            anchor, first, last = np.array(found, np.int64).reshape(-1, 3).T
            row = pa.array(row, pa.int64())
            return {
                "id": batch.column("id").take(row),
                "crc": batch.column("crc").take(row),
                "anchor": pa.array(anchor),
                "digest": pa.array(np.array(content, np.uint64).view(np.int64)),
                "first": pa.array(first.astype(np.int32)),
                "last": pa.array(last.astype(np.int32)),
            }

        return work

    return map_batches(keyed.select("id", "crc", "bytes"), make, RUNS)


CUT = "id long, crc long, anchor long, first int, run binary"


def cut_out(keyed: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """The bytes of runs (id, crc, anchor, first, last), from their texts."""
    per_text = kinds.groupBy("id", "crc").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("runs"))
    both = keyed.join(per_text, ["id", "crc"]).select("id", "crc", "bytes", "runs").dropDuplicates(["id", "crc"])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            rows = [
                (i, c, r["anchor"], r["first"], text[r["first"] : r["last"] + length])
                for i, c, text, held in zip(*(batch.column(k).to_pylist() for k in ("id", "crc", "bytes", "runs")), strict=True)
                for r in held
            ]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            names = [x.split()[0] for x in CUT.split(", ")]
            return {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}

        return work

    return map_batches(both, make, CUT)


def by_array(rows: Iterable[tuple], most: int) -> Iterator[list[tuple]]:
    """Rows of ``CUT`` in the order of their anchors, as many whole anchors at a time as have ``most`` bytes, one at least."""
    held, size = [], 0
    for _, own in groupby(rows, key=lambda row: row[2]):
        own = list(own)
        more = sum(len(row[4]) for row in own)
        if held and size + more > most:
            yield held
            held, size = [], 0
        held += own
        size += more
    if held:
        yield held


SPANS = "id long, crc long, start int, stop int"


def sorted_shards(cut: DataFrame, shards: int, length: int) -> DataFrame:
    """Spans of the starts that repeat, from a suffix array of each megabyte or so of whole anchors."""

    def spans_of(rows: list) -> pa.RecordBatch:
        found = []
        for (i, c, _, first, _), starts in zip(rows, repeated_starts([r[4] for r in rows], length), strict=True):
            if len(starts):
                cuts = np.flatnonzero(np.diff(starts) > length)
                for a, b in zip(np.r_[starts[0], starts[cuts + 1]], np.r_[starts[cuts], starts[-1]], strict=True):
                    found.append((i, c, first + int(a), first + int(b) + length))
        columns = list(zip(*found, strict=True)) if found else [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "crc", "start", "stop"])

    def run(batches):
        rows = (
            row
            for batch in batches
            for row in zip(*(batch.column(k).to_pylist() for k in ("id", "crc", "anchor", "first", "run")), strict=True)
        )
        for held in by_array(rows, ARRAY):
            yield spans_of(held)

    return cut.repartition(shards, "anchor").sortWithinPartitions("anchor").mapInArrow(run, SPANS)


def met_by_digest(cut: DataFrame, length: int) -> DataFrame:
    """Spans of the strings that start more than once, for anchors with too many kinds of runs."""

    def make():
        digest = xxhash.xxh3_128_digest

        def work(batch: pa.RecordBatch) -> dict:
            row, start, found = [], [], []
            for k, (first, run) in enumerate(zip(batch.column("first").to_pylist(), batch.column("run").to_pylist(), strict=True)):
                view = memoryview(run)
                for at in range(len(run) - length + 1):
                    row.append(k)
                    start.append(first + at)
                    found.append(digest(view[at : at + length]))
            row = pa.array(row, pa.int64())
            return {k: batch.column(k).take(row) for k in ("id", "crc")} | {
                "start": pa.array(start, pa.int32()), "string": pa.array(found, pa.binary())
            }

        return work

    strings = map_batches(cut.select("id", "crc", "first", "run"), make, "id long, crc long, start int, string binary")
    strings = materialise(strings, "suffix-strings")
    often = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return strings.join(often, "string").select("id", "crc", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(
    keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, most_kinds: int = MOST_KINDS
) -> DataFrame:
    """id, crc, start, stop: spans that cover every byte of every repeat (they may overlap)."""
    every = materialise(runs(keyed, length, gram), "suffix-runs")
    # written first, so that the join can split an anchor that many runs have
    often = materialise(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "suffix-often")
    shared = materialise(every.join(often, "anchor"), "suffix-shared")
    kinds = materialise(
        shared.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "crc", "first", "last")).alias("one")),
        "suffix-kinds",
    )
    whole = shared.join(kinds.where("n > 1").select("anchor", "digest"), ["anchor", "digest"]).select(
        "id", "crc", F.col("first").alias("start"), (F.col("last") + length).alias("stop")
    )
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    apart = kinds.join(several, "anchor").select("anchor", "one.*", (F.col("kinds") > most_kinds).alias("many"))
    cut = materialise(
        cut_out(keyed, apart, length).join(several.where(F.col("kinds") > most_kinds).select("anchor", F.lit(True).alias("many")), "anchor", "left"),
        "suffix-cut",
    )
    few, many = cut.where("many IS NULL"), cut.where("many")
    size = few.agg(F.sum(F.length("run"))).first()[0] or 0
    return whole.unionAll(sorted_shards(few, max(1, -(-size // CHUNK)), length)).unionAll(met_by_digest(many, length))


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal spans: those that touch or overlap become one."""
    found: list[list[int]] = []
    for start, stop in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], stop)
        else:
            found.append([start, stop])
    return found


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_kinds: int = MOST_KINDS
) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans and the bytes that are kept."""
    keyed = _keyed(docs)
    spans = repeated_spans(keyed, length, gram, most_kinds)
    by_text = spans.groupBy("id", "crc").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            rows = []
            for text, held in zip(batch.column("bytes").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                gone = merged([(s["start"], s["stop"]) for s in held or ()])
                ends = [0, *(x for span in gone for x in span), len(text)]
                parts = [text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)]
                rows.append((len(text), sum(b - a for a, b in gone), len(gone), b"".join(parts)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("n_bytes", "n_removed", "n_spans", "kept")
            return {"doc_id": batch.column("doc_id")} | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}

        return work

    both = keyed.join(by_text, ["id", "crc"], "left").select("doc_id", "bytes", "spans")
    return map_batches(both, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
