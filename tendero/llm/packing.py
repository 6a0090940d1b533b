"""Best-fit packing of tokenised documents into sequences of fixed length.

The plan is made over the histogram of piece lengths, not over documents: best-fit decreasing puts
all pieces of one length at once, so its work and its size depend on the sequence length only.
Pieces then take planned slots by joining on their rank within their length.

Edge cases: a null or empty text is one piece with the end token alone; repeated rows are packed
each; a null doc_id stays null; a longer document is cut into full pieces and a rest; an empty
table gives an empty result; columns other than doc_id and text do not matter."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import held, map_batches, materialise, slots, texts

# Words and parts of a table, of which there are two: the present one and the one before it.
WORD_LIMIT, WORD_LENGTH = 500_000, 64
ITEM = array("I").itemsize  # bytes of an id
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class _Words:
    """Token ids of the words between spaces, as little-endian bytes.  The tokenizer drops white
    space and looks at no word's neighbours, so a text's ids are those of its words.  Nor does it
    look beyond marks that follow letters (ones that no special token or short form holds), so new
    words are cut there, and their parts encoded together, once for each text.  Words and parts share
    a table.  A full one is kept until the next is full, and what comes again moves on, so frequent words stay."""

    MARKS = ",.!%$#*&;?:"

    def __init__(self, tokenizer: str):
        # One thread a task: the cores of an executor belong to its tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(tokenizer).encode_batch_fast
        self.words: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.long: set[str] = set()  # those of the present text

    def learn(self, words: set[str]) -> None:
        known, old, cut, fresh = self.words, self.old, [], set()
        for word in words:
            if (found := old.get(word)) is not None:
                known[word] = found
                continue
            stem = word.rstrip(self.MARKS)
            plain = stem.isalpha()
            tail = word[len(stem) :] if plain else ""
            if not plain:
                stem = word
            elif stem.isascii():
                stem = stem.lower()
            for part in (stem, tail) if tail else (stem,):
                if part not in known:
                    if (found := old.get(part)) is None:
                        fresh.add(part)
                    else:
                        known[part] = found
            cut.append((word, stem, tail))
        fresh = list(fresh)
        for part, found in zip(fresh, self.encode(fresh, add_special_tokens=False), strict=True):
            known[part] = array("I", found.ids).tobytes()
        for word, stem, tail in cut:
            if word != stem:
                known[word] = known[stem] + known[tail] if tail else known[stem]
        self.long |= {x for x in (*words, *fresh) if len(x) > WORD_LENGTH}

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        different = set(words)
        if len(self.words) > WORD_LIMIT:
            self.old, self.words = self.words, {"": b""}
        if new := different.difference(self.words):
            self.learn(new)
        found = b"".join(map(self.words.__getitem__, words))
        for word in self.long:
            del self.words[word]
        self.long.clear()
        return found


def _words(tokenizer: str) -> _Words:
    """One a Python worker: the tasks that it runs one after another know the words of those before."""
    return held(_Words, tokenizer)


def pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of at most ``length`` tokens."""
    end = array("I", [end_id]).tobytes()

    def make():
        words = _words(tokenizer)

        def work(batch: pa.RecordBatch) -> dict:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = words.ids(text) + end
                for n, start in enumerate(range(0, len(ids), length * ITEM)):
                    part = ids[start : start + length * ITEM]
                    kept = part if with_ids else None
                    rows.append((doc, n, start // ITEM, len(part) // ITEM, zlib.crc32(part), kept))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            names = [x.split()[0] for x in PIECES.split(", ")]
            return {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}

        return work

    found = map_batches(texts(docs), make, PIECES, shared=True)
    return found if with_ids else found.drop("ids")


@dataclass
class _Alike:
    """Sequences with the same filling: ``count`` of them, numbered from ``first``."""

    first: int
    count: int
    left: int


@dataclass
class Plan:
    """Slots for the pieces of each length, in the order of their rank: (length, rank from, rank to,
    first sequence, offset); and how many sequences there are."""

    capacity: int
    sequences: int = 0
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)


def best_fit(counts: Iterable[tuple[int, int]], capacity: int) -> Plan:
    """Best-fit decreasing over (length, count).  Sequences alike are handled as one, so the steps
    are bounded by the capacity squared whatever the counts are."""
    plan = Plan(capacity)
    open_: list[list[_Alike]] = [[] for _ in range(capacity + 1)]  # by the room left
    for length, count in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        rank = 0
        while rank < count:
            room = next((r for r in range(length, capacity) if open_[r]), None)
            if room is None:  # new sequences, each for as many pieces of this length as it takes
                group = _Alike(plan.sequences, -(-(count - rank) // (capacity // length)), capacity)
                plan.sequences += group.count
            else:
                group = open_[room].pop()
            put = min(group.count, count - rank)
            if put < group.count:
                open_[group.left].append(_Alike(group.first + put, group.count - put, group.left))
            plan.slots.append((length, rank, rank + put, group.first, capacity - group.left))
            open_[group.left - length].append(_Alike(group.first, put, group.left - length))
            rank += put
    return plan


def pack(pieces: DataFrame, length: int) -> DataFrame:
    """Add sequence_id and offset to materialised pieces."""
    spark = pieces.sparkSession
    counts = [tuple(r) for r in pieces.groupBy("length").count().collect()]  # at most ``length`` rows
    plan = best_fit(counts, length)
    by_length: dict[int, list] = {}
    for size, *slot in plan.slots:
        by_length.setdefault(size, []).append(tuple(slot))
    planned = spark.createDataFrame(
        list(by_length.items()),
        "length long, slots array<struct<low:long,high:long,first:long,offset:long>>",
    )
    ranked = slots(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", buckets=256)
    slot = F.filter("slots", lambda s: (s.low <= F.col("rank")) & (F.col("rank") < s.high))[0]
    return (
        ranked.join(planned, "length")
        .withColumn("slot", slot)
        .withColumn("sequence_id", F.expr("slot.first + rank - slot.low"))
        .withColumn("offset", F.col("slot.offset"))
        .drop("rank", "slots", "slot")
    )


def best_fit_packing(
    docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).
    The pieces are written once, since the plan needs their counts before they get their slots."""
    cut = materialise(pieces(docs, tokenizer, length, end_id, with_ids), "packing-pieces")
    return pack(cut, length)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids, from pieces with ids.  A group is
    one sequence, so it is bounded by the sequence length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    joined = F.unhex(F.concat_ws("", F.transform(parts, lambda p: p.ids)))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
