"""Token counts: the exact number of tokens of every prefix of a text.

The vocabulary's pieces never hold white space after another character, nor a line feed, so a
text falls into chunks whose tokens are independent.  Within a chunk, prefix dynamic programming
over byte-pair tokens: of all pieces that end at a position, exactly one is the last token of
that prefix's encoding, namely the one that the encoder leaves beside the last token of the
prefix before it.  ``count[i] = count[i - len(piece)] + 1``.  The library is asked only for pairs of
neighbouring tokens; chunks and pairs are kept in bounded tables, which the tasks of a Python worker share.

Edge cases: a null or empty text has 0 tokens and no prefixes; repeated rows are counted each;
a null doc_id stays null; columns other than doc_id and text do not matter."""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import held, map_batches, texts

SPACE = "▁"  # how the library writes a space
CHUNK_LIMIT, PART_LIMIT, CHUNK_LENGTH, PAIR_LIMIT = 800_000, 500_000, 48, 1_000_000
SHARED_LIMIT, BEGINNING = 1_000_000, 16
COLUMNS = "doc_id long, n_bytes long, n_chars long, n_tokens long, prefix_steps binary, limit_chars long"


class _Pairs(dict):
    """Whether two tokens stay as they are when they meet."""

    def __init__(self, model: str):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_file=model)
        e = self.encoder
        special = (e.is_control, e.is_unknown, e.is_byte, e.is_unused)
        self.pieces = {e.id_to_piece(i) for i in range(e.get_piece_size()) if not any(f(i) for f in special)}
        # Every ending of a piece, and whether it is a piece itself.
        self.endings = {p[k:]: p[k:] in self.pieces for p in self.pieces for k in range(len(p))}
        self.own: dict[str, list[int]] = {"": []}

    def encode(self, text: str) -> list[int]:
        """Tokens of a part of a text: a line feed before it keeps the library's own space apart."""
        return self.encoder.encode("\n" + text)[2:]

    def ids(self, token: str) -> list[int]:
        if token not in self.own:
            if len(self.own) > PAIR_LIMIT:
                self.own = {"": []}
            self.own[token] = self.encode(token)
        return self.own[token]

    def __missing__(self, pair: tuple[str, str]) -> bool:
        a, b = pair
        kept = (b not in self.pieces or len(self.ids(b)) == 1) and self.encode(a + b) == self.ids(a) + self.ids(b)
        if len(self) > PAIR_LIMIT:
            self.clear()
        self[pair] = kept
        return kept


class _Chunks(dict):
    """By chunk: the step of the token count at each of its characters, as signed bytes."""

    # Where no piece has a letter before one of these marks, a chunk can be cut between the two.
    NOTHING = {"": bytes(2)}
    LETTERS, MARKS = "A-Za-zÀ-ɏ", "!%$#*&|,.;:?@+^~"

    def __init__(self, model: str):
        self.pairs = _Pairs(model)
        joined = {m for p in self.pairs.pieces for m in re.findall(rf"[{self.LETTERS}](.)", p)}
        marks = "".join(m for m in self.MARKS if m not in joined)
        self.cut = re.compile(rf"(?<=[{self.LETTERS}])(?=[{re.escape(marks)}])").split if marks else lambda chunk: [chunk]
        self.parts: dict[str, bytes] = {}
        self.shared = dict(self.NOTHING)

    def steps(self, part: str) -> bytes:
        pairs, endings, shared = self.pairs, self.pairs.endings, self.shared
        # Words share their beginnings: go on from the longest one that is known.  Its record has the
        # counts and the sizes of the last tokens at each of its prefixes, and maybe at longer ones.
        most = min(len(part), BEGINNING - 1)
        done = most
        while (record := shared.get(part[:done])) is None:
            done -= 1
        half = len(record) // 2
        counts = list(record[: done + 1])
        lasts = [part[end - size : end] for end, size in enumerate(record[half : half + done + 1])]
        for end in range(done + 1, len(part) + 1):
            start = end - 1
            ends = [part[start]]
            while start and (piece := endings.get(wider := part[start - 1 : end])) is not None:
                start -= 1
                if piece:
                    ends.append(wider)
            for token in reversed(ends):
                if pairs[lasts[end - len(token)], token]:
                    break
            else:
                raise ValueError(f"no token ends at {end} of {part!r}")
            counts.append(counts[end - len(token)] + (1 if token in endings else len(pairs.ids(token))))
            lasts.append(token)
        if done < most and max(counts[: most + 1]) < 256:
            if len(shared) > SHARED_LIMIT:
                self.shared = shared = dict(self.NOTHING)
            record = bytes(counts[: most + 1]) + bytes(map(len, lasts[: most + 1]))
            for end in range(done + 1, most + 1):
                shared[part[:end]] = record
        return bytes([(b - a) & 255 for a, b in pairwise(counts)])

    def __missing__(self, chunk: str) -> bytes:
        cut = self.cut(chunk)
        if len(cut) == 1:
            whole = self.parts.get(chunk) or self.steps(chunk)
        else:
            found = []
            for part in cut:
                steps = self.get(part) or self.parts.get(part)
                if steps is None:
                    steps = self.steps(part)
                    if len(part) <= CHUNK_LENGTH:
                        if len(self.parts) > PART_LIMIT:
                            self.parts.clear()
                        self.parts[part] = steps
                found.append(steps)
            whole = b"".join(found)
        if len(chunk) <= CHUNK_LENGTH:
            if len(self) > CHUNK_LIMIT:
                self.clear()
            self[chunk] = whole
        return whole


class PrefixCounter:
    """Steps of the token count at every prefix of a text (``prefix_steps``)."""

    FIND = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall

    def __init__(self, model: str):
        self.chunks = _Chunks(model)

    def steps(self, text: str) -> bytes:
        """One signed byte for each character; their running sum is the count at each prefix."""
        if not text:
            return b""
        shown = self.FIND(SPACE + text.replace(" ", SPACE))
        steps = b"".join(map(self.chunks.__getitem__, shown))
        first = int.from_bytes(steps[:1], signed=True) + int.from_bytes(steps[1:2], signed=True)
        return first.to_bytes(1, signed=True) + steps[2:]


def _counter(model: str) -> PrefixCounter:
    """One a Python worker: the tasks that it runs one after another know the chunks of those before."""
    return held(PrefixCounter, model)


def prefix_counts(steps: bytes) -> np.ndarray:
    """Tokens of every prefix, from the empty one to the whole text."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens, prefix_steps (see ``prefix_counts``) and limit_chars: the
    characters of the longest prefix with at most ``limit`` tokens."""

    def make():
        counter = _counter(model)

        def work(batch: pa.RecordBatch) -> dict:
            given = batch.column("text").to_pylist()
            steps = [counter.steps(t) for t in given]
            totals, fits = [], []
            for s in steps:
                if len(s) <= limit // 4:  # a character has four tokens at most
                    totals.append(int(np.frombuffer(s, np.int8).sum(dtype=np.int64)))
                    fits.append(len(s))
                else:
                    counts = prefix_counts(s)
                    totals.append(int(counts[-1]))
                    fits.append(len(s) if counts[-1] <= limit else int(np.flatnonzero(counts <= limit)[-1]))
            return {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(t.encode()) for t in given], pa.int64()),
                "n_chars": pa.array(map(len, given), pa.int64()),
                "n_tokens": pa.array(totals, pa.int64()),
                "prefix_steps": pa.array(steps, pa.binary()),
                "limit_chars": pa.array(fits, pa.int64()),
            }

        return work

    return map_batches(texts(docs), make, COLUMNS, shared=True)


def tokens_at(counted: DataFrame, n_chars: str, out: str) -> DataFrame:
    """The token count of the prefix whose length the column ``n_chars`` names, from the stored steps."""

    @F.pandas_udf("long")
    def at(steps, length):
        pairs = zip(steps, length, strict=True)
        return steps.__class__([int(np.frombuffer(s[: int(n)], np.int8).sum(dtype=np.int64)) for s, n in pairs])

    return counted.withColumn(out, at("prefix_steps", n_chars))


def truncated(counted: DataFrame, budget: str, out: str) -> DataFrame:
    """The characters of the longest prefix within the token budget in the column ``budget``."""

    @F.pandas_udf("long")
    def cut(steps, budget):
        pairs = zip(steps, budget, strict=True)
        return steps.__class__([int(np.flatnonzero(prefix_counts(s) <= n)[-1]) for s, n in pairs])

    return counted.withColumn(out, cut("prefix_steps", budget))
