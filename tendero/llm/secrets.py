"""Secret scans.

Three fixed patterns find assignments, access keys and long hexadecimal runs.  Beyond these, values
in the context of a credential are judged by their guess cost: the cheapest way to write the value
as words, dates, repeats, keyboard walks and brute-force spans of any length, found by dynamic
programming over its positions (bits add up).  A value that costs at least ``min_bits`` is a secret of
kind ``guess`` where no fixed pattern covers it; a placeholder or a plain word is cheap and is left
alone.  Every value's bits are returned, also of those inside the fixed patterns' spans.

Words are ranked: a short fixed list of password words first, then the ``words`` most counted words of the
documents themselves, so a word costs about the logarithm of its rank.  All documents are counted; the
bounded list (at most ``words`` words of 20 letters) goes to every task.

A limit: bits are exact below ``FULL_BITS`` and count as that many above.  Repeats are sought from every place on
and with units of any length, in values of any length; a long value that is cheap since it nests long repeats
takes a time that grows with the square of the longest unit.

Edge cases: a null or empty text has no spans; repeated rows are scanned each; a null doc_id stays
null; a value of any length is judged whole (the search stops as soon as no way to end it can be
cheap); words of equal count rank by letters; columns other than doc_id and text do not matter."""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import map_batches, texts

# Kinds in the order in which spans at one place are listed, and their patterns.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a maximal run, so the same as dropping shorter ones
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_HINTS = ("passw", "secret", "token", "api")

# Words that announce a credential; the value runs up to white space, a quote, a bracket or a comma.
CONTEXT = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth|authorization|bearer)"""
    r"""["']?\x20*(?:[:=]|(?<=[Bb]earer)\x20)\x20*(?:(?ai:bearer|basic)\x20+)?["']?([^\s"'`<>(){}\[\],]{6,})"""
)
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "api", "access", "private", "credential", "auth", "bearer")

# Common words of passwords, the most common first.
WORDS = (
    "password pass admin user login welcome secret token key test guest root master changeme default example "
    "letmein love dragon monkey sunshine princess football baseball shadow superman batman qwerty abc iloveyou "
    "hello freedom whatever trustno michael jennifer jordan hunter ranger buster soccer hockey killer george "
    "summer winter spring autumn monday friday january july august october december none null true false empty "
    "your the this that here value string placeholder required optional hidden redacted removed xxx foo bar baz "
    "api access auth bearer basic service client server database local host mail name account public private "
    "prod dev stage demo sample temp new old my is and for with from green blue red black white orange purple "
    "happy money house water flower computer internet family cookie cheese pepper ginger silver golden diamond "
    "correct horse battery staple"
).split()
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("@4301!$57", "aaeolisst")
#: Dates by form: year first, year last (of four or two digits, or none), a year alone.
DATES = tuple(
    re.compile(p)
    for p in (
        r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])",
        r"(?:0?[1-9]|[12]\d|3[01])([-/._])(?:0?[1-9]|1[0-2])\1(?:(?:19|20)?\d\d)",
        r"(?:19|20)\d\d",
    )
)
LONG_UNIT = 127  # units up to here are tried also if they are repeats themselves
FULL_BITS = 128.0  # costs are not told apart above
WORDS_OF_CORPUS, LEAST_COUNT, LONGEST_WORD = 20_000, 20, 20
SEGMENT_BITS = 1.0  # for each span: where it ends


def _neighbours() -> dict[str, str]:
    """By key: the keys around it on a keyboard whose rows are shifted by half a key."""
    near: dict[str, set[str]] = {}
    for y, row in enumerate(ROWS):
        for x, key in enumerate(row):
            around = [(x - 1, y), (x + 1, y), (x, y - 1), (x + 1, y - 1), (x - 1, y + 1), (x, y + 1)]
            near[key] = {ROWS[b][a] for a, b in around if 0 <= b < len(ROWS) and 0 <= a < len(ROWS[b])}
    return {k: "".join(v) for k, v in near.items()}


NEAR = _neighbours()
RANK = {word: k + 1 for k, word in enumerate(WORDS)}
WALK_START, WALK_TURN = math.log2(len(NEAR)), math.log2(6)
DATE_BITS = math.log2(365 * 120)


#: Kinds of characters: digits, small letters, capitals, ASCII marks, all others.
SIZES = ((1, 10), (2, 26), (4, 26), (8, 33), (16, 1000))
#: By set of kinds: bits of a character of a brute-force span.
WIDTH = [0.0] + [math.log2(sum(n for bit, n in SIZES if kinds & bit)) for kinds in range(1, 32)]


def _kind(c: str) -> int:
    return (1 if c.isdigit() else 2 if c.islower() else 4 if c.isupper() else 8) if c < "\x7f" else 16


def _step(a: str, b: str) -> str | None:
    """The direction of a walk's step: a neighbouring key, or the next or last letter or digit."""
    if b in NEAR.get(a, ""):
        return f"{ROWS_OF[b][0] - ROWS_OF[a][0]}{ROWS_OF[b][1] - ROWS_OF[a][1]}"
    if abs(ord(b) - ord(a)) == 1 and a.isalnum() and b.isalnum():
        return "up" if b > a else "down"
    return None


ROWS_OF = {key: (x, y) for y, row in enumerate(ROWS) for x, key in enumerate(row)}


def _word_bits(part: str, lower: str, plain: str, ranks: dict[str, int]) -> float:
    """A word of the list, with its capitals; written with digits for letters it costs two bits more."""
    rank = ranks.get(lower) or 4 * ranks.get(plain, 0)
    if not rank:
        return math.inf
    return math.log2(rank + 1) + (0 if part == lower else 1 if part == part.capitalize() or part.isupper() else len(part))


def _walks(lower: str, i: int, most: float):
    """(end, bits) of the keyboard walks from a place on, while they cost less than ``most``."""
    turns, way = 0, None
    for j in range(i + 2, len(lower) + 1):
        step = _step(lower[j - 2], lower[j - 1])
        if step is None:
            return
        turns += step != way
        way = step
        bits = WALK_START + turns * WALK_TURN + math.log2(j - i)
        if bits >= most:
            return
        if j - i >= 3:
            yield j, bits


def _alike(value: str, a: int, b: int, way: int) -> int:
    """How many characters from two places on, forwards or backwards, are the same."""
    most, done, size = (len(value) - b if way > 0 else a), 0, 16
    while done < most:
        size = min(size, most - done)
        x, y = (a + done, b + done) if way > 0 else (a - done - size, b - done - size)
        if value[x : x + size] == value[y : y + size]:
            done += size
            size *= 2
        elif size == 1:
            break
        else:
            most, size = done + size, size // 2
    return done


def _runs(value: str) -> list[tuple[int, int, int]]:
    """(start, end, size) of the longest stretches in which every character is that of ``size`` places before, at
    least two units long: what stands several times in a row is inside of one.

    Of a unit of 2 to 4 blocks, the first whole block of its run stands again a unit later, so each block is looked
    up in the stretch where that may be.  A unit of over ``LONG_UNIT`` characters that is itself a repeat of a
    smaller one is left out: writing the smaller one more often costs less."""
    n, found = len(value), []
    at = 0
    while at < n:
        end = at + 1 + _alike(value, at, at + 1, 1)
        if end - at >= 2:
            found.append((at, end, 1))
        at = end
    block = 1
    while 4 * block <= n:
        met: dict[int, tuple[int, int]] = {}  # by size: the last stretch, also one that is too short
        small = sorted(r for r in found if 2 * r[2] <= block) if 2 * block > LONG_UNIT else []
        known, inside = 0, 0
        for t in range(0, n - 3 * block + 1, block):
            part, stop = value[t : t + block], min(n, t + 5 * block - 1)
            while known < len(small) and small[known][0] <= t:
                inside = max(inside, small[known][1])
                known += 1
            j = t + 2 * block
            if inside >= t + block:
                j = max(j, inside - block + 1)
            while (j := value.find(part, j, stop)) >= 0:
                size = j - t
                a, b = met.get(size, (0, 0))
                if not (a <= t and j + block <= b):
                    a = t - _alike(value, t, j, -1)
                    b = j + _alike(value, t, j, 1)
                    met[size] = (a, b)
                    if b - a >= 2 * size and not (
                        size > LONG_UNIT and any(x <= a and b <= y and size % q == 0 for x, y, q in found if q < size)
                    ):
                        found.append((a, b, size))
                j += 1
        block *= 2
    return sorted(found)


def guess_bits(
    value: str, enough: float = math.inf, ranks: dict[str, int] = RANK, known: dict[str, float] | None = None
) -> float:
    """Bits of the cheapest segmentation of a value; any number of at least ``enough`` stands for more.
    ``known`` holds the bits of the units of repeats that were met before."""
    known = {} if known is None else known
    lower, plain = value.lower(), value.lower().translate(LEET)
    if len(lower) != len(value):  # a letter whose lower case is longer
        lower = plain = value
    n = len(value)
    cost = [0.0] + [math.inf] * n
    # By set of kinds: the cheapest brute-force span that is open, less its width times its start.
    spans_open = [math.inf] * 32
    held = 0
    for c in set(value):
        held |= _kind(c)
    sets = [kinds for kinds in range(1, 32) if kinds & held == kinds]
    reach = 0  # where the longest of the other spans so far ends
    runs = _runs(value)[::-1]
    open_runs: list[tuple[int, int, int, dict[int, int]]] = []  # with the last start that was tried, by its place in the unit

    def put(end: int, bits: float) -> None:
        nonlocal reach
        reach = max(reach, end)
        cost[end] = min(cost[end], bits)

    for i in range(n + 1):
        if i:
            kind = _kind(value[i - 1])
            for kinds in sets:
                if kinds & kind:
                    cost[i] = min(cost[i], spans_open[kinds] + SEGMENT_BITS + i * WIDTH[kinds])
                else:
                    spans_open[kinds] = math.inf
        if i == n:
            break
        if reach <= i and cost[i] >= enough:
            return enough  # what crosses this place or ends here costs as much already
        for kinds in sets:
            spans_open[kinds] = min(spans_open[kinds], cost[i] - i * WIDTH[kinds])
        base = cost[i] + SEGMENT_BITS
        if base >= enough:
            continue
        for j in range(i + 1, min(n, i + LONGEST_WORD) + 1):
            if not ("a" <= plain[j - 1] <= "z"):
                break  # words are of letters
            if (bits := _word_bits(value[i:j], lower[i:j], plain[i:j], ranks)) < math.inf:
                put(j, base + bits)
        for end, bits in _walks(lower, i, enough - base):
            put(end, base + bits)
        if value[i].isdigit():
            for pattern in DATES:
                if m := pattern.match(value, i):
                    put(m.end(), base + DATE_BITS)
        while runs and runs[-1][0] <= i:
            open_runs.append((*runs.pop(), {}))
        if any(end < i + 2 * size for _, end, size, _ in open_runs):
            open_runs = [r for r in open_runs if r[1] >= i + 2 * r[2]]
        for start, end, size, tried in open_runs:
            place = (i - start) % size
            before = tried.get(place)
            if before is not None and cost[before] + math.log2((i - before) // size + 2) - 1 <= cost[i]:
                continue  # the same unit from there on reaches every end at no higher cost
            unit = value[i : i + size]
            own = known.get(unit)
            if own is None:
                own = WIDTH[_kind(unit)] if size == 1 else guess_bits(unit, enough, ranks, known)
                known[unit] = own
            if base + own < enough:
                tried[place] = i
                for times, stop in enumerate(range(i + 2 * size, end + 1, size), start=2):
                    put(stop, base + own + math.log2(times))
    return cost[n]


def judged(text: str, min_bits: float = 40.0, ranks: dict[str, int] = RANK):
    """All secrets of a text, (start, kind as a number, end) in order, and all values in credential
    contexts, (start, end, bits)."""
    found, values = [], []
    small = text.lower()
    if any(h in small for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(h in small for h in CONTEXT_HINTS):
        held = sorted((a, b) for a, _, b in found)
        for m in CONTEXT.finditer(text):
            start, end = m.span(1)
            end -= len(m[1]) - len(m[1].rstrip(".;:!?"))
            bits = guess_bits(text[start:end], max(min_bits, FULL_BITS), ranks)
            values.append((start, end, bits))
            if bits >= min_bits and not any(a <= start and end <= b for a, b in held):
                found.append((start, 3, end))
    return sorted(found), values


def spans(text: str, min_bits: float = 40.0, ranks: dict[str, int] = RANK) -> list[tuple[int, int, int]]:
    return judged(text, min_bits, ranks)[0]


def dictionary(docs: DataFrame, words: int = WORDS_OF_CORPUS, least: int = LEAST_COUNT) -> dict[str, int]:
    """Ranks of words: the fixed list, then the most counted words of all whole texts.

    A word is a maximal run of 3 to 20 ASCII letters, in lower case.  Counts combine before they are
    shuffled, and only the ``words`` first reach the driver."""
    runs = F.filter(
        F.split(F.lower(F.col("text")), "[^a-z]+"), lambda w: (F.length(w) >= 3) & (F.length(w) <= LONGEST_WORD)
    )
    counted = (
        texts(docs)
        .select(F.explode(runs).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.desc("n"), "word")
        .limit(words)
        .collect()
    )
    more = [r.word for r in counted if r.word not in RANK]
    return RANK | {word: k for k, word in enumerate(more, start=len(RANK) + 1)}


def _listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def redacted(text: str, found: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by a mark."""
    parts, at = [], 0
    for start, _, end in found:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


COLUMNS = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, "
    "value_bits string"
)


def secret_scans(docs: DataFrame, min_bits: float = 40.0, words: int = WORDS_OF_CORPUS) -> DataFrame:
    """One row a document: counts by kind, the digest of the fixed patterns' spans, all spans, and
    value_bits: start:end:bits (rounded down) of every value in a credential context."""
    ranks = dictionary(docs, words)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            both = [judged(t, min_bits, ranks) for t in batch.column("text").to_pylist()]
            found = [spans for spans, _ in both]
            bits = [",".join(f"{a}:{b}:{int(c)}" for a, b, c in values) for _, values in both]
            count = lambda kind: pa.array([sum(k == kind for _, k, _ in x) for x in found], pa.int64())
            base = [_listed([s for s in x if s[1] < 3]) for x in found]
            return {
                "doc_id": batch.column("doc_id"),
                **{f"n_{name}": count(k) for k, name in enumerate(KINDS)},
                "base_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                "spans": pa.array(map(_listed, found), pa.string()),
                "value_bits": pa.array(bits, pa.string()),
            }

        return work

    return map_batches(texts(docs), make, COLUMNS)


def redact(docs: DataFrame, min_bits: float = 40.0, words: int = WORDS_OF_CORPUS) -> DataFrame:
    """The documents with every secret in their texts replaced; n_chars follows the text, the
    other columns stay as they are."""
    schema, ranks = docs.schema, dictionary(docs, words)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            kept = [None if t is None else redacted(t, spans(t, min_bits, ranks)) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(kept, batch.schema.field(at).type)
            if (n := batch.schema.get_field_index("n_chars")) >= 0:
                lengths = [old if t is None else len(t) for t, old in zip(kept, columns[n].to_pylist(), strict=True)]
                columns[n] = pa.array(lengths, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
