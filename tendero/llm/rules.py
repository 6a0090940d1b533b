"""Quality rules with risk-controlled cutoffs.

Fixed rules reject what is too short or repeats itself.  A further rule compares a text's features
with cutoffs that are learnt per stratum (the language).  One labelled document in five (by a hash of
its id) and the bad ones lay out a sequence of joint rules, each stricter than the one before in one
feature: what catches most bad texts for each good one comes first.  The good documents of the other
four fifths then test the sequence from the most lenient rule on, each rule by the exact binomial
tail: it holds while its false rejection rate is shown to be at most ``alpha`` at level
``delta / strata`` (fixed-sequence testing within a stratum, Bonferroni across strata).  So with
probability ``1 - delta`` no stratum loses more than ``alpha`` of its good documents.  Of the rules that
hold, the one with the best balance of good and bad rejections is taken, in the middle of equals.
A stratum with too few labels to show anything gets no cutoff.

Edge cases: a null or empty text has no words and fails the fixed rules; a null language is a
stratum of its own; repeated rows are judged each; a null doc_id keeps its row and has no label; of
repeated labels of a document the lowest counts; an empty table of documents or labels is no error."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import BATCH_ROWS, map_batches, materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marked")
#: Features of which a high value is bad, all between 0 and 1, from the counts.
FEATURES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "n_letters"),
    "marked": ("n_marked", "n_words"),
}
GRID = 200  # cutoffs of a feature
SHAPE = 5  # one good labelled document in so many lays out the rules, the others test them
PRIOR = 2.0  # good texts that a feature's levels are taken to hold beyond the sample
MEASURED = "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS)


def repeated_words(words: list[str]) -> int:
    """Words inside the windows of five words that the text has more than once."""
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for at, window in enumerate(windows):
        seen = first.setdefault(window, at)
        if seen != at:
            covered[at : at + WINDOW] = covered[seen : seen + WINDOW] = b"\1" * WINDOW
    return sum(covered)


def counts_of(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    held = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    upper = int(held[65:91].sum())
    return (
        len(words),
        sum(map(len, words)),
        int(held[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        upper,
        upper + int(held[97:123].sum()),
        sum(not (w[-1].isalnum() or w[-1] in ".,") for w in words),
    )


def measure(docs: DataFrame) -> DataFrame:
    """The counts of every whole text."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            rows = [counts_of(t) for t in batch.column("text").to_pylist()]
            found = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
            return {k: batch.column(k) for k in ("doc_id", "stratum")} | dict(zip(COUNTS, map(pa.array, found), strict=True))

        return work

    return map_batches(given, make, MEASURED)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n) where each has probability p."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def _labelled(labels: DataFrame) -> DataFrame:
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("label"))


def _level(name: str) -> Column:
    """A feature on the grid: the highest cutoff that it is above, -1 for none."""
    part, whole = FEATURES[name]
    share = F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return (F.ceil(F.least(share, F.lit(1.0)) * GRID) - 1).cast("int")


def choose(good: np.ndarray, bad: np.ndarray, alpha: float, delta: float) -> int | None:
    """The cutoff from counts of good and bad labelled texts by level + 1; tested from the highest down."""
    n = int(good.sum())
    lost = good[::-1].cumsum()[::-1][1:]  # by cutoff: good texts at it or above
    caught = bad[::-1].cumsum()[::-1][1:]
    held = []
    for cutoff in range(len(lost) - 1, -1, -1):
        if n == 0 or binomial_tail(int(lost[cutoff]), n, alpha) > delta:
            break
        held.append(cutoff)
    if not held:
        return None
    gain = [caught[c] / max(1, bad.sum()) - lost[c] / n for c in held]
    best = [c for c, g in zip(held, gain, strict=True) if g == max(gain)]
    return best[len(best) // 2] if max(gain) > 0 else None


def sequence(good: np.ndarray, bad: np.ndarray) -> list[tuple[int, int]]:
    """Joint rules from the most lenient on: (feature, cutoff) lowers that feature's cutoff.

    ``good`` and ``bad`` count labelled texts by feature and level + 1.  A feature goes down along the
    cutoffs that catch most bad texts for each good one; a few good texts spread evenly over the
    levels (``PRIOR``) stand for what the sample does not show."""
    moves = []
    for feature in range(len(good)):
        lost = good[feature][::-1].cumsum()[::-1][1:] + PRIOR * (1 - np.arange(GRID) / GRID)
        caught = bad[feature][::-1].cumsum()[::-1][1:]
        at, so_far, paid = GRID, 0, 0.0
        while at > 0:
            worth = (caught[:at] - so_far) / (lost[:at] - paid)
            step = int(np.flatnonzero(worth == worth.max())[0])
            if worth[step] <= 0:
                break
            moves.append((-float(worth[step]), feature, step))
            at, so_far, paid = step, caught[step], lost[step]
    return [(feature, step) for _, feature, step in sorted(moves, key=lambda m: (m[0], m[1], -m[2]))]


def calibrate(measured: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.1) -> dict[str, dict[str, int]]:
    """Cutoffs by stratum and feature.  What reaches the driver are histograms of the strata that have
    enough good labels to show anything: one by feature and grid step, which lays out the sequence of
    joint rules, and one by the first joint rule that rejects a text, which tests it."""
    known = _labelled(labels)
    with_label = measured.join(known, "doc_id").select(
        "stratum",
        (F.col("label") == 1).alias("good"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(SHAPE)) == 0).alias("shape"),
        F.array(*map(_level, FEATURES)).alias("levels"),
    )
    count = lambda condition: F.sum(condition.cast("long"))
    least = math.log(delta) / math.log1p(-alpha)
    enough = with_label.groupBy("stratum").agg(count(F.col("good") & ~F.col("shape")).alias("n")).where(F.col("n") >= least)
    laid = (
        with_label.where("shape OR NOT good")
        .where(F.col("stratum").isin([r.stratum for r in enough.collect()]))
        .select("stratum", "good", F.posexplode("levels").alias("feature", "level"))
        .groupBy("stratum", "feature", "level")
        .agg(count(F.col("good")).alias("good"), count(~F.col("good")).alias("bad"))
        .collect()
    )
    counts: dict[str, np.ndarray] = {}
    for r in laid:
        held = counts.setdefault(r.stratum, np.zeros((2, len(FEATURES), GRID + 1), np.int64))
        held[:, r.feature, r.level + 1] = r.good, r.bad
    rules = {stratum: sequence(*held) for stratum, held in counts.items()}
    # By stratum, feature and level + 1: how many of the rules, from the strictest on, a text goes through
    # before one lets it pass; 0 if none rejects it.
    places = []
    for stratum, moves in rules.items():
        strict = np.zeros((len(FEATURES), GRID + 1), np.int64)
        for k, (feature, step) in enumerate(moves):
            row = strict[feature, step + 1 :]
            row[row == 0] = len(moves) - k
        places.append((stratum, strict.tolist()))
    spark = measured.sparkSession
    # The driver holds these rows already, one a stratum; so one language may hold most documents.
    steps = F.broadcast(spark.createDataFrame(places, "stratum string, strict array<array<int>>"))
    placed = with_label.join(steps, "stratum")
    joint = F.greatest(*(F.col("strict")[k][F.col("levels")[k] + 1] for k in range(len(FEATURES))))
    tested = (
        placed.where("NOT shape OR NOT good")
        .groupBy("stratum", joint.alias("place"))
        .agg(count(F.col("good")).alias("good"), count(~F.col("good")).alias("bad"))
        .collect()
    )
    cutoffs: dict[str, dict[str, int]] = {}
    for stratum, moves in sorted(rules.items()):
        good, bad = np.zeros(len(moves) + 1, np.int64), np.zeros(len(moves) + 1, np.int64)
        for r in tested:
            if r.stratum == stratum:
                good[r.place], bad[r.place] = r.good, r.bad
        if (cutoff := choose(good, bad, alpha, delta / len(rules))) is not None:
            names = list(FEATURES)
            # A later rule of a feature is the stricter one.
            cutoffs[stratum] = {names[feature]: step for feature, step in moves[: len(moves) - cutoff]}
    return cutoffs


def judge(measured: DataFrame, cutoffs: dict[str, dict[str, int]]) -> DataFrame:
    """base_failed by the fixed rules, kept by these and the cutoffs of the text's stratum."""
    spark = measured.sparkSession
    held = spark.createDataFrame(
        [(s, *(found.get(name) for name in FEATURES)) for s, found in cutoffs.items()],
        "stratum string, " + ", ".join(f"_{name} int" for name in FEATURES),
    )
    over = [F.coalesce(_level(name) >= F.col(f"_{name}"), F.lit(False)) for name in FEATURES]
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rejected = F.col("base_failed")
    for x in over:
        rejected = rejected | x
    return (
        measured.withColumn("base_failed", base)
        .join(F.broadcast(held), "stratum", "left")  # a row a stratum, held by the driver already
        .withColumn("kept", ~rejected)
        .drop(*(f"_{name}" for name in FEATURES))
    )


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.1) -> DataFrame:
    """One row a document: doc_id, stratum, the counts, base_failed and kept.  The counts are
    written once, for the cutoffs and for the verdicts."""
    measured = materialise(measure(docs), "quality-counts")
    return judge(measured, calibrate(measured, labels, alpha, delta))


def accepted(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.1) -> DataFrame:
    """The documents that the rules keep, with all their columns.  Only labelled documents are
    counted for the cutoffs; then every text is judged where it is."""
    with_label = docs.join(_labelled(labels).select("doc_id"), "doc_id", "left_semi")
    cutoffs = calibrate(materialise(measure(with_label), "quality-counts"), labels, alpha, delta)
    steps = {s: {FEATURES[name]: step for name, step in found.items()} for s, found in cutoffs.items()}

    def keeps(text: str | None, stratum: str | None) -> bool:
        held = dict(zip(COUNTS, counts_of(text or ""), strict=True))
        if held["n_words"] < 10 or 100 * held["n_repeat_words"] > 20 * held["n_words"]:
            return False
        return not any(
            held[whole] and math.ceil(min(held[part] / held[whole], 1.0) * GRID) - 1 >= step
            for (part, whole), step in steps.get(stratum or "", {}).items()
        )

    def run(batches):
        for batch in batches:
            text, lang = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "lang"))
            yield batch.filter(pa.array(map(keeps, text, lang), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
