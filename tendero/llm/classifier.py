"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of hashed n-grams: words, word pairs, and runs of up to three
word shapes (case, marks, a word or a line that repeats).  Each indicator is scaled by the log ratio
of its smoothed class counts; a linear hinge-loss model on these is fitted by dual coordinate
descent and drawn towards the plain ratios; a logistic curve on rows that the fit has not seen turns
margins into probabilities.  The model is fitted on at most ``rows`` labelled documents (those with
the smallest hash of their id), so its size and the broadcast of these rows are bounded; every
document is scored in one pass without a shuffle.

Edge cases: a null or empty text has no features and gets the score of the bare model; repeated
rows are scored each; a null doc_id is never labelled and not held out; of repeated labels of a
document the lowest counts; with labels of fewer than two classes the score is their smoothed share;
an empty table gives an empty result; columns other than doc_id and text do not matter."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import map_batches, materialise, texts

BITS = 17  # hashed slots of words and of word pairs
WORD = re.compile(r"\S+").findall
SHAPES = 64  # codes of a word shape
REPEATED_WORD, REPEATED_LINE = 62, 63
SLOTS = 2 * 2**BITS + SHAPES**3
WORD_LIMIT = 500_000


class _Words(dict):
    """By word: its hashed slot and the code of its shape."""

    def __missing__(self, word: str) -> int:
        core = word.rstrip("!#*$%&|<>.,;:?)\"'")
        tail = word[len(core) :]
        case = (
            0 if not core else 1 if core.islower() else 2 if len(core) > 1 and core.isupper()
            else 3 if core.istitle() else 4 if core.isdigit() else 5 if core.isalpha() else 6
        )
        marks = 0 if not tail else 1 if tail in ".,;:" else 2 if tail[0] in "!?" else 3 if tail[0] in "#*$%&" else 4
        found = (zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) & (2**BITS - 1)) * SHAPES + case * 5 + marks
        if len(self) > WORD_LIMIT:
            self.clear()
        self[word] = found
        return found


class Features:
    """Sorted slots of the indicators that a text has."""

    def __init__(self):
        self.words = _Words()

    def __call__(self, text: str) -> np.ndarray:
        found = np.fromiter(map(self.words.__getitem__, WORD(text)), np.int64)
        slots, shapes = found // SHAPES, found % SHAPES
        if len(found):
            shapes[1:][found[1:] == found[:-1]] = REPEATED_WORD
        lines = [x for x in text.split("\n") if x]
        if len(set(lines)) < len(lines):
            shapes = np.append(shapes, REPEATED_LINE)
        # Shape 0 stands for none, so runs of one and two are among those of three.
        one = shapes + 1
        two = one[:-1] * SHAPES + one[1:]
        three = two[:-1] * SHAPES + one[2:]
        pairs = (slots[:-1] * 40_503 + slots[1:]) & (2**BITS - 1)
        runs = np.concatenate([one, two, three]) % SHAPES**3 + 2 * 2**BITS
        return np.unique(np.concatenate([slots, pairs + 2**BITS, runs])).astype(np.int32)


@dataclass
class Model:
    """margin = weights of a text's indicators / sqrt(their number) + bias; score = logistic of it."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, slots: np.ndarray) -> float:
        return float(self.weights[slots].sum() / max(1, len(slots)) ** 0.5 + self.bias)

    def score(self, slots: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(slots) + self.shift, -40, 40))))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Of each indicator: the log ratio of its smoothed shares among good and bad texts."""
    logs = []
    for kind in (True, False):
        of = [r for r, y in zip(rows, good, strict=True) if y == kind]
        counts = smooth + np.bincount(np.concatenate(of), minlength=SLOTS)
        logs.append(np.log(counts / (smooth * 2 + len(of))))
    return logs[0] - logs[1]


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float = 1.0, passes: int = 12
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model: each step solves for one row's multiplier,
    which stays between 0 and the row's cost; rows of the rarer class cost more."""
    weights, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    most = cost * np.where(y > 0, 0.5 * len(y) / max(1, (y > 0).sum()), 0.5 * len(y) / max(1, (y < 0).sum()))
    curve = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(1)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * (values[i] @ weights[rows[i]] + bias) - 1.0
            after = min(max(alpha[i] - slope / curve[i], 0.0), most[i])
            if after != alpha[i]:
                step = (after - alpha[i]) * y[i]
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(after - alpha[i]))
                alpha[i] = after
        if moved < 1e-3:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, with smoothed targets."""
    n1, n0 = int(good.sum()), int((~good).sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + 1e-6 * np.eye(2), x @ (target - p))
        at = at + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], good: np.ndarray, apart: np.ndarray, mix: float = 0.5) -> Model:
    """Fit on the rows that are not ``apart``, and the logistic curve on those that are."""
    own = np.flatnonzero(~apart)
    if len(set(good[own])) < 2 or len(set(good[apart])) < 2:
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros(SLOTS), 0.0, 0.0, float(np.log(share / (1 - share))))
    used, labels = [rows[i] for i in own], good[own]
    ratios = log_count_ratios(used, labels)
    values = [ratios[r] / max(1, len(r)) ** 0.5 for r in used]
    weights, bias = dual_coordinate_descent(used, values, np.where(labels, 1.0, -1.0), SLOTS)
    seen = weights[weights != 0]
    mean = float(np.abs(seen).mean()) if len(seen) else 0.0
    model = Model(ratios * ((1 - mix) * mean + mix * weights), mix * bias, 1.0, 0.0)
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(apart)])
    model.slope, model.shift = logistic_curve(margins, good[apart])
    return model


def fold() -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, rows: int = 8000) -> Model:
    """Fit on at most ``rows`` labelled documents outside fold 0; fold 1 is for the logistic curve."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
        .withColumn("fold", fold())
        .where("fold != 0")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    sample = texts(docs).join(F.broadcast(known), "doc_id")

    def make():
        features = Features()

        def work(batch: pa.RecordBatch) -> dict:
            held = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            return {k: batch.column(k) for k in ("doc_id", "label", "fold")} | {"slots": pa.array(held, pa.binary())}

        return work

    label_type = dict(sample.dtypes)["label"]
    found = map_batches(
        sample.select("doc_id", F.col("label").cast("int"), F.col("fold").cast("int"), "text"),
        make,
        "doc_id long, label int, fold int, slots binary",
    )
    assert label_type in ("int", "bigint", "smallint", "tinyint")
    # One row a document, so repeated rows cannot outgrow the bound either.
    held = materialise(found, "classifier-rows").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    slots = [np.frombuffer(s, np.int32) for s in held["slots"]]
    return fit(slots, (held["label"] == 1).to_numpy(bool), (held["fold"] == 1).to_numpy(bool))


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = 8000, threshold: float = 0.3) -> DataFrame:
    """One row a document: doc_id, held_out, score and predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows))

    def make():
        features = Features()

        def work(batch: pa.RecordBatch) -> dict:
            scores = [model.value.score(features(t)) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())}

        return work

    scored = map_batches(texts(docs), make, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
