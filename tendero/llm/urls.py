"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest.

Everything is DataFrame expressions and aggregates.  Features are integers on fixed grids, so the
labelled URLs fold into cells (a feature vector with its counts of labels).  Each level of each
tree is one aggregation of gradients by leaf, feature and step, of which at most
``2**depth x features x STEPS`` rows reach the driver; the finished trees are CASE expressions inside
the scan's code.

Edge cases: a null URL, or one without ``://``, has an empty host and path and is judged by its
features; repeated rows are judged each; repeated labels of a document count by their lowest;
without labels every tree is empty and all URLs without a rule are allowed; extra columns do not matter."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import materialise

STEPS = 32  # grid steps of a feature
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add host (lower case) and path, both empty where the URL has no ``://``."""
    given = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(given, "://")
    rest = F.when(at > 0, F.substring(given, at + 3, F.length(given))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return urls.withColumn("host", F.translate(host, UPPER, LOWER)).withColumn("path", path)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and the paths that begin with the rule's."""

    verdict: str
    text: str  # host and path, as in ``example.org/es/``

    def fits(self) -> Column:
        host, slash, path = self.text.partition("/")
        own = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        return own & F.col("path").startswith(slash + path)


def matching(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        text = F.when(rule.fits(), F.lit(rule.text)).otherwise(text)
        verdict = F.when(rule.fits(), F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits a character: of each letter, digit and mark by its number in the text."""
    marks = LOWER + "0123456789-._~/?=&%:#+"
    lowered, n = F.lower(text), F.greatest(F.length(text), F.lit(1))
    parts = []
    for c in marks:
        k = F.length(lowered) - F.length(F.translate(lowered, c, ""))
        parts.append(F.when(k > 0, -(k / n) * F.log2(k / n)).otherwise(0.0))
    total = parts[0]
    for x in parts[1:]:
        total = total + x
    return total


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def features(url: str = "url") -> dict[str, Column]:
    """By name: the feature's step on its grid.  Expects host and path."""
    given = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(given, r"\?([^#]*)", 1)
    n = F.greatest(F.length(given), F.lit(1))
    raw = {
        "length": F.length(given) / 4,
        "host_length": F.length("host"),
        "path_length": F.length("path") / 2,
        "depth": _count(F.col("path"), "/"),
        "labels": _count(F.col("host"), "."),
        "digits": _count(given, "0123456789") / n * STEPS,
        "entropy": _entropy(given) * 6,
        "parameters": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "marks": _count(given, "-_%~+"),
        "fragment": F.instr(given, "#") > 0,
    }
    return {k: F.least(F.greatest(v.cast("int"), F.lit(0)), F.lit(STEPS - 1)) for k, v in raw.items()}


def suffix() -> Column:
    """The last two labels of the host."""
    return F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0)


@dataclass
class Trees:
    """A model: the score of a URL is ``base`` and the sum of its leaves."""

    names: list[str]
    base: float
    trees: list[list]

    def leaf(self, tree: list, at: int = 0) -> Column:
        """The number of the leaf in a tree whose nodes are (feature, step) or None, heap by heap."""
        if at >= len(tree) or tree[at] is None:
            return F.lit(at)
        name, step = tree[at]
        return F.when(F.col(name) <= step, self.leaf(tree, 2 * at + 1)).otherwise(self.leaf(tree, 2 * at + 2))

    def value(self, tree: list, values: dict[int, float], at: int = 0) -> Column:
        if at >= len(tree) or tree[at] is None:
            return F.lit(values.get(at, 0.0))
        name, step = tree[at]
        low, high = self.value(tree, values, 2 * at + 1), self.value(tree, values, 2 * at + 2)
        return F.when(F.col(name) <= step, low).otherwise(high)

    def score(self) -> Column:
        total = F.lit(self.base)
        for tree, values in self.trees:
            total = total + self.value(tree, values)
        return total

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.score()))


def _best_split(sums: dict, names: list[str], penalty: float, least: float):
    """The (feature, step) with the most gain in a leaf; sums: by feature and step, [gradient, curvature]."""
    best = (1e-9, None)
    for name in names:
        steps = sorted(sums.get(name, {}).items())
        whole_g, whole_h = sum(x[0] for _, x in steps), sum(x[1] for _, x in steps)
        g = h = 0.0
        for step, (dg, dh) in steps[:-1]:
            g, h = g + dg, h + dh
            if h < least or whole_h - h < least:
                continue
            other = whole_g - g
            gain = g * g / (h + penalty) + other * other / (whole_h - h + penalty) - whole_g**2 / (whole_h + penalty)
            if gain > best[0] + 1e-12:
                best = (gain, (name, step))
    return best[1]


def boost(
    cells: DataFrame, names: list[str], rounds: int = 8, depth: int = 3, rate: float = 0.3, penalty: float = 1.0, least: float = 5.0
) -> Trees:
    """Logistic gradient boosting over cells: the feature steps with n labels, bad of them."""
    n, bad = cells.agg(F.sum("n"), F.sum("bad")).first()
    if not n:
        return Trees(names, -20.0, [])
    share = min(max((bad or 0) / n, 1e-6), 1 - 1e-6)
    model = Trees(names, math.log(share / (1 - share)), [])
    for _ in range(rounds):
        p = model.probability()
        graded = cells.withColumn("_g", F.col("n") * p - F.col("bad")).withColumn("_h", F.col("n") * p * (1 - p))
        tree: list = []
        sums: dict[int, dict] = {}
        for level in range(depth + 1):
            rows = (
                graded.select(
                    model.leaf(tree).alias("leaf"), "_g", "_h", F.posexplode(F.array(*names)).alias("feature", "step")
                )
                .groupBy("leaf", "feature", "step")
                .agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))
                .collect()
            )
            sums = {}
            for r in rows:
                sums.setdefault(r.leaf, {}).setdefault(names[r.feature], {})[r.step] = (r.g, r.h)
            if level == depth:
                break
            fresh = {at: _best_split(sums[at], names, penalty, least) for at in sums if at >= 2**level - 1}
            tree += [None] * (2 ** (level + 1) - 1 - len(tree))
            for at, split in fresh.items():
                tree[at] = split
            if not any(fresh.values()):
                break
        first = names[0]
        values = {}
        for at, by_name in sums.items():
            g, h = (sum(x[k] for x in by_name[first].values()) for k in (0, 1))
            values[at] = -rate * g / (h + penalty)
        model.trees.append((tree, values))
    return model


def url_filter(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], threshold: float = 0.5, rounds: int = 8
) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict and the trees' score.

    A URL is labelled if its path names a document (a number at its end) with a quality label;
    label 0 is bad.  All labelled URLs are used."""
    named = with_parts(pages.select(F.col("page_id"), F.col("url").cast("string").alias("url")))
    named = named.withColumns(features()).withColumn("suffix", suffix())
    own = list(features())
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    number = F.regexp_extract("path", r"/(\d{1,18})(?:\.\w+)?/?$", 1)
    labelled = materialise(
        named.where(number != "")
        .withColumn("_doc", number.cast("long"))
        .join(known.withColumnRenamed("doc_id", "_doc"), "_doc")
        .select("suffix", *own, (F.col("label") == 0).cast("int").alias("bad"))
        .groupBy("suffix", *own, "bad")
        .agg(F.count(F.lit(1)).alias("n")),
        "url-labelled",
    )
    n, bad = labelled.agg(F.sum("n"), F.sum(F.col("n") * F.col("bad"))).first()
    prior = (bad or 0) / n if n else 0.0
    statistics = materialise(
        labelled.groupBy("suffix").agg(
            F.least(F.log2(F.sum("n") + 1).cast("int"), F.lit(STEPS - 1)).alias("suffix_count"),
            F.least(
                ((F.sum(F.col("n") * F.col("bad")) + 50 * prior) / (F.sum("n") + 50) * (STEPS - 1)).cast("int"),
                F.lit(STEPS - 1),
            ).alias("suffix_bad"),
        ),
        "url-suffixes",
    )
    names = [*own, "suffix_count", "suffix_bad"]
    cells = materialise(
        labelled.join(statistics, "suffix")
        .groupBy(*names)
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("bad")).alias("bad")),
        "url-cells",
    ).coalesce(8)
    model = boost(cells, names, rounds)
    text, verdict = matching(rules)
    unseen = {"suffix_count": 0, "suffix_bad": int(prior * (STEPS - 1))}
    scored = named.join(statistics, "suffix", "left").fillna(unseen).withColumn("score", model.probability())
    judged = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, judged).alias("verdict"), "score"
    )
