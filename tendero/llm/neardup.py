"""Near-duplicate documents by bottom-k sketches.

A document's set is its distinct five-word shingles.  Documents with equal sets fold into one node.
One hash function gives each node its sketch: the k smallest hashes.  Two sets with Jaccard J have
about J * k of the values at the bottom of their union in common, so sketches of linked nodes share at
least ``least_shared`` values but for a chance below one in ten million; therefore they meet in the
inverted list of one of the values that a node indexes when its rarest values come first (prefix
filter).  Values that thousands of documents hold through one passage are thus hardly indexed.

Short lists give all their pairs; the members of long lists are compared with the list's centre.
From these, each node's most promising pairs are verified on full sets and joined to components.
Then the other pairs across components are tried, unless the union of their sketches rules a link
out.  Where a long list still holds several components, its pairs come from full sets instead: a link
needs 3 / 7 of both sizes in common, so values that no other such node holds come first, and nodes
with too many of them meet nobody of their size.  Pairs inside a component cannot change it and are left out.

Edge cases: a null or empty text has an empty set and is linked with nothing; fewer words than five
are one shingle; rows with equal doc_id count as one document where their texts are linked; rows with a
null doc_id take part, and get component null if their component has no id: then the row with the
smallest text digest is kept; ids may be negative; an empty table gives an empty result; columns other
than doc_id and text do not matter."""

from __future__ import annotations

import functools
import hashlib
import operator
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tendero.llm.common import map_batches, materialise, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+").findall
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPAN = 5
WORD_LIMIT = 500_000
BIT_WORDS = 16


@dataclass(frozen=True)
class Sketching:
    """Sizes and the threshold, as shared / union."""

    k: int = 64
    shared: int = 3
    union: int = 4
    sigmas: float = 5.5
    short_list: int = 48

    @property
    def threshold(self) -> float:
        return self.shared / self.union

    @property
    def slack(self) -> float:
        """How far an estimate over k values may stay below the threshold."""
        return self.sigmas * (self.threshold * (1 - self.threshold) / self.k) ** 0.5


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > WORD_LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _list_array(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    values = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


class Shingles:
    """The sorted distinct 64-bit hashes of a text's shingles."""

    FACTORS = [pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(SPAN)]

    def __init__(self):
        self.words = _Words()

    def __call__(self, text: str) -> np.ndarray:
        x = np.fromiter(map(self.words.__getitem__, WORD(text.translate(LOWER))), np.uint64)
        if not len(x):
            return x
        span = min(SPAN, len(x))
        n = len(x) - span + 1
        h = np.full(n, span, np.uint64)
        for k in range(span):
            h += x[k : k + n] * np.uint64(self.FACTORS[k])
            h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        return np.unique(h)


def odd_bits(values: np.ndarray) -> np.ndarray:
    """The parity of the number of values in each of 1,024 classes, as 16 words: two sets whose bits differ
    at d places differ in d values or more."""
    counts = np.bincount(((values >> np.uint64(20)) & np.uint64(64 * BIT_WORDS - 1)).astype(np.int64), minlength=64 * BIT_WORDS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def text_digest(text: F.Column) -> F.Column:
    """128 bits that stand for a text (null: empty)."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, digest of the text, n (set size), digest of the set, sketch."""

    def make():
        shingles = Shingles()

        def work(batch: pa.RecordBatch) -> dict:
            found = [shingles(t) for t in batch.column("text").to_pylist()]
            digest = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found]
            return {
                **{c: batch.column(c) for c in ("doc_id", "own")},
                "n": pa.array(map(len, found), pa.int64()),
                "digest": pa.array(digest, pa.binary()),
                "sketch": _list_array([x[:k] for x in found]),
            }

        return work

    given = texts(docs).withColumn("own", text_digest(F.col("text")))
    return map_batches(given, make, "doc_id long, own binary, n long, digest binary, sketch array<long>")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and component (the smallest node that can be reached) for every node of ``links`` (a, b).

    Large and small stars in turn: a node's larger neighbours go to its smallest one.  Each round is
    written, so nothing depends on the executors of an earlier one."""
    both = lambda e: e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(links.where("a != b").select("a", "b").distinct(), "components-links")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    before = None
    for _ in range(most_rounds):
        near = both(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a != b").distinct(), "components-large")
        # Small star: edges point from larger to smaller nodes here.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        first = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(first, "a").select("b", "m").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(
            small.unionAll(first.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "components-small"
        )
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


class NearDuplicates:
    """The steps of one run; each frame that is read again is written to shared storage."""

    def __init__(self, docs: DataFrame, sketching: Sketching = Sketching()):  # noqa: B008
        self.docs, self.s = docs, sketching
        # Rows and nodes have numbers of their own, so that any id and no id are alike to them.
        self.rows = materialise(sets(docs, sketching.k).withColumn("row", F.monotonically_increasing_id()), "neardup-rows")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "own", "row"))
        self.nodes = materialise(
            self.rows.where("n > 0")
            .groupBy("digest")
            .agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), first.alias("first"))
            .withColumn("node", F.monotonically_increasing_id()),
            "neardup-nodes",
        )

    def similar_sizes(self):
        small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        return self.s.union * small >= self.s.shared * large

    def index(self) -> DataFrame:
        """v, node, n and the node's number of values that nobody else has: the inverted lists."""
        s = self.s
        values = self.nodes.select("node", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
        held = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        k, t = F.col("k"), s.threshold
        # A set of up to t * k shingles and all its partners are held whole, so its bound is exact.
        exact = F.ceil(k * t)
        likely = F.floor(k * t - s.sigmas * F.sqrt(k * t * (1 - t)))
        least = F.when(F.col("n") <= int(s.k * t), exact).otherwise(F.greatest(likely, F.lit(1)))
        by_node = Window.partitionBy("node")
        ranked = (
            values.join(held, "v")
            .withColumn("alone", F.col("k") - F.count(F.lit(1)).over(by_node))
            .withColumn("rank", F.row_number().over(by_node.orderBy("df", "v")))
        )
        kept = ranked.where(F.col("alone") + F.col("rank") <= k - least + 1)
        return materialise(kept.select("v", "node", "n", "alone"), "neardup-index")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """a, b and their exact intersection and union, for pairs of nodes."""
        shingled = self.shingled.select("node", "set")
        sides = pairs.join(shingled.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
            shingled.select(F.col("node").alias("b"), F.col("set").alias("y")), "b"
        )

        def make():
            def work(batch: pa.RecordBatch) -> dict:
                shared, union = [], []
                for x, y in zip(_lists(batch.column("x")), _lists(batch.column("y")), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    shared.append(both)
                    union.append(len(x) + len(y) - both)
                return {k: batch.column(k) for k in ("a", "b")} | {
                    "shared": pa.array(shared, pa.int64()), "union": pa.array(union, pa.int64())
                }

            return work

        return map_batches(sides.select("a", "b", "x", "y"), make, "a long, b long, shared long, union long")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the union of their two sketches does not rule out."""
        k, least = self.s.k, self.s.threshold - self.s.slack
        sketch = lambda side: self.nodes.select(F.col("node").alias(side), F.col("sketch").alias(f"s_{side}"))
        sides = pairs.join(sketch("a"), "a").join(sketch("b"), "b")
        bottom = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
        both = F.size(F.array_intersect(F.array_intersect(bottom, F.col("s_a")), F.col("s_b")))
        return sides.where(both >= least * F.size(bottom)).select("a", "b")

    def keep_sets(self, pairs: DataFrame) -> None:
        """Full sets of the nodes in ``pairs``, from one of the texts of each."""
        needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        nodes = self.nodes.join(needed, "node", "left_semi").select("node", "first.*").drop("row")
        docs = texts(self.docs).withColumn("own", text_digest(F.col("text")))

        def make():
            shingles = Shingles()

            def work(batch: pa.RecordBatch) -> dict:
                held = [shingles(t) for t in batch.column("text").to_pylist()]
                return {"node": batch.column("node"), "set": _list_array(held), "bits": _list_array([odd_bits(x) for x in held])}

            return work

        named = docs.join(nodes.where("NOT nameless"), ["doc_id", "own"])
        nameless = docs.where("doc_id IS NULL").join(nodes.where("nameless").select("node", "own"), "own")
        of_texts = lambda found: map_batches(found.select("node", "text"), make, "node long, set array<long>, bits array<long>")
        whole = of_texts(named).unionAll(of_texts(nameless).dropDuplicates(["node"]))
        self.shingled = materialise(whole, "neardup-sets")

    def of_full_sets(self, nodes: DataFrame) -> DataFrame:
        """Pairs of nodes (node, n, component) of different components that may be linked: the prefix
        filter once more, exact, over all values of these nodes, and a bound on the values they differ in.

        Sets of n and m values are linked if they share 3 / 7 of n + m (at least ``need``), so the first
        value in common stands at one of the first n - need + 1 places of the one and m - need + 1 of the
        other.  A value at some place is thus indexed for partners up to a size only, by classes of
        sizes.  A node that differs from all others in a seventh of its values meets none of its size or
        larger, however common its other values are.  Linked sets differ in at most a seventh of n + m
        values, which ``odd_bits`` tells for most others while the pairs meet."""
        s = self.s
        bits = [f"bits{k}" for k in range(BIT_WORDS)]
        held_bits = [F.col("bits")[k].alias(name) for k, name in enumerate(bits)]
        values = self.shingled.join(nodes, "node").select("node", "n", "component", *held_bits, F.explode("set").alias("v"))
        held = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        by_node = Window.partitionBy("node")
        ranked = (
            values.join(held, "v")
            .withColumn("common", F.count(F.lit(1)).over(by_node))
            .withColumn("place", F.col("n") - F.col("common") + F.row_number().over(by_node.orderBy("df", "v")))
        )
        # Sizes of partners for which this place is early enough, as classes of sizes within 5 %.
        both, n = s.shared + s.union, F.col("n")
        small = F.ceil(n * s.shared / s.union)
        large = F.least(F.floor(n * s.union / s.shared), F.floor(both * (n - F.col("place") + 1) / s.shared) - n)
        size_class = lambda size: F.floor(F.log(size) / float(np.log(1.05))).cast("int")
        entries = ranked.withColumn("large", large).where(F.col("large") >= small).select(
            "v", "node", "n", "place", "component", *bits, size_class(n).alias("own"),
            F.explode(F.sequence(size_class(small), size_class(F.col("large")))).alias("other"),
        )
        kept = materialise(entries, "neardup-prefixes")
        a, b = (kept.select("v", *(F.col(c).alias(f"{c}_{x}") for c in kept.columns[1:])) for x in ("a", "b"))
        classes = (F.col("own_a") == F.col("other_b")) & (F.col("other_a") == F.col("own_b"))
        once = (F.col("own_a") < F.col("own_b")) | ((F.col("own_a") == F.col("own_b")) & (F.col("node_a") < F.col("node_b")))
        left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) + 1
        enough = both * left >= s.shared * (F.col("n_a") + F.col("n_b"))
        differ = functools.reduce(operator.add, (F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b"))) for x in bits))
        few = both * differ <= (s.union - s.shared) * (F.col("n_a") + F.col("n_b"))
        apart = F.col("component_a") != F.col("component_b")
        met = a.join(b, (a.v == b.v) & classes & once & apart & enough & few)
        return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()

    def links(self) -> DataFrame:
        """Links that join all nodes which any links join."""
        s = self.s
        index = self.index()
        lists = materialise(
            index.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("alone", "node")).alias("centre")).where("m > 1"),
            "neardup-lists",
        )
        short = index.join(lists.where(F.col("m") <= s.short_list).select("v"), "v")
        long = materialise(
            index.join(lists.where(F.col("m") > s.short_list).select("v", F.col("centre.node").alias("centre")), "v"),
            "neardup-long",
        )

        a, b = (short.select("v", F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in ("a", "b"))
        met = a.join(b, "v").where(F.col("a") < F.col("b")).where(self.similar_sizes())
        pairs = materialise(met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met")), "neardup-pairs")
        best = lambda x, y: pairs.groupBy(x).agg(F.max_by(y, "met").alias(y)).select("a", "b")
        centred = long.where("node != centre").select(
            F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")
        )
        first = materialise(best("a", "b").unionAll(best("b", "a")).unionAll(centred).distinct(), "neardup-first")
        self.keep_sets(pairs.select("a", "b").unionAll(first))
        is_link = F.col("shared") * s.union >= F.col("union") * s.shared
        tried = materialise(self.verified(first), "neardup-tried")
        links = tried.where(is_link).select("a", "b")
        joined = components(links)

        def across(pairs: DataFrame) -> DataFrame:
            for x in ("a", "b"):
                own = joined.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
                pairs = pairs.join(own, x, "left").withColumn(f"c_{x}", F.coalesce(f"c_{x}", x))
            return pairs.where("c_a != c_b").select("a", "b")

        placed = long.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = placed.groupBy("v").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
        apart = placed.join(mixed.select("v"), "v").select("node", "n", "component").distinct()
        far = self.of_full_sets(materialise(apart, "neardup-apart"))
        rest = across(pairs).unionAll(far).distinct().join(first, ["a", "b"], "left_anti")
        more = materialise(self.possible(rest), "neardup-rest")
        return links.unionAll(self.verified(more).where(is_link).select("a", "b"))

    def classes(self) -> DataFrame:
        """One row a document: doc_id, own (digest of the text), n_shingles, component_id, kept, and
        head (whether it is the one row of its component that stands for it)."""
        joined = components(self.links())
        own = self.nodes.select("node", "digest", "first")
        linked = materialise(own.join(joined, "node"), "neardup-linked")
        heads = linked.groupBy("component").agg(F.min("first").alias("least"))
        of_set = (
            linked.join(heads, "component")
            .select("digest", "least")
            .unionAll(own.join(joined, "node", "left_anti").select("digest", F.col("first").alias("least")))
            .select("digest", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("least"))
        )
        found = self.rows.select("doc_id", "own", "n", "digest", "row").join(of_set, "digest", "left")
        component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        head = (F.col("n") == 0) | (F.col("row") == F.col("least"))
        return found.select(
            "doc_id",
            "own",
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.when(component.isNull(), head).otherwise(F.col("doc_id").eqNullSafe(component)).alias("kept"),
            head.alias("head"),
        )


def near_duplicates(docs: DataFrame, sketching: Sketching = Sketching()) -> DataFrame:  # noqa: B008
    """One row a document: doc_id, n_shingles, component_id (the smallest doc_id that can be reached
    over links, its own included) and kept (whether it is that document; one row where no id can be
    reached)."""
    return NearDuplicates(docs, sketching).classes().drop("own", "head")


def representatives(docs: DataFrame, sketching: Sketching = Sketching()) -> DataFrame:  # noqa: B008
    """One document for each component of ``near_duplicates``, with all its columns: the smallest id,
    then the smallest text digest.  Of rows with the same doc_id and text one stays."""
    found = NearDuplicates(docs, sketching)
    heads = found.classes().where("head").select("doc_id", "own").distinct()
    times = found.rows.groupBy("doc_id", "own").agg(F.count(F.lit(1)).alias("times"))
    same = heads["doc_id"].eqNullSafe(times["doc_id"]) & (heads["own"] == times["own"])
    kept = materialise(
        times.join(heads, same, "left_semi").select(
            F.col("doc_id").alias("_kept_id"), F.col("own").alias("_kept_text"), (F.col("times") > 1).alias("_again")
        ),
        "neardup-heads",
    )
    given = docs.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_text", text_digest(F.col("text")))
    on = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_text") == F.col("_kept_text"))
    # Whole texts move once, for the join; only rows that stand several times are grouped after it.
    once = given.join(kept.where("NOT _again"), on, "left_semi")
    again = given.join(kept.where("_again"), on, "left_semi").dropDuplicates(["_id", "_text"])
    return once.unionAll(again).select(*docs.columns)
