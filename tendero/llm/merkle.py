"""A Merkle manifest of a table of documents: one root for all rows, and for each row a proof.

A row's leaf is the hash of its fields, each with its length.  The leaves of a source, by doc_id, are
hashed in runs of three, level by level, up to the source's root; the roots of the sources, by name,
are hashed in the same way up to the root of the table.

Proofs come from pointer jumping.  A node first knows the siblings on the step to its parent.  Each
round joins the nodes with themselves: a node takes over what its ancestor knows, so that the
distance doubles, and appends it to what it has.  Only the levels that a later round can still meet
are kept (every second, fourth, ... one), so that after the first round the leaves are nearly all
rows.  A leaf is joined on (source, level, number), which no other node of its level shares, or on an
ancestor far above of which there are few: no join holds a hot group that cannot be split.

Edge cases: a null field is ``-``; a null source is a source of its own, before all others; a null
doc_id comes first in its source and is never marked for tampering.  Rows with equal doc_ids follow
by their leaf; wholly equal rows have equal leaves at places of their own.  The root of an empty
table does not exist: no rows come back.  Other columns do not matter, whatever they are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendero.llm.common import materialise
from tendero.llm.ordered import running

RUN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<before: binary, after: binary>>"


def record_hash(fields: dict[str, Column]) -> Column:
    """The leaf of a row, in hex: the hash of all its fields in their order."""
    texts = [fields[name].cast("string") for name in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat(*parts), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(run: Column, places: range) -> Column:
    """The digests at some places of a run, one after the other; a place behind its end is empty."""
    found = [F.coalesce(F.get(run, F.lit(k))["digest"], F.lit(b"")) for k in places]
    return F.concat(*found) if found else F.lit(b"")


def _grown(leaves: DataFrame, purpose: str) -> tuple[DataFrame | None, int, DataFrame]:
    """From (key, idx, n, digest): the nodes with their siblings, the height of the tallest tree, and
    (key, digest) of the roots.  A tree of n leaves has a third of that a level up."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    roots = leaves.filter("n = 1").select("key", "digest")
    nodes, level, current = None, 0, leaves
    while largest > 1:
        runs = (
            current.filter("n > 1")
            .groupBy("key", F.expr(f"idx div {RUN}").alias("up"), "n")
            .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("run"))
        )
        runs = materialise(runs, f"{purpose}-level-{level}")
        run, place = F.col("run"), F.col("place")
        before, after = F.lit(b""), F.lit(b"")
        for k in range(RUN):
            before = F.when(place == k, _joined(run, range(k))).otherwise(before)
            after = F.when(place == k, _joined(run, range(k + 1, RUN))).otherwise(after)
        members = runs.select("key", "run", F.posexplode("run").alias("place", "node")).select(
            "key", F.lit(level).alias("level"), F.col("node.idx").alias("idx"),
            F.array(F.struct(before.alias("before"), after.alias("after"))).cast(PROOF).alias("proof"),
        )
        nodes = members if nodes is None else nodes.unionByName(members)
        parent = F.unhex(F.sha2(_hex(_joined(run, range(RUN))), 256))
        current = runs.select(
            "key", F.col("up").alias("idx"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"), parent.alias("digest")
        )
        roots = roots.unionByName(current.filter("n = 1").select("key", "digest"))
        largest, level = -(-largest // RUN), level + 1
    return nodes, level, roots


def _proofs(nodes: DataFrame | None, height: int, purpose: str) -> DataFrame | None:
    """(key, idx, proof) of the leaves of trees with more than one."""
    span = 1
    while span < height:
        near = nodes.filter(F.col("level") % (2 * span) == 0).withColumn("up", F.expr(f"idx div {RUN ** span}L"))
        far = nodes.filter(F.col("level") % (2 * span) == span).select(
            "key", (F.col("level") - span).alias("level"), F.col("idx").alias("up"), F.col("proof").alias("rest")
        )
        jumped = near.join(far, ["key", "level", "up"], "left").select(
            "key", "level", "idx", F.concat("proof", F.coalesce("rest", F.array().cast(PROOF))).alias("proof")
        )
        nodes = materialise(jumped, f"{purpose}-span-{span}")
        span *= 2
    return None if nodes is None else nodes.filter("level = 0").select("key", "idx", "proof")


def _tree(leaves: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with the proof to the root of their key, and (key, digest) of the roots."""
    nodes, height, roots = _grown(leaves, purpose)
    proofs = _proofs(nodes, height, purpose)
    empty = F.array().cast(PROOF)
    if proofs is None:
        return leaves.withColumn("proof", empty), roots
    proven = leaves.join(proofs, ["key", "idx"], "left")
    return proven.withColumn("proof", F.coalesce("proof", empty)), roots


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """Per row: doc_id, source, leaf, subroot and root in hex, and ``proof``: from the leaf to the
    root of the table, the siblings before and behind on each level.  ``carry`` holds further
    expressions over the row of ``docs``."""
    fields = {name: F.col(name) for name in FIELDS}
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-"))  # "-" comes before any name
    rows = docs.select(
        key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(record_hash(fields)).alias("digest"),
        F.struct(F.lit(0).alias("none"), *[value.alias(name) for name, value in (carry or {}).items()]).alias("carried"),
    )
    leaves = running(rows, ["key"], ["doc_id", "digest"], {"idx": F.lit(1)}, "merkle-leaves", {"idx": "n"})
    leaves = materialise(leaves, "merkle-numbered")
    proven, subroots = _tree(leaves, "merkle-source")
    named = subroots.select(F.lit("").alias("key"), F.col("key").alias("source_key"), "digest")
    tops = running(named, ["key"], ["source_key"], {"idx": F.lit(1)}, "merkle-subroots", {"idx": "n"})
    tops, root = _tree(materialise(tops, "merkle-tops"), "merkle-top")
    above = tops.join(root.select("key", F.col("digest").alias("root")), "key").select(
        F.col("source_key").alias("key"), F.col("digest").alias("subroot"), "root", F.col("proof").alias("above")
    )
    return proven.join(above, "key").select(
        "doc_id",
        F.when(F.col("key") != "-", F.substring("key", 2, 2**31 - 1)).alias("source"),
        _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        F.concat("proof", "above").alias("proof"),
        *[F.col(f"carried.{name}").alias(name) for name in carry or {}],
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (in hex) and a proof lead to."""
    return F.aggregate(
        proof, leaf, lambda node, step: F.sha2(F.concat(_hex(step["before"]), node, _hex(step["after"])), 256)
    )


def proof_hash(proof: Column) -> Column:
    """The hash of all siblings of a proof, level by level, left to right."""
    levels = F.transform(proof, lambda step: _hex(F.concat(step["before"], step["after"])))
    return F.sha2(F.array_join(levels, ""), 256)


def without_newlines() -> Column:
    """The leaf of a row of documents after tampering: where 2 divides the checksum of doc_id, its
    text has lost the line breaks."""
    fields = {name: F.col(name) for name in FIELDS}
    marked = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    fields["text"] = F.when(marked, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return record_hash(fields)


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, checked against a copy in which some texts were tampered with."""
    rows = manifest(docs, {"found": without_newlines()})
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"),
        folded(F.col("found"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
