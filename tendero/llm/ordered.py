"""Running sums in the order of a key's rows, where one key may hold most rows of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendero.llm.common import materialise


def running(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], purpose: str,
    totals: dict[str, str] | None = None, modulus: int | None = None,
) -> DataFrame:
    """Add the sum of each of ``sums`` over the rows of the key that come before a row (0 for the
    first one).  The sum of ones is a number without gaps from 0.  ``totals`` maps one of the sums to
    a column for its total over the key; with ``modulus`` the sums are remainders.

    Rows are dealt by ranges of (key, order), so a key with very many rows lies in many parts.  Each
    part is summed on its own and moved up by the parts before it, of which there is one row a key
    and part.  Rows that are equal in ``order`` follow each other in any order, which is fixed once
    the parts are written.  Keys may not be null; nulls come first in ``order``."""
    valued = df.withColumns({f"_v_{name}": value.cast("decimal(38,0)") for name, value in sums.items()})
    dealt = (
        valued.withColumn("_salt", F.rand(7))
        .repartitionByRange(*[F.col(c) for c in (*keys, *order)], F.col("_salt"))
        .withColumn("_part", F.spark_partition_id())
    )
    dealt = materialise(dealt, purpose)
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(*keys, "_part").agg(*[F.sum(f"_v_{name}").alias(f"_p_{name}") for name in sums])
    bases = parts.select(
        *keys,
        "_part",
        *[F.coalesce(F.sum(f"_p_{name}").over(before), F.lit(0)).alias(f"_b_{name}") for name in sums],
        *[F.sum(f"_p_{name}").over(of_key).cast("long").alias(out) for name, out in (totals or {}).items()],
    )
    earlier = (
        Window.partitionBy(*keys, "_part").orderBy(*order, "_salt").rowsBetween(Window.unboundedPreceding, -1)
    )
    within = {f"_w_{name}": F.coalesce(F.sum(f"_v_{name}").over(earlier), F.lit(0)) for name in sums}
    summed = dealt.withColumns(within).join(bases, [*keys, "_part"])
    added = {name: F.col(f"_b_{name}") + F.col(f"_w_{name}") for name in sums}
    if modulus is not None:
        added = {name: total % F.lit(modulus).cast("decimal(38,0)") for name, total in added.items()}
    return summed.withColumns({name: total.cast("long") for name, total in added.items()}).drop(
        "_salt", "_part", *[f"_{kind}_{name}" for kind in "vbw" for name in sums]
    )
