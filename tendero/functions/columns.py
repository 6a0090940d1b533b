"""Column expressions shared by the operators; all of them stay inside whole-stage codegen.

Money is summed as DECIMAL so that a result never depends on the order in which shuffle blocks
arrive; ratios are DOUBLE and NULL where the denominator is zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tendero.schemas import CATEGORY_EN, RETURNED

TICKET_TYPE = "decimal(18,2)"
LINE_TYPE = "decimal(18,4)"


def money(column: str | Column) -> Column:
    """A reported amount as exact cents."""
    return _col(column).cast(TICKET_TYPE)


def money_sum(column: str | Column) -> Column:
    return F.sum(money(column))


def signed(amount: Column, status: str | Column = "status") -> Column:
    """Returned tickets subtract; every other status adds."""
    return F.when(_col(status) == RETURNED, -amount).otherwise(amount)


def net_amount(total: str | Column = "total_amount", status: str | Column = "status") -> Column:
    return signed(money(total), status)


def line_amount(quantity: str | Column = "quantity", price: str | Column = "unit_price") -> Column:
    return (_col(quantity) * _col(price)).cast(LINE_TYPE)


def line_cost(quantity: str | Column = "quantity", cost: str | Column = "cost") -> Column:
    return (_col(quantity) * _col(cost)).cast(LINE_TYPE)


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def transaction_count(unique_ids: bool = False, key: str = "transaction_id") -> Column:
    """Distinct tickets.  With ``unique_ids`` the key is trusted (``dq_duplicate_keys`` is zero),
    which replaces a shuffle of every ticket id by a map-side count."""
    return F.count(key) if unique_ids else F.count_distinct(key)


def average_ticket(unique_ids: bool = False, positive_only: bool = False) -> Column:
    """Net sales per ticket as an aggregate.  ``positive_only`` leaves tickets whose reported total
    is zero or less out of both sides."""
    net, counted = net_amount(), F.col("transaction_id")
    if positive_only:
        positive = F.col("total_amount") > 0
        net, counted = F.when(positive, net), F.when(positive, counted)
    return ratio(F.sum(net), F.count(counted) if unique_ids else F.count_distinct(counted))


def week_start(day: str | Column) -> Column:
    """Monday of the week holding ``day``."""
    return F.date_trunc("week", _col(day)).cast("date")


def month_index_diff(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def surrogate_key(*columns: str | Column) -> Column:
    """Stable BIGINT key: the first 60 bits of SHA-256 over the natural key.  Independent of
    partitioning and of load order, so facts and dimensions can be built by separate jobs.  Each
    part carries its length, and NULL a mark of its own, so no two natural keys share a text; a
    natural key that is NULL throughout has a NULL key."""
    parts = [_col(c).cast("string") for c in columns]
    text = F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])
    key = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
    return F.when(F.coalesce(*parts).isNotNull(), key)


def row_hash(columns: list[str]) -> Column:
    """Change detector for upserts.  A NULL and an empty string hash differently, and moments count to
    the microsecond."""
    moment = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": f"{moment}XXX", "timestampNTZFormat": moment}
    return F.sha2(F.to_json(F.struct(*sorted(columns)), options), 256)


def category_en(column: str | Column) -> Column:
    """English category name; unknown categories pass through."""
    pairs = [F.lit(text) for item in CATEGORY_EN.items() for text in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(column)), _col(column))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
