from tendero.functions.columns import (
    average_ticket,
    category_en,
    line_amount,
    line_cost,
    money,
    money_sum,
    month_index_diff,
    net_amount,
    ratio,
    row_hash,
    signed,
    surrogate_key,
    transaction_count,
    week_start,
)
from tendero.functions.student_t import t_critical, t_two_sided_p

__all__ = [
    "average_ticket",
    "category_en",
    "line_amount",
    "line_cost",
    "money",
    "money_sum",
    "month_index_diff",
    "net_amount",
    "ratio",
    "row_hash",
    "signed",
    "surrogate_key",
    "t_critical",
    "t_two_sided_p",
    "transaction_count",
    "week_start",
]
