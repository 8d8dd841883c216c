"""The two margins and the line mean. They look alike and must not be swapped."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SUM = "decimal(22,4)"


def row_margin(profit: Column, sales: Column) -> Column:
    """Margin of one sale in percent, 4 digits; 0 where sales are exactly zero.

    Negative sales do get a margin. Works on doubles, like the source values.
    """
    return F.when(sales != 0, F.round(profit / sales * 100, 4)).otherwise(F.lit(0.0))


def margin_sql(profit_sum: str, sales_sum: str) -> str:
    """Margin of summed profit over summed sales, 2 digits; 0 unless sales are positive."""
    profit, sales = f"cast({profit_sum} AS {SUM})", f"cast({sales_sum} AS {SUM})"
    return f"CASE WHEN {sales} > 0 THEN round({profit} / {sales} * 100, 2) ELSE 0 END"


def margin_pct(profit_sum: str, sales_sum: str) -> Column:
    return F.expr(margin_sql(profit_sum, sales_sum))


def mean_line_sql(sales_sum: str, lines: str) -> str:
    """Mean sale per line, 2 digits. Dividing exact sums keeps 20 digits before rounding."""
    return f"round(cast({sales_sum} AS {SUM}) / {lines}, 2)"


def mean_line(sales_sum: str, lines: str) -> Column:
    return F.expr(mean_line_sql(sales_sum, lines))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: mean of value weighted by weight; NULL where the weights sum to zero."""
    value, weight = value.cast("double"), weight.cast("double")
    return F.try_divide(F.sum(value * weight), F.sum(weight))
