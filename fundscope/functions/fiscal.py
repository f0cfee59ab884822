"""Fiscal-year expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Params


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_year(c, start_month: int = 7) -> Column:
    """Fiscal year named for the calendar year it ends in.

    With a July start, 30 June 2018 -> 2018 and 1 July 2018 -> 2019.  A NULL
    date gives NULL.  Shifting the date forward by ``13 - start_month``
    months and taking its year is the same rule as
    ``CASE WHEN month >= start THEN year + 1 ELSE year END``.
    """
    d = F.to_date(_col(c))
    if start_month == 1:
        return F.year(d)
    return F.year(F.add_months(d, 13 - start_month))


def in_window(c, first: _dt.date, last: _dt.date) -> Column:
    """Closed date range on the *day*: a time on the last day still counts.

    ``to_date(c) BETWEEN first AND last`` is rewritten by Catalyst into a
    range on the raw column, so it still reaches the Parquet scan.
    """
    return F.to_date(_col(c)).between(F.lit(first), F.lit(last))


def in_fy(c, fy: int, params: Params) -> Column:
    first, last = params.fy_bounds(fy)
    return in_window(c, first, last)


def in_report_range(c, params: Params) -> Column:
    first, last = params.report_bounds
    return in_window(c, first, last)


def fy_column_name(fy: int) -> str:
    """``fy_18_gift_amount`` style name for one reporting year."""
    return f"fy_{fy % 100:02d}_gift_amount"


def fy_amount_columns(amount, close_date, stage, role, params: Params) -> list[Column]:
    """One column per reporting FY: the amount when the gift was accepted,
    the row is the lead solicitor's and the close date falls in that FY;
    NULL otherwise (no ELSE)."""
    amount, close_date, stage, role = map(_col, (amount, close_date, stage, role))
    base = stage.isin(list(params.accepted_stages)) & (role == F.lit(params.lead_role))
    return [
        F.when(base & in_fy(close_date, fy, params), amount).alias(fy_column_name(fy))
        for fy in params.report_fys
    ]
