"""Crediting rules: role sums, credited dollars, goal levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P

MONEY = T.DecimalType(18, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def role_dollars(df: DataFrame, keys: Sequence[str], role: str = "solicitor_level",
                 amount: str = "gift_amt", lead_role: str = P.LEAD_ROLE,
                 co_role: str = P.CO_ROLE, lead_name: str = "lead_dollars",
                 co_name: str = "co_dollars", positive_only: bool = True,
                 total_name: str | None = None) -> DataFrame:
    """Lead and co-solicitor sums per key, in one pass (conditional sums;
    partial aggregation runs before the shuffle, so a hot key only sends one
    partial row per task).  Money is summed as decimal: exact and
    order-independent.  ``positive_only`` keeps groups whose total is > 0;
    ``total_name`` also returns the total of all rows."""
    amt = _col(amount).cast(MONEY)
    r = _col(role)
    out = df.groupBy(*keys).agg(
        F.sum(F.when(r == lead_role, amt).otherwise(F.lit(0).cast(MONEY))).cast(MONEY).alias(lead_name),
        F.sum(F.when(r == co_role, amt).otherwise(F.lit(0).cast(MONEY))).cast(MONEY).alias(co_name),
        F.sum(amt).alias("__total"))
    if positive_only:
        out = out.where(F.col("__total") > 0)
    return out.withColumnRenamed("__total", total_name) if total_name else out.drop("__total")


def regroup_dollars(df: DataFrame, keys: Sequence[str], lead_name: str = "lead_dollars",
                    co_name: str = "co_dollars", total_name: str = "total_dollars",
                    positive_only: bool = True) -> DataFrame:
    """Sum pre-aggregated lead / co / total sums again over coarser or joined
    keys.  Sums distribute over joins, so aggregating per solicitor first and
    regrouping after the officer join gives the per-row result."""
    out = df.groupBy(*keys).agg(F.sum(lead_name).cast(MONEY).alias(lead_name),
                                F.sum(co_name).cast(MONEY).alias(co_name),
                                F.sum(total_name).alias("__total"))
    if positive_only:
        out = out.where(F.col("__total") > 0)
    return out.drop("__total")


def credited_dollars(lead, co, count_all_flag, goal_lvl4, test_on: str = "lead") -> Column:
    """Dollars credited to an officer.

    Lead + co when the officer's team counts everything, or when the goal
    test passes; the lead dollars alone otherwise.  ``test_on="lead"`` tests
    the lead dollars against the level-4 goal; ``test_on="total"`` tests
    lead + co and falls back to the lead dollars when the goal is missing.
    A missing goal never passes (NULL comparison).
    """
    lead, co, flag, lvl4 = map(_col, (lead, co, count_all_flag, goal_lvl4))
    both = lead + co
    tested = lead if test_on == "lead" else both
    if test_on not in ("lead", "total"):
        raise ValueError("test_on must be 'lead' or 'total'")
    expr = F.when(flag == F.lit("Y"), both).when(tested >= lvl4, both)
    if test_on == "lead":
        return expr.otherwise(lead)
    return expr.when(tested < lvl4, lead).when(lvl4.isNull(), lead)


def goal_level(dollars, single, lvl3, lvl4, lvl5) -> Column:
    """'Goal Achieved' against a single goal; with a single goal of 0 the
    highest of levels 5, 4, 3 reached.  A NULL single goal is neither 0 nor
    reachable, so it gives NULL (levels are not looked at)."""
    d, single, l3, l4, l5 = map(_col, (dollars, single, lvl3, lvl4, lvl5))
    levels = (F.when(d >= l5, F.lit(P.LEVEL_ACHIEVED[5]))
              .when(d >= l4, F.lit(P.LEVEL_ACHIEVED[4]))
              .when(d >= l3, F.lit(P.LEVEL_ACHIEVED[3])))
    return (F.when(single == 0, levels)
            .otherwise(F.when(d >= single, F.lit(P.GOAL_ACHIEVED))))


def effective_goal(single, lvl3) -> Column:
    """The single goal when present, else the level-3 goal."""
    return F.coalesce(_col(single), _col(lvl3))
