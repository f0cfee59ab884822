"""Ordering operators: top-n lists, first-two-per-key, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.names import is_blank

MONEY = T.DecimalType(18, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_n(df: DataFrame, n: int, order: Sequence[Column], tie_break: Sequence[str]) -> DataFrame:
    """``TOP n ... ORDER BY``: the n first rows in ``order``, ties broken by
    ``tie_break`` so the result is the same on every run and every retry.
    Planned as ``TakeOrderedAndProject``: each task keeps its own n best,
    only n x tasks rows move, whatever the input size."""
    return df.orderBy(*order, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(n)


def first_two(df: DataFrame, key: str, order: Sequence[Column], value: str,
              first_name: str = "first_value", second_name: str = "second_value") -> DataFrame:
    """Per key, the value on rank 1 and on rank 2 of ``order`` (rank 2 NULL
    when the key has one row; ``has_first`` tells whether rank 1 exists).

    ``row_number() <= 2`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so at most two rows per key leave each task: a key
    holding a third of all rows costs no more than any other.  The two ranks
    are then folded by one conditional aggregate instead of a self join."""
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.select(key, value, F.row_number().over(w).alias("__rn")).where(F.col("__rn") <= 2)
    return ranked.groupBy(key).agg(
        F.max(F.when(F.col("__rn") == 1, F.col(value))).alias(first_name),
        F.max(F.when(F.col("__rn") == 2, F.col(value))).alias(second_name),
        F.max(F.col("__rn") == 1).alias("has_first"),
        F.max(F.col("__rn") == 2).alias("has_second"))


def household_label(first, second, separator: str = P.HOUSEHOLD_SEPARATOR) -> Column:
    """'first & second' with trailing blanks trimmed; the first alone when
    the second is NULL; the second alone when only it exists; NULL when
    neither."""
    a, b = F.rtrim(_col(first)), F.rtrim(_col(second))
    return (F.when(a.isNull() & b.isNull(), F.lit(None).cast("string"))
            .when(a.isNull(), b)
            .when(b.isNull(), a)
            .otherwise(F.concat(a, F.lit(separator), b)))


def owner_label(total_leads, account, amount, lead_id, lead_name,
                overrides: Sequence[tuple] = ()) -> Column:
    """Who gets the gift on the list: several leads, a manual override
    (account, amount), no lead entered (NULL or blank id), else the lead's
    name."""
    expr = F.when(_col(total_leads) > 1, F.lit(P.MULTIPLE_LEADS))
    for acct, amt in overrides:
        expr = expr.when((_col(account) == F.lit(acct)) & (_col(amount) == F.lit(amt).cast(MONEY)),
                         F.lit(P.MULTIPLE_LEADS))
    return expr.when(is_blank(lead_id), F.lit(P.NO_LEAD)).otherwise(_col(lead_name))
