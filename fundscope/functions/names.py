"""Name forms and team flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_last(first, last) -> Column:
    """'First Last'; NULL when either part is NULL (string ``+`` semantics)."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def last_first(first, last) -> Column:
    return F.concat(_col(last), F.lit(" "), _col(first))


def last_first_comma(first, last) -> Column:
    return F.concat(_col(last), F.lit(", "), _col(first))


def sort_name(first, last) -> Column:
    """'LAST/FIRST' in capitals, as used to sort contactors."""
    return F.concat(F.upper(_col(last)), F.lit("/"), F.upper(_col(first)))


def text(c, collation: str | None = None) -> Column:
    """A string column compared under ``collation`` (None: byte-wise)."""
    return F.collate(_col(c), collation) if collation else _col(c)


def team_flag(team, teams, collation: str | None = None) -> Column:
    """'Y' when ``team`` is one of ``teams``, else NULL (CASE without ELSE)."""
    return F.when(text(team, collation).isin(list(teams)), F.lit("Y"))


def kept_owner(name, excluded, collation: str | None = None) -> Column:
    """``name <> x`` for every excluded x: a NULL name never passes."""
    cond = _col(name).isNotNull()
    if excluded:
        cond = cond & ~text(name, collation).isin(list(excluded))
    return cond


def is_blank(c) -> Column:
    """NULL or the empty string (ids of any type are compared as text)."""
    c = _col(c)
    return c.isNull() | (c.cast("string") == F.lit(""))
