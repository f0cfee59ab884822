"""Capacity tiers: code a rating text or an amount, then combine sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segment_code(c, mapping: dict | None = None, default: int = 0) -> Column:
    """Map rating segment texts to tier codes; unknown or NULL -> ``default``.

    The mapping is grouped per code into ``isin`` tests, lowest code first,
    which is the first-match order of the rule book.
    """
    mapping = P.SEGMENT_CODES if mapping is None else mapping
    by_code: dict[int, list[str]] = {}
    for text, code in mapping.items():
        by_code.setdefault(code, []).append(text)
    expr = None
    for code in sorted(by_code):
        cond = _col(c).isin(by_code[code])
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def numeric_tier(c, cutoffs=P.CAPACITY_CUTOFFS, default: int = 0) -> Column:
    """Tier 1 for the largest lower bound, 2 for the next ... ; below the
    smallest bound or NULL -> ``default``."""
    c = _col(c)
    expr = None
    for code, bound in enumerate(sorted(cutoffs, reverse=True), start=1):
        cond = c >= F.lit(bound)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(default))


def tier_label(code, labels: dict | None = None, none_label: str = P.NO_TIER_LABEL) -> Column:
    labels = P.TIER_LABELS if labels is None else labels
    code = _col(code)
    expr = None
    for k in sorted(labels):
        expr = F.when(code == k, F.lit(labels[k])) if expr is None else expr.when(code == k, F.lit(labels[k]))
    return expr.otherwise(F.lit(none_label))


def combine_tiers(primary, fallback, labels: dict | None = None,
                  primary_source: str = P.SOURCE_RESEARCH,
                  fallback_source: str = P.SOURCE_VENDOR) -> tuple[Column, Column]:
    """(label, source): the primary code unless it is 0, then the fallback
    code; the source is NULL when both are 0."""
    primary, fallback = _col(primary), _col(fallback)
    label = F.when(primary == 0, tier_label(fallback, labels)).otherwise(tier_label(primary, labels))
    source = (F.when((primary == 0) & (fallback == 0), F.lit(None).cast("string"))
              .when(primary == 0, F.lit(fallback_source))
              .otherwise(F.lit(primary_source)))
    return label, source
