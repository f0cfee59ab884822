"""The data-quality checks as a gate of the refresh.

The author's checks that judge single rows are sums and counts, so they are
observed while a dataset is written (``DataFrame.observe``) and cost no scan of
their own.  Each metric may have a :class:`Limit`; the report says which hold,
and a broken limit that ``holds`` keeps the new version from being published.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions.fiscal import in_fy
from ..params import Params

REPORT = ("check string, dataset string, value double, previous double, rule string, "
          "passed boolean, holds boolean")


@dataclass(frozen=True)
class Limit:
    """What a metric may be: at most ``most``, at most ``grow`` times and at
    least ``shrink`` times its value in the version before, and apart from
    another metric (``dataset.metric``) by at most the share ``apart``."""

    most: float | None = None
    grow: float | None = None
    shrink: float | None = None
    like: str | None = None
    apart: float = 0.0
    holds: bool = True

    def rule(self) -> str:
        words = [f"at most {self.most:g}" if self.most is not None else "",
                 f"at most {self.grow:g} x before" if self.grow is not None else "",
                 f"at least {self.shrink:g} x before" if self.shrink is not None else "",
                 f"within {self.apart:g} of {self.like}" if self.like else ""]
        return ", ".join(w for w in words if w)

    def passed(self, value: float, previous: float | None, others: dict[str, float]) -> bool:
        if self.most is not None and value > self.most:
            return False
        if previous is not None and self.grow is not None and value > self.grow * previous:
            return False
        if previous is not None and self.shrink is not None and value < self.shrink * previous:
            return False
        if self.like is not None:
            other = others.get(self.like)
            return other is not None and abs(value - other) <= self.apart * max(abs(value), abs(other))
        return True


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def metrics(params: Params, as_of: _dt.date | None = None) -> dict[str, dict[str, Column]]:
    """Dataset -> check -> the sum or count to observe.

    ``as_of`` is the day after which an ask lies in the future (default: the
    last day of the current fiscal year, so that the check is repeatable)."""
    as_of = as_of or _dt.date(params.current_fy, params.fy_start_month, 1)
    accepted = F.col("StageName").isin(list(params.accepted_stages))
    lead = F.col("solicitor_level") == params.lead_role
    of_fy = in_fy("gift_date", params.current_fy, params)
    dollars = F.col("source") == P.SOURCE_DOLLARS
    low = F.col("StageName").contains("Accepted") & (F.col("gift_amt") < 1)
    ahead = (F.col("ask_amt") >= 1) & (F.col("ask_date") >= F.lit(as_of))
    amount = F.sum(F.when(accepted & lead & of_fy, F.col("gift_amt")))
    return {
        "goal_rejects": {"rejected_cells": F.sum("rejected_cells"), "blank_cells": F.sum("blank_cells")},
        "goal_rejected_rows": {},
        "do_goals": {"unmatched_goals": _count(F.col("do_id").isNull())},
        "activity_list": {
            "visits": _count(F.col("source") == P.SOURCE_VISITS),
            "asks": _count(F.col("source") == P.SOURCE_ASKS),
            "dollars": _count(dollars),
            "low_amounts": _count(dollars & low),                                     # QA19
            "future_asks": _count(dollars & ahead),                                   # QA20
            "lead_dollars": F.sum(F.when(dollars & accepted & lead & of_fy, F.col("gift_amt"))),  # QA15
            "without_fy": _count(F.col("comb_fy").isNull()),
        },
        "qry_proposal": {"low_amounts": _count(low), "future_asks": _count(ahead), "lead_dollars": amount},
        "activity_audit": {
            "null_status": _count(F.col("ActivityStatus").isNull()),                  # QA5
            "owner_mismatch": _count(F.col("OwnerID") != F.col("Contactor")),         # QA8
            "without_owner": _count(F.col("OwnerName").isNull()),
        },
        "comb_hh_capacities": {},
    }


#: What the author expected of the data; only a list that loses half its rows,
#: or dollars that do not come through to the list, hold a version back.
LIMITS: dict[str, Limit] = {
    "activity_list.rows": Limit(shrink=0.5),
    "activity_list.low_amounts": Limit(most=0, holds=False),
    "qry_proposal.low_amounts": Limit(most=0, holds=False),
    "activity_audit.null_status": Limit(grow=2, holds=False),
    "activity_audit.owner_mismatch": Limit(grow=2, holds=False),
    "do_goals.unmatched_goals": Limit(most=0, holds=False),
    "goal_rejected_rows.rows": Limit(most=0),
    # equal gifts are merged in the list, so it may stay somewhat below
    "activity_list.lead_dollars": Limit(like="qry_proposal.lead_dollars", apart=0.05),
}


def judged(seen: dict[str, dict[str, float]], before: dict[str, float],
           limits: dict[str, Limit]) -> list[tuple]:
    """Rows of :data:`REPORT`: every metric, those without a limit as passed."""
    flat = {f"{d}.{m}": float(v) for d, own in seen.items() for m, v in own.items()}
    rows = []
    for name, value in sorted(flat.items()):
        dataset, metric = name.split(".")
        limit = limits.get(name, Limit())
        passed = limit.passed(value, before.get(name), flat)
        rows.append((metric, dataset, value, before.get(name), limit.rule(), passed, limit.holds))
    return rows


def held_back(rows: list[tuple]) -> list[str]:
    """The broken checks that keep a version from being published."""
    return [f"{r[1]}.{r[0]}" for r in rows if not r[5] and r[6]]


def report_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, REPORT)
