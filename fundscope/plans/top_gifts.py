"""Top-gifts list with a solicitor label (P7, P7a-c and the older P14 form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.fiscal import in_fy
from ..functions.names import is_blank
from ..operators.ranking import owner_label, top_n
from ..params import Params
from ..sources.standins import Crm

MONEY = T.DecimalType(18, 2)


def _accepted_in_fy(crm: Crm, params: Params, fy: int, exclude_ids: bool = True) -> DataFrame:
    o = crm.opportunity.where(F.col("stage").isin(list(params.accepted_stages))
                              & in_fy("close_date", fy, params))
    if exclude_ids and params.excluded_opportunity_ids:
        o = o.where(~F.col("id").isin(list(params.excluded_opportunity_ids)))
    return o


def top_gifts(crm: Crm, params: Params, fy: int | None = None, n: int | None = None,
              exclude_ids: bool = True) -> DataFrame:
    """The n largest accepted gifts of one FY per account x opportunity,
    largest sum first, then latest close date; ties broken by account and
    opportunity id so the list is stable across runs and task retries.

    Accepted opportunities of the FY are aggregated per (account,
    opportunity) first and only then meet the account names; the top-n is
    a ``TakeOrderedAndProject`` (n rows per task reach the driver)."""
    fy = params.current_fy if fy is None else fy
    n = params.top_n if n is None else n
    o = _accepted_in_fy(crm, params, fy, exclude_ids)
    per = (o.groupBy(F.col("account_id").alias("AccountID"), F.col("id").alias("opportunity_ID"))
           .agg(F.sum("amount").cast(MONEY).alias("gift_amt"),
                F.max("close_date").alias("gift_date"),
                F.countDistinct("lead_solicitor_id").alias("total_sols")))
    acc = crm.account.select(F.col("id").alias("AccountID"), F.col("name").alias("hh_name"))
    # grouping key includes the account name: one row per account x name
    j = per.join(acc, "AccountID", "inner")
    t = top_n(j, n, [F.col("gift_amt").desc_nulls_last(), F.col("gift_date").desc_nulls_last()],
              ["AccountID", "hh_name", "opportunity_ID"])
    return t.select("AccountID", "hh_name", "gift_amt", "gift_date", "total_sols", "opportunity_ID")


def top_gifts_labelled(crm: Crm, params: Params, fy: int | None = None, n: int | None = None,
                       on: str = "account") -> DataFrame:
    """Each listed gift labelled with its solicitor, then the distinct
    top n again.

    ``on="account"`` re-attaches every accepted FY opportunity of the same
    account (the dashboard's join: an account with several gifts gets a row
    per gift label and can push other rows off the list).  ``on="opportunity"``
    joins the gift's own opportunity only.  The n listed rows are broadcast
    back: their size is n, whatever the input."""
    fy = params.current_fy if fy is None else fy
    n = params.top_n if n is None else n
    tg = top_gifts(crm, params, fy, n)
    o = _accepted_in_fy(crm, params, fy).select(
        F.col("account_id").alias("__acc"), F.col("id").alias("__opp"),
        F.col("lead_solicitor_id").alias("__lead"))
    if on == "account":
        cond = tg.AccountID == o.__acc
    elif on == "opportunity":
        cond = tg.opportunity_ID == o.__opp
    else:
        raise ValueError("on must be 'account' or 'opportunity'")
    j = o.join(F.broadcast(tg), cond, "inner")
    users = crm.user.select(F.col("id").alias("__uid"), F.col("name").alias("__lead_name"))
    j = j.join(users, j.__lead == users.__uid, "left")
    label = owner_label("total_sols", "__acc", "gift_amt", "__lead", "__lead_name",
                        params.multiple_lead_overrides)
    rows = j.select("AccountID", "hh_name", "gift_amt", "gift_date", "opportunity_ID",
                    label.alias("solicitor")).distinct()
    return top_n(rows, n, [F.col("gift_amt").desc_nulls_last(), F.col("gift_date").desc_nulls_last()],
                 ["AccountID", "opportunity_ID", "solicitor", "hh_name"])


def top_gifts_merged(crm: Crm, params: Params, fy: int | None = None, n: int | None = None,
                     on: str = "account") -> DataFrame:
    """Rows of one account with equal amount, date and label are merged
    and their amounts summed (the amount is part of the key)."""
    b = top_gifts_labelled(crm, params, fy, n, on)
    return (b.groupBy("AccountID", "hh_name", "gift_amt", "gift_date", "solicitor")
            .agg(F.sum("gift_amt").cast(MONEY).alias("__sum"))
            .select("AccountID", "hh_name", F.col("__sum").alias("gift_amt"), "gift_date", "solicitor"))


def top_gifts_by_lead_name(crm: Crm, params: Params, fy: int | None = None,
                           n: int = 30) -> DataFrame:
    """P14 (older form): the top n without id exclusions, one row per lead
    name found on the account's accepted FY gifts; label 'several' when the
    opportunity had several leads, 'none entered' for a blank name."""
    fy = params.current_fy if fy is None else fy
    tg = top_gifts(crm, params, fy, n, exclude_ids=False)
    o = _accepted_in_fy(crm, params, fy, exclude_ids=False).select(
        F.col("account_id").alias("__acc"), F.col("lead_solicitor_id").alias("__lead"))
    users = crm.user.select(F.col("id").alias("__uid"), F.col("name").alias("propsolnam"))
    sol = o.join(users, o.__lead == users.__uid, "left").select("__acc", "propsolnam")
    j = tg.join(sol, tg.AccountID == sol.__acc, "left")
    label = (F.when(F.col("total_sols") > 1, F.lit(P.MULTIPLE_LEADS))
             .when(is_blank("propsolnam"), F.lit(P.NO_LEAD))
             .otherwise(F.col("propsolnam")))
    return j.select("AccountID", "hh_name", "gift_amt", "gift_date", label.alias("solicitor"),
                    "opportunity_ID").distinct()
