"""Data-quality checks (QA1-QA22): each returns a DataFrame of findings.

Checks that the dashboard author expected to return nothing ("should
return no rows") are plain filters: an empty result is a pass.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.fiscal import in_fy
from ..params import Params
from ..sources.standins import Crm

MONEY = T.DecimalType(18, 2)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """QA1: the distinct values of one column."""
    return df.select(column).distinct()


def browse(df: DataFrame, column: str, value) -> DataFrame:
    """QA2: the rows where ``column = value``."""
    return df.where(F.col(column) == F.lit(value))


def name_search(df: DataFrame, column: str, fragment: str) -> DataFrame:
    """QA3: rows whose name contains ``fragment`` (``LIKE '%x%'``)."""
    return df.where(F.col(column).contains(fragment))


def status_counts(crm: Crm, params: Params) -> DataFrame:
    """QA4: activity rows per status for the visit types."""
    return (crm.activity.where(F.col("type").isin(list(params.visit_types)))
            .groupBy(F.col("status").alias("Status"))
            .agg(F.count(F.lit(1)).alias("n")))


def null_status(crm: Crm) -> DataFrame:
    """QA5: activities without a status, counted per date."""
    return (crm.activity.where(F.col("status").isNull())
            .groupBy(F.col("status").alias("Status"), F.col("activity_date").alias("ActivityDate"))
            .agg(F.count(F.lit(1)).alias("n")))


def counts_by_owner(activity_audit: DataFrame, fragment: str) -> DataFrame:
    """QA6: activities per owner and type for owners matching a name."""
    return (activity_audit.where(F.col("OwnerName").contains(fragment))
            .groupBy("OwnerName", "ActivityType").agg(F.count(F.lit(1)).alias("n")))


def types_of_people(activity_audit: DataFrame, people: Sequence[str]) -> DataFrame:
    """QA7: the activity types logged by the named owners."""
    return (activity_audit.where(F.col("OwnerName").isin(list(people)))
            .select("ActivityType").distinct())


def owner_mismatch(crm: Crm) -> DataFrame:
    """QA8: activities whose owner is not the first contactor."""
    users = crm.user.select(F.col("id").alias("__uid"), F.col("name").alias("name2"))
    a = crm.activity.where(F.col("owner_id") != F.col("contactor_1"))
    j = a.join(users, a.owner_id == users.__uid, "left")
    return j.select(F.col("owner_id").alias("owner_id_1"), F.col("contactor_1").alias("ownerID_c1"),
                    "name2")


def multi_lead_self(crm: Crm) -> DataFrame:
    """QA9: opportunity ids carrying more than one lead on themselves
    (zero by construction: one id, one lead column)."""
    return (crm.opportunity.groupBy(F.col("id").alias("Id"),
                                    F.col("lead_solicitor_id").alias("Lead_Solicitor"))
            .agg(F.count("lead_solicitor_id").alias("count_lead_sol"))
            .where(F.col("count_lead_sol") > 1))


def known_leads(crm: Crm, key: DataFrame) -> DataFrame:
    """QA10: team-member names on opportunities whose lead is an officer."""
    o = crm.opportunity.join(key.select(F.col("do_id").alias("lead_solicitor_id")),
                             "lead_solicitor_id", "left_semi")
    t = crm.opportunity_team.select(F.col("opportunity_id"), F.col("name").alias("__member"))
    j = o.join(t, o.id == t.opportunity_id, "left")
    return j.select(F.col("__member").alias("name"),
                    F.col("lead_solicitor_id").alias("Lead_Solicitor")).distinct()


def _multi_lead(crm: Crm, params: Params, by_name: bool) -> DataFrame:
    keys = ["opportunity_id", "name"] if by_name else ["opportunity_id"]
    g = (crm.opportunity_team.where(F.col("role") == params.lead_role)
         .groupBy(*keys)
         .agg(F.countDistinct("user_id").alias("count_of_lead_sol"), F.count(F.lit(1)).alias("__n"))
         .where(F.col("count_of_lead_sol") > 1))
    return g.orderBy(F.col("__n").desc(), *keys).drop("__n")


def multi_lead_named(crm: Crm, params: Params) -> DataFrame:
    """QA11: several lead users on one opportunity under one name."""
    return _multi_lead(crm, params, by_name=True)


def multi_lead(crm: Crm, params: Params) -> DataFrame:
    """QA22: opportunities with several lead users."""
    return _multi_lead(crm, params, by_name=False)


def lead_mismatch(crm: Crm, params: Params, long_form: bool = False) -> DataFrame:
    """QA12: team rows with the lead role whose user is not the
    opportunity's lead."""
    o = crm.opportunity.select(F.col("id"), F.col("name").alias("opp_name"),
                               F.col("lead_solicitor_id"))
    t = crm.opportunity_team.where(F.col("role") == params.lead_role)
    j = o.join(t, o.id == t.opportunity_id, "inner").where(F.col("user_id") != F.col("lead_solicitor_id"))
    cols = [F.col("opportunity_id").alias("OpportunityId"), F.col("name").alias("team_name"), "opp_name"]
    if long_form:
        cols += [F.col("user_id").alias("UserId"), F.col("lead_solicitor_id").alias("Lead_Solicitor")]
    return j.select(*cols)


def officer_leads(crm: Crm, key: DataFrame, params: Params) -> DataFrame:
    """QA13: officer ids against opportunity leads and lead-role names."""
    k = key.select("do_id")
    o = crm.opportunity.select(F.col("id").alias("__opp"), F.col("lead_solicitor_id"))
    t = crm.opportunity_team.where(F.col("role") == params.lead_role).select(
        F.col("opportunity_id"), F.col("name"))
    j = (k.join(o, k.do_id == o.lead_solicitor_id, "inner")
         .join(t, F.col("__opp") == t.opportunity_id, "inner"))
    return j.select("name", F.col("lead_solicitor_id").alias("Lead_Solicitor"), "do_id").distinct()


def _lead_dollars(crm: Crm, params: Params, stages: Sequence[str], fy: int) -> DataFrame:
    o = crm.opportunity.where(in_fy("close_date", fy, params) & F.col("stage").isin(list(stages)))
    sums = o.groupBy("lead_solicitor_id").agg(F.sum("amount").alias("__amt"))
    users = crm.user.select(F.col("id").alias("__uid"), F.col("name").alias("Name"))
    # sum per lead id first (partial aggregation), then per name
    j = sums.join(users, sums.lead_solicitor_id == users.__uid, "left")
    return j.groupBy("Name").agg(F.sum("__amt").cast(MONEY).alias("lead_sol_dollars"))


def lead_dollars_for_name(crm: Crm, params: Params, fragment: str, fy: int | None = None) -> DataFrame:
    """QA14: lead dollars of one FY for names matching ``fragment``, over the
    wider stage list."""
    d = _lead_dollars(crm, params, params.wide_stages, params.current_fy if fy is None else fy)
    return d.where(F.col("Name").contains(fragment))


def lead_dollars(crm: Crm, params: Params, fy: int | None = None) -> DataFrame:
    """QA16: lead dollars of one FY per lead name (accepted stages)."""
    return _lead_dollars(crm, params, params.accepted_stages, params.current_fy if fy is None else fy)


def reconcile_dollars(crm: Crm, activity_list: DataFrame, params: Params,
                      fy: int | None = None) -> DataFrame:
    """QA15: lead dollars per name straight from opportunities against the
    activity list's lead rows, side by side, with the difference."""
    fy = params.current_fy if fy is None else fy
    src = lead_dollars(crm, params, fy)
    al = (activity_list.where(in_fy("gift_date", fy, params)
                              & F.col("StageName").isin(list(params.accepted_stages))
                              & (F.col("solicitor_level") == params.lead_role)
                              & (F.col("source") == P.SOURCE_DOLLARS))
          .groupBy("first_last").agg(F.sum("gift_amt").cast(MONEY).alias("list_dollars")))
    j = src.join(al, src.Name == al.first_last, "left")
    return j.select("Name", "lead_sol_dollars", "first_last", "list_dollars",
                    (F.col("lead_sol_dollars") - F.col("list_dollars")).cast(MONEY).alias("difference"))


def accepted_sorted(activity_list: DataFrame, params: Params) -> DataFrame:
    """QA18: accepted rows of the activity list ordered by ask amount, then
    by the other columns: rows without an ask amount are spread over the
    sort's partitions, and ties have one order."""
    return (activity_list.where(F.col("StageName").isin(list(params.accepted_stages)))
            .select("ask_date", "ask_amt", "gift_date", "gift_amt", "solicitor")
            .orderBy(*[F.col(c).asc_nulls_first() for c in
                       ("ask_amt", "gift_date", "gift_amt", "solicitor", "ask_date")]))


def low_amount_list(activity_list: DataFrame) -> DataFrame:
    """QA19a: accepted dollars rows below 1 (should be empty)."""
    return activity_list.where(F.col("StageName").contains("Accepted") & (F.col("gift_amt") < 1)
                               & (F.col("source") == P.SOURCE_DOLLARS))


def low_amount_opportunities(crm: Crm) -> DataFrame:
    """QA19b: accepted opportunities below 1 (should be empty)."""
    o = crm.opportunity.where(F.col("stage").contains("Accepted") & (F.col("amount") < 1))
    return o.select(F.col("id").alias("OpportunityID"), F.col("account_id").alias("AccountId"),
                    F.col("ask_date").alias("Ask_Date"), F.col("ask_amount").alias("Ask_Amount"),
                    F.col("close_date").alias("CloseDate"), F.col("amount").alias("Amount"),
                    F.col("stage").alias("StageName"))


def future_asks_list(activity_list: DataFrame, as_of: _dt.date) -> DataFrame:
    """QA20a: dollars rows asked on or after ``as_of`` with an amount.
    ``as_of`` is a parameter (not the clock) so the check is repeatable."""
    return activity_list.where((F.col("ask_amt") >= 1) & (F.col("ask_date") >= F.lit(as_of))
                               & (F.col("source") == P.SOURCE_DOLLARS))


def future_asks_opportunities(crm: Crm, as_of: _dt.date) -> DataFrame:
    """QA20b: opportunities asked after ``as_of`` with an amount."""
    o = crm.opportunity.where((F.col("ask_amount") >= 1) & (F.col("ask_date") > F.lit(as_of)))
    return o.select(F.col("id").alias("OpportunityID"), F.col("account_id").alias("AccountId"),
                    F.col("ask_date").alias("Ask_Date"), F.col("ask_amount").alias("Ask_Amount"),
                    F.col("close_date").alias("CloseDate"), F.col("amount").alias("Amount"),
                    F.col("stage").alias("StageName"))


def account_rows_list(activity_list: DataFrame, account_ids: Sequence) -> DataFrame:
    """QA21a: all dollars rows of the given accounts."""
    return activity_list.where((F.col("source") == P.SOURCE_DOLLARS)
                               & F.col("AccountID").isin(list(account_ids)))


def account_rows_opportunities(crm: Crm, account_ids: Sequence) -> DataFrame:
    """QA21b: all opportunities of the given accounts."""
    o = crm.opportunity.where(F.col("account_id").isin(list(account_ids)))
    return o.select(F.col("id").alias("OpportunityID"), F.col("account_id").alias("AccountId"),
                    F.col("ask_date").alias("Ask_Date"), F.col("ask_amount").alias("Ask_Amount"),
                    F.col("close_date").alias("CloseDate"), F.col("amount").alias("Amount"),
                    F.col("stage").alias("StageName"))


def unmatched_goals(goal_rows: DataFrame) -> DataFrame:
    """Goal rows whose 'Last, First' matched no officer."""
    return goal_rows.where(F.col("do_id").isNull()).select("last_first", "goal_fy")


def collapsed_dollars(opportunity_rows: DataFrame, dollars_rows: DataFrame) -> DataFrame:
    """How many dollars rows the de-duplication merged: input rows minus
    output rows, per solicitor level."""
    a = opportunity_rows.groupBy("solicitor_level").agg(F.count(F.lit(1)).alias("rows_in"))
    b = dollars_rows.groupBy("solicitor_level").agg(F.count(F.lit(1)).alias("rows_out"))
    return (a.join(b, "solicitor_level", "full")
            .select("solicitor_level", "rows_in", "rows_out",
                    (F.coalesce(F.col("rows_in"), F.lit(0)) - F.coalesce(F.col("rows_out"), F.lit(0)))
                    .alias("merged")))
