"""Registered queries: a DataFrame builder and its oracle SQL for each.

Every builder takes ``(spark, sf_dir)``, reads the whole test tables
through the stand-ins and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.fiscal import fiscal_year, in_report_range
from ..operators import trigram
from ..operators.distinct import distinct_bitmaps, distinct_counts
from ..params import Params
from ..sources import standins
from ..sources.goals import rejected_cells
from . import activity as A
from . import audit as AU
from . import checks as C
from . import dimensions as D
from . import oracle as O
from . import scorecard as SC
from . import top_gifts as TG

MONEY = T.DecimalType(18, 2)
AS_OF = _dt.date(1997, 6, 1)          # fixed "today" of the future-ask checks, inside the range
NAME_FRAGMENT = "00000001"            # name search of the checks
SAMPLE_ACCOUNTS = (736, 262)          # accounts browsed by the account checks


@dataclass
class Ctx:
    """The lazy stand-in plans of one call."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def params(self) -> Params:
        return standins.standin_params(self.sf_dir)

    @cached_property
    def crm(self) -> standins.Crm:
        crm = standins.load(self.spark, self.sf_dir, self.params)
        return standins.collated(crm, self.params.collation)

    @cached_property
    def key(self) -> DataFrame:
        return D.name_key(self.crm, self.params)

    @cached_property
    def goals(self) -> DataFrame:
        return D.goals(self.crm, self.key)

    @cached_property
    def activity_list(self) -> DataFrame:
        return A.activity_list(self.crm, self.key, self.params)

    @cached_property
    def counted_visits(self) -> DataFrame:
        return A.counted_visits(self.crm, self.key, self.params)


def context(spark: SparkSession, sf_dir: str) -> Ctx:
    """A context per call: file listings and plans are never older than it."""
    return Ctx(spark, sf_dir)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _fiscal_year(c: Ctx) -> DataFrame:
    o = c.crm.opportunity
    return o.select(F.col("id").alias("OpportunityID"), "close_date", "ask_date",
                    fiscal_year("close_date", c.params.fy_start_month).alias("close_fy"),
                    fiscal_year("ask_date", c.params.fy_start_month).alias("ask_fy"))


def _date_window(c: Ctx) -> DataFrame:
    """Sums over opportunity x team rows, weighted by the team's row count
    instead of joining its rows."""
    team = (c.crm.opportunity_team.where(F.col("opportunity_id").isNotNull())
            .groupBy("opportunity_id").agg(F.count(F.lit(1)).alias("n_team")))
    o = c.crm.opportunity.where(in_report_range("ask_date", c.params) | in_report_range("close_date", c.params))
    o = o.join(team, o["id"] == team["opportunity_id"], "left").withColumn("n", F.coalesce("n_team", F.lit(1)))
    return (o.groupBy(fiscal_year("close_date").alias("comb_fy"), F.col("stage").alias("StageName"))
            .agg(F.sum("n").alias("n"), F.sum(F.col("amount") * F.col("n")).cast(MONEY).alias("gift_amt")))


def _role_dollars(c: Ctx) -> DataFrame:
    from ..functions.fiscal import in_fy
    from ..operators.credit import regroup_dollars, role_dollars
    p = c.params
    rows = c.activity_list.where((F.col("source") == P.SOURCE_DOLLARS)
                                 & in_fy("gift_date", p.current_fy, p)
                                 & F.col("StageName").isin(list(p.accepted_stages)))
    per_solicitor = role_dollars(rows, ["solicitor"], "solicitor_level", "gift_amt", p.lead_role,
                                 p.co_role, positive_only=False, total_name="total_dollars")
    nk = c.key.where(F.col("do_id").isNotNull()).select(
        "do_id", F.col("first_last").alias("solicitor"), "do_team", "do_level")
    j = per_solicitor.join(nk, "solicitor", "inner")
    return regroup_dollars(j, ["do_id", "solicitor", "do_team", "do_level"])


def _branch(source: str):
    def f(c: Ctx) -> DataFrame:
        return c.activity_list.where(F.col("source") == source)
    return f


def _name_forms(c: Ctx) -> DataFrame:
    from ..functions.names import first_last, last_first, last_first_comma, sort_name
    u = c.crm.user
    return u.select(F.col("id").alias("user_id"), "name",
                    first_last("first_name", "last_name").alias("first_last"),
                    last_first("first_name", "last_name").alias("last_first"),
                    last_first_comma("first_name", "last_name").alias("last_first_comma"),
                    sort_name("first_name", "last_name").alias("sort_name"))


def _team_flag(c: Ctx) -> DataFrame:
    from ..functions.names import team_flag
    team = c.crm.team.select(F.col("id").alias("team_id"), F.col("name").alias("do_team"))
    o = c.crm.officer.join(team, "team_id", "left")
    return o.select("user_id", "do_team", "level",
                    team_flag("do_team", c.params.count_all_teams, c.params.collation).alias("count_all_flag"))


def _segment_code(c: Ctx) -> DataFrame:
    from ..functions.tiers import segment_code
    return c.crm.rating.select("account_id", "record_type_id", "segment",
                               segment_code("segment", c.params.segment_codes).alias("segment_code"))


def _numeric_tier(c: Ctx) -> DataFrame:
    from ..functions.tiers import numeric_tier, tier_label
    code = numeric_tier("capacity", c.params.capacity_cutoffs)
    return c.crm.account.select(F.col("id").alias("account_id"), "capacity",
                                code.alias("capacity_code"), tier_label(code).alias("capacity_label"))


def _goal_level(c: Ctx) -> DataFrame:
    d = SC.dollars_rollup(c.activity_list, c.key, c.goals, c.params)
    return d.select("do_id", "goal_dollars", "goal_achieved")


def _visit_bitmaps(c: Ctx) -> DataFrame:
    """The distinct visit activities per visitor and fiscal year, as bitmaps."""
    v = c.counted_visits.where(F.col("contactor").isNotNull())
    return distinct_bitmaps(v, ["visitor", "comb_fy"], "activity_id")


def _name_search(c: Ctx) -> DataFrame:
    """As ``qa_name_search``, through trigram postings of the names."""
    return trigram.search(c.key, "first_last", trigram.postings(c.key, "first_last"), NAME_FRAGMENT)


QUERIES: dict[str, Callable[[Ctx], DataFrame]] = {
    # step 1: credited dollars
    "credited_dollars": lambda c: SC.dollars_rollup(c.activity_list, c.key, c.goals, c.params),
    "credited_dollars_total": lambda c: SC.dollars_rollup(c.activity_list, c.key, c.goals,
                                                          c.params, test_on="total"),
    "role_dollars": _role_dollars,
    # step 2: fiscal years and windows
    "fiscal_year": _fiscal_year,
    "fy_amount_columns": lambda c: A.opportunities(c.crm, c.params),
    "date_window": _date_window,
    # step 3: unpivots
    "contactors_unpivot": lambda c: A.contacts_visits(c.crm, c.params),
    "contact_links_unpivot": lambda c: A.activities(c.crm, c.params),
    # step 4-5: dimensions
    "name_key": lambda c: c.key,
    "name_forms": _name_forms,
    "team_flag": _team_flag,
    "segment_code": _segment_code,
    "numeric_tier": _numeric_tier,
    "capacity_tier": lambda c: D.capacity_tiers(c.crm, c.params),
    "capacity_tier_best": lambda c: D.capacity_tiers(c.crm, c.params, prefer="best"),
    # step 6: flattened views
    "proposals": lambda c: AU.proposals(c.crm),
    "proposal_wide": lambda c: AU.proposal_wide(c.crm),
    "prospects": lambda c: AU.prospects(c.crm),
    "task_audit": lambda c: AU.tasks(c.crm),
    "audit_names": lambda c: AU.audit_names(c.crm),
    "activity_audit": lambda c: AU.activity_audit(c.crm, c.params),
    "activity_contacts_audit": lambda c: AU.activity_contacts_audit(c.crm, c.params),
    # step 7: goals
    "goals_import": lambda c: c.goals,
    "goal_rejects": lambda c: rejected_cells(c.crm.goals_import),
    "effective_goal": lambda c: SC.effective_goals(c.goals, c.params),
    "goal_level": _goal_level,
    # step 8-9: the activity list
    "visits_qualified": _branch(P.SOURCE_VISITS),
    "asks_qualified": _branch(P.SOURCE_ASKS),
    "dollars_dedup": _branch(P.SOURCE_DOLLARS),
    "activity_list": lambda c: c.activity_list,
    # step 10: scorecard
    "visits_rollup": lambda c: SC.visits_rollup(c.counted_visits, c.key, c.params),
    "visits_by_id": lambda c: SC.visits_rollup(c.counted_visits, c.key, c.params, match="id"),
    "visits_distinct": lambda c: SC.visits_rollup(c.counted_visits, c.key, c.params, count="activities"),
    "visits_distinct_by_fy": lambda c: distinct_counts(_visit_bitmaps(c), ["visitor", "comb_fy"], "visits"),
    "visits_distinct_years": lambda c: distinct_counts(_visit_bitmaps(c), ["visitor"], "visits"),
    "scorecard_resolved": lambda c: SC.scorecard(c.activity_list, c.key, c.goals, c.params,
                                                 visit_rows=c.counted_visits, match="resolved"),
    "asks_rollup": lambda c: SC.asks_rollup(c.activity_list, c.key, c.params),
    "scorecard": lambda c: SC.scorecard(c.activity_list, c.key, c.goals, c.params,
                                        visit_rows=c.counted_visits),
    "scorecard_all_officers": lambda c: SC.scorecard(c.activity_list, c.key, c.goals, c.params,
                                                     drive="all", visit_rows=c.counted_visits),
    # step 11: top gifts
    "top_gifts": lambda c: TG.top_gifts(c.crm, c.params),
    "top_gifts_labelled": lambda c: TG.top_gifts_labelled(c.crm, c.params),
    "top_gifts_merged": lambda c: TG.top_gifts_merged(c.crm, c.params),
    "top_gifts_by_opportunity": lambda c: TG.top_gifts_merged(c.crm, c.params, on="opportunity"),
    "top_gifts_by_lead_name": lambda c: TG.top_gifts_by_lead_name(c.crm, c.params),
    # step 12: households
    "household_label": lambda c: D.household(c.crm),
    # step 13: checks
    "qa_distinct_values": lambda c: C.distinct_values(c.crm.opportunity_team, "role"),
    "qa_distinct_substantive": lambda c: C.distinct_values(AU.activity_audit(c.crm, c.params), "Substantive_Activity"),
    "qa_distinct_types": lambda c: C.distinct_values(AU.activity_audit(c.crm, c.params), "ActivityType"),
    "qa_distinct_teams": lambda c: C.distinct_values(c.key, "do_team"),
    "qa_distinct_status": lambda c: C.distinct_values(c.crm.activity, "status"),
    "qa_distinct_account_status": lambda c: C.distinct_values(c.crm.account, "status"),
    "qa_column_browse": lambda c: C.browse(AU.activity_audit(c.crm, c.params), "ActivityType", "Visit"),
    "qa_name_search": lambda c: C.name_search(c.key, "first_last", NAME_FRAGMENT),
    "name_postings": lambda c: trigram.postings(c.key, "first_last"),
    "qa_name_search_postings": _name_search,
    "qa_status_counts": lambda c: C.status_counts(c.crm, c.params),
    "qa_null_status": lambda c: C.null_status(c.crm),
    "qa_counts_by_owner": lambda c: C.counts_by_owner(AU.activity_audit(c.crm, c.params), NAME_FRAGMENT),
    "qa_types_of_people": lambda c: C.types_of_people(AU.activity_audit(c.crm, c.params),
                                                      c.params.visit_people),
    "qa_owner_mismatch": lambda c: C.owner_mismatch(c.crm),
    "qa_multi_lead_self": lambda c: C.multi_lead_self(c.crm),
    "qa_known_leads": lambda c: C.known_leads(c.crm, c.key),
    "qa_multi_lead_named": lambda c: C.multi_lead_named(c.crm, c.params),
    "qa_lead_mismatch": lambda c: C.lead_mismatch(c.crm, c.params),
    "qa_lead_mismatch_long": lambda c: C.lead_mismatch(c.crm, c.params, long_form=True),
    "qa_officer_leads": lambda c: C.officer_leads(c.crm, c.key, c.params),
    "qa_lead_dollars_name": lambda c: C.lead_dollars_for_name(c.crm, c.params, NAME_FRAGMENT),
    "qa_reconcile": lambda c: C.reconcile_dollars(c.crm, c.activity_list, c.params),
    "qa_lead_dollars": lambda c: C.lead_dollars(c.crm, c.params),
    "qa_visit_contacts": lambda c: A.visit_contacts(c.crm, c.params),
    "qa_accepted_sorted": lambda c: C.accepted_sorted(c.activity_list, c.params),
    "qa_low_amount": lambda c: C.low_amount_list(c.activity_list),
    "qa_low_amount_opps": lambda c: C.low_amount_opportunities(c.crm),
    "qa_future_asks": lambda c: C.future_asks_list(c.activity_list, AS_OF),
    "qa_future_asks_opps": lambda c: C.future_asks_opportunities(c.crm, AS_OF),
    "qa_account_rows": lambda c: C.account_rows_list(c.activity_list, SAMPLE_ACCOUNTS),
    "qa_account_rows_opps": lambda c: C.account_rows_opportunities(c.crm, SAMPLE_ACCOUNTS),
    "qa_multi_lead": lambda c: C.multi_lead(c.crm, c.params),
    "qa_unmatched_goals": lambda c: C.unmatched_goals(c.goals),
    "qa_collapsed_dollars": lambda c: C.collapsed_dollars(A.dollar_candidates(c.crm, c.params),
                                                          _branch(P.SOURCE_DOLLARS)(c)),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, fn in QUERIES.items():
        def run(spark, sf_dir, _fn=fn):
            return _fn(context(spark, sf_dir))
        run.__name__ = name
        out[name] = run
    return out


# ---------------------------------------------------------------------------
# Oracle side
# ---------------------------------------------------------------------------

def oracle_sql(params: Params | None = None) -> dict[str, str]:
    from .oracle_queries import finals
    p = params or standins.standin_params()
    return {name: O.compose(p, final, extra) for name, (final, extra) in finals(p).items()}
