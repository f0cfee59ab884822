"""Per-officer scorecard (P6, P6a-d): visits, asks, credited dollars, goals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.fiscal import in_fy
from ..functions.names import team_flag
from ..operators.credit import (credited_dollars, effective_goal, goal_level, regroup_dollars,
                               role_dollars)
from ..params import Params
from .dimensions import goals_for_fy

MONEY = T.DecimalType(18, 2)
GOAL_COLUMNS = ["visit_goal_lvl3", "visit_goal_lvl4", "visit_goal_lvl5", "visit_goal_single",
                "ask_goal_lvl3", "ask_goal_lvl4", "ask_goal_lvl5", "ask_goal_single",
                "dollar_goal_lvl3", "dollar_goal_lvl4", "dollar_goal_lvl5", "dollar_goal_single"]


def _by_name(rollup: DataFrame, name_col: str, key: DataFrame) -> DataFrame:
    """Attach the officer id by display name; unmatched names drop out.  The
    roll-up is aggregated first, so only one row per name meets the key."""
    nk = key.where(F.col("do_id").isNotNull()).select("do_id", F.col("first_last").alias("__name"))
    return rollup.join(nk, rollup[name_col] == nk.__name, "inner").drop("__name")


def shared_names(key: DataFrame) -> DataFrame:
    """Display names that several officers have (``__shared``)."""
    named = key.where(F.col("do_id").isNotNull() & F.col("first_last").isNotNull())
    return (named.groupBy(F.col("first_last").alias("__shared"))
            .agg(F.min("do_id").alias("__least"), F.max("do_id").alias("__most"))
            .where(F.col("__least") != F.col("__most")).select("__shared"))


def _resolved(rows: DataFrame, name_col: str, id_col: str, key: DataFrame, sums: dict,
              columns: tuple[str, ...] = ("do_id",)) -> DataFrame:
    """Roll ``rows`` up per name and attach the officer's ``columns``: by the
    name alone where one officer has it, by name and id where several do.
    ``sums`` maps an output name to its aggregate, a sum or a count.

    Rows are reduced to one per name and id before any join; ids count only
    under a shared name, so every other name is matched as by name."""
    shared = shared_names(key)
    per = rows.groupBy(F.col(name_col).alias("__name"), F.col(id_col).alias("__id")).agg(
        *[c.alias(n) for n, c in sums.items()])
    per = per.join(shared, F.col("__name") == F.col("__shared"), "left")
    per = (per.withColumn("__id", F.when(F.col("__shared").isNotNull(), F.col("__id")))
           .groupBy("__name", "__id").agg(*[F.sum(n).alias(n) for n in sums]))
    officers = key.where(F.col("do_id").isNotNull()).select(*columns, F.col("first_last").alias("__officer"))
    officers = officers.join(shared, F.col("__officer") == F.col("__shared"), "left")
    on = (F.col("__name") == F.col("__officer")) & (F.col("__shared").isNull() | (F.col("__id") == F.col("do_id")))
    return per.join(officers, on, "inner").select(F.col("__name").alias(name_col), *sums, *columns)


def visits_rollup(activity_list: DataFrame, key: DataFrame, params: Params,
                  fy: int | None = None, match: str = "name", count: str = "rows") -> DataFrame:
    """Visit rows per visitor in one FY (rows, not distinct activities:
    each contactor x contact link counts), with the officer id.

    Reads the stored list, or counted visits (``activity.counted_visits``),
    whose row counts are added up without repeating rows.  ``match="id"``
    attaches the officer by the contactor's id instead of the display name,
    so that namesakes do not share visits; ``match="resolved"`` does so for
    names that several officers share and goes by name for all others;
    ``count="activities"`` (counted visits only) counts distinct activities
    per visitor instead of rows."""
    fy = params.current_fy if fy is None else fy
    v = (activity_list.where((F.col("source") == P.SOURCE_VISITS) & in_fy("visit_date", fy, params)
                             & F.col("contactor").isNotNull())
         )
    if count == "activities":
        n = F.countDistinct("activity_id")
    else:
        n = F.sum("n_rows") if "n_rows" in v.columns else F.count(F.lit(1))
    if match == "id":
        per = v.groupBy("visitor", "contactor").agg(n.alias("visits"))
        ids = key.where(F.col("do_id").isNotNull()).select("do_id").distinct()
        return (per.join(ids, F.col("contactor") == F.col("do_id"), "inner")
                .select("visitor", "visits", "do_id"))
    if match == "resolved":
        if count == "activities":
            raise ValueError("distinct activities cannot be added up over ids: use match='id'")
        return _resolved(v, "visitor", "contactor", key, {"visits": n}).select("visitor", "visits", "do_id")
    return (_by_name(v.groupBy("visitor").agg(n.alias("visits")), "visitor", key)
            .select("visitor", "visits", "do_id"))


def asks_rollup(activity_list: DataFrame, key: DataFrame, params: Params,
                fy: int | None = None, match: str = "name") -> DataFrame:
    """Qualified asks per solicitor in one FY, with the officer id
    (``match="resolved"``: by the lead's id where officers share a name)."""
    fy = params.current_fy if fy is None else fy
    rows = activity_list.where((F.col("source") == P.SOURCE_ASKS) & in_fy("ask_date", fy, params)
                               & F.col("solicitor").isNotNull())
    if match == "resolved":
        asked = _resolved(rows, "solicitor", "lead_solicitor_ID", key, {"asks": F.count(F.lit(1))})
        return asked.select("do_id", "solicitor", "asks")
    a = rows.groupBy("solicitor").agg(F.count(F.lit(1)).alias("asks"))
    return _by_name(a, "solicitor", key).select("do_id", "solicitor", "asks")


def dollars_rollup(activity_list: DataFrame, key: DataFrame, goal_rows: DataFrame,
                   params: Params, fy: int | None = None, test_on: str = "lead",
                   match: str = "name") -> DataFrame:
    """Lead and co-solicitor dollars accepted in one FY per officer,
    the dollars that count toward the goal, and the goal level reached.

    The dollars rows are reduced to one row per solicitor (lead, co and
    total sums, partial-aggregated per task) before they meet the officer
    and goal rows; the sums are regrouped per officer x goal row after the
    join.  Sums distribute over the join, so this equals summing the joined
    rows (a solicitor matching two officer rows counts for each, as in the
    row-wise form), while only solicitor-sized data reaches the join.
    ``match="resolved"`` goes by the credited officer's id where officers share
    a name, so that each gift counts for one of them."""
    fy = params.current_fy if fy is None else fy
    g = goals_for_fy(goal_rows, fy).select(
        F.col("do_id").alias("__gdo"), "dollar_goal_lvl3", "dollar_goal_lvl4",
        "dollar_goal_lvl5", "dollar_goal_single")
    rows = activity_list.where((F.col("source") == P.SOURCE_DOLLARS) & in_fy("gift_date", fy, params)
                               & F.col("StageName").isin(list(params.accepted_stages)))
    # aggregate first: one row per solicitor leaves the activity list
    if match == "resolved":
        amount, role = F.col("gift_amt").cast(MONEY), F.col("solicitor_level")
        sums = {name: F.sum(F.when(role == of, amount).otherwise(F.lit(0).cast(MONEY)))
                for name, of in (("lead_dollars", params.lead_role), ("co_dollars", params.co_role))}
        named = _resolved(rows, "solicitor", "do_id", key, sums | {"total_dollars": F.sum(amount)},
                          ("do_id", "do_team", "do_level"))
    else:
        per_solicitor = role_dollars(rows, ["solicitor"], "solicitor_level", "gift_amt", params.lead_role,
                                     params.co_role, "lead_dollars", "co_dollars", positive_only=False,
                                     total_name="total_dollars")
        nk = (key.where(F.col("do_id").isNotNull())
              .select("do_id", F.col("first_last").alias("solicitor"), "do_team", "do_level"))
        # officer rows matched by name
        named = per_solicitor.join(nk, "solicitor", "inner")
    # goals hang on the officer id
    j = named.join(g, F.col("do_id") == F.col("__gdo"), "left")
    keys = ["solicitor", "dollar_goal_lvl3", "dollar_goal_lvl4", "dollar_goal_lvl5",
            "dollar_goal_single", "do_team", "do_level", "do_id"]
    d = regroup_dollars(j, keys, "lead_dollars", "co_dollars", "total_dollars")
    flag = team_flag("do_team", params.count_all_teams, params.collation)
    d = d.withColumn("count_all_flag", flag)
    # one row per distinct (officer, sums, flag, goals): the team and level
    # only served the flag
    r = d.select("do_id", "solicitor", "lead_dollars", "co_dollars", "count_all_flag",
                 "dollar_goal_single", "dollar_goal_lvl3", "dollar_goal_lvl4",
                 "dollar_goal_lvl5").distinct()
    credited = credited_dollars("lead_dollars", "co_dollars", "count_all_flag",
                                "dollar_goal_lvl4", test_on=test_on).cast(MONEY)
    r = r.withColumn("goal_dollars", credited)
    level = goal_level("goal_dollars", "dollar_goal_single", "dollar_goal_lvl3",
                       "dollar_goal_lvl4", "dollar_goal_lvl5")
    return r.select("do_id", "solicitor", "lead_dollars", "co_dollars", "goal_dollars",
                    "count_all_flag", level.alias("goal_achieved"))


def effective_goals(goal_rows: DataFrame, params: Params, fy: int | None = None) -> DataFrame:
    """P6d: goals of one FY with the effective visit / ask / dollar goal
    (single goal when present, else level 3)."""
    fy = params.current_fy if fy is None else fy
    g = goals_for_fy(goal_rows, fy)
    return g.select("do_id", "goal_date", *GOAL_COLUMNS,
                    effective_goal("visit_goal_single", "visit_goal_lvl3").alias("visit_goal"),
                    effective_goal("ask_goal_single", "ask_goal_lvl3").alias("ask_goal"),
                    effective_goal("dollar_goal_single", "dollar_goal_lvl3").alias("dollar_goal"))


def scorecard(activity_list: DataFrame, key: DataFrame, goal_rows: DataFrame, params: Params,
              fy: int | None = None, drive: str = "visits",
              visit_rows: DataFrame | None = None, match: str = "name") -> DataFrame:
    """One row per officer with visits, asks, credited dollars and
    goals for one FY.

    ``drive="visits"`` keeps the dashboard's behaviour: the visit roll-up
    drives the left-join chain, so an officer with gifts but no visit is
    absent.  ``drive="all"`` starts from every officer with any of the
    three (full outer joins: each roll-up is derived once).  ``visit_rows``
    may bring counted visits in place of the list's visit rows.
    ``match="resolved"`` tells officers who share a display name apart by
    their ids; the default gives each of them everything under the name, as
    the dashboard does.  Every input is officer-sized after its roll-up, so the chain
    joins small frames; the final de-duplication groups on all columns and
    tests ``sum(lead + co)`` over the group against the level-4 goal."""
    fy = params.current_fy if fy is None else fy
    rows = activity_list if visit_rows is None else visit_rows
    vis = visits_rollup(rows, key, params, fy, match).select("do_id", "visits")
    ask = asks_rollup(activity_list, key, params, fy, match).select(F.col("do_id").alias("__a"), "asks")
    dol = dollars_rollup(activity_list, key, goal_rows, params, fy, match=match).select(
        F.col("do_id").alias("__d"), "goal_dollars", "lead_dollars", "co_dollars")
    gol = effective_goals(goal_rows, params, fy).select(
        F.col("do_id").alias("__g"), "goal_date", *GOAL_COLUMNS)
    k = key.select(F.col("do_id").alias("__k"), "last_first_comma", "last_first", "do_team",
                   "do_level", "count_all_flag")
    how = "full_outer" if drive == "all" else "left"
    both = vis.join(ask, F.col("do_id") == F.col("__a"), how)
    both = both.withColumn("do_id", F.coalesce("do_id", "__a"))
    j = both.join(dol, F.col("do_id") == F.col("__d"), how)
    j = j.withColumn("do_id", F.coalesce("do_id", "__d"))
    j = (j.where(F.col("do_id").isNotNull())
         .join(gol, F.col("do_id") == F.col("__g"), "left")
         .join(k, F.col("do_id") == F.col("__k"), "left"))
    keys = ["do_id", "last_first_comma", "last_first", "do_team", "do_level", "goal_date",
            "visits", "asks", "goal_dollars", *GOAL_COLUMNS, "lead_dollars", "co_dollars",
            "count_all_flag"]
    g = j.groupBy(*keys).agg(F.sum(F.col("lead_dollars") + F.col("co_dollars")).alias("__sum_both"))
    lead, co = F.col("lead_dollars"), F.col("co_dollars")
    lvl4 = F.col("dollar_goal_lvl4")
    combined = (F.when(F.col("count_all_flag") == "Y", lead + co)
                .when(F.col("__sum_both") >= lvl4, lead + co)
                .when(F.col("__sum_both") < lvl4, lead)
                .when(lvl4.isNull(), lead))
    return g.select("do_id", "last_first_comma", "last_first", "do_team", "do_level", "goal_date",
                    F.col("visits"), F.col("asks"), "goal_dollars", *GOAL_COLUMNS,
                    "lead_dollars", "co_dollars", combined.cast(MONEY).alias("credited_dollars"))
