"""Officer, account and goal dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import first_last, last_first, last_first_comma, team_flag
from ..functions.tiers import combine_tiers, numeric_tier, segment_code
from ..operators.ranking import first_two, household_label
from ..params import Params
from ..sources.goals import typed_import
from ..sources.standins import Crm
from ..sources.tables import literal_rows

NAME_KEY_COLUMNS = ["do_id", "first_last", "last_first", "do_team", "do_level",
                    "last_first_comma", "count_all_flag"]


def name_key(crm: Crm, params: Params) -> DataFrame:
    """Officer dimension: id, three name forms, team, level and the
    count-all flag, plus the manual rows of ``params.override_officers``.

    Officers are few per organisation but the user table is not bounded, so
    its joins are left to the planner and AQE."""
    off, us = crm.officer, crm.user
    team = crm.team.select(F.col("id").alias("team_id"), F.col("name").alias("do_team"))
    users = us.select(F.col("id").alias("user_id"), "first_name", "last_name")
    main = (off.join(users, "user_id", "left")
            .join(team, "team_id", "left")
            .select(F.col("user_id").alias("do_id"),
                    first_last("first_name", "last_name").alias("first_last"),
                    last_first("first_name", "last_name").alias("last_first"),
                    F.col("do_team"),
                    F.col("level").alias("do_level"),
                    last_first_comma("first_name", "last_name").alias("last_first_comma"),
                    team_flag("do_team", params.count_all_teams, params.collation).alias("count_all_flag")))
    if not params.override_officers:
        return main
    id_type = main.schema["do_id"].dataType
    schema = T.StructType([T.StructField("do_id", id_type)] +
                          [T.StructField(c, T.StringType()) for c in NAME_KEY_COLUMNS[1:]])
    extra = literal_rows(main.sparkSession, list(params.override_officers), schema)
    return main.unionByName(extra.select(*[F.col(f.name).cast(f.dataType) for f in main.schema.fields]))


def capacity_tiers(crm: Crm, params: Params, prefer: str = "lowest") -> DataFrame:
    """Capacity tier label per active account and which source it came from.

    Ratings are reduced to one row per account *before* meeting the
    accounts (max code over ratings of a counted record type, plus whether
    the account had any rating at all).  The join is then 1:1 on the
    account key and no account row is multiplied by its ratings.  An
    account whose ratings are all of other types drops out; an account with
    no rating keeps code 0 from the rating side.

    Of several counted ratings ``prefer="lowest"`` takes the lowest tier (the
    largest code), ``"best"`` the best tier that any of them names.
    """
    if prefer not in ("lowest", "best"):
        raise ValueError("prefer must be 'lowest' or 'best'")
    rt = crm.record_type.select(F.col("id").alias("record_type_id"), F.col("name").alias("rt_name"))
    counted = F.col("rt_name").isin(list(params.rating_record_types)) | F.col("rt_name").isNull()
    code = segment_code("segment", params.segment_codes)
    per_account = (crm.rating.join(rt, "record_type_id", "left")
                   .groupBy("account_id")
                   .agg((F.max(F.when(counted, code)) if prefer == "lowest"
                         else F.min(F.when(counted & (code > 0), code))).alias("vendor_code"),
                        F.max(counted).alias("any_counted")))
    acc = (crm.account.where(F.col("status") == params.active_status)
           .select(F.col("id").alias("account_id"),
                   numeric_tier("capacity", params.capacity_cutoffs).alias("research_code")))
    joined = (acc.join(per_account, "account_id", "left")
              .where(F.col("any_counted").isNull() | F.col("any_counted"))
              .select("account_id", "research_code",
                      F.coalesce(F.col("vendor_code"), F.lit(0)).alias("vendor_code")))
    label, source = combine_tiers("research_code", "vendor_code")
    return joined.select(F.col("account_id").alias("Account_ID"),
                         label.alias("comb_capacity_range"),
                         source.alias("comb_capacity_source"))


def household(crm: Crm) -> DataFrame:
    """Household label per account from its first two contacts (primary
    first, then by contact id).  Accounts whose first contact has no label
    are left out, as in the dashboard."""
    ranked = first_two(crm.contact, "account_id",
                       [F.col("is_primary").desc_nulls_last(), F.col("id").asc()],
                       "label", "first_label", "second_label")
    acc = crm.account.select(F.col("id").alias("account_id"))
    return (ranked.where(F.col("first_label").isNotNull())
            .join(acc, "account_id", "left_semi")
            .select(F.col("account_id").alias("AccountID"),
                    household_label("first_label", "second_label").alias("comb_gusy")))


def goals(crm: Crm, key: DataFrame) -> DataFrame:
    """Typed goals with the officer id, matched on 'Last, First'.  Unmatched
    goal rows are kept with a NULL id (they are what the check reports)."""
    typed = typed_import(crm.goals_import)
    nk = key.select(F.col("do_id"), F.col("first_last"),
                    F.col("last_first_comma").alias("__lfc"))
    out = typed.join(nk, typed.last_first == nk.__lfc, "left")
    goal_cols = [c for c in typed.columns]
    return out.select("do_id", "first_last", *goal_cols, F.col("__lfc").alias("last_first_comma"))


def goals_for_fy(goal_rows: DataFrame, fy: int) -> DataFrame:
    """One goal year: the join key for every reader of the goals."""
    return goal_rows.where(F.col("goal_fy") == fy)
