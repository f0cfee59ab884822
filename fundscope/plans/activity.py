"""The activity list: visits, qualified asks and dollars (P1, P5, P5a-e)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.fiscal import fiscal_year, fy_amount_columns, fy_column_name, in_report_range
from ..functions.names import kept_owner, sort_name
from ..functions.rules import threshold_ladder, visit_candidate, visit_qualifies
from ..operators.relational import align_union, bridge_left_join, unpivot_non_null
from ..params import Params
from ..sources.crm_store import hot_keys
from ..sources.standins import Crm

MONEY = T.DecimalType(18, 2)


def activity_list_schema(params: Params, id_type: T.DataType = T.LongType()) -> T.StructType:
    """The 31 aligned columns of the wide activity list."""
    s = T.StringType(params.collation) if params.collation else T.StringType()
    fields = [
        ("AccountID", id_type), ("hh_name", s), ("market", s), ("do_id", id_type),
        ("comb_fy", T.IntegerType()), ("visit_date", T.DateType()), ("visit_summ", s),
        ("visitor", s), ("ask_amt", MONEY), ("ask_date", T.DateType()), ("gift_amt", MONEY),
        ("gift_date", T.DateType()), ("solicitor", s), ("solicitor_level", s), ("gift_name", s),
        ("gift_unit", s), ("source", s), ("ActivityStatus", s), ("StageName", s),
        ("lead_solicitor_ID", id_type), ("first_last", s), ("last_first", s),
        ("last_first_comma", s), ("contactor", id_type), ("contactor_name", s),
        ("Subject__c", s), ("gift_amt_comb_lead_sec", MONEY),
    ]
    fields += [(fy_column_name(fy), MONEY) for fy in params.report_fys]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def _owner_filtered(crm: Crm, params: Params, visit_types_only: bool) -> DataFrame:
    """Activities with the owner's name, owners without a name or excluded
    dropped (the filter turns the owner join into an inner join)."""
    owner = crm.user.select(F.col("id").alias("owner_id"), F.col("name").alias("owner_name"),
                            F.col("first_name").alias("owner_first"),
                            F.col("last_name").alias("owner_last"))
    act = crm.activity
    if visit_types_only:
        act = act.where(F.col("type").isin(list(params.visit_types)))
    return act.join(owner, "owner_id", "inner").where(kept_owner("owner_name", params.excluded_owners, params.collation))


def contacts_visits(crm: Crm, params: Params) -> DataFrame:
    """One row per visit x related contact x contactor."""
    act = _owner_filtered(crm, params, visit_types_only=True)
    links = crm.activity_contact.select(F.col("activity_id").alias("activity_id_rc"),
                                        F.col("contact_id").alias("contact_id_rc"))
    joined = bridge_left_join(act, links, "id", "activity_id_rc", known_hot=hot_keys(crm, "activity_contact"))
    base = joined.select(
        F.col("owner_id").alias("do_id"),
        F.col("activity_date").alias("actcompdat"),
        F.col("type").alias("actcontvalue"),
        F.col("type").alias("actactivity"),
        F.col("substantive").alias("Substantive_Activity"),
        F.col("status").alias("actcategory"),
        F.col("description").alias("actcomm"),
        F.col("owner_name").alias("taskcontactor"),
        sort_name("owner_first", "owner_last").alias("taskcontactorsort"),
        F.col("account_id").alias("Account_ID"),
        F.col("id").alias("activity_id"),
        "activity_id_rc", "contact_id_rc", "contactor_1", "contactor_2", "contactor_3")
    ids = [c for c in base.columns if not c.startswith("contactor_")]
    return unpivot_non_null(base, ids, ["contactor_1", "contactor_2", "contactor_3"],
                            "contactor_number", "contactor")


def visit_contacts(crm: Crm, params: Params) -> DataFrame:
    """Check QA17: visits unpivoted by contactor with their related contacts
    (no owner filter)."""
    act = crm.activity.where(F.col("type").isin(list(params.visit_types)))
    links = crm.activity_contact.select(F.col("activity_id").alias("activity_id_rc"),
                                        F.col("contact_id").alias("contact_id_rc"))
    base = (bridge_left_join(act, links, "id", "activity_id_rc", known_hot=hot_keys(crm, "activity_contact"))
            .select(F.col("type").alias("ActivityType"),
                    F.col("description").alias("Activity_Description"),
                    F.col("activity_date").alias("ActivityDate"),
                    F.col("account_id").alias("AccountID"),
                    F.col("status").alias("ActivityStatus"),
                    F.col("substantive").alias("Substantive_Activity"),
                    "activity_id_rc", "contact_id_rc", "contactor_1", "contactor_2", "contactor_3"))
    ids = [c for c in base.columns if not c.startswith("contactor_")]
    return unpivot_non_null(base, ids, ["contactor_1", "contactor_2", "contactor_3"],
                            "contactor_number", "contactor")


def _by_contactor(act: DataFrame, crm: Crm) -> DataFrame:
    """One row per activity and contactor, with the contactor's name."""
    keep = [c for c in act.columns if c not in ("contactor_1", "contactor_2", "contactor_3")]
    rows = unpivot_non_null(act, keep, ["contactor_1", "contactor_2", "contactor_3"],
                            "contactor_number", "contactor")
    names = crm.user.select(F.col("id").alias("__cid"), F.col("name").alias("contactor_name"))
    return rows.join(names, F.col("contactor") == F.col("__cid"), "left").drop("__cid")


def _activity_columns(act: DataFrame, *more: str) -> DataFrame:
    return act.select(F.col("id").alias("__id"),
                      F.col("owner_id").alias("OwnerID"),
                      F.col("owner_name").alias("OwnerName"),
                      F.col("type").alias("ActivityType"),
                      F.col("description").alias("Activity_Description"),
                      F.col("activity_date").alias("ActivityDate"),
                      F.col("account_id").alias("AccountID"),
                      F.col("status").alias("ActivityStatus"),
                      F.col("substantive").alias("Substantive_Activity"),
                      F.col("subject").alias("Subject__c"),
                      F.col("who_id").alias("WhoId__c"),
                      "contactor_1", "contactor_2", "contactor_3", *more)


def activities(crm: Crm, params: Params) -> DataFrame:
    """Activities x contactors x contact links, with the contactor's
    name.  Each activity repeats once per contactor and once per contact
    link (the WhoId and each related contact): this growth is what the
    visit counts count.  An activity with no link at all drops out.

    Owner and contactor names are joined before the links multiply the
    rows; nothing is joined after them."""
    act = _by_contactor(_activity_columns(_owner_filtered(crm, params, visit_types_only=False)), crm)
    links = crm.activity_contact.select(F.col("activity_id").alias("activity_id_rc"),
                                        F.col("contact_id").alias("contact_rc"))
    linked = bridge_left_join(act, links, "__id", "activity_id_rc", known_hot=hot_keys(crm, "activity_contact")).drop("__id")
    keep = [c for c in linked.columns if c not in ("WhoId__c", "contact_rc")]
    return unpivot_non_null(linked, keep, ["WhoId__c", "contact_rc"], "related_contact", "contact")


def link_counts(crm: Crm) -> DataFrame:
    """Per activity: its contact links, and those that name a contact."""
    return (crm.activity_contact.where(F.col("activity_id").isNotNull())
            .groupBy(F.col("activity_id").alias("__linked"))
            .agg(F.count(F.lit(1)).alias("__links"), F.count("contact_id").alias("__named")))


def opportunities(crm: Crm, params: Params) -> DataFrame:
    """Opportunities x team members, with the per-FY lead amounts."""
    opp = crm.opportunity
    team = crm.opportunity_team.select(F.col("opportunity_id"), F.col("user_id").alias("optm_userID"),
                                       F.col("name").alias("optm_name"),
                                       F.col("role").alias("solicitor_level"))
    j = bridge_left_join(opp, team, "id", "opportunity_id", known_hot=hot_keys(crm, "opportunity_team"))
    return j.select(
        F.col("owner_id").alias("OwnerID"),
        "ask_date",
        F.col("ask_amount").alias("ask_amt"),
        F.col("amount").alias("gift_amt"),
        F.col("close_date").alias("gift_date"),
        "optm_name", "solicitor_level",
        F.col("name").alias("gift_name"),
        F.col("division").alias("gift_unit"),
        F.col("stage").alias("StageName"),
        F.col("id").alias("OpportunityID"),
        F.col("account_id").alias("AccountID"),
        F.col("comment").alias("Comment"),
        F.col("lead_solicitor_id").alias("lead_solicitor_ID"),
        "optm_userID",
        *fy_amount_columns("amount", "close_date", "stage", "solicitor_level", params))


def _accounts(crm: Crm) -> DataFrame:
    return crm.account.select(F.col("id").alias("__acc"), F.col("name").alias("hh_name"),
                              F.col("district").alias("market"))


def _officers(key: DataFrame) -> DataFrame:
    return key.select(F.col("do_id").alias("__do"), "do_id", "first_last", "last_first",
                      "last_first_comma", "do_team", "do_level", "count_all_flag")


def counted_visits(crm: Crm, key: DataFrame, params: Params) -> DataFrame:
    """Visits as one row per activity and contactor, with ``n_rows``: how
    often the row stands on the list (once for the WhoId per link, or once
    without links, and once per related contact).  Links are counted per
    activity and never multiply rows."""
    early = crm.activity.where(in_report_range("activity_date", params)
                               & visit_candidate("type", "subject", "substantive", params))
    act = (_owner_filtered(replace(crm, activity=early), params, visit_types_only=False)
           .join(_accounts(crm), F.col("account_id") == F.col("__acc"), "left")
           .join(_officers(key), F.col("owner_id") == F.col("__do"), "left")
           .join(link_counts(crm), F.col("id") == F.col("__linked"), "left"))
    who = F.when(F.col("who_id").isNull(), 0).otherwise(F.greatest(F.coalesce("__links", F.lit(0)), F.lit(1)))
    act = act.withColumn("n_rows", who + F.coalesce("__named", F.lit(0))).where("n_rows > 0")
    rows = _by_contactor(_activity_columns(
        act, "hh_name", "market", "do_id", "first_last", "last_first", "last_first_comma",
        "do_team", "n_rows"), crm)
    q = visit_qualifies("ActivityType", "do_team", "contactor_name", "Subject__c",
                        "Substantive_Activity", params)
    return rows.where(q).select(
        "AccountID", "hh_name", "market", "do_id",
        fiscal_year("ActivityDate", params.fy_start_month).alias("comb_fy"),
        F.col("ActivityDate").alias("visit_date"),
        F.col("Activity_Description").alias("visit_summ"),
        F.col("contactor_name").alias("visitor"),
        F.lit(P.SOURCE_VISITS).alias("source"),
        "ActivityStatus", "first_last", "last_first", "last_first_comma",
        "contactor", "contactor_name", "Subject__c", "n_rows",
        F.col("__id").alias("activity_id"))


def visits(crm: Crm, key: DataFrame, params: Params) -> DataFrame:
    """Activity rows that qualify as visits in the reporting range: the
    counted visits, each repeated by its count after every join."""
    v = counted_visits(crm, key, params)
    rows = v.withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    return rows.drop("__nth", "n_rows", "activity_id")


def asks(crm: Crm, key: DataFrame, params: Params) -> DataFrame:
    """P5d: lead-solicitor asks in the reporting range that pass the
    level / team amount ladder of the opportunity's lead."""
    o = (opportunities(crm, params)
         .where(in_report_range("ask_date", params)
                & (F.col("solicitor_level") == params.lead_role)))
    j = (o.join(_accounts(crm), o.AccountID == F.col("__acc"), "left")
         .join(_officers(key), o.lead_solicitor_ID == F.col("__do"), "left"))
    ladder = threshold_ladder("first_last", "do_level", "do_team", "ask_amt", params)
    return j.where(ladder == "Y").select(
        "AccountID", "hh_name", "market", "do_id",
        fiscal_year("ask_date", params.fy_start_month).alias("comb_fy"),
        "ask_amt", "ask_date", "gift_amt", "gift_date",
        F.col("first_last").alias("solicitor"),
        "solicitor_level", "gift_name", "gift_unit",
        F.lit(P.SOURCE_ASKS).alias("source"),
        "StageName", "lead_solicitor_ID", "first_last", "last_first", "last_first_comma")


def dollar_candidates(crm: Crm, params: Params) -> DataFrame:
    """Lead and secondary opportunity rows asked or closed in the reporting
    range: the input of the dollars branch before de-duplication."""
    o = opportunities(crm, params)
    in_range = in_report_range("ask_date", params) | in_report_range("gift_date", params)
    return o.where(F.col("solicitor_level").isin(params.lead_role, params.co_role) & in_range)


def dollars(crm: Crm, key: DataFrame, params: Params) -> DataFrame:
    """P5e: lead and secondary rows asked or closed in the reporting range,
    credited to the team member, de-duplicated on every output column (two
    equal gifts with the same name, date and account count once).

    Most output columns follow from others: the household from the account,
    the names and the flag from the officer, the amounts per FY from the gift.
    So the rows are de-duplicated on the eleven columns that nothing else
    determines, and the distinct account and officer rows are joined to what is
    left.  A team member who is no officer has no ``do_id``, as before, so
    several such members of a gift stay one row."""
    o = dollar_candidates(crm, params)
    ids = key.select(F.col("do_id").alias("__do")).where("__do IS NOT NULL").distinct()
    base = (o.join(ids, o.optm_userID == F.col("__do"), "left").withColumnRenamed("__do", "do_id")
            .select("AccountID", "do_id", "ask_amt", "ask_date", "gift_amt", "gift_date", "solicitor_level",
                    "gift_name", "gift_unit", "StageName", "lead_solicitor_ID").distinct())
    names = (_officers(key).where("__do IS NOT NULL")
             .select("__do", "first_last", "last_first", "last_first_comma", "count_all_flag").distinct())
    d = (base.join(_accounts(crm).distinct(), F.col("AccountID") == F.col("__acc"), "left")
         .join(names, F.col("do_id") == F.col("__do"), "left"))
    return d.select(
        "AccountID", "hh_name", "market", "do_id",
        fiscal_year("gift_date", params.fy_start_month).alias("comb_fy"),
        "ask_amt", "ask_date", "gift_amt", "gift_date",
        F.col("first_last").alias("solicitor"),
        "solicitor_level", "gift_name", "gift_unit",
        F.lit(P.SOURCE_DOLLARS).alias("source"),
        "StageName", "lead_solicitor_ID", "first_last", "last_first", "last_first_comma",
        *fy_amount_columns("gift_amt", "gift_date", "StageName", "solicitor_level", params))


def activity_list(crm: Crm, key: DataFrame, params: Params) -> DataFrame:
    """P5: visits, qualified asks and dollars on one 31-column schema with a
    ``source`` tag.  A filter on ``source`` removes the other branches at
    plan time (the tag is a literal), so readers of one branch pay for one."""
    id_type = crm.activity.schema["owner_id"].dataType
    schema = activity_list_schema(params, id_type)
    return align_union([visits(crm, key, params), asks(crm, key, params),
                        dollars(crm, key, params)], schema)


#: The order of the stored list within a fiscal year: an account's rows stand
#: together, and the dates spread a hot account over files.
CLUSTER = ("AccountID", "gift_date", "visit_date", "ask_date", "visitor", "solicitor")


def write_activity_list(activity_list_df: DataFrame, path: str) -> None:
    """Store the activity list once, partitioned by fiscal year and ordered by
    account within it.  Readers of one FY (every scorecard roll-up) read that
    partition only (``PartitionFilters`` on ``comb_fy``) instead of re-deriving
    the list; readers of some accounts (:func:`fundscope.plans.checks.account_rows_list`)
    skip the row groups whose range or Bloom filter rules the accounts out.
    Rows whose FY is unknown land in the NULL partition."""
    from ..sources.versions import bloom
    rows = activity_list_df.repartitionByRange("comb_fy", *CLUSTER).sortWithinPartitions("comb_fy", *CLUSTER)
    rows.write.mode("overwrite").partitionBy("comb_fy").options(**bloom(CLUSTER[:1])).parquet(path)


def read_activity_list(spark, path: str, params: Params, fy: int | None = None) -> DataFrame:
    """The stored activity list, optionally cut to one fiscal year by
    partition pruning (the FY filters of the roll-ups stay as they are)."""
    return stored_list(spark.read.parquet(path), params, fy)


def stored_list(df: DataFrame, params: Params, fy: int | None = None) -> DataFrame:
    """A stored activity list in its schema's order, optionally cut to one fiscal year."""
    if fy is not None:
        df = df.where(F.col("comb_fy") == fy)
    id_type = df.schema["AccountID"].dataType
    return df.select(*[F.col(f.name).cast(f.dataType) for f in activity_list_schema(params, id_type).fields])
