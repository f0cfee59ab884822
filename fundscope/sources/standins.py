"""CRM-shaped stand-ins built from the TPC-H-like test tables.

The dashboards read a CRM copy (activities, users, opportunities, team
members, accounts, ratings, contacts, tasks, a goals spreadsheet).  The
test data is a star schema of orders and line items, so each CRM table is
derived from it here with plain DataFrame expressions:

===================  =========================================================
CRM table            derived from
===================  =========================================================
account              customer + nation + region
user                 supplier (first name / last name split at ``#``)
officer, team        supplier (balance >= 0) + nation, region (one team per region)
opportunity          orders + the line-1 supplier as lead
opportunity_team     distinct (order, supplier, role by line number)
activity             events (+ the order sharing the id, for the account)
activity_contact     distinct (order, part) of lineitem
contact              orders (one contact per order)
rating               orders (priority -> segment)
record_type          a five-row lookup
task                 activity rows seen as tasks
account_totals       sums and counts over an account's orders
goals_import         supplier, every column as text, two goal years
===================  =========================================================

Everything is lazy: nothing is read until an action runs, and Catalyst
prunes the stand-in columns a query does not use down to the Parquet scan.
The SQL twins of these definitions live in :mod:`fundscope.plans.oracle`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import Params
from .tables import read_table

MONEY = T.DecimalType(18, 2)

# stand-in code tables (fixed small lookups of the test world)
STAGE_BY_STATUS = {"F": "Accepted", "O": "Accepted - Stewardship", "P": "Cultivation"}
TEAM_BY_REGION = {
    "AFRICA": "GULC",
    "AMERICA": "Regional Major Gifts",
    "ASIA": "Lombardi",
    "EUROPE": "Principal Gifts",
    "MIDDLE EAST": "Planned Giving",
}
LEVELS = ("DA", "Leadership", "AVP", "SDOD", "DOD", "ADOD")
ACTIVITY_TYPE_BY_EVENT = {
    "view": "Visit",
    "click": "Visit Assist",
    "purchase": "Prospect Activity",
    "signup": "Call",
}
SEGMENT_BY_PRIORITY = {
    "1-URGENT": "$10 million or more",
    "2-HIGH": "$1,000,000 to $4,999,999",
    "3-MEDIUM": "$250,000 to $499,999",
    "4-NOT SPECIFIED": "Not Specified",
    "5-LOW": "$500 - $999",
}
RECORD_TYPES = (("F", "GGA"), ("O", "Gu Capacity"), ("P", "Wealth Screen"),
                ("T", "Task"), ("V", "Visit Report"))
ACTIVITY_MONTH_SHIFT = -312  # events are from 2024; move them 26 years back
GOAL_FYS = (1998, 1997)


@dataclass
class Crm:
    """The CRM tables one pipeline run reads."""

    account: DataFrame
    user: DataFrame
    officer: DataFrame
    team: DataFrame
    opportunity: DataFrame
    opportunity_team: DataFrame
    activity: DataFrame
    activity_contact: DataFrame
    contact: DataFrame
    rating: DataFrame
    record_type: DataFrame
    task: DataFrame
    goals_import: DataFrame
    account_totals: DataFrame


def collated(crm: Crm, collation: str | None) -> Crm:
    """Every text column of every table under one collation (``None``: as
    they are).  Comparisons, joins and groupings on these columns, and on
    names built from them, then all follow it; literals take the column's."""
    if not collation:
        return crm

    def cast(df: DataFrame) -> DataFrame:
        return df.select(*[F.collate(F.col(f.name), collation).alias(f.name)
                           if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])

    return Crm(**{n: cast(getattr(crm, n)) for n in Crm.__dataclass_fields__})


def _sql_case(col: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {repr(default) if default is not None else 'NULL'} END"


def load(spark: SparkSession, sf_dir: str, params: Params | None = None) -> Crm:
    """Build the stand-in CRM tables (lazy).  Projections are written as SQL
    expressions: one driver call per projection instead of one per column
    function, which keeps plan building cheap."""
    params = params or Params(current_fy=1998)
    t = {n: read_table(spark, sf_dir, n)
         for n in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")}
    nation, region = t["nation"], t["region"]
    fy_shift = 13 - params.fy_start_month

    # nation (25 rows) and region (5 rows) are fixed-size code lists
    geo = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", "n_name", "n_regionkey", "r_name"))

    c = t["customer"]
    account = (c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left")
               .selectExpr("c_custkey AS id", "c_name AS name", "n_name AS district",
                           "r_name AS region",
                           "CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status",
                           "c_mktsegment AS account_type",
                           "CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 1100 AS DECIMAL(18,2)) AS capacity",
                           "concat('A-', c_custkey) AS external_id", "concat('City ', c_nationkey) AS billing_city",
                           "n_name AS billing_country", "r_name AS billing_state",
                           "CAST(10000 + c_custkey AS STRING) AS billing_postal_code"))

    s = t["supplier"]
    user = s.selectExpr(
        "s_suppkey AS id",
        "CASE WHEN s_suppkey % 20 = 19 THEN CAST(NULL AS STRING) "
        "ELSE concat(split_part(s_name, '#', 1), ' ', split_part(s_name, '#', 2)) END AS name",
        "split_part(s_name, '#', 1) AS first_name",
        "split_part(s_name, '#', 2) AS last_name")

    levels = ", ".join(f"'{x}'" for x in LEVELS)
    # staff with a negative balance stand for users who are not officers
    officer = (s.where("s_acctbal >= 0")
               .join(F.broadcast(nation), s.s_nationkey == nation.n_nationkey, "left")
               .selectExpr("s_suppkey AS user_id", "n_regionkey AS team_id",
                           f"element_at(array({levels}), CAST(s_suppkey % {len(LEVELS)} + 1 AS INT)) AS level"))
    team = region.selectExpr("r_regionkey AS id", f"{_sql_case('r_name', TEAM_BY_REGION)} AS name")

    li = t["lineitem"]
    members = li.selectExpr(
        "l_orderkey AS opportunity_id", "l_suppkey AS user_id",
        f"CASE WHEN l_linenumber = 1 THEN '{params.lead_role}' "
        f"WHEN l_linenumber = 2 THEN '{params.co_role}' ELSE 'Team Member' END AS role").distinct()
    # one row per order: the lead (smallest line-1 supplier) and the owner
    # (smallest supplier), from the de-duplicated member rows, so lineitem
    # is scanned once for both
    heads = members.groupBy("opportunity_id").agg(
        F.expr(f"min(CASE WHEN role = '{params.lead_role}' THEN user_id END)").alias("lead"),
        F.min("user_id").alias("owner"))
    opportunity_team = (members.join(user.selectExpr("id AS user_id", "name"), "user_id", "left")
                        .select("opportunity_id", "user_id", "name", "role"))

    o = t["orders"]
    close = "to_date(o_orderdate)"
    opportunity = (o.join(heads, o.o_orderkey == heads.opportunity_id, "left")
                   .selectExpr(
                       "o_orderkey AS id", "owner AS owner_id", "o_custkey AS account_id",
                       "lead AS lead_solicitor_id",
                       f"date_sub({close}, 60) AS ask_date",
                       "CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS DECIMAL(18,2)) "
                       "ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS DECIMAL(18,2)) END AS ask_amount",
                       # a few gifts below 1, which the low-amount check is for
                       "CASE WHEN o_totalprice < 3000 THEN CAST(0.5 AS DECIMAL(18,2)) "
                       "ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount",
                       f"{close} AS close_date",
                       "o_orderpriority AS name", "o_orderstatus AS division",
                       f"{_sql_case('o_orderstatus', STAGE_BY_STATUS)} AS stage",
                       "concat('order ', CAST(o_orderkey AS STRING)) AS comment",
                       f"year(add_months({close}, {fy_shift})) AS fiscal_year",
                       f"quarter(add_months({close}, {fy_shift})) AS fiscal_quarter",
                       "concat('Fund ', o_orderstatus) AS campaign_fund"))
    accepted_order = "CASE WHEN division = 'F' THEN"
    account_totals = opportunity.groupBy("account_id").agg(
        F.coalesce(F.expr(f"sum({accepted_order} amount END)"), F.lit(0)).cast(MONEY).alias("total_gifts"),
        F.expr(f"count({accepted_order} 1 END)").alias("total_gifts_count"),
        F.count(F.lit(1)).alias("number_of_contacts"), F.max("lead_solicitor_id").alias("relationship_manager"))

    activity = activity_from_events(t["events"], o)

    activity_contact = li.selectExpr("l_orderkey AS activity_id", "l_partkey AS contact_id").distinct()

    contact = o.selectExpr(
        "o_orderkey AS id", "o_custkey AS account_id",
        "concat('Contact ', CAST(o_orderkey AS STRING)) AS name",
        "CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE concat(o_orderpriority, '  ') END AS label",
        "CASE WHEN startswith(o_orderpriority, '1') THEN 'Yes' ELSE 'No' END AS is_primary",
        "o_orderstatus AS contact_type",
        "1998 - year(date_sub(to_date(o_orderdate), 12000)) AS age",
        "CASE o_orderstatus WHEN 'F' THEN 'BA' WHEN 'O' THEN 'MA' ELSE 'PhD' END AS degree",
        "year(o_orderdate) AS degree_year", "substr(o_orderpriority, 3) AS school",
        "date_sub(to_date(o_orderdate), 12000) AS birthdate", "concat('c', o_orderkey, '@example.org') AS email",
        "concat('P-', o_orderstatus) AS pasy", "CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
        "concat(o_orderstatus, ';', o_orderpriority) AS affiliations", "o_orderstatus AS primary_affiliation",
        "CAST(NULL AS STRING) AS religion")

    rating = o.selectExpr("o_custkey AS account_id", "o_orderstatus AS record_type_id",
                          f"{_sql_case('o_orderpriority', SEGMENT_BY_PRIORITY)} AS segment")

    rt_rows = ", ".join(f"('{i}', '{n}')" for i, n in RECORD_TYPES)
    record_type = spark.sql(f"SELECT * FROM VALUES {rt_rows} AS t(id, name)")

    task = activity.selectExpr("id", "account_id", "activity_date", "created_by", "created_date",
                               "modified_by", "modified_date", "owner_id", "record_type_id",
                               "type", "'Task' AS subtype", "system_modstamp", "account_id AS what_id",
                               "who_id", "gambit_key", "external_id")

    goals_import = _goals_import(s)

    return Crm(account=account, user=user, officer=officer, team=team,
               opportunity=opportunity, opportunity_team=opportunity_team,
               activity=activity, activity_contact=activity_contact, contact=contact,
               rating=rating, record_type=record_type, task=task, goals_import=goals_import,
               account_totals=account_totals)


def activity_from_events(events: DataFrame, orders: DataFrame) -> DataFrame:
    """The activity table from events (batch or streaming): the related
    account is the customer of the order sharing the event id."""
    orders_acct = orders.select("o_orderkey", "o_custkey")
    return (events.join(orders_acct, events.event_id == orders_acct.o_orderkey, "left")
            .selectExpr(
                "event_id AS id", "user_id AS owner_id",
                "CASE WHEN event_id % 13 = 0 THEN user_id + 3 ELSE user_id END AS contactor_1",
                "CASE WHEN event_id % 3 = 0 THEN user_id + 1 END AS contactor_2",
                "CASE WHEN event_id % 7 = 0 THEN user_id + 2 END AS contactor_3",
                f"{_sql_case('event_type', ACTIVITY_TYPE_BY_EVENT, 'Email')} AS type",
                f"add_months(to_date(ts), {ACTIVITY_MONTH_SHIFT}) AS activity_date",
                "CASE WHEN value >= 400 THEN 'true' ELSE 'false' END AS substantive",
                "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS STRING) "
                "WHEN event_id % 50 = 1 THEN 'In Progress' ELSE 'Completed' END AS status",
                "props AS description", "o_custkey AS account_id",
                "CASE WHEN value >= 250 THEN 'Substantive Action' ELSE 'Follow-up' END AS subject",
                "CASE WHEN event_id % 2 = 0 THEN event_id END AS who_id",
                "CASE WHEN event_type IN ('view', 'click') THEN 'V' ELSE 'T' END AS record_type_id",
                "user_id + 1 AS created_by", "ts AS created_date",
                "user_id + 2 AS modified_by", "ts AS modified_date", "ts AS system_modstamp",
                "concat('G', event_id) AS gambit_key", "concat('X', event_id) AS external_id"))


def _goals_import(s: DataFrame) -> DataFrame:
    """The goals spreadsheet as imported: every cell is text."""

    def single(number: str) -> str:
        return (f"CASE s_suppkey % 4 WHEN 0 THEN CAST({number} AS STRING) WHEN 1 THEN '0' "
                "WHEN 2 THEN '' ELSE CAST(NULL AS STRING) END")

    def money(x: str) -> str:
        return f"CAST(CAST({x} AS DECIMAL(18,2)) AS STRING)"

    frames = []
    for fy in GOAL_FYS:
        l4 = f"CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 200 + {2_000_000 - 500_000 * (GOAL_FYS[0] - fy)} AS DECIMAL(18,2))"
        frames.append(s.selectExpr(
            "concat(split_part(s_name, '#', 2), ', ', split_part(s_name, '#', 1)) AS last_first",
            f"{money(l4 + ' - 1000000')} AS dollar_goal_lvl3",
            f"CAST({l4} AS STRING) AS dollar_goal_lvl4",
            f"{money(l4 + ' + 1000000')} AS dollar_goal_lvl5",
            f"{single('CAST(' + l4 + ' + 500000 AS DECIMAL(18,2))')} AS dollar_goal_single",
            "CAST(s_nationkey + 10 AS STRING) AS visit_goal_lvl3",
            "CAST(s_nationkey + 20 AS STRING) AS visit_goal_lvl4",
            "CAST(s_nationkey + 30 AS STRING) AS visit_goal_lvl5",
            f"{single('s_nationkey + 25')} AS visit_goal_single",
            "CAST(s_nationkey + 5 AS STRING) AS ask_goal_lvl3",
            "CAST(s_nationkey + 10 AS STRING) AS ask_goal_lvl4",
            "CAST(s_nationkey + 15 AS STRING) AS ask_goal_lvl5",
            f"{single('s_nationkey + 12')} AS ask_goal_single",
            f"'{fy - 1}-07-01' AS goal_date",
            f"'{fy}' AS goal_fy",
            "CASE WHEN s_suppkey % 9 = 0 THEN 'tbd' ELSE CAST(s_nationkey AS STRING) END AS discovery_visit_goal",
            f"{money(l4 + ' - 100000')} AS dollar_goal__lvl4_fy17",
            f"{money(l4 + ' - 200000')} AS dollar_goal__lvl4_fy16",
            f"{money(l4 + ' - 300000')} AS dollar_goal__lvl4_fy15",
        ))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def standin_params(sf_dir: str | None = None) -> Params:
    """Rule-book parameters for the stand-in world.

    Reporting years are FY1995-FY1998 (orders run 1995-2001, activities are
    moved into January 1998).  People are picked among the first suppliers,
    which exist at every scale; ids of the exclusions are order keys.
    """
    # a manual name-key row for a user missing from the officer table (at
    # sf0.01 supplier 20 has a negative balance, so it is no officer there)
    manual_officer = {
        "do_id": 20,
        "first_last": "Supplier 000000020",
        "last_first": "000000020 Supplier",
        "do_team": "Planned Giving",
        "do_level": "DOD",
        "last_first_comma": "000000020, Supplier",
        "count_all_flag": "Y",
    }
    return Params(
        current_fy=1998,
        excluded_owners=("Supplier 000000003",),
        visit_people=("Supplier 000000004", "Supplier 000000005", "Supplier 000000006"),
        always_count_people=("Supplier 000000008",),
        excluded_opportunity_ids=(1161, 1834),
        multiple_lead_overrides=((736, "498622.84"),),
        override_officers=(manual_officer,),
    )
