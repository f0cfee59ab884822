"""Final SELECTs of the oracle SQL, one per registered query.

Each entry is ``name -> (final select, extra CTEs)``; the stand-ins and
shared results come from :func:`fundscope.plans.oracle.base_ctes`.
"""

from __future__ import annotations

from .. import params as P
from ..params import Params
from .oracle import _bounds, _fy, _in, _q, _values

AS_OF = "DATE '1997-06-01'"
FRAG = "00000001"
ACCOUNTS = "(736, 262)"
M = "DECIMAL(18,2)"

GOALS = [f"{kind}_goal_{level}" for kind in ("visit", "ask", "dollar")
         for level in ("lvl3", "lvl4", "lvl5", "single")]
AUDIT_COLUMNS = {
    "OwnerID": "owner_id", "OwnerName": "owner", "ActivityType": "type", "ActivityStatus": "status",
    "Activity_Description": "description", "Substantive_Activity": "substantive",
    "ActivityDate": "activity_date", "SystemModstamp": "system_modstamp", "RecordTypeID": "record_type_id",
    "RecordTypeName": "kind", "Account_ID": "account_id", "Contact_WhoID": "who_id",
    "CreatedByID": "created_by", "CreatedByName": "creator", "CreatedDate": "created_date",
    "LastModifiedByID": "modified_by", "LastModifiedByName": "modifier", "LastModifiedDate": "modified_date",
    "Gambit_Key": "gambit_key", "External_ID": "external_id",
    "Contactor": "contactor_1", "Contactor2": "contactor_2", "Contactor3": "contactor_3"}
TASK_COLUMNS = {
    "Id": "id", "AccountId": "account_id", "ActivityDate": "activity_date", "CreatedById": "created_by",
    "CreatedByName": "creator", "CreatedDate": "created_date", "LastModifiedById": "modified_by",
    "LastModifiedByName": "modifier", "LastModifiedDate": "modified_date", "OwnerId": "owner_id",
    "OwnerName": "owner", "Gambit_Key": "gambit_key", "External_Id": "external_id",
    "RecordTypeId": "record_type_id", "recordType": "kind", "Type": "type", "TaskSubtype": "subtype",
    "SystemModstamp": "system_modstamp", "WhatId": "what_id", "WhoId": "who_id"}


def _as(columns: dict[str, str]) -> str:
    return ", ".join(f"{src} AS {out}" for out, src in columns.items())


def _named(table: str) -> str:
    """A table of activities or tasks with the names behind its ids, looked up one by one."""
    who = lambda col: f"(SELECT any_value(name) FROM crm_user WHERE id = t.{col})"
    return f"""SELECT t.*, {who('created_by')} AS creator, {who('modified_by')} AS modifier, {who('owner_id')} AS owner,
        (SELECT any_value(name) FROM record_type WHERE id = t.record_type_id) AS kind FROM {table} t"""


def _measures(p: Params) -> list[tuple[str, str]]:
    """Per display name: the year's visits, asks and dollars in one grouped pass; then per officer row."""
    a, b = _bounds(p, p.current_fy)
    this = lambda col: f"{col} BETWEEN {a} AND {b}"
    dollars = f"source = 'all_asks' AND {this('gift_date')} AND StageName IN {_in(p.accepted_stages)}"
    levels = ", ".join(f"{{'bound': dollar_goal_lvl{n}, 'label': {_q(P.LEVEL_ACHIEVED[n])}}}" for n in (5, 4, 3))

    def credited(name: str, tested: str) -> tuple[str, str]:
        return (name, f"""SELECT do_id, solicitor, lead_dollars, co_dollars, goal_dollars, count_all_flag,
                CASE WHEN dollar_goal_single = 0
                       THEN list_filter([{levels}], lambda x: coalesce(goal_dollars >= x.bound, false))[1].label
                     WHEN goal_dollars >= dollar_goal_single THEN {_q(P.GOAL_ACHIEVED)} END AS goal_achieved
            FROM (SELECT DISTINCT * EXCLUDE (do_team, do_level),
                    CAST(lead_dollars + if(count_all_flag = 'Y' OR coalesce({tested} >= dollar_goal_lvl4, false),
                         co_dollars, 0) AS {M}) AS goal_dollars FROM officer_dollars)""")

    return [
        ("by_name", f"""SELECT coalesce(visitor, solicitor) AS person,
                count(*) FILTER (source = 'visits' AND {this('visit_date')} AND contactor IS NOT NULL) AS visits,
                count(*) FILTER (source = 'qual_asks' AND {this('ask_date')}) AS asks,
                coalesce(sum(gift_amt) FILTER ({dollars} AND solicitor_level = {_q(p.lead_role)}), 0) AS lead_sum,
                coalesce(sum(gift_amt) FILTER ({dollars} AND solicitor_level = {_q(p.co_role)}), 0) AS co_sum,
                sum(gift_amt) FILTER ({dollars}) AS all_sum
            FROM activity_list GROUP BY person HAVING person IS NOT NULL"""),
        ("known", "SELECT * FROM name_key WHERE do_id IS NOT NULL"),
        ("sc_vis", "SELECT person AS visitor, visits, do_id FROM by_name, known WHERE person = first_last AND visits > 0"),
        ("sc_ask", "SELECT do_id, person AS solicitor, asks FROM by_name, known WHERE person = first_last AND asks > 0"),
        ("year_goals", f"FROM goals WHERE goal_fy = {p.current_fy}"),
        # equal officer and goal rows are one row that counts several times
        ("officer_dollars", f"""SELECT k.do_id, person AS solicitor, k.do_team, k.do_level,
                CAST(any_value(lead_sum) * count(*) AS {M}) AS lead_dollars,
                CAST(any_value(co_sum) * count(*) AS {M}) AS co_dollars,
                any_value(if(k.do_team IN {_in(p.count_all_teams)}, 'Y', NULL)) AS count_all_flag,
                dollar_goal_single, dollar_goal_lvl3, dollar_goal_lvl4, dollar_goal_lvl5
            FROM by_name JOIN known k ON person = k.first_last LEFT JOIN year_goals g ON g.do_id = k.do_id
            WHERE all_sum > 0 GROUP BY k.do_id, person, k.do_team, k.do_level, dollar_goal_single,
                dollar_goal_lvl3, dollar_goal_lvl4, dollar_goal_lvl5"""),
        credited("sc_dol", "lead_dollars"),
        credited("sc_dol_total", "lead_dollars + co_dollars"),
        ("sc_gol", f"""SELECT do_id, goal_date, {', '.join(GOALS)},
                coalesce(visit_goal_single, visit_goal_lvl3) AS visit_goal,
                coalesce(ask_goal_single, ask_goal_lvl3) AS ask_goal,
                coalesce(dollar_goal_single, dollar_goal_lvl3) AS dollar_goal FROM year_goals"""),
    ]


def _scorecard(everyone: bool) -> str:
    """Equal rows are one, tested with their dollars added up."""
    goals = ", ".join(GOALS)
    ids = " UNION ".join(f"SELECT do_id FROM {t}" for t in (("sc_vis", "sc_ask", "sc_dol") if everyone else ("sc_vis",)))
    return f"""SELECT do_id, last_first_comma, last_first, do_team, do_level, goal_date, visits, asks, goal_dollars,
        {goals}, lead_dollars, co_dollars,
        CAST(CASE WHEN count_all_flag = 'Y' OR times * (lead_dollars + co_dollars) >= dollar_goal_lvl4
                  THEN lead_dollars + co_dollars ELSE lead_dollars END AS {M}) AS credited_dollars
    FROM (SELECT do_id, k.last_first_comma, k.last_first, k.do_team, k.do_level, k.count_all_flag, goal_date, visits, asks,
                 goal_dollars, {goals}, lead_dollars, co_dollars, count(*) AS times
          FROM ({ids}) LEFT JOIN sc_vis USING (do_id) LEFT JOIN sc_ask USING (do_id) LEFT JOIN sc_dol USING (do_id)
          LEFT JOIN sc_gol USING (do_id) LEFT JOIN name_key k USING (do_id)
          WHERE do_id IS NOT NULL GROUP BY ALL)"""


def _gifts(p: Params) -> list[tuple[str, str]]:
    a, b = _bounds(p, p.current_fy)
    best = "gift_amt DESC NULLS LAST, gift_date DESC NULLS LAST, AccountID NULLS FIRST"
    excluded = f"id NOT IN {_in(p.excluded_opportunity_ids)}" if p.excluded_opportunity_ids else "true"
    several = " OR ".join(["total_sols > 1", *(f"(AccountID = {acct} AND gift_amt = {amt})"
                                               for acct, amt in p.multiple_lead_overrides)])

    def ranked(name: str, src: str, n: int) -> tuple[str, str]:
        return (name, f"""SELECT AccountID, acc.name AS hh_name, CAST(o.amount AS {M}) AS gift_amt, close_date AS gift_date,
                (lead_solicitor_id IS NOT NULL)::BIGINT AS total_sols, o.id AS opportunity_ID
            FROM (SELECT *, account_id AS AccountID FROM {src}) o JOIN account acc ON acc.id = AccountID
            QUALIFY row_number() OVER (ORDER BY {best}, hh_name NULLS FIRST, opportunity_ID NULLS FIRST) <= {n}""")

    def labelled(name: str, on: str) -> tuple[str, str]:
        return (name, f"""FROM (SELECT DISTINCT AccountID, hh_name, gift_amt, gift_date, opportunity_ID,
                    CASE WHEN {several} THEN {_q(P.MULTIPLE_LEADS)}
                         WHEN lead_solicitor_id IS NULL THEN {_q(P.NO_LEAD)} ELSE lead.name END AS solicitor
                FROM tg JOIN year_gifts y ON {on} LEFT JOIN crm_user lead ON lead.id = lead_solicitor_id)
            QUALIFY row_number() OVER (ORDER BY {best}, opportunity_ID NULLS FIRST, solicitor NULLS FIRST,
                                       hh_name NULLS FIRST) <= {p.top_n}""")

    return [
        ("all_year_gifts", f"FROM opportunity WHERE stage IN {_in(p.accepted_stages)} AND close_date BETWEEN {a} AND {b}"),
        ("year_gifts", f"FROM all_year_gifts WHERE {excluded}"),
        ranked("tg", "year_gifts", p.top_n),
        ranked("tg_old", "all_year_gifts", 30),
        labelled("bs", "y.account_id = tg.AccountID"),
        labelled("bs_opp", "y.id = tg.opportunity_ID"),
        ("account_leads", """SELECT DISTINCT account_id, u.name AS lead_name
            FROM all_year_gifts LEFT JOIN crm_user u ON u.id = lead_solicitor_id"""),
    ]


def _merged(src: str) -> str:
    return f"""SELECT AccountID, hh_name, CAST(gift_amt * times AS {M}) AS gift_amt, gift_date, solicitor
        FROM (SELECT AccountID, hh_name, gift_amt, gift_date, solicitor, count(*) AS times FROM {src} GROUP BY ALL)"""


def _tiers(p: Params) -> list[tuple[str, str]]:
    cuts = [(i, float(c)) for i, c in enumerate(sorted(p.capacity_cutoffs, reverse=True), start=1)]
    return [
        ("segment_of", f"SELECT * FROM {_values(list(p.segment_codes.items()), 's(segment, code)')}"),
        ("cut", f"SELECT * FROM {_values(cuts, 'c(code, bound)')}"),
        ("tier", f"SELECT * FROM {_values(list(P.TIER_LABELS.items()), 't(code, label)')}"),
        ("rated", """SELECT r.*, coalesce(s.code, 0) AS segment_code
            FROM rating r LEFT JOIN segment_of s ON s.segment = r.segment"""),
        ("sized", """SELECT *, coalesce((SELECT min(code) FROM cut WHERE capacity >= bound), 0) AS capacity_code
            FROM account"""),
    ]


def _tier_of(p: Params, tiers: list, chosen: str) -> tuple[str, list]:
    final = f"""SELECT id AS Account_ID, coalesce(label, {_q(P.NO_TIER_LABEL)}) AS comb_capacity_range,
            CASE WHEN capacity_code > 0 THEN {_q(P.SOURCE_RESEARCH)} WHEN best > 0 THEN {_q(P.SOURCE_VENDOR)} END AS comb_capacity_source
        FROM (SELECT s.*, best, if(capacity_code > 0, capacity_code, coalesce(best, 0)) AS chosen
              FROM sized s LEFT JOIN vendor ON account_id = id
              WHERE status = 'Active' AND (account_id IS NULL OR counted > 0))
        LEFT JOIN tier ON code = chosen"""
    vendor = f"""SELECT account_id, count(*) FILTER (ok) AS counted, {chosen} AS best
        FROM (SELECT *, coalesce((SELECT any_value(name) FROM record_type WHERE id = record_type_id),
                                 {_q(p.rating_record_types[0])}) IN {_in(p.rating_record_types)} AS ok FROM rated)
        GROUP BY account_id"""
    return final, [*tiers, ("vendor", vendor)]


def _lead_sums(p: Params, stages) -> str:
    a, b = _bounds(p, p.current_fy)
    return f"""SELECT (SELECT any_value(name) FROM crm_user WHERE id = lead_solicitor_id) AS Name,
            CAST(sum(amount) AS {M}) AS lead_sol_dollars
        FROM opportunity WHERE stage IN {_in(stages)} AND close_date BETWEEN {a} AND {b} GROUP BY 1"""


def _opportunities(where: str) -> str:
    return f"""SELECT id AS OpportunityID, account_id AS AccountId, ask_date AS Ask_Date, ask_amount AS Ask_Amount,
        close_date AS CloseDate, amount AS Amount, stage AS StageName FROM opportunity WHERE {where}"""


def _rejects() -> str:
    """Blank and unparsable cells of each typed column."""
    kinds = {f"{k}_goal_{lv}": "DOUBLE" for k in ("dollar", "visit", "ask") for lv in ("lvl3", "lvl4", "lvl5", "single")}
    kinds |= {"goal_date": "DATE", "goal_fy": "INTEGER", "discovery_visit_goal": "INTEGER"}
    kinds |= {f"dollar_goal__lvl4_fy{y}": "DOUBLE" for y in (17, 16, 15)}
    return " UNION ALL ".join(
        f"""SELECT {_q(c.replace('__', '_'))} AS column_name, count(*) FILTER (trim({c}) = '') AS blank_cells,
            count(*) FILTER (trim({c}) <> '' AND TRY_CAST({c} AS {t}) IS NULL) AS rejected_cells FROM goals_import"""
        for c, t in kinds.items())


def finals(p: Params) -> dict[str, tuple[str, list]]:
    a, b = _bounds(p, p.current_fy)
    first, last = (f"DATE '{d}'" for d in p.report_bounds)
    accepted, wide = _in(p.accepted_stages), _in(p.visit_types)
    sc, gifts, tiers = _measures(p), _gifts(p), _tiers(p)
    lead = _q(p.lead_role)
    kept = f"owner NOT IN {_in(p.excluded_owners)}" if p.excluded_owners else "owner IS NOT NULL"
    acts = [("named_acts", _named("activity")),
            ("audit", f"SELECT {_as(AUDIT_COLUMNS)} FROM named_acts WHERE type IN {wide} AND {kept}")]
    contacts = [("contact_rows", f"""SELECT o.*, l.activity_id AS activity_id_rc, l.contact_id AS contact_id_rc
        FROM activity_contact l RIGHT JOIN (SELECT * FROM activity WHERE type IN {wide}) o ON o.id = l.activity_id""")]
    filled = """unnest([{'n': 'contactor_1', 'who': contactor_1}, {'n': 'contactor_2', 'who': contactor_2},
        {'n': 'contactor_3', 'who': contactor_3}]) AS u(place) WHERE place.who IS NOT NULL"""
    branch = lambda s: (f"FROM activity_list WHERE source = '{s}'", [])

    return {
        # credited dollars
        "credited_dollars": ("FROM sc_dol", sc),
        "credited_dollars_total": ("FROM sc_dol_total", sc),
        "role_dollars": (f"""SELECT do_id, person AS solicitor, do_team, do_level,
                CAST(lead_sum * count(*) AS {M}) AS lead_dollars, CAST(co_sum * count(*) AS {M}) AS co_dollars
            FROM by_name, known WHERE person = first_last AND all_sum > 0
            GROUP BY do_id, person, do_team, do_level, lead_sum, co_sum""", sc),
        # fiscal years and windows
        "fiscal_year": (f"""SELECT id AS OpportunityID, close_date, ask_date, {_fy('close_date')} AS close_fy,
            {_fy('ask_date')} AS ask_fy FROM opportunity""", []),
        "fy_amount_columns": ("FROM opps", []),
        "date_window": (f"""SELECT {_fy('gift_date')} AS comb_fy, StageName, count(*) AS n, CAST(sum(gift_amt) AS {M}) AS gift_amt
            FROM opps WHERE ask_date BETWEEN {first} AND {last} OR gift_date BETWEEN {first} AND {last} GROUP BY ALL""", []),
        # unpivots
        "contactors_unpivot": (f"""SELECT owner_id AS do_id, activity_date AS actcompdat, type AS actcontvalue,
                type AS actactivity, substantive AS Substantive_Activity, status AS actcategory, description AS actcomm,
                w.name AS taskcontactor, sort_name AS taskcontactorsort, account_id AS Account_ID, id AS activity_id,
                activity_id_rc, contact_id_rc, place.n AS contactor_number, place.who AS contactor
            FROM contact_rows JOIN person w ON w.user_id = owner_id AND {kept.replace('owner', 'w.name')}, {filled}""", contacts),
        "contact_links_unpivot": ("""SELECT owner_id AS OwnerID, owner_name AS OwnerName, type AS ActivityType,
                description AS Activity_Description, activity_date AS ActivityDate, account_id AS AccountID,
                status AS ActivityStatus, substantive AS Substantive_Activity, activity_id AS activity_id_rc,
                subject AS Subject__c, contactor_number, contactor, contactor_name,
                hit.n AS related_contact, hit.who AS contact
            FROM places LEFT JOIN activity_contact ON activity_id = id,
                unnest([{'n': 'WhoId__c', 'who': who_id}, {'n': 'contact_rc', 'who': contact_id}]) AS u(hit)
            WHERE hit.who IS NOT NULL""", []),
        # dimensions
        "name_key": ("FROM name_key", []),
        "name_forms": ("FROM person", []),
        "team_flag": (f"""SELECT user_id, t.name AS do_team, level, if(t.name IN {_in(p.count_all_teams)}, 'Y', NULL) AS count_all_flag
            FROM team t RIGHT JOIN officer ON team_id = t.id""", []),
        "segment_code": ("SELECT account_id, record_type_id, segment, segment_code FROM rated", tiers),
        "numeric_tier": (f"""SELECT id AS account_id, capacity, capacity_code, coalesce(label, {_q(P.NO_TIER_LABEL)}) AS capacity_label
            FROM sized LEFT JOIN tier ON code = capacity_code""", tiers),
        "capacity_tier": _tier_of(p, tiers, "max(segment_code) FILTER (ok)"),
        "capacity_tier_best": _tier_of(p, tiers, "min(segment_code) FILTER (ok AND segment_code > 0)"),
        # flattened views
        "proposals": ("""SELECT OwnerID AS do_id, lead_solicitor_ID AS Lead_Solicitor_ID, ask_date, ask_amt, gift_amt, gift_date,
                optm_name AS solicitor, solicitor_level, gift_name, gift_unit, OpportunityID, StageName, Comment, AccountID,
                (SELECT any_value(name) FROM account WHERE id = AccountID) AS AccountName FROM opps""", []),
        "proposal_wide": ("""SELECT OpportunityID, StageName, OwnerID, opps.lead_solicitor_ID AS Lead_Solicitor_ID, AccountID,
                gift_name AS Opportunity_name, opps.ask_date AS Ask_Date, ask_amt AS Ask_Amount, gift_date AS Close_Date,
                gift_amt AS Amount, gift_unit AS Division, o.campaign_fund AS CampaignFund, opps.Comment,
                o.fiscal_year AS Fiscal_Yr, o.fiscal_quarter AS Fiscal_Qtr, optm_name AS DO_name, solicitor_level AS TeamMemberRole
            FROM opps JOIN opportunity o ON o.id = OpportunityID""", []),
        "prospects": ("""SELECT a.id AS Account_Id, a.name AS Account_Name, c.id AS Contact_Id, c.name AS Contact_Name,
                external_id AS Gambit_Id, status AS Account_Status, account_type AS Account_Type, district AS District,
                region AS Region, total_gifts AS Total_Gifts, total_gifts_count AS Total_Gifts_Count,
                billing_city AS Billing_City, billing_country AS Billing_Country, billing_state AS Billing_State,
                billing_postal_code AS Billing_Postal_Code, capacity AS GU_Capacity, number_of_contacts AS Number_of_Contacts,
                relationship_manager AS Relationship_Manager, age AS Age, degree AS Degree, degree_year AS Degree_Year,
                school AS School, contact_type AS Category, birthdate AS Birthdate, email AS Contact_Email, label AS GUSY,
                pasy AS PASY, gender AS Gender, affiliations AS Affilication, primary_affiliation AS Primary_Affiliation,
                religion AS Religion
            FROM account a LEFT JOIN account_totals t ON t.account_id = a.id RIGHT JOIN contact c ON c.account_id = a.id""", []),
        "task_audit": (f"SELECT {_as(TASK_COLUMNS)} FROM named_tasks", [("named_tasks", _named("task"))]),
        "audit_names": ("""SELECT id AS activity_id, creator AS CreatedByName, modifier AS LastModifiedByName,
            owner AS OwnerName, kind AS RecordTypeName FROM named_acts""", acts),
        "activity_audit": ("FROM audit", acts),
        "activity_contacts_audit": (f"""SELECT owner_id AS OwnerID, owner AS OwnerName, type AS ActivityType,
                description AS Activity_Description, activity_date AS ActivityDate, system_modstamp AS SystemModstamp,
                account_id AS AccountID, record_type_id AS RecordTypeID, kind AS RecordTypeName, status AS ActivityStatus,
                substantive AS Substantive_Activity, activity_id_rc, contact_id_rc
            FROM named_rows WHERE {kept}""", contacts + [("named_rows", _named("contact_rows"))]),
        # goals
        "goals_import": ("FROM goals", []),
        "goal_rejects": (_rejects(), []),
        "effective_goal": ("FROM sc_gol", sc),
        "goal_level": ("SELECT do_id, goal_dollars, goal_achieved FROM sc_dol", sc),
        # the activity list
        "visits_qualified": branch("visits"),
        "asks_qualified": branch("qual_asks"),
        "dollars_dedup": branch("all_asks"),
        "activity_list": ("FROM activity_list", []),
        # scorecard
        "visits_rollup": ("FROM sc_vis", sc),
        "visits_by_id": (f"""SELECT visitor, sum(times)::BIGINT AS visits, contactor AS do_id FROM visits_counted
            WHERE visit_date BETWEEN {a} AND {b} AND times > 0 AND contactor IN (SELECT do_id FROM known)
            GROUP BY visitor, contactor""", sc),
        "visits_distinct": (f"""SELECT visitor, n AS visits, do_id
            FROM (SELECT visitor, count(DISTINCT activity_id) AS n FROM visits_counted
                  WHERE visit_date BETWEEN {a} AND {b} AND times > 0 GROUP BY visitor)
            JOIN known ON first_last = visitor""",
            [c for c in sc if c[0] == "known"]),
        "visits_distinct_by_fy": ("""SELECT visitor, comb_fy, count(DISTINCT activity_id) AS visits FROM visits_counted
            WHERE times > 0 AND contactor IS NOT NULL GROUP BY visitor, comb_fy""", []),
        "visits_distinct_years": ("""SELECT visitor, count(DISTINCT activity_id) AS visits FROM visits_counted
            WHERE times > 0 AND contactor IS NOT NULL GROUP BY visitor""", []),
        "scorecard_resolved": (_scorecard(False), sc),   # no two officers of the test tables share a name
        "asks_rollup": ("FROM sc_ask", sc),
        "scorecard": (_scorecard(False), sc),
        "scorecard_all_officers": (_scorecard(True), sc),
        # top gifts
        "top_gifts": ("FROM tg", gifts),
        "top_gifts_labelled": ("FROM bs", gifts),
        "top_gifts_merged": (_merged("bs"), gifts),
        "top_gifts_by_opportunity": (_merged("bs_opp"), gifts),
        "top_gifts_by_lead_name": (f"""SELECT DISTINCT AccountID, hh_name, gift_amt, gift_date, opportunity_ID,
                if(total_sols > 1, {_q(P.MULTIPLE_LEADS)}, coalesce(nullif(lead_name, ''), {_q(P.NO_LEAD)})) AS solicitor
            FROM account_leads RIGHT JOIN tg_old ON account_id = AccountID""", gifts),
        # households: the first two contacts of an account side by side
        "household_label": (f"""SELECT AccountID, concat_ws({_q(P.HOUSEHOLD_SEPARATOR)}, rtrim(one), rtrim(two)) AS comb_gusy
            FROM (SELECT account_id AS AccountID, max(label) FILTER (nth = 1) AS one, max(label) FILTER (nth = 2) AS two
                  FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY is_primary DESC, id) AS nth FROM contact)
                  GROUP BY account_id)
            WHERE one IS NOT NULL AND AccountID IN (SELECT id FROM account)""", []),
        # checks
        "qa_distinct_values": ("SELECT role FROM opportunity_team GROUP BY role", []),
        "qa_distinct_substantive": ("SELECT Substantive_Activity FROM audit GROUP BY ALL", acts),
        "qa_distinct_types": ("SELECT ActivityType FROM audit GROUP BY ALL", acts),
        "qa_distinct_teams": ("SELECT do_team FROM name_key GROUP BY ALL", []),
        "qa_distinct_status": ("SELECT status FROM activity GROUP BY ALL", []),
        "qa_distinct_account_status": ("SELECT status FROM account GROUP BY ALL", []),
        "qa_column_browse": ("FROM audit WHERE ActivityType = 'Visit'", acts),
        "qa_name_search": (f"FROM name_key WHERE contains(first_last, '{FRAG}')", []),
        "name_postings": ("""SELECT DISTINCT substr(v, i, least(3, len(v))) AS gram, v AS value
            FROM (SELECT first_last AS v, unnest(range(1, greatest(len(first_last) - 2, 1) + 1)) AS i
                  FROM name_key WHERE first_last IS NOT NULL)""", []),
        "qa_name_search_postings": (f"FROM name_key WHERE contains(first_last, '{FRAG}')", []),
        "qa_status_counts": (f"SELECT status AS Status, count(*) AS n FROM activity WHERE type IN {wide} GROUP BY ALL", []),
        "qa_null_status": ("""SELECT NULL::VARCHAR AS Status, activity_date AS ActivityDate, count(*) - count(status) AS n
            FROM activity GROUP BY ActivityDate HAVING n > 0""", []),
        "qa_counts_by_owner": (f"""SELECT OwnerName, ActivityType, count(*) AS n FROM audit
            GROUP BY ALL HAVING contains(OwnerName, '{FRAG}')""", acts),
        "qa_types_of_people": (f"SELECT ActivityType FROM audit WHERE OwnerName IN {_in(p.visit_people or ('',))} GROUP BY ALL", acts),
        "qa_owner_mismatch": ("""SELECT owner_id AS owner_id_1, contactor_1 AS ownerID_c1, owner AS name2
            FROM named_acts WHERE contactor_1 <> owner_id""", acts),
        "qa_multi_lead_self": ("""SELECT id AS Id, lead_solicitor_id AS Lead_Solicitor, n AS count_lead_sol
            FROM (SELECT id, lead_solicitor_id, count(lead_solicitor_id) AS n FROM opportunity GROUP BY ALL) WHERE n > 1""", []),
        "qa_known_leads": ("""SELECT DISTINCT optm_name AS name, lead_solicitor_ID AS Lead_Solicitor
            FROM opps SEMI JOIN name_key ON do_id = lead_solicitor_ID""", []),
        "qa_multi_lead_named": (f"""SELECT opportunity_id, name, len(users) AS count_of_lead_sol
            FROM (SELECT opportunity_id, name, list(DISTINCT user_id) AS users FROM opportunity_team WHERE role = {lead}
                  GROUP BY ALL) WHERE len(users) > 1""", []),
        "qa_lead_mismatch": (f"""SELECT OpportunityID AS OpportunityId, optm_name AS team_name, gift_name AS opp_name
            FROM opps WHERE solicitor_level = {lead} AND optm_userID <> lead_solicitor_ID""", []),
        "qa_lead_mismatch_long": (f"""SELECT OpportunityID AS OpportunityId, optm_name AS team_name, gift_name AS opp_name,
                optm_userID AS UserId, lead_solicitor_ID AS Lead_Solicitor
            FROM opps WHERE solicitor_level = {lead} AND optm_userID <> lead_solicitor_ID""", []),
        "qa_officer_leads": (f"""SELECT DISTINCT optm_name AS name, lead_solicitor_ID AS Lead_Solicitor, do_id
            FROM (SELECT * FROM opps WHERE solicitor_level = {lead}) JOIN name_key ON do_id = lead_solicitor_ID""", []),
        "qa_lead_dollars_name": (f"FROM sums WHERE contains(Name, '{FRAG}')", [("sums", _lead_sums(p, p.wide_stages))]),
        "qa_lead_dollars": ("FROM sums", [("sums", _lead_sums(p, p.accepted_stages))]),
        "qa_reconcile": (f"""SELECT name AS Name, sum(amt) FILTER (side = 'crm') AS lead_sol_dollars,
                if(bool_or(side = 'list'), name, NULL) AS first_last, sum(amt) FILTER (side = 'list') AS list_dollars,
                CAST(sum(amt) FILTER (side = 'crm') - sum(amt) FILTER (side = 'list') AS {M}) AS difference
            FROM (SELECT 'crm' AS side, Name AS name, lead_sol_dollars AS amt FROM sums
                  UNION ALL SELECT 'list', first_last, CAST(sum(gift_amt) AS {M}) FROM activity_list
                  WHERE source = 'all_asks' AND solicitor_level = {lead} AND StageName IN {accepted}
                    AND gift_date BETWEEN {a} AND {b} AND first_last IS NOT NULL GROUP BY first_last)
            GROUP BY name HAVING bool_or(side = 'crm')""", [("sums", _lead_sums(p, p.accepted_stages))]),
        "qa_visit_contacts": (f"""SELECT type AS ActivityType, description AS Activity_Description, activity_date AS ActivityDate,
                account_id AS AccountID, status AS ActivityStatus, substantive AS Substantive_Activity, activity_id_rc,
                contact_id_rc, place.n AS contactor_number, place.who AS contactor FROM contact_rows, {filled}""", contacts),
        "qa_accepted_sorted": (f"SELECT ask_date, ask_amt, gift_date, gift_amt, solicitor FROM activity_list WHERE StageName IN {accepted}", []),
        "qa_low_amount": ("FROM dollars WHERE contains(StageName, 'Accepted') AND gift_amt < 1", []),
        "qa_low_amount_opps": (_opportunities("contains(stage, 'Accepted') AND amount < 1"), []),
        "qa_future_asks": (f"FROM dollars WHERE ask_date >= {AS_OF} AND ask_amt >= 1", []),
        "qa_future_asks_opps": (_opportunities(f"ask_date > {AS_OF} AND ask_amount >= 1"), []),
        "qa_account_rows": (f"FROM dollars WHERE AccountID IN {ACCOUNTS}", []),
        "qa_account_rows_opps": (_opportunities(f"account_id IN {ACCOUNTS}"), []),
        "qa_multi_lead": (f"""SELECT opportunity_id, len(users) AS count_of_lead_sol
            FROM (SELECT opportunity_id, list(DISTINCT user_id) AS users FROM opportunity_team WHERE role = {lead}
                  GROUP BY ALL) WHERE len(users) > 1""", []),
        "qa_unmatched_goals": ("SELECT last_first, goal_fy FROM typed_goals g ANTI JOIN name_key k ON k.last_first_comma = g.last_first", []),
        "qa_collapsed_dollars": ("""SELECT solicitor_level, sum(before)::BIGINT AS rows_in, sum(after)::BIGINT AS rows_out,
                (coalesce(sum(before), 0) - coalesce(sum(after), 0))::BIGINT AS merged
            FROM (SELECT solicitor_level, 1 AS before, NULL AS after FROM counted_rows
                  UNION ALL SELECT solicitor_level, NULL, 1 FROM dollars) GROUP BY solicitor_level""", [
            ("counted_rows", f"""FROM opps WHERE solicitor_level IN {_in((p.lead_role, p.co_role))}
                AND (ask_date BETWEEN {first} AND {last} OR gift_date BETWEEN {first} AND {last})""")]),
    }
