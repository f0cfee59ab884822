"""Oracle SQL (DuckDB dialect) for every registered query.

Each text states, independently of the DataFrame code, (1) the stand-in
CRM tables over the test tables and (2) every result from its rule in the
survey: rules as lookup tables, counts of links instead of repeated rows,
grouped facts joined once.  Only the rule-book values (names, ids, years) are
filled in from :class:`Params`.
"""

from __future__ import annotations

from ..params import Params
from ..sources import standins as S


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values) + ")"


def _fy(col: str) -> str:
    return f"CAST(CASE WHEN month({col}) >= 7 THEN year({col}) + 1 ELSE year({col}) END AS INTEGER)"


def _bounds(p: Params, fy: int) -> tuple[str, str]:
    a, b = p.fy_bounds(fy)
    return f"DATE '{a.isoformat()}'", f"DATE '{b.isoformat()}'"


def _case(col: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {_q(default) if default is not None else 'NULL'} END"


# ----------------------------------------------------------------------------
# stand-in CRM tables
# ----------------------------------------------------------------------------

def base_ctes(p: Params) -> list[tuple[str, str]]:
    levels = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(S.LEVELS))
    seg = _case("o_orderpriority", S.SEGMENT_BY_PRIORITY)
    rt_rows = ", ".join(f"({_q(i)}, {_q(n)})" for i, n in S.RECORD_TYPES)
    goal_parts = []
    for fy in S.GOAL_FYS:
        offset = 2_000_000 - 500_000 * (S.GOAL_FYS[0] - fy)
        goal_parts.append(f"""
        SELECT split_part(s_name, '#', 2) || ', ' || split_part(s_name, '#', 1) AS last_first,
               CAST(CAST(l4 - 1000000 AS DECIMAL(18,2)) AS VARCHAR) AS dollar_goal_lvl3,
               CAST(l4 AS VARCHAR) AS dollar_goal_lvl4,
               CAST(CAST(l4 + 1000000 AS DECIMAL(18,2)) AS VARCHAR) AS dollar_goal_lvl5,
               CASE s_suppkey % 4 WHEN 0 THEN CAST(CAST(l4 + 500000 AS DECIMAL(18,2)) AS VARCHAR)
                    WHEN 1 THEN '0' WHEN 2 THEN '' ELSE NULL END AS dollar_goal_single,
               CAST(s_nationkey + 10 AS VARCHAR) AS visit_goal_lvl3,
               CAST(s_nationkey + 20 AS VARCHAR) AS visit_goal_lvl4,
               CAST(s_nationkey + 30 AS VARCHAR) AS visit_goal_lvl5,
               CASE s_suppkey % 4 WHEN 0 THEN CAST(s_nationkey + 25 AS VARCHAR)
                    WHEN 1 THEN '0' WHEN 2 THEN '' ELSE NULL END AS visit_goal_single,
               CAST(s_nationkey + 5 AS VARCHAR) AS ask_goal_lvl3,
               CAST(s_nationkey + 10 AS VARCHAR) AS ask_goal_lvl4,
               CAST(s_nationkey + 15 AS VARCHAR) AS ask_goal_lvl5,
               CASE s_suppkey % 4 WHEN 0 THEN CAST(s_nationkey + 12 AS VARCHAR)
                    WHEN 1 THEN '0' WHEN 2 THEN '' ELSE NULL END AS ask_goal_single,
               '{fy - 1}-07-01' AS goal_date,
               '{fy}' AS goal_fy,
               CASE WHEN s_suppkey % 9 = 0 THEN 'tbd' ELSE CAST(s_nationkey AS VARCHAR) END AS discovery_visit_goal,
               CAST(CAST(l4 - 100000 AS DECIMAL(18,2)) AS VARCHAR) AS dollar_goal__lvl4_fy17,
               CAST(CAST(l4 - 200000 AS DECIMAL(18,2)) AS VARCHAR) AS dollar_goal__lvl4_fy16,
               CAST(CAST(l4 - 300000 AS DECIMAL(18,2)) AS VARCHAR) AS dollar_goal__lvl4_fy15
        FROM (SELECT *, CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 200 + {offset} AS DECIMAL(18,2)) AS l4
              FROM supplier)""")
    return [
        ("geo", """SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name
                   FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""),
        ("account", """SELECT c.c_custkey AS id, c.c_name AS name, g.n_name AS district,
                   g.r_name AS region,
                   CASE WHEN c.c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status,
                   c.c_mktsegment AS account_type,
                   CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) * 1100 AS DECIMAL(18,2)) AS capacity,
                   'A-' || c.c_custkey AS external_id, 'City ' || c.c_nationkey AS billing_city,
                   g.n_name AS billing_country, g.r_name AS billing_state,
                   CAST(10000 + c.c_custkey AS VARCHAR) AS billing_postal_code
                   FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey"""),
        ("crm_user", """SELECT s_suppkey AS id,
                   CASE WHEN s_suppkey % 20 = 19 THEN NULL
                        ELSE split_part(s_name, '#', 1) || ' ' || split_part(s_name, '#', 2) END AS name,
                   split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name
                   FROM supplier"""),
        ("officer", f"""SELECT s.s_suppkey AS user_id, n.n_regionkey AS team_id,
                   CASE s.s_suppkey % 6 {levels} END AS level
                   FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
                   WHERE s.s_acctbal >= 0"""),
        ("team", f"SELECT r_regionkey AS id, {_case('r_name', S.TEAM_BY_REGION)} AS name FROM region"),
        ("heads", """SELECT l_orderkey, min(CASE WHEN l_linenumber = 1 THEN l_suppkey END) AS lead,
                   min(l_suppkey) AS owner FROM lineitem GROUP BY l_orderkey"""),
        ("opportunity", f"""SELECT o.o_orderkey AS id, h.owner AS owner_id, o.o_custkey AS account_id,
                   h.lead AS lead_solicitor_id,
                   CAST(o.o_orderdate AS DATE) - 60 AS ask_date,
                   CASE WHEN o.o_orderkey % 4 = 0 THEN NULL
                        ELSE CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 2 AS DECIMAL(18,2)) END AS ask_amount,
                   CASE WHEN o.o_totalprice < 3000 THEN CAST(0.5 AS DECIMAL(18,2))
                        ELSE CAST(o.o_totalprice AS DECIMAL(18,2)) END AS amount,
                   CAST(o.o_orderdate AS DATE) AS close_date,
                   o.o_orderpriority AS name, o.o_orderstatus AS division,
                   {_case('o.o_orderstatus', S.STAGE_BY_STATUS)} AS stage,
                   'order ' || CAST(o.o_orderkey AS VARCHAR) AS comment,
                   {_fy('o.o_orderdate')} AS fiscal_year,
                   CAST(quarter(o.o_orderdate + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_quarter,
                   'Fund ' || o.o_orderstatus AS campaign_fund
                   FROM orders o LEFT JOIN heads h ON o.o_orderkey = h.l_orderkey"""),
        ("members", f"""SELECT DISTINCT l_orderkey AS opportunity_id, l_suppkey AS user_id,
                   CASE WHEN l_linenumber = 1 THEN {_q(p.lead_role)}
                        WHEN l_linenumber = 2 THEN {_q(p.co_role)} ELSE 'Team Member' END AS role
                   FROM lineitem"""),
        ("opportunity_team", """SELECT m.opportunity_id, m.user_id, u.name, m.role
                   FROM members m LEFT JOIN crm_user u ON m.user_id = u.id"""),
        ("activity", f"""SELECT e.event_id AS id, e.user_id AS owner_id,
                   CASE WHEN e.event_id % 13 = 0 THEN e.user_id + 3 ELSE e.user_id END AS contactor_1,
                   CASE WHEN e.event_id % 3 = 0 THEN e.user_id + 1 END AS contactor_2,
                   CASE WHEN e.event_id % 7 = 0 THEN e.user_id + 2 END AS contactor_3,
                   {_case('e.event_type', S.ACTIVITY_TYPE_BY_EVENT, 'Email')} AS type,
                   CAST(CAST(e.ts AS DATE) - INTERVAL {-S.ACTIVITY_MONTH_SHIFT} MONTH AS DATE) AS activity_date,
                   CASE WHEN e.value >= 400 THEN 'true' ELSE 'false' END AS substantive,
                   CASE WHEN e.event_id % 50 = 0 THEN NULL WHEN e.event_id % 50 = 1 THEN 'In Progress'
                        ELSE 'Completed' END AS status,
                   e.props AS description, o.o_custkey AS account_id,
                   CASE WHEN e.value >= 250 THEN 'Substantive Action' ELSE 'Follow-up' END AS subject,
                   CASE WHEN e.event_id % 2 = 0 THEN e.event_id END AS who_id,
                   CASE WHEN e.event_type IN ('view', 'click') THEN 'V' ELSE 'T' END AS record_type_id,
                   e.user_id + 1 AS created_by, e.ts AS created_date, e.user_id + 2 AS modified_by,
                   e.ts AS modified_date, e.ts AS system_modstamp,
                   'G' || e.event_id AS gambit_key, 'X' || e.event_id AS external_id
                   FROM events e LEFT JOIN orders o ON e.event_id = o.o_orderkey"""),
        ("activity_contact", """SELECT DISTINCT l_orderkey AS activity_id, l_partkey AS contact_id
                   FROM lineitem"""),
        ("contact", """SELECT o_orderkey AS id, o_custkey AS account_id,
                   'Contact ' || CAST(o_orderkey AS VARCHAR) AS name,
                   CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority || '  ' END AS label,
                   CASE WHEN starts_with(o_orderpriority, '1') THEN 'Yes' ELSE 'No' END AS is_primary,
                   o_orderstatus AS contact_type,
                   1998 - year(CAST(o_orderdate AS DATE) - 12000) AS age,
                   CASE o_orderstatus WHEN 'F' THEN 'BA' WHEN 'O' THEN 'MA' ELSE 'PhD' END AS degree,
                   year(o_orderdate) AS degree_year, substr(o_orderpriority, 3) AS school,
                   CAST(o_orderdate AS DATE) - 12000 AS birthdate, 'c' || o_orderkey || '@example.org' AS email,
                   'P-' || o_orderstatus AS pasy, CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                   o_orderstatus || ';' || o_orderpriority AS affiliations, o_orderstatus AS primary_affiliation,
                   CAST(NULL AS VARCHAR) AS religion FROM orders"""),
        ("account_totals", """SELECT o_custkey AS account_id,
                   CAST(coalesce(sum(amount) FILTER (o_orderstatus = 'F'), 0) AS DECIMAL(18,2)) AS total_gifts,
                   count(*) FILTER (o_orderstatus = 'F') AS total_gifts_count, count(*) AS number_of_contacts,
                   max(lead_solicitor_id) AS relationship_manager
                   FROM orders JOIN opportunity ON id = o_orderkey GROUP BY o_custkey"""),
        ("rating", f"""SELECT o_custkey AS account_id, o_orderstatus AS record_type_id, {seg} AS segment
                   FROM orders"""),
        ("record_type", f"SELECT * FROM (VALUES {rt_rows}) AS t(id, name)"),
        ("task", """SELECT id, account_id, activity_date, created_by, created_date, modified_by,
                   modified_date, owner_id, record_type_id, type, 'Task' AS subtype,
                   system_modstamp, account_id AS what_id, who_id, gambit_key, external_id FROM activity"""),
        ("goals_import", " UNION ALL ".join(goal_parts)),
        *views(p),
    ]


# ----------------------------------------------------------------------------
# shared results, each stated from its rule
# ----------------------------------------------------------------------------

AL_COLUMNS = {
    "AccountID": "BIGINT", "hh_name": "VARCHAR", "market": "VARCHAR", "do_id": "BIGINT",
    "comb_fy": "INTEGER", "visit_date": "DATE", "visit_summ": "VARCHAR", "visitor": "VARCHAR",
    "ask_amt": "DECIMAL(18,2)", "ask_date": "DATE", "gift_amt": "DECIMAL(18,2)",
    "gift_date": "DATE", "solicitor": "VARCHAR", "solicitor_level": "VARCHAR",
    "gift_name": "VARCHAR", "gift_unit": "VARCHAR", "source": "VARCHAR",
    "ActivityStatus": "VARCHAR", "StageName": "VARCHAR", "lead_solicitor_ID": "BIGINT",
    "first_last": "VARCHAR", "last_first": "VARCHAR", "last_first_comma": "VARCHAR",
    "contactor": "BIGINT", "contactor_name": "VARCHAR", "Subject__c": "VARCHAR",
    "gift_amt_comb_lead_sec": "DECIMAL(18,2)",
}


def fy_name(fy: int) -> str:
    return f"fy_{fy % 100:02d}_gift_amount"


def _on_list(p: Params, have: set[str]) -> str:
    """A projection on the list's columns; what a branch lacks is NULL."""
    types = AL_COLUMNS | {fy_name(fy): "DECIMAL(18,2)" for fy in p.report_fys}
    return ", ".join(f"CAST({c if c in have else 'NULL'} AS {t}) AS {c}" for c, t in types.items())


def _values(rows, names: str) -> str:
    lit = lambda v: "NULL" if v is None else _q(v) if isinstance(v, str) else str(v)
    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS {names}"


def _ask_rules(p: Params):
    """(what is looked at, its value, least ask amount or NULL for any)."""
    yield from (("person", v, None) for v in p.always_count_people)
    yield from (("level", v, None) for v in p.ask_levels_always)
    yield from (("team", v, None) for v in p.ask_teams_always)
    yield from (("team", v, float(m)) for v, m in p.ask_team_minimums)
    yield from (("level", v, float(m)) for v, m in p.ask_level_minimums)


def views(p: Params) -> list[tuple[str, str]]:
    first, last = (f"DATE '{d}'" for d in p.report_bounds)
    names = ("do_id", "first_last", "last_first", "do_team", "do_level", "last_first_comma", "count_all_flag")
    manual = [tuple(r[k] for k in names) for r in p.override_officers]
    manual_rows = f" UNION ALL BY NAME SELECT * FROM {_values(manual, 'm(' + ', '.join(names) + ')')}" if manual else ""
    kept = f"name NOT IN {_in(p.excluded_owners)}" if p.excluded_owners else "name IS NOT NULL"
    accepted, counted = _in(p.accepted_stages), _in((p.lead_role, p.co_role))
    per_year = ", ".join(
        f"if(role = {_q(p.lead_role)} AND stage IN {accepted} AND close_date BETWEEN {a} AND {b}, amount, NULL) AS {fy_name(fy)}"
        for fy in p.report_fys for a, b in [_bounds(p, fy)])
    wide = _in(p.visit_types)
    person = f"""contactor_name IN {_in(p.visit_people or ('',))} AND (ActivityType IN {wide}
            OR Substantive_Activity = {_q(p.substantive_flag)}
            OR (ActivityType = {_q(p.prospect_activity_type)} AND Subject__c = {_q(p.substantive_subject)}))"""
    lead_asks = {"AccountID", "hh_name", "market", "do_id", "comb_fy", "ask_amt", "ask_date", "gift_amt", "gift_date",
                 "solicitor", "solicitor_level", "gift_name", "gift_unit", "source", "StageName", "lead_solicitor_ID",
                 "first_last", "last_first", "last_first_comma"}
    return [
        # people with every form of their name
        ("person", """SELECT id AS user_id, name, concat(first_name, ' ', last_name) AS first_last,
                concat(last_name, ' ', first_name) AS last_first, concat(last_name, ', ', first_name) AS last_first_comma,
                concat(upper(last_name), '/', upper(first_name)) AS sort_name FROM crm_user"""),
        ("name_key", f"""SELECT user_id AS do_id, first_last, last_first, team.name AS do_team, level AS do_level,
                last_first_comma, if(team.name IN {_in(p.count_all_teams)}, 'Y', NULL) AS count_all_flag
            FROM officer LEFT JOIN person USING (user_id) LEFT JOIN team ON team.id = officer.team_id{manual_rows}"""),
        # goals: every cell typed, what does not parse is NULL
        ("typed_goals", """SELECT last_first, TRY_CAST(COLUMNS('^(dollar|visit|ask)_goal_(lvl[345]|single)$') AS DOUBLE),
                TRY_CAST(goal_date AS DATE) AS goal_date, TRY_CAST(COLUMNS('^(goal_fy|discovery_visit_goal)$') AS INTEGER),
                TRY_CAST(dollar_goal__lvl4_fy17 AS DOUBLE) AS dollar_goal_lvl4_fy17,
                TRY_CAST(dollar_goal__lvl4_fy16 AS DOUBLE) AS dollar_goal_lvl4_fy16,
                TRY_CAST(dollar_goal__lvl4_fy15 AS DOUBLE) AS dollar_goal_lvl4_fy15 FROM goals_import"""),
        ("goals", """SELECT do_id, first_last, t.*, last_first_comma
            FROM typed_goals t LEFT JOIN name_key k ON k.last_first_comma = t.last_first
            """.replace("t.*", "t.*")),
        # opportunities with each team row
        ("opps", f"""SELECT owner_id AS OwnerID, ask_date, ask_amount AS ask_amt, amount AS gift_amt,
                close_date AS gift_date, m.name AS optm_name, role AS solicitor_level, o.name AS gift_name,
                division AS gift_unit, stage AS StageName, id AS OpportunityID, account_id AS AccountID,
                comment AS Comment, lead_solicitor_id AS lead_solicitor_ID, m.user_id AS optm_userID, {per_year}
            FROM opportunity_team m RIGHT JOIN opportunity o ON o.id = m.opportunity_id"""),
        # each filled contactor place of an activity whose owner counts
        ("own_acts", f"SELECT a.*, u.name AS owner_name FROM activity a, crm_user u WHERE u.id = a.owner_id AND u.{kept}"),
        ("places", """SELECT a.* EXCLUDE (contactor_1, contactor_2, contactor_3), place.n AS contactor_number,
                place.who AS contactor, (SELECT name FROM crm_user WHERE id = place.who) AS contactor_name
            FROM own_acts a, unnest([{'n': 'contactor_1', 'who': contactor_1}, {'n': 'contactor_2', 'who': contactor_2},
                {'n': 'contactor_3', 'who': contactor_3}]) AS u(place) WHERE place.who IS NOT NULL"""),
        ("links", """SELECT activity_id, list(contact_id) AS contacts, count(*) AS n_links FROM activity_contact GROUP BY ALL
            """.replace("GROUP BY ALL", "GROUP BY activity_id")),
        # a row stands on the list once per related contact, and once per link (at least once) for a who id
        ("counted", """SELECT places.*, if(who_id IS NULL, 0, greatest(coalesce(n_links, 0), 1)) + coalesce(len(contacts), 0) AS times
            FROM places LEFT JOIN links ON activity_id = id"""),
        ("visit_rows", f"""SELECT c.id AS activity_id, c.times, c.contactor, contactor_name, contactor_name AS visitor, activity_date AS visit_date,
                description AS visit_summ, account_id AS AccountID, status AS ActivityStatus, subject AS Subject__c,
                type AS ActivityType, substantive AS Substantive_Activity, {_fy('activity_date')} AS comb_fy,
                k.*, 'visits' AS source,
                (SELECT any_value(name) FROM account WHERE id = c.account_id) AS hh_name,
                (SELECT any_value(district) FROM account WHERE id = c.account_id) AS market
            FROM counted c LEFT JOIN name_key k ON k.do_id = owner_id WHERE activity_date BETWEEN {first} AND {last}"""),
        ("visits_counted", f"""SELECT * FROM visit_rows
            WHERE ActivityType IN {_in(p.plain_visit_types)} OR (ActivityType IN {wide} AND do_team = {_q(p.visit_team)})
               OR ({person})"""),
        ("visits", f"""SELECT {_on_list(p, {'AccountID', 'hh_name', 'market', 'do_id', 'comb_fy', 'visit_date', 'visit_summ',
                'visitor', 'source', 'ActivityStatus', 'first_last', 'last_first', 'last_first_comma', 'contactor',
                'contactor_name', 'Subject__c'})} FROM visits_counted, range(times)"""),
        # an ask counts if any rule of its lead's name, level or team admits its amount
        ("ask_rule", f"SELECT * FROM {_values(list(_ask_rules(p)), 'r(looks_at, wanted, least)')}"),
        ("lead_asks", f"""SELECT opps.*, k.*, first_last AS solicitor, 'qual_asks' AS source, {_fy('ask_date')} AS comb_fy,
                a.name AS hh_name, a.district AS market
            FROM opps LEFT JOIN account a ON a.id = AccountID JOIN name_key k ON k.do_id = opps.lead_solicitor_ID
            WHERE solicitor_level = {_q(p.lead_role)} AND ask_date BETWEEN {first} AND {last}
              AND EXISTS (FROM ask_rule WHERE wanted = CASE looks_at WHEN 'person' THEN first_last
                            WHEN 'level' THEN do_level ELSE do_team END AND (least IS NULL OR ask_amt >= least))"""),
        ("asks", f"SELECT {_on_list(p, lead_asks)} FROM lead_asks"),
        # dollars: equal rows of a gift, person and role count once
        ("credit_rows", f"""SELECT AccountID, a.name AS hh_name, a.district AS market, k.* EXCLUDE (do_team, do_level), ask_amt, ask_date,
                gift_amt, gift_date, solicitor_level, gift_name, gift_unit, StageName, lead_solicitor_ID,
                COLUMNS('^fy_.*_gift_amount$')
            FROM opps LEFT JOIN name_key k ON k.do_id = optm_userID LEFT JOIN account a ON a.id = AccountID
            WHERE solicitor_level IN {counted}
              AND (ask_date BETWEEN {first} AND {last} OR gift_date BETWEEN {first} AND {last})"""),
        ("dollars", f"""SELECT {_on_list(p, lead_asks | {fy_name(fy) for fy in p.report_fys})}
            FROM (SELECT DISTINCT *, first_last AS solicitor, 'all_asks' AS source, {_fy('gift_date')} AS comb_fy FROM credit_rows)"""),
        ("activity_list", "FROM visits UNION ALL FROM asks UNION ALL FROM dollars"),
    ]


def compose(p: Params, final: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = base_ctes(p) + (extra or [])
    body = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes)
    return f"WITH {body}\n{final}"
