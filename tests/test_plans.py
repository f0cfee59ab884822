"""Dashboard datasets on hand-made CRM tables (FIXTURES.md §4 cases)."""

import datetime as dt
from decimal import Decimal

from fundscope.params import Params
from fundscope.plans import activity as A
from fundscope.plans import dimensions as D
from fundscope.plans import scorecard as SC
from fundscope.plans import top_gifts as TG
from fundscope.sources.goals import rejected_cells

from .minicrm import crm

P = Params(current_fy=2018)


def _acc(i, capacity=None, status="Active", name=None):
    return {"id": i, "name": name or f"acc{i}", "district": "d", "status": status, "capacity": capacity}


def test_capacity_rollup_edges(spark):
    c = crm(spark,
            account=[_acc(1, Decimal("500.00")), _acc(2, Decimal("20000000.00")), _acc(3), _acc(4),
                     _acc(5, status="Closed")],
            rating=[{"account_id": 1, "record_type_id": "G", "segment": "$1,000,000 to $4,999,999"},
                    {"account_id": 1, "record_type_id": "G", "segment": "$25,000 to $49,999"},
                    {"account_id": 3, "record_type_id": "X", "segment": "$10 million or more"},
                    {"account_id": 5, "record_type_id": "G", "segment": "$10 million or more"}],
            record_type=[("G", "GGA"), ("X", "Other")])
    out = {r.Account_ID: (r.comb_capacity_range, r.comb_capacity_source)
           for r in D.capacity_tiers(c, P).collect()}
    # codes 3 and 5 on one account: max keeps 5 (the lower tier)
    assert out[1] == ("5 Special Gift Prospect ($25K-$100K)", "GG+A")
    assert out[2] == ("1 Transformative Prospect ($10M+)", "GU Research")
    assert 3 not in out                       # only a rating of another type
    assert out[4] == ("No Capacity Assigned", None)   # no rating at all
    assert 5 not in out                       # not active


def test_household_needs_first_label(spark):
    c = crm(spark, account=[_acc(1), _acc(2), _acc(3), _acc(4)],
            contact=[{"id": 10, "account_id": 1, "label": "A  ", "is_primary": "Yes"},
                     {"id": 11, "account_id": 1, "label": "B ", "is_primary": "No"},
                     {"id": 20, "account_id": 2, "label": "A", "is_primary": "Yes"},
                     {"id": 21, "account_id": 2, "label": None, "is_primary": "No"},
                     {"id": 30, "account_id": 3, "label": None, "is_primary": "Yes"},
                     {"id": 31, "account_id": 3, "label": "B", "is_primary": "No"},
                     {"id": 90, "account_id": 9, "label": "Z", "is_primary": "Yes"}])
    out = {r.AccountID: r.comb_gusy for r in D.household(c).collect()}
    assert out == {1: "A & B", 2: "A"}


def _officer_world(spark, goals_rows=()):
    users = [{"id": 1, "name": "Ann Lee", "first_name": "Ann", "last_name": "Lee"},
             {"id": 2, "name": "Bob Kay", "first_name": "Bob", "last_name": "Kay"},
             {"id": 3, "name": None, "first_name": "Cy", "last_name": "Noe"}]
    return dict(user=users,
                officer=[{"user_id": 1, "team_id": 1, "level": "DOD"},
                         {"user_id": 2, "team_id": 2, "level": "DA"}],
                team=[(1, "GULC"), (2, "Other")],
                goals_import=list(goals_rows))


def _goal(last_first, fy, lvl4="6", single="0"):
    return {"last_first": last_first, "dollar_goal_lvl3": "1", "dollar_goal_lvl4": lvl4,
            "dollar_goal_lvl5": "100", "dollar_goal_single": single, "goal_fy": str(fy),
            "goal_date": f"{fy - 1}-07-01", "discovery_visit_goal": "x"}


def test_name_key_override_and_flags(spark):
    p = P.with_(override_officers=({"do_id": 9, "first_last": "Zed Q", "last_first": "Q Zed",
                                    "do_team": "Planned Giving", "do_level": "DOD",
                                    "last_first_comma": "Q, Zed", "count_all_flag": "Y"},))
    c = crm(spark, **_officer_world(spark))
    rows = {r.do_id: r for r in D.name_key(c, p).collect()}
    assert rows[1].first_last == "Ann Lee" and rows[1].count_all_flag == "Y"
    assert rows[2].count_all_flag is None and rows[2].last_first_comma == "Kay, Bob"
    assert rows[9].do_team == "Planned Giving"


def test_goals_typed_two_years_and_blank(spark):
    w = _officer_world(spark, [_goal("Lee, Ann", 2018, single=""), _goal("Lee, Ann", 2017),
                               _goal("Nobody, X", 2018)])
    c = crm(spark, **w)
    g = D.goals(c, D.name_key(c, P))
    rows = g.collect()
    assert len(rows) == 3
    ann18 = [r for r in rows if r.do_id == 1 and r.goal_fy == 2018][0]
    assert ann18.dollar_goal_single is None and ann18.dollar_goal_lvl4 == 6.0
    assert ann18.goal_date == dt.date(2017, 7, 1) and ann18.discovery_visit_goal is None
    assert D.goals_for_fy(g, 2018).where("do_id = 1").count() == 1
    rej = {r.column_name: (r.blank_cells, r.rejected_cells) for r in rejected_cells(c.goals_import).collect()}
    assert rej["dollar_goal_single"] == (1, 0)
    assert rej["discovery_visit_goal"] == (0, 3)


def _opp(i, acct, amount, close, lead=1, stage="Accepted", ask=None, ask_date=None, name="g"):
    return {"id": i, "owner_id": lead, "account_id": acct, "lead_solicitor_id": lead,
            "ask_date": ask_date or close, "ask_amount": ask, "amount": Decimal(amount),
            "close_date": close, "name": name, "division": "u", "stage": stage}


def test_dollars_dedup_collapses_equal_gifts(spark):
    d = dt.date(2018, 1, 5)
    w = _officer_world(spark)
    w.update(account=[_acc(1)],
             opportunity=[_opp(1, 1, "5.00", d), _opp(2, 1, "5.00", d), _opp(3, 1, "7.00", d)],
             opportunity_team=[(1, 1, "Ann Lee", "Lead Solicitor"), (2, 1, "Ann Lee", "Lead Solicitor"),
                               (3, 1, "Ann Lee", "Lead Solicitor"), (3, 2, "Bob Kay", "Secondary Solicitor"),
                               (3, 3, None, "Team Member")])
    c = crm(spark, **w)
    key = D.name_key(c, P)
    rows = A.dollars(c, key, P).collect()
    assert len(rows) == 3   # opportunities 1 and 2 are equal but for the id: one row
    assert sorted((r.solicitor_level, r.gift_amt) for r in rows) == [
        ("Lead Solicitor", Decimal("5.00")), ("Lead Solicitor", Decimal("7.00")),
        ("Secondary Solicitor", Decimal("7.00"))]


def test_scorecard_drops_officer_without_visits(spark):
    d = dt.date(2018, 1, 5)
    w = _officer_world(spark, [_goal("Lee, Ann", 2018), _goal("Kay, Bob", 2018)])
    w.update(account=[_acc(1)],
             opportunity=[_opp(1, 1, "5.00", d, lead=2)],
             opportunity_team=[(1, 2, "Bob Kay", "Lead Solicitor")],
             activity=[{"id": 1, "owner_id": 1, "contactor_1": 1, "type": "Visit",
                        "activity_date": d, "account_id": 1, "who_id": 77}])
    c = crm(spark, **w)
    key = D.name_key(c, P)
    al = A.activity_list(c, key, P)
    goals = D.goals(c, key)
    sc = {r.do_id: r for r in SC.scorecard(al, key, goals, P).collect()}
    assert set(sc) == {1}                      # Bob has dollars but no visits
    assert sc[1].visits == 1 and sc[1].credited_dollars is None
    every = {r.do_id for r in SC.scorecard(al, key, goals, P, drive="all").collect()}
    assert every == {1, 2}


def test_top_gifts_merge_and_labels(spark):
    d = dt.date(2018, 1, 5)
    w = _officer_world(spark)
    w.update(account=[_acc(1), _acc(2)],
             opportunity=[_opp(1, 1, "9.00", d, lead=1), _opp(2, 1, "9.00", d, lead=1),
                          _opp(3, 2, "4.00", d, lead=None), _opp(4, 2, "1.00", d, lead=2,
                                                                  stage="Cultivation")])
    c = crm(spark, **w)
    tg = TG.top_gifts(c, P).collect()
    assert [r.opportunity_ID for r in tg] == [1, 2, 3]
    labelled = TG.top_gifts_labelled(c, P).collect()
    assert {(r.AccountID, r.solicitor) for r in labelled} == {(1, "Ann Lee"), (2, "No Lead Solicitor Entered")}
    merged = {(r.AccountID, r.gift_amt) for r in TG.top_gifts_merged(c, P).collect()}
    assert merged == {(1, Decimal("18.00")), (2, Decimal("4.00"))}  # equal rows, amount doubled
    assert TG.top_gifts(c, P, n=2).count() == 2


def test_visits_drop_unnamed_and_excluded_owner(spark):
    d = dt.date(2018, 1, 5)
    w = _officer_world(spark)
    p = P.with_(excluded_owners=("Bob Kay",))
    acts = [{"id": i, "owner_id": o, "contactor_1": o, "contactor_2": None, "type": "Visit",
             "activity_date": d, "account_id": 1, "who_id": 100 + i} for i, o in [(1, 1), (2, 2), (3, 3)]]
    w.update(account=[_acc(1)], activity=acts, activity_contact=[(1, 500), (1, 501)])
    c = crm(spark, **w)
    rows = A.visits(c, D.name_key(c, p), p).collect()
    # activity 1: one contactor x two link rows x (who_id, link) = 4 rows (the who_id repeats
    # on every link row, as in the double unpivot); owners 2 (excluded) and 3 (no name) drop
    assert len(rows) == 4 and {r.visitor for r in rows} == {"Ann Lee"}


def test_dollars_rollup_duplicate_officer_row_counts_twice(spark):
    # a manual name-key row identical to an existing officer: the row-wise
    # form sums every activity row once per matching officer row, and so
    # must the aggregate-first form
    d = dt.date(2018, 1, 5)
    dup = {"do_id": 1, "first_last": "Ann Lee", "last_first": "Lee Ann", "do_team": "GULC",
           "do_level": "DOD", "last_first_comma": "Lee, Ann", "count_all_flag": "Y"}
    p = P.with_(override_officers=(dup,))
    w = _officer_world(spark, [_goal("Lee, Ann", 2018)])
    w.update(account=[_acc(1)],
             opportunity=[_opp(1, 1, "5.00", d), _opp(2, 1, "7.00", d)],
             opportunity_team=[(1, 1, "Ann Lee", "Lead Solicitor"), (2, 1, "Ann Lee", "Secondary Solicitor")])
    c = crm(spark, **w)
    key = D.name_key(c, p)
    al = A.activity_list(c, key, p)
    out = SC.dollars_rollup(al, key, D.goals(c, key), p).collect()
    # two name-key rows, and two goal rows (goals match the name key by
    # 'Last, First'): every activity row counts 2 x 2 times
    assert len(out) == 1
    assert out[0].lead_dollars == Decimal("20.00") and out[0].co_dollars == Decimal("28.00")


def test_more_than_one_lead_on_itself(spark):
    """QA9 finds an opportunity id that carries two rows with one lead."""
    from fundscope.plans import checks

    tables = crm(spark, opportunity=[{"id": 1, "lead_solicitor_id": 5}, {"id": 1, "lead_solicitor_id": 5},
                                             {"id": 2, "lead_solicitor_id": 5}, {"id": 3}, {"id": 3}])
    rows = checks.multi_lead_self(tables).collect()
    assert [(r["Id"], r["Lead_Solicitor"], r["count_lead_sol"]) for r in rows] == [(1, 5, 2)]


def test_best_tier_of_several_ratings(spark):
    from fundscope.params import Params
    from fundscope.plans.dimensions import capacity_tiers

    p = Params()
    texts = sorted(p.segment_codes, key=lambda t: p.segment_codes[t])
    tables = crm(
        spark, account=[{"id": 1, "status": p.active_status}], record_type=[{"id": "G", "name": p.rating_record_types[0]}],
        rating=[{"account_id": 1, "record_type_id": "G", "segment": t} for t in (texts[0], texts[-1], "unknown")])
    label = lambda prefer: capacity_tiers(tables, p, prefer).first()["comb_capacity_range"]
    from fundscope import params as P
    assert label("best") == P.TIER_LABELS[p.segment_codes[texts[0]]]
    assert label("lowest") == P.TIER_LABELS[p.segment_codes[texts[-1]]]


def test_collation_reaches_every_comparison(spark):
    """Mixed case and trailing blanks: nothing matches byte by byte, all of it under the collation."""
    import datetime as dt
    from decimal import Decimal

    from fundscope import params as P
    from fundscope.params import Params
    from fundscope.plans import activity as A
    from fundscope.plans import dimensions as D
    from fundscope.plans import scorecard as SC
    from fundscope.plans import top_gifts as TG
    from fundscope.sources.standins import collated

    p = Params(current_fy=2018, collation="UTF8_LCASE_RTRIM")
    day = dt.date(2018, 1, 1)
    seg = next(iter(p.segment_codes))
    raw = crm(
        spark,
        account=[{"id": 1, "name": "Acme", "status": p.active_status.upper() + " "}],
        user=[{"id": 5, "name": "ann lee ", "first_name": "Ann", "last_name": "Lee"}],
        officer=[{"user_id": 5, "team_id": 1, "level": "x"}], team=[{"id": 1, "name": p.count_all_teams[0].lower() + " "}],
        opportunity=[{"id": 9, "account_id": 1, "lead_solicitor_id": 5, "owner_id": 5, "amount": Decimal("50.00"),
                      "ask_amount": Decimal("60.00"), "ask_date": day, "close_date": day, "stage": "accepted "}],
        opportunity_team=[{"opportunity_id": 9, "user_id": 5, "name": "Ann Lee", "role": p.lead_role.lower() + " "}],
        record_type=[{"id": "G", "name": p.rating_record_types[0].upper()}],
        rating=[{"account_id": 1, "record_type_id": "g ", "segment": seg.upper() + " "}],
        goals_import=[{"last_first": "LEE, ANN ", "goal_fy": "2018", "dollar_goal_lvl3": "5"}])
    found = []
    for tables, params in ((raw, Params(current_fy=2018)), (collated(raw, p.collation), p)):
        key = D.name_key(tables, params)
        goals = D.goals(tables, key)
        dollars = A.activity_list(tables, key, params).where("source = 'all_asks'")
        paid = A.opportunities(tables, params).first()["fy_18_gift_amount"]
        roll = SC.dollars_rollup(A.activity_list(tables, key, params), key, goals, params).collect()
        found.append((key.first()["count_all_flag"], goals.first()["do_id"], paid, dollars.count(),
                      [r["lead_dollars"] for r in roll], TG.top_gifts(tables, params).count(),
                      [r["comb_capacity_source"] for r in D.capacity_tiers(tables, params).collect()]))
    assert found[0][:6] == (None, None, None, 0, [], 0) and found[0][6] == []
    assert found[1] == ("Y", 5, Decimal("50.00"), 1, [Decimal("50.00")], 1, [P.SOURCE_VENDOR])


def _namesakes(spark):
    """Two officers called Ann Lee (1 and 5) and one Bob Kay (2)."""
    w = _officer_world(spark)
    w["user"] = w["user"] + [{"id": 5, "name": "Ann Lee", "first_name": "Ann", "last_name": "Lee"}]
    w["officer"] = w["officer"] + [{"user_id": 5, "team_id": 1, "level": "DOD"}]
    gifts = [{"id": 100 + i, "owner_id": who, "account_id": 7, "lead_solicitor_id": who, "ask_date": dt.date(2018, 1, 5),
              "ask_amount": Decimal("900000.00"), "amount": Decimal(f"{amount}.00"), "close_date": dt.date(2018, 2, 5),
              "name": f"g{i}", "stage": P.accepted_stages[0]} for i, (who, amount) in enumerate([(1, 10), (5, 200), (2, 3000)])]
    team = [{"opportunity_id": g["id"], "user_id": g["lead_solicitor_id"], "name": "x", "role": P.lead_role} for g in gifts]
    acts = [{"id": 200 + i, "owner_id": who, "contactor_1": who, "type": "Visit", "activity_date": dt.date(2018, 3, 1),
             "substantive": "Yes", "account_id": 7, "who_id": 1} for i, who in enumerate([1, 5, 5, 2])]
    return crm(spark, **w, account=[_acc(7)], opportunity=gifts, opportunity_team=team, activity=acts)


def test_officers_of_one_name_are_told_apart_by_id(spark):
    c = _namesakes(spark)
    key = D.name_key(c, P)
    al = A.activity_list(c, key, P)
    goals = D.goals(c, key)
    dollars = lambda match: {r.do_id: r.lead_dollars for r in SC.dollars_rollup(al, key, goals, P, match=match).collect()}
    # by name each of the two gets everything under the name, as the dashboard does
    assert dollars("name") == {1: Decimal(210), 5: Decimal(210), 2: Decimal(3000)}
    assert dollars("resolved") == {1: Decimal(10), 5: Decimal(200), 2: Decimal(3000)}
    visits = lambda match: {r.do_id: r.visits for r in SC.visits_rollup(al, key, P, match=match).collect()}
    assert visits("name") == {1: 3, 5: 3, 2: 1}
    assert visits("resolved") == {1: 1, 5: 2, 2: 1}
    assert visits("resolved") == {r.do_id: r.visits for r in SC.visits_rollup(A.counted_visits(c, key, P), key, P, match="resolved").collect()}
    asks = {r.do_id: r.asks for r in SC.asks_rollup(al, key, P, match="resolved").collect()}
    assert asks == {1: 1, 5: 1, 2: 1}
    card = SC.scorecard(al, key, goals, P, match="resolved").collect()
    assert {(r.do_id, r.visits, r.asks, r.lead_dollars) for r in card} == {
        (1, 1, 1, Decimal(10)), (5, 2, 1, Decimal(200)), (2, 1, 1, Decimal(3000))}
    assert sum(r.lead_dollars for r in card) == Decimal(3210)
