"""The refresh job over stored CRM tables: equal to the registered queries,
published in one step, by fiscal year, and held back by its checks."""

import csv
import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fundscope.plans import catalog, gate, refresh
from fundscope.sources.standins import Crm
from fundscope.sources.versions import Versions, register

from .conftest import SF_SMALL

DATASETS = {
    "do_name_key": "name_key", "do_goals": "goals_import", "goal_rejects": "goal_rejects",
    "activity_list": "activity_list", "do_indiv_summ": "scorecard", "top_gifts": "top_gifts_merged",
    "comb_hh_capacities": "capacity_tier", "comb_hh_gusy": "household_label",
    "qry_contacts": "contactors_unpivot", "qry_proposal": "proposals", "task_audit": "task_audit",
    "activity_audit": "activity_audit", "activity_contacts_audit": "activity_contacts_audit",
    "proposal_wide": "proposal_wide", "prospects": "prospects"}


@pytest.fixture(scope="module")
def stored(spark, scratch):
    """The stand-in CRM copy as stored tables, and its parameters."""
    c = catalog.context(spark, SF_SMALL)
    crm_dir = os.path.join(scratch, "crm_copy")
    for name in Crm.__dataclass_fields__:
        getattr(c.crm, name).write.parquet(f"{crm_dir}/{name}")
    return refresh.read_crm(spark, crm_dir), c.params


@pytest.fixture(scope="module")
def published(spark, scratch, stored):
    """The first version, from the spreadsheet's goals, in the catalog; the tests below build on it in their order."""
    crm, params = stored
    # the goals come in another column order, with one name to correct
    rows = [r.asDict() for r in crm.goals_import.collect()]
    fixes = spark.createDataFrame([("Wrong, Name", rows[0]["last_first"])], "old_name string, new_name string")
    wrong = [dict(r, last_first="Wrong, Name") if r["last_first"] == rows[0]["last_first"] else r for r in rows]
    path = os.path.join(scratch, "goals_export.csv")
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, sorted(rows[0], reverse=True) + ["remark"])
        w.writeheader()
        w.writerows(dict(r, remark="two\nlines") for r in wrong)
    out = os.path.join(scratch, "dashboards")
    more = dict(goals_csv=path, corrections=fixes, as_of=catalog.AS_OF)

    def run(crm=crm, **extra):
        return refresh.refresh(spark, crm, params, out, **{**more, "database": None, **extra})

    return run, out, run(database="weekly")


def same(got, want):
    got = got.select(want.columns)
    return got.count() == want.count() and got.exceptAll(want).count() == 0


def list_files(out):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/activity_list/**/part-*", recursive=True)}


def test_a_second_session_reads_every_dataset_by_name(spark, stored, published):
    _, out, done = published
    assert done.published and done.version == 1
    assert set(done.datasets) == {*DATASETS, "goal_rejected_rows"}
    other = spark.newSession()
    q = catalog.queries()
    for name, query in DATASETS.items():
        got, want = other.table(f"weekly.{name}"), q[query](other, SF_SMALL)
        if name == "goal_rejects":   # an empty CSV cell is a NULL, not a blank text
            got, want = got.drop("blank_cells"), want.drop("blank_cells")
        assert sorted(got.columns) == sorted(want.columns), name
        assert same(got, want), name
    assert other.table("weekly.goal_rejected_rows").count() == 0
    one = other.table("weekly.activity_list").where(F.col("comb_fy") == stored[1].current_fy)
    assert "comb_fy" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    # an application without a metastore of its own registers the folder
    spark.sql("DROP DATABASE weekly CASCADE")
    assert len(register(spark, out, "weekly")) == 16
    assert spark.newSession().table("weekly.do_indiv_summ").count() == q["scorecard"](spark, SF_SMALL).count()


def test_observed_checks_equal_the_check_queries(spark, published):
    _, out, done = published
    seen = {f"{r['dataset']}.{r['check']}": r["value"] for r in spark.read.parquet(done.report).collect()}
    q = catalog.queries()
    n = lambda name: q[name](spark, SF_SMALL).count()
    assert seen["activity_list.low_amounts"] == n("qa_low_amount")
    assert seen["activity_list.future_asks"] == n("qa_future_asks")
    assert seen["do_goals.unmatched_goals"] == n("qa_unmatched_goals")
    assert seen["activity_list.visits"] == n("visits_qualified")
    assert seen["goal_rejects.rejected_cells"] == sum(r["rejected_cells"] for r in q["goal_rejects"](spark, SF_SMALL).collect())
    v = Versions(spark, out)
    audit = v.read("activity_audit")
    assert seen["activity_audit.owner_mismatch"] == audit.where("OwnerID <> Contactor").count()
    assert seen["activity_audit.null_status"] == audit.where("ActivityStatus IS NULL").count()
    for name in DATASETS:
        assert seen[f"{name}.rows"] == v.read(name).count(), name


def test_only_the_changed_year_is_written(spark, stored, published):
    crm, params = stored
    run, out, _ = published
    first, v = list_files(out), Versions(spark, out)
    # one gift of FY1996, asked and closed in that year, gets another name
    in_year = [F.col(c).between("1995-07-01", "1996-06-30") for c in ("ask_date", "close_date")]
    team = crm.opportunity_team.where(F.col("role") == params.lead_role).select("opportunity_id")
    one = crm.opportunity.where(in_year[0] & in_year[1]).join(team, F.col("id") == F.col("opportunity_id"), "left_semi")
    gift = one.orderBy("id").first()["id"]
    renamed = crm.opportunity.withColumn("name", F.when(F.col("id") == gift, F.lit("renamed")).otherwise(F.col("name")))
    changed = replace(crm, opportunity=renamed)
    assert run(changed).published
    after = list_files(out)
    assert {f: t for f, t in after.items() if f in first} == first
    new = set(after) - set(first)
    assert new and all("/comb_fy=1996/" in f for f in new)
    # datasets that the gift is not part of keep their files, too
    assert {p.path for p in v.parts(1) if p.dataset == "task_audit"} == {p.path for p in v.parts(2) if p.dataset == "task_audit"}
    # the result is that of a full computation
    key = refresh.D.name_key(changed, params)
    assert same(v.read("activity_list"), refresh.A.activity_list(changed, key, params))
    assert same(v.read("proposal_wide"), refresh.AU.proposal_wide(changed))
    assert v.read("activity_list").where("gift_name = 'renamed'").count() > 0
    assert v.read("activity_list", 1).where("gift_name = 'renamed'").count() == 0


def test_a_refresh_that_breaks_half_way_leaves_the_old_set(spark, stored, published, monkeypatch):
    run, out, _ = published
    v = Versions(spark, out)
    before = {n: v.read(n).count() for n in DATASETS}
    latest = v.latest()
    monkeypatch.setattr(refresh.AU, "proposals", lambda crm: crm.opportunity.select(F.raise_error(F.lit("disk is full")).alias("x")))
    with pytest.raises(Exception, match="disk is full"):
        run(replace(stored[0], opportunity=stored[0].opportunity.where("id % 2 = 0")), limits={})
    assert v.latest() == latest
    assert {n: v.read(n).count() for n in DATASETS} == before


def test_bad_rows_hold_the_new_version_back(spark, stored, published):
    crm, _ = stored
    run, out, _ = published
    v = Versions(spark, out)
    rows, latest = v.read("activity_list").count(), v.latest()
    bad = replace(crm, activity=crm.activity.where("id % 20 = 0"), opportunity=crm.opportunity.where("id % 20 = 0"))
    done = run(bad)
    assert not done.published and done.broken == ["activity_list.rows"]
    assert v.latest() == latest and v.read("activity_list").count() == rows
    report = {(r["dataset"], r["check"]): r for r in spark.read.parquet(done.report).collect()}
    r = report["activity_list", "rows"]
    assert not r["passed"] and r["holds"] and r["previous"] == rows and r["rule"] == "at least 0.5 x before"
    # the same rows pass where the limits allow them, under the number that stayed free
    done = run(bad, limits={})
    assert done.published and v.latest() == latest + 1 == done.version
    # versions that nobody needs any more go with the files that only they name
    shared = {p.path for p in v.parts()}
    gone = v.retire(keep=1)
    assert gone and not set(gone) & shared and v.numbers() == [done.version]
    assert all(not os.path.exists(p) for p in gone) and all(os.path.exists(p) for p in shared)
    assert 0 < v.read("activity_list").count() < rows


@pytest.mark.parametrize("limit,value,before,passed", [
    (gate.Limit(most=3), 3, None, True), (gate.Limit(most=3), 4, None, False),
    (gate.Limit(grow=2), 9, None, True), (gate.Limit(grow=2), 9, 4, False), (gate.Limit(grow=2), 8, 4, True),
    (gate.Limit(shrink=0.5), 1, 4, False), (gate.Limit(shrink=0.5), 2, 4, True),
    (gate.Limit(like="b.x", apart=0.1), 95, None, True), (gate.Limit(like="b.x", apart=0.1), 80, None, False),
    (gate.Limit(like="b.missing"), 1, None, False)])
def test_limits(limit, value, before, passed):
    rows = gate.judged({"a": {"x": value}, "b": {"x": 100}}, {} if before is None else {"a.x": before}, {"a.x": limit})
    assert [r[5] for r in rows] == [passed, True]
    assert gate.held_back(rows) == ([] if passed else ["a.x"])
