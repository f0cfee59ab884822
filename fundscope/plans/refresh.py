"""The weekly refresh: every dashboard dataset from one set of CRM tables.

A deployment reads its CRM copy (one Parquet folder per table, in the
schema of :class:`fundscope.sources.standins.Crm`), computes each dataset
once and writes it into a new version (:mod:`fundscope.sources.versions`).
The activity list is written by fiscal year, only the years whose content has
changed, and the scorecard reads it back from there (one computation, partition
pruning for the FY readers) instead of re-deriving it.

The row checks are observed during the writes (:mod:`.gate`).  Their report is
written in any case; if a check that holds is broken, the version is not
published and readers keep the last one.  Otherwise one commit switches all
datasets, and the catalog's views follow.

    python -m fundscope.plans.refresh <crm_folder> <out_folder> [current_fy [goals_csv]]
"""

from __future__ import annotations

import datetime as _dt
import sys
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Params
from ..sources.goals import GOALS_SCHEMA, correct_names, rejected_cells
from ..sources.standins import Crm, collated
from ..sources.tables import checked_text_csv
from ..sources.versions import Versions, register
from . import activity as A
from . import audit as AU
from . import dimensions as D
from . import gate as G
from . import scorecard as SC
from . import top_gifts as TG

DATABASE = "dashboards"


@dataclass
class Outcome:
    """What a refresh did: the version, whether it was published, and the checks."""

    version: int
    published: bool
    broken: list[str]
    datasets: list[str]
    report: str


def read_crm(spark: SparkSession, folder: str) -> Crm:
    """CRM tables stored as ``<folder>/<table>`` Parquet folders."""
    return Crm(**{n: spark.read.parquet(f"{folder.rstrip('/')}/{n}")
                  for n in Crm.__dataclass_fields__})


def last_report(spark: SparkSession, out: str, version: int) -> dict[str, float]:
    """``dataset.check`` -> value in the report of a version."""
    rows = spark.read.schema(f"{G.REPORT}, version int").parquet(f"{out}/reports").where(F.col("version") == version)
    return {f"{r['dataset']}.{r['check']}": r["value"] for r in rows.collect()}


def refresh(spark: SparkSession, crm: Crm, params: Params, out: str,
            goals_csv: str | None = None, corrections: DataFrame | None = None,
            limits: dict[str, G.Limit] | None = None, as_of: _dt.date | None = None,
            database: str | None = DATABASE) -> Outcome:
    """Write every dataset under ``out`` as one version and publish it as views
    of ``database`` (None: no catalog).

    ``goals_csv`` is the spreadsheet export to use instead of an imported
    table, ``corrections`` its manual renames (``old_name``, ``new_name``);
    what was blank or did not parse is written as ``goal_rejects``, whole rows
    that are malformed as ``goal_rejected_rows``.  ``limits`` replaces the
    checks' limits (:data:`.gate.LIMITS`)."""
    out = out.rstrip("/")
    versions = Versions(spark, out)
    latest = versions.latest()
    draft = versions.draft()
    asked = G.metrics(params, as_of)

    def save(name: str, df: DataFrame) -> DataFrame:
        return draft.save(name, df, asked.get(name))

    crm = collated(crm, params.collation)
    raw = crm.goals_import
    if goals_csv is not None:
        raw, malformed = checked_text_csv(spark, goals_csv, [src for _, src, _ in GOALS_SCHEMA])
        save("goal_rejected_rows", malformed)
    if corrections is not None:
        raw = correct_names(raw, corrections)
    crm = replace(crm, goals_import=raw)
    save("goal_rejects", rejected_cells(raw))

    key = save("do_name_key", D.name_key(crm, params))
    goals = save("do_goals", D.goals(crm, key))

    full = A.activity_list(crm, key, params)
    draft.save_partitioned("activity_list", full, "comb_fy", asked["activity_list"], A.CLUSTER)
    # every roll-up filters one FY on the date its branch's comb_fy is
    # derived from, so the scorecard reads that partition only
    al = A.stored_list(draft.read("activity_list"), params, fy=params.current_fy)

    save("do_indiv_summ", SC.scorecard(al, key, goals, params))
    save("top_gifts", TG.top_gifts_merged(crm, params))
    save("comb_hh_capacities", D.capacity_tiers(crm, params))
    save("comb_hh_gusy", D.household(crm))
    save("qry_contacts", A.contacts_visits(crm, params))
    save("qry_proposal", AU.proposals(crm))
    save("task_audit", AU.tasks(crm))
    save("activity_audit", AU.activity_audit(crm, params))
    save("activity_contacts_audit", AU.activity_contacts_audit(crm, params))
    save("proposal_wide", AU.proposal_wide(crm))
    save("prospects", AU.prospects(crm))

    before = last_report(spark, out, latest) if latest is not None else {}
    rows = G.judged(draft.metrics, before, G.LIMITS if limits is None else limits)
    broken = G.held_back(rows)
    # the report of a version that is held back stays beside the published ones
    report = f"{out}/{'held_reports' if broken else 'reports'}/version={draft.number}"
    G.report_frame(spark, rows).coalesce(1).write.mode("overwrite").parquet(report)
    datasets = sorted({p.dataset for p in draft.parts})
    if broken:
        draft.discard()
        return Outcome(draft.number, False, broken, datasets, report)
    draft.commit()
    if database:
        register(spark, out, database)
    return Outcome(draft.number, True, broken, datasets, report)


def main(argv: list[str]) -> int:
    crm_folder, out = argv[1], argv[2]
    params = Params(current_fy=int(argv[3])) if len(argv) > 3 else Params()
    spark = SparkSession.builder.appName("fundscope-refresh").getOrCreate()
    goals_csv = argv[4] if len(argv) > 4 else None
    done = refresh(spark, read_crm(spark, crm_folder), params, out, goals_csv)
    print("version", done.version, "published" if done.published else f"held back by {', '.join(done.broken)}")
    print("report", done.report)
    for name in done.datasets if done.published else []:
        print(f"{DATABASE}.{name}")
    return 0 if done.published else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
