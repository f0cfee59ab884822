"""Qualification rules compiled from data into first-match ``when`` chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Params
from .names import text


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def visit_qualifies(activity_type, team, contactor_name, subject, substantive,
                    params: Params) -> Column:
    """A visit counts when it is a plain visit, or the officer's team has the
    wider visit rule and the type is a visit or assist, or the contactor is
    one of the named people and the activity is a visit, assist, a prospect
    activity with the substantive subject, or flagged substantive."""
    coll = params.collation
    t = text(activity_type, coll)
    cond = t.isin(list(params.plain_visit_types))
    cond = cond | ((text(team, coll) == F.lit(params.visit_team)) & t.isin(list(params.visit_types)))
    if params.visit_people:
        wide = (t.isin(list(params.visit_types))
                | ((t == F.lit(params.prospect_activity_type))
                   & (text(subject, coll) == F.lit(params.substantive_subject)))
                | (text(substantive, coll) == F.lit(params.substantive_flag)))
        cond = cond | (text(contactor_name, coll).isin(list(params.visit_people)) & wide)
    # NULLs in any test make the OR unknown -> the row is not kept
    return F.coalesce(cond, F.lit(False))


def visit_candidate(activity_type, subject, substantive, params: Params) -> Column:
    """A necessary condition of :func:`visit_qualifies` that reads only the
    activity's own columns.  Applied before the activities are multiplied by
    contactors and contact links (and before the joins that bring the team
    and contactor name), it drops rows that can never qualify; Catalyst
    cannot infer it because the full rule also reads joined columns."""
    coll = params.collation
    t = text(activity_type, coll)
    cond = t.isin(list(params.plain_visit_types) + list(params.visit_types))
    if params.visit_people:
        cond = (cond
                | ((t == F.lit(params.prospect_activity_type))
                   & (text(subject, coll) == F.lit(params.substantive_subject)))
                | (text(substantive, coll) == F.lit(params.substantive_flag)))
    return F.coalesce(cond, F.lit(False))


def threshold_ladder(name, level, team, amount, params: Params) -> Column:
    """'Y' / 'N' by the first rule that matches, in this order: named person,
    level without minimum, team without minimum, team with minimum, level
    with minimum.  A NULL amount never passes a minimum."""
    coll = params.collation
    name, level, team = (text(c, coll) for c in (name, level, team))
    amount = _col(amount)
    steps: list[Column] = []
    if params.always_count_people:
        steps.append(name.isin(list(params.always_count_people)))
    if params.ask_levels_always:
        steps.append(level.isin(list(params.ask_levels_always)))
    if params.ask_teams_always:
        steps.append(team.isin(list(params.ask_teams_always)))
    for t, minimum in params.ask_team_minimums:
        steps.append((team == F.lit(t)) & (amount >= F.lit(minimum)))
    for lv, minimum in params.ask_level_minimums:
        steps.append((level == F.lit(lv)) & (amount >= F.lit(minimum)))
    expr = None
    for cond in steps:
        expr = F.when(cond, F.lit("Y")) if expr is None else expr.when(cond, F.lit("Y"))
    return F.lit("N") if expr is None else expr.otherwise(F.lit("N"))
