"""Typing of the imported goals spreadsheet (all text in, typed out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# output column -> (input column, SQL type); order is the output order
GOALS_SCHEMA = [
    ("last_first", "last_first", "string"),
    ("dollar_goal_lvl3", "dollar_goal_lvl3", "double"),
    ("dollar_goal_lvl4", "dollar_goal_lvl4", "double"),
    ("dollar_goal_lvl5", "dollar_goal_lvl5", "double"),
    ("dollar_goal_single", "dollar_goal_single", "double"),
    ("visit_goal_lvl3", "visit_goal_lvl3", "double"),
    ("visit_goal_lvl4", "visit_goal_lvl4", "double"),
    ("visit_goal_lvl5", "visit_goal_lvl5", "double"),
    ("visit_goal_single", "visit_goal_single", "double"),
    ("ask_goal_lvl3", "ask_goal_lvl3", "double"),
    ("ask_goal_lvl4", "ask_goal_lvl4", "double"),
    ("ask_goal_lvl5", "ask_goal_lvl5", "double"),
    ("ask_goal_single", "ask_goal_single", "double"),
    ("goal_date", "goal_date", "date"),
    ("goal_fy", "goal_fy", "int"),
    ("discovery_visit_goal", "discovery_visit_goal", "int"),
    ("dollar_goal_lvl4_fy17", "dollar_goal__lvl4_fy17", "double"),
    ("dollar_goal_lvl4_fy16", "dollar_goal__lvl4_fy16", "double"),
    ("dollar_goal_lvl4_fy15", "dollar_goal__lvl4_fy15", "double"),
]


def typed_import(raw: DataFrame, schema=GOALS_SCHEMA) -> DataFrame:
    """Cast every text cell to its type.  Blank or unparsable cells become
    NULL (``try_cast``) instead of 0 / 1900-01-01 or an error; text columns
    are kept whole (no 30-character cut)."""
    cols = []
    for out, src, typ in schema:
        c = F.col(src)
        cols.append((c if typ == "string" else c.try_cast(typ)).alias(out))
    return raw.select(*cols)


def rejected_cells(raw: DataFrame, schema=GOALS_SCHEMA) -> DataFrame:
    """Per column: how many cells were blank and how many had text that did
    not parse.  One pass, one global aggregate (partial per task)."""
    aggs = []
    for out, src, typ in schema:
        if typ == "string":
            continue
        c = F.col(src)
        blank = c.isNotNull() & (F.trim(c) == "")
        bad = c.isNotNull() & (F.trim(c) != "") & c.try_cast(typ).isNull()
        aggs.append(F.count(F.when(blank, 1)).alias(f"{out}__blank"))
        aggs.append(F.count(F.when(bad, 1)).alias(f"{out}__rejected"))
    wide = raw.agg(*aggs)
    stack = ", ".join(
        f"'{out}', `{out}__blank`, `{out}__rejected`" for out, _, typ in schema if typ != "string")
    n = sum(1 for _, _, typ in schema if typ != "string")
    return wide.selectExpr(f"stack({n}, {stack}) as (column_name, blank_cells, rejected_cells)")


def correct_names(raw: DataFrame, corrections: DataFrame, column: str = "last_first") -> DataFrame:
    """Apply a correction table (``old_name``, ``new_name``) to the name
    column of the imported goals before matching them to officers: the
    manual renames of the spreadsheet kept as data, not code.  The table is
    joined, not broadcast by hint; the planner sizes it."""
    fix = corrections.select(F.col("old_name").alias("__old"), F.col("new_name").alias("__new"))
    j = raw.join(fix, raw[column] == fix["__old"], "left")
    return j.select(*[F.coalesce(F.col("__new"), F.col(c)).alias(c) if c == column else F.col(c)
                      for c in raw.columns])
