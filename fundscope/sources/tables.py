"""Scans: Parquet tables, the all-text goals CSV and literal rows."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """``spark.read`` of one table under ``base`` (``<base>/<name>.parquet``
    for the test data).  Projections and filters applied later are pushed
    into the scan by Catalyst (``ReadSchema`` / ``PushedFilters``)."""
    path = os.path.join(base, f"{name}.{fmt}") if fmt == "parquet" else os.path.join(base, name)
    return spark.read.format(fmt).load(path)


def read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A spreadsheet export read with every column as text (no inference),
    as the import into the database did; typing happens in
    :func:`fundscope.sources.goals.typed_import`.

    Columns are taken by their names in the file's header, in any order;
    further columns are ignored, and a missing one is an error.  A row that
    is too short has NULLs in the places it lacks."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    return raw.select(*[F.col(f"`{c}`") for c in columns])


CORRUPT = "_corrupt_record"


def checked_text_csv(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """A spreadsheet export as (rows, rejected rows), every column as text.

    Columns are taken by their header names, in any order.  Cells may hold line
    breaks within quotes.  A row with more or fewer cells than the header is
    rejected whole: its text stands in ``row_text`` beside ``reason``, and it is
    not among the rows.  A row without any value is no row.  A quote that is
    never closed takes the rest of its file into one cell, so its row is
    rejected unless that was the last one.  A missing column is an error."""
    header = spark.read.option("header", True).option("multiLine", True).csv(path).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    read = (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("escape", '"'))
    raw = read.csv(path)
    whole = [F.col(f"`{c}`") for c in header]
    # a rejected row is told by its text; all columns are asked for, so none is pruned before the cells are counted
    filled = sum((c.isNotNull().cast("int") for c in whole), F.lit(0))
    rows = raw.where(F.col(CORRUPT).isNull() & (filled > 0)).select(*[F.col(f"`{c}`") for c in columns])
    reason = F.when(filled < len(header), "too few cells").otherwise("too many cells")
    rejected = raw.where(F.col(CORRUPT).isNotNull() & (filled >= 0)).select(F.col(CORRUPT).alias("row_text"), reason.alias("reason"))
    return rows, rejected


def literal_rows(spark: SparkSession, rows: list[dict], schema: T.StructType | str) -> DataFrame:
    """A small literal relation (``SELECT 'a' AS x, ...`` without FROM)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
