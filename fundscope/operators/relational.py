"""Relational building blocks: unpivot, aligned unions, star flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unpivot_non_null(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                     name_col: str, value_col: str) -> DataFrame:
    """Columns to rows, one row per non-NULL cell, the source column name in
    ``name_col``.  ``DataFrame.unpivot`` keeps NULL cells, so they are
    filtered right after; the plan is an ``Expand`` plus a filter inside one
    codegen stage, no shuffle."""
    return (df.unpivot(list(ids), list(cols), name_col, value_col)
            .where(F.col(value_col).isNotNull()))


def align_union(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """UNION ALL of several sources on one explicit schema: each frame is
    projected onto the schema's columns in order, missing columns become
    typed NULLs and present ones are cast.  Narrow: no shuffle."""
    out = None
    for f in frames:
        have = set(f.columns)
        cols = [(F.col(fld.name) if fld.name in have else F.lit(None)).cast(fld.dataType).alias(fld.name)
                for fld in schema.fields]
        proj = f.select(*cols)
        out = proj if out is None else out.unionByName(proj)
    return out


def role_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
              columns: dict[str, str], how: str = "left") -> DataFrame:
    """Join one dimension on one key and bring ``columns`` (dim column ->
    output name).  Used several times on the same dimension for role-played
    keys (creator, modifier, owner).  No hint: the planner broadcasts a
    stored dimension under its threshold, and AQE one that turns out so."""
    d = dim.select(F.col(dim_key).alias("__k"), *[F.col(c).alias(a) for c, a in columns.items()])
    return fact.join(d, fact[fact_key] == d["__k"], how).drop("__k")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner, from the sizes it knows without running a job,
    takes ``df`` for small enough to broadcast."""
    spark = df.sparkSession
    most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def star_flatten(fact: DataFrame, dims) -> DataFrame:
    """A fact with several dimensions: ``dims`` is a list of
    ``(dimension, fact_key, dim_key, {dim column: output name})``, joined left
    (the same dimension may appear under several keys, e.g. creator / modifier
    / owner).

    Dimensions that fit a broadcast are joined one after the other: the fact is
    not moved at all.  Where more than one does not fit, joining them in turn
    would shuffle the whole fact once for each; instead the distinct key
    combinations (:func:`flatten_by_key_sets`) carry the joins."""
    dims = list(dims)
    if sum(not fits_broadcast(dim) for dim, *_ in dims) > 1:
        return flatten_by_key_sets(fact, dims)
    out = fact
    for dim, fact_key, dim_key, columns in dims:
        out = role_join(out, dim, fact_key, dim_key, columns)
    return out


def flatten_by_key_sets(fact: DataFrame, dims) -> DataFrame:
    """As :func:`star_flatten`, with one exchange of the fact.

    The distinct combinations of the fact's keys (narrow rows, combined
    map-side, far fewer than facts: people log many records each) are joined
    to each dimension in turn, and the fact meets the named combinations once,
    on all keys, where NULL equals NULL.  A dimension row that repeats its key
    repeats the combination and so the facts, as a plain join does.  A hot
    combination sits on the preserved side, which AQE's skew join splits."""
    keys = list(dict.fromkeys(fact_key for _, fact_key, _, _ in dims))
    named = fact.select(*keys).distinct()
    for dim, fact_key, dim_key, columns in dims:
        named = role_join(named, dim, fact_key, dim_key, columns)
    named = named.withColumnsRenamed({k: f"__set_{i}" for i, k in enumerate(keys)})
    on = None
    for i, k in enumerate(keys):
        equal = fact[k].eqNullSafe(named[f"__set_{i}"])
        on = equal if on is None else on & equal
    return fact.join(named, on, "left").drop(*[f"__set_{i}" for i in range(len(keys))])


# the keys with most bridge rows that are split (any other key holds at most
# this share of all bridge rows), and the bridge rows of a part
HOT_KEYS = 1000
PART_ROWS = 1_000_000


def bridge_left_join(left: DataFrame, bridge: DataFrame, left_key: str, bridge_key: str,
                     hot_keys: int = HOT_KEYS, part_rows: int = PART_ROWS,
                     known_hot: Sequence | None = None) -> DataFrame:
    """``left LEFT JOIN bridge ON left_key = bridge_key`` that reads ``left``
    once and survives a hot key on the bridge side (one activity with a
    third of all contact links, one opportunity with a third of all team
    rows).

    AQE splits a skewed partition of an outer join only on the preserved
    (left) side, so hot bridge keys are split here: the keys with more than
    ``part_rows`` bridge rows, at most ``hot_keys`` of them (a broadcast of
    that many rows), get several parts; their bridge rows are dealt to the
    parts by hash and their left rows are repeated once per part.  A
    repeated left row that meets no bridge row in its part is dropped: its
    key has bridge rows in another.  Column names of the two inputs must not
    overlap.

    ``known_hot`` lists the hot keys where storage has counted them
    (:mod:`fundscope.sources.crm_store`): the bridge is not read to find them,
    and tables bucketed on the key are joined without an exchange.  Only the
    rows of hot keys, if there are any, take the way through parts."""
    if known_hot is not None:
        hot_row = F.col(bridge_key).isin(list(known_hot)) if known_hot else F.lit(False)
        plain = left.join(bridge.where(F.coalesce(~hot_row, F.lit(True))) if known_hot else bridge,
                          F.col(left_key) == F.col(bridge_key), "left")
        if not known_hot:
            return plain.select(*left.columns, *bridge.columns)
        hot_left = F.coalesce(F.col(left_key).isin(list(known_hot)), F.lit(False))
        split = bridge_left_join(left.where(hot_left), bridge.where(hot_row), left_key, bridge_key, hot_keys, part_rows)
        return plain.where(~hot_left).select(*left.columns, *bridge.columns).unionByName(split)
    counts = bridge.groupBy(F.col(bridge_key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    hot = (counts.where(F.col("__hot").isNotNull() & (F.col("__n") > part_rows))
           .orderBy(F.col("__n").desc(), "__hot").limit(hot_keys)
           .select("__hot", F.ceil(F.col("__n") / F.lit(part_rows)).cast("int").alias("__parts")))

    def with_parts(df: DataFrame, key: str) -> DataFrame:
        j = df.join(F.broadcast(hot), df[key] == hot["__hot"], "left")
        return j.drop("__hot").withColumn("__parts", F.coalesce("__parts", F.lit(1)))

    dealt = F.pmod(F.xxhash64(*bridge.columns, F.spark_partition_id()), F.col("__parts")).cast("int")
    right = with_parts(bridge, bridge_key).select(*bridge.columns, dealt.alias("__bridge_part"),
                                                  F.lit(True).alias("__met"))
    spread = with_parts(left, left_key).withColumn(
        "__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    j = spread.join(right, (spread[left_key] == right[bridge_key])
                    & (spread["__part"] == right["__bridge_part"]), "left")
    j = j.where((F.col("__parts") == 1) | F.col("__met"))
    return j.select(*left.columns, *bridge.columns)
