"""Exact distinct counts that can be stored and added up.

``countDistinct`` of several years is not the sum of the years' counts.  A set
of integer ids as bitmaps is exact and can be merged: the id space is cut into
buckets of 32,768 ids, and a bucket's ids are the bits of one small bitmap
(Spark's ``bitmap_construct_agg``, combined map-side).  Bitmaps kept per year
give the count of any years by ``bitmap_or_agg``, without reading the facts.

A group's bitmaps are rows, one per bucket, so no task ever holds a whole
group; a hot group has at most (largest id / 32,768) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "id_bucket", "id_bits"


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``keys``, ``id_bucket``, ``id_bits``: the distinct ids of each group.
    NULL ids are left out, as ``countDistinct`` does; ids are integers."""
    i = F.col(id_col).cast("long")
    rows = df.where(i.isNotNull()).select(*keys, F.bitmap_bucket_number(i).alias(BUCKET), F.bitmap_bit_position(i).alias("__bit"))
    return rows.groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg("__bit").alias(BITS))


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for coarser ``keys``: the union of the groups' ids."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many distinct ids each group of ``keys`` has."""
    n = F.sum(F.bitmap_count(BITS)).cast("long").alias(name)
    return merged_bitmaps(bitmaps, keys).groupBy(*keys).agg(n)
