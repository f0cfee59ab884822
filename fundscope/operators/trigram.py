"""Search for a fragment of a name through stored trigram postings.

``LIKE '%fragment%'`` reads every row.  The postings list, for each run of
three characters, the distinct values that hold it; a value that holds the
fragment holds all the fragment's trigrams, so it is among the values listed
under each of them.  Those candidates are verified with ``contains``, and the
rows are then found by equality with the values that passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3


def postings(df: DataFrame, column: str) -> DataFrame:
    """``gram``, ``value``: each distinct value under its distinct trigrams,
    and values shorter than a trigram under themselves.  Sorted by gram when
    stored, a search reads few row groups (:func:`write_postings`)."""
    v = F.col("value")
    grams = F.transform(F.sequence(F.lit(1), F.length(v) - (GRAM - 1)), lambda i: F.substring(v, i, F.lit(GRAM)))
    grams = F.when(F.length(v) < GRAM, F.array(v)).otherwise(grams)
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    return values.select(F.explode(F.array_distinct(grams)).alias("gram"), "value")


def write_postings(df: DataFrame, column: str, path: str) -> None:
    """Store the postings in the order of their grams.  A hot gram (a common
    ending) is spread over several files, since values sort within it."""
    rows = postings(df, column)
    (rows.repartitionByRange("gram", "value").sortWithinPartitions("gram", "value")
     .write.mode("errorifexists").parquet(path))


def candidates(stored: DataFrame, fragment: str) -> DataFrame:
    """The values that hold ``fragment`` (``value``), from postings alone.

    A fragment shorter than a trigram has none of its own: values are found
    under every gram that holds it."""
    if len(fragment) < GRAM:
        some = stored.where(F.col("gram").contains(fragment)).select("value").distinct()
    else:
        grams = sorted({fragment[i:i + GRAM] for i in range(len(fragment) - GRAM + 1)})
        some = (stored.where(F.col("gram").isin(grams)).groupBy("value")
                .agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") == len(grams)).select("value"))
    return some.where(F.col("value").contains(fragment))


def search(df: DataFrame, column: str, stored: DataFrame, fragment: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` holds ``fragment``."""
    found = candidates(stored, fragment)
    return df.join(found, df[column] == found["value"], "left_semi")
