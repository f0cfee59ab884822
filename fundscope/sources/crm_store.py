"""The CRM copy as bucketed tables, with the hot keys of its bridges counted once.

Facts and bridges that are joined on one key (activity and its contact links,
opportunity and its team) are stored in the same number of buckets of that key,
sorted by it, one file a bucket.  A join on the key then needs no exchange, and
reads each side once.  Keys with so many bridge rows that a bucket would be
one long task are counted while the tables are stored and kept beside them, so
no query looks for them again.

``store`` writes the tables and their catalog entries; a session without a
persistent metastore calls ``attach`` on the folder.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .standins import Crm

#: Table -> the key that its joins share.
BUCKET_KEYS = {"activity": "id", "activity_contact": "activity_id",
               "opportunity": "id", "opportunity_team": "opportunity_id"}
#: Bridges whose hot keys are counted.
BRIDGES = ("activity_contact", "opportunity_team")
LAYOUT = "table string, bucket_key string, buckets int, schema string"
HOT = "table string, key string, n_rows long"


@dataclass
class StoredCrm(Crm):
    """CRM tables read from storage, with the hot keys of the bridges (at most
    ``most_hot`` each, chosen when they were stored)."""

    hot: dict[str, list] = field(default_factory=dict)


def hot_keys(crm: Crm, bridge: str) -> list | None:
    """The hot keys of a bridge, or None where nobody has counted them."""
    return crm.hot.get(bridge, []) if isinstance(crm, StoredCrm) else None


def _entry(spark: SparkSession, database: str, name: str, schema: T.StructType, key: str | None,
           buckets: int, path: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS " if key else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet {by}LOCATION '{path}'")


def store(crm: Crm, folder: str, database: str = "crm", buckets: int = 200, hot_rows: int = 1_000_000,
          most_hot: int = 1000) -> StoredCrm:
    """Write every table under ``folder`` and read them back as catalog tables;
    each copy has a folder and a database of its own.

    ``buckets`` is the largest table's bytes over some 128 MB, so that a bucket
    is one task's work.  A bridge key with more than ``hot_rows`` rows is hot;
    any key beyond the ``most_hot`` largest holds at most that share of the
    bridge."""
    spark = crm.account.sparkSession
    folder = folder.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    layout = []
    for name in Crm.__dataclass_fields__:
        df: DataFrame = getattr(crm, name)
        key, path = BUCKET_KEYS.get(name), f"{folder}/{name}"
        if key:
            # the exchange deals rows as buckets do: one file each
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
            writer.option("path", path).format("parquet").saveAsTable(f"`{database}`.`{name}`")
        else:
            df.write.parquet(path)
            _entry(spark, database, name, df.schema, None, 0, path)
        layout.append((name, key, buckets if key else 0, df.schema.json()))
    counts = None
    for name in BRIDGES:
        key = BUCKET_KEYS[name]
        n = spark.table(f"`{database}`.`{name}`").groupBy(F.col(key).cast("string").alias("key"))
        n = n.agg(F.count(F.lit(1)).alias("n_rows")).where(f"key IS NOT NULL AND n_rows > {hot_rows}")
        n = n.orderBy(F.desc("n_rows"), "key").limit(most_hot).select(F.lit(name).alias("table"), "key", "n_rows")
        counts = n if counts is None else counts.unionByName(n)
    counts.coalesce(1).write.parquet(f"{folder}/hot_keys")
    # the layout comes last: a folder without it is not a whole copy
    spark.createDataFrame(layout, LAYOUT).coalesce(1).write.parquet(f"{folder}/layout")
    return read(spark, folder, database)


def attach(spark: SparkSession, folder: str, database: str = "crm") -> StoredCrm:
    """Catalog entries (with their buckets) for a stored copy, in a session that has none."""
    folder = folder.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for r in spark.read.schema(LAYOUT).parquet(f"{folder}/layout").collect():
        schema = T.StructType.fromJson(json.loads(r["schema"]))
        _entry(spark, database, r["table"], schema, r["bucket_key"], r["buckets"], f"{folder}/{r['table']}")
    return read(spark, folder, database)


def read(spark: SparkSession, folder: str, database: str = "crm") -> StoredCrm:
    """The stored tables by their catalog names, with the counted hot keys."""
    tables = {n: spark.table(f"`{database}`.`{n}`") for n in Crm.__dataclass_fields__}
    hot: dict[str, list] = {}
    for r in spark.read.schema(HOT).parquet(f"{folder.rstrip('/')}/hot_keys").collect():  # at most most_hot a bridge
        kind = tables[r["table"]].schema[BUCKET_KEYS[r["table"]]].dataType
        hot.setdefault(r["table"], []).append(r["key"] if isinstance(kind, T.StringType) else int(r["key"]))
    return StoredCrm(**tables, hot=hot)
