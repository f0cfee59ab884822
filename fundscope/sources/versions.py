"""A set of datasets in versions: written beside each other, switched by one commit.

Layout under ``out``::

    <dataset>/version=<token>/[<partition>=<value>/]*.parquet
    commits/version=<n>/*.parquet         one row per dataset or partition

A :class:`Draft` writes its datasets into folders of its own and touches no
file that an earlier version reads.  Its commit is one more file in the log,
which a file system shows whole or not at all; until then, and if the draft
breaks off, readers see the last version complete.  A partition whose content
is unchanged is not written again: the new version names the old files.

:func:`register` puts the current version into the catalog: a table over the
files, and a view per dataset that picks the newest committed version when it
is read.  Adding the log's new partition is the last statement, so the views of
all datasets change together.  A session with a persistent metastore sees them
at once; one without calls ``register`` on the folder.

There is one writer at a time (the weekly job); of two drafts that commit the
same number, the second fails.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = ("dataset string, partition_column string, partition_value string, path string, n_rows long, "
       "digest string, schema string")


@dataclass(frozen=True)
class Part:
    """The files of one dataset, or of one of its partitions."""

    dataset: str
    partition_column: str | None
    partition_value: str | None     # None: the dataset is whole, or the NULL partition
    path: str
    n_rows: int
    digest: str
    schema: str

    @property
    def same_as(self) -> tuple:
        return self.n_rows, self.digest, self.schema


def digest(columns: list[str]) -> Column:
    """A number for the rows of a group, whatever their order: the sum of their hashes."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def bloom(columns: Sequence[str]) -> dict[str, str]:
    """Parquet options: a Bloom filter per row group for each column that is looked up by value."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _remove(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


class Versions:
    """Reads the committed versions under ``out``."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")

    def log(self) -> DataFrame | None:
        """All commits: the rows of :data:`LOG` with their ``version``."""
        fs, at = _folder(self.spark, f"{self.out}/commits")
        if not fs.exists(at):
            return None
        return self.spark.read.schema(f"{LOG}, version int").parquet(f"{self.out}/commits")

    def numbers(self) -> list[int]:
        log = self.log()
        return [] if log is None else sorted(r["version"] for r in log.select("version").distinct().collect())

    def latest(self) -> int | None:
        return max(self.numbers(), default=None)

    def parts(self, version: int | None = None) -> list[Part]:
        """The parts of a version (default: the newest): datasets x partitions rows."""
        version = self.latest() if version is None else version
        if version is None:
            return []
        rows = self.log().where(F.col("version") == version).drop("version").collect()
        return [Part(**r.asDict()) for r in rows]

    def read(self, dataset: str, version: int | None = None) -> DataFrame:
        """One dataset of one version; a filter on its partition column prunes files."""
        parts = [p for p in self.parts(version) if p.dataset == dataset]
        if not parts:
            raise ValueError(f"{self.out}: no committed version of {dataset}")
        return read_parts(self.spark, self.out, parts)

    def draft(self) -> Draft:
        return Draft(self)

    def retire(self, keep: int = 2) -> list[str]:
        """Delete the files that none of the newest ``keep`` versions names, and the older commits."""
        numbers = self.numbers()
        kept, old = numbers[-keep:], numbers[:-keep]
        named = {p.path for n in kept for p in self.parts(n)}
        gone = sorted({p.path for n in old for p in self.parts(n)} - named)
        # the commits go first: a reader never finds a version without its files
        for n in old:
            _remove(self.spark, f"{self.out}/commits/version={n}")
        for path in gone:
            _remove(self.spark, path)
        return gone


def read_parts(spark: SparkSession, out: str, parts: list[Part]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(parts[0].schema))
    base = f"{out}/{parts[0].dataset}"
    full = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    df = spark.read.schema(full).option("basePath", base).parquet(*[p.path for p in parts])
    return df.select(*schema.names)


class Draft:
    """A version in the making."""

    def __init__(self, versions: Versions):
        self.versions, self.spark, self.out = versions, versions.spark, versions.out
        self.number = (versions.latest() or 0) + 1
        self.token = f"{self.number}-{uuid.uuid4().hex[:8]}"
        self.before = {(p.dataset, p.partition_column, p.partition_value): p for p in versions.parts()}
        self.parts: list[Part] = []
        self.written: set[str] = set()
        self.metrics: dict[str, dict[str, float]] = {}

    def _previous(self, part: Part) -> Part | None:
        old = self.before.get((part.dataset, part.partition_column, part.partition_value))
        return old if old and old.same_as == part.same_as else None

    def _add(self, part: Part) -> None:
        self.parts.append(self._previous(part) or part)

    def save(self, dataset: str, df: DataFrame, metrics: dict[str, Column] | None = None) -> DataFrame:
        """Write a whole dataset and return it as stored.  Row count, digest and
        the given metrics (sums and counts over its rows) are observed during
        the write; an unchanged dataset keeps its old files."""
        path = f"{self.out}/{dataset}/version={self.token}"
        seen = Observation(f"{dataset}-{self.token}")
        df.observe(seen, F.count(F.lit(1)).alias("__rows"), digest(df.columns).alias("__digest"),
                   *[c.alias(n) for n, c in (metrics or {}).items()]).write.parquet(path)
        got = seen.get
        rows, mark = got.pop("__rows"), str(got.pop("__digest"))
        self.metrics[dataset] = {"rows": rows, **{k: float(v or 0) for k, v in got.items()}}
        part = Part(dataset, None, None, path, rows, mark, df.schema.json())
        if self._previous(part):
            _remove(self.spark, path)
        else:
            self.written.add(path)
        self._add(part)
        return self.read(dataset)

    def save_partitioned(self, dataset: str, df: DataFrame, column: str,
                         metrics: dict[str, Column] | None = None,
                         cluster_by: tuple[str, ...] = ()) -> DataFrame:
        """Write the partitions of ``column`` whose content has changed.

        One pass over ``df`` takes each partition's row count, digest and
        metrics; only partitions that differ from the last version's are
        computed again and written.  ``cluster_by`` orders the rows within a
        partition, so that a filter on its first column reads few row groups;
        the further columns spread a hot value over files."""
        extra = metrics or {}
        seen = df.groupBy(column).agg(F.count(F.lit(1)).alias("__rows"), digest(df.columns).alias("__digest"),
                                      *[c.alias(f"__{n}") for n, c in extra.items()]).collect()
        self.metrics[dataset] = {"rows": sum(r["__rows"] for r in seen)}
        self.metrics[dataset] |= {n: sum(float(r[f"__{n}"] or 0) for r in seen) for n in extra}
        root = f"{self.out}/{dataset}/version={self.token}"
        changed = []
        for r in seen:
            value = None if r[column] is None else str(r[column])
            folder = f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            part = Part(dataset, column, value, f"{root}/{folder}", r["__rows"], str(r["__digest"]), df.schema.json())
            if not self._previous(part):
                changed.append(r[column])
                self.written.add(part.path)
            self._add(part)
        if changed:
            there = F.col(column).isin([v for v in changed if v is not None])
            rows = df.where(there | F.col(column).isNull() if None in changed else there)
            if cluster_by:
                rows = rows.repartitionByRange(column, *cluster_by).sortWithinPartitions(column, *cluster_by)
            rows.write.partitionBy(column).options(**bloom(cluster_by[:1])).parquet(root)
        elif not seen:   # no rows: the folder alone keeps the schema
            df.drop(column).write.parquet(root)
            self.written.add(root)
            self._add(Part(dataset, column, None, root, 0, "None", df.schema.json()))
        return self.read(dataset)

    def read(self, dataset: str) -> DataFrame:
        return read_parts(self.spark, self.out, [p for p in self.parts if p.dataset == dataset])

    def carry(self) -> None:
        """Take over from the last version every dataset that this draft has not saved."""
        own = {p.dataset for p in self.parts}
        self.parts += [p for p in self.before.values() if p.dataset not in own]

    def commit(self) -> int:
        """Make this the current version: one new file in the log."""
        rows = [tuple(getattr(p, f) for f in Part.__dataclass_fields__) for p in self.parts]
        log = self.spark.createDataFrame(rows, LOG).coalesce(1)
        log.write.mode("errorifexists").parquet(f"{self.out}/commits/version={self.number}")
        return self.number

    def discard(self) -> None:
        """Delete what this draft wrote."""
        for path in sorted(self.written):
            _remove(self.spark, path)


def materialise(df: DataFrame, out: str, dataset: str, partition_by: str | None = None,
                cluster_by: tuple[str, ...] = ()) -> int:
    """``SELECT ... INTO`` with drop-if-exists: the dataset's next version.

    The set's other datasets stay as they are, readers see the old rows until
    the new ones are whole, and with ``partition_by`` only changed partitions
    are written.  Returns the version's number."""
    draft = Versions(df.sparkSession, out).draft()
    if partition_by:
        draft.save_partitioned(dataset, df, partition_by, cluster_by=cluster_by)
    else:
        draft.save(dataset, df)
    draft.carry()
    return draft.commit()


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _table(spark: SparkSession, name: str, schema: T.StructType, partitions: list[str], location: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{c}`" for c in partitions)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION {_quoted(location)}")


def register(spark: SparkSession, out: str, database: str = "dashboards") -> list[str]:
    """Catalog tables and views of the current version; returns the view names.

    ``<database>.<dataset>`` reads the version that is committed when the view
    is read.  Every session of the metastore sees it; without one, call this in
    each application."""
    versions = Versions(spark, out)
    number = versions.latest()
    if number is None:
        raise ValueError(f"{out}: no committed version")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    parts = versions.parts(number)
    names = sorted({p.dataset for p in parts})
    log = f"`{database}`.`published_versions`"
    log_schema = T.StructType.fromDDL(f"{LOG}, version int")
    _table(spark, log, log_schema, ["version"], f"{versions.out}/commits")
    for name in names:
        own = [p for p in parts if p.dataset == name]
        schema = T.StructType.fromJson(json.loads(own[0].schema))
        column = own[0].partition_column
        # a table per schema: sessions that have read the old one are not left with its columns
        files = f"`{database}`.`{name}_files_{hashlib.sha256(own[0].schema.encode()).hexdigest()[:8]}`"
        full = T.StructType([*[f for f in schema if f.name != column], T.StructField("version", T.IntegerType()),
                             *[f for f in schema if f.name == column]])
        _table(spark, files, full, ["version"] + ([column] if column else []), f"{versions.out}/{name}")
        for p in own:
            if column and not p.n_rows:
                continue
            value = ", `{}` = {}".format(column, "null" if p.partition_value is None else _quoted(p.partition_value)) if column else ""
            spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS PARTITION (version = {number}{value}) "
                      f"LOCATION {_quoted(p.path)}")
        columns = ", ".join(f"`{c}`" for c in schema.names)
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {columns} FROM {files} "
                  f"WHERE version = (SELECT max(version) FROM {log})")
    # the switch: all views follow the newest version of the log
    spark.sql(f"ALTER TABLE {log} ADD IF NOT EXISTS PARTITION (version = {number}) "
              f"LOCATION {_quoted(f'{versions.out}/commits/version={number}')}")
    return [f"{database}.{n}" for n in names]
