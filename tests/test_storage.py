"""Stored layouts: bucketed bridges, lists clustered by account, trigram postings, mergeable distinct counts."""

import os

import pytest
from pyspark.sql import functions as F

from fundscope import params as P
from fundscope.operators import trigram
from fundscope.operators.distinct import distinct_bitmaps, distinct_counts, merged_bitmaps
from fundscope.operators.relational import flatten_by_key_sets, role_join, star_flatten
from fundscope.plans import activity as A
from fundscope.plans import audit as AU
from fundscope.plans import catalog
from fundscope.plans import checks as C
from fundscope.sources import crm_store

from .conftest import SF_SMALL

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def without_broadcast(spark):
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def store(spark, scratch):
    c = catalog.context(spark, SF_SMALL)
    return crm_store.store(c.crm, os.path.join(scratch, "bucketed"), "crm_cold", buckets=4), c


def test_bucketed_bridges_join_without_exchange(spark, store, without_broadcast):
    stored, c = store
    assert stored.hot == {}
    for build in (lambda x: A.opportunities(x, c.params), AU.proposal_wide):
        text = plan(build(stored))
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert text.count("FileScan parquet") == 2
    links = A.activities(stored, c.params)._jdf.queryExecution().executedPlan().toString()
    assert links.count("crm_cold.activity_contact") == 1


def test_stored_tables_give_the_same_rows(spark, store, scratch, without_broadcast):
    stored, c = store
    for build in (lambda x: A.opportunities(x, c.params), lambda x: A.activities(x, c.params),
                  lambda x: A.contacts_visits(x, c.params), AU.proposals, lambda x: AU.activity_contacts_audit(x, c.params)):
        assert rows(build(stored)) == rows(build(c.crm))
    spark.sql("DROP DATABASE crm_cold CASCADE")   # an application without a metastore
    again = crm_store.attach(spark, os.path.join(scratch, "bucketed"), "crm_cold")
    assert rows(AU.proposal_wide(again)) == rows(AU.proposal_wide(c.crm))
    assert "Exchange" not in plan(A.opportunities(again, c.params))


def test_hot_keys_are_counted_when_stored(spark, scratch, store):
    _, c = store
    one = c.crm.opportunity.orderBy("id").first()["id"]
    many = spark.range(3000).select(F.lit(one).alias("opportunity_id"), F.col("id").alias("user_id"),
                                    F.lit("x").alias("name"), F.lit(c.params.co_role).alias("role"))
    types = {f.name: f.dataType for f in c.crm.opportunity_team.schema}
    many = many.select(*[F.col(n).cast(t) for n, t in types.items()])
    hot_crm = type(c.crm)(**{n: getattr(c.crm, n) for n in type(c.crm).__dataclass_fields__}
                          | {"opportunity_team": c.crm.opportunity_team.unionByName(many)})
    stored = crm_store.store(hot_crm, os.path.join(scratch, "bucketed_hot"), "crm_hot", buckets=4, hot_rows=500)
    assert stored.hot == {"opportunity_team": [one]}
    got, want = A.opportunities(stored, c.params), A.opportunities(hot_crm, c.params)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


@pytest.fixture
def facts(spark):
    fact = spark.range(400).select(
        "id", F.when(F.col("id") % 11 != 0, F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"),
        (F.col("id") % 3).alias("c"), F.repeat(F.col("id").cast("string"), F.lit(50)).alias("payload"))
    # user 2 stands twice, user 4 has no name
    users = spark.sql("SELECT * FROM VALUES (0L, 'u0'), (1L, 'u1'), (2L, 'u2'), (2L, 'U2'), (4L, NULL), (6L, 'u6') AS t(k, name)")
    kinds = spark.sql("SELECT * FROM VALUES (0L, 'x'), (1L, 'y') AS t(k, kind)")
    return fact, [(users, "a", "k", {"name": "an"}), (users, "b", "k", {"name": "bn"}), (kinds, "c", "k", {"kind": "ck"})]


def test_key_sets_equal_joins_in_turn(facts):
    fact, dims = facts
    want = fact
    for dim, fact_key, dim_key, columns in dims:
        want = role_join(want, dim, fact_key, dim_key, columns)
    got = flatten_by_key_sets(fact, dims)
    assert got.columns == want.columns and rows(got) == rows(want) == rows(star_flatten(fact, dims))


def test_the_fact_passes_one_exchange(spark, facts, without_broadcast):
    def exchanges_of_facts(df, mark):
        text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        parts = [p for p in text.split("\n\n") if p.startswith("(") and ") Exchange" in p.splitlines()[0]]
        return sum(mark in p.split("Arguments:")[0] for p in parts)

    fact, dims = facts
    assert exchanges_of_facts(star_flatten(fact, dims), "payload") == 1
    c = catalog.context(spark, SF_SMALL)
    for build, mark in ((lambda: AU.tasks(c.crm), "gambit_key"), (lambda: AU.activity_audit(c.crm, c.params), "gambit_key")):
        assert exchanges_of_facts(build(), mark) == 1


def test_small_dimensions_do_not_move_the_fact(facts):
    fact, dims = facts
    text = plan(star_flatten(fact, dims))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_account_filter_reads_few_rows(spark, scratch):
    n, accounts = 120_000, 2000
    schema = A.activity_list_schema(catalog.context(spark, SF_SMALL).params)
    some = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(accounts)).alias("AccountID"), F.lit(1998).alias("comb_fy"),
                                 F.lit(P.SOURCE_DOLLARS).alias("source"), F.col("id").cast("string").alias("gift_name"))
    full = some.select(*[(F.col(f.name) if f.name in some.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schema.fields]).repartition(8)
    by_account, as_it_comes = os.path.join(scratch, "clustered"), os.path.join(scratch, "unclustered")
    A.write_activity_list(full, by_account)
    full.write.partitionBy("comb_fy").parquet(as_it_comes)

    def read(path):
        df = C.account_rows_list(spark.read.parquet(path), [7, 9])
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            found = len(df.collect())
            scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
            return found, scan.metrics().apply("numOutputRows").value()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")

    # the metric is of the plan that ran
    (found, read_rows), (all_found, all_rows) = read(by_account), read(as_it_comes)
    assert found == all_found > 0
    assert all_rows >= n // 2 and read_rows <= all_rows // 2


@pytest.mark.parametrize("fragment", ["ann", "an", "a", "Ann Lee", "zzz", "", "ee", "nn Le", "éa"])
def test_trigram_search_equals_contains(spark, scratch, fragment):
    names = ["Ann Lee", "Joann Leeds", "Bo", "a", "", None, "Hanna", "Ann Lee", "éaé", "ANN LEE"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    want = rows(C.name_search(df, "name", fragment))
    assert rows(trigram.search(df, "name", trigram.postings(df, "name"), fragment)) == want
    path = os.path.join(scratch, "postings")
    if not os.path.exists(path):
        trigram.write_postings(df, "name", path)
    stored = spark.read.parquet(path)
    assert rows(trigram.search(df, "name", stored, fragment)) == want
    if len(fragment) >= 3:
        assert "PushedFilters: [" in plan(trigram.candidates(stored, fragment)) and "gram" in plan(trigram.candidates(stored, fragment))


def test_distinct_counts_add_up(spark, scratch):
    df = spark.range(5000).select((F.col("id") % 3 + 1996).alias("fy"), (F.col("id") % 2).alias("who"),
                                  F.when(F.col("id") % 13 != 0, F.col("id") * 7 % 90_000 - 100).alias("n"))
    df = df.unionByName(df.where("fy = 1996").withColumn("fy", F.lit(1997).cast("long")))
    path = os.path.join(scratch, "bitmaps")
    distinct_bitmaps(df, ["fy", "who"], "n").write.partitionBy("fy").parquet(path)
    stored = spark.read.parquet(path)
    want = df.groupBy("fy", "who").agg(F.countDistinct("n").alias("c"))
    assert rows(distinct_counts(stored, ["fy", "who"], "c").select(F.col("fy").cast("long"), "who", "c")) == rows(want)
    # several years together are not the sum of the years
    years = stored.where("fy < 1998")
    both = df.where("fy < 1998").groupBy("who").agg(F.countDistinct("n").alias("c"))
    assert rows(distinct_counts(years, ["who"], "c")) == rows(both)
    assert rows(distinct_counts(merged_bitmaps(stored, ["who"]), ["who"], "c")) == rows(df.groupBy("who").agg(F.countDistinct("n").alias("c")))
    empty = spark.createDataFrame([], "who long, n long")
    assert distinct_counts(distinct_bitmaps(empty, ["who"], "n"), ["who"], "c").count() == 0
