"""DataFrame operators on tiny frames."""

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.operators import (align_union, credited_dollars, effective_goal, first_two,
                                 goal_level, household_label, owner_label, role_dollars, top_n,
                                 unpivot_non_null)


def test_unpivot_drops_null_cells(spark):
    df = spark.createDataFrame([(1, 10, None, 30)], "id int, c1 int, c2 int, c3 int")
    out = unpivot_non_null(df, ["id"], ["c1", "c2", "c3"], "n", "v").collect()
    assert sorted((r.n, r.v) for r in out) == [("c1", 10), ("c3", 30)]


def test_second_unpivot_without_links(spark):
    df = spark.createDataFrame([(1, 10, 11, None, None)], "id int, c1 int, c2 int, w int, rc int")
    a = unpivot_non_null(df, ["id", "w", "rc"], ["c1", "c2"], "n", "v")
    b = unpivot_non_null(a, ["id", "n", "v"], ["w", "rc"], "rn", "contact")
    assert a.count() == 2 and b.count() == 0


def test_align_union_types_and_count(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                           T.StructField("c", T.DecimalType(18, 2))])
    x = spark.createDataFrame([(1, "x")], "a int, b string")
    y = spark.createDataFrame([(2.5,), (3.0,)], "c double")
    u = align_union([x, y], schema)
    assert u.schema == schema
    assert u.count() == x.count() + y.count()


def test_role_dollars_sum_to_total(spark):
    rows = [("a", "Lead Solicitor", Decimal("5")), ("a", "Secondary Solicitor", Decimal("3")),
            ("b", "Lead Solicitor", Decimal("0")), ("c", "Lead Solicitor", None)]
    df = spark.createDataFrame(rows, "s string, r string, amt decimal(18,2)")
    out = {r.s: (r.lead_dollars, r.co_dollars) for r in role_dollars(df, ["s"], "r", "amt").collect()}
    assert out == {"a": (Decimal("5.00"), Decimal("3.00"))}  # b and c have no positive total


def test_credited_dollars_both_rules(spark):
    rows = [(5, 3, 6, "Y"), (5, 3, 6, None), (5, 3, 4, None), (5, 3, None, None)]
    df = spark.createDataFrame(rows, "lead int, co int, goal int, flag string")
    lead = [r.x for r in df.select(credited_dollars("lead", "co", "flag", "goal", "lead").alias("x")).collect()]
    total = [r.x for r in df.select(credited_dollars("lead", "co", "flag", "goal", "total").alias("x")).collect()]
    assert lead == [8, 5, 8, 5]
    assert total == [8, 8, 8, 5]


def test_goal_level(spark):
    rows = [(0.0, 5.0e6), (None, 5.0e6), (100.0, 150.0), (0.0, 2.5e6), (0.0, 1.0)]
    df = spark.createDataFrame(rows, "single double, d double")
    out = [r.x for r in df.select(goal_level("d", "single", F.lit(1e6), F.lit(2e6), F.lit(4e6)).alias("x")).collect()]
    assert out == ["Level 5 Achieved", None, "Goal Achieved", "Level 4 Achieved", None]


def test_effective_goal(spark):
    df = spark.createDataFrame([(None, 7.0), (0.0, 7.0)], "single double, l3 double")
    assert [r.x for r in df.select(effective_goal("single", "l3").alias("x")).collect()] == [7.0, 0.0]


def test_household_label(spark):
    rows = [("a  ", "b "), ("a", None), (None, "b"), (None, None)]
    df = spark.createDataFrame(rows, "f string, s string")
    out = [r.x for r in df.select(household_label("f", "s").alias("x")).collect()]
    assert out == ["a & b", "a", "b", None]


def test_first_two_hot_key(spark):
    # one account holds most rows: still at most two ranks per key survive
    rows = [(1, f"{i:05d}", "No", i) for i in range(2000)] + [(1, "p", "Yes", 99999), (2, "z", "No", 1)]
    df = spark.createDataFrame(rows, "acc int, label string, prim string, id int")
    out = first_two(df, "acc", [F.col("prim").desc(), F.col("id")], "label", "a", "b")
    got = {r.acc: (r.a, r.b) for r in out.collect()}
    assert got == {1: ("p", "00000"), 2: ("z", None)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_owner_label(spark):
    rows = [(2, 1, Decimal("5.00"), 7, "Ann"), (1, 9, Decimal("450.00"), 7, "Ann"),
            (1, 1, Decimal("5.00"), None, "Ann"), (1, 1, Decimal("5.00"), 7, "Ann")]
    df = spark.createDataFrame(rows, "n long, acc long, amt decimal(18,2), lead long, name string")
    lab = owner_label("n", "acc", "amt", "lead", "name", overrides=((9, "450.00"),))
    assert [r.x for r in df.select(lab.alias("x")).collect()] == [
        "Multiple Lead Solicitors", "Multiple Lead Solicitors", "No Lead Solicitor Entered", "Ann"]


def test_top_n_stable_ties(spark):
    rows = [(i, 100) for i in range(10)] + [(99, 200)]
    df = spark.createDataFrame(rows, "id int, v int")
    out = top_n(df, 3, [F.col("v").desc()], ["id"]).collect()
    assert [r.id for r in out] == [99, 0, 1]
    assert "TakeOrderedAndProject" in top_n(df, 3, [F.col("v").desc()], ["id"])._jdf.queryExecution().executedPlan().toString()


def test_bridge_left_join_matches_left_join(spark):
    from fundscope.operators.relational import bridge_left_join
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id long, x string")
    # key 1 is hot on the bridge side
    bridge = spark.createDataFrame([(1, i) for i in range(500)] + [(3, 9)], "k long, v int")
    got = sorted(repr(tuple(r)) for r in bridge_left_join(left, bridge, "id", "k").collect())
    want = sorted(repr(tuple(r)) for r in left.join(bridge, left.id == bridge.k, "left").collect())
    assert got == want and len(got) == 502
    # split keys, also when equal bridge rows leave parts without any
    for rows in ([(1, i) for i in range(500)] + [(3, 9)], [(1, 7)] * 60 + [(2, 8)]):
        bridge = spark.createDataFrame(rows, "k long, v int")
        split = bridge_left_join(left, bridge, "id", "k", hot_keys=2, part_rows=5)
        want = sorted(repr(tuple(r)) for r in left.join(bridge, left.id == bridge.k, "left").collect())
        assert sorted(repr(tuple(r)) for r in split.collect()) == want


