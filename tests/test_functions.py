"""Column expressions: fiscal years, windows, names, tiers, rules."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from fundscope.functions import (combine_tiers, fiscal_year, first_last, in_fy, is_blank,
                                 kept_owner, last_first_comma, numeric_tier, segment_code,
                                 sort_name, team_flag, threshold_ladder, visit_qualifies)
from fundscope.params import Params


def test_fiscal_year_edges(spark):
    df = spark.createDataFrame([(dt.date(2018, 6, 30),), (dt.date(2018, 7, 1),), (None,)], "d date")
    got = [r.fy for r in df.select(fiscal_year("d").alias("fy")).collect()]
    assert got == [2018, 2019, None]


def test_fiscal_year_other_start(spark):
    df = spark.createDataFrame([(dt.date(2018, 9, 30),), (dt.date(2018, 10, 1),)], "d date")
    got = [r.fy for r in df.select(fiscal_year("d", 10).alias("fy")).collect()]
    assert got == [2018, 2019]


def test_time_on_last_day_is_inside(spark):
    p = Params(current_fy=2018)
    df = spark.createDataFrame([(dt.datetime(2018, 6, 30, 10, 0),), (dt.datetime(2018, 7, 1, 0, 0),),
                                (dt.datetime(2017, 7, 1, 0, 0),)], "t timestamp_ntz")
    got = [r.x for r in df.select(in_fy("t", 2018, p).alias("x")).collect()]
    assert got == [True, False, True]


def test_fy_bounds():
    p = Params(current_fy=2018)
    assert p.fy_bounds(2018) == (dt.date(2017, 7, 1), dt.date(2018, 6, 30))
    assert p.report_fys == [2018, 2017, 2016, 2015]
    assert p.report_bounds == (dt.date(2014, 7, 1), dt.date(2018, 6, 30))


def test_name_forms_null_part(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee")], "f string, l string")
    rows = df.select(first_last("f", "l").alias("a"), last_first_comma("f", "l").alias("b"),
                     sort_name("f", "l").alias("c")).collect()
    assert tuple(rows[0]) == ("Ann Lee", "Lee, Ann", "LEE/ANN")
    assert tuple(rows[1]) == (None, None, None)


def test_team_flag_and_owner_filter(spark):
    df = spark.createDataFrame([("GULC", "x"), ("Other", None), (None, "ex")], "t string, n string")
    rows = df.select(team_flag("t", ["GULC"]).alias("f"), kept_owner("n", ["ex"]).alias("k")).collect()
    assert [r.f for r in rows] == ["Y", None, None]
    assert [r.k for r in rows] == [True, False, False]


def test_is_blank(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "s string")
    assert [r.b for r in df.select(is_blank("s").alias("b")).collect()] == [True, True, False]


def test_numeric_tier_edges(spark):
    vals = [Decimal("10000000.00"), Decimal("9999999.99"), Decimal("999.99"), None,
            Decimal("25000.00"), Decimal("1000.00")]
    df = spark.createDataFrame([(v,) for v in vals], "c decimal(18,2)")
    got = [r.t for r in df.select(numeric_tier("c").alias("t")).collect()]
    assert got == [1, 2, 0, 0, 5, 6]


def test_segment_code(spark):
    df = spark.createDataFrame([("$10 million or more",), ("$500 - $999",), ("$50,000 to $99,999",),
                                ("unknown",), (None,)], "s string")
    got = [r.c for r in df.select(segment_code("s").alias("c")).collect()]
    assert got == [1, 6, 5, 0, 0]


def test_combine_tiers(spark):
    df = spark.createDataFrame([(0, 0), (0, 3), (2, 5)], "gu int, gga int")
    label, source = combine_tiers("gu", "gga")
    rows = df.select(label.alias("l"), source.alias("s")).collect()
    assert rows[0].l == "No Capacity Assigned" and rows[0].s is None
    assert rows[1].l.startswith("3 ") and rows[1].s == "GG+A"
    assert rows[2].l.startswith("2 ") and rows[2].s == "GU Research"


def test_threshold_ladder_order(spark):
    p = Params(always_count_people=("Pat Doe",))
    rows = [("x", "DA", "T", None), ("x", "DOD", "T", Decimal("99999.99")),
            ("x", "DOD", "T", Decimal("100000.00")), ("x", "DOD", "T", None),
            ("Pat Doe", None, None, None), ("x", "ADOD", "GULC", Decimal("50000.00")),
            ("x", None, "Lombardi", None), (None, None, None, Decimal("1e9"))]
    df = spark.createDataFrame(rows, "n string, lv string, t string, a decimal(18,2)")
    got = [r.y for r in df.select(threshold_ladder("n", "lv", "t", "a", p).alias("y")).collect()]
    assert got == ["Y", "N", "Y", "N", "Y", "Y", "Y", "N"]


def test_visit_qualifies(spark):
    p = Params(visit_people=("Kim Roe",))
    rows = [("Visit", None, None, None, None),            # plain visit
            ("Visit Assist", "Other", None, None, None),   # assist, not the team
            ("Visit Assist", "GULC", None, None, None),    # team rule
            ("Prospect Activity", None, "Kim Roe", "Substantive Action", "false"),
            ("Call", None, "Kim Roe", "x", "true"),
            ("Call", None, "Kim Roe", "x", "false")]
    df = spark.createDataFrame(rows, "t string, team string, c string, s string, f string")
    got = [r.q for r in df.select(visit_qualifies("t", "team", "c", "s", "f", p).alias("q")).collect()]
    assert got == [True, False, True, True, True, False]


def test_collation_option(spark):
    p = Params(collation="UTF8_LCASE_RTRIM")
    df = spark.createDataFrame([("visit ", "gulc"), ("Visit Assist", "GULC  ")], "t string, team string")
    byte = [r.q for r in df.select(visit_qualifies("t", "team", "t", "t", "t", Params()).alias("q")).collect()]
    ci = [r.q for r in df.select(visit_qualifies("t", "team", "t", "t", "t", p).alias("q")).collect()]
    assert byte == [False, False] and ci == [True, True]
    assert [r.f for r in df.select(team_flag("team", ["GULC"], p.collation).alias("f")).collect()] == ["Y", "Y"]


def test_fy_amount_columns(spark):
    from fundscope.functions import fy_amount_columns
    p = Params(current_fy=2018)
    rows = [(Decimal("10.00"), dt.date(2018, 6, 30), "Accepted", "Lead Solicitor"),
            (Decimal("20.00"), dt.date(2017, 7, 1), "Accepted - Stewardship", "Lead Solicitor"),
            (Decimal("30.00"), dt.date(2014, 7, 1), "Accepted", "Lead Solicitor"),
            (Decimal("40.00"), dt.date(2018, 7, 1), "Accepted", "Lead Solicitor"),
            (Decimal("50.00"), dt.date(2018, 1, 1), "Cultivation", "Lead Solicitor"),
            (Decimal("60.00"), dt.date(2018, 1, 1), "Accepted", "Secondary Solicitor")]
    df = spark.createDataFrame(rows, "amt decimal(18,2), d date, stage string, role string")
    out = df.select(*fy_amount_columns("amt", "d", "stage", "role", p)).collect()
    assert out[0].fy_18_gift_amount == Decimal("10.00") and out[0].fy_17_gift_amount is None
    assert out[1].fy_18_gift_amount == Decimal("20.00")          # 1 July 2017 opens FY2018
    assert out[2].fy_15_gift_amount == Decimal("30.00")
    assert all(v is None for v in out[3])                        # FY2019: outside the four years
    assert all(v is None for v in out[4]) and all(v is None for v in out[5])
