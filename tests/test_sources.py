"""Sources and sinks: all-text CSV import, views, partitioned tables,
checkpoints."""

import os

from pyspark.sql import functions as F

from fundscope.plans import activity as A
from fundscope.plans import catalog
from fundscope.plans import scorecard as SC
from fundscope.sources import (GOALS_SCHEMA, checkpoint_dir, publish_view,
                               read_text_csv, rejected_cells, typed_import)

from .conftest import SF_SMALL


def test_csv_import_typed(spark, scratch):
    cols = [src for _, src, _ in GOALS_SCHEMA]
    path = os.path.join(scratch, "goals.csv")
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n")
        row = {c: "" for c in cols}
        row.update(last_first="Lee, Ann", dollar_goal_lvl4="4000000", dollar_goal_single="abc",
                   goal_date="2017-07-01", goal_fy="2018")
        f.write(",".join(f'"{row[c]}"' for c in cols) + "\n")
    raw = read_text_csv(spark, path, cols)
    assert all(t == "string" for _, t in raw.dtypes)
    r = typed_import(raw).collect()[0]
    assert r.dollar_goal_lvl4 == 4000000.0 and r.dollar_goal_single is None and r.goal_fy == 2018
    rej = {x.column_name: x.rejected_cells for x in rejected_cells(raw).collect()}
    assert rej["dollar_goal_single"] == 1 and rej["dollar_goal_lvl4"] == 0


def test_csv_columns_by_name(spark, scratch):
    import pytest

    path = os.path.join(scratch, "permuted.csv")
    with open(path, "w") as f:
        f.write('goal_fy,more,last_first\n2018,x,"Lee, Ann"\n2017\n,,\n')
    got = read_text_csv(spark, path, ["last_first", "goal_fy"]).collect()
    assert [tuple(r) for r in got] == [("Lee, Ann", "2018"), (None, "2017"), (None, None)]
    with pytest.raises(ValueError, match="goal_date"):
        read_text_csv(spark, path, ["last_first", "goal_date"])


def test_publish_view(spark):
    c = catalog.context(spark, SF_SMALL)
    publish_view(c.key, "do_name_key")
    assert spark.sql("SELECT count(*) AS n FROM do_name_key").collect()[0].n == c.key.count()


def test_partitioned_activity_list_prunes(spark, scratch):
    c = catalog.context(spark, SF_SMALL)
    path = os.path.join(scratch, "activity_list")
    A.write_activity_list(c.activity_list, path)
    stored = A.read_activity_list(spark, path, c.params, fy=c.params.current_fy)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(comb_fy" in plan
    # the scorecard on the stored list equals the scorecard on the live plan
    live = SC.scorecard(c.activity_list, c.key, c.goals, c.params)
    again = SC.scorecard(stored, c.key, c.goals, c.params)
    assert live.count() == again.count() > 0
    assert live.exceptAll(again.select(live.columns)).count() == 0


def test_checkpoint_dir_of_the_session_is_kept(spark, scratch):
    d = checkpoint_dir(spark, fallback=os.path.join(scratch, "ckpt2"))
    assert d and not d.endswith("ckpt2")


def test_correct_names(spark):
    from fundscope.sources.goals import correct_names
    raw = spark.createDataFrame([("Smith, Jo", "1"), ("Lee, Ann", "2")], "last_first string, x string")
    fix = spark.createDataFrame([("Smith, Jo", "Brown, Jo")], "old_name string, new_name string")
    got = sorted(tuple(r) for r in correct_names(raw, fix).collect())
    assert got == [("Brown, Jo", "1"), ("Lee, Ann", "2")]


def test_literal_rows(spark):
    from fundscope.sources import literal_rows
    df = literal_rows(spark, [{"a": 1, "b": "x"}, {"b": "y"}], "a long, b string")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (None, "y")]


def test_malformed_csv_rows_stand_beside_the_good_ones(spark, scratch):
    import pytest

    from fundscope.sources.tables import checked_text_csv

    path = os.path.join(scratch, "malformed.csv")
    with open(path, "w") as f:
        f.write('goal_fy,remark,last_first\n2018,"two\nlines","Lee, Ann"\n2017\n2016,x,"Ray, Bo",9,9\n,,\n\n'
                '2015,"says ""hi""","O\'Neil, C"\n2014,x,"never closed\n')
    rows, rejected = checked_text_csv(spark, path, ["last_first", "goal_fy", "remark"])
    assert {*map(tuple, rows.collect())} == {
        ("Lee, Ann", "2018", "two\nlines"), ("O'Neil, C", "2015", 'says "hi"'), ("never closed\n", "2014", "x")}
    bad = {r["row_text"].strip(): r["reason"] for r in rejected.collect()}
    assert bad.pop("2017").startswith("too few") and bad.pop("2016,x,\"Ray, Bo\",9,9") == "too many cells"
    assert not bad
    with open(path, "a") as f:
        f.write("2013,x,y\n")   # the open quote takes this line in
    assert checked_text_csv(spark, path, ["goal_fy"])[0].count() == 3
    # asking for one column counts the cells all the same
    assert checked_text_csv(spark, path, ["remark"])[0].count() == 3
    with pytest.raises(ValueError, match="goal_date"):
        checked_text_csv(spark, path, ["goal_date"])
    empty = os.path.join(scratch, "header_only.csv")
    with open(empty, "w") as f:
        f.write("a,b\n")
    rows, rejected = checked_text_csv(spark, empty, ["b"])
    assert rows.count() == rejected.count() == 0


def test_materialise_replaces_one_dataset_of_a_set(spark, scratch):
    from fundscope.sources import Versions, materialise, register

    out = os.path.join(scratch, "one_by_one")
    years = spark.range(30).select("id", (F.col("id") % 3 + 1996).cast("int").alias("fy"))
    assert materialise(spark.range(5), out, "small") == 1
    assert materialise(years, out, "years", "fy", ("id",)) == 2
    v = Versions(spark, out)
    assert v.read("small").count() == 5 and v.read("years").count() == 30
    assert "PartitionFilters: [isnotnull(fy" in v.read("years").where("fy = 1997")._jdf.queryExecution().executedPlan().toString()
    with_unknown = years.unionByName(spark.range(2).select("id", F.lit(None).cast("int").alias("fy")))
    assert materialise(with_unknown, out, "years", "fy") == 3
    assert {p.path.split("/version=")[1][0] for p in v.parts() if p.dataset == "years" and p.partition_value} == {"2"}
    assert v.read("years").where("fy IS NULL").count() == 2 and v.read("years", 2).count() == 30
    # a session that reads by name follows, also to the rows of no year and to another schema
    register(spark, out, "one_by_one")
    reader = spark.newSession()
    assert reader.table("one_by_one.years").where("fy IS NULL").count() == 2 and reader.table("one_by_one.small").count() == 5
    materialise(years.limit(0), out, "years", "fy")
    materialise(spark.range(3).select("id", F.lit("it's").alias("new")), out, "small")
    register(spark, out, "one_by_one")
    assert reader.table("one_by_one.years").count() == 0 and reader.table("one_by_one.years").columns == ["id", "fy"]
    assert [r["new"] for r in reader.table("one_by_one.small").collect()] == ["it's"] * 3
