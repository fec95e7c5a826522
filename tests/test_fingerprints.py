"""Rows seen in earlier batches, by a bucketed table of fingerprints."""

import io
from contextlib import redirect_stdout

from batchlens.sources.fingerprints import Fingerprints

SCHEMA = "day int, a long, b long, c string"


def test_rows_that_come_again(spark, tmp_path):
    seen = Fingerprints(spark, str(tmp_path / "fp"), ["a", "b", "c"], 4)
    one = spark.createDataFrame([(1, 1, None, "x"), (1, 1, None, "x"), (1, 2, 2, None), (1, None, None, None)], SCHEMA)
    assert [tuple(r) for r in seen.compare(one, ["day"]).collect()] == [(1, 4, 0, 3)]
    assert seen.compare(one.limit(0), ["day"]).count() == 0
    seen.add(one)
    seen.add(one)  # a replay
    assert seen.known().count() == 3 and spark.table(seen.name).count() == 3
    # a null in another place is another row
    two = spark.createDataFrame([(2, None, 1, "x"), (2, 1, None, "x"), (2, None, None, None), (2, 9, 9, "y"), (2, 9, 9, "y")], SCHEMA)
    assert [tuple(r) for r in seen.compare(two, ["day"]).collect()] == [(2, 5, 2, 2)]
    assert sorted(r.a or 0 for r in seen.unseen(two).collect()) == [0, 9, 9]
    seen.add(two)
    assert seen.compare(two, []).first().asDict() == {"row_count": 5, "seen_rows": 5, "new_rows": 0}


def test_a_hot_row_and_a_plan_without_an_exchange_of_history(spark, tmp_path):
    seen = Fingerprints(spark, str(tmp_path / "fp"), ["a"], 4)
    old = spark.range(5000).selectExpr("if(id % 3 = 0, 0, id) a", "0 day")
    seen.add(old)
    assert seen.known().count() == old.select("a").distinct().count()
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = seen.compare(spark.range(4000, 8000).selectExpr("if(id % 3 = 0, 0, id) a", "1 day"), ["day"])
        with redirect_stdout(io.StringIO()) as text:
            out.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    plan = text.getvalue()
    assert "Bucketed: true" in plan
    # the new rows' groups, their way to the buckets, the sums of each key; none for history
    assert plan.split("\n\n")[0].count("Exchange") == 3
    r = out.first()
    assert (r.row_count, r.seen_rows, r.new_rows) == (4000, 4000 // 3 + 1 + 666, 2000)
