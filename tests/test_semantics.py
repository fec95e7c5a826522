"""Micro tables for the pandas-vs-Spark semantic traps and the operator properties."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from batchlens.functions.exprs import parse_batch_range, period_start, weekday_mon0
from batchlens.functions.quantiles import grouped_quantiles, quantiles
from batchlens.operators import rules as R
from batchlens.operators.batching import assign_batches, batch_list
from batchlens.operators.cleaning import clean
from batchlens.operators.evaluate import argmin, metrics_dict
from batchlens.operators.features import make_time_features, nan_as_null, normalize_columns, require_columns
from batchlens.operators.preprocess import fit_stats
from batchlens.operators.quality import quality_profile
from batchlens.operators.sequence import next_value_in_group
from batchlens.operators.split import tail_split, validation_rows
from batchlens.spec import TAXI, TRIPS_EV, TRIPS_LI

T = dt.datetime


def test_weekday_and_week_start(spark):
    # Sunday 23:59:59 and Monday 00:00:00 fall in different Monday-based weeks
    df = spark.createDataFrame([(T(2024, 1, 7, 23, 59, 59),), (T(2024, 1, 8, 0, 0, 0),)], "ts timestamp_ntz")
    r = df.select(weekday_mon0("ts").alias("wd"), period_start("ts").alias("wk")).collect()
    assert [x.wd for x in r] == [6, 0]
    assert [x.wk for x in r] == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]


def test_min_batch_rows_and_ordinal(spark):
    rows = [(T(2024, 1, 1) + dt.timedelta(minutes=i), T(2024, 1, 1, 1), 1.0) for i in range(100)]
    rows += [(T(2024, 1, 8) + dt.timedelta(minutes=i), T(2024, 1, 8, 1), 1.0) for i in range(99)]
    rows += [(None, T(2024, 1, 8, 1), 1.0)]
    df = spark.createDataFrame(rows, "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, total_amount double")
    b = assign_batches(df, TRIPS_EV)
    names = batch_list(b, TRIPS_EV).collect()
    assert len(names) == 1 and names[0].row_count == 100
    assert names[0].batch_name == "batch_0001_2024-01-01_2024-01-01"


def test_nan_is_not_nonnegative(spark):
    # pandas: NaN >= 0 is False; Spark: NaN >= 0 is True unless NaN became NULL
    from batchlens.operators.features import nan_as_null

    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert df.where("x >= 0").count() == 2
    assert nan_as_null(df).where("x >= 0").count() == 1


def test_duplicates_count_nulls_as_equal(spark):
    # count_distinct drops rows with a NULL; the profile must not
    spec = TRIPS_EV
    rows = [
        (1, 1, T(2024, 1, 1, 1), T(2024, 1, 1, 2), None, "a", 1, 1.0),
        (1, 1, T(2024, 1, 1, 1), T(2024, 1, 1, 2), None, "a", 1, 1.0),
        (1, 1, T(2024, 1, 1, 1), T(2024, 1, 1, 2), None, "a", 1, 1.0),
        (2, 1, T(2024, 1, 1, 3), None, -1.0, None, None, -2.0),
    ]
    df = spark.createDataFrame(
        rows,
        "event_id long, user_id long, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, total_amount double, "
        "store_flag string, passenger_count long, trip_distance double",
    ).withColumn(spec.batch_col, period_start("pickup_ts"))
    p = quality_profile(df, spec).first()
    assert p.row_count == 4 and p.duplicate_count == 2
    # nulls: 3 targets + (dropoff, flag, passengers, duration) of the last row
    assert p.missing_total == 3 + 4
    assert p.negative_target_count == 1 and p.negative_trip_distance_count == 1
    assert p.invalid_duration_count == 1


def test_exact_quantile_matches_pandas_and_percentile(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(size=3000), np.full(500, 0.25)])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    for q in (0.0, 0.25, 0.5, 0.75, 0.99, 1.0):
        got = quantiles(df, {"x": q})["x"]
        assert got == pytest.approx(float(pd.Series(vals).quantile(q)), abs=1e-12)
        assert got == df.agg(F.percentile("x", q)).first()[0]  # bit-identical interpolation
    assert quantiles(df, {"x": [0.0, 1.0]})["x"] == [vals.min(), vals.max()]
    assert quantiles(df.where("x > 100"), {"x": 0.5})["x"] is None


def test_grouped_quantiles_with_a_hot_group(spark):
    # one batch holds 90 % of the rows, with continuous values; groups of one row, of nulls only, and the null group
    rng = np.random.default_rng(2)
    n = 20_000
    g = np.where(rng.random(n) < 0.9, "hot", rng.choice(["a", "b", "c"], n))
    pdf = pd.DataFrame({"g": g, "x": rng.lognormal(size=n), "y": rng.integers(0, 5, n).astype(float)})
    pdf = pd.concat([pdf, pd.DataFrame({"g": ["one", "none", None], "x": [7.0, np.nan, 3.0], "y": [np.nan, 1.0, 2.0]})])
    df = nan_as_null(spark.createDataFrame(pdf))
    wants = {"x50": ("x", 0.5), "x99": ("x", 0.99), "y25": ("y", 0.25)}
    got = {r.g: r for r in grouped_quantiles(df, ["g"], wants).collect()}
    assert set(got) == {"hot", "a", "b", "c", "one", "none", None}
    for k, part in pdf.groupby("g", dropna=False):
        r = got[k if isinstance(k, str) else None]
        for name, (c, q) in wants.items():
            want = part[c].quantile(q)
            assert (r[name] is None and np.isnan(want)) or r[name] == pytest.approx(want, abs=1e-12)


def test_weighted_quantiles_count_rows(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 2)], "x double, n long")
    got = grouped_quantiles(df, [], {"q": ("x", 0.5)}, weight=F.col("n")).first()["q"]
    assert got == np.quantile([1, 1, 1, 2, 10, 10], 0.5)


def test_clean_order_matters(spark):
    # the target threshold is taken over survivors of the distance trim (m_quant)
    rows = [(T(2024, 1, 1), T(2024, 1, 1, 0, 10), float(t), float(d)) for t, d in
            [(1, 1), (2, 1), (3, 1), (4, 1), (100, 1000), (5, 2), (6, 2), (7, 3), (8, 3), (9, 4)]]
    df = spark.createDataFrame(rows, "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, total_amount double, trip_distance double")
    spec = TRIPS_EV.with_(distance_q=0.9, target_q=0.9, duration_q=1.0)
    res = clean(make_time_features(df, spec), spec)
    pdf = pd.DataFrame(rows, columns=["p", "d", "t", "dist"])
    pdf = pdf[pdf.dist <= pdf.dist.quantile(0.9)]
    pdf = pdf[pdf.t <= pdf.t.quantile(0.9)]
    assert sorted(r.total_amount for r in res.df.collect()) == sorted(pdf.t.tolist())
    assert set(res.thresholds) == {"distance", "target", "duration"}


def test_scoring_mode_keeps_rows_without_target(spark):
    rows = [(T(2024, 1, 1), T(2024, 1, 1, 0, 10), None, 1.0), (T(2024, 1, 1), T(2024, 1, 1, 0, 20), 5.0, 2.0)]
    df = spark.createDataFrame(rows, "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, total_amount double, trip_distance double")
    spec = TRIPS_EV.with_(distance_q=1.0, duration_q=1.0)  # isolate the target requirement from the trims
    f = make_time_features(df, spec)
    assert clean(f, spec).df.count() == 1
    assert clean(f, spec, require_target=False).df.count() == 2


@pytest.mark.parametrize("n,k", [(2, 1), (1999, 400), (2000, 1000), (2001, 1000)])
def test_tail_split_sizes(spark, n, k):
    assert validation_rows(n) == k
    rows = [(T(2024, 1, 1) + dt.timedelta(seconds=i // 3), float(i)) for i in range(n)]  # ties on time
    df = spark.createDataFrame(rows, "pickup_ts timestamp_ntz, total_amount double").withColumn(
        "dropoff_ts", F.col("pickup_ts")
    )
    ts = tail_split(df, TRIPS_EV)
    assert ts.validation.count() == k and ts.subtrain.count() == n - k
    assert ts.subtrain.agg(F.max("total_amount")).first()[0] < ts.validation.agg(F.min("total_amount")).first()[0]


def test_modes_tie_to_smallest_and_unseen_category(spark):
    df = spark.createDataFrame([(2,), (1,), (2,), (1,), (None,)], "vendor_id long").withColumn("store_flag", F.lit("x"))
    spec = TRIPS_LI.with_(raw_features=("vendor_id", "store_flag"), categorical=("vendor_id", "store_flag"))
    st = fit_stats(df, spec)
    assert st.modes["vendor_id"] == "1" and st.categories["vendor_id"] == ["1", "2"]


def test_metrics_and_argmin(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (None, 9.0)], "y double, prediction double")
    m = metrics_dict(df, "y")
    assert m["rows"] == 3 and m["mae"] == pytest.approx(1 / 3) and m["rmse"] == pytest.approx(math.sqrt(0.5 / 3))
    assert m["r2"] == pytest.approx(1 - 0.5 / 2.0)
    c = spark.createDataFrame([("a", 2.0, 0), ("b", 1.0, 1), ("c", 1.0, 2)], "k string, rmse double, o long")
    assert argmin(c, "rmse", "o").first().k == "b"


def test_rules_all_splits_and_lift(spark):
    rows = [(True, True, False, False, False, True)] * 6 + [(True, False, False, False, False, False)] * 4
    df = spark.createDataFrame(rows, ", ".join(f"{i} boolean" for i in R.ITEMS))
    cond = R.Conditions(df, R.ITEMS, {})
    fi = R.frequent_itemsets(cond, 0.05)
    sup = {r["items"]: r["support"] for r in fi.collect()}
    assert sup["pickup_night"] == 1.0 and sup["pickup_night & pickup_weekend & total_amount_high"] == 0.6
    rules = {r["rule"]: r for r in R.association_rules(fi, 0.6).collect()}
    # multi-item consequent present; lift = confidence / support(consequent)
    r = rules["pickup_weekend -> pickup_night & total_amount_high"]
    assert r.confidence == pytest.approx(1.0) and r.lift == pytest.approx(1.0 / 0.6)


def test_skew_safe_lead_equals_window(spark):
    rng = np.random.default_rng(1)
    n = 3000
    users = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 20, n))  # user 0 holds half the rows
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 10 * 86400, n), unit="s")
    pdf = pd.DataFrame({"event_id": np.arange(n), "user_id": users, "ts": ts})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = next_value_in_group(df, "user_id", ["ts", "event_id"], "ts", "nxt", F.to_date("ts"))
    want = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    assert got.select("event_id", "nxt").exceptAll(want.select("event_id", "nxt")).count() == 0
    assert got.count() == n


def test_batch_name_parsing_and_guards(spark):
    df = spark.createDataFrame([("batch_0001_2015-01-01_2015-01-04.csv",), ("batch_0002_bad",), ("x_y_2016-13-01_z",)], "n string")
    s, e = parse_batch_range(F.col("n"))
    r = df.select(s.alias("s"), e.alias("e")).collect()
    assert r[0].s == dt.date(2015, 1, 1) and r[0].e == dt.date(2015, 1, 4)
    assert r[1].s == dt.date(9999, 12, 31) and r[2].e == dt.date(9999, 12, 31)
    raw = spark.createDataFrame([(1,)], "RateCodeID long")
    assert "RatecodeID" in normalize_columns(raw, TAXI).columns
    with pytest.raises(ValueError, match="lacks required columns"):
        require_columns(raw, TAXI.required)


def test_rules_over_many_conditions(spark):
    # 70 conditions: more than a 64-bit mask has bits
    items = tuple(f"c{i:02d}" for i in range(70))
    rows = [tuple(i < 3 or i == 69 for i in range(70))] * 8 + [tuple(i == 5 for i in range(70))] * 2
    fi = R.frequent_itemsets(R.Conditions(spark.createDataFrame(rows, ", ".join(f"{i} boolean" for i in items)), items, {}), 0.5)
    assert fi.count() == 2**4 - 1
    rules = R.association_rules(fi, 0.9).collect()
    assert len(rules) == 3**4 - 2 * 2**4 + 1  # ordered pairs of disjoint non-empty sets
    assert {r.lift for r in rules} == {1.25}


def test_zone_free_parsing(spark):
    from batchlens.functions.exprs import parse_ts

    rows = [("2015-03-08 02:30:00",), ("2015-03-08T02:30:00.25",), ("never",), (None,)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(rows, "t string").select(parse_ts("t").alias("t"))
        got = [r.t for r in df.collect()]
        hours = [r.h for r in df.select(period_start("t", "hour").cast("string").alias("h")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [T(2015, 3, 8, 2, 30), T(2015, 3, 8, 2, 30, 0, 250_000), None, None]
    assert hours == ["2015-03-08 02:00:00", "2015-03-08 02:00:00", None, None]  # an hour that New York's clocks skip


@pytest.mark.parametrize("freq,key", [("day", dt.date(2024, 2, 29)), ("month", dt.date(2024, 2, 1)), ("week", dt.date(2024, 2, 26)), ("hour", T(2024, 2, 29, 13))])
def test_period_keys(spark, freq, key):
    df = spark.createDataFrame([(T(2024, 2, 29, 13, 59, 59),)], "t timestamp_ntz")
    assert df.select(period_start("t", freq)).first()[0] == key


def test_unseen_category_is_all_zeros(spark):
    from batchlens.models.base import FEATURES, feature_stages, fit_pipeline, with_features
    from batchlens.operators.preprocess import FitStats

    st = FitStats([], ["c"], modes={"c": "a"}, categories={"c": ["a", "b"]})
    train = with_features(spark.createDataFrame([("a",), ("b",)], "c string"), st, "tree")
    test = with_features(spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "c string"), st, "tree")
    got = [r[0].toArray().tolist() for r in fit_pipeline(feature_stages(st, one_hot=True), train).transform(test).select(FEATURES).collect()]
    assert got == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [1.0, 0.0]]


def test_csv_sources(spark, tmp_path):
    from batchlens.plans.train import load_source, prepare_batches
    from batchlens.sources.files import read_batch_files, read_trips
    from batchlens.sources.store import Store

    head = "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,pickup_longitude,pickup_latitude,RateCodeID,store_and_fwd_flag,dropoff_longitude,dropoff_latitude,total_amount"
    good = [f"1,2015-01-0{1 + i % 7} 0{i % 10}:00:00,2015-01-0{1 + i % 7} 0{i % 10}:10:00,1,{i}.5,-73.9,40.7,1,N,-73.9,40.7,{10 + i}" for i in range(120)]
    bad = ["2,not a time,2015-01-01 00:10:00,1,1.0,0,0,1,N,0,0,5", "2,2015-01-02 00:00:00,2015-01-02 00:09:00,x,NaN,0,0,1,,0,0,nan"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([head, *good, *bad]))
    df = read_trips(spark, str(tmp_path / "in"), TAXI)
    assert "RatecodeID" in df.columns and df.schema["tpep_pickup_datetime"].dataType.typeName() == "timestamp_ntz"
    assert df.count() == 122 and df.where("trip_distance is null").count() == 1 and df.where("isnan(total_amount)").count() == 0
    assert load_source(df, TAXI).count() == 121
    names = prepare_batches(df, TAXI.with_(min_batch_rows=51), Store(spark, str(tmp_path / "store"))).collect()
    assert [(r.batch_name, r.row_count) for r in names] == [("batch_0001_2015-01-01_2015-01-04", 70), ("batch_0002_2015-01-05_2015-01-07", 51)]
    (tmp_path / "in" / "b.csv").write_text("tpep_pickup_datetime,extra\n2015-02-01 00:00:00,7\n")
    both = read_batch_files(spark, str(tmp_path / "in"), TAXI)
    assert both.count() == 123 and {r[0] for r in both.select("source_batch").distinct().collect()} == {"a.csv", "b.csv"}
    assert both.where("extra = '7'").first().total_amount is None


def test_nothing_stays_cached(spark):
    from batchlens import catalog

    for q in ("clean_trips_ev", "a12_rules_low_ev"):
        catalog.queries()[q](spark, "/root/testdata/sf0.001").count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0
