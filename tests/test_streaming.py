"""Stream over landed files == batch processing; running quality aggregation over a file stream."""

import os

from pyspark.sql import functions as F

from batchlens.functions.exprs import period_start
from batchlens.plans.train import train_models
from batchlens.sources.fixtures import trips_ev
from batchlens.sources.store import LEDGER, UPDATES
from batchlens.spec import TRIPS_EV
from batchlens.streaming.stream import StreamStore, quality_stream, run_stream, write_closed_weeks

from conftest import SF01
from test_pipeline import SMALL


def _land(spark, landing, weeks):
    df = trips_ev(spark, SF01).withColumn("wk", period_start("pickup_ts"))
    for w in weeks:
        df.where(F.col("wk") == F.lit(w)).drop("wk").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(landing, f"week={w}")
        )
    return df.drop("wk").schema


def test_stream_updates_in_order(spark, tmp_path):
    spec = TRIPS_EV
    weeks = [r[0] for r in trips_ev(spark, SF01).select(period_start("pickup_ts")).distinct().orderBy(1).collect()]
    assert len(weeks) == 5
    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "ckpt")
    schema = _land(spark, landing, weeks[:3])
    # files arrive; nothing trained yet, so batches only accumulate
    assert run_stream(spark, root, spec, landing + "/*", schema, ckpt) == 0
    train_models(StreamStore(spark, root, spec, hold_latest=False), spec, grids=SMALL, mlp_rounds=1,
                 selected_models=["boost", "tree"])
    _land(spark, landing, weeks[3:])
    n = run_stream(spark, root, spec, landing + "/*", schema, ckpt, boost_iterations=2)
    assert n == 2
    s = StreamStore(spark, root, spec, hold_latest=False)
    led = s.read(LEDGER).where(F.col("batch_start").isNotNull())
    assert led.select("batch_start").distinct().count() == 5
    upd = s.read(UPDATES).orderBy("created_at").select("processed_batch_index").collect()
    assert [r[0] for r in upd] == [4, 5]


def test_quality_stream_matches_batch(spark, tmp_path):
    spec = TRIPS_EV
    landing = str(tmp_path / "landing")
    schema = _land(spark, landing, [r[0] for r in trips_ev(spark, SF01).select(period_start("pickup_ts")).distinct().collect()])
    st = spark.readStream.schema(schema).parquet(landing + "/*")
    q = (
        quality_stream(st, spec)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("qstream")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = {r["batch_start"]: r["row_count"] for r in spark.sql("select * from qstream").collect()}
    want = {
        r[0]: r[1]
        for r in trips_ev(spark, SF01).groupBy(period_start("pickup_ts")).count().collect()
    }
    assert got == want


def test_late_files_are_learned_and_hours_end(spark, tmp_path):
    """Hourly batches (zone-free keys), with a file of a closed hour that lands last: the stream ends, the hour is reopened, and only its
    late rows are learned."""
    import datetime as dt

    from batchlens.sources.store import QUALITY

    spec = TRIPS_EV.with_(batch_freq="hour", min_batch_rows=20)
    t0 = dt.datetime(2015, 3, 8, 0, 0)

    def land(name, hour, n, start=0):
        rows = [(h := start + i, 1, t0 + dt.timedelta(hours=hour, seconds=h), t0 + dt.timedelta(hours=hour, seconds=h + 60 + i % 7), 10.0 + i % 5, "a", 1 + i % 3, 1.0 + i % 9) for i in range(n)]
        df = spark.createDataFrame(rows, "event_id long, user_id long, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, total_amount double, store_flag string, passenger_count long, trip_distance double")
        df.coalesce(1).write.parquet(str(tmp_path / "landing" / name))
        return df.schema

    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "ckpt")
    for h in (0, 1, 2):
        schema = land(f"h{h}", h, 60)
    assert run_stream(spark, root, spec, landing + "/*", schema, ckpt) == 0
    whole = StreamStore(spark, root, spec, hold_latest=False)
    train_models(whole, spec, grids=SMALL, selected_models=["tree"])
    land("h3", 3, 60)
    land("late", 1, 25, start=1000)
    assert run_stream(spark, root, spec, landing + "/*", schema, ckpt) == 2  # hour 3 and the late rows of hour 1
    assert run_stream(spark, root, spec, landing + "/*", schema, ckpt) == 0
    led = whole.read(LEDGER).where("kind = 'late_rows'").collect()
    assert len(led) == 1 and led[0].batch_start == t0 + dt.timedelta(hours=1)
    upd = {r.processed_batch_index: r for r in whole.committed_log(UPDATES).collect()}
    assert set(upd) == {2, 4} and upd[2].quality_row_count == 85 and upd[2].post_update_batch_rows <= 25
    assert whole.committed_log(QUALITY).count() == 2


def test_quality_stream_figures(spark, tmp_path):
    from batchlens.operators.quality import quality_profile

    spec = TRIPS_EV
    landing = str(tmp_path / "landing")
    schema = _land(spark, landing, [r[0] for r in trips_ev(spark, SF01).select(period_start("pickup_ts")).distinct().collect()])
    st = spark.readStream.schema(schema).parquet(landing + "/*")
    q = quality_stream(st, spec).writeStream.outputMode("complete").format("memory").queryName("qfull").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["batch_start"]: r for r in spark.sql("select * from qfull").collect()}
    rows = trips_ev(spark, SF01).withColumn("batch_start", period_start("pickup_ts"))
    want = {r["batch_start"]: r for r in quality_profile(rows, spec).collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        for c in ("row_count", "negative_target_count", "invalid_duration_count", "negative_trip_distance_count", "invalid_coordinate_count"):
            assert g[c] == w[c], c
        for c in ("target_q99", "duration_q99", "trip_distance_q99"):
            assert abs(g[c] - w[c]) <= 0.05 * abs(w[c]) + 1e-6, c


def test_closed_weeks_are_exact_and_leave_no_state(spark, tmp_path):
    """Every row of some weeks twice, half of the copies in a later file: closed weeks equal the batch profile, and their state is gone."""
    from batchlens.operators.quality import quality_profile

    spec = TRIPS_EV
    rows = trips_ev(spark, SF01)
    rows = rows.unionByName(rows.where("event_id % 5 = 0")).withColumn("batch_start", period_start("pickup_ts"))
    weeks = [r[0] for r in rows.select("batch_start").distinct().orderBy(1).collect()]
    landing = str(tmp_path / "landing")

    def run():
        st = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        return write_closed_weeks(st, spec, str(tmp_path / "out"), str(tmp_path / "ck"))

    raw = rows.drop("batch_start")
    schema = raw.schema
    for w in weeks[:2]:  # a file for each half of the week, the copies apart from their rows
        part = raw.where(F.col("pickup_ts").between(F.lit(w), F.lit(w) + F.expr("interval 7 days"))).where(period_start("pickup_ts") == F.lit(w))
        part.where("event_id % 2 = 0").coalesce(1).write.mode("append").parquet(landing)
        run()
        part.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(landing)
        run()
    raw.where(period_start("pickup_ts") == F.lit(weeks[3])).limit(1).coalesce(1).write.mode("append").parquet(landing)
    q = run()
    got = {r["batch_start"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["batch_start"]: r for r in quality_profile(rows.where(F.col("batch_start").isin(weeks[:2])), spec).collect()}
    assert set(got) == set(weeks[:2])
    for k, w in want.items():
        assert w["duplicate_count"] > 0
        assert got[k].asDict() == {c: w[c] for c in got[k].asDict()}
    held = [op["numRowsTotal"] for op in q.lastProgress["stateOperators"]]
    assert max(held) <= 1  # the one row of the week still open
