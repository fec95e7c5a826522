"""Registered queries: each Spark callable (spark, sf_dir) -> DataFrame, and its DuckDB oracle SQL.

Every query reads the driver's tables (through the adapters in ``sources.fixtures``) in full.
Doubles that come out of different summation orders are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.operators.batching import assign_batches, batch_list
from batchlens.operators.cleaning import prepare
from batchlens.operators.features import make_time_features, model_columns
from batchlens.operators.quality import batch_meta, quality_profile, quality_totals
from batchlens.operators import rules as R
from batchlens.operators.evaluate import argmin, regression_metrics
from batchlens.operators.preprocess import boosting_frame, fit_stats, mlp_frame, stats_frame
from batchlens.operators.split import tail_split
from batchlens.functions.exprs import fixed4, parse_batch_range, parse_ts, text_or_na
from batchlens.functions.quantiles import quantile
from batchlens.plans import sql as S
from batchlens.plans.train import prepare_split
from batchlens.plans.summary import best_records, history, latest_record
from batchlens.session import ensure_checkpoint_dir, kept_table
from batchlens.sources.files import read_batch_files, read_trips
from batchlens.sources.store import latest_per, pending_batches
from batchlens.sources.fixtures import ADAPTERS, adapter_sql
from batchlens.spec import TRIPS_EV, TRIPS_LI, TableSpec

Query = Callable[[SparkSession, str], DataFrame]

LI_RAW = [
    "pickup_ts", "dropoff_ts", "total_amount", "trip_distance", "passenger_count", "vendor_id", "ratecode_id",
    "store_flag", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
]
EV_RAW = [
    "event_id", "user_id", "pickup_ts", "dropoff_ts", "total_amount", "store_flag", "passenger_count",
    "trip_distance",
]

NUMERIC_CATS = {"vendor_id", "ratecode_id"}
_SPECS = {"trips_li": TRIPS_LI, "trips_li_dup": TRIPS_LI, "trips_ev": TRIPS_EV, "trips_signal": TRIPS_EV}
_RAW = {"trips_li": LI_RAW, "trips_li_dup": LI_RAW, "trips_ev": EV_RAW, "trips_signal": EV_RAW}
ADAPTERS_COLS = _RAW


def _r(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _rs(cols) -> str:
    return ", ".join(f"round({c}, 6) {c}" for c in cols)


def _batched(spark, sf, adapter):
    spec = _SPECS[adapter]
    return assign_batches(ADAPTERS[adapter](spark, sf), spec), spec


def _batched_once(spark, sf, adapter):
    """As ``_batched``, with the adapter's rows stored first: rules and splits read them several times, and the join behind them is shuffled once."""
    spec = _SPECS[adapter]
    return assign_batches(kept_table(ADAPTERS[adapter](spark, sf), "trips"), spec), spec


Q99 = ["trip_distance_q99", "target_q99", "duration_q99"]


def q_quality(adapter: str) -> Query:
    def run(spark, sf):
        b, spec = _batched(spark, sf, adapter)
        return _r(quality_profile(b, spec), Q99)

    return run


def sql_quality(adapter: str) -> str:
    spec = _SPECS[adapter]
    inner = S.quality_profile_sql(adapter, spec, _RAW[adapter])
    keep = [
        "batch_start", "row_count", "missing_total", "duplicate_count", "negative_trip_distance_count",
        "negative_target_count", "invalid_duration_count", "invalid_coordinate_count",
    ]
    return f"select {', '.join(keep)}, {_rs(Q99)} from ({inner}) q"


def q_batch_list(adapter: str) -> Query:
    def run(spark, sf):
        b, spec = _batched(spark, sf, adapter)
        return batch_list(b, spec)

    return run


def q_batch_meta(adapter: str) -> Query:
    def run(spark, sf):
        b, spec = _batched(spark, sf, adapter)
        return batch_meta(b, spec)

    return run


def q_quality_totals(adapter: str) -> Query:
    def run(spark, sf):
        b, spec = _batched(spark, sf, adapter)
        return quality_totals(quality_profile(b, spec))

    return run


def sql_quality_totals(adapter: str) -> str:
    return f"""select count(*) processed_batches, cast(sum(row_count) as bigint) total_rows,
  cast(sum(missing_total) as bigint) total_missing, cast(sum(duplicate_count) as bigint) total_duplicates,
  cast(sum(negative_target_count) as bigint) total_negative_target,
  cast(sum(invalid_duration_count) as bigint) total_invalid_duration,
  cast(sum(invalid_coordinate_count) as bigint) total_invalid_coordinates
from ({S.quality_profile_sql(adapter, _SPECS[adapter], _RAW[adapter])}) q"""


def q_time_features(adapter: str) -> Query:
    def run(spark, sf):
        spec = _SPECS[adapter]
        return make_time_features(ADAPTERS[adapter](spark, sf), spec)

    return run


def sql_time_features(adapter: str) -> str:
    spec = _SPECS[adapter]
    cols = ", ".join(_RAW[adapter])
    return f"""select {cols}, {spec.hour_col}, {spec.weekday_col}, {spec.month_col}, {spec.duration_col}
  from (select *, {S.time_features_sql(spec)} from ({adapter_sql(adapter)}) t) x"""


def q_clean(adapter: str) -> Query:
    def run(spark, sf):
        spec = _SPECS[adapter]
        return prepare(ADAPTERS[adapter](spark, sf), spec).df

    return run


def sql_clean(adapter: str) -> str:
    spec = _SPECS[adapter]
    cols = _RAW[adapter] + [spec.hour_col, spec.weekday_col, spec.month_col]
    with_coords = bool(spec.coordinates)
    return f"""with trips as ({adapter_sql(adapter)}), {S.clean_ctes('trips', spec, _RAW[adapter], with_coords)}
select {', '.join(cols)}, {spec.duration_col} from c_final"""


MIN_SUPPORT, MIN_CONFIDENCE, TOP_K = 0.05, 0.6, 5


def _prepared_batches(spark, sf, adapter):
    """Union of all kept batches (batch key kept, so cross-batch duplicates survive), prepared."""
    b, spec = _batched_once(spark, sf, adapter)
    return kept_table(prepare(b, spec).df, "prepared"), spec, b


def q_q75(adapter: str) -> Query:
    def run(spark, sf):
        p, spec, _ = _prepared_batches(spark, sf, adapter)
        thr = R.q75_thresholds(p, spec)
        names = {spec.distance: "q75_trip_distance", spec.duration_col: "q75_trip_duration", spec.target: "q75_total_amount"}
        return spark.range(1).select(*[F.lit(thr[c]).cast("double").alias(n) for c, n in names.items()])

    return run


def sql_q75(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"""with {S.rules_ctes(adapter, spec, R.ITEMS, MIN_SUPPORT)}
select qd q75_trip_distance, qu q75_trip_duration, qt q75_total_amount from q"""


def q_conditions(adapter: str) -> Query:
    def run(spark, sf):
        p, spec, _ = _prepared_batches(spark, sf, adapter)
        return R.binary_conditions(p, spec).df

    return run


def sql_conditions(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"with {S.rules_ctes(adapter, spec, R.ITEMS, MIN_SUPPORT)} select * from cond"


def q_itemsets(adapter: str) -> Query:
    def run(spark, sf):
        p, spec, _ = _prepared_batches(spark, sf, adapter)
        found = R.frequent_itemsets(R.binary_conditions(p, spec), MIN_SUPPORT)
        bit = F.create_map(*[x for i, it in enumerate(R.ITEMS) for x in (F.lit(it), F.lit(1 << i).cast("long"))])
        mask = F.aggregate("itemset", F.lit(0).cast("long"), lambda acc, x: acc + F.element_at(bit, x))
        return found.withColumn("itemset", mask)

    return run


def sql_itemsets(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"""with {S.rules_ctes(adapter, spec, R.ITEMS, MIN_SUPPORT)}
select itemset, {S.items_text_sql('itemset', R.ITEMS)} items, cnt "count", support from fi"""


def q_rules(adapter: str, top: int | None = None) -> Query:
    def run(spark, sf):
        p, spec, _ = _prepared_batches(spark, sf, adapter)
        rules, _, _ = R.mine_rules(p, spec, MIN_SUPPORT, MIN_CONFIDENCE)
        return R.top_rules(rules, top) if top else rules

    return run


def sql_rules(adapter: str, top: int | None = None) -> str:
    body = S.rules_sql(adapter, _SPECS[adapter], R.ITEMS, MIN_SUPPORT, MIN_CONFIDENCE)
    if not top:
        return body
    return f"""select * from ({body}) r
order by round(lift, 9) desc, round(confidence, 9) desc, round(support, 9) desc, rule limit {top}"""


def q_rules_config(adapter: str) -> Query:
    def run(spark, sf):
        p, spec, b = _prepared_batches(spark, sf, adapter)
        return R.rules_config(p, spec, MIN_SUPPORT, MIN_CONFIDENCE)

    return run


def sql_rules_config(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"""with {S.rules_ctes(adapter, spec, R.ITEMS, MIN_SUPPORT)}
select cast({MIN_SUPPORT} as double) min_support, cast({MIN_CONFIDENCE} as double) min_confidence, count(distinct {spec.batch_col}) batch_count,
       count(*) row_count from c_final"""


# ---- split, fit statistics, preprocessing, metrics (lineitem trips: 342 weekly batches) ----


def _split_prepared(spark, sf, adapter="trips_li"):
    b, spec = _batched_once(spark, sf, adapter)  # the windows and joins behind the rows are done once
    p = prepare_split(b, spec)
    return p.train, p.test, spec


def _split_sql(adapter: str, spec: TableSpec) -> str:
    k = spec.batch_col
    clean_tr = S.clean_ctes("tr_raw", spec, [], bool(spec.coordinates))
    clean_te = S.clean_ctes("te_raw", spec, [], bool(spec.coordinates)).replace("c0 as", "d0 as")
    for i in range(7):
        clean_te = clean_te.replace(f"c{i}", f"d{i}")
    clean_te = clean_te.replace("c_final", "d_final")
    return f"""{S.batched_ctes(adapter, spec)},
mx as (select max({k}) m from bb),
tr_raw as (select * from bb where {k} < (select m from mx)),
te_raw as (select * from bb where {k} = (select m from mx)),
{clean_tr},
{clean_te},
tr as (select * from c_final), te as (select * from d_final)"""


def q_holdout(adapter: str) -> Query:
    def run(spark, sf):
        tr, te, spec = _split_prepared(spark, sf, adapter)
        agg = [F.count_distinct(spec.batch_col).alias("batches"), F.count(F.lit(1)).alias("rows")]
        return tr.agg(F.lit("train").alias("side"), *agg).unionByName(te.agg(F.lit("test").alias("side"), *agg))

    return run


def sql_holdout(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"""with {_split_sql(adapter, spec)}
select 'train' side, count(distinct {spec.batch_col}) batches, count(*) "rows" from tr
union all select 'test', count(distinct {spec.batch_col}), count(*) from te"""


def q_tail(adapter: str) -> Query:
    def run(spark, sf):
        tr, _, spec = _split_prepared(spark, sf, adapter)
        return tail_split(tr, spec).validation

    return run


def sql_tail(adapter: str) -> str:
    spec = _SPECS[adapter]
    probe = ADAPTERS_COLS[adapter]
    order = [spec.batch_col, spec.event_ts, spec.end_ts] + sorted(
        c for c in probe + list(spec.generated) if c not in (spec.batch_col, spec.event_ts, spec.end_ts)
    )
    desc = ", ".join(f"{c} desc nulls last" for c in order)
    return f"""with {_split_sql(adapter, spec)},
n as (select count(*) n from tr)
select * exclude (rn) from (select *, row_number() over (order by {desc}) rn from tr) t
where rn <= (select case when n < 2000 then n - least(greatest(greatest(1, cast(floor(n * 0.8) as bigint)), 1), n - 1)
                         else n - least(greatest(n - 1000, 1), n - 1) end from n)"""


def q_fit_stats(adapter: str) -> Query:
    def run(spark, sf):
        tr, _, spec = _split_prepared(spark, sf, adapter)
        return stats_frame(tr, spec)

    return run


def sql_fit_stats(adapter: str) -> str:
    spec = _SPECS[adapter]
    meds = " union all ".join(
        f"select '{c}' feature, 'median' stat, cast(quantile_cont({c}, 0.5) as double) num_value, "
        f"cast(null as varchar) text_value from tr"
        for c in spec.numerical
    )
    pairs = " union all ".join(
        f"select '{c}' col, cast(cast({c} as bigint) as varchar) val, cast({c} as bigint) nk from tr"
        if c in NUMERIC_CATS
        else f"select '{c}' col, {c} val, cast(null as bigint) nk from tr"
        for c in spec.categorical
    )
    return f"""with {_split_sql(adapter, spec)},
pairs as ({pairs}),
cnt as (select col, val, nk, count(*) n from pairs where val is not null group by all)
{meds}
union all
select col feature, 'mode' stat, cast(null as double) num_value,
       first(val order by n desc, nk asc nulls first, val asc) text_value
from cnt group by col"""


def _cat_sql(c: str, fill: str) -> str:
    txt = f"cast(cast({c} as bigint) as varchar)" if c in NUMERIC_CATS else c
    return f"coalesce({txt}, {fill}) {c}"


def q_boost_frame(adapter: str) -> Query:
    def run(spark, sf):
        tr, te, spec = _split_prepared(spark, sf, adapter)
        st = fit_stats(tr, spec)
        return boosting_frame(te, st).select(*spec.features, spec.target)

    return run


def sql_boost_frame(adapter: str) -> str:
    spec = _SPECS[adapter]
    cols = []
    for c in spec.features:
        if c in spec.categorical:
            cols.append(_cat_sql(c, "'missing'"))
        else:
            cols.append(f"coalesce(cast({c} as double), (select quantile_cont({c}, 0.5) from tr)) {c}")
    return f"""with {_split_sql(adapter, spec)}
select {', '.join(cols)}, {spec.target} from te"""


def q_scaled(adapter: str) -> Query:
    def run(spark, sf):
        tr, te, spec = _split_prepared(spark, sf, adapter)
        st = fit_stats(tr, spec, scale=True)
        out = mlp_frame(te, st).select(*spec.features, spec.target)
        return _r(out, list(spec.numerical))

    return run


def sql_scaled(adapter: str) -> str:
    spec = _SPECS[adapter]
    imp_tr = ", ".join(
        f"coalesce(cast({c} as double), (select quantile_cont({c}, 0.5) from tr)) {c}" for c in spec.numerical
    )
    stats = ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) s_{c}" for c in spec.numerical)
    cols = []
    for c in spec.features:
        if c in spec.categorical:
            mode = (
                f"(select first(v order by n desc, nk asc nulls first, v asc) from (select "
                f"{'cast(cast(' + c + ' as bigint) as varchar)' if c in NUMERIC_CATS else c} v, "
                f"{'cast(' + c + ' as bigint)' if c in NUMERIC_CATS else 'cast(null as bigint)'} nk, count(*) n "
                f"from tr where {c} is not null group by all) z)"
            )
            cols.append(_cat_sql(c, mode))
        else:
            x = f"coalesce(cast({c} as double), (select quantile_cont({c}, 0.5) from tr))"
            sd = f"(select case when s_{c} = 0 or s_{c} is null then 1.0 else s_{c} end from st)"
            cols.append(f"round(({x} - (select m_{c} from st)) / {sd}, 6) {c}")
    return f"""with {_split_sql(adapter, spec)},
tri as (select {imp_tr} from tr),
st as (select {stats} from tri)
select {', '.join(cols)}, {spec.target} from te"""


def q_median_baseline(adapter: str) -> Query:
    def run(spark, sf):
        tr, te, spec = _split_prepared(spark, sf, adapter)
        med = quantile(tr, spec.target, 0.5)
        m = regression_metrics(te.withColumn("prediction", F.lit(med)), spec.target)
        return _r(m, ["mae", "rmse", "r2"])

    return run


def sql_median_baseline(adapter: str) -> str:
    spec = _SPECS[adapter]
    y = spec.target
    return f"""with {_split_sql(adapter, spec)},
p as (select {y} y, (select quantile_cont({y}, 0.5) from tr) p from te where {y} is not null),
a as (select count(*) "rows", avg(abs(y - p)) mae, sqrt(avg((y - p) * (y - p))) rmse,
             sum((y - p) * (y - p)) sse, var_pop(y) * count(*) sst from p)
select "rows", round(mae, 6) mae, round(rmse, 6) rmse,
       round(case when sst > 0 then 1 - sse / sst when sse = 0 then 1.0 else 0.0 end, 6) r2
from a where "rows" > 0"""


# ---- batch names, rule report text ----


def q_parse_names(adapter: str) -> Query:
    def run(spark, sf):
        b, spec = _batched(spark, sf, adapter)
        names = batch_list(b, spec)
        start, end = parse_batch_range(F.col("batch_name"))
        return names.select("batch_name", start.alias("start_date"), end.alias("end_date"))

    return run


def sql_parse_names(adapter: str) -> str:
    body = S.batch_list_sql(adapter, _SPECS[adapter])
    return f"""select batch_name,
  coalesce(try_cast(regexp_extract(batch_name, '_([^_]+)_[^_]+$', 1) as date), date '9999-12-31') start_date,
  coalesce(try_cast(regexp_extract(batch_name, '_([^_]+)$', 1) as date), date '9999-12-31') end_date
from ({body}) n"""


def q_rules_report(adapter: str, top: int) -> Query:
    def run(spark, sf):
        top_df = q_rules(adapter, top)(spark, sf)
        return top_df.select("rule", *[fixed4(c).alias(f"{c}_text") for c in ("support", "confidence", "lift")])

    return run


def sql_rules_report(adapter: str, top: int) -> str:
    return f"""select rule, printf('%.4f', support) support_text, printf('%.4f', confidence) confidence_text,
  printf('%.4f', lift) lift_text from ({sql_rules(adapter, top)}) t"""


# ---- learning operators (rows-only checks: no SQL oracle for a fitted model) ----


def q_model_predictions(adapter: str, kind: str) -> Query:
    def run(spark, sf):
        from batchlens.models.mlp import MLPModel
        from batchlens.models.trees import BoostModel, TreeModel

        tr, te, spec = _split_prepared(spark, sf, adapter)
        if kind == "tree":
            m = TreeModel.fit(tr, spec)  # the reference's default tree parameters
        elif kind == "boost":
            m = BoostModel.fit(tr, spec, {"iterations": 200, "depth": 6, "learning_rate": 0.1})
        else:
            m = MLPModel.fit(tr, spec)  # default architecture, early stopping
        return m.predict(te).select(*spec.features, spec.target, "prediction")

    return run


def q_profile_named(adapter: str) -> Query:
    def run(spark, sf):
        from batchlens.plans.train import profile_batches

        b, spec = _batched(spark, sf, adapter)
        return _r(profile_batches(b, spec), Q99)

    return run


def sql_profile_named(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"""select q.*, n.batch_name from ({sql_quality(adapter)}) q
join ({S.batch_list_sql(adapter, spec)}) n using ({spec.batch_col})"""


def q_rules_first(adapter: str, n: int) -> Query:
    def run(spark, sf):
        from batchlens.plans.train import generate_rules

        b, spec = _batched_once(spark, sf, adapter)
        return generate_rules(b, spec, MIN_SUPPORT, MIN_CONFIDENCE, max_batches=n)["rules"]

    return run


# ---- logs, ledger and files: the log is a record for each batch, out of the given tables ----

MODELS = ("boost", "tree", "mlp")


def _log(spark, sf, adapter):
    b, spec = _batched(spark, sf, adapter)
    key = F.element_at(F.array(*[F.lit(m) for m in MODELS]), (F.col("batch_index") % 3 + 1).cast("int"))
    return batch_list(b, spec).select(
        "batch_index", "batch_name", F.col("pickup_max").alias("created_at"), key.alias("model_key"),
        F.col("row_count").cast("double").alias("test_rmse"), (F.col("batch_index") % 4 == 0).alias("is_best"),
    )


def _log_sql(adapter: str) -> str:
    keys = ", ".join(f"'{m}'" for m in MODELS)
    return f"""select batch_index, batch_name, pickup_max created_at, [{keys}][batch_index % 3 + 1] model_key,
  cast(row_count as double) test_rmse, batch_index % 4 = 0 is_best from ({S.batch_list_sql(adapter, _SPECS[adapter])}) n"""


def q_best_records(adapter: str) -> Query:
    return lambda spark, sf: best_records(_log(spark, sf, adapter))


def q_latest_record(adapter: str) -> Query:
    return lambda spark, sf: latest_record(_log(spark, sf, adapter), "created_at")


def q_latest_per_model(adapter: str) -> Query:
    return lambda spark, sf: latest_per(_log(spark, sf, adapter), "model_key", "created_at")


def q_argmin(adapter: str) -> Query:
    return lambda spark, sf: argmin(_log(spark, sf, adapter), "test_rmse", "batch_index")


def q_training_history(adapter: str) -> Query:
    return lambda spark, sf: history(_log(spark, sf, adapter), ["created_at", "model_key", "test_rmse", "is_best"])


def q_pending(adapter: str) -> Query:
    """The ledger lacks every third batch and knows the others up to epoch 2; batches have epochs 0 to 4."""

    def run(spark, sf):
        log = _log(spark, sf, adapter)
        table = log.select(F.col("batch_name").alias("batch_id"), "batch_index", (F.col("batch_index") % 5).cast("long").alias("upto_epoch"))
        done = table.where("batch_index % 3 <> 0").select("batch_id", F.lit(2).cast("long").alias("done_epoch"))
        return pending_batches(table, done)

    return run


def sql_pending(adapter: str) -> str:
    return f"""with t as (select batch_name batch_id, batch_index, batch_index % 5 upto_epoch from ({_log_sql(adapter)}) l),
d as (select batch_id, cast(2 as bigint) done_epoch from t where batch_index % 3 <> 0)
select t.*, d.done_epoch from t left join d using (batch_id) where done_epoch is null or upto_epoch > done_epoch"""


def q_union_logs(adapter: str) -> Query:
    def run(spark, sf):
        log = _log(spark, sf, adapter)
        old = log.where("batch_index % 2 = 0").select("batch_name", "model_key")
        return old.unionByName(log.where("batch_index % 2 = 1").select("batch_name", "test_rmse"), allowMissingColumns=True)

    return run


def sql_union_logs(adapter: str) -> str:
    return f"""with l as ({_log_sql(adapter)})
select batch_name, model_key from l where batch_index % 2 = 0 union all by name select batch_name, test_rmse from l where batch_index % 2 = 1"""


def q_metrics_null_targets(adapter: str) -> Query:
    """A constant prediction against a target that is missing where the passengers are."""

    def run(spark, sf):
        spec = _SPECS[adapter]
        df = ADAPTERS[adapter](spark, sf)
        y = F.when(F.col(spec.passengers).isNotNull(), F.col(spec.target))
        return _r(regression_metrics(df.select(y.alias("y"), F.lit(100.0).alias("prediction")), "y"), ["mae", "rmse", "r2"])

    return run


def sql_metrics_null_targets(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"""with p as (select {spec.target} y, 100.0::double p from ({adapter_sql(adapter)}) t where {spec.passengers} is not null and {spec.target} is not null)
select count(*) "rows", round(avg(abs(y - p)), 6) mae, round(sqrt(avg((y - p) * (y - p))), 6) rmse,
  round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) r2 from p"""


def q_model_columns(adapter: str) -> Query:
    def run(spark, sf):
        spec = _SPECS[adapter]
        return model_columns(prepare(ADAPTERS[adapter](spark, sf), spec).df, spec)

    return run


def sql_model_columns(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"select {', '.join([*spec.features, spec.target])} from ({sql_clean(adapter)}) c"


def q_own_medians(adapter: str) -> Query:
    """The held-out batch filled from its own medians."""

    def run(spark, sf):
        _, te, spec = _split_prepared(spark, sf, adapter)
        return boosting_frame(te, fit_stats(te, spec)).select(*spec.features, spec.target)

    return run


def sql_own_medians(adapter: str) -> str:
    return sql_boost_frame(adapter).replace("from tr)", "from te)")


def q_na_text(adapter: str) -> Query:
    return lambda spark, sf: ADAPTERS[adapter](spark, sf).select(text_or_na("store_flag").alias("store_flag"), text_or_na("passenger_count").alias("passengers"))


def sql_na_text(adapter: str) -> str:
    return f"""select coalesce(store_flag, 'n/a') store_flag, coalesce(cast(passenger_count as varchar), 'n/a') passengers
from ({adapter_sql(adapter)}) t"""


def _as_text(spark, sf, adapter):
    """Event trips as text, with every 7th start time, 11th target and 13th distance spoilt."""
    c = F.col
    return ADAPTERS[adapter](spark, sf).select(
        "event_id",
        F.when(c("event_id") % 7 == 0, "soon").otherwise(F.date_format("pickup_ts", "yyyy-MM-dd HH:mm:ss")).alias("pickup_ts"),
        F.date_format("dropoff_ts", "yyyy-MM-dd HH:mm:ss").alias("dropoff_ts"),
        F.when(c("event_id") % 11 == 0, "n/a").otherwise(F.floor("total_amount").cast("string")).alias("total_amount"),
        F.when(c("event_id") % 13 == 0, "NaN").otherwise(F.floor("trip_distance").cast("string")).alias("trip_distance"),
    )


def _csv_folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"


def q_lenient_load(adapter: str) -> Query:
    """The spoilt text as CSV batch files, read back."""

    def run(spark, sf):
        root = _csv_folder(spark)
        _as_text(spark, sf, adapter).write.option("header", True).csv(root)
        return read_batch_files(spark, root, _SPECS[adapter]).drop("source_batch").withColumn("event_id", F.col("event_id").cast("long"))

    return run


def q_csv_trips(adapter: str) -> Query:
    """Trips as CSV files of two kinds: one lacks a column, has one more with a comma in its name, and all in another order."""

    def run(spark, sf):
        root, rows = _csv_folder(spark), ADAPTERS[adapter](spark, sf)
        one, two = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 <> 0")
        form = {"header": True, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
        one.write.options(**form).csv(f"{root}/one")
        two = two.withColumn("note, quoted", F.concat(F.lit('a "b", '), F.col("event_id").cast("string")))
        two.select(*sorted((c for c in two.columns if c != "store_flag"), reverse=True)).write.options(**form).csv(f"{root}/two")
        out = read_trips(spark, root, _SPECS[adapter])
        return out.withColumns({c: F.col(c).cast("long") for c in ("event_id", "user_id")}).withColumnRenamed("note, quoted", "note")

    return run


def sql_csv_trips(adapter: str) -> str:
    return f"""select * replace (case when event_id % 2 = 0 then store_flag end as store_flag, cast(passenger_count as double) as passenger_count),
  case when event_id % 2 <> 0 then 'a "b", ' || event_id end note from ({adapter_sql(adapter)}) t"""


def q_parse_timestamps(adapter: str) -> Query:
    return lambda spark, sf: _as_text(spark, sf, adapter).select("event_id", parse_ts("pickup_ts").alias("pickup_ts"))


def sql_lenient_load(adapter: str) -> str:
    return f"""select event_id, case when event_id % 7 <> 0 then date_trunc('second', pickup_ts) end pickup_ts,
  date_trunc('second', dropoff_ts) dropoff_ts, case when event_id % 11 <> 0 then floor(total_amount) end total_amount,
  case when event_id % 13 <> 0 then floor(trip_distance) end trip_distance from ({adapter_sql(adapter)}) t"""


def q_learns(adapter: str, kind: str) -> Query:
    """Rows of the held-out batch and whether the model's error there is under half the target's deviation."""

    def run(spark, sf):
        from batchlens.models.mlp import MLPModel
        from batchlens.models.trees import BoostModel, TreeModel

        tr, te, spec = _split_prepared(spark, sf, adapter)
        fit = {
            "tree": lambda: TreeModel.fit(tr, spec),
            "boost": lambda: BoostModel.fit(tr, spec, {"iterations": 30, "depth": 6, "learning_rate": 0.1}),
            "mlp": lambda: MLPModel.fit(tr, spec),
        }[kind]
        pred = fit().predict(te).where(F.col(spec.target).isNotNull())
        error = F.sqrt(F.avg((F.col("prediction") - F.col(spec.target)) ** 2))
        return pred.agg(F.count(F.lit(1)).alias("rows"), (error < 0.5 * F.stddev_pop(spec.target)).alias("learned"))

    return run


def sql_learns(adapter: str) -> str:
    spec = _SPECS[adapter]
    return f"""with {_split_sql(adapter, spec)}
select count(*) "rows", true learned from te where {spec.target} is not null"""


def q_rules_low(adapter: str) -> Query:
    def run(spark, sf):
        p, spec, _ = _prepared_batches(spark, sf, adapter)
        return R.mine_rules(p, spec, 0.01, 0.2)[0]

    return run


SEEN_COLS = ["trip_distance", "passenger_count", "vendor_id", "ratecode_id", "store_flag"]


def q_seen_before(adapter: str) -> Query:
    """Batches of the later half of the time against the fingerprints of the earlier half."""

    def run(spark, sf):
        from batchlens.sources.fingerprints import Fingerprints

        b, spec = _batched(spark, sf, adapter)
        k = F.col(spec.batch_col)
        b = kept_table(b.select(k, *SEEN_COLS), "batches")
        lo, hi = b.agg(F.min(k), F.max(k)).first()
        middle = F.lit(lo + (hi - lo) // 2)
        seen = Fingerprints(spark, f"{ensure_checkpoint_dir(spark)}/fingerprints-{uuid.uuid4().hex}", SEEN_COLS, 16)
        seen.add(b.where(k <= middle))
        return seen.compare(b.where(k > middle), [spec.batch_col])

    return run


def sql_seen_before(adapter: str) -> str:
    spec = _SPECS[adapter]
    k, cols = spec.batch_col, ", ".join(SEEN_COLS)
    same = " and ".join(f"o.{c} is not distinct from n.{c}" for c in SEEN_COLS)
    return f"""with {S.batched_ctes(adapter, spec)},
mid as (select min({k}) + cast((max({k}) - min({k})) // 2 as integer) m from bb),
old as (select distinct {cols} from bb where {k} <= (select m from mid)),
new as (select {k}, {cols}, count(*) c from bb where {k} > (select m from mid) group by all),
told as (select n.*, exists (select 1 from old o where {same}) seen from new n)
select {k}, cast(sum(c) as bigint) row_count, cast(sum(case when seen then c else 0 end) as bigint) seen_rows,
  count(*) filter (where not seen) new_rows from told group by {k}"""


def q_closed_weeks(adapter: str) -> Query:
    """The trips landed as files and streamed; weeks that the watermark closed."""

    def run(spark, sf):
        from batchlens.streaming.stream import write_closed_weeks

        spec, root = _SPECS[adapter], f"{ensure_checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"
        rows = ADAPTERS[adapter](spark, sf).na.drop(subset=[spec.event_ts, spec.end_ts])  # as batches are cut
        rows = rows.unionByName(rows.where("event_id % 50 = 0"))
        rows.write.parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        write_closed_weeks(stream, spec, f"{root}/out", f"{root}/state")
        return spark.read.parquet(f"{root}/out")

    return run


def sql_closed_weeks(adapter: str) -> str:
    spec = _SPECS[adapter]
    doubled = f"(select * from ({adapter_sql(adapter)}) a union all select * from ({adapter_sql(adapter)}) b where event_id % 50 = 0)"
    counts = [
        "batch_start", "row_count", "missing_total", "duplicate_count", "negative_trip_distance_count", "negative_target_count",
        "invalid_duration_count", "invalid_coordinate_count",
    ]
    profile = S.quality_profile_sql(adapter, spec, _RAW[adapter]).replace(f"({adapter_sql(adapter)})", doubled)
    return f"""select {', '.join(counts)} from ({profile}) q
where batch_start + interval 7 days <= (select max({spec.event_ts}) - interval 1 day from ({adapter_sql(adapter)}) t where {spec.end_ts} is not null)"""


def queries() -> dict[str, Query]:
    return {
        "a9_quality_profile_li": q_quality("trips_li"),
        "a9_quality_profile_li_dup": q_quality("trips_li_dup"),
        "a9_quality_profile_ev": q_quality("trips_ev"),
        "w1_batch_list_li": q_batch_list("trips_li"),
        "w1_batch_list_ev": q_batch_list("trips_ev"),
        "a2_batch_meta_li_dup": q_batch_meta("trips_li_dup"),
        "a14_quality_totals_li_dup": q_quality_totals("trips_li_dup"),
        "p1_time_features_ev": q_time_features("trips_ev"),
        "clean_trips_li_dup": q_clean("trips_li_dup"),
        "clean_trips_ev": q_clean("trips_ev"),
        "a10_q75_thresholds_ev": q_q75("trips_ev"),
        "p6_conditions_ev": q_conditions("trips_ev"),
        "a11_itemsets_ev": q_itemsets("trips_ev"),
        "a11_itemsets_li_dup": q_itemsets("trips_li_dup"),
        "a12_rules_ev": q_rules("trips_ev"),
        "a12_rules_li_dup": q_rules("trips_li_dup"),
        "k4_top_rules_li_dup": q_rules("trips_li_dup", TOP_K),
        "s16_rules_config_ev": q_rules_config("trips_ev"),
        "w2_holdout_li": q_holdout("trips_li"),
        "w3_tail_validation_li": q_tail("trips_li"),
        "a16_fit_stats_li": q_fit_stats("trips_li"),
        "p7_boosting_frame_li": q_boost_frame("trips_li"),
        "p15_scaled_features_li": q_scaled("trips_li"),
        "a13_median_baseline_li": q_median_baseline("trips_li"),
        "w3_tail_validation_ev": q_tail("trips_ev"),
        "a16_fit_stats_ev": q_fit_stats("trips_ev"),
        "p7_boosting_frame_ev": q_boost_frame("trips_ev"),
        "p15_scaled_features_ev": q_scaled("trips_ev"),
        "a13_median_baseline_ev": q_median_baseline("trips_ev"),
        "p11_parse_batch_names_li": q_parse_names("trips_li"),
        "g7_profile_batches_li_dup": q_profile_named("trips_li_dup"),
        "f14_rules_first_batches_li_dup": q_rules_first("trips_li_dup", 150),
        "x19_rules_report_li_dup": q_rules_report("trips_li_dup", TOP_K),
        "a12_rules_low_ev": q_rules_low("trips_ev"),
        "f9_metrics_null_targets_li": q_metrics_null_targets("trips_li"),
        "f10_best_records_li": q_best_records("trips_li"),
        "f13_pending_batches": q_pending("trips_li"),
        "a15_argmin_li": q_argmin("trips_li"),
        "w4_latest_record_li": q_latest_record("trips_li"),
        "w5_latest_per_model_li": q_latest_per_model("trips_li"),
        "g3_training_history_li": q_training_history("trips_li"),
        "u4_union_logs_li": q_union_logs("trips_li"),
        "p3_model_columns_ev": q_model_columns("trips_ev"),
        "p8_own_medians_ev": q_own_medians("trips_ev"),
        "p13_na_text_li": q_na_text("trips_li"),
        "x1_parse_timestamps": q_parse_timestamps("trips_ev"),
        "s2_lenient_load": q_lenient_load("trips_ev"),
        "s1_csv_trips": q_csv_trips("trips_ev"),
        "u2_seen_before_li_dup": q_seen_before("trips_li_dup"),
        "m8_closed_weeks_ev": q_closed_weeks("trips_ev"),
        "l1_tree_learns": q_learns("trips_signal", "tree"),
        "l3_boost_learns": q_learns("trips_signal", "boost"),
        "l5_mlp_learns": q_learns("trips_signal", "mlp"),
        "l1_tree_predictions_ev": q_model_predictions("trips_ev", "tree"),
        "l3_boost_predictions_ev": q_model_predictions("trips_ev", "boost"),
        "l5_mlp_predictions_ev": q_model_predictions("trips_ev", "mlp"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "a9_quality_profile_li": sql_quality("trips_li"),
        "a9_quality_profile_li_dup": sql_quality("trips_li_dup"),
        "a9_quality_profile_ev": sql_quality("trips_ev"),
        "w1_batch_list_li": S.batch_list_sql("trips_li", TRIPS_LI),
        "w1_batch_list_ev": S.batch_list_sql("trips_ev", TRIPS_EV),
        "a2_batch_meta_li_dup": S.batch_meta_sql("trips_li_dup", TRIPS_LI, LI_RAW),
        "a14_quality_totals_li_dup": sql_quality_totals("trips_li_dup"),
        "p1_time_features_ev": sql_time_features("trips_ev"),
        "clean_trips_li_dup": sql_clean("trips_li_dup"),
        "clean_trips_ev": sql_clean("trips_ev"),
        "a10_q75_thresholds_ev": sql_q75("trips_ev"),
        "p6_conditions_ev": sql_conditions("trips_ev"),
        "a11_itemsets_ev": sql_itemsets("trips_ev"),
        "a11_itemsets_li_dup": sql_itemsets("trips_li_dup"),
        "a12_rules_ev": sql_rules("trips_ev"),
        "a12_rules_li_dup": sql_rules("trips_li_dup"),
        "k4_top_rules_li_dup": sql_rules("trips_li_dup", TOP_K),
        "s16_rules_config_ev": sql_rules_config("trips_ev"),
        "w2_holdout_li": sql_holdout("trips_li"),
        "w3_tail_validation_li": sql_tail("trips_li"),
        "a16_fit_stats_li": sql_fit_stats("trips_li"),
        "p7_boosting_frame_li": sql_boost_frame("trips_li"),
        "p15_scaled_features_li": sql_scaled("trips_li"),
        "a13_median_baseline_li": sql_median_baseline("trips_li"),
        "w3_tail_validation_ev": sql_tail("trips_ev"),
        "a16_fit_stats_ev": sql_fit_stats("trips_ev"),
        "p7_boosting_frame_ev": sql_boost_frame("trips_ev"),
        "p15_scaled_features_ev": sql_scaled("trips_ev"),
        "a13_median_baseline_ev": sql_median_baseline("trips_ev"),
        "p11_parse_batch_names_li": sql_parse_names("trips_li"),
        "g7_profile_batches_li_dup": sql_profile_named("trips_li_dup"),
        "f14_rules_first_batches_li_dup": S.rules_sql(
            "trips_li_dup", TRIPS_LI, R.ITEMS, MIN_SUPPORT, MIN_CONFIDENCE, max_batches=150
        ),
        "x19_rules_report_li_dup": sql_rules_report("trips_li_dup", TOP_K),
        "a12_rules_low_ev": S.rules_sql("trips_ev", TRIPS_EV, R.ITEMS, 0.01, 0.2),
        "f9_metrics_null_targets_li": sql_metrics_null_targets("trips_li"),
        "f10_best_records_li": f"select * from ({_log_sql('trips_li')}) l where is_best",
        "f13_pending_batches": sql_pending("trips_li"),
        "a15_argmin_li": f"select * from ({_log_sql('trips_li')}) l order by test_rmse, batch_index limit 1",
        "w4_latest_record_li": f"select * from ({_log_sql('trips_li')}) l order by created_at desc limit 1",
        "w5_latest_per_model_li": f"select * from ({_log_sql('trips_li')}) l qualify row_number() over (partition by model_key order by created_at desc) = 1",
        "g3_training_history_li": f"select created_at, model_key, test_rmse, is_best from ({_log_sql('trips_li')}) l",
        "u4_union_logs_li": sql_union_logs("trips_li"),
        "p3_model_columns_ev": sql_model_columns("trips_ev"),
        "p8_own_medians_ev": sql_own_medians("trips_ev"),
        "p13_na_text_li": sql_na_text("trips_li"),
        "x1_parse_timestamps": f"select event_id, pickup_ts from ({sql_lenient_load('trips_ev')}) t",
        "s2_lenient_load": sql_lenient_load("trips_ev"),
        "s1_csv_trips": sql_csv_trips("trips_ev"),
        "u2_seen_before_li_dup": sql_seen_before("trips_li_dup"),
        "m8_closed_weeks_ev": sql_closed_weeks("trips_ev"),
        "l1_tree_learns": sql_learns("trips_signal"),
        "l3_boost_learns": sql_learns("trips_signal"),
        "l5_mlp_learns": sql_learns("trips_signal"),
    }
