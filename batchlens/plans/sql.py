"""DuckDB SQL for the oracle side, generated from the same ``TableSpec`` the Spark operators use."""

from __future__ import annotations

from batchlens.sources.fixtures import adapter_sql
from batchlens.spec import TableSpec


def time_features_sql(spec: TableSpec) -> str:
    ts, end = spec.event_ts, spec.end_ts
    return (
        f"hour({ts}) {spec.hour_col}, isodow({ts}) - 1 {spec.weekday_col}, month({ts}) {spec.month_col}, "
        f"date_diff('microsecond', {ts}, {end}) / 60000000.0 {spec.duration_col}"
    )


def batched_ctes(adapter: str, spec: TableSpec) -> str:
    """CTEs ``trips`` (adapter) and ``bb`` (rows of kept weekly batches with ``batch_start``)."""
    return f"""trips as ({adapter_sql(adapter)}),
b as (select *, cast(date_trunc('{spec.batch_freq}', {spec.event_ts}) as date) {spec.batch_col}
      from trips where {spec.event_ts} is not null and {spec.end_ts} is not null),
kept as (select {spec.batch_col} from b group by 1 having count(*) >= {spec.min_batch_rows}),
bb as (select * from b where {spec.batch_col} in (select {spec.batch_col} from kept))"""


def null_cells_sql(cols) -> str:
    return " + ".join(f"cast({c} is null as integer)" for c in cols)


def coords_invalid_sql(spec: TableSpec) -> str:
    if not spec.coordinates:
        return "0"
    bad = " or ".join(f"not ({b.column} between {b.lo} and {b.hi})" for b in spec.coordinates)
    return f"count(*) filter (where coalesce({bad}, true))"


def quality_profile_sql(adapter: str, spec: TableSpec, raw_cols: list[str]) -> str:
    cols = raw_cols + list(spec.generated)
    k = spec.batch_col
    dist = spec.distance
    return f"""with {batched_ctes(adapter, spec)},
f as (select *, {time_features_sql(spec)} from bb),
main as (
  select {k}, count(*) row_count,
         cast(sum({null_cells_sql(cols)}) as bigint) missing_total,
         count(*) filter (where {dist} < 0) negative_trip_distance_count,
         count(*) filter (where {spec.target} < 0) negative_target_count,
         count(*) filter (where {spec.duration_col} is null or {spec.duration_col} <= 0) invalid_duration_count,
         cast({coords_invalid_sql(spec)} as bigint) invalid_coordinate_count,
         quantile_cont({dist}, 0.99) trip_distance_q99,
         quantile_cont({spec.target}, 0.99) target_q99,
         quantile_cont({spec.duration_col}, 0.99) duration_q99
  from f group by {k}),
dups as (select {k}, cast(sum(n - 1) as bigint) duplicate_count
         from (select {k}, {', '.join(raw_cols)}, count(*) n from bb group by all) g group by {k})
select main.*, dups.duplicate_count from main join dups using ({k})"""


def batch_list_sql(adapter: str, spec: TableSpec) -> str:
    k = spec.batch_col
    return f"""with {batched_ctes(adapter, spec)},
per as (select {k}, count(*) row_count, min({spec.event_ts}) pickup_min, max({spec.event_ts}) pickup_max
        from bb group by {k}),
o as (select *, row_number() over (order by {k}) batch_index from per)
select {k}, batch_index,
       'batch_' || lpad(cast(batch_index as varchar), 4, '0') || '_' || strftime(pickup_min, '%Y-%m-%d')
         || '_' || strftime(pickup_max, '%Y-%m-%d') batch_name,
       row_count, pickup_min, pickup_max
from o"""


def batch_meta_sql(adapter: str, spec: TableSpec, raw_cols: list[str]) -> str:
    k = spec.batch_col
    return f"""with {batched_ctes(adapter, spec)},
per as (select {k}, count(*) row_count, {len(raw_cols)} column_count,
               strftime(min({spec.event_ts}), '%Y-%m-%dT%H:%M:%S') pickup_min,
               strftime(max({spec.event_ts}), '%Y-%m-%dT%H:%M:%S') pickup_max,
               cast(sum({null_cells_sql(raw_cols)}) as bigint) missing_total
        from bb group by {k}),
dups as (select {k}, cast(sum(n - 1) as bigint) duplicate_count
         from (select {k}, {', '.join(raw_cols)}, count(*) n from bb group by all) g group by {k}),
o as (select {k}, min({spec.event_ts}) mn, max({spec.event_ts}) mx,
             row_number() over (order by {k}) batch_index from bb group by {k})
select per.*, dups.duplicate_count,
       'batch_' || lpad(cast(batch_index as varchar), 4, '0') || '_' || strftime(mn, '%Y-%m-%d')
         || '_' || strftime(mx, '%Y-%m-%d') batch_name
from per join dups using ({k}) join o using ({k})"""


def clean_ctes(source: str, spec: TableSpec, cols: list[str], with_coords: bool) -> str:
    """CTEs ending in ``c_final``: the CLEAN chain as dependent scalar subqueries over ``source``."""
    dist, tgt, dur = spec.distance, spec.target, spec.duration_col
    coord = " and ".join(
        f"{b.column} is not null and {b.column} between {b.lo} and {b.hi}" for b in spec.coordinates
    )
    coord_step = f"where {coord}" if with_coords and coord else ""
    return f"""c0 as (select *, {time_features_sql(spec)} from {source}),
c1 as (select * from c0 where {spec.event_ts} is not null and {spec.end_ts} is not null and {tgt} is not null
       and {dist} is not null and {dist} >= 0),
c2 as (select * from c1 where {dist} <= (select quantile_cont({dist}, {spec.distance_q}) from c1) and {tgt} >= 0),
c3 as (select * from c2 where {tgt} <= (select quantile_cont({tgt}, {spec.target_q}) from c2)),
c4 as (select * from c3 {coord_step}),
c5 as (select * from c4 where {dur} > 0),
c6 as (select * from c5 where {dur} <= (select quantile_cont({dur}, {spec.duration_q}) from c5)),
c_final as (select distinct * from c6)"""


def rules_ctes(
    adapter: str, spec: TableSpec, items: tuple[str, ...], min_support: float, max_batches: int | None = None
) -> str:
    """CTEs through ``fi`` (frequent itemsets) for the rule-mining oracle over the kept batches
    (the first ``max_batches`` of them in time order when given)."""
    dist, dur, tgt, hr, wd = spec.distance, spec.duration_col, spec.target, spec.hour_col, spec.weekday_col
    conds = {
        "pickup_night": f"{hr} < 6 or {hr} >= 22",
        "pickup_weekend": f"{wd} >= 5",
        "trip_distance_high": f"{dist} > (select qd from q)",
        "trip_duration_high": f"{dur} > (select qu from q)",
        "passenger_many": f"{spec.passengers} >= 4",
        "total_amount_high": f"{tgt} > (select qt from q)",
    }
    cond_sql = ", ".join(f"coalesce({conds[i]}, false) {i}" for i in items)
    mask = " + ".join(f"cast({it} as bigint) * {1 << i}" for i, it in enumerate(items))
    full = (1 << len(items)) - 1
    k = spec.batch_col
    limit = (
        f"bbn as (select * from bb where {k} in (select {k} from (select distinct {k} from bb) d "
        f"order by {k} limit {max_batches}))"
        if max_batches
        else "bbn as (select * from bb)"
    )
    return f"""{batched_ctes(adapter, spec)},
{limit},
{clean_ctes('bbn', spec, [], bool(spec.coordinates))},
q as (select quantile_cont({dist}, 0.75) qd, quantile_cont({dur}, 0.75) qu, quantile_cont({tgt}, 0.75) qt
      from c_final),
cond as (select {cond_sql} from c_final),
m as (select {mask} mask, count(*) n from cond group by 1),
tot as (select cast(sum(n) as double) total from m),
ic as (select s itemset, cast(sum(n) as bigint) cnt
       from (select unnest(list_filter(generate_series(1, {full}), lambda x: (mask & x) = x)) s, n from m) e
       group by s),
fi as (select itemset, cnt, cast(cnt as double) / (select total from tot) support from ic
       where cast(cnt as double) / (select total from tot) >= {min_support})"""


def items_text_sql(mask: str, items: tuple[str, ...]) -> str:
    order = sorted(range(len(items)), key=lambda i: items[i])
    parts = ", ".join(f"case when ({mask} & {1 << i}) <> 0 then '{items[i]}' end" for i in order)
    return f"concat_ws(' & ', {parts})"


def rules_sql(
    adapter: str, spec: TableSpec, items: tuple[str, ...], min_support: float, min_conf: float,
    max_batches: int | None = None,
) -> str:
    at, bt = items_text_sql("a", items), items_text_sql("b", items)
    return f"""with {rules_ctes(adapter, spec, items, min_support, max_batches)},
sp as (select itemset s, support,
              unnest(list_filter(generate_series(1, itemset), lambda a: (itemset & a) = a and a <> itemset)) a
       from fi where (itemset & (itemset - 1)) <> 0),
r as (select sp.a, sp.s - sp.a b, sp.support, sp.support / fa.support confidence, fb.support sup_b
      from sp join fi fa on fa.itemset = sp.a join fi fb on fb.itemset = sp.s - sp.a),
r2 as (select *, confidence / sup_b lift from r where confidence >= {min_conf})
select {at} || ' -> ' || {bt} rule, support, confidence, lift, {at} "A_text", {bt} "B_text" from r2"""
