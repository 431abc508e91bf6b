"""The same results in plain SQL over the same tables, written event by event.

Runs on DuckDB, where `skewness` and `kurtosis` are the bias-corrected ones. Adding 0.0 after
rounding turns a negative zero into zero.
"""

from __future__ import annotations

from footfall.catalog import FOLDS, FOREST, FOREST_FEATURES, TOP_TAGS
from footfall.operators.ratios import RATIO_DENOMINATORS, RATIO_NUMERATORS
from footfall.schema import SLICES, TRAIN_COLUMNS

EVENT_LOG = """
src as (
  select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k, epoch_us(ts) // 1000 as play_stamp from events
),
raw as (
  select user_id, event_id, play_stamp, make_timestamp(play_stamp * 1000) as ts,
    'ch_' || (event_id % 6)::varchar as install_channel,
    k as video_id,
    'video_type_' || (k % 8)::varchar as video_type,
    case when k % 11 = 0 then null when k % 3 = 0 then 't' || (k % 5)::varchar
         else 't' || (k % 5)::varchar || '$t' || (5 + k % 7)::varchar end as video_tag,
    nullif(k % 20, 19) as video_creator,
    cast(src.ts as date) - (k % 30) as launch_date,
    10 + k * 3 as video_length,
    case event_type when 'error' then '-' when 'view' then '1' when 'click' then '1' when 'purchase' then '1' else '0' end as show_raw,
    case event_type when 'error' then '-' when 'click' then '1' when 'purchase' then '1' else '0' end as click_raw,
    'rec_type_' || (1 + event_id % 3)::varchar as rec_type,
    case event_type when 'error' then '-' else value::varchar end as length_raw,
    case when event_type = 'error' then '-' when event_type = 'purchase' and k % 25 = 0 then '1' else '0' end as comment_raw,
    case when event_type = 'error' then '-' when event_type = 'purchase' and value >= 50 then '1' else '0' end as like_raw,
    case when event_type = 'error' then '-' when event_type = 'click' and k % 10 = 0 then '1' else '0' end as share_raw
  from src
),
ev as (
  select *,
    (show_raw = '1')::int as show, (click_raw = '1')::int as click, (comment_raw = '1')::int as comment,
    (like_raw = '1')::int as "like", (share_raw = '1')::int as share,
    coalesce(try_cast(length_raw as double), 0.0) as play_time_length,
    dayofmonth(ts)::int as play_mday, dayofyear(ts)::int as play_yday,
    hour(ts) + minute(ts) / 60.0::double as play_time,
    dayofyear(launch_date)::int as launch_day,
    dayofyear(ts)::int - dayofyear(launch_date)::int as watch_gap,
    case when dayofmonth(ts) >= 15 then ((dayofmonth(ts) - 15) % 7 + 1)::int end as weekday
  from raw
),
users as (select distinct user_id from ev)"""

PEOPLE = """,
people as (
  select c_custkey as user_id,
    case c_nationkey % 3 when 0 then '-' when 1 then 'male' else 'female' end as gender,
    case when c_acctbal < 0 then '-' when c_acctbal < 3000 then 'age_1' when c_acctbal < 6000 then 'age_2' else 'age_3' end as age,
    case c_mktsegment when 'BUILDING' then '-' else c_mktsegment end as edu,
    'loc_' || c_nationkey::varchar as location
  from customer
)"""

LABELS = """,
labels_ as (
  select user_id, max(case when event_type = 'purchase' and ts >= timestamp '2024-01-29' then 1 else 0 end)::int as label
  from events group by user_id
)"""

FOLD_SCORES = f""",
fold_scores as (
  select user_id, f.fold, avg(click) as score
  from ev, (select unnest(range({FOLDS})) as fold) f where event_id % {FOLDS} <> f.fold group by user_id, f.fold
),
averaged as (select user_id, avg(score) as score from fold_scores group by user_id)"""


def q(body: str, more: str = "") -> str:
    return f"with {EVENT_LOG}{more}\n{body}"


def r(expr: str, digits: int = 6) -> str:
    """Rounded like `catalog.rounded`: a value half-way between two roundings goes up."""
    return f"(round(({expr}) + 1e-{digits + 3}, {digits}) + 0.0)"


def cond(s: str) -> str:
    return "true" if s == "play" else f'"{s}" = 1'


def skew(x: str, where: str = "true") -> str:
    w = f"filter (where {where})"
    return f"case when count({x}) {w} < 3 then null when max({x}) {w} = min({x}) {w} then 0.0 else skewness({x}) {w} end"


def kurt(x: str, where: str = "true") -> str:
    w = f"filter (where {where})"
    return f"case when count({x}) {w} < 4 then null when max({x}) {w} = min({x}) {w} then 0.0 else kurtosis({x}) {w} end"


def by_user(columns: list[str], source: str = "ev") -> str:
    return f"select user_id, {', '.join(columns)} from {source} group by user_id"


def distribution(x: str, pattern: str, source: str, where: str, stats, digits: int = 6) -> str:
    """Statistics of x per user over the rows meeting `where`; users without such rows are absent."""
    formula = {
        "count": f"count(distinct {x})",
        "var": r(f"var_samp({x})", digits),
        "mean": r(f"avg({x})", digits),
        "median": r(f"median({x})", digits),
        "mad": r(f"avg(abs({x} - _m))", digits),
        "skew": r(skew(x), digits),
        "kurt": r(kurt(x), digits),
        "max": r(f"max({x})", digits),
    }
    cols = ", ".join(f"{formula[s]} as {pattern.format(s)}" for s in stats)
    inner = f"select user_id, ({x})::double as {x}, avg({x}) over (partition by user_id) as _m from {source} where {where}"
    return f"select user_id, {cols} from ({inner}) group by user_id"


STATS = ("count", "var", "mean", "median", "mad", "skew", "kurt", "max")


def join_all(parts: list[str], how: str = "left join") -> str:
    return "users " + " ".join(f"{how} ({p}) using (user_id)" for p in parts)


def slice_stats(x: str, name: str, source: str = "ev", slices=SLICES, stats=STATS, digits: int = 6) -> list[str]:
    return [
        distribution(x, name.format(slice=s, stat="{}"), source, cond(s), stats, digits) for s in slices
    ]


def diffs(s: str, value: str = "play_time", digits: int = 6) -> str:
    """Differences within a slice, event by event."""
    lagged = f"""(select user_id, {value} - lag({value}, 1) over w as d, {value} - lag({value}, 2) over w as d2
      from (select *, (hour(ts) * 60 + minute(ts))::double as minutes from ev) where {cond(s)}
      window w as (partition by user_id order by play_stamp, event_id))"""
    if value == "minutes":
        lagged = f"(select user_id, d / 60.0::double as d, d2 / 60.0::double as d2 from {lagged})"
    one = distribution("d", f"diff_time_{s}_{{}}", lagged, "true", STATS, digits)
    two = f"select user_id, {r('max(d2)', digits)} as diff2_time_{s}_max from {lagged} group by user_id"
    return f"select * from ({one}) join ({two}) using (user_id)"


def event_diff(s: str) -> str:
    return f"""select event_id, {r('play_time - lag(play_time) over (partition by user_id order by play_stamp, event_id)')} as diff_{s}
      from ev where {cond(s)}"""


ACTIONS = [
    "count(*) as show_count_all",
    *[f'sum("{f}")::bigint as {f}_count' for f in ("show", "click", "comment", "like", "share")],
    r('sum("show") / count(*)::double') + " as show_ratio",
    r('sum(click) / (sum("show") + 1)::double') + " as click_ratio",
    *[f"""{r(f'sum("{f}") / (sum(click) + 1)::double')} as {f}_ratio""" for f in ("comment", "like", "share")],
]
LENGTH_LAUNCH = [
    f"{r('avg(video_length)')} as video_length_mean",
    "max(video_length) as video_length_max",
    "min(video_length) as video_length_min",
    f"{r('avg(launch_day)')} as launch_time_mean",
    "max(launch_day) as launch_time_max",
    "min(launch_day) as launch_time_min",
    f"{r('stddev_samp(launch_day)')} as launch_time_std",
    f"{r(skew('launch_day::double'))} as launch_time_skew",
    f"{r(kurt('launch_day::double'))} as launch_time_kurt",
]
DURATIONS = [
    f"{r(f'max(play_time) filter (where {cond(s)}) - min(play_time) filter (where {cond(s)})')} as {s}_duration"
    for s in ("play", "show", "click", "like", "share")
]
_RATIO = "(play_time_length / (video_length + 0.01::double))"
WATCH_RATIO = [
    *[f"{r(f'{f}({_RATIO}) filter (where click = 1)')} as watch_ratio_{n}" for n, f in (("mean", "avg"), ("max", "max"), ("min", "min"))],
    f"{r(skew(_RATIO, 'click = 1'))} as watch_ratio_skew",
    f"{r(kurt(_RATIO, 'click = 1'))} as watch_ratio_kurt",
]


def pivot_counts(s: str, key: str, values, name: str) -> list[str]:
    return [
        f"case when count({key}) filter (where {cond(s)}) > 0 then count(*) filter (where {cond(s)} and {key} = {v}) end as {name.format(i)}"
        for i, v in values
    ]


REC_TYPES = [
    c
    for name, s in (("show0", "play"), ("show1", "show"), ("click", "click"), ("like", "like"), ("share", "share"))
    for c in pivot_counts(s, "rec_type", [(i, f"'rec_type_{i}'") for i in (1, 2, 3)], "rec_type_{}_" + name)
]
PERIOD = """(case when play_time > 0 and play_time < 6 then 5 when play_time >= 6 and play_time < 11 then 1
  when play_time >= 11 and play_time < 13.5 then 2 when play_time >= 13.5 and play_time < 18 then 3
  when play_time >= 18 and play_time <= 21 then 4 when play_time > 21 then 5 end)"""
PERIOD_INTENDED = PERIOD.replace("play_time > 0 and", "play_time >= 0 and")


def periods(period: str) -> list[str]:
    return [
        c
        for s in ("show", "click", "like")
        for c in pivot_counts(s, period, [(i, str(i)) for i in range(1, 6)], f"period_{s}_{{}}")
    ]


CREATORS = (("creator", "video_creator"), ("video", "video_id"), ("type", "video_type"))


def interest(which) -> list[str]:
    formula = {"max": "max(n)", "mean": r("avg(n)"), "count": "nullif(count(*) filter (where n > 1), 0)"}
    parts = []
    for name, col in CREATORS:
        for s in ("play", "show", "click"):
            cols = ", ".join(f"{formula[w]} as re{s}_{name}_{w}" for w in which)
            parts.append(
                f"select user_id, {cols} from (select user_id, {col}, count(*) as n from ev "
                f"where {cond(s)} and {col} is not null group by all) group by user_id"
            )
    return parts


def favourites(argmax: bool) -> list[str]:
    best = "arg_max(video_type, (n, video_type))" if argmax else "max(video_type)"
    return [
        f"select user_id, {best} as fav_{s}_type, max(n) as fav_{s}_type_count, {r('max(n) / sum(n)::double')} as fav_{s}_type_ratio "
        f"from (select user_id, video_type, count(*) as n from ev where {cond(s)} group by all) group by user_id"
        for s in SLICES
    ]


def popularity(literal: bool) -> str:
    parts, kept = [], "true"
    for col in ("video_id", "video_tag", "video_creator"):
        kept = f"{kept} and {col} is not null" if literal else f"{col} is not null"
        rows = f"(select * from ev where {kept})"
        parts.append(
            f"select user_id, sum(n)::bigint as {col}_sum from (select user_id, count(*) over (partition by {col}) as n from {rows}) group by user_id"
        )
    cols = ", ".join(
        f"{c}_sum, {r(f'{c}_sum / events_::double')} as {c}_ratio" for c in ("video_id", "video_tag", "video_creator")
    )
    users = "(select user_id, count(*) as events_ from ev group by user_id) u"
    how = "join" if literal else "left join"
    return f"select user_id, {cols} from {users} " + " ".join(f"{how} ({p}) using (user_id)" for p in parts)


SPARSE = [f"video_type_{i}" for i in range(8)], [f"ch_{i}" for i in range(6)]


def sparse() -> str:
    cols = [
        f"count(*) filter (where {col} = '{v}') as {col}_{v}"
        for col, vs in zip(("video_type", "install_channel"), SPARSE)
        for v in vs
    ]
    return by_user(cols, "(select * from ev where click = 1)")


STEPS = """(select user_id, event_id,
  play_stamp - lag(play_stamp) over (partition by user_id order by play_stamp, event_id) as d from ev)"""


def intervals(digits: int | None) -> str:
    def at(expr: str) -> str:
        return r(expr, digits) if digits else expr

    return f"""select user_id, coalesce(sum(nullif(d, 0)), 0)::bigint as interval_sum,
      {at('avg(nullif(d, 0))')} as interval_mean, {at('median(nullif(d, 0))')} as interval_median,
      max(nullif(d, 0)) as interval_max, min(nullif(d, 0)) as interval_min,
      {at('stddev_samp(nullif(d, 0))')} as interval_std, {at(skew('nullif(d, 0)::double'))} as interval_skew,
      max(nullif(d, 0)) - min(nullif(d, 0)) as interval_diff, count(nullif(d, 0)) as interval_cnt
      from {STEPS} group by user_id"""


def encode(col: str) -> str:
    return f"(dense_rank() over (order by coalesce(nullif({col}, '-'), 'nan')) - 1)::int as {col}"


def base(label: bool) -> str:
    first = """select user_id, arg_min(gender, (ev.play_stamp, event_id)) as gender, arg_min(age, (ev.play_stamp, event_id)) as age,
      arg_min(edu, (ev.play_stamp, event_id)) as edu, arg_min(play_mday, (ev.play_stamp, event_id)) as play_mday,
      arg_min(play_yday, (ev.play_stamp, event_id)) as play_yday from ev left join people using (user_id) group by user_id"""
    codes = ", ".join(encode(c) for c in ("gender", "age", "edu"))
    if label:
        return f"select user_id, {codes}, play_mday, play_yday, label from ({first}) join labels_ using (user_id)"
    return f"select user_id, {codes}, play_mday, play_yday from ({first})"


CLICK_CELLS = """
        select user_id, i::int as i, count(*) as n from (
          select user_id, code + case kind when 'video_type' then 0 else (select count(distinct video_type) from ev where click = 1) end as i
          from (select user_id, 'video_type' as kind, video_type as v from ev where click = 1
                union all select user_id, 'install_channel', install_channel from ev where click = 1)
          join (select kind, v, row_number() over (partition by kind order by v) - 1 as code from (
                select distinct 'video_type' as kind, video_type as v from ev where click = 1
                union select distinct 'install_channel', install_channel from ev where click = 1)) using (kind, v))
        group by 1, 2"""
CLICK_VECTORS = f"""(select user_id, string_agg(i::varchar, ',' order by i) as click_indices, string_agg(n::varchar, ',' order by i) as click_counts
  from ({CLICK_CELLS}) group by user_id)"""


def features_parts(digits: int) -> list[str]:
    """The families of the full table, one row per user each."""
    return [
        by_user(ACTIONS), by_user(LENGTH_LAUNCH), *slice_stats("play_time", "time_{slice}_{stat}", digits=digits),
        by_user(REC_TYPES), by_user(periods(PERIOD)), by_user(DURATIONS), by_user(WATCH_RATIO),
        *[diffs(s, digits=digits) for s in SLICES],
        *slice_stats("watch_gap", "watch_gap_{slice}_{stat}", digits=digits),
        *interest(("max", "mean", "count")),
    ]


def reround(sql: str, digits: int) -> str:
    return sql.replace("+ 1e-9, 6) + 0.0)", f"+ 1e-{digits + 3}, {digits}) + 0.0)")


def user_features() -> str:
    first = f"select *, {WEEKDAY} from ({base(False)})"
    means = ", ".join(
        f"{r(f'{s}_raw / nullif(diff_time_{s}_count, 0)::double', 4)} as {s}_interval" for s in SLICES
    )
    raw = by_user(
        [f"max(play_time) filter (where {cond(s)}) - min(play_time) filter (where {cond(s)}) as {s}_raw" for s in SLICES]
    )
    drop = ", ".join(f"{s}_raw" for s in SLICES)
    joined = "(" + first + ") b " + " ".join(f"left join ({p}) using (user_id)" for p in [raw, *features_parts(4)])
    joined += f" left join {CLICK_VECTORS} using (user_id) join ({popularity(True)}) using (user_id)"
    return reround(f"select * exclude ({drop}), {means} from {joined}", 4)


def user_features_intended() -> str:
    gaps = slice_stats("gap", "watch_gap_{slice}_{stat}", "(select *, ts::date - launch_date as gap from ev)", digits=4)
    first = "select user_id, isodow(d)::int as play_weekday, (isodow(d) > 5)::int as play_isweekend from (select user_id, arg_min(ts::date, (play_stamp, event_id)) as d from ev group by user_id)"
    sums = f"select user_id, video_id_sum, video_tag_sum, video_creator_sum from ({popularity(False)})"
    parts = [by_user(periods(PERIOD_INTENDED)), *[diffs(s, "minutes", digits=4) for s in SLICES], *gaps, sums]
    return f"select * from ({first}) b " + " ".join(f"left join ({p}) using (user_id)" for p in parts)


WEEKDAY = """case when play_mday >= 15 then ((play_mday - 15) % 7 + 1)::int end as play_weekday,
  (case when play_mday >= 15 and (play_mday - 15) % 7 + 1 <= 5 then 0 else 1 end)::int as play_isweekend"""


def ratio_grid() -> str:
    parts = [*features_parts(6), *favourites(False), intervals(None)]
    joined = f"({popularity(True)}) " + " ".join(f"left join ({p}) using (user_id)" for p in parts)
    cols = ", ".join(
        f"{r(f'{n}::double / nullif(interval_{d}, 0)::double')} as {n}_interval_{d}_ratio"
        for n in RATIO_NUMERATORS
        for d in RATIO_DENOMINATORS
    )
    return f"select user_id, {cols} from {joined}"


def slice_interval() -> str:
    out = []
    for s in SLICES:
        duration = by_user([f"max(play_time) filter (where {cond(s)}) - min(play_time) filter (where {cond(s)}) as dur"])
        out.append(
            f"select user_id, {r(f'dur / nullif(diff_time_{s}_count, 0)::double')} as {s}_interval "
            f"from ({duration}) left join ({diffs(s)}) using (user_id)"
        )
    return "select * from " + join_all(out)


def value_stat(stat: str) -> str:
    return "select * from " + join_all(slice_stats("play_time", "{slice}_{stat}", slices=("play", "click"), stats=(stat,)))


def length_aggs(formulas: dict[str, str]) -> str:
    return by_user(
        [
            f"{expr.format(x=x)} as {name}_{suffix}"
            for name, expr in formulas.items()
            for suffix, x in (("all", "video_length::double"), ("click", "(case when click = 1 then video_length end)::double"))
        ]
    )


TAGS = "string_split(coalesce(video_tag, 'nan'), '$')"
TOP = f"(select tag, count(*) as n from (select unnest({TAGS}) as tag from ev) group by tag order by n desc, tag limit {TOP_TAGS + 1})"
SHARED_TAGS = f"(select user_id, sum(len({TAGS}))::bigint as shared_tags from ev where share = 1 group by user_id)"
SLICE_COUNTS = by_user([f'count(*) filter (where "{s}" = 1) as n_{s}' for s in ("show", "click", "like", "share")])

SWEEP = """select 23.0::double + i * ((23.0::double + 0.001::double) - 23.0::double) as threshold,
  count(*) filter (where label = 1 and m > 23.0::double + i * ((23.0::double + 0.001::double) - 23.0::double)) as p,
  count(*) filter (where m > 23.0::double + i * ((23.0::double + 0.001::double) - 23.0::double)) as n
  from (select unnest(range(1000)) as i) t,
       (select user_id, max(play_time) filter (where click = 1) as m, any_value(label) as label
        from ev left join labels_ using (user_id) group by user_id) u group by i"""

FILE_SOURCE = {
    "UserId": "user_id::varchar", "gender": "gender", "age": "age", "edu": "edu", "location": "location", "label": "0::int",
    "video_id": "video_id::varchar", "video_creator": "video_creator::varchar",
    "launch_time": "(launch_date - date '1970-01-01')::bigint * 86400", "show": "show_raw", "click": "click_raw",
    "play_time_length": "length_raw", "comment": "comment_raw", "like": "like_raw", "share": "share_raw",
}

def tree_sql(node) -> str:
    """A tree of the fixed ensemble; counts are never missing."""
    if isinstance(node, float):
        return f"{node}::double"
    return f"case when {FOREST_FEATURES[node[0]]} <= {node[1]} then {tree_sql(node[2])} else {tree_sql(node[3])} end"


_FOREST_VALUES = ", ".join(f"{tree_sql(t)} as v{i}" for i, t in enumerate(FOREST))
FORESTED = f"""{LABELS},
counted as ({by_user(ACTIONS)}),
valued as (select user_id, label, {_FOREST_VALUES} from counted join labels_ using (user_id)),
staged as ({" union all ".join(f"select {k} as prefix, label, {' + '.join(f'v{i}' for i in range(k))} as s from valued" for k in range(1, len(FOREST) + 1))}),
areas as (
  select prefix, (sum(w) filter (where label = 1) - p * (p + 1) / 2.0) / nullif(p * n, 0)::double as auc
  from (
    select prefix, label, avg(r) over (partition by prefix, s) as w, count(*) filter (where label = 1) over (partition by prefix) as p,
           count(*) filter (where label = 0) over (partition by prefix) as n
    from (select *, row_number() over (partition by prefix order by s) as r from staged)
  ) group by prefix, p, n
)"""


def _margin(k: int) -> str:
    return "(" + " + ".join(f"v{i}" for i in range(k)) + ")"


FEATURE_SPLITS = "(values " + ", ".join(
    f"('{FOREST_FEATURES[n[0]]}', {n[1]}::double)" for t in FOREST for n in (lambda walk: walk(walk, t))(
        lambda walk, n: [] if isinstance(n, float) else [n, *walk(walk, n[2]), *walk(walk, n[3])]
    )
) + ") f(feature, threshold)"
SPLIT_IMPORTANCE = f"""select feature, count(distinct i) as importance, (count(*) filter (where value <= threshold))::bigint as below, count(*) as users
from (select *, row_number() over () as i from {FEATURE_SPLITS}) join (
  {" union all ".join(f"select '{c}' as feature, {c}::double as value from counted" for c in FOREST_FEATURES)}
) using (feature) group by feature"""

BEST_PREFIX = """, seen as (
  select prefix, auc, arg_max(prefix, (auc, -prefix)) over (order by prefix) as best from areas
), stopped as (select coalesce(min(prefix) filter (where prefix - best >= 3), max(prefix)) as stop from seen)"""


def label_mean(c: str, held_out: int | None) -> str:
    """The mean over the rows of other folds that have the row's value, drawn to the mean of all of them."""
    outside = "b.fold <> a.fold" + ("" if held_out is None else f" and b.fold <> {held_out}")
    same = f"{outside} and coalesce(a.{c}, 'nan') = coalesce(b.{c}, 'nan')"
    prior = f"coalesce((select avg(label) from dealt b where {outside}), 0.5)"
    return f"((select coalesce(sum(label), 0) from dealt b where {same}) + 20.0::double * {prior}) / ((select count(*) from dealt b where {same}) + 20.0::double)"


SQL: dict[str, str] = {
    "load_events": q(
        "select " + ", ".join(f'{FILE_SOURCE.get(c, c)} as "{c}"' for c in TRAIN_COLUMNS) + " from ev left join people using (user_id)",
        PEOPLE,
    ),
    "load_events_limited": q(
        'select user_id::varchar as "UserId", play_stamp, video_id::varchar as video_id, rec_type from ev order by user_id, play_stamp, event_id limit 1000'),
    "load_feature_table": q(SLICE_COUNTS),
    "profile_events": "select count(*) as events, count(distinct user_id) as users from events",
    "user_labels": q("select * from labels_", LABELS),
    "write_feature_table": q(by_user(ACTIONS)),
    "submission_format": q("select user_id as userid, printf('%.4f', score) as score from averaged", FOLD_SCORES),
    "sort_events": q('select user_id, play_stamp, event_id, "show", click from ev order by 1, 2, 3'),
    "clean_events": q('select user_id, event_id, "show", click, comment, "like", share, video_length, play_time_length from ev'),
    "decode_timestamp": q("select user_id, event_id, play_mday, play_yday, play_time, launch_day, launch_date from ev"),
    "day_period": q(f"select user_id, event_id, {PERIOD}::int as play_period from ev"),
    "day_period_intended": q(f"select user_id, event_id, {PERIOD_INTENDED}::int as play_period from ev"),
    "weekday_feats": q(f"select user_id, play_mday, play_date, {WEEKDAY} from (select user_id, arg_min(play_mday, (play_stamp, event_id)) as play_mday, min(ts)::date as play_date from ev group by user_id)"),
    "weekday_feats_intended": q("select user_id, dayofmonth(d)::int as play_mday, d as play_date, isodow(d)::int as play_weekday, (isodow(d) > 5)::int as play_isweekend from (select user_id, min(ts)::date as d from ev group by user_id)"),
    "event_calendar": q(
        "select user_id, event_id, weekday, (coalesce(weekday, 6) > 5)::int as weekend, isodow(ts)::int as true_weekday, "
        "(isodow(ts) > 5)::int as true_weekend, watch_gap, (ts::date - launch_date)::int as true_watch_gap from ev"
    ),
    "over_midnight": q(by_user(["max((hour(ts) + minute(ts) / 60.0::double + second(ts) / 3600.0::double + play_time_length / 3600.0::double > 24)::int) as is_overday"])),
    "drop_by_pattern": q("select user_id, play_duration, show_duration, click_duration, like_duration, share_duration, "
        + ", ".join(f"fav_{s}_type, fav_{s}_type_count, fav_{s}_type_ratio" for s in ("show", "click", "like"))
        + " from " + join_all([by_user(DURATIONS), *favourites(False)])),
    "constant_column": q(by_user(["max(video_type) as fav_play_type", '0::int as "is_play=show"'])),
    "join_inner_user": q("select user_id, sum(video_length)::bigint as shared_length from ev where share = 1 group by user_id"),
    "join_left_user": q("select user_id, (sum(video_length) filter (where share = 1))::bigint as shared_length from ev group by user_id"),
    "join_labels": q(f"select * from ({SLICE_COUNTS}) left join labels_ using (user_id)", LABELS),
    "join_tags": q(f"select * from ({SLICE_COUNTS}) left join {SHARED_TAGS} using (user_id)"),
    "union_enrich_split": q(
        f"select c.*, case when c.user_id % 5 <> 0 then label end as label, shared_tags, case when c.user_id % 5 <> 0 then 'train' else 'test' end as part "
        f"from ({SLICE_COUNTS}) c left join labels_ using (user_id) left join {SHARED_TAGS} using (user_id)", LABELS),
    "slice_counts": q(SLICE_COUNTS),
    "agg_count": q(length_aggs({"count": "count({x})"})),
    "agg_sum": q(length_aggs({"sum": "sum({x})::bigint"})),
    "agg_mean_max_min": q(length_aggs({"mean": r("avg({x})"), "max": "max({x})::int", "min": "min({x})::int"})),
    "agg_var_std": q(length_aggs({"var": r("var_samp({x})"), "std": r("stddev_samp({x})")})),
    "agg_skew": q(length_aggs({"skew": r(skew("{x}"))})),
    "agg_kurt": q(length_aggs({"kurt": r(kurt("{x}"))})),
    "agg_median": q(value_stat("median")),
    "agg_mad": q(value_stat("mad")),
    "agg_nunique": q(value_stat("count")),
    "first_per_user": q("select user_id, event_id, play_stamp, video_id, rec_type from ev qualify row_number() over (partition by user_id order by play_stamp, event_id) = 1"),
    "diff1_play": q(f"select user_id, event_id, diff_play from ev left join ({event_diff('play')}) using (event_id)"),
    "diff1_slices": q("select user_id, event_id, diff_show, diff_click, diff_like from ev " + " ".join(f"left join ({event_diff(s)}) using (event_id)" for s in ("show", "click", "like"))),
    "diff2_max": q("select user_id, " + ", ".join(f"diff2_time_{s}_max" for s in SLICES) + " from " + join_all([diffs(s) for s in SLICES])),
    "event_interval": q(f"select user_id, event_id, d as interval, nullif(d, 0) as interval_record, case when d <> 0 then 1 end::int as interval_flag from {STEPS}"),
    "file_event_intervals": q(f"""select user_id::varchar as "UserId", play_stamp, d as interval, case when d <> 0 then 1 end::int as interval_flag
        from {STEPS} join (select event_id, play_stamp from ev) using (event_id)"""),
    "file_event_tags": q("""select user_id::varchar as "UserId", play_stamp, len(string_split(trim(coalesce(video_tag, 'nan')), '$'))::int as tag_count from ev"""),
    "user_base": q(base(True), PEOPLE + LABELS),
    "user_base_nolabel": q(base(False), PEOPLE),
    "action_counts": q(by_user(ACTIONS)),
    "item_popularity": q(popularity(True)),
    "item_popularity_intended": q(popularity(False)),
    "video_length_launch_stats": q(by_user(LENGTH_LAUNCH)),
    "time_of_day_stats": q("select * from " + join_all(slice_stats("play_time", "time_{slice}_{stat}"))),
    "tag_count": q("select user_id, event_id, coalesce(len(string_split(video_tag, '$')), 1)::int as tag_count from ev"),
    "tag_count_intended": q("select user_id, event_id, coalesce(len(string_split(video_tag, '$')), 0)::int as tag_count from ev"),
    "top_tags": q(f"select * from {TOP}"),
    "tag_topn_counts": q(f"select u.user_id, t.tag || '_count' as tag, count(e.event_id) as n from users u cross join (select tag from {TOP} order by n desc, tag offset 1) t left join ev e on e.user_id = u.user_id and list_contains({TAGS}, t.tag) group by 1, 2"),
    "rec_type_pivot": q(by_user(REC_TYPES)),
    "day_period_pivot": q(by_user(periods(PERIOD))),
    "day_period_pivot_intended": q(by_user(periods(PERIOD_INTENDED))),
    "sparse_click_pivot": q("select * from " + join_all([sparse()])),
    "sparse_click_counts": q(" union all ".join(f"select user_id, '{c}' as kind, {c} as item, count(*) as n from ev where click = 1 group by all" for c in ("video_type", "install_channel"))),
    "slice_duration": q(by_user(DURATIONS)),
    "watch_ratio_stats": q(by_user(WATCH_RATIO)),
    "time_diff_stats": q("select * from " + join_all([diffs(s) for s in SLICES])),
    "time_diff_stats_intended": q("select * from " + join_all([diffs(s, "minutes") for s in SLICES])),
    "slice_interval": q(slice_interval()),
    "watch_gap_stats": q("select * from " + join_all(slice_stats("watch_gap", "watch_gap_{slice}_{stat}", digits=4))),
    "watch_gap_stats_intended": q("select * from " + join_all(slice_stats("gap", "watch_gap_{slice}_{stat}", "(select *, ts::date - launch_date as gap from ev)", digits=4))),
    "repeat_interest_max": q("select * from " + join_all(interest(("max",)))),
    "repeat_interest_mean": q("select * from " + join_all(interest(("mean",)))),
    "repeat_interest_count": q("select * from " + join_all(interest(("count",)))),
    "install_channel_count": q(by_user(["count(distinct install_channel) as install_channel_count"])),
    "interval_stats": q(intervals(3)),
    "missing_rates": q(by_user([c for f in ("gender", "age", "edu") for c in (f"count(*) filter (where {f} = '-') as {f}_nan_count", f"{r(f'''avg(({f} = '-')::int)''')} as {f}_nan_ratio")], "ev join people using (user_id)"), PEOPLE),
    "favourite_type": q("select * from " + join_all(favourites(False))),
    "favourite_type_argmax": q("select * from " + join_all(favourites(True))),
    "ratio_grid": q(ratio_grid()),
    "user_features": q(user_features(), PEOPLE),
    "user_features_intended": q(user_features_intended()),
    "sparse_click_vectors": q(CLICK_CELLS),
    "label_encode": q("select user_id, " + ", ".join(encode(f"fav_{s}_type") for s in SLICES) + " from " + join_all(favourites(False))),
    "stratified_folds": q(f"select *, ((row_number() over (partition by label order by md5(user_id::varchar || '2018'), user_id) - 1) % {FOLDS})::int as fold from labels_", LABELS),
    "fold_average": q(f"select user_id, {r('score')} as score from averaged", FOLD_SCORES),
    "prediction_mean": q(f"select {r('avg(score)')} as mean from averaged", FOLD_SCORES),
    "auc_rank": q(
        f"""select {r('sum(case when a.s > b.s then 1.0 when a.s = b.s then 0.5 else 0.0 end) / count(*)', 9)}::double as auc
        from (select score as s from averaged join labels_ using (user_id) where label = 1) a,
             (select score as s from averaged join labels_ using (user_id) where label = 0) b""", FOLD_SCORES + LABELS),
    "forest_scores": q(
        f"select user_id, {r(f'1 / (1 + exp(-2 * {_margin(len(FOREST))}))')} as score, {r(f'1 / (1 + exp(-2 * {_margin(len(FOREST) // 2)}))')} as half_score from valued",
        FORESTED),
    "staged_auc": q(f"select prefix, {r('auc', 9)} as auc from areas", FORESTED),
    "best_prefix": q(f"select best as prefix, {r('(select auc from areas where prefix = best)', 9)} as auc from seen, stopped where prefix = stop", FORESTED + BEST_PREFIX),
    "split_importance": q(SPLIT_IMPORTANCE, FORESTED),
    "label_means": q(
        "select user_id, fold, " + ", ".join(f"{r(label_mean(f'fav_{s}_type', h))} as fav_{s}_type_{n}" for s in SLICES for h, n in ((None, "all"), (0, "0")))
        + " from dealt a",
        f"""{LABELS}, favoured as (select * from {join_all(favourites(False))} join labels_ using (user_id)),
dealt as (select *, ((row_number() over (partition by label order by md5(user_id::varchar || '2018'), user_id) - 1) % {FOLDS})::int as fold from favoured)"""),
    "tail_rate_sweep": q(f"select {r('threshold')} as threshold, {r('p / nullif(n, 0)::double')} as rate from ({SWEEP})", LABELS),
    "tail_rate_max": q(f"select {r('threshold')} as threshold, {r('rate')} as rate from (select threshold, p / nullif(n, 0)::double as rate from ({SWEEP})) where rate is not null order by 2 desc, 1 limit 1", LABELS),
}
