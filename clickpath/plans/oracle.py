"""DuckDB SQL twins of the registered queries (same column names and rounding).

Each text runs on the driver's pre-registered views (only ``events`` is read).
Sessions use the gaps-and-islands form: a new session starts where the time
since the key's previous event exceeds the gap.
"""

from __future__ import annotations

from ..schema import FEATURE_COLS

K = "cast(json_extract(props, '$.k') as bigint)"

EV = f"""ev as (
  select event_id,
         ts as event_time,
         case event_type when 'click' then 'cart' when 'error' then 'remove_from_cart' else event_type end as event_type,
         {K} as product_id,
         {K} // 10 as category_id,
         'c' || cast({K} // 10 as varchar) as category_code,
         case when {K} % 7 <> 0 then 'b' || cast({K} % 7 as varchar) end as brand,
         value as price,
         user_id,
         cast(user_id as varchar) as user_session,
         {K} as k
  from events)"""

CORE = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
CORE_SEC = ("date_trunc('second', event_time) as event_time, event_type, product_id, category_id, "
            "category_code, brand, round(price, 6) as price, user_id, user_session")


def sessions_cte(gap: str, src: str = "ev", prefix: str = "s") -> str:
    """CTEs ``{prefix}raw`` (all windows) and ``{prefix}feat`` (feature rows)."""
    p = prefix
    return f"""{p}g as (
  select *, case when event_time - lag(event_time) over (partition by user_session order by event_time)
                      <= interval '{gap}' then 0 else 1 end as nw
  from {src}),
{p}h as (
  select *, sum(nw) over (partition by user_session order by event_time rows unbounded preceding) as sid
  from {p}g),
{p}raw as (
  select user_session, sid,
         min(event_time) as window_start,
         max(event_time) + interval '{gap}' as window_end,
         count(*) as n_events,
         max(case when event_type = 'purchase' then 1 else 0 end) as label,
         min(event_time) filter (where event_type <> 'purchase') as session_start,
         max(event_time) filter (where event_type <> 'purchase') as session_end,
         count(*) filter (where event_type = 'view') as view_count,
         count(*) filter (where event_type = 'cart') as cart_count,
         count(*) filter (where event_type = 'remove_from_cart') as remove_count,
         count(distinct product_id) filter (where event_type <> 'purchase') as distinct_products,
         count(distinct category_id) filter (where event_type <> 'purchase') as distinct_categories,
         count(distinct brand) filter (where event_type <> 'purchase') as distinct_brands,
         avg(price) filter (where event_type <> 'purchase') as avg_price,
         max(price) filter (where event_type <> 'purchase') as max_price
  from {p}h group by user_session, sid),
{p}feat as (
  select user_session, window_start, window_end, label, session_start, session_end,
         view_count, cart_count, remove_count,
         distinct_products, distinct_categories, coalesce(distinct_brands, 0) as distinct_brands,
         coalesce(avg_price, 0.0) as avg_price, coalesce(max_price, 0.0) as max_price,
         date_diff('second', date_trunc('second', session_start), date_trunc('second', session_end))
           as session_duration_sec,
         case when cart_count > 0 then 1 else 0 end as has_cart
  from {p}raw where session_start is not null)"""


FEATURE_SELECT = """user_session, window_start, window_end, label, session_start, session_end,
       view_count, cart_count, remove_count, distinct_products, distinct_categories, distinct_brands,
       round(avg_price, 6) as avg_price, round(max_price, 6) as max_price, session_duration_sec, has_cart"""

# 12-hour sessions, the fixed rule scores and the time split (cutoffs in epoch
# seconds computed with double arithmetic, as the driver-side Python does).
SCORED = f"""{EV},
{sessions_cte('12 hour', prefix='l')},
scored as (
  select *,
         (view_count * 7 + cart_count * 31 + distinct_products * 13 + session_duration_sec) % 100 as score_pct,
         (cart_count * 29 + remove_count * 17 + distinct_categories * 11
            + floor(session_duration_sec / 60)) % 100 as score_pct_v2
  from lfeat),
scored2 as (
  select *, cast(score_pct as double) / 100.0 as purchase_probability,
            cast(score_pct_v2 as double) / 100.0 as probability_v2,
            epoch_us(session_start) // 1000000 as ss
  from scored),
bounds as (select min(ss) as lo, max(ss) as hi from scored2),
cuts as (
  select lo,
         lo + cast(trunc(cast(hi - lo as double) * 0.6::double) as bigint) as train_cut,
         lo + cast(trunc(cast(hi - lo as double) * (0.6::double + 0.15::double)) as bigint) as val_cut
  from bounds),
labelled as (
  select s.*, case when s.ss <= (select train_cut from cuts) then 'train'
                   when s.ss <= (select val_cut from cuts) then 'val' else 'test' end as split
  from scored2 s)"""

THRESHOLDS = "(select i, round(0.05 * i, 2)::double as threshold from range(1, 20) r(i))"

SWEEP = f"""{SCORED},
val as (select * from labelled where split = 'val'),
grid as {THRESHOLDS},
hist as (
  -- threshold i (t = 5i %) is cleared by score_pct >= 5i, i.e. by rows whose
  -- bin least(score_pct // 5, 19) is at least i
  select least(score_pct // 5, 19) as b,
         count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
  from val group by 1),
counts as (
  select g.threshold,
         cast(coalesce(sum(h.pos), 0) as bigint) as tp,
         cast(coalesce(sum(h.neg), 0) as bigint) as fp,
         cast((select count(*) from val where label = 1) - coalesce(sum(h.pos), 0) as bigint) as fn
  from grid g left join hist h on h.b >= g.i
  group by g.threshold),
sweep as (
  select threshold, tp, fp, fn,
         case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision,
         case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall
  from counts),
sweep2 as (
  select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0.0 end as f1
  from sweep),
best as (select threshold, f1, precision, recall from sweep2 order by f1 desc, threshold asc limit 1)"""

# Exact AUC (Mann–Whitney with ties ½) per group key.
def auc_sql(src: str, score: str, group: str | None) -> str:
    g = f"{group}, " if group else ""
    part = f"partition by {group} " if group else ""
    return f"""(
  select {g}case when sum(pos) * sum(neg) > 0
              then sum(pos * neg_below + 0.5 * pos * neg) / (sum(pos) * sum(neg)) end as auc,
         cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg
  from (
    select {g}s, pos, neg,
           coalesce(sum(neg) over ({part}order by s rows between unbounded preceding and 1 preceding), 0) as neg_below
    from (select {g}{score} as s,
                 count(*) filter (where label = 1) as pos,
                 count(*) filter (where label <> 1) as neg
          from {src} group by {g}{score}) a) b
  {'group by ' + group if group else ''})"""


PREDICTIONS = f"""{SCORED},
pred as (
  select user_session, session_end as event_time, purchase_probability,
         score_pct >= 50 as predicted_label,
         case when split = 'train' then 'v1' else 'v2' end as model_version,
         session_end as scored_at
  from labelled),
latest as (select max(scored_at) as as_of from pred),
batches as (
  select date_trunc('hour', scored_at) as batch_id, count(*) as total,
         cast(sum(cast(predicted_label as int)) as bigint) as purchases
  from pred group by 1),
counters as (
  select 'total_predictions' as metric_key, cast(coalesce(sum(total), 0) as bigint) as metric_value from batches
  union all
  select 'purchase_predicted', cast(coalesce(sum(purchases), 0) as bigint) from batches)"""

DECISIONS = f"""{SCORED},
dayed as (select *, cast(session_start as date) as day from scored2),
champ as {auc_sql('dayed', 'purchase_probability', 'day')},
chall as {auc_sql('dayed', 'probability_v2', 'day')},
decisions as (
  select chall.day, chall.auc as auc_challenger, chall.n_pos, chall.n_neg, champ.auc as auc_champion,
         chall.auc - champ.auc as improvement,
         chall.auc is not null and (champ.auc is null or coalesce(chall.auc - champ.auc > 0.02, false)) as promoted
  from chall join champ on chall.day = champ.day),
reg as (
  select strftime(day, '%Y%m%d') || '_000000' as version, strftime(day, '%Y-%m-%d') as trained_on,
         auc_challenger as auc_score, promoted, cast(day as timestamp) + interval 1 day as created_at
  from decisions)"""

# Stream/baseline split by the middle of the event time range; tail replayed.
STREAMED = f"""{EV},
eb as (select min(epoch_us(event_time) // 1000000) as lo, max(epoch_us(event_time) // 1000000) as hi from ev),
ec as (select lo + cast(trunc(cast(hi - lo as double) * 0.5::double) as bigint) as mid,
              lo + cast(trunc(cast(hi - lo as double) * 0.75::double) as bigint) as tail from eb),
evs as (select ev.*, epoch_us(event_time) // 1000000 as es from ev),
baseline as (select {CORE} from evs where es <= (select mid from ec)),
streamed as (
  select {CORE} from evs where es > (select mid from ec)
  union all
  select {CORE} from evs where es > (select tail from ec))"""

SAN_LONG = """case when {c} is null or lower(trim({c})) in ('', 'null', 'none', 'n/a') then null
     when regexp_full_match(trim({c}), '[+-]?[0-9]+') then try_cast(trim({c}) as bigint)
     else cast(trunc(try_cast(trim({c}) as decimal(38, 6))) as bigint) end"""

WIRE = f"""{EV},
wire as (
  select event_id, event_type, k, user_id,
         case when k % 10 = 0 then 'n/a'
              when k % 10 = 1 then cast(k as varchar) || '.0'
              when k % 10 = 2 then ' ' || cast(k as varchar) || ' '
              when k % 10 = 3 then 'NULL'
              when k % 10 = 4 then 'None'
              when k % 10 = 5 then cast(k as varchar) || '.9'
              when k % 10 = 6 then 'x' || cast(k as varchar)
              else cast(k as varchar) end as product_raw,
         case when k % 4 = 0 then cast(k // 10 as varchar) || '.0'
              when k % 4 = 1 then ''
              else cast(k // 10 as varchar) end as category_raw,
         case when event_type = 'view' then cast(user_id + 2053013555631882000 as varchar)
              when event_type = 'signup' then cast(user_id as varchar) || '.0'
              else cast(user_id as varchar) end as user_raw,
         case when k % 11 = 0 then 'NaN'
              when k % 11 = 1 then 'inf'
              when k % 11 = 2 then 'N/A'
              when k % 11 = 3 then ''
              when k % 11 = 4 then '-Infinity'
              when k % 11 = 5 then ' ' || cast(price as varchar) || ' '
              when k % 11 = 6 then 'abc'
              else cast(price as varchar) end as price_raw,
         case when k // 10 = 0 then '' else 'c' || cast(k // 10 as varchar) end as category_code_raw,
         case when k % 7 = 0 then '' else 'b' || cast(k % 7 as varchar) end as brand_raw
  from ev)"""


# Messages with broken JSON (all null), blank sessions and unreadable times, by rule.
_BROKEN = "k % 5 = 0 and event_type = 'signup'"
EDGE = f"""{EV},
edge as (
  select {', '.join(f"case when not ({_BROKEN}) then {c} end as {c}" for c in CORE.split(', ')
                    if c not in ('event_time', 'user_session'))},
         case when not ({_BROKEN}) and not (k % 5 = 0 and event_type = 'remove_from_cart') then event_time end as event_time,
         case when {_BROKEN} then null when k % 5 = 0 and event_type = 'purchase' then '' else user_session end as user_session
  from ev)"""

# The JSON wire carries event times to the second.
EV_SEC = EV.replace("ts as event_time", "date_trunc('second', ts) as event_time")


def _sql(ctes: str, body: str) -> str:
    return f"with {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    feat30 = f"{EV},\n{sessions_cte('30 minute')}"
    q: dict[str, str] = {}
    q["events_scan"] = _sql(EV, f"select {CORE_SEC} from ev")
    q["lake_scan"] = q["events_scan"]
    q["decode_events"] = _sql(EDGE, f"select {CORE_SEC} from edge")
    q["clean_events"] = _sql(EDGE, f"select {CORE_SEC} from edge where event_time is not null "
                                   "and user_session is not null and user_session <> ''")
    q["encode_events"] = _sql(EV, """select user_session as key, cast(json_object(
        'event_time', strftime(event_time, '%Y-%m-%d %H:%M:%S') || ' UTC',
        'event_type', event_type, 'product_id', product_id, 'category_id', category_id,
        'category_code', category_code, 'brand', brand, 'price', price, 'user_id', user_id,
        'user_session', user_session) as varchar) as value from ev""")
    q["sanitize_ids"] = _sql(WIRE, "select event_id, "
                             + SAN_LONG.format(c="product_raw") + " as product_id, "
                             + SAN_LONG.format(c="category_raw") + " as category_id, "
                             + SAN_LONG.format(c="user_raw") + " as user_id from wire")
    q["sanitize_price"] = _sql(WIRE, """select event_id, round(case
          when lower(trim(price_raw)) in ('', 'null', 'none', 'n/a') then null
          when isnan(try_cast(trim(price_raw) as double)) or isinf(try_cast(trim(price_raw) as double)) then null
          else try_cast(trim(price_raw) as double) end, 6) as price from wire""")
    q["sanitize_text"] = _sql(WIRE, "select event_id, nullif(category_code_raw, '') as category_code, "
                                    "nullif(brand_raw, '') as brand from wire")
    q["reject_summary"] = _sql(EV, """select count(*) as n_lines,
        count(*) - count(*) filter (where k % 5 = 0 and event_type in ('signup', 'remove_from_cart')) as n_accepted,
        count(*) filter (where k % 5 = 0 and event_type in ('signup', 'remove_from_cart')) as n_rejected,
        count(*) - count(*) filter (where k % 5 = 0 and event_type in ('signup', 'remove_from_cart', 'purchase'))
          as n_clean
        from ev""")
    q["bounded_replay"] = _sql(EV, f"""select {CORE_SEC.replace("date_trunc('second', event_time)", "event_time")}
        from ev where event_time is not null and user_session is not null
        order by event_time asc nulls last, event_type asc nulls first, product_id asc nulls first,
                 category_id asc nulls first, category_code asc nulls first, brand asc nulls first,
                 price asc nulls first, user_id asc nulls first, user_session asc nulls first
        limit (select cast(trunc(count(*) * 0.5) as bigint) from ev)""")
    q["archive_layout"] = _sql(EV, "select event_type, cast(event_time as date) as event_date, count(*) as n_events "
                                   "from ev group by 1, 2")
    q["dedup_events"] = _sql(STREAMED, f"select distinct {CORE.replace('price', 'round(price, 6) as price')} "
                                       "from (select * from baseline union all select * from streamed)")
    q["consolidate"] = _sql(STREAMED, f"""select {CORE.replace('price', 'round(price, 6) as price')} from baseline
        union all
        select {CORE.replace('price', 'round(price, 6) as price')} from (select distinct * from streamed)""")
    q["session_windows"] = _sql(feat30, "select user_session, window_start, window_end, n_events from sraw")
    q["session_bounds"] = _sql(feat30, "select user_session, window_start, session_start, session_end from sraw")
    q["session_labels"] = _sql(feat30, "select user_session, window_start, label from sraw")
    q["session_counts"] = _sql(feat30, "select user_session, window_start, view_count, cart_count, remove_count "
                                       "from sraw")
    q["session_distincts"] = _sql(feat30, "select user_session, window_start, distinct_products, "
                                          "distinct_categories, distinct_brands from sraw")
    q["session_prices"] = _sql(feat30, "select user_session, window_start, round(avg_price, 6) as avg_price, "
                                       "round(max_price, 6) as max_price from sraw")
    q["purchase_only_windows"] = _sql(feat30, """select count(*) as total_windows,
        count(*) filter (where session_start is null) as purchase_only_windows,
        count(*) filter (where session_start is not null) as kept_windows from sraw""")
    q["session_features"] = _sql(feat30, f"select {FEATURE_SELECT} from sfeat")
    q["session_features_12h"] = _sql(f"{EV},\n{sessions_cte('12 hour')}", f"select {FEATURE_SELECT} from sfeat")
    q["time_split"] = _sql(SCORED, "select user_session, window_start, session_start, split from labelled")
    q["class_balance"] = _sql(SCORED, "select label, count(*) as n from labelled where split = 'train' group by label")
    q["class_weights"] = _sql(SCORED, """, cb as (select label, count(*) as n from labelled where split = 'train'
                                                  group by label),
        r as (select case when coalesce(sum(n) filter (where label = 1), 0) > 0
                          then coalesce(sum(n) filter (where label = 0), 0) / sum(n) filter (where label = 1)
                          else 1.0 end as ratio from cb)
        select label, n, round(case when label = 1 then (select ratio from r) else 1.0 end, 6) as class_weight
        from cb""")
    q["purchase_rate"] = _sql(feat30, """select count(*) as n_sessions, cast(sum(label) as bigint) as n_purchased,
        round(100.0 * cast(sum(label) as double) / greatest(count(*), 1), 6) as purchase_pct from sfeat""")
    q["threshold_sweep"] = _sql(SWEEP, "select threshold, tp, fp, fn, round(precision, 6) as precision, "
                                       "round(recall, 6) as recall, round(f1, 6) as f1 from sweep2")
    q["best_threshold"] = _sql(SWEEP, "select threshold, round(f1, 6) as f1, round(precision, 6) as precision, "
                                      "round(recall, 6) as recall from best")
    q["auc_ranksum"] = _sql(SCORED + """,
        test as (select 'rule' as score, purchase_probability as p, label from labelled where split = 'test'
                 union all select 'price', avg_price, label from labelled where split = 'test')""",
                            "select score, round(auc, 6) as auc, n_pos, n_neg from " + auc_sql("test", "p", "score") + " a")
    q["classification_metrics"] = _sql(SWEEP, """,
        t as (select * from labelled where split = 'test'),
        c as (select count(*) as n,
                     count(*) filter (where label = 1 and purchase_probability >= (select threshold from best)) as tp,
                     count(*) filter (where label = 0 and purchase_probability >= (select threshold from best)) as fp,
                     count(*) filter (where label = 1 and purchase_probability < (select threshold from best)) as fn,
                     count(*) filter (where label = 0 and purchase_probability < (select threshold from best)) as tn
              from t),
        d as (select *,
                     case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as p1,
                     case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as r1,
                     case when tn + fn > 0 then tn / (tn + fn) else 0.0 end as p0,
                     case when tn + fp > 0 then tn / (tn + fp) else 0.0 end as r0,
                     case when n > 0 then (tp + fn) / n else 0.0 end as w1,
                     case when n > 0 then (tn + fp) / n else 0.0 end as w0
              from c)
        select n, tp, fp, fn, tn,
               round(case when n > 0 then (tp + tn) / n else 0.0 end, 6) as accuracy,
               round(w1 * p1 + w0 * p0, 6) as weighted_precision,
               round(w1 * r1 + w0 * r0, 6) as weighted_recall,
               round(p1, 6) as precision_purchase, round(r1, 6) as recall_purchase,
               round(case when w1 > 0 then p1 / w1 end, 6) as lift,
               (select threshold from best) as decision_threshold
        from d""")
    q["promotion_decision"] = _sql(DECISIONS, """select day, round(auc_challenger, 6) as auc_challenger, n_pos, n_neg,
        round(auc_champion, 6) as auc_champion, round(improvement, 6) as improvement, promoted from decisions""")
    q["registry_state"] = _sql(DECISIONS, """,
        act as (select arg_max(version, (created_at, version)) as v from reg where promoted)
        select version, trained_on, round(auc_score, 6) as auc_score, promoted, created_at,
               coalesce(version = (select v from act), false) as is_active,
               (select count(*) from reg) as n_models
        from reg""")
    q["registry_listing"] = _sql(DECISIONS, """,
        act as (select arg_max(version, (created_at, version)) as v from reg where promoted)
        select version, trained_on, round(auc_score, 6) as auc_score, promoted, created_at,
               coalesce(version = (select v from act), false) as is_active,
               (select count(*) from reg) as n_models, left(version, 8) as short_version
        from reg""")
    q["active_champion"] = _sql(DECISIONS, """select version, trained_on, round(auc_score, 6) as auc_score, promoted,
        created_at from reg where promoted order by created_at desc, version desc limit 1""")
    q["registry_history"] = _sql(DECISIONS, """select version, trained_on, round(auc_score, 6) as auc_score, promoted,
        created_at, row_number() over (order by created_at, version) as position from reg""")
    q["running_counters"] = _sql(PREDICTIONS, "select metric_key, metric_value from counters")
    q["headline_stats"] = _sql(PREDICTIONS, """,
        h as (select coalesce(max(metric_value) filter (where metric_key = 'total_predictions'), 0) as tot,
                     coalesce(max(metric_value) filter (where metric_key = 'purchase_predicted'), 0) as pur
              from counters)
        select tot as total_predictions, pur as purchase_predicted, tot - pur as no_purchase_predicted,
               round(case when tot > 0 then pur / tot * 100 else 0.0 end, 6) as purchase_rate,
               round(case when tot > 0 then round(pur / tot * 100, 2) else 0.0 end, 6) as purchase_rate_api,
               (select max(scored_at) from pred) as latest_scored_at
        from h""")
    q["avg_probability"] = _sql(PREDICTIONS, """select round(coalesce(avg(purchase_probability) filter
        (where scored_at >= (select as_of from latest) - interval 30 minute), 0.0), 6) as avg_probability from pred""")
    q["trend"] = _sql(PREDICTIONS, """,
        b as (select date_trunc('minute', scored_at) as minute_ts, count(*) as total,
                     count(*) filter (where predicted_label) as purchases
              from pred where scored_at >= (select as_of from latest) - interval 30 minute
              group by 1 order by 1 desc limit 30)
        select minute_ts, strftime(minute_ts, '%m-%d %H:%M') as minute, total, purchases,
               round(case when total > 0 then round(purchases / total * 100, 1) else 0.0 end, 6) as purchase_rate
        from b""")
    q["stream_sessions"] = _sql(f"{EV_SEC},\n{sessions_cte('30 minute')}", f"""select
        user_session, window_start, window_end, session_start, session_end, view_count, cart_count, remove_count,
        distinct_products, distinct_categories, distinct_brands, round(avg_price, 6) as avg_price,
        round(max_price, 6) as max_price, session_duration_sec, has_cart
        from sfeat where window_end <= (select max(event_time) from ev) - interval 30 minute""")
    q["archive_stream"] = _sql(EV_SEC, "select event_type, cast(event_time as date) as event_date, "
                                       "count(*) as n_events from ev group by 1, 2")
    q["recent_predictions"] = _sql(PREDICTIONS, """select user_session, round(purchase_probability, 6)
        as purchase_probability, predicted_label, model_version, scored_at from pred
        order by scored_at desc, user_session asc, event_time desc limit 20""")
    # at most three events a session here: the estimate is exact
    q["approx_distincts"] = _sql(feat30, "select user_session, window_start, distinct_products, distinct_categories, "
                                         "distinct_brands from sfeat")
    keys = "select user_session, session_end as event_time, '{v}' as model_version, true as probability_valid from {t}"
    q["score_sessions"] = _sql(SCORED, keys.format(v="lr", t="labelled"))
    q["stream_scoring"] = _sql(f"{EV_SEC},\n{sessions_cte('30 minute')}", keys.format(v="v1", t="sfeat")
                               + " where window_end <= (select max(event_time) from ev) - interval 30 minute")
    for key, model_type in (("train_lr", "logistic_regression"), ("train_rf", "random_forest"), ("train_gbt", "gbt")):
        q[key] = _sql(SCORED, f"""select '{model_type}' as model_type, count(*) filter (where split = 'train') as train_rows,
            count(*) filter (where split = 'val') as val_rows, count(*) filter (where split = 'test') as test_rows,
            count(*) filter (where split = 'train' and label = 0) as negatives,
            count(*) filter (where split = 'train' and label = 1) as positives,
            round(count(*) filter (where split = 'train' and label = 0)
                  / nullif(count(*) filter (where split = 'train' and label = 1), 0), 6) as weight_ratio,
            true as metrics_valid from labelled""")
    slopes = ", ".join(f"('{c}')" for c in [*FEATURE_COLS, "intercept"])
    q["lr_optimum"] = f"select feature, true as at_optimum from (values {slopes}) t(feature)"
    q["installed_threshold"] = _sql(SCORED, """select model_type, count(*) filter (where split = 'test') as n_scored, 0::bigint as n_faults
        from labelled, (values ('logistic_regression'), ('random_forest')) m(model_type) group by model_type""")
    q["retrain_cycle"] = _sql(f"{EV},\n{sessions_cte('12 hour')}", """select version, version = 'v1' as promoted, version = 'v1' as is_active,
        count(*) as n_sessions, sum(label)::bigint as n_purchased from sfeat, (values ('v1'), ('v2')) m(version) group by version""")
    q["lake_presence"] = _sql(EV, """select folder, folder <> 'missing' as present, folder = 'finished' as complete,
        case when folder like '%finished' then n end as n_events
        from (values ('missing'), ('empty'), ('unfinished'), ('finished')) f(folder), (select count(*) as n from ev)""")
    return q
