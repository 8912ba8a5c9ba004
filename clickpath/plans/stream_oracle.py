"""DuckDB SQL twins of the queries in :mod:`clickpath.plans.stream_queries`."""

from __future__ import annotations

from .oracle import EV, EV_SEC, FEATURE_SELECT, oracle_sql as _tables_sql, sessions_cte

_LAST = "(select max(event_time) from ev)"


def stream_oracle_sql() -> dict[str, str]:
    tables = _tables_sql()
    wire30 = f"with {EV_SEC},\n{sessions_cte('30 minute')}\n"
    rejected = "(k % 5 = 0 and event_type in ('signup', 'remove_from_cart'))"
    ingested = f"""with {EV}
        select count(*) filter (where not {rejected}) as n_messages,
               count(distinct user_session) filter (where not {rejected} and not (k % 5 = 0 and event_type = 'purchase')) as n_keys,
               count(*) filter (where {rejected}) as n_rejected
        from ev"""
    return {
        "session_distincts_bitmap": tables["session_distincts"],
        "open_sessions": wire30 + f"""select user_session, window_start, window_end, label, session_start, session_end, view_count, cart_count,
            remove_count, round(avg_price, 6) as avg_price, round(max_price, 6) as max_price
            from sraw where window_end > {_LAST} - interval 30 minute""",
        # a trigger's late rows are judged by the watermark that the trigger before it ran with
        "late_ledger": f"""with {EV_SEC},
            b as (select min(epoch(event_time)::bigint) as lo, max(epoch(event_time)::bigint) as hi from ev),
            cut as (select to_timestamp(lo + cast(trunc((hi - lo) / 2) as bigint))::timestamp as mid from b),
            late as (select distinct user_session, event_time from ev where k % 5 = 0),
            mark as (select max(event_time) - interval 30 minute as w from ev, cut where event_time <= mid)
            select 0::bigint as batch_id, count(*) as input_rows, 0::bigint as dropped_rows from ev, cut where event_time <= mid
            union all select 1, count(*), 0 from ev, cut where event_time > mid
            union all select 2, count(*), count(*) filter (where event_time + interval 30 minute <= w) from late, mark""",
        "capped_intake": f"""with {EV_SEC}
            select cast(floor((k % 6) / 2) as bigint) as batch_id, count(*) as input_rows, (select count(*) from ev) as n_archived from ev group by 1""",
        "two_sinks": wire30 + f"""select 'lake' as sink, count(*) as n_rows from ev
            union all select 'sessions', count(*) from sfeat where window_end <= {_LAST} - interval 30 minute""",
        "merged_sessions": f"with {EV_SEC},\n{sessions_cte('12 hour')}\nselect {FEATURE_SELECT} from sfeat",
        "archive_dedup_stream": f"""with {EV_SEC},
            d as (select distinct event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session from ev)
            select event_type, cast(event_time as date) as event_date, count(*) as n_events from d group by 1, 2""",
        "ingest_stream": ingested,
        "ingest_restart": ingested,
        "trend_partitioned": tables["trend"],
        "recent_partitioned": tables["recent_predictions"],
        "counter_rollup": tables["running_counters"],
        "registry_commits": tables["registry_state"],
    }
