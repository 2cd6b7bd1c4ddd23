"""The driver's star-schema tables seen as the domain's relations, in Spark and as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: "Now" for views over events, and for views over orders (the day after their last session).
AS_OF_EVENTS = "2024-01-31"
AS_OF_ORDERS = "2001-11-05"

#: Both engines run the same select lists; what differs between their dialects is filled in.
_SPARK = {
    "k": "cast(get_json_object(props, '$.k') as int)",
    "ts": "cast(ts as timestamp)",
    "week": "cast(floor(datediff(ts, date'2024-01-01') / 7) as int)",
    "later": "cast(ts as timestamp) + make_interval(0, 0, 0, 0, 0, 0, k % 5)",
    "region": "element_at(array('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), cast(user_id % 5 as int) + 1)",
    "minute": "make_interval(0, 0, 0, 0, 0, 1, 0)",
    "odd": "cast(substring(p_brand, -1) as int) % 2 = 1",
    "add_days": "date_add({0}, cast({1} as int))",
    "day": "cast({0} as date)",
    # lines are dealt by title, then by order, where they are numbered: no third and fourth time
    "sessions": "(lineitem join part on l_partkey = p_partkey) join (orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey) on l_orderkey = o_orderkey",
}
_DUCK = {
    "k": "cast(json_extract_string(props, '$.k') as int)",
    "ts": "ts",
    "week": "cast(floor(date_diff('day', date '2024-01-01', cast(ts as date)) / 7) as int)",
    "later": "ts + to_seconds(k % 5)",
    "region": "['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'][cast(user_id % 5 as int) + 1]",
    "minute": "interval 1 minute",
    "odd": "cast(right(p_brand, 1) as int) % 2 = 1",
    "add_days": "cast({0} + cast({1} as int) as date)",
    "day": "cast({0} as date)",
    "sessions": """lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey join customer on o_custkey = c_custkey
                 join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
}


def _views(d: dict[str, str]) -> dict[str, str]:
    add = d["add_days"].format
    return {
        "ev0": f"select *, {d['k']} as k, {d['week']} as week from events",
        "v_playback_events": f"""
            select cast(event_id as varchar(20)) as event_id, concat(cast(user_id as varchar(20)), '-', cast(week as varchar(20))) as session_id,
                   user_id as profile_id, (user_id * 31 + week) % 200 as title_id, {d['region']} as region_code,
                   case when event_type in ('view', 'click') then 'HEARTBEAT' when event_type = 'signup' then 'START'
                        when event_type = 'error' then (case when k % 2 = 0 then 'REBUFFER' else 'ERROR' end)
                        when k % 3 = 0 then 'COMPLETE' when k % 3 = 1 then 'SEEK' else 'PAUSE' end as event_type,
                   {d['ts']} as event_ts, {d['later']} as ingest_ts, 10 * k as position_seconds,
                   case user_id % 3 when 0 then 'tv' when 1 then 'mobile' else 'web' end as device_type,
                   concat('1.', cast(user_id % 4 as varchar(20))) as app_version,
                   case when k <> 99 then concat('pop-', cast(user_id % 9 as varchar(20))) end as cdn_pop,
                   800 + 1500 * (k % 6) as bitrate_kbps,
                   case when event_type = 'error' and k % 2 = 0 then cast(round(value * 1000) as int) end as rebuffer_ms,
                   case when event_type = 'signup' then cast(round(value * 50) as int) end as startup_ms,
                   case when event_type = 'error' and k % 2 = 1 then concat('E', cast(k % 3 as varchar(20))) end as error_code,
                   case when user_id % 4 <> 0 then 'treatment' end as ab_bucket
            from ev0""",
        "v_playback_events_raw": f"""
            select * from v_playback_events
            union all
            select event_id, session_id, profile_id, title_id, region_code, event_type, event_ts, ingest_ts + {d['minute']} as ingest_ts, position_seconds,
                   device_type, app_version, cdn_pop, bitrate_kbps, rebuffer_ms, startup_ms, error_code, ab_bucket
            from v_playback_events where position_seconds % 200 = 0""",
        "v_titles": f"""
            select p_partkey as title_id, concat('ref-', cast(p_partkey as varchar(20))) as external_ref, p_name as title_name, p_type as content_type,
                   120 * p_size as runtime_seconds, {add("date '1990-01-01'", 'p_partkey % 3650')} as release_date,
                   case p_partkey % 3 when 0 then 'G' when 1 then 'PG' else 'R' end as maturity_rating, {d['odd']} as is_original,
                   case when p_partkey % 3 <> 0 then {add("date '1997-10-01'", 'p_partkey % 400')} end as licence_expires
            from part""",
        "v_genres": "select cast(row_number() over (order by name) as smallint) as genre_id, name as genre_name from (select p_type as name from part union select p_brand as name from part) g",
        "v_title_genres": """
            select p_partkey as title_id, genre_id from part join v_genres on genre_name = p_type
            union all
            select p_partkey as title_id, genre_id from part join v_genres on genre_name = p_brand where p_partkey % 2 = 0""",
        "v_title_costs": f"""
            select p_partkey as title_id, cast(case when p_partkey % 4 = 0 then 0 else p_retailprice * 100 end as decimal(14,2)) as licence_cost_usd,
                   cast(p_size * 1000 as decimal(14,2)) as production_cost_usd, {add("date '1996-01-01'", 'p_partkey % 500')} as licence_start,
                   {add("date '1996-01-01'", 'p_partkey % 500 + p_size * 10 - 10')} as licence_end,
                   case when p_partkey % 4 = 0 then 'original' else 'licensed' end as cost_type
            from part""",
        "v_regions": """
            select cast(r_regionkey as smallint) as region_id, r_name as region_code, r_name as display_name,
                   case r_regionkey % 3 when 0 then 'provider-a' when 1 then 'provider-b' else 'provider-c' end as cdn_provider
            from region""",
        "v_title_availability": f"""
            select p_partkey as title_id, cast(r_regionkey as smallint) as region_id,
                   cast({add("date '1997-01-01'", '(p_partkey * 7 + r_regionkey * 31) % 500')} as timestamp) as available_from,
                   case when (p_partkey + r_regionkey) % 3 <> 0 then cast({add("date '1997-06-01'", '(p_partkey * 11 + r_regionkey * 17) % 500')} as timestamp) end as available_to
            from part cross join region where (p_partkey + r_regionkey) % 4 <> 0""",
        "v_profiles": "select c_custkey as profile_id, c_custkey as subscriber_id, c_name as display_name, c_custkey % 7 = 0 as is_kids from customer",
        "v_watch_sessions": f"""
            select concat('s', cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20)), '-', cast(row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_shipdate, l_quantity, l_discount, l_extendedprice, l_tax, l_returnflag, l_linestatus) as varchar(20))) as session_id,
                   o_custkey as profile_id, l_partkey as title_id, {d['day'].format('l_shipdate')} as session_date, r_name as region_code,
                   cast(120 * l_quantity as bigint) as seconds_watched, least(1.0, l_quantity / p_size) as completion_ratio, 100 * l_discount as rebuffer_seconds,
                   100 * l_discount / (120 * l_quantity / 3600.0) as rebuffer_seconds_per_hour, l_returnflag = 'R' as explicitly_abandoned,
                   least(1.0, l_quantity / p_size) >= 0.9 as is_completed, 120 * l_quantity >= 30 as is_valid_session, p_type as content_type,
                   case when least(1.0, l_quantity / p_size) >= 0.9 then 1 when least(1.0, l_quantity / p_size) >= 0.25 and l_returnflag <> 'R' then 1 else 0 end as engagement_label
            from {d['sessions']}""",
        "v_subscriptions_log": """
            select o_custkey as subscription_id, o_custkey as subscriber_id,
                   case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'premium' when o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED') then 'standard' else 'basic' end as tier,
                   case o_orderstatus when 'O' then 'active' when 'F' then 'cancelled' else 'paused' end as status, round(o_totalprice / 10000, 2) as monthly_price,
                   cast(o_orderdate as timestamp) as started_at, cast(null as timestamp) as ended_at, cast(o_orderdate as timestamp) as updated_at,
                   'u' as __op, o_orderkey as __lsn, cast(o_orderdate as timestamp) as __source_ts,
                   case when o_orderstatus = 'P' and o_orderkey % 10 = 0 then 'true' end as __deleted
            from orders""",
        "v_title_vectors": "select vec_id as title_id, embedding as vector, label as genre from embeddings",
    }


SPARK_VIEWS, DUCK_VIEWS = _views(_SPARK), _views(_DUCK)
_TABLES = ("events", "part", "orders", "lineitem", "customer", "nation", "region", "embeddings")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views above as a DataFrame; nothing is registered in the session."""
    frames: dict[str, DataFrame] = {}

    def get(n: str) -> DataFrame:
        if n not in frames:
            if n in _TABLES:
                frames[n] = spark.read.parquet(f"{sf_dir}/{n}.parquet")
            else:
                text = SPARK_VIEWS[n]
                words = set(text.replace("(", " ").replace(")", " ").split())
                used = {w: get(w) for w in (*SPARK_VIEWS, *_TABLES) if w in words and w != n}
                for w in used:
                    text = _replace_word(text, w, "{" + w + "}")
                frames[n] = spark.sql(text.replace("varchar(20)", "string"), **used)
        return frames[n]

    return get(name)


def _replace_word(text: str, word: str, by: str) -> str:
    import re

    return re.sub(rf"(?<![\w.{{]){word}(?![\w.}}])", by, text)


def duck(query: str, views: dict[str, str] | None = None) -> str:
    """The query with the views that it uses as common table expressions before it."""
    import re

    all_views = {**DUCK_VIEWS, **(views or {})}
    used: list[str] = []

    def need(text: str) -> None:
        for n, sql in all_views.items():
            if re.search(rf"\b{n}\b", text) and n not in used:
                need(sql)
                if n not in used:
                    used.append(n)

    need(query)
    parts = ",\n".join(f"{n} AS ({all_views[n]})" for n in used)
    q = query.strip()
    if not used:
        return q
    return f"WITH {parts},\n{q[4:].lstrip()}" if q[:5].lower() == "with " else f"WITH {parts}\n{q}"


Views = Callable[[str], DataFrame]
