"""ANSI SQL for every query, for an independent engine over the same tables."""

from __future__ import annotations

USERS = """
select concat('u-', cast(e.event_id as varchar)) as id,
       case when e.event_id % 29 = 0 then null
            when e.user_id % 2 = 0 then 'female' else 'male' end as gender,
       case when e.event_id % 23 = 0 then null
            else cast(e.event_id % 91 as int) end as age,
       case when e.event_id % 31 = 0 then null else n.n_name end as country,
       e.ts as ts, e.event_id as number
from events e
join customer c on e.user_id = c.c_custkey
join nation n on c.c_nationkey = n.n_nationkey
"""

BRACKET = """case when age < 18 then '0-17'
     when age between 18 and 24 then '18-24'
     when age between 25 and 34 then '25-34'
     when age between 35 and 44 then '35-44'
     when age between 45 and 54 then '45-54'
     when age between 55 and 64 then '55-64'
     else '65+' end"""

POSITION = f"""case {BRACKET} when '0-17' then 1 when '18-24' then 2 when '25-34' then 3
     when '35-44' then 4 when '45-54' then 5 when '55-64' then 6 else 7 end"""

MINUTE = "date_trunc('minute', ts)"
MICROS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def _text(column: str) -> str:
    """A string column as JSON text."""
    return f"""coalesce('"' || {column} || '"', 'null')"""


def _number(column: str) -> str:
    """A number column as JSON text."""
    return f"coalesce(cast({column} as varchar), 'null')"


AGES = f"select {BRACKET} as age_group, count(*) as count from u group by 1"
GENDERS = "select gender, count(*) as count from u group by gender"
COUNTRIES = "select country, count(*) as count from u group by country"
MEANS = "select country, avg(age) as avg_age, count(*) as count from u group by country"
INFLOW = f"""select {MINUTE} as window_start, {MINUTE} + interval 1 minute as window_end,
       count(*) as count from u group by 1, 2"""
BARS = f"""select {BRACKET} as age_group, count(*) as count,
       cast({POSITION} as int) as position from u group by 1, 3"""
RECORD = f"""concat('{{"id":', {_text("id")}, ',"gender":', {_text("gender")},
       ',"age":', {_number("age")}, ',"location":{{"country":', {_text("country")},
       '}},"timestamp":', {_text(MICROS)}, '}}')"""
BIRTH = f"""concat('{{"date":', {_text(MICROS)}, ',"age":', {_number("age")}, '}}')"""
RAW_RECORD = f"""concat('{{"gender":', {_text("gender")},
       ',"name":{{"first":', {_text("id")}, ',"last":"User"}},"location":{{"country":',
       {_text("country")}, ',"coordinates":{{"latitude":"', number % 90,
       '.25","longitude":"', -(number % 180), '.5"}}}},"login":{{"uuid":', {_text("id")},
       '}},"dob":', {BIRTH}, ',"nat":', case when number % 7 <> 0 then '"NA"' else 'null' end,
       '}}')"""
SPACED_RECORD = f"""concat('{{"id": ', {_text("id")}, ', "gender": ', {_text("gender")},
       ', "age": ', {_number("age")}, ', "location": {{"country": ', {_text("country")},
       '}}, "name": "Jos\\u00e9 \\"', id, '\\" \\ud83d\\ude00\\n", "tags": [', {_text("gender")},
       ', null], "share": ', cast(number / 8.0e0 as varchar), '}}')"""
DAMAGED = "number % 17 = 0 or number % 19 = 0 or number % 37 = 0"
# Bodies that begin with a whole record; read alone, it counts.
GLUED = "number % 41 = 0 or number % 43 = 0 or number % 47 = 0 or number % 53 = 0"
CHANGED = "age >= 65 or country is null"
RAW_USERS = """select id, gender, age, country,
       case when number % 7 <> 0 then 'NA' end as nationality from u"""
CLOSED = f"""select * from ({INFLOW})
       where window_end <= (select max(ts) from u) - interval 1 minute"""


# Every 17th user of the earlier half lands with the later one, and is too late unless
# its window is open yet. Times far ahead count at the arrival, which is ``ts``.
UNTRUSTED = f""", m as (select make_timestamp(epoch_us(min(ts))
         + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2) as middle from events),
     w as (select max(ts) - interval 1 minute as seen from u, m
       where ts < middle and number % 17 <> 0)
select {MINUTE} as window_start, {MINUTE} + interval 1 minute as window_end,
       count(*) as count
from u, m, w
where (ts < middle and number % 17 <> 0 or {MINUTE} + interval 1 minute > seen)
  and {MINUTE} + interval 1 minute <= (select max(ts) from u) - interval 1 minute
group by 1, 2"""


# What the first landing closes: every 17th user of it comes with the second.
LATE = f"""select id, ts, seen as watermark from u, (select make_timestamp(epoch_us(min(ts))
         + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2) as middle from events) m,
       (select max(ts) - interval 1 minute as seen from u, (select make_timestamp(epoch_us(min(ts))
         + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2) as middle from events) m
        where ts < middle and number % 17 <> 0) w
where ts < middle and number % 17 = 0 and {MINUTE} + interval 1 minute <= seen"""


def _long(inflow: str) -> str:
    """All results in one list; they share the columns ``series``, ``count``, ``avg_age``."""
    return f"""select 'gender_distribution' as result, gender as series, count(*) as count,
       cast(null as double) as avg_age from u group by gender
union all select 'age_distribution', {BRACKET}, count(*), null from u group by 2
union all select 'country_distribution', country, count(*), null from u group by country
union all select 'user_inflow', strftime(window_start, '%Y-%m-%d %H:%M:%S'), count, null
       from ({inflow})
union all select 'avg_age_by_country', country, count(*), avg(age) from u group by country"""


LONG = _long(INFLOW)

ONE_PASS = f"""select 'gender_distribution' as result, gender,
       cast(null as varchar) as age_group, cast(null as varchar) as country,
       cast(null as timestamp) as window_start, cast(null as timestamp) as window_end,
       avg(age) as avg_age, count(*) as count from u group by gender
union all select 'age_distribution', null, {BRACKET}, null, null, null, avg(age), count(*)
       from u group by 3
union all select 'avg_age_by_country', null, null, country, null, null, avg(age), count(*)
       from u group by country
union all select 'user_inflow', null, null, null, {MINUTE}, {MINUTE} + interval 1 minute,
       avg(age), count(*) from u group by 5, 6"""

SPREAD = """select concat('s-', cast(case when number % 2 = 0 then number & -number else number end
       as varchar)) as series, count(*) as count from u group by 1 order by 2 desc, 1 limit 10"""


def _ranges(columns: str, edges: str) -> str:
    """Counts of users whose minute lies in ranges, given by minutes from the first and last."""
    return f"""select {columns}, count(*) as count from u,
       (select min({MINUTE}) as lo, max({MINUTE}) as hi from u),
       (values {edges}) as edges(range, a, b)
where {MINUTE} >= lo + to_minutes(a) and {MINUTE} < hi + to_minutes(b) group by 1"""


_BODIES = {
    "gender_distribution": GENDERS,
    "age_distribution": AGES,
    "age_distribution_known": f"""select case when age is null then 'unknown'
       else {BRACKET} end as age_group, count(*) as count from u group by 1""",
    "age_distribution_by_batch": f"""select {BRACKET} as age_group, count(*) as count,
       cast(date_trunc('day', ts) as timestamp) as batch_ts from u group by 1, 3""",
    "country_distribution": COUNTRIES,
    "avg_age_by_country": MEANS,
    "user_inflow": INFLOW,
    "inflow_by_arrival": INFLOW,
    "inflow_by_processing_time": """select timestamp '2024-02-01 12:30:00' as window_start,
       timestamp '2024-02-01 12:31:00' as window_end,
       timestamp '2024-02-01 12:30:45' as timestamp, count(*) as count from u""",
    "analytics_in_one_pass": ONE_PASS,
    "user_inflow_recent": f"""select {MINUTE} as window_start, count(*) as count from u
       where {MINUTE} between (select max({MINUTE}) from u) - interval 36 hours
         and (select max({MINUTE}) from u) - interval 12 hours group by 1""",
    "inflow_of_ranges": _ranges("range", "(0, 0, 1), (1, 7, -11), (2, 4321, -1560)"),
    "inflow_of_range_by_gender": _ranges("gender", "(1, 7, -11)"),
    "inflow_by_hour": """select cast(date_trunc('hour', ts) as timestamp) as window_start,
       cast(date_trunc('hour', ts) as timestamp) + interval 1 hour as window_end,
       count(*) as count from u group by 1, 2""",
    "gender_share": """select gender, count(*) as count,
       100.0e0 * count(*) / sum(count(*)) over () as percent from u group by gender""",
    "latest_by_gender": """select gender, arg_max(count, d) as count from
       (select gender, date_trunc('day', ts) as d, count(*) as count from u group by 1, 2)
       group by gender""",
    "age_bars": BARS,
    "top_countries": """select country, count(*) as count from u
       where country is not null group by country order by count desc, country limit 10""",
    "top_frequent": SPREAD,
    "stream_top_frequent": SPREAD,
    "stream_inflow_levels": f"""select cast(date_trunc('hour', window_start) as timestamp)
       as window_start, cast(sum(count) as bigint) as count from ({CLOSED}) group by 1""",
    "user_total": "select count(*) as total from u",
    "country_markers": f"""select country, avg_age, count,
       case when hi = lo then 2.0e0
            else 2.0e0 + 13.0e0 * (cast(count - lo as double) / (hi - lo)) end as size,
       case when avg_age is null then null when old = young then 0.0e0
            else (avg_age - young) / (old - young) end as heat,
       case when avg_age >= 80 then 'red' else 'green' end as band
       from ({MEANS}), (select min(count) as lo, max(count) as hi,
            min(avg_age) as young, max(avg_age) as old from ({MEANS}))""",
    "inflow_bands": f"""select {MINUTE} as window_start, count(*) as count,
       case when count(*) >= 80 then 'red' else 'green' end as band from u group by 1""",
    "parse_normalized": "select id, gender, age, country, ts from u",
    "parse_declared": f"""select id, gender, cast(null as varchar) as name,
       cast(null as varchar) as email, cast(null as varchar) as dob, age,
       cast(null as varchar) as nationality, {MICROS} as timestamp, country from u""",
    "parse_declared_raw_shape": f"""select cast(null as varchar) as id, gender,
       concat('{{"first":', {_text("id")}, ',"last":"User"}}') as name, {BIRTH} as dob,
       cast(null as int) as age, country, cast(null as varchar) as nationality from u""",
    "parse_normalized_raw_shape": """select id, gender, age, country,
       case when number % 7 <> 0 then 'NA' end as nationality,
       cast(concat(cast(number % 90 as varchar), '.25') as double) as latitude,
       cast(concat(cast(-(number % 180) as varchar), '.5') as double) as longitude
       from u""",
    "parse_unknown_keys": """select case when number % 17 <> 0 then id end as id,
       case when number % 17 <> 0 then country end as country,
       case when number % 17 <> 0 then 'x' end as os,
       case when number % 17 <> 0 then cast(number % 5 as int) end as version,
       case when number % 17 <> 0 then cast(number as bigint) end as street,
       cast(null as varchar) as declared from u""",
    "malformed_counted": f"""select case when {DAMAGED} then null else gender end as gender,
       count(*) as count from u group by 1""",
    "malformed_skipped": f"""select gender, count(*) as count from u
       where not ({DAMAGED} or {GLUED}) group by gender""",
    "publish_messages": f"""select concat('{{"uuid":', {_text("id")}, '}}') as key,
       {RECORD} as value from u""",
    "publish_raw_messages": f"""select concat('{{"uuid":', {_text("id")}, '}}') as key,
       {RAW_RECORD} as value from u""",
    "publish_spaced_messages": f"""select concat('{{"uuid": ', {_text("id")}, '}}') as key,
       {SPACED_RECORD} as value from u""",
    "publish_respaced_records": f"""select concat('{{"uuid": ', {_text("id")}, '}}') as key,
       {RAW_RECORD.replace('":', '": ').replace(',"', ', "')} as value from u""",
    "split_responses": """select id, gender, age, country, cast(null as varchar) as rejected
       from u, range(2) where number % 11 <> 0 and number % 37 <> 0
       union all select null, null, null, null, case when number % 11 = 0
         then concat('{"error":"', id, '"}') else concat(id, ' oops') end
       from u where number % 11 = 0 or number % 37 = 0""",
    "find_users": """select id, gender, country from u
       where gender is not distinct from null and age >= 65""",
    "find_users_equal": """select id, gender, age, country, ts from u
       where gender = 'male' and country is null""",
    "find_events": "select event_id, user_id from events where event_type = 'error'",
    "find_by_notes": """select * exclude (number) from u where age between 30 and 33
       and (country in ('FRANCE', 'CHINA') or country is null)
       union all select * exclude (number) from u where id in ('u-5', 'u-77', 'u-none')""",
    "append_users": "select id, gender, age, country, ts from u",
    "replace_result": """select gender, count(*) as count, cast(1 as bigint) as batch_id
       from u group by gender""",
    "upsert_users": f"""select id, case when {CHANGED} then null else gender end as gender,
       case when {CHANGED} then age + 1 else age end as age, country, ts from u""",
    "upsert_bucketed_users": f"""select id, case when {CHANGED} then null else gender end as gender,
       case when {CHANGED} then age + 1 else age end as age, country, ts from u""",
    "latest_users": """select id, gender, age, country, ts from u where country is not null
       qualify row_number() over (partition by country order by ts desc) = 1""",
    "stream_latest_users": """select concat('c-', cast(number % 500 as varchar)) as id, gender, age,
       country, ts from u qualify row_number() over (partition by number % 500 order by ts desc) = 1""",
    "append_one_user": """select id, gender, age from u
       union all select 'one', null, 30 union all select 'two', 'x', null""",
    "update_where_users": """select id, case when age >= 65 then null else gender end as gender,
       case when age >= 65 then age + 1 else age end as age, country, ts from u
       union all select 'new', null, 1, null, null
       union all select 'other', null, 2, null, null""",
    "update_first_users": """select id, gender, age, case when id = (select min(id) from u
       where gender = 'female') then 'unknown' else country end as country, ts from u""",
    "update_users": f"""select id, case when {CHANGED} then null else gender end as gender,
       case when {CHANGED} then age + 1 else age end as age, country, ts from u
       where country is not null""",
    "set_users": """select id, gender, case when h then age + 1 else age end as age,
       case when h then 'unknown' else country end as country, ts,
       case when h then 'modified' else 'untouched' end as outcome
       from (select *, coalesce(gender = 'female' and country is null, false) as h from u)""",
    "upsert_counts": """select case when country is null then 'inserted'
       when age >= 65 then 'modified' else 'untouched' end as outcome,
       count(*) as count from u group by 1""",
    "documents_view": "select id, strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp from u",
    "json_documents": f"""select concat('{{"age_group":"', age_group, '","count":', count,
       ',"timestamp":"', strftime(day, '%Y-%m-%d %H:%M:%S'),
       '","batch_id":7,"updated_at":"2024-02-01 12:30:45"}}') as document from
       (select {BRACKET} as age_group, cast(date_trunc('day', ts) as timestamp) as day,
               count(*) as count from u group by 1, 2)""",
    "stream_avg_age": MEANS,
    "stream_gender_every": GENDERS,
    "stream_inflow_complete": INFLOW,
    "stream_inflow_append": CLOSED,
    "stream_inflow_update": INFLOW,
    "stream_inflow_by_arrival": INFLOW,
    "stream_inflow_untrusted": UNTRUSTED,
    "stream_age_per_batch": BARS,
    "stream_age_bounded": BARS,
    "stream_all_results": LONG,
    "stream_shared_scan": LONG,
    "stream_snapshot": f"select *, true as of_batch from ({LONG})",
    "stream_change_feed": MEANS,
    "stream_count_changes": """select country, count(*) as more from u
       where ts >= (select make_timestamp(epoch_us(min(ts))
         + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2) from events) group by country""",
    "stream_shared_bounded": _long(CLOSED),
    "stream_parsed_table": GENDERS,
    "backfill_results": LONG,
    "backfill_raw_records": LONG,
    "ingest_raw_records": RAW_USERS,
    "ingest_without_repeats": RAW_USERS,
    "stream_inflow_late_merged": CLOSED,
    "stream_inflow_late_now": INFLOW,
    "stream_late_rows": LATE,
}

ORACLES = {name: f"with u as ({USERS})\n{body}" for name, body in _BODIES.items()}
