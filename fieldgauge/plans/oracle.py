"""The registered queries as plain SQL over the same tables."""

_READINGS = """readings as (
    select *, user_id % 10 + 1 as station_id, event_id as s_no, event_type as battery_status,
        cast(floor(epoch(ts)) as bigint) as status_timestamp,
        cast(json_extract_string(props, '$.k') as int) as humidity,
        cast(floor("value") as int) as temperature,
        cast(event_id % 251 as int) as wind_speed
    from events
), texts as (
    select *, cast(json_object('station_id', station_id, 's_no', s_no,
        'battery_status', battery_status, 'status_timestamp', status_timestamp,
        'weather', json_object('humidity', humidity, 'temperature', temperature,
            'wind_speed', wind_speed)) as varchar) as t
    from readings
)"""

_MESSAGES = f"""{_READINGS}, raw as (
    select event_id as "offset", ts,
        case when event_id % 29 != 0 then cast(user_id as varchar) end as "key",
        case when event_id % 11 = 0 then null
            when event_id % 7 = 0 then 'x' || t
            when event_id % 13 = 0 then left(t, length(t) - 3)
            when event_id % 17 = 0 then replace(t, '"weather"', '"other"')
            when event_id % 19 = 0 then replace(t, '"humidity":', '"humidity":"n/a","h":')
            when event_id % 23 = 0 then replace(t, '"temperature"', '"t"')
            when event_id % 31 = 0 then regexp_replace(t, '"humidity":(\\d+)', '"humidity":"\\1"')
            when event_id % 37 = 0 then regexp_replace(t, '"humidity":(\\d+)', '"humidity":\\1.7')
            when event_id % 41 = 0 then regexp_replace(t, '"humidity":\\d+', '"humidity":true')
            when event_id % 43 = 0 then regexp_replace(t, '"humidity":\\d+', '"humidity":null')
            when event_id % 47 = 0 then t || ' x'
            when event_id % 53 = 0 then replace(t, '"temperature":', '"temperature":1,"temperature":')
            when event_id % 59 = 0 then replace(t, '{{"station_id"', '{{"firmware":"1: a, \\"b\\"","station_id"')
            when event_id % 5 = 0 then chr(9) || chr(10) || ' ' || t
            when event_id % 3 = 0 then replace(t, ',"', ', "')
            else t end as v
    from texts
), checked as (
    select *, coalesce(regexp_matches(v, '^[\\x00-\\x20]*\\{{'), false) as valid,
        -- Text after the document is not looked at, and of a doubled field the last counts.
        replace(regexp_replace(v, ' x$', ''), '"temperature":1,"temperature"', '"temperature"') as j,
        coalesce(json_valid(regexp_replace(v, ' x$', '')), false) as parsable,
        coalesce(json_valid(v), false) as whole
    from raw
), fields as (
    select *,
        case when parsable then try_cast(json_extract_string(j, '$.station_id') as bigint) end as station_id,
        case when parsable then try_cast(json_extract_string(j, '$.s_no') as bigint) end as s_no,
        case when parsable then json_extract_string(j, '$.battery_status') end as battery_status,
        case when parsable then try_cast(json_extract_string(j, '$.status_timestamp') as bigint) end as status_timestamp,
        case when parsable then cast(trunc(try_cast(json_extract_string(j, '$.weather.humidity') as double)) as int) end as humidity,
        case when parsable then cast(trunc(try_cast(json_extract_string(j, '$.weather.temperature') as double)) as int) end as temperature,
        case when parsable then cast(trunc(try_cast(json_extract_string(j, '$.weather.wind_speed') as double)) as int) end as wind_speed
    from checked
), classified as (
    select *, case
        when not valid then 'not an envelope'
        when not parsable then 'unparsable'
        when station_id is null or s_no is null or battery_status is null or status_timestamp is null
            or humidity is null or temperature is null or wind_speed is null
        then 'missing or invalid: ' || concat_ws(', ',
            case when station_id is null then 'station_id' end,
            case when s_no is null then 's_no' end,
            case when battery_status is null then 'battery_status' end,
            case when status_timestamp is null then 'status_timestamp' end,
            case when humidity is null then 'weather.humidity' end,
            case when temperature is null then 'weather.temperature' end,
            case when wind_speed is null then 'weather.wind_speed' end)
        end as reason
    from fields
)"""

_ALERTS = f"""with {_MESSAGES}
select "offset", "key",
    case when temperature is null
        then '{{' || chr(10) || '    "alert": "INVALID DATA"' || chr(10) || '}}' || chr(10)
        else '{{' || chr(10) || '    "alert": "RAIN DETECTED",' || chr(10)
            || '    "humidity": ' || humidity || ',' || chr(10)
            || '    "temperature": ' || temperature || chr(10) || '}}' || chr(10)
    end as "value"
from classified where valid and humidity > 70"""

_DEAD_LETTERS = f"""with {_MESSAGES}
select coalesce("key", 'unknown_station') as "key", v as "value", "offset", reason
from classified where reason is not null"""

_LATEST = """select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type
from events group by user_id"""



def _snapshot(value: str) -> str:
    return f"""with {_MESSAGES}, k as (
    select coalesce("key", 'unknown_station') as "key", v, whole, "offset" as version from checked where valid
), l as (
    select "key", arg_max(v, version) as v, arg_max(whole, version) as whole from k group by "key"
)
select "key", {value} as "value" from l"""


_EVENT_ROWS = 'select event_id, user_id, event_type, "value" from events'

_FEED = """with fed as (
    select *, cast(11 as bigint) as station_id, 'high' as battery_status,
        cast(floor(epoch(ts)) as bigint) as status_timestamp,
        case when event_id % 11 = 0 then 'no document'
            when event_id % 13 = 0 or event_id % 17 = 0 then 'unparsable' end as reason,
        case when event_id % 19 = 0 then 0 else 1 end as numbers,
        case when event_id % 7 = 0 then 0 else 1 end as warm,
        case when reason is null then numbers * cast(json_extract_string(props, '$.k') as int) end as humidity,
        case when reason is null then numbers * warm * cast(trunc("value") as int) end as temperature,
        case when reason is null then numbers * cast(trunc("value" / 2) as int) end as wind_speed
    from events
)"""

_SLICE = """select event_id, user_id, "value" from events
where event_type = 'view' and year(ts) = 2024 and month(ts) = 1"""

_LINES = """with l as (
    select doc_id, unnest(string_split("text", chr(10))) as line,
        unnest(range(1, len(string_split("text", chr(10))) + 1)) as line_no
    from documents
)"""

_PAIRS = f"""{_LINES}, p as (
    select *, lead(line) over (partition by doc_id order by line_no) as next from l
)
select doc_id, cast((line_no + 1) // 2 as bigint) as pair_no, line || coalesce(next, '') as pair
from p where line_no % 2 = 1"""


def _runs(rows: str, station: str, seq: str, order: str) -> str:
    return f"""with r as ({rows}), p as (
    select *, lag({seq}) over (partition by {station} order by {order}) as prev from r
), n as (
    select *, sum(case when {seq} < prev then 1 else 0 end)
        over (partition by {station} order by {order}) as run
    from p
)
select {station}, cast(run as bigint) as run, min({seq}) as first_no, max({seq}) as last_no,
    count(*) as messages, count(distinct {seq}) as received,
    max({seq}) - min({seq}) + 1 - count(distinct {seq}) as dropped
from n group by {station}, run"""


# The batch that an event arrives in.
_PARTS = """parts as (
    select *, event_id * 4 // (select max(event_id) + 1 from events) as part from events
)"""

# What is sent, when it arrives, and the watermark of its batch: the greatest time of the
# batches before, in whole milliseconds, less a day.
_ARRIVALS = f"""with {_PARTS}, sent as (
    select event_id, user_id, epoch_us(ts) as at_micros, part, epoch_us(ts) as first_micros, part as first_part from parts
    union all
    select event_id, user_id, epoch_us(ts) + case when event_id % 10 = 2 then 4 * 86400000000 else 0 end,
        part + case when event_id % 10 = 0 then 0 else 1 end, epoch_us(ts), part
    from parts where event_id % 10 < 3
), marks as (
    select b.part, (select max(at_micros) // 1000 * 1000 - 86400000000 from sent where sent.part < b.part) as watermark
    from (select distinct part from sent where part < 4) b
), judged as (
    -- A row that was kept is remembered until the watermark is a day past it.
    select sent.*, at_micros > coalesce(watermark, -1) as in_time,
        first_part = sent.part or first_micros + 86400000000 <= watermark as forgotten
    from sent join marks on marks.part = sent.part
)
select distinct event_id, user_id, at_micros from judged where in_time and forgotten"""

ORACLE = {
    "parquet_scan": "select * from orders",
    "latest_per_key": """select user_id, max(event_id) as event_id, arg_max(ts, event_id) as ts,
    arg_max(event_type, event_id) as event_type, arg_max("value", event_id) as "value"
from events group by user_id""",
    "latest_orders": """select o_custkey, o_orderkey, o_orderdate, o_totalprice from (
    select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
    from orders) where rn = 1""",
    "lookup": f"select * from ({_LATEST}) where user_id = 7",
    "alert_filter": """select event_id, cast(json_extract_string(props, '$.k') as int) as k
from events where cast(json_extract_string(props, '$.k') as int) > 70""",
    "alert_render": _ALERTS,
    "route": f'with {_MESSAGES} select "offset", valid from checked',
    "default_key": f"""with {_MESSAGES}
select "offset", coalesce("key", 'unknown_station') as "key" from raw""",
    "classify_messages": f'with {_MESSAGES} select "offset", reason from classified',
    "dead_letters": _DEAD_LETTERS,
    "parse_envelope": f"""with {_MESSAGES}
select station_id, s_no, battery_status, status_timestamp, humidity, temperature, wind_speed
from classified where reason is null""",
    "envelope_json": f'with {_READINGS} select event_id, t as "value" from texts',
    "keyed_rows": f"""with {_READINGS}
select cast(station_id as varchar) as "key", t as "value" from texts""",
    "normalise_value": f"""with {_MESSAGES}
select "offset", case when valid and whole then cast(json(v) as varchar) else v end as "value" from checked""",
    "normalise_spaced": f"""with {_MESSAGES}, marked as (
    select *, regexp_replace(cast(json(case when valid and whole then v end) as varchar),
        '("(?:\\\\.|[^"\\\\])*")|([:,])', '\\1\\2' || chr(1), 'g') as m
    from checked
)
select "offset", coalesce(replace(replace(m, '"' || chr(1), '"'), chr(1), ' '), v) as "value" from marked""",
    "adapt_feed": f"""{_FEED} select event_id,
    row_number() over (partition by event_type order by event_id) as s_no,
    station_id, battery_status, status_timestamp, humidity, temperature, wind_speed
from fed where reason is null""",
    "adapt_feed_by_offset": f"""{_FEED} select event_id + 1 as s_no, station_id, battery_status,
    status_timestamp, humidity, temperature, wind_speed, reason from fed""",
    "status_share": """select user_id, event_type, count(*) as n,
    cast(count(*) as double) * 100 / cast(sum(count(*)) over (partition by user_id) as double) as pct
from events group by user_id, event_type""",
    "sequence_audit": """select l_orderkey, min(l_linenumber) as first_no, max(l_linenumber) as last_no,
    count(distinct l_linenumber) as received,
    cast(max(l_linenumber) - min(l_linenumber) + 1 - count(distinct l_linenumber) as bigint) as dropped
from lineitem group by l_orderkey""",
    "sequence_runs": _runs(
        "select distinct l_suppkey, l_partkey, l_orderkey from lineitem",
        "l_suppkey",
        "l_orderkey",
        "l_partkey, l_orderkey",
    ),
    "sequence_runs_by_offset": _runs(
        "select event_type, user_id, event_id from events", "event_type", "user_id", "event_id"
    ),
    "cadence_audit": """select user_id, expected, received, n - received as repeated, expected - received as dropped
from (
    select user_id, count(*) as n, count(distinct floor(epoch(ts))) as received,
        cast(floor(epoch(max(ts))) - floor(epoch(min(ts))) + 1 as bigint) as expected
    from events group by user_id)""",
    "archive_counts": """select event_type, cast(year(ts) as int) as year,
    strftime(ts, '%m') as month, count(*) as n
from events group by all""",
    "snapshot_lines": """select user_id || ',' || arg_max(props, event_id) as "value"
from events group by user_id""",
    "count_lines": f"{_LINES} select count(*) as n from l where contains(line, 'license')",
    "select_lines": f"{_LINES} select * from l where regexp_matches(line, 'license|email|the')",
    "pair_lines": _PAIRS,
    "pair_text": _PAIRS,
    "pair_selected_lines": """with s as (
    select *, row_number() over (partition by user_id order by event_id) as i,
        lead(event_type) over (partition by user_id order by event_id) as second
    from events where regexp_matches(event_type, 'view|click|error')
)
select user_id, cast((i + 1) // 2 as bigint) as pair_no, event_type as first, second,
    concat_ws('+', event_type, second) as pair
from s where i % 2 = 1""",
    "top_k": """select user_id, count(*) as n from events
group by user_id order by n desc, user_id limit 10""",
    "top_k_weighted": """select user_id, cast(sum(cast(round("value" * 100) as bigint)) as bigint) as weight
from events group by user_id order by weight desc, user_id limit 10""",
    "allocation_top_k": """select event_type as object_class,
    cast(sum(cast(json_extract_string(props, '$.k') as int)) * 1024 as bigint) as weight
from events group by event_type order by weight desc, object_class limit 10""",
    "top_pairs": """select 'objectClass = ' || event_type || ' weight = ' || json_extract_string(props, '$.k')
    || ' kB' as pair, count(*) as n
from events group by pair order by n desc, pair limit 10""",
    "max_duration": """select "value" * case user_id % 3 when 0 then 0.001::double
        when 1 then 1.0::double else 1000.0::double end as max_ms,
    'duration = ' || "value" || case user_id % 3 when 0 then ' us' when 1 then ' ms' else ' s' end as line
from events order by max_ms desc, line desc limit 1""",
    "archive_round_trip": """select event_id, user_id, event_type, "value",
    cast(year(ts) as int) as year, cast(month(ts) as int) as month from events""",
    "slice": _SLICE,
    "slice_folder": _SLICE,
    "snapshot_csv": _snapshot("replace(v, chr(10), ' ')"),
    "snapshot_csv_quoted": _snapshot("v"),
    "export_json": _snapshot("case when whole then cast(json(v) as varchar) else v end"),
    "index_export": _EVENT_ROWS,
    "feed_scan": """select strftime(ts, '%Y-%m-%dT%H:%M') as "time", "value" as temperature_2m,
    cast(json_extract_string(props, '$.k') as double) as relative_humidity_2m,
    "value" / 2 as wind_speed_10m from events""",
    "compact_rebuild": _LATEST,
    "stream_dead_letters": _DEAD_LETTERS,
    "stream_archive": f"""with {_MESSAGES}
select station_id, s_no, battery_status, status_timestamp, humidity, temperature, wind_speed,
    cast(year(make_timestamp(status_timestamp * 1000000)) as int) as year,
    cast(month(make_timestamp(status_timestamp * 1000000)) as int) as month
from classified where reason is null""",
    "stream_view": f"""with {_MESSAGES}
select coalesce("key", 'unknown_station') as "key", v as "value", "offset" from checked where valid
qualify row_number() over (partition by coalesce("key", 'unknown_station') order by ts desc, "offset" desc) = 1""",
    "stream_view_partitions": f"""with {_MESSAGES}
select coalesce("key", 'unknown_station') as "key", v as "value",
    cast("offset" % 4 as int) as "partition", "offset" // 4 as "offset" from checked where valid
qualify row_number() over (partition by coalesce("key", 'unknown_station')
    order by ts desc, checked."offset" % 4 desc, checked."offset" // 4 desc) = 1""",
    "archive_compaction": f"""with {_MESSAGES}
select station_id, s_no, battery_status, status_timestamp, humidity, temperature, wind_speed,
    cast(year(make_timestamp(status_timestamp * 1000000)) as int) as year,
    cast(month(make_timestamp(status_timestamp * 1000000)) as int) as month, true as fewer_files
from classified where reason is null""",
    "json_document": _snapshot("case when whole then cast(json(v) as varchar) else v end"),
    "clustered_span": """select event_id, user_id, cast(floor(epoch(ts)) as bigint) as at from events
where user_id between 40 and 49 and cast(floor(epoch(ts)) as bigint) between 1704412800 and 1704412800 + 3 * 86400 - 1""",
    "merged_small_files": f"""with {_MESSAGES}
select station_id, s_no, battery_status, status_timestamp, humidity, temperature, wind_speed,
    cast(year(make_timestamp(status_timestamp * 1000000)) as int) as year,
    cast(month(make_timestamp(status_timestamp * 1000000)) as int) as month
from classified where reason is null""",
    "lookup_many": f"""select * from ({_LATEST})
where user_id in (select user_id from events where event_type = 'signup' and "value" > 60)""",
    "lookup_list": f"select * from ({_LATEST}) where user_id in (3, 77, 140, -1)",
    "top_words": """select word, count(*) as n from (select unnest(string_split("text", ' ')) as word from documents)
group by word order by n desc, word limit 10""",
    "compact_files": 'select event_id, "value", true as bounded from events',
    "stream_latest": _LATEST,
    "stream_alerts": _ALERTS,
    "state_view": f"""with {_PARTS}
select b as after_batch, user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type
from parts, (select unnest(range(4)) as b) where part <= b group by user_id, b""",
    "state_changes": f"""with {_PARTS}
select part as batch_id, user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type
from parts group by user_id, part""",
    "stream_first_arrivals": _ARRIVALS,
    "stream_status_windows": """with counted as (
    select cast(floor(epoch(ts) / 86400) as bigint) * 86400 as begins, user_id % 10 + 1 as station_id,
        event_type as status, count(*) as n
    from events group by all
)
select *, round(cast(n as double) * 100 / cast(sum(n) over (partition by begins, station_id) as double), 4) as pct
from counted""",
    "stream_sequence_runs": _runs(
        "select user_id, event_id, event_id % 1001 // 2 as s_no from events", "user_id", "s_no", "event_id"
    ),
    "stream_from_tail": f"""with {_PARTS}
select event_id, user_id, event_type from parts where part > 1""",
    "stream_from_start": "select event_id, user_id, event_type from events",
    "stream_restarted": f"""with {_MESSAGES}
select station_id, s_no, battery_status, status_timestamp, humidity, temperature, wind_speed,
    cast(year(make_timestamp(status_timestamp * 1000000)) as int) as year,
    cast(month(make_timestamp(status_timestamp * 1000000)) as int) as month, true as bounded
from classified where reason is null""",
}
