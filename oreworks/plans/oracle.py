"""The same queries as SQL for another engine, over the same tables and whole tables only."""

from __future__ import annotations

from oreworks.functions.text import FAILURE_DETAIL_CHARS, FAILURE_MESSAGE
from oreworks.operators.datagen import NAMES
from oreworks.operators.marts import FUNNEL_STAGES
from oreworks.plans.catalog import DELETE_WHERE, UPDATE_WHERE
from oreworks.spec import PEOPLE

# Views the queries below share: the derived raw rows and the layers over them.
_VIEWS = """
with raw_v as (
  select cast(case when event_id % 37 = 0 then null when event_id % 11 = 0 then event_id - 1
                   else event_id end as integer) as id,
         event_type as name,
         case when event_id % 10 = 0 then null else cast(floor(value) as integer) - 10 end as age,
         ts as ingestion_time,
         case when event_id % 2 = 0 then 'a.csv' else 'b.json' end as source_file,
         event_id
  from events
), first_v as (
  select * exclude (rn) from (
    select *, row_number() over (partition by id order by ingestion_time, event_id) as rn from raw_v)
  where rn = 1
), silver_v as (
  select id, name, coalesce(age, 45) as age, ingestion_time, source_file, event_id,
         cast(ingestion_time as date) as processed_date
  from first_v
), gold_v as (
  select processed_date, avg(age) as average_age, count(*) as total_users
  from silver_v group by processed_date
), drop_silver_v as (
  select id, name, coalesce(age, 45) as age from (
    select *, row_number() over (partition by id order by name nulls last, age nulls last) as rn from raw_v)
  where rn = 1
), dq_v as (
  select count(*) as total_rows,
         count(*) filter (where id is null) as null_ids,
         count(*) filter (where age < 0) as negative_ages,
         count(*) filter (where age > 120) as invalid_ages,
         count(*) - (count(distinct id) + max(case when id is null then 1 else 0 end)) as duplicate_ids
  from raw_v
), v1 as (
  select *, cast(ingestion_time as date) as processed_date from raw_v
), v2 as (
  select * replace (case when UPDATE_WHERE then age * 2 else age end as age) from v1
), v3 as (
  select * from v2 where not coalesce(DELETE_WHERE, false)
)
""".replace("UPDATE_WHERE", UPDATE_WHERE).replace("DELETE_WHERE", DELETE_WHERE)

_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
_DAY = "strftime({}, '%Y-%m-%d')"
_RAW = f"id, name, age, {_TIME.format('ingestion_time')} as ingestion_time, source_file, event_id"
_SILVER = f"{_RAW}, {_DAY.format('processed_date')} as processed_date"
_SILVER_SHORT = f"id, name, age, {_DAY.format('processed_date')} as processed_date"


def _draw(key: str, purpose: str, seed: int = 1) -> str:
    return f"cast('0x' || substr(md5({key} || ':{purpose}:{seed}'), 1, 8) as bigint)"


def _people(source: str, null_rate: float, seed: int = 1) -> str:
    key = "cast(id as varchar)"
    limit = int(null_rate * 2**32)
    return f"""
      select cast(id as integer) as id,
             list_extract({list(NAMES)}, 1 + {_draw(key, 'name', seed)} % {len(NAMES)}) as name,
             case when {_draw(key, 'null_age', seed)} < {limit} then null
                  else cast(18 + {_draw(key, 'age', seed)} % 63 as integer) end as age
      from {source}"""


# The message as an SQL text.
_FAILURE = FAILURE_MESSAGE.replace("'", "''")
_IDS = "(select c_custkey as id from customer)"

_BODIES = {
    "ingest_csv": "select id, name, age from raw_v",
    "ingest_json": "select id, name, age from raw_v",
    "ingest_optional_sources": "select id, name, age from raw_v",
    "union_sources": "select id, name, age from raw_v",
    "bronze": """
        select id, name, age, '2024-02-01 12:00:00.000000' as ingestion_time,
               case when event_id % 2 = 0 then 'csv' else 'json' end as file_kind from raw_v""",
    "bronze_lineage": """
        select case when event_id % 2 = 0 then 'csv' else 'json' end as file_kind,
               count(*) as n_rows, cast(1 as bigint) as n_times
        from raw_v group by 1""",
    "read_layer": f"select {_RAW} from raw_v",
    "write_overwrite": f"select {_RAW} from raw_v where event_id % 2 = 1",
    "write_append": f"select {_RAW} from raw_v",
    "schema_evolution_append": """
        select event_id, id, name, age, cast(null as integer) as x from raw_v where event_id % 2 = 0
        union all
        select event_id, id, name, age, 1 as x from raw_v where event_id % 2 = 1""",
    "partitioned_read": f"select {_SILVER_SHORT} from silver_v where processed_date = date '2024-01-15'",
    "csv_export_roundtrip": f"select {_SILVER_SHORT} from silver_v",
    "silver": f"""
        select {_SILVER}, lower(typeof(ingestion_time)) as time_type, lower(typeof(processed_date)) as date_type from silver_v""",
    "dedup_by_key": f"select {_RAW} from first_v",
    "fill_nulls": "select event_id, id, name, coalesce(age, 45) as age from raw_v",
    "distinct_rows": "select distinct id, name, age from raw_v",
    "dq_metrics": "select * from dq_v",
    "dq_by_source": """
        select source_file, count(*) as total_rows,
               count(*) filter (where id is null) as null_ids,
               count(*) filter (where age < 0) as negative_ages,
               count(*) filter (where age > 120) as invalid_ages,
               count(*) - (count(distinct id) + max(case when id is null then 1 else 0 end)) as duplicate_ids
        from raw_v group by source_file""",
    "dq_gate": """
        select total_rows, null_ids, round(null_ids / total_rows, 9) as null_ids_ratio,
               printf('%.2f%%', 100.0 * null_ids / total_rows) as null_ids_percent,
               null_ids <= 0.5 * total_rows as passed
        from dq_v""",
    "dq_breakdown": " union all ".join(
        f"select '{label}' as violation, {metric} as violations from dq_v"
        for metric, label in [*[(r.metric, r.label) for r in PEOPLE.rules], (PEOPLE.duplicate_metric, PEOPLE.duplicate_label)]
    ),
    "dq_latest": "select *, '2024-02-01 13:00:00.000000' as validation_time from dq_v",
    "gold": f"""
        select {_DAY.format('processed_date')} as processed_date, average_age, total_users,
               lower(typeof(processed_date)) as date_type
        from gold_v""",
    "gold_trend": f"""
        select {_DAY.format('processed_date')} as processed_date, average_age from gold_v order by 1""",
    "layer_counts": """
        select 'bronze' as layer, count(*) as row_count from raw_v
        union all select 'silver', count(*) from silver_v
        union all select 'gold', count(*) from gold_v""",
    "layer_funnel": " union all ".join(
        f"select '{stage}' as stage, count(*) as row_count from {layer if layer != 'bronze' else 'raw'}_v"
        for layer, stage in FUNNEL_STAGES.items()
    ),
    "histogram": """
        select bin, round(lo + bin * w, 6) as bin_start, round(lo + (bin + 1) * w, 6) as bin_end, n from (
          select cast(least(floor((cast(age as double) - lo) / w), 19) as integer) as bin,
                 any_value(lo) as lo, any_value(w) as w, count(*) as n
          from raw_v, (select cast(min(age) as double) as lo, (max(age) - min(age)) / 20.0::double as w from raw_v)
          where age is not null group by 1)""",
    "latest_rows_topk": f"select {_RAW} from raw_v order by ingestion_time desc, event_id desc limit 100",
    "silver_ordered_page": f"""
        select {_SILVER_SHORT} from (
          select * from silver_v order by processed_date desc, id asc nulls first limit 100)""",
    "run_kpis": """
        select (select printf('%.2f', max_by(value, event_id)) from events) as last_run,
               count(*) as silver_rows, format('{:,}', count(*)) as silver_rows_text
        from silver_v""",
    "update_where": f"""
        select {_SILVER_SHORT} from (
          select * replace (case when {UPDATE_WHERE} then age * 2 else age end as age) from silver_v)""",
    "delete_where": f"select {_SILVER_SHORT} from silver_v where not coalesce({DELETE_WHERE}, false)",
    "history": f"""
        select cast(0 as bigint) as version, '2024-02-01 12:00:00' as timestamp, 'WRITE' as operation, count(*) as rows_written,
               0 as updated_rows, 0 as deleted_rows, 0 as copied_rows
        from v1 where event_id % 2 = 0
        union all
        select 1, '2024-02-01 12:00:01', 'WRITE', count(*), 0, 0, 0 from v1 where event_id % 2 = 1
        union all
        select 2, '2024-02-01 12:00:02', 'UPDATE', 0, count(*) filter (where coalesce({UPDATE_WHERE}, false)), 0,
               count(*) filter (where not coalesce({UPDATE_WHERE}, false))
        from v1 where processed_date in (select processed_date from v1 where {UPDATE_WHERE})
        union all
        select 3, '2024-02-01 12:00:03', 'DELETE', 0, 0, count(*) filter (where coalesce({DELETE_WHERE}, false)),
               count(*) filter (where not coalesce({DELETE_WHERE}, false))
        from v2 where processed_date in (select processed_date from v2 where {DELETE_WHERE})""",
    "replace_partitions": """
        , rows_v as (
          select event_id, value, case when event_id % 4 <> 0 then timestamp '2024-01-01' + to_microseconds(event_id % 3) end as slot,
                 case when event_id % 2 = 0 then 'a/b=c d%"\u00e9' else 'plain' end as kind
          from events
        ), new_v as (
          select * replace (value + 1000 as value) from rows_v where event_id % 3 = 1 and event_id % 2 = 0)
        select event_id, value, strftime(slot, '%Y-%m-%d %H:%M:%S.%f') as slot, kind from (
          select * from new_v
          union all
          select * from rows_v r where not exists (
            select 1 from new_v n where n.slot is not distinct from r.slot and n.kind = r.kind))""",
    "history_volume": """
        select '2024-02-01 12:00:00' as timestamp, count(*) as rows_written from v1 where event_id % 2 = 0
        union all
        select '2024-02-01 12:00:01', count(*) from v1 where event_id % 2 = 1""",
    "table_versions": """
        select 0 as version, count(*) as n_rows, cast(sum(age) as bigint) as age_sum from v1 where event_id % 2 = 0
        union all select 1, count(*), cast(sum(age) as bigint) from v1
        union all select 2, count(*), cast(sum(age) as bigint) from v2
        union all select 3, count(*), cast(sum(age) as bigint) from v3""",
    "read_as_of": f"""
        select id, name, age, event_id, {_DAY.format('processed_date')} as processed_date
        from v1 where event_id % 2 = 0""",
    "incident_log": f"""
        select 'events' as dag_id, 'run_' || cast(floor(epoch(ts)) as bigint) as run_id,
               'user_' || user_id as task_id,
               printf('{_FAILURE}', 'user_' || user_id, substr(repeat(props, 40), 1, {FAILURE_DETAIL_CHARS})) as message,
               'ERROR' as status, {_TIME.format('ts')} as timestamp
        from events where event_type = 'error'""",
    "file_profile": """
        select source_file, cast(sum(n) as bigint) as n_rows, cast(sum(n - 1) as bigint) as duplicate_rows,
               cast(sum(n * ((id is null)::int + (name is null or trim(name) = '')::int + (age is null)::int)) as bigint)
                 as empty_cells
        from (select source_file, id, name, age, count(*) as n from raw_v group by all)
        group by source_file""",
    "file_profile_csv": """
        , line_v as (
          select event_id // 1000 as part, coalesce(id::varchar, '') || ',' || case when event_id % 5 = 0 then '"' || name || chr(10) || ',b"' else name end
                   || ',' || coalesce(age::varchar, '') as line,
                 (id is null)::int + (age is null)::int as blanks, unnest(range(case when event_id % 7 = 0 then 2 else 1 end)) as copy
          from raw_v
        ), file_v as (
          select part, count(*) as n_rows, cast(sum(strlen(line) + 1) + strlen('id,name,age') + 1 as bigint) as size_bytes,
                 count(*) - count(distinct line) as duplicate_rows, cast(sum(blanks) as bigint) as empty_cells
          from line_v group by part)
        select *, 's' || size_bytes || 'd' || duplicate_rows || 'n' || empty_cells as name_start from file_v""",
    "medallion_run": """
        select 'run_1706788800' as run_id, 'succeeded' as status, total_rows as bronze_rows,
               (select count(*) from drop_silver_v) as silver_rows, cast(1 as bigint) as gold_rows,
               null_ids, negative_ages, invalid_ages, duplicate_ids, '2024-02-01' as processed_date,
               (select avg(age) from drop_silver_v) as average_age,
               (select count(*) from drop_silver_v) as total_users
        from dq_v""",
    "stream_ingest": "select id, name, age from raw_v",
    "stream_medallion": """
        select id, name, coalesce(age, 45) as age from (
          select *, row_number() over (partition by id, event_id % 4 < 2 order by name nulls last, age nulls last) as rn from raw_v)
        where rn = 1""",
    "generate_people": f"""
        , people_v as ({_people(_IDS, 0.2)})
        select * from people_v
        union all
        select * from (
          select * from people_v order by {_draw('cast(id as varchar)', 'sample')}, id
          limit (select count(*) // 5 from customer))""",
    "generate_people_inline": f"""
        , people_v as ({_people(_IDS, 0.1)})
        select * from people_v
        union all
        select * from people_v where {_draw('cast(id as varchar)', 'repeat')} < {int(0.05 * 2**32)}""",
    "generate_people_reused": f"""
        , people_v as ({_people(_IDS, 0.05)}),
        again_v as ({_people('(select c_custkey as id from customer)', 0.0, 2)})
        select * from people_v
        union all
        select * from again_v where id <= (select count(*) // 10 from customer)""",
}

ORACLE_SQL: dict[str, str] = {name: _VIEWS.rstrip() + "\n" + body.strip() for name, body in _BODIES.items()}
