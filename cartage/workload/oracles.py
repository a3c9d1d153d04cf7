"""The same results in plain SQL over the given tables (DuckDB dialect)."""

from cartage.workload.tables import POINT_1_2, POINT_3_4

_STATES_FILE = """case event_type when 'view' then 'PENDING' when 'click' then 'IN_PROGRESS'
    when 'purchase' then 'SUCCESS' when 'error' then 'FAILED' when 'signup' then 'RETRYING_FULL_INGEST' end"""
_STATES_PARTITION = """case event_type when 'view' then 'PENDING' when 'click' then 'IN_PROGRESS'
    when 'purchase' then 'COMPLETED' when 'error' then 'FAILED' when 'signup' then 'NOT_SELECTED' end"""


def _log(states: str) -> str:
    return f"""history as (
    select user_id as task_id, event_id % 20 as item_id, event_id as seq, ts as at, {states} as status,
        case when value < 20 then 'ADD_FILES_COPY' else 'FULL_INGEST' end as load_mode_used,
        case when event_type = 'error' then repeat(event_type || ' ' || props || ' ', 60)
             when event_type = 'purchase' and value >= 20
             then 'ADD_FILES_COPY failed: ' || substr(props, 1, 500) || '. Retrying with FULL_INGEST...'
        end as error_message,
        cast(props->>'$.k' as integer) as retry_count
    from events),
state as (select * from history qualify row_number() over (partition by task_id, item_id order by seq desc) = 1)"""


_FILES = "with " + _log(_STATES_FILE)
_PARTITIONS = "with " + _log(_STATES_PARTITION)
_RUNS = """with runs as (
    select upper('migrate_' || (case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'import' else 'export' end)
            || '_shop_sales_order' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d_%H%M%S')) as task_id,
        case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'IMPORT' else 'EXPORT' end as operation,
        case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'RUNNING' else 'FAILED' end as status,
        o_orderdate as created_at
    from orders)"""

_SAFE = "regexp_replace({}, '[^a-zA-Z0-9_-]', '_', 'g')"
_PRIORITY_FOLDER = _SAFE.format("o_orderpriority")
_NULL_KEY = "nullif(o_orderpriority, '5-LOW')"
_NULL_KEY_ORDERS = f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    {_NULL_KEY} as o_orderpriority from orders"""
_SHELF = "p_type || (case when p_size % 2 = 0 then ' ' else '#' end) || (p_size // 2)"
_INVENTORY = " union all ".join(
    f"""select '{t}' as table_name, (select count(*) from information_schema.columns
        where table_name = '{t}') as column_count, (select count(*) from {t}) as total_rows"""
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
)
_ALL_ORDERS = "select * from orders"
_DESCRIBED = " union all ".join(
    f"""select '{t}' as table_name, cast(c.column_index - 1 as integer) as ordinal, c.column_name, f.filled
        from (select column_index, column_name from duckdb_columns() where table_name = '{t}') c
        join (unpivot (select count(columns(*)) from {t}) on columns(*) into name column_name value filled) f using (column_name)"""
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
)


def _cell(expression: str) -> str:
    return f"""case when length(coalesce({expression}, '')) > 30
        then substr({expression}, 1, 27) || '...' else coalesce({expression}, '') end"""


ORACLES: dict[str, str] = {
    "partition_profile": "select l_returnflag, count(*) as total_rows from lineitem group by 1",
    "partition_profile_composite":
        "select l_returnflag, l_linestatus, count(*) as total_rows from lineitem group by 1, 2",
    "partition_profile_nulls": f"select {_NULL_KEY} as o_orderpriority, count(*) as total_rows from orders group by 1",
    "partition_profile_daily": "select cast(ts as date) as day, count(*) as total_rows from events group by 1",
    "partition_bytes": """select lang, cast(sum(octet_length(encode(text)) + octet_length(encode(lang))
        + octet_length(encode(source)) + 16) as bigint) as input_bytes from documents group by 1""",
    "table_inventory": _INVENTORY,
    "catalog_inventory": _INVENTORY,
    "describe_table": _DESCRIBED,
    "new_partitions": """select cast(ts as date) as day, count(*) as total_rows from events
        where cast(ts as date) not in (select cast(ts as date) from events where ts < timestamp '2024-01-21')
        group by 1""",
    "new_partition_discovery_nulls": f"""select o_orderpriority, count(*) as total_rows from ({_NULL_KEY_ORDERS}) o
        where not exists (select 1 from ({_NULL_KEY_ORDERS}) k
            where (k.o_orderpriority is null or k.o_orderpriority = '2-HIGH')
            and k.o_orderpriority is not distinct from o.o_orderpriority)
        group by 1""",
    "predicate_string": "select * from orders where o_orderpriority = '4-NOT SPECIFIED'",
    "predicate_date": "select * from orders where o_orderdate = timestamp '1997-05-28 00:00:00'",
    "predicate_number": "select * from part where p_size = 28",
    "predicate_null": f"select * from ({_NULL_KEY_ORDERS}) where o_orderpriority is null",
    "predicate_composite": "select * from lineitem where l_returnflag = 'A' and l_linestatus = 'F'",
    "compat_projection": """select event_id, ts, user_id, event_type, value, cast(json(props) as varchar) as props,
        ts as seen_at from events""",
    "compat_projection_nested": "select event_id, ts as seen_at, cast(json(props) as varchar) as props from events",
    "compat_report": """select unnest(['TIMESTAMP_LTZ', 'TIMESTAMP_NTZ', 'TIMESTAMP_TZ', 'VARIANT']) as data_type,
        cast(1 as bigint) as column_count, (select count(ts) from events) as value_count""",
    "target_schema": """select vec_id, label, cast(unnest(range(len(embedding))) as integer) as pos,
        cast(unnest(embedding) as double) as value from embeddings""",
    "export_columns": f"select o_orderkey, o_totalprice, {_PRIORITY_FOLDER} as path_key from orders",
    "run_parameters": "select event_id, cast(props->>'$.k' as bigint) as k from events",
    "path_key": f"select p_partkey, {_SAFE.format('p_brand')} as path_key from part",
    "path_collisions": f"""select {_SAFE.format('shelf')} as path_key, count(distinct shelf) as key_count
        from (select {_SHELF} as shelf from part) group by 1 having count(distinct shelf) > 1""",
    "relative_path": r"""select page_id,
        regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*', ''), '/{2,}', '/', 'g') as path,
        split_part(url, '/', -1) as file_name from pages""",
    "stage_relative_paths": r"""select page_id, regexp_replace(case
            when url not like '%://%' then 'en/' || split_part(url, '/', -1)
            when contains(url, '/en/') then 'en/' || substr(url, strpos(url, '/en/') + 4)
            when regexp_matches(url, '/en$') then 'en'
            else 'en/' || split_part(url, '/', -1) end, '/{2,}', '/', 'g') as path from pages""",
    "run_name": """select o_orderkey, upper('migrate_export_shop_sales_' || o_orderpriority || '_'
        || strftime(o_orderdate, '%Y%m%d_%H%M%S')) as task_id from orders""",
    "elapsed_text": """with t as (select event_id, datesub('second', timestamp '2024-01-01', ts) as s from events),
        u as (select event_id, s // 86400 as d, s % 86400 // 3600 as h, s % 3600 // 60 as m, s % 60 as s from t)
        select event_id, concat_ws(', ',
            case when d > 0 then d || ' day' || (case when d = 1 then '' else 's' end) end,
            case when h > 0 then h || ' hour' || (case when h = 1 then '' else 's' end) end,
            case when m > 0 then m || ' minute' || (case when m = 1 then '' else 's' end) end,
            s || ' second' || (case when s = 1 then '' else 's' end)) as elapsed from u""",
    "next_batch": """select p_brand, count(*) as total_rows from part group by 1
        order by total_rows, p_brand limit 10""",
    "wave_plan": """select p_brand, total_rows,
        cast((row_number() over (order by total_rows, p_brand) - 1) // 4 as integer) as wave
        from (select p_brand, count(*) as total_rows from part group by 1)""",
    "file_cap_plan": """select o_orderpriority, count(*) as total_rows,
        cast(ceil(count(*) / 500.0) as bigint) as file_count from orders group by 1""",
    "log_state": f"{_FILES} select task_id, item_id, seq, status from state",
    "pending_items": f"{_FILES} select task_id, item_id, seq from state where status = 'PENDING'",
    "select_partitions": f"""{_PARTITIONS} select task_id, item_id, 'PENDING' as status, 0 as retry_count,
        cast(null as varchar) as error_message from state
        where (task_id, item_id) in (select (user_id, event_id % 20) from events where value >= 50)""",
    "select_non_completed": f"{_PARTITIONS} select task_id, item_id, status from state where status <> 'COMPLETED'",
    "reset_failed": f"""{_PARTITIONS} select task_id, item_id, 'PENDING' as status, retry_count,
        cast(null as varchar) as error_message from state where status = 'FAILED'""",
    "log_extend": f"""{_PARTITIONS}, tasks as (
            select task_id, status, seq from history
            qualify row_number() over (partition by task_id order by seq desc) = 1)
        select task_id, status, seq from tasks union all
        select c_custkey, 'NOT_SELECTED', null from customer where c_custkey not in (select task_id from tasks)""",
    "status_counts": f"""{_PARTITIONS} select s.status, count(state.status) as item_count
        from (select unnest(['PENDING', 'IN_PROGRESS', 'COMPLETED', 'FAILED']) as status) s
        left join state on state.status = s.status group by 1""",
    "status_counts_import": f"""{_FILES} select s.status, count(state.status) as item_count
        from (select unnest(['PENDING', 'IN_PROGRESS', 'SUCCESS', 'FAILED']) as status) s
        left join state on replace(state.status, 'RETRYING_FULL_INGEST', 'IN_PROGRESS') = s.status group by 1""",
    "task_progress": f"""{_PARTITIONS} select task_id, count(*) as total_items,
        count(*) filter (status = 'COMPLETED') as completed_items,
        cast(count(*) filter (status = 'COMPLETED') as double) / count(*) as progress
        from state where status <> 'NOT_SELECTED' group by 1""",
    "load_mode_summary": f"""{_FILES} select load_mode_used, status, count(*) as file_count from state group by 1, 2""",
    "run_summary": f"""{_RUNS} select count(*) as total_tasks, count(*) filter (status = 'COMPLETED') as completed,
        count(*) filter (status = 'FAILED') as failed from runs""",
    "run_totals": f"""{_FILES} select task_id, count(*) filter (status = 'SUCCESS') as completed_items,
        count(*) filter (status = 'FAILED') as failed_items,
        count(*) filter (status = 'SUCCESS' and error_message like 'ADD_FILES_COPY failed: %') as fallback_items
        from state group by 1""",
    "error_audit": f"""{_FILES} select task_id, item_id, status, substr(error_message, 1, 500) as error_message
        from state where error_message is not null""",
    "fallback_audit": f"""{_FILES} select task_id, item_id, error_message from state
        where status = 'SUCCESS' and load_mode_used = 'FULL_INGEST' and error_message like 'ADD_FILES_COPY failed%'""",
    "fallback_history": f"""{_FILES} select task_id, item_id, seq from state where status = 'SUCCESS'
        and exists (select 1 from history h where h.task_id = state.task_id and h.item_id = state.item_id
            and h.status = 'RETRYING_FULL_INGEST')""",
    "recent_runs": f"{_RUNS} select * from runs order by created_at desc, task_id desc limit 100",
    "active_runs": f"""{_RUNS} select * from runs where status in ('CREATED', 'RUNNING')
        and task_id like 'MIGRATE\\_IMPORT\\_%' escape '\\' order by created_at desc, task_id desc limit 100""",
    "log_view": f"""{_FILES} select task_id, item_id, seq, {_cell('status')} as status,
        {_cell('error_message')} as error_message, retry_count from state order by state.status, seq limit 100""",
    "export_roundtrip": _ALL_ORDERS,
    "export_failures": """select cast(l_orderkey % 48 as integer) as lane, count(*) as total_rows,
        case when l_orderkey % 48 < 40 then 'FAILED' else 'COMPLETED' end as status,
        case when l_orderkey % 48 >= 40 then count(*) end as rows_unloaded, l_orderkey % 48 < 40 as told
        from lineitem group by l_orderkey % 48""",
    "export_vanished_partition": "select * from part where p_brand <> 'Brand#11'",
    "run_progress": """select 'EXPORT' as operation, 'COMPLETED' as status, count(distinct o_orderpriority) as selected_items,
        count(distinct o_orderpriority) as completed_items, cast(1 as double) as progress from orders
        group by case when o_orderpriority = '1-URGENT' then 1 else 2 end""",
    "run_registry": """select 'EXPORT' as operation, true as named, (count(distinct o_orderpriority) + 2) // 3 + 1 as progress_rows,
            count(distinct o_orderpriority) as completed_items, cast(0 as bigint) as failed_items,
            cast(null as bigint) as fallback_items, true as one_start from orders
        union all select 'IMPORT', true, count(distinct o_orderstatus), count(distinct o_orderstatus) - 1, cast(1 as bigint),
            cast(1 as bigint), true from orders""",
    "active_real_runs": """select 'EXPORT' as operation, 'RUNNING' as status, count(distinct o_orderpriority) as total_items
        from orders""",
    "compat_projection_time": "select event_id, strftime(ts, '%H:%M:%S') as clock from events",
    "compat_projection_geometry": f"""select c_custkey, case when c_custkey % 2 = 0 then '{POINT_1_2}' else '{POINT_3_4}' end
        as place from customer""",
    "import_after_reexport": _ALL_ORDERS,
    "import_after_cleanup": _ALL_ORDERS,
    "stream_batch_repeated": _ALL_ORDERS,
    "import_replaces_partition": """select o_orderkey, o_custkey, o_orderstatus,
        case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as o_totalprice,
        o_orderdate, o_orderpriority from orders""",
    "import_nested_by_name": """select o_orderkey, o_custkey as map_a, o_orderkey as map_b, cast(null as varchar) as missing,
        o_custkey as list_a, o_orderkey as list_b from orders""",
    "export_layout": f"""select {_PRIORITY_FOLDER} as path_key, count(*) as rows, cast(1 as bigint) as files
        from orders group by 1""",
    "export_null_and_composite_keys": f"""select coalesce({_SAFE.format('o_orderpriority')}, '__NULL__')
        || '__' || o_orderstatus as path_key, o_orderpriority, o_orderstatus, count(*) as total_rows
        from ({_NULL_KEY_ORDERS}) group by 1, 2, 3""",
    "export_colliding_keys": f"""select {_SHELF} as shelf, count(*) as total_rows, cast(1 as bigint) as folders
        from part group by 1""",
    "export_many_files": """select l_returnflag as path_key, count(*) as rows, true as several_files
        from lineitem group by 1""",
    "export_split_oversize": "select * from lineitem",
    "export_within_cap": """select lang, 'COMPLETED' as status, count(*) as rows_unloaded, true as within_cap,
        true as files_told from documents group by 1""",
    "export_in_waves": """select cast(ts as date) as day, strftime(ts, '%Y-%m-%d') as path_key, 'COMPLETED' as status,
        count(*) as total_rows, count(*) as rows_unloaded, cast(1 as bigint) as file_count
        from events group by 1, 2""",
    "export_selection": """with p as (select o_orderpriority, count(*) as n,
            row_number() over (order by count(*), o_orderpriority) as rn from orders group by 1)
        select o_orderpriority, case when rn <= 3 then 'COMPLETED' else 'NOT_SELECTED' end as status,
            case when rn <= 3 then n end as rows_unloaded from p""",
    "export_resume": """select o_orderpriority, cast(1 as bigint) as times_exported, count(*) as rows_unloaded
        from orders group by 1""",
    "export_incremental": """select cast(ts as date) as day, count(*) as rows_unloaded,
        cast(ts as date) >= date '2024-01-21' as second_run from events group by 1""",
    "export_overwrite": """select o_orderkey, o_custkey, o_orderstatus,
        case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as o_totalprice,
        o_orderdate, o_orderpriority from orders""",
    "export_no_overwrite": """select o_orderpriority,
        case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'FAILED' else 'COMPLETED' end as status,
        case when o_orderpriority not in ('1-URGENT', '2-HIGH') then count(*) end as rows_unloaded
        from orders group by 1""",
    "export_reconcile": f"""select {_NULL_KEY} as o_orderpriority, count(*) as planned_rows,
        count(*) as actual_rows, true as matched from orders group by 1""",
    "analyse_and_select": """select cast(ts as date) as day, strftime(ts, '%Y-%m-%d') as path_key,
        case when cast(ts as date) >= date '2024-01-15' then 'PENDING' else 'NOT_SELECTED' end as status,
        count(*) as total_rows,
        cast(sum(8 + 8 + 8 + 8 + 4 + octet_length(encode(event_type)) + octet_length(encode(props))) as bigint)
            as input_bytes
        from events group by 1, 2, 3""",
    "stage_listing": f"select {_PRIORITY_FOLDER} as path_key, cast(1 as bigint) as files from orders group by 1",
    "column_list": f"""select {_PRIORITY_FOLDER} as path_key, count(*) as num_rows,
        'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' as column_list
        from orders group by 1""",
    "new_files": """select strftime(ts, '%Y-%m-%d') as path_key, cast(1 as bigint) as files from events
        where ts >= timestamp '2024-01-21' group by 1""",
    "cleanup_plan": f"""select distinct {_PRIORITY_FOLDER} as path_key from orders
        where o_orderpriority not in ('1-URGENT', '5-LOW')""",
    "import_full_ingest": """select o_orderkey, o_custkey, cast(cast(o_totalprice as decimal(12,2)) as double)
        as o_totalprice, cast(o_orderdate as date) as o_orderdate, cast(null as varchar) as "O_ORDERPRIORITY",
        cast(null as varchar) as o_comment from orders""",
    "import_add_files_copy": _ALL_ORDERS,
    "import_add_files_reference": _ALL_ORDERS,
    "import_fallback": """select case o_orderstatus when 'F' then 'fit' when 'O' then 'millis' else 'array' end as variant,
        case when o_orderstatus in ('F', 'O') then 'SUCCESS' else 'FAILED' end as status,
        case when o_orderstatus = 'F' then 'ADD_FILES_COPY' else 'FULL_INGEST' end as load_mode_used,
        o_orderstatus = 'O' as copy_failed,
        count(*) filter (o_orderstatus in ('F', 'O')) as rows_loaded
        from orders group by 1, 2, 3, 4""",
    "import_fallback_rows": "select * from orders where o_orderstatus in ('F', 'O')",
    "import_schema_check": """select case o_orderstatus when 'F' then 'fit' when 'O' then 'millis' else 'array' end as variant,
        case o_orderstatus when 'F' then null
            when 'O' then 'column o_orderdate: time unit MILLIS where the table needs MICROS'
            else 'column o_totalprice: type array<double> in the file, double in the table' end as copy_problem,
        case o_orderstatus when 'F' then null
            when 'O' then 'column o_orderdate: time unit MILLIS where the table needs MICROS'
            else 'column o_totalprice: type array<double> in the file, double in the table' end as reference_problem,
        count(*) as num_rows from orders group by 1, 2, 3""",
    "import_reconcile": """select o_orderpriority, count(*) as planned_rows, count(*) as actual_rows, true as matched
        from orders group by 1""",
    "import_twice": _ALL_ORDERS,
    "stream_import": _ALL_ORDERS,
}
