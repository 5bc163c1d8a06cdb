"""DuckDB SQL for the registered queries.

The partition functions are spelled out over character lists and hexadecimal bytes, which is
another way than the engine's.
"""

from __future__ import annotations

from catalog.queries import KEY, TABLE

MASK = 2**32 - 1
MULTIPLIER = 0x5BD1E995
SEED = 0x9747B28C


def java_hash(key: str) -> str:
    """String hash over UTF-16 units as an unsigned number."""
    units = (
        f"flatten(list_transform(string_split({key}, ''), lambda ch: case when ascii(ch) < 65536 then [ascii(ch)::bigint] "
        "else [(55296 + (ascii(ch) - 65536) // 1024)::bigint, (56320 + (ascii(ch) - 65536) % 1024)::bigint] end))"
    )
    return f"list_reduce({units}, lambda h, u: (h * 31 + u) & {MASK}, 0::bigint)"


def hashcode_pid(key: str, partitions: int) -> str:
    h = java_hash(key)
    signed = f"(case when {h} = 2147483648 then 0 when {h} > 2147483648 then 4294967296 - {h} else {h} end)"
    return f"({signed} % {partitions})::int"


def _little_endian(digits: str) -> str:
    """Number of up to four bytes written in hexadecimal, lowest byte first; '' is 0."""
    swapped = " || ".join(f"substr({digits}, {start}, 2)" for start in (7, 5, 3, 1))
    return f"coalesce(try_cast('0x' || nullif({swapped}, '') as bigint), 0)"


def murmur_pid(key: str, partitions: int) -> str:
    """Murmur2 over the key's bytes in hexadecimal; lists of one value name the steps."""
    n = "(length(d) // 2)"
    words = f"list_transform(regexp_extract_all(d, '.{{8}}'), lambda w: ({_little_endian('w')} * {MULTIPLIER}) & {MASK})"
    mixed = f"list_transform({words}, lambda k: (xor(k, k >> 24) * {MULTIPLIER}) & {MASK})"
    steps = f"[list_reduce({mixed}, lambda h, k: xor((h * {MULTIPLIER}) & {MASK}, k), xor({SEED}::bigint, {n}))]"
    tail = _little_endian(f"substr(d, ({n} // 4 * 8 + 1)::int)")
    for step in (
        f"case when {n} % 4 > 0 then (xor(h, {tail}) * {MULTIPLIER}) & {MASK} else h end",
        f"(xor(h, h >> 13) * {MULTIPLIER}) & {MASK}",
        "xor(h, h >> 15)",
        f"((h & 2147483647) % {partitions})::int",
    ):
        steps = f"list_transform({steps}, lambda h: {step})"
    return f"list_transform([hex(encode({key}))], lambda d: ({steps})[1])[1]"


def modulo_pid(key: str, partitions: int) -> str:
    return f"(((({key})::bigint % {partitions}) + {partitions}) % {partitions})::int"


def block_first(p: int, s: int) -> str:
    return f"(pid * {s // p} + least(pid, {s % p}))"


def block_size(p: int, s: int) -> str:
    return f"(case when pid < {s % p} then {s // p + 1} else {s // p} end)"


def dealt(source: str, pid: str, p: int, s: int, order: str) -> str:
    """Rows of ``source`` with pid and segment_id, dealt in turn within each pid."""
    return (
        f"select * exclude (rn), ({block_first(p, s)} + (rn - 1) % {block_size(p, s)})::int as segment_id from "
        f"(select *, row_number() over (partition by pid order by {order}) as rn from "
        f"(select *, {pid} as pid from {source}))"
    )


def folded(source: str, pid: str, s: int) -> str:
    return f"select *, (pid % {s})::int as segment_id from (select *, {pid} as pid from {source})"


FOLD = folded("orders", hashcode_pid("o_custkey::varchar", 12), 5)
DEAL = dealt("orders", modulo_pid("o_orderkey", 4), 4, 13, "o_orderkey")
BY_TYPE = dealt("events", murmur_pid("event_type", 8), 8, 16, "event_id")
EVENTS_16 = folded("events", murmur_pid("event_type", 16), 16)


def ids(n: int) -> str:
    return f"(select range::int as segment_id from range({n}))"


def two_keys(function) -> str:
    return (
        f"select *, {function('c_name', 9)} as name_pid, {function('number::varchar', 9)} as number_pid "
        "from (select c_custkey, c_name, (c_custkey - 500) * 1234567891 as number from customer)"
    )


def stats(columns: list[str], distinct: bool) -> str:
    parts = []
    for c in columns:
        extra = f", count(distinct {c}) as distinct_count" if distinct else ""
        parts.append(
            f"select segment_id, count(*) as record_count, '{c}' as column_name, min({c})::varchar as min_value, "
            f"max({c})::varchar as max_value, count(*) - count({c}) as null_count{extra} from t group by segment_id"
        )
    source = folded(
        "(select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus, "
        "o_totalprice::decimal(15,2) as o_totalprice, o_orderdate from orders)",
        hashcode_pid("o_custkey::varchar", 12),
        5,
    )
    return f"with t as ({source}) " + " union all ".join(parts)


STATS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
MS = "epoch_ms(o_orderdate)::bigint"
NAME = f"'{TABLE}_{KEY}_' || segment_id"
JOB_ROWS = (
    f"select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, {MS} as order_ms "
    "from orders join customer on o_custkey = c_custkey where c_mktsegment <> 'BUILDING'"
)
JOB_FOLDED = folded(f"({JOB_ROWS})", murmur_pid("o_custkey::varchar", 4), 3)
MONTHLY = (
    "select o_orderkey, o_totalprice, ms, o_orderstatus, (month % 24)::int as segment_id from (select o_orderkey, o_totalprice, "
    f"nullif(o_orderstatus, 'P') as o_orderstatus, {MS} as ms, {MS} // 2592000000 as month from orders) where month < 322"
)


def day(text: str) -> str:
    return f"epoch_ms(timestamp '{text}')"


# what a row must fulfil, and what a segment's least and greatest values must
CONDITIONS = {
    "range": (f"ms >= {day('1995-03-01')} and ms < {day('1995-05-01')}", f"max(ms) >= {day('1995-03-01')} and min(ms) < {day('1995-05-01')}"),
    "or": (f"ms < {day('1995-01-20')} or o_totalprice < 1100", f"min(ms) < {day('1995-01-20')} or min(o_totalprice) < 1100"),
    "not": (f"not (ms >= {day('1995-02-01')} or o_orderstatus is null)", f"min(ms) < {day('1995-02-01')} and count(o_orderstatus) > 0"),
    "null": ("o_orderstatus is null and o_orderkey = 77", "count(o_orderstatus) < count(*) and min(o_orderkey) <= 77 and max(o_orderkey) >= 77"),
}
JOB_DEALT = dealt(f"({JOB_ROWS})", murmur_pid("o_custkey::varchar", 4), 4, 10, "o_orderkey")
JOB_COUNTS = (
    f"select i.segment_id, '{TABLE}_{KEY}_' || i.segment_id as segment_name, count(d.segment_id) as record_count, "
    f"count(d.segment_id) > 0 as has_bytes from {ids(10)} i left join ({JOB_DEALT}) d using (segment_id) group by i.segment_id"
)
DEAL_COUNTS = f"select segment_id, count(*) as n from ({DEAL}) group by segment_id"
PAYLOAD = (
    "'{\"part\": \"' || " + NAME + " || '\", \"of\": \"" + TABLE + "\", \"rows\": ' || n || "
    "', \"all_rows\": ' || (select count(*) from orders) || '}'"
)


def plan(mode: str, offset: str, payload: str) -> str:
    return (
        f"select segment_id + 1 as push_order, {NAME} as segment_name, '{mode}' as upload_mode, 'orders' as base_table_name, "
        f"'OFFLINE' as table_type, 's3a://bucket/segment_id=' || segment_id as segment_uri, ({offset})::bigint as push_offset_seconds, "
        f"{payload} as payload, n as record_count, {str(mode == 'URI').lower()} as delete_after_push from ({DEAL_COUNTS})"
    )


def schema_rows() -> str:
    fields = [
        ("o_orderkey", "dimension", "bigint", "o_orderkey"),
        ("o_custkey", "dimension", "bigint", "o_custkey"),
        ("o_orderstatus", "dimension", "string", "o_orderstatus"),
        ("o_orderpriority", "dimension", "string", "o_orderpriority"),
        ("o_totalprice", "metric", "double", "o_totalprice"),
        ("order_ms", "dateTime", "bigint", "o_orderdate"),
    ]
    return " union all ".join(
        f"select '{name}' as column_name, '{role}' as role, '{kind}' as data_type, count({source}) as filled from orders"
        for name, role, kind, source in fields
    )


def formats() -> str:
    return " union all ".join(
        f"select '{name}' as format, count(*) as n, sum(c_custkey)::bigint as keys from customer"
        for name in ("JSON", "json", "Parquet", "PARQUET")
    )


ORACLE: dict[str, str] = {
    "query_extract": """
        select n_name, o_orderstatus, count(*) as n_orders, sum(o_totalprice::decimal(18,2))::double as total
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        where o_orderpriority <> '5-LOW' group by n_name, o_orderstatus""",
    "stage_json": "select * replace (nullif(event_type, 'error') as event_type) from events",
    "stage_json_text": "select * from documents",
    "stage_json_nested": "select vec_id, label, (generate_subscripts(embedding, 1) - 1)::int as place, unnest(embedding)::double as x from embeddings",
    "stage_parquet": "select * from orders",
    "format_dispatch": formats(),
    "scan_json": "select o_orderkey, o_orderstatus, null::varchar as o_clerk from orders",
    "scan_parquet": """
        select l_returnflag, count(*) as n, sum(l_quantity::decimal(18,2))::double as quantity
        from lineitem where l_shipdate < timestamp '1996-01-01' group by l_returnflag""",
    "scan_prefix": "select * from orders",
    "scan_dir": "select * from orders where o_orderstatus = 'F'",
    "scan_concat": """
        select c_custkey as id, c_name as name, c_mktsegment from customer
        union all select s_suppkey, s_name, null from supplier""",
    "scan_empty": "select * from orders",
    "table_schema": schema_rows(),
    "table_layout": f"""
        select pid, count(*) as n, 'customer_OFFLINE' as table_name
        from (select {murmur_pid('c_name', 6)} as pid from customer) group by pid""",
    "project_physical": """
        select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
               true as order_ms, o_orderdate from orders""",
    "conform_types": f"select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 3 = 0 then try_cast(o_orderpriority as bigint) else {MS} end as order_ms from orders",
    "extract_validate": """
        with n as (select count(*) as n from orders where o_orderstatus = 'F')
        select "case", taken, case when taken then (select n from n) else 0 end as n from (values ('0: json', true), ('1: Parquet', true),
            ('2: json', false), ('3: json', false), ('4: avro', false), ('5: csv', false), ('6: no format', false)) as c("case", taken)""",
    "part_rejects": """
        select o_orderkey::varchar as line, o_custkey, case when o_orderkey % 11 <> 0 then o_orderkey end as o_orderkey,
            case when o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 then 12.5::double end as o_totalprice,
            concat_ws('; ', case when o_orderkey % 11 = 0 then 'o_orderkey #' || o_orderkey || ' bigint' end,
                case when o_orderkey % 7 = 0 then 'o_totalprice n/a double' end) as reasons
        from orders""",
    "time_bucket": """
        select kind, time_bucket(interval '6 hours', ts, timestamp '1970-01-01') as bucket,
            (epoch_ms(time_bucket(interval '6 hours', ts, timestamp '1970-01-01')) // 21600000)::bigint as number, count(*) as n
        from events, (values ('LONG'), ('STRING')) as k(kind) group by all""",
    "event_time": "select o_orderkey, o_orderdate as event_time from orders",
    "partition_key": "select coalesce(nullif(event_type, 'error'), '') as key, count(*) as n from events group by 1",
    "pid_hashcode": two_keys(hashcode_pid),
    "pid_hashcode_text": f"select doc_id, {hashcode_pid('text', 101)} as pid from documents",
    "pid_murmur": two_keys(murmur_pid),
    "pid_murmur_text": f"select doc_id, {murmur_pid('text', 101)} as pid from documents",
    "pid_modulo": f"""
        select *, {modulo_pid('shifted', 7)} as pid, {modulo_pid('shifted', 7)} as text_pid
        from (select o_orderkey, o_orderkey - 700 as shifted from orders)""",
    "resolve_partition_fn": f"""
        select c_custkey, {hashcode_pid('c_custkey::varchar', 6)} as unset, {hashcode_pid('c_custkey::varchar', 6)} as blank,
               {hashcode_pid('c_custkey::varchar', 6)} as upper, {murmur_pid('c_custkey::varchar', 6)} as murmur,
               {modulo_pid('c_custkey', 6)} as modulo from customer""",
    "partition_spec": " union all ".join(
        f"select segment_id, count(*) as record_count, {s} as segments from ({folded('orders', modulo_pid('o_custkey', 6), s)}) group by segment_id"
        for s in (6, 4)
    ),
    "assign_unpartitioned": f"select segment_id, case when segment_id = 0 then (select count(*) from orders) else 0 end as record_count from {ids(4)}",
    "assign_fold": f"select o_orderkey, pid, segment_id from ({FOLD})",
    "assign_block_rr": f"select o_orderkey, pid, segment_id from ({DEAL})",
    "assign_block_rr_cells": f"select o_orderkey, pid, segment_id from ({DEAL})",
    "assign_block_rr_hot_key": f"select event_id, pid, segment_id from ({dealt('events', hashcode_pid('event_type', 3), 3, 20, 'ts, event_id')})",
    "assign_block_rr_copies": f"select segment_id, count(*) as record_count from ({dealt('lineitem', hashcode_pid('l_orderkey::varchar', 4), 4, 10, 'l_returnflag')}) group by segment_id",
    "assign_block_rr_stable": "select count(*) as dealt_rows, 0::bigint as moved_rows from lineitem",
    "assign_block_rr_text_order": f"select doc_id, pid, segment_id from ({dealt('documents', hashcode_pid('source', 3), 3, 8, 'text, doc_id')})",
    "segment_block": f"""
        select pid, n, {block_first(5, 13)}::int as first_segment, ({block_first(5, 13)} + {block_size(5, 13)})::int as end_segment,
               unnest(range({block_first(5, 13)}, {block_first(5, 13)} + {block_size(5, 13)}))::int as segment_id
        from (select pid, count(*) as n from (select {modulo_pid('o_custkey', 5)} as pid from orders) group by pid)""",
    "route_parquet": f"select * exclude (pid) from ({DEAL})",
    "route_json": f"select * exclude (pid) from ({folded('documents', hashcode_pid('source', 16), 6)})",
    "segment_name": f"select {NAME} as segment_name, count(*) as record_count from ({FOLD}) group by segment_id",
    "write_segments": f"select * exclude (pid) from ({FOLD}) where segment_id % 2 = 0",
    "write_segments_direct": f"select * exclude (pid) from ({DEAL})",
    "emit_empty_segments": f"select i.segment_id, count(d.segment_id) as record_count from {ids(16)} i left join ({EVENTS_16}) d using (segment_id) group by i.segment_id",
    "target_folder": f"select segment_id, count(*) as n, true as named from ({FOLD}) group by segment_id",
    "clean_target": "select * from orders where o_orderstatus <> 'F'",
    "scheme_dispatch": "select c_mktsegment, 2 * count(*) as n from customer group by c_mktsegment",
    "input_record_count": "select count(*) as input_record_count from lineitem",
    "segment_record_count": f"select segment_id, count(*) as record_count from ({folded('lineitem', murmur_pid('l_partkey::varchar', 32), 10)}) group by segment_id",
    "segment_byte_size": f"select segment_id, true as has_bytes, true as has_files from ({DEAL}) group by segment_id",
    "segment_manifest": f"""
        select i.segment_id, 'events_OFFLINE_{KEY}_' || i.segment_id as segment_name, 'segment_id=' || i.segment_id as folder,
               count(d.segment_id) as record_count, count(d.segment_id) > 0 as has_bytes, count(d.segment_id) > 0 as has_files
        from {ids(16)} i left join ({EVENTS_16}) d using (segment_id) group by i.segment_id""",
    "generation_summary": "select 13::bigint as segment_count, count(*) as record_count, count(*) as input_record_count, true as has_bytes, true as has_input_bytes from orders",
    "reconcile": "select count(*) as input_record_count, count(*) as output_record_count, true as matched from orders",
    "segment_column_stats": stats(STATS_COLUMNS, True),
    "segment_column_stats_estimated": f"select *, true as close from ({stats(STATS_COLUMNS, False)})",
    "merged_sketches": " union all ".join(
        f"select '{c}' as column_name, count(*) as record_count, count(*) - count({c}) as null_count, true as distinct_close, true as median_close "
        "from (select * replace (nullif(o_orderstatus, 'P') as o_orderstatus) from orders)"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    ),
    "segment_time_range": f"select segment_id, min(ts) as min_time, max(ts) as max_time from ({BY_TYPE}) group by segment_id",
    "segment_balance": f"""
        with d as ({dealt('events', hashcode_pid('user_id::varchar', 8), 8, 30, 'event_id')}),
        c as (select pid, segment_id, count(*) as n from d group by pid, segment_id),
        g as (select pid, sum(n)::bigint as record_count, any_value({block_size(8, 30)})::int as owned_segments, count(*) as used_segments,
                     min(n) as least, max(n) as max_records from c group by pid)
        select pid, record_count, owned_segments, used_segments, case when used_segments < owned_segments then 0 else least end as min_records,
               max_records, max_records - (case when used_segments < owned_segments then 0 else least end) as spread,
               (max_records * 30)::double / (select count(*) from events) as largest_share from g""",
    "segment_fill": f"select segment_id from {ids(16)} where segment_id not in (select segment_id from ({folded('events', hashcode_pid('event_type', 16), 16)}))",
    "segment_purity": f"select segment_id, count(distinct pid) as partition_ids from ({FOLD}) group by segment_id",
    "segment_prune_double": "select o_orderkey from orders where o_totalprice in (select o_totalprice from orders where o_orderkey % 997 = 1)",
    "segment_prune_decimal": "select o_orderkey from orders where o_totalprice::decimal(12,2) in (select o_totalprice::decimal(12,2) from orders where o_orderkey % 997 = 1)",
    "segment_prune_boolean": "select o_orderkey from orders where o_orderstatus = 'F'",
    "segment_prune_timestamp": "select event_id from events where ts in (select ts from events where event_id % 997 = 1)",
    "segment_prune_date": "select o_orderkey from orders where o_orderdate::date in (select o_orderdate::date from orders where o_orderkey % 499 = 1)",
    "segment_prune_key_table": "select o.* from orders o where o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY' and c_nationkey < 9)",
    "zone_prune": " union all ".join(f"select '{n}' as condition, o_orderkey, segment_id from ({MONTHLY}) where {c}" for n, (c, _) in CONDITIONS.items()),
    "zone_segments": " union all ".join(f"select '{n}' as condition, segment_id from ({MONTHLY}) group by segment_id having {z}" for n, (_, z) in CONDITIONS.items()),
    "member_prune": " union all ".join(
        f"select '{by}' as \"by\", * exclude (pid) from ({FOLD}) where {c} in (select {c} from orders where o_orderkey % 499 = 3)"
        for by, c in (("price", "o_totalprice"), ("date", "o_orderdate"))
    ),
    "generation_rows": f"select * exclude (pid) replace (case when segment_id = 3 then o_totalprice * 2 else o_totalprice end as o_totalprice) from ({FOLD})",
    "generation_changes": f"select segment_id, count(*) as record_count from ({FOLD}) where segment_id = 3 group by segment_id",
    "segment_prune": "select * from events where event_type in ('error', 'click')",
    "segment_scan": f"select * exclude (pid) from ({DEAL}) where segment_id in (0, 5, 12)",
    "render_payload": f"select segment_id, {PAYLOAD} as payload, '{{}}' as without_template from ({DEAL_COUNTS})",
    "publish_plan": " union all ".join(
        (plan("METADATA", "segment_id * 30", PAYLOAD), plan("URI", "0", PAYLOAD), plan("FILE", "0", "null"))
    ),
    "publish_validate": f"""
        with p as (select segment_id, {NAME} as segment_name, segment_id % 4 as r from ({DEAL_COUNTS}))
        select segment_id + 1 as push_order, segment_name, 'METADATA' as upload_mode,
               case r when 1 then 'no remote location' else 'location is not remote' end as problem from p where r in (1, 2)
        union all select segment_id + 1, segment_name, 'FILE', 'no local path' from p where r = 1""",
    "segment_job": JOB_COUNTS,
    "segment_job_rows": f"select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, order_ms, segment_id from ({dealt(f'({JOB_ROWS})', murmur_pid('o_custkey::varchar', 4), 4, 10, 'o_orderkey')})",
    "segment_job_json_rows": f"select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, order_ms, segment_id from ({folded(f'({JOB_ROWS})', murmur_pid('o_custkey::varchar', 4), 3)})",
    "segment_job_file_order": JOB_COUNTS,
    "segment_job_json_dealt": JOB_COUNTS,
    "segment_job_json_dealt_rows": f"select *, {murmur_pid('o_custkey::varchar', 4)} as pid, true as own from ({JOB_ROWS})",
    "segment_job_generations": f"""
        select * exclude (pid), count(*) over (partition by segment_id) as listed from ({JOB_FOLDED}) where o_orderkey % 4 <> 1""",
    "segment_job_statistics": f"""
        with t as ({JOB_FOLDED}), z as (select segment_id, min(order_ms)::varchar as zone_least from t group by segment_id)
        select s.*, zone_least from z join ("""
    + " union all ".join(
        f"select segment_id, count(*) as record_count, '{c}' as column_name, min({c})::varchar as min_value, max({c})::varchar as max_value, "
        f"count(*) - count({c}) as null_count from t group by segment_id"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "order_ms")
    )
    + ") s using (segment_id)",
    "input_file_stats": "select 7::bigint as file_count, count(*) as row_count from orders",
}
