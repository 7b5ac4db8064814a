"""DuckDB SQL giving the expected result of each registered query, written from the tables alone."""

from __future__ import annotations

ACTIONS = """
actions as (
  select event_id as seq,
    case when event_id % 50 = 0 then 'actionSubscribe'
         when event_id % 50 = 49 then 'actionUnsubscribe'
         when event_id % 103 = 9 then null
         when event_id % 10 = 5 then 'actionFetchStream'
         when event_id % 97 = 3 then 'actionFetchSchema'
         when event_id % 101 = 7 then 'actionBogus'
         else 'actionSendStream' end as action,
    case when event_id % 61 = 4 and event_id % 50 not in (0, 49) then null
         when event_id % 67 = 5 then 'topic-x'
         else concat('topic-', cast(user_id % 3 as varchar(9))) end as topic,
    case when event_id % 59 = 2 and event_id % 50 not in (0, 49) then null
         when event_id % 50 = 49
           then concat('subscriber-', cast(cast(floor(event_id / 50.0) as bigint) - 2 as varchar(9)))
         else concat('subscriber-', cast(cast(floor(event_id / 50.0) as bigint) + 1 - user_id % 5 as varchar(9)))
         end as subscriber_id,
    case when event_id % 71 = 6 then null else event_id end as batch_id,
    event_id % 73 <> 8 as has_rows
  from events),
topics(topic) as (values ('topic-0'), ('topic-1'), ('topic-2')),
attempts as (
  select 'subscriber-' || row_number() over (order by seq) as subscriber_id, topic, seq as start_seq
  from actions where action = 'actionSubscribe'),
intervals as (
  select a.subscriber_id, a.topic, a.start_seq, min(u.seq) as end_seq
  from attempts a
  left join actions u
    on u.action = 'actionUnsubscribe' and u.subscriber_id = a.subscriber_id and u.seq > a.start_seq
  where a.topic in (select topic from topics)
  group by all),
requests as (
  select a.*,
    exists (select 1 from intervals i where i.subscriber_id = a.subscriber_id and a.seq > i.start_seq
            and a.seq <= coalesce(i.end_seq, a.seq)) as is_subscriber
  from actions a),
judged as (
  select *, case
    when action is null then 'missing action'
    when action = 'actionBogus' then 'unsupported action'
    when action in ('actionFetchStream', 'actionUnsubscribe') then
      case when subscriber_id is null then 'missing subscriberId'
           when not is_subscriber then 'invalid subscriber' else 'ok' end
    when topic is null then 'missing topic'
    when action = 'actionSendStream' and batch_id is null then 'missing batchId'
    when action = 'actionSendStream' and not has_rows then 'missing rows'
    when topic not in (select topic from topics) then 'unknown topic'
    else 'ok' end as status
  from requests),
deliveries as (
  select s.seq, s.topic, i.subscriber_id
  from judged s join intervals i
    on i.topic = s.topic and s.seq > i.start_seq and (i.end_seq is null or s.seq < i.end_seq)
  where s.action = 'actionSendStream' and s.status = 'ok'),
assigned as (
  select d.seq, d.topic, d.subscriber_id,
    (select min(f.seq) from judged f
     where f.action = 'actionFetchStream' and f.status = 'ok' and f.subscriber_id = d.subscriber_id
       and f.seq > d.seq) as fetch_seq
  from deliveries d)
"""

PACKETS = """
with recursive e as (
  select {shard} as shard, event_id, (16 + strlen(event_type) + strlen(props))::bigint as sz,
         row_number() over (partition by {shard} order by event_id) as rn from events),
r as (
  select shard, event_id, sz, rn, 0::bigint as packet, sz as acc from e where rn = 1
  union all
  select e.shard, e.event_id, e.sz, e.rn,
         r.packet + case when r.acc >= 200 then 1 else 0 end,
         case when r.acc >= 200 then e.sz else r.acc + e.sz end
  from r join e on e.shard = r.shard and e.rn = r.rn + 1)
"""

WORDS = """
select unnest(case when text = '' then [''] when rtrim(text, ' ') = '' then []
                   else string_split(rtrim(text, ' '), ' ') end) as w from documents
"""

WORD_COUNT = f"select w as value, count(*) as count from ({WORDS}) group by 1"

STAMPED_EVENTS = """
select *, 'site-a' as tp_producer, cast(7 as bigint) as tp_batch_id,
       row_number() over (order by event_id) - 1 as tp_offset
from events
"""


def oracle_sql() -> dict[str, str]:
    packets = f"{PACKETS} select events.*, sz as size, packet from r join events using (event_id)"
    return {
        "topic_roundtrip": "select * from events",
        "topic_table": "select * from lineitem",
        "topic_replay_idempotent": "select * from events",
        "with_receive_time": "select *, '2024-03-01 12:30:45.678' as received from events",
        "row_ids": "select *, '7-' || (row_number() over (order by event_id) - 1) as id from events",
        "row_extra": """
            select cast(7 as bigint) as batch_id, row_number() over (order by event_id) - 1 as offset_in_batch,
                   '2024-03-01 12:30:45.678' as received from events""",
        "original_rows": "select * from events",
        "offset_range": """
            with placed as (
              select *, row_number() over (
                order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_orderkey) - 1 as position
              from orders)
            select * from placed
            where position > (select count(*) // 4 from orders)
              and position <= (select 3 * count(*) // 4 from orders)""",
        "batch_receipts": """
            select case l_linestatus when 'F' then 'site-f' else 'site-o' end as tp_producer,
                   cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as bigint) as tp_batch_id,
                   count(*) as rows, count(*) - 1 as last_offset,
                   cast(sum(strlen(cast(l_orderkey as varchar))) as bigint) as bytes
            from lineitem group by 1, 2""",
        "format_roundtrip": "select * from events",
        "format_table": """
            select vec_id, 'site-a' as tp_producer, cast(4 as bigint) as tp_batch_id,
                   dense_rank() over (order by vec_id) - 1 as tp_offset,
                   cast(unnest(range(len(embedding))) as integer) as place, cast(unnest(embedding) as double) as x
            from embeddings""",
        "manifest_range": """
            with placed as (
              select *, row_number() over (order by o_orderkey % 5, o_orderkey) - 1 as position
              from orders where o_custkey % 2 = 0)
            select * from placed
            where position > (select count(*) // 3 from placed) and position <= (select 4 * count(*) // 5 from placed)""",
        "topic_compaction": """
            select *, 'site-a' as tp_producer, event_id % 4 as tp_batch_id,
                   row_number() over (partition by event_id % 4 order by event_id) - 1 as tp_offset from events""",
        "topic_release": """
            select *, 'site-a' as tp_producer, event_id % 4 as tp_batch_id,
                   row_number() over (partition by event_id % 4 order by event_id) - 1 as tp_offset,
                   unnest(['left', 'slow', 'fast']) as reader
            from events where event_id % 4 >= 2""",
        "schema_change": """
            select o_orderkey,
                   case when o_orderkey % 3 > 0 then cast(cast(o_totalprice as float) as double) else o_totalprice end
                     as o_totalprice,
                   o_orderstatus, case when o_orderkey % 3 = 0 then o_orderpriority end as o_orderpriority,
                   case when o_orderkey % 3 = 0 then o_custkey end as customers
            from orders""",
        "topic_filter": """
            select * rename (event_type as topic) from events where event_type = 'purchase'""",
        "subscribe_from_now": """
            select 'early' as subscriber, * from events
            union all
            select 'late', * from events where coalesce(event_type not in ('view', 'click'), true)""",
        "unsubscribe": """
            select 'stays' as subscriber, * from events
            union all
            select 'leaves', * from events where event_type in ('view', 'click')""",
        "source_from_now": """
            select *, '2024-03-01 12:30:45.678' as _TIMESTAMP_ from events
            where coalesce(event_type not in ('view', 'click'), true)""",
        "topic_schema": """
            with counted as (unpivot (select count(columns(*)) from events) on columns(*) into name name value "values")
            select cast(d.place as integer) as place, d.column_name as name,
                   case d.column_type when 'BIGINT' then 'bigint' when 'DOUBLE' then 'double'
                        when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' end as type,
                   c."values"
            from (select *, row_number() over () - 1 as place from (describe events)) d
            join counted c on c.name = d.column_name
            union all
            select (select count(*) from (describe events)), '_TIMESTAMP_', 'timestamp', count(*) from events""",
        "fetch_incremental": """
            select cast(case when event_type in ('view', 'click') then 1 else 2 end as integer) as fetch_no, *
            from events""",
        "word_count": WORD_COUNT,
        "word_count_stream": WORD_COUNT,
        "split_words": """
            with w as (
              select conv_id, turn,
                     case when text = '' then [''] when rtrim(text, ' ') = '' then []
                          else string_split(rtrim(text, ' '), ' ') end as ws
              from conversations)
            select conv_id, turn, cast(unnest(range(len(ws))) as integer) as place, unnest(ws) as word from w""",
        "printed_rows": """
            with o as (select *, row_number() over (order by conv_id, turn) - 1 as line_no from conversations)
            select cast(-1 as bigint) as line_no, '++++++++topic=turns++++++++' as line
            union all
            select line_no, 'RowEx([' || coalesce(conv_id::varchar, 'null') || ',' || coalesce(turn::varchar, 'null')
                            || ',' || coalesce(role, 'null') || ',' || coalesce(text, 'null') || '],3,' || line_no
                            || ',2024-03-01 12:30:45.678)' from o""",
        "collector_rows": """
            select *, row_number() over (order by event_id) - 1 as tp_offset,
                   'site-a' as tp_producer, cast(0 as bigint) as tp_batch_id from events""",
        "collector_producers": """
            with parted as (
              select *, case when event_type in ('view', 'click') then '007' else '7' end as tp_producer from events)
            select *, row_number() over (partition by tp_producer order by event_id) - 1 as tp_offset,
                   cast(5 as bigint) as tp_batch_id from parted""",
        "packetize": packets.format(shard="user_id"),
        "packetize_large_shards": packets.format(shard="event_type"),
        "packet_offsets": f"""{PACKETS.format(shard="user_id")}
            select events.*, packet,
                   row_number() over (partition by shard, packet order by event_id) - 1 as packet_offset
            from r join events using (event_id)""",
        "json_roundtrip": "select * from events",
        "json_roundtrip_items": "select * from lineitem",
        "json_roundtrip_arrays": """
            select vec_id, label, cast(unnest(range(len(embedding))) as integer) as place,
                   cast(unnest(embedding) as double) as element from embeddings""",
        "packet_push_ingest": STAMPED_EVENTS,
        "arrow_push_ingest": STAMPED_EVENTS,
        "dedup_redelivery": STAMPED_EVENTS,
        "dedup_late_rows": STAMPED_EVENTS,
        "ingest_topic": STAMPED_EVENTS,
        "dedup_table": STAMPED_EVENTS,
        "delivered_ranges": """
            with o as (select row_number() over (order by event_id) - 1 as o from events),
            seen as (select o from o where o % 5 <> 2 or (o % 10 <> 7 and o % 1000 < 600)),
            runs as (select o, o - row_number() over (order by o) as run from seen)
            select 'site-a' as tp_producer, cast(7 as bigint) as tp_batch_id, min(o) as first, max(o) as until
            from runs group by run""",
        "push_receipts": """
            select (n - 1) // 1000 as shard, cast(count(*) as bigint) as rows, cast(1 as integer) as attempts
            from (select row_number() over (order by event_id) as n from events) group by 1""",
        "kafka_records": """
            select '7-' || (row_number() over (order by event_id) - 1) as key, cast(event_id as varchar) as value,
                   'events' as topic from events""",
        "kafka_records_json": """
            select '3-' || (row_number() over (order by conv_id, turn) - 1) as key,
                   cast(json_object('conv_id', conv_id, 'turn', turn, 'role', role, 'text', text) as varchar) as value,
                   'turns' as topic from conversations""",
        "classify_requests": f"with {ACTIONS} select seq, status from judged",
        "classify_requests_kafka": f"""
            with {ACTIONS}
            select seq, case when action is null then 'missing action'
                             when action <> 'actionSendStream' then 'unsupported action'
                             when topic is null then 'missing topic'
                             when batch_id is null then 'missing batchId'
                             when not has_rows then 'missing rows' else 'ok' end as status
            from actions""",
        "subscription_intervals": f"with {ACTIONS} select * from intervals",
        "fan_out": f"with {ACTIONS} select * from deliveries",
        "drain_assignment": f"with {ACTIONS} select * from assigned",
        "drain_assignment_stream": f"with {ACTIONS} select * from assigned",
        "undelivered_stream": f"""
            with {ACTIONS}
            select seq, topic from judged
            where action = 'actionSendStream' and status = 'ok'
              and seq not in (select seq from assigned where fetch_seq is not null)""",
        "undelivered": f"""
            with {ACTIONS}
            select seq, topic from judged
            where action = 'actionSendStream' and status = 'ok'
              and seq not in (select seq from assigned where fetch_seq is not null)""",
        "lost_copies": f"with {ACTIONS} select seq, topic, subscriber_id from assigned where fetch_seq is null",
    }
