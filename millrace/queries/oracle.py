"""DuckDB SQL for every query, over the same Parquet tables."""

from __future__ import annotations

from millrace.queries.inputs import TABLES

WORDS = """
    select doc_id, word from (
        select doc_id, lower(trim(unnest(string_split(sentence, ' ')))) as word from (
            select doc_id, unnest(string_split("text", '.')) as sentence from documents))
    where word is not null and regexp_matches(word, '[a-z]')
"""

WORD_COUNT = f'select word, count(*) as "count" from ({WORDS}) group by word'

INVOICE_LINES = """
    select cast(o_orderkey as varchar) as "InvoiceNumber",
           cast(epoch(o_orderdate) as bigint) as "CreatedTime",
           'STR' || (o_orderkey % 97) as "StoreID",
           'POS' || (o_orderkey % 11) as "PosID",
           o_orderstatus as "CustomerType",
           o_orderpriority as "PaymentMethod",
           'HOME-DELIVERY' as "DeliveryType",
           'City ' || (o_custkey % 31) as "City",
           o_orderstatus as "State",
           cast(o_custkey as varchar) as "PinCode",
           cast(l_partkey as varchar) as "ItemCode",
           l_returnflag || '/' || l_linestatus as "ItemDescription",
           l_extendedprice as "ItemPrice",
           cast(l_quantity as bigint) as "ItemQty",
           l_extendedprice * (1 - l_discount) as "TotalValue"
    from orders join lineitem on o_orderkey = l_orderkey
"""

TRADE_TYPE = """case event_type when 'purchase' then 'BUY' when 'click' then 'SELL'
                else event_type end"""

LOG_COLUMNS = f"""
    cast(user_id as varchar) as "key",
    strftime(ts, '%Y-%m-%d %H:%M:%S') as "CreatedTime",
    {TRADE_TYPE} as "Type",
    value as "Amount",
    event_type as "BrokerCode",
    value as "Reading"
"""

LOG_PARSE = f"""select {LOG_COLUMNS}, 'events' as topic, ts as "timestamp" from events"""

LOG_BATCH = f"""
    select cast(user_id as varchar) as "key",
           '{{"CreatedTime":"' || strftime(ts, '%Y-%m-%d %H:%M:%S')
           || '","Type":"' || {TRADE_TYPE}
           || '","Amount":' || cast(value as varchar)
           || ',"BrokerCode":"' || event_type
           || '","Reading":' || cast(value as varchar) || '}}' as "value",
           'events' as topic, event_id as "offset", ts as "timestamp"
    from events
"""

IDEMPOTENT = f"""
    select "key", "CreatedTime", "Type", "Amount", "BrokerCode", "Reading", topic, "timestamp"
    from (select {LOG_COLUMNS}, topic, ts as "timestamp",
                 row_number() over (
                     partition by ts, event_type, value order by topic desc, event_id desc) as n
          from (select *, 'events' as topic from events
                union all
                select *, 'events-replay' from events
                where ts >= timestamp '2024-01-15 00:00:00'))
    where n = 1
"""

AMOUNT = "cast(o_totalprice as decimal(18,2))"

REWARDS = f"""
    select cast(o_custkey as varchar) as "CustomerCardNo",
           cast(sum({AMOUNT}) as double) as "TotalAmount",
           cast(sum({AMOUNT} * 0.02) as double) as "TotalPoints"
    from orders group by o_custkey
"""

EXACT_SUMMARY = """
    select time_bucket(interval 15 minutes, ts) as "start",
           time_bucket(interval 15 minutes, ts) + interval 15 minutes as "end",
           sum(case when event_type = 'purchase' then cast(value as decimal(18,2)) else 0 end)
               as buy,
           sum(case when event_type = 'click' then cast(value as decimal(18,2)) else 0 end)
               as sell
    from events group by 1, 2
"""

TRADE_SUMMARY = f"""
    select "start", "end", cast(buy as double) as "TotalBuy", cast(sell as double) as "TotalSell"
    from ({EXACT_SUMMARY})
"""

SENSOR_TUMBLING = """
    select cast(user_id as varchar) as "SensorID",
           time_bucket(interval 15 minutes, ts) as "start",
           time_bucket(interval 15 minutes, ts) + interval 15 minutes as "end",
           max(value) as "MaxReading"
    from events group by 1, 2, 3
"""

SENSOR_SLIDING = """
    select cast(user_id as varchar) as "SensorID", "start",
           "start" + interval 15 minutes as "end", max(value) as "MaxReading"
    from (select user_id, value,
                 unnest([bucket, bucket - interval 5 minutes, bucket - interval 10 minutes])
                     as "start"
          from (select user_id, value, time_bucket(interval 5 minutes, ts) as bucket
                from events))
    group by 1, 2
"""

# Every 50th payload is cut short, the one after it has an amount in words, the next is missing.
MALFORMED = f"""
    with log as (
        select event_id, ts, cast(user_id as varchar) as "key", event_id % 50 as nth,
               strftime(ts, '%Y-%m-%d %H:%M:%S') as at_time, {TRADE_TYPE} as kind, value, event_type,
               '{{{{"CreatedTime":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","Type":"' || {TRADE_TYPE}
                   || '","Amount":' as head,
               ',"BrokerCode":"' || event_type || '","Reading":' || cast(value as varchar) || '}}}}'
                   as tail
        from events)
    select "key", event_id as "offset", nth < 2 as is_malformed,
           case nth when 0 then substr(head, 1, 20) when 1 then head || '"much"' || tail end
               as malformed,
           case when nth > 2 then at_time end as "CreatedTime",
           case when nth > 2 then kind end as "Type",
           case when nth > 2 then value end as "Amount",
           case when nth > 2 then event_type end as "BrokerCode",
           case when nth > 2 then value end as "Reading"
    from log
""".replace("{{", "{").replace("}}", "}")

OBSERVED = """
    with bounds as (select epoch_us(min(ts)) as low, epoch_us(max(ts)) as high from events),
    waves as (
        select ts, event_id % 50 as nth,
               ts is null or epoch_us(ts) < low + round((high - low) / 3.0) as is_first
        from events, bounds),
    reached as (
        select max(date_trunc('second', ts)) - interval 30 minutes as watermark
        from waves where not is_first and nth > 2),
    marked as (
        select *, coalesce(is_first and nth > 2 and
                  time_bucket(interval 15 minutes, ts) + interval 15 minutes <= watermark, false)
                  as is_late
        from waves, reached)
    select count(*) as rows_in, count(*) filter (nth < 2) as malformed,
           count(*) filter (nth = 2 or (nth > 2 and ts is null)) as untimed,
           count(*) filter (nth > 2 and ts is not null and not is_late) as counted,
           count(*) filter (is_late) as late
    from marked
"""

ORACLE = {
    "text_sentences": """
        select sentence, count(*) as n
        from (select unnest(string_split("text", '.')) as sentence from documents)
        group by sentence""",
    "word_tokens": f"select doc_id, word, count(*) as n from ({WORDS}) group by doc_id, word",
    "word_count": WORD_COUNT,
    "word_count_overwrite": WORD_COUNT,
    "words_with_prefix": f"""
        select cast(sum("count") as bigint) as total
        from ({WORD_COUNT}) where substr(word, 1, 1) = 's'""",
    "json_infer": """
        select event_id, user_id, value, cast(json_extract(props, '$.k') as bigint) as k
        from events""",
    "csv_roundtrip": "select * from customer",
    "source_file_lineage": """
        select 'orders.parquet' as input_file, count(*) as n_rows from orders
        union all select 'lineitem.parquet', count(*) from lineitem""",
    "row_count": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {name}" for name in TABLES
    ),
    "peek_rows": "select * from orders order by o_orderkey limit 10",
    "invoice_lines": INVOICE_LINES,
    "invoice_documents": """
        select cast(o_orderkey as varchar) as "InvoiceNumber", cast(1 as bigint) as "PageNumber",
               count(*) as n_items, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
        from orders join lineitem on o_orderkey = l_orderkey group by o_orderkey""",
    "log_batch_read": LOG_BATCH,
    "log_malformed": MALFORMED,
    "log_parse": LOG_PARSE,
    "log_from_timestamp": f"{LOG_PARSE} where ts >= timestamp '2024-01-15 00:00:00'",
    "sensor_parse": """
        select cast(user_id as varchar) as "SensorID",
               date_trunc('second', ts) as "CreatedTime", value as "Reading"
        from events""",
    "trade_parse": f"""
        select date_trunc('second', ts) as "CreatedTime", {TRADE_TYPE} as "Type",
               value as "Amount", event_type as "BrokerCode",
               case when event_type = 'purchase' then value else 0 end as "Buy",
               case when event_type = 'click' then value else 0 end as "Sell"
        from events""",
    "rewards": REWARDS,
    "rewards_double": """
        select cast(o_custkey as varchar) as "CustomerCardNo",
               round(sum(o_totalprice), 2) as "TotalAmount",
               round(sum(o_totalprice * cast(0.02 as double)), 4) as "TotalPoints"
        from orders group by o_custkey""",
    "trade_summary": TRADE_SUMMARY,
    "trade_summary_sliding": """
        select "start", "start" + interval 15 minutes as "end",
               cast(sum(case when event_type = 'purchase' then amount else 0 end) as double)
                   as "TotalBuy",
               cast(sum(case when event_type = 'click' then amount else 0 end) as double)
                   as "TotalSell"
        from (select event_type, cast(value as decimal(18,2)) as amount,
                     unnest([bucket, bucket - interval 5 minutes, bucket - interval 10 minutes])
                         as "start"
              from (select *, time_bucket(interval 5 minutes, ts) as bucket from events))
        group by 1""",
    "sensor_max_tumbling": SENSOR_TUMBLING,
    "sensor_max_sliding": SENSOR_SLIDING,
    "window_lookup": f"""
        select "TotalBuy", "TotalSell" from ({TRADE_SUMMARY})
        where strftime("start", '%Y-%m-%d %H:%M:%S') = '2024-01-15 00:45:00'
          and strftime("end", '%Y-%m-%d %H:%M:%S') = '2024-01-15 01:00:00'""",
    "running_net": f"""
        select "end", strftime("end", '%H:%M') as at_time,
               cast(sum(buy) over (order by "end") as double) as "Buy",
               cast(sum(sell) over (order by "end") as double) as "Sell",
               cast(sum(buy) over (order by "end") - sum(sell) over (order by "end") as double)
                   as "Net"
        from ({EXACT_SUMMARY})""",
    "upsert_replace": f"""
        with sides as (
            select cast(o_custkey as varchar) as card,
                   o_orderdate >= timestamp '1998-01-01' as is_new,
                   sum({AMOUNT}) as amount, sum({AMOUNT} * 0.02) as points
            from orders group by 1, 2)
        select coalesce(n.card, o.card) as "CustomerCardNo",
               cast(case when n.card is null then o.amount else n.amount end as double)
                   as "TotalAmount",
               cast(case when n.card is null then o.points else n.points end as double)
                   as "TotalPoints"
        from (select * from sides where is_new) n
        full join (select * from sides where not is_new) o on n.card = o.card""",
    "upsert_accumulate": REWARDS,
    "upsert_latest": """
        select coalesce(c_custkey, o_custkey) as custkey, price as last_price
        from customer
        full join (select o_custkey, max_by(o_totalprice, o_orderkey) as price
                   from orders group by 1) on c_custkey = o_custkey""",
    "idempotent_ingest": IDEMPOTENT,
    "stream_word_count": WORD_COUNT,
    "stream_invoice_lines": INVOICE_LINES,
    "stream_default_trigger": INVOICE_LINES,
    "stream_interval_trigger": INVOICE_LINES,
    "stream_log_to_bronze": LOG_PARSE,
    "stream_restart": LOG_PARSE,
    "stream_idempotent_ingest": IDEMPOTENT,
    "stream_rewards_complete": REWARDS,
    "stream_rewards_update": REWARDS,
    "stream_rewards_accumulate": REWARDS,
    "stream_trade_summary": TRADE_SUMMARY,
    "stream_sensor_sliding": SENSOR_SLIDING,
    "stream_sensor_append": f"""
        select * from ({SENSOR_TUMBLING})
        where "end" <= (select max(date_trunc('second', ts)) from events) - interval 30 minutes""",
    "stream_inserted_rows": TRADE_SUMMARY,
    "stream_log_checked": MALFORMED,
    "stream_trade_update": TRADE_SUMMARY,
    "stream_sensor_update": SENSOR_SLIDING,
    "stream_trade_append": f"""
        select * from ({TRADE_SUMMARY})
        where "end" <= (select max(date_trunc('second', ts)) from events) - interval 30 minutes""",
    "stream_state_readback": f"""
        select w.*, watermark
        from ({SENSOR_TUMBLING}) w,
             (select max(date_trunc('second', ts)) - interval 30 minutes as watermark from events)
        where "end" > watermark""",
    "stream_observed_counts": OBSERVED,
}
