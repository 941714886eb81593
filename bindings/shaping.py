"""Flattening, splitting, deduplication, lookups, quality rules and incremental selection."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bindings.common import RUN_TS, query, table
from silvermill.functions.columns import entity_name, json_map, run_stamp
from silvermill.operators.enrich import enrich_left, miss_count
from silvermill.operators.flatten import flatten_pages, split_by
from silvermill.operators.incremental import after_marks, in_states, in_window, marks_of
from silvermill.operators.latest import latest_by, latest_lookup
from silvermill.operators.paging import paginate
from silvermill.operators.quality import any_negative, duplicate_groups, evaluate, rules_for
from silvermill.session import Scratch

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"
LATEST_LINE_SQL = f"""select {LINE_COLUMNS} from lineitem qualify row_number() over (
  partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc) = 1"""
LATEST_ORDER_SQL = """select o_custkey, o_orderkey, o_orderstatus, o_orderdate from orders {where}
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""


def latest_lines(df):
    return latest_by(df.select(*LINE_COLUMNS.split(", ")), LINE_KEYS, LINE_ORDER)


def documents_with_label(spark, sf):
    """All documents, with their newest label where they have one; about half have none."""
    labels = table(spark, sf, "labels")
    newest = latest_lookup(labels, ["doc_id"], ["quality", "toxic"], ["quality", "toxic"])
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return enrich_left(documents, Scratch(spark).stage(newest, "lookup"), ["doc_id"], ["quality", "toxic"])


def labelled(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")


@query("explode_flatten", "select conv_id, turn, role, text from conversations")
def explode_flatten(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    pages = paginate(turns, ["conv_id"], Scratch(spark))
    return flatten_pages(
        pages, ("conv_id", "record.turn as turn", "record.role as role", "record.text as text")
    )


@query(
    "flatten_mixed",
    """select lower(role) || '#' || conv_id as conv_id, conv_id || '/' || turn as turn_id, 'record' as kind, turn
    from conversations""",
)
def flatten_mixed(spark, sf):
    """An expression over an envelope column and a record field, another whose name is that of the envelope
    column, and a literal that spells the record's name."""
    pages = paginate(table(spark, sf, "conversations").select("conv_id", "turn", "role"), ["conv_id"], Scratch(spark))
    fields = (
        "concat(lower(record.role), '#', conv_id) as conv_id",
        "concat_ws('/', conv_id, record.turn) as turn_id",
        "'record' as kind",
        "record.turn as turn",
    )
    return flatten_pages(pages, fields)


@query("explode_drops_empty", "select doc_id, quality, toxic from documents join labels using (doc_id)")
def explode_drops_empty(spark, sf):
    """Documents without a label carry an empty array, and give no row."""
    record = F.struct("quality", "toxic")
    empty = F.array().cast("array<struct<quality:int,toxic:int>>")
    pages = labelled(spark, sf).select(
        "doc_id", F.when(F.col("quality").isNotNull(), F.array(record)).otherwise(empty).alias("data")
    )
    return flatten_pages(pages, ("doc_id", "record.quality as quality", "record.toxic as toxic"))


def _split_documents(spark, sf):
    label = F.when(F.col("quality").isNotNull(), F.struct("quality", "toxic")).alias("label")
    base = documents_with_label(spark, sf).select("doc_id", label)
    return split_by(base.withColumn("has_label", F.col("label").isNotNull()), "has_label")


@query("split_present", "select doc_id, quality, toxic from documents join labels using (doc_id)")
def split_present(spark, sf):
    return _split_documents(spark, sf)[1].select("doc_id", "label.quality", "label.toxic")


@query("split_absent", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def split_absent(spark, sf):
    return _split_documents(spark, sf)[0].select("doc_id")


@query("equality_flag", "select doc_id, quality = 1 as flag from documents left join labels using (doc_id)")
def equality_flag(spark, sf):
    """Three-valued: null where there is nothing to compare."""
    return labelled(spark, sf).select("doc_id", (F.col("quality") == 1).alias("flag"))


@query(
    "rename_columns",
    """select s_suppkey as supplier_key, s_name as supplier_name, s_nationkey, s_acctbal as supplier_balance
    from supplier""",
)
def rename_columns(spark, sf):
    """A name that is not there is passed over."""
    names = {"s_suppkey": "supplier_key", "s_name": "supplier_name", "s_acctbal": "supplier_balance", "s_gone": "gone"}
    return table(spark, sf, "supplier").withColumnsRenamed(names)


@query("stamp_run_ts", "select o_orderkey, timestamp '2026-04-06 02:00:00' as silver_ingested_at from orders")
def stamp_run_ts(spark, sf):
    stamped = run_stamp(RUN_TS).cast("timestamp_ntz").alias("silver_ingested_at")
    return table(spark, sf, "orders").select("o_orderkey", stamped)


@query(
    "concat_key",
    """select doc_id, concat_ws('/', lang, case when quality = 1 then source end) as full_name
    from documents left join labels using (doc_id)""",
)
def concat_key(spark, sf):
    """Null parts are skipped; the key is never null."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", entity_name("lang", F.when(F.col("quality") == 1, F.col("source"))).alias("full_name"))


@query("json_map_field", "select event_id, json_extract_string(props, '$.k') as k from events")
def json_map_field(spark, sf):
    return table(spark, sf, "events").select("event_id", json_map("props")["k"].alias("k"))


@query(
    "dedupe_latest_per_day",
    """select event_id, user_id, cast(ts as date) as snapshot_date, ts from events qualify row_number() over (
    partition by user_id, cast(ts as date) order by ts desc, event_id desc) = 1""",
)
def dedupe_latest_per_day(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("snapshot_date"), "ts")
    return latest_by(events, ["user_id", "snapshot_date"], ["ts"], ["event_id"])


@query("dedupe_latest_per_key", LATEST_LINE_SQL)
def dedupe_latest_per_key(spark, sf):
    return latest_lines(table(spark, sf, "lineitem"))


@query(
    "dedupe_latest_per_key_day",
    """select event_id, event_type, user_id, cast(ts as date) as snapshot_date from events qualify row_number() over (
    partition by event_type, user_id, cast(ts as date) order by ts desc, event_id desc) = 1""",
)
def dedupe_latest_per_key_day(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    events = events.withColumn("snapshot_date", F.to_date("ts"))
    return latest_by(events, ["event_type", "user_id", "snapshot_date"], ["ts"], ["event_id"]).drop("ts")


@query("lookup_latest", LATEST_ORDER_SQL.format(where=""))
def lookup_latest(spark, sf):
    return latest_lookup(
        table(spark, sf, "orders"), ["o_custkey"], ["o_orderkey", "o_orderstatus", "o_orderdate"],
        ["o_orderdate", "o_orderkey"],
    )


@query(
    "enrich_left",
    "select doc_id, lang, source, n_chars, quality, toxic from documents left join labels using (doc_id)",
)
def enrich(spark, sf):
    return documents_with_label(spark, sf)


@query(
    "enrich_miss_count",
    """select count(*) as row_count, count(*) filter (where quality is null) as missing
    from documents left join labels using (doc_id)""",
)
def enrich_miss_count(spark, sf):
    return documents_with_label(spark, sf).agg(
        F.count("*").alias("row_count"), miss_count("quality").alias("missing")
    )


@query(
    "dq_null_counts",
    """select 'not_null' as rule, 'doc_id' as columns, count(*) filter (where doc_id is null) as value
    from documents left join labels using (doc_id)
    union all select 'not_null', 'quality', count(*) filter (where quality is null)
    from documents left join labels using (doc_id)
    union all select 'not_null', 'toxic', count(*) filter (where toxic is null)
    from documents left join labels using (doc_id)""",
)
def dq_null_counts(spark, sf):
    report = evaluate(labelled(spark, sf), rules_for(required=["doc_id", "quality", "toxic"]))
    return report.filter("rule = 'not_null'").select("rule", "columns", "value")


@query(
    "dq_negative_rows",
    """select count(*) filter (where c_acctbal < 0 or low < 0) as negative_rows from customer left join
    (select s_nationkey, min(s_acctbal) as low from supplier group by 1) on c_nationkey = s_nationkey""",
)
def dq_negative_rows(spark, sf):
    low = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.min("s_acctbal").alias("low"))
    rows = table(spark, sf, "customer").join(low, F.col("c_nationkey") == F.col("s_nationkey"), "left")
    return rows.agg(F.count_if(any_negative(["c_acctbal", "low"])).alias("negative_rows"))


@query(
    "dq_duplicate_groups",
    """select count(*) as value from (
    select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
)
def dq_duplicate_groups(spark, sf):
    return duplicate_groups(table(spark, sf, "lineitem"), LINE_KEYS)


@query(
    "dq_report",
    """with c as (select * from customer), m as (
      select 'not_empty' as rule, '' as columns, 'error' as severity, count(*) as value from c
      union all select 'not_null', 'c_custkey', 'error', count(*) filter (where c_custkey is null) from c
      union all select 'not_null', 'c_name', 'error', count(*) filter (where c_name is null) from c
      union all select 'not_blank', 'c_name', 'error', count(*) filter (where trim(c_name) = '') from c
      union all select 'not_negative', 'c_acctbal,c_nationkey', 'error',
        count(*) filter (where c_acctbal < 0 or c_nationkey < 0) from c
      union all select 'unique', 'c_mktsegment,c_nationkey', 'error', (select count(*) from (
        select 1 from c group by c_mktsegment, c_nationkey having count(*) > 1))
      union all select 'known', 'c_mktsegment', 'info', count(*) filter (where c_mktsegment is null) from c)
    select *, case when rule = 'not_empty' then value > 0 else value = 0 end as passed from m""",
)
def dq_report(spark, sf):
    rules = rules_for(
        required=["c_custkey", "c_name"],
        not_blank=["c_name"],
        not_negative=["c_acctbal", "c_nationkey"],
        unique=["c_mktsegment", "c_nationkey"],
        known=["c_mktsegment"],
    )
    return evaluate(table(spark, sf, "customer"), rules)


@query(
    "incremental_window",
    """select event_id, ts, event_type from events
    where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15'""",
)
def incremental_window(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return in_window(events, "ts", datetime(2024, 1, 8), datetime(2024, 1, 15))


@query(
    "incremental_since_hwm",
    """with h as (select event_type, max(ts) as last_run from events
      where ts < timestamp '2024-01-20' and event_type <> 'signup' group by 1)
    select event_id, e.ts, e.event_type from events e left join h on e.event_type = h.event_type
    where h.last_run is null or e.ts > h.last_run""",
)
def incremental_since_hwm(spark, sf):
    """One event type has no mark and is read in full."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    seen = in_window(events, "ts", until=datetime(2024, 1, 20)).filter("event_type <> 'signup'")
    marks = Scratch(spark).stage(marks_of(seen, ["event_type"], "ts"), "marks")
    return after_marks(events, marks, ["event_type"], "ts")


@query(
    "state_filter",
    """select 'all' as asked, o_orderkey, o_orderstatus from orders
    union all select 'open', o_orderkey, o_orderstatus from orders where o_orderstatus in ('O', 'P')""",
)
def state_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    everything = in_states(orders, "o_orderstatus").withColumn("asked", F.lit("all"))
    return everything.unionByName(in_states(orders, "o_orderstatus", ["O", "P"]).withColumn("asked", F.lit("open")))
