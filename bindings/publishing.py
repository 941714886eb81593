"""Replace, upsert, marks, audit, composed jobs and streaming."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from bindings.common import (
    CUSTOMER_SCHEMA,
    CUSTOMER_SQL,
    DAY,
    ENVELOPE,
    EVENT_FIELDS,
    EVENT_SCHEMA,
    RUN_TS,
    customer_records,
    event_records,
    query,
    table,
)
from bindings.shaping import LATEST_LINE_SQL, LINE_COLUMNS, LINE_KEYS, LINE_ORDER, documents_with_label, latest_lines
from silvermill.functions.columns import iso_text
from silvermill.operators.incremental import in_window, marks_of
from silvermill.plans.audit import read_runs
from silvermill.plans.jobs import newest, run_entity, run_snapshot, run_split_entity
from silvermill.plans.landing import land_records, land_snapshots, read_marks, write_marks
from silvermill.plans.specs import Feed, Lookup, Store, Table
from silvermill.session import Scratch
from silvermill.sinks.replace import replace_where
from silvermill.sinks.upsert import read_table, upsert
from silvermill.sources.envelopes import Scope, scan_envelopes
from silvermill.streaming.ingest import stream_entity, stream_split


def _store(spark) -> Store:
    folder = Scratch(spark)
    return Store(folder.path("bronze"), folder.path("silver"))


def _published_events(spark, sf):
    """Events published by day, and the frame."""
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("snapshot_date")
    )
    path = Scratch(spark).path("silver") + "/events"
    events.hint("rebalance", "snapshot_date").write.partitionBy("snapshot_date").parquet(path)
    return path, events


REPLACE_SQL = """with e as (select event_id, event_type, value, cast(ts as date) as snapshot_date from events)
select * from e where not ({old})
union all select event_id, event_type, value + 1, snapshot_date from e where {new}"""
THE_DAY = "snapshot_date = date '2024-01-15'"
CLICKS = THE_DAY + " and event_type = 'click'"


@query("replace_where_partition", REPLACE_SQL.format(old=THE_DAY, new=CLICKS))
def replace_where_partition(spark, sf):
    path, events = _published_events(spark, sf)
    for _ in range(2):  # the second run changes nothing
        replace_where(events.filter(CLICKS).withColumn("value", F.col("value") + 1), path, "2024-01-15")
    return spark.read.schema(events.schema).parquet(path)


@query("replace_where_scoped", REPLACE_SQL.format(old=CLICKS, new=CLICKS))
def replace_where_scoped(spark, sf):
    path, events = _published_events(spark, sf)
    scope = F.col("event_type") == F.lit("click")
    for _ in range(2):
        replace_where(events.filter(CLICKS).withColumn("value", F.col("value") + 1), path, "2024-01-15", scope)
    return spark.read.schema(events.schema).parquet(path)


_WEEK = [f"2024-01-{day}" for day in range(10, 17)]
_IN_WEEK = "snapshot_date between date '2024-01-10' and date '2024-01-16'"


@query("replace_where_dates", REPLACE_SQL.format(old=_IN_WEEK, new=_IN_WEEK + " and event_type <> 'click'"))
def replace_where_dates(spark, sf):
    """Entity rows published by date instead of by key: a week is run again, each date a replacement of its own."""
    path, events = _published_events(spark, sf)
    again = events.filter("event_type <> 'click'").withColumn("value", F.col("value") + 1)
    for day in _WEEK:
        replace_where(again.filter(F.col("snapshot_date") == F.lit(day).cast("date")), path, day)
    return read_table(spark, path)


_BY_IDS = """with e as (select user_id, event_id, event_type, value, cast(ts as date) as snapshot_date from events)
select user_id, event_id, event_type, case when {week} then value + 1 else value end as value,
  case when {week} then snapshot_date + 1 else snapshot_date end as snapshot_date
from e where user_id is not null and event_id is not null"""


@query("merge_by_ids", _BY_IDS.format(week=_IN_WEEK))
def merge_by_ids(spark, sf):
    """Keyed by the parent's id and the record's own, in partitions by date; a second batch changes values and dates."""
    events = table(spark, sf, "events").filter("user_id is not null and event_id is not null").select(
        "user_id", "event_id", "event_type", "value", F.to_date("ts").alias("snapshot_date")
    )
    changed = events.filter(_IN_WEEK).withColumns(
        {"value": F.col("value") + 1, "snapshot_date": F.date_add("snapshot_date", 1)}
    )
    path = Scratch(spark).path("silver") + "/events"
    for batch in (events, changed):
        upsert(batch, path, ["user_id", "event_id"], partition_by=["snapshot_date"])
    return read_table(spark, path)


def _lines(spark, sf, where="true"):
    return latest_lines(table(spark, sf, "lineitem").filter(where))


@query("merge_first_load", LATEST_LINE_SQL)
def merge_first_load(spark, sf):
    path = Scratch(spark).path("silver") + "/lines"
    upsert(_lines(spark, sf), path, LINE_KEYS)
    return read_table(spark, path)


_OLD = "l_shipdate < timestamp_ntz '1999-01-01 00:00:00'"
_NEW = "l_shipdate >= timestamp_ntz '1998-06-01 00:00:00'"
_LATEST = """{columns} from lineitem where {where} qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc) = 1"""
_MERGE_SQL = """with target as (select {old}), source as (select {new})
select * from target t where not exists (select 1 from source s
  where s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber)
union all select * from source"""


def _merge_sql(columns, old, new):
    return _MERGE_SQL.format(
        old=_LATEST.format(columns=columns, where=old.replace("timestamp_ntz", "timestamp")),
        new=_LATEST.format(columns=columns, where=new.replace("timestamp_ntz", "timestamp")),
    )


@query("merge_upsert", _merge_sql(LINE_COLUMNS, _OLD, _NEW))
def merge_upsert(spark, sf):
    path = Scratch(spark).path("silver") + "/lines"
    for where in (_OLD, _NEW):
        upsert(_lines(spark, sf, where), path, LINE_KEYS)
    return read_table(spark, path)


_YEAR = ", cast(year(l_shipdate) as int) as ship_year"


@query("merge_moves_partition", _merge_sql(LINE_COLUMNS + _YEAR, _OLD, _NEW))
def merge_moves_partition(spark, sf):
    """A matched row whose partition column changes leaves no copy in its old partition."""
    path = Scratch(spark).path("silver") + "/lines"
    for where in (_OLD, _NEW):
        lines = _lines(spark, sf, where).withColumn("ship_year", F.year("l_shipdate"))
        upsert(lines, path, LINE_KEYS, partition_by=["ship_year"])
    return read_table(spark, path)


@query("merge_newer_by", LATEST_LINE_SQL)
def merge_newer_by(spark, sf):
    """Batches in the wrong order; with a guard column the later state stays."""
    path = Scratch(spark).path("silver") + "/lines"
    for where in (_NEW, _OLD):
        upsert(_lines(spark, sf, where), path, LINE_KEYS, newer_by="l_shipdate")
    return read_table(spark, path)


@query("merge_type_drift", _merge_sql(LINE_COLUMNS, _OLD, _NEW))
def merge_type_drift(spark, sf):
    """A batch whose columns are of other types than the table's: the table keeps its own."""
    path = Scratch(spark).path("silver") + "/lines"
    upsert(_lines(spark, sf, _OLD), path, LINE_KEYS)
    drifted = _lines(spark, sf, _NEW)
    drifted = drifted.withColumns({
        "l_orderkey": F.col("l_orderkey").cast("int"), "l_linenumber": F.col("l_linenumber").cast("string"),
        "l_partkey": F.col("l_partkey").cast("string"), "l_shipdate": F.col("l_shipdate").cast("timestamp"),
    })
    upsert(drifted, path, LINE_KEYS)
    return read_table(spark, path)


@query("hwm_upsert", "select 'shop' as owner, event_type as repo, max(ts) as last_run from events group by event_type")
def hwm_upsert(spark, sf):
    path = Scratch(spark).path("silver") + "/_marks"
    events = event_records(spark, sf).withColumn("ts", F.to_timestamp("ts"))
    first = in_window(events, "ts", until=datetime(2024, 1, 16))
    second = in_window(events, "ts", since=datetime(2024, 1, 10))
    for part in (first, second):
        write_marks(marks_of(part, ["owner", "repo"], "ts").withColumn("endpoint", F.lit("events")), path)
    return read_marks(spark, path, "events").withColumn("last_run", F.col("last_run").cast("timestamp_ntz"))


# Composed jobs.

CUSTOMERS = Feed(
    "customers",
    CUSTOMER_SCHEMA,
    (
        "data.id as customer_id",
        "data.full_name as repo_full_name",
        "data.balance as balance",
        "data.home.name as nation",
        "data.home.region.name as region",
        "to_timestamp(fetched_at) as bronze_ingested_at",
        "to_timestamp(batch_timestamp) as bronze_batch_timestamp",
    ),
)
CUSTOMER_TABLE = Table(
    "customers",
    dedupe_keys=("customer_id", "snapshot_date"),
    required=("customer_id", "repo_full_name", "nation", "snapshot_date"),
)


@query(
    "job_snapshot",
    CUSTOMER_SQL.format(
        columns="""c_custkey as customer_id, r_name || '/' || c_name as repo_full_name, c_acctbal as balance,
        n_name as nation, timestamp '2026-04-06 02:30:00' as bronze_ingested_at, date '2026-04-06' as snapshot_date"""
    ),
)
def job_snapshot(spark, sf):
    """Landed twice in one day: the values of the second landing stay. A rerun changes nothing."""
    store = _store(spark)
    records = customer_records(spark, sf)
    land_snapshots(store, "customers", records.withColumn("balance", F.col("balance") - 1), RUN_TS, RUN_TS)
    land_snapshots(store, "customers", records, RUN_TS, RUN_TS + timedelta(minutes=30))
    for _ in range(2):
        run_snapshot(spark, store, CUSTOMERS, CUSTOMER_TABLE, Scope(DAY), run_ts=RUN_TS)
    silver = read_table(spark, store.table("customers"))
    ingested = F.col("bronze_ingested_at").cast("timestamp_ntz").alias("bronze_ingested_at")
    return silver.select("customer_id", "repo_full_name", "balance", "nation", ingested, "snapshot_date")


ORDER_FEED = Feed(
    "orders",
    """owner string, repo string, fetched_at string, batch_timestamp string,
    data struct<id bigint, status string, ordered_at string>""",
    (
        "data.id as order_id",
        "data.status as order_status",
        "cast(to_timestamp(data.ordered_at) as timestamp_ntz) as ordered_at",
        "concat_ws('/', owner, repo) as repo_full_name",
        "to_timestamp(fetched_at) as bronze_ingested_at",
        "to_timestamp(batch_timestamp) as bronze_batch_timestamp",
    ),
)
ORDER_TABLE = Table("orders", dedupe_keys=("order_id", "snapshot_date"), required=("order_id", "snapshot_date"))
LINE_FEED = Feed(
    "lines",
    ENVELOPE
    + """, data array<struct<order_id bigint, line int, l_partkey bigint, l_suppkey bigint, l_quantity double,
    l_extendedprice double, l_shipdate string>>""",
    (
        "record.order_id as order_id",
        "record.line as l_linenumber",
        "record.l_partkey as l_partkey",
        "record.l_suppkey as l_suppkey",
        "record.l_quantity as l_quantity",
        "record.l_extendedprice as l_extendedprice",
        "cast(to_timestamp(record.l_shipdate) as timestamp_ntz) as l_shipdate",
        "concat_ws('/', owner, repo) as repo_full_name",
        "to_timestamp(fetched_at) as bronze_ingested_at",
        "to_timestamp(batch_timestamp) as bronze_batch_timestamp",
    ),
)
LINE_TABLE = Table(
    "lines",
    dedupe_keys=("order_id", "l_linenumber"),
    publish_keys=("order_id", "l_linenumber"),
    order=("bronze_ingested_at", *LINE_ORDER),
    required=("order_id", "l_linenumber", "repo_full_name", "snapshot_date"),
    not_blank=("repo_full_name",),
    partition_by=("snapshot_date",),
)
ORDER_STATUS = Lookup("orders", key=("order_id",), values=("order_status",), version=("snapshot_date",))


def _land_orders(spark, sf, store, run_ts=RUN_TS, where="true", mark=""):
    orders = table(spark, sf, "orders").filter(where).select(
        F.col("o_orderstatus").alias("owner"),
        F.col("o_orderkey").cast("string").alias("repo"),
        F.col("o_orderkey").alias("id"),
        F.concat("o_orderstatus", F.lit(mark)).alias("status"),
        iso_text("o_orderdate").alias("ordered_at"),
    )
    land_snapshots(store, "orders", orders, run_ts, run_ts)


def _land_lines(spark, sf, store):
    """Three entities by return flag; the largest holds about half of the rows."""
    lines = table(spark, sf, "lineitem").select(
        F.lit("tpch").alias("owner"),
        F.col("l_returnflag").alias("repo"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        iso_text("l_shipdate").alias("l_shipdate"),
    )
    entities = lines.select("owner", "repo").distinct()
    land_records(spark, store, "lines", lines, entities, RUN_TS, "l_shipdate", fetched_at=RUN_TS)


@query(
    "job_entity",
    f"""select l_orderkey as order_id, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate,
    o_orderstatus as order_status from ({LATEST_LINE_SQL}) left join orders on l_orderkey = o_orderkey""",
)
def job_entity(spark, sf):
    """Orders published as snapshots, then line pages deduplicated, enriched, checked and upserted."""
    store = _store(spark)
    _land_orders(spark, sf, store)
    _land_lines(spark, sf, store)
    run_snapshot(spark, store, ORDER_FEED, ORDER_TABLE, Scope(DAY), run_ts=RUN_TS)
    run_entity(spark, store, LINE_FEED, LINE_TABLE, ORDER_STATUS, Scope(DAY), RUN_TS)
    return read_table(spark, store.table("lines")).select(
        "order_id", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
        "order_status",
    )


_VERSIONED = replace(ORDER_TABLE, current_by=("order_id",))


@query(
    "lookup_after_rerun",
    """select o_orderkey as order_id, o_orderstatus || case when o_orderkey = (select max(o_orderkey) from orders) then '4'
      when o_orderkey % 4 = 0 then '3' else '1' end as order_status from orders""",
)
def lookup_after_rerun(spark, sf):
    """The newest version per key after: a history that no current versions were kept for, a later date, a rerun of that
    date from which half of its keys are gone, a rerun of the earlier date, and a run for one entity."""
    store, later = _store(spark), RUN_TS + timedelta(days=7)
    again = Store(Scratch(spark).path("bronze"), store.silver)
    _land_orders(spark, sf, store, mark="1")
    _land_orders(spark, sf, store, later, "o_orderkey % 2 = 0", "2")
    _land_orders(spark, sf, again, later, "o_orderkey % 4 = 0", "3")
    run_snapshot(spark, store, ORDER_FEED, ORDER_TABLE, Scope(DAY), run_ts=RUN_TS)
    for source, run_ts in ((store, later), (again, later), (store, RUN_TS)):
        run_snapshot(spark, source, ORDER_FEED, _VERSIONED, Scope(f"{run_ts:%Y-%m-%d}"), run_ts=run_ts)
    last = RUN_TS + timedelta(days=14)
    newest_order = table(spark, sf, "orders").orderBy(F.desc("o_orderkey")).first()
    _land_orders(spark, sf, store, last, f"o_orderkey > {newest_order.o_orderkey} - 100", "4")
    entity = (newest_order.o_orderstatus, str(newest_order.o_orderkey))
    run_snapshot(spark, store, ORDER_FEED, _VERSIONED, Scope(f"{last:%Y-%m-%d}", *entity), run_ts=last)
    return newest(spark, store, ORDER_STATUS, Scratch(spark))


@query(
    "run_audit_counts",
    """select 'lines' as job, 'SUCCESS' as status, cast(0 as bigint) as miscounted_pages,
    cast(0 as bigint) as corrupt_pages, cast((select sum(ceil(n / 100.0)) from (
      select count(*) as n from lineitem group by l_returnflag)) as bigint) as pages,
    (select count(*) from lineitem) as records,
    (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as rows_written""",
)
def run_audit_counts(spark, sf):
    """The audit record of an entity run: pages read, records in them, rows published."""
    store = _store(spark)
    _land_lines(spark, sf, store)
    run_entity(spark, store, LINE_FEED, LINE_TABLE, None, Scope(DAY), RUN_TS)
    return read_runs(spark, store.table("_runs")).select(
        "job", "status", "pages", "miscounted_pages", "corrupt_pages", "records", F.col("rows_written")["lines"].alias("rows_written")
    )


_PAGE = """case when s_suppkey % 3 = 0 then '{{"owner":"tpch","repo":"S","endpoint":"lines","count":"many","data":{{"message":"' || s_name || '"}}}}'
  when s_suppkey % 3 = 1 then '{{"owner":"tpch","repo":"S","endpoint":"lines","count":2,"batch_timestamp":"2026-04-06T02:00:00Z","data":[{{"order_id":' || s_suppkey || ',"line":1,"l_quantity":"' || s_name || '"}},{{"order_id":' || s_suppkey || ',"line":2,"l_quantity":{{"n":1}}}}]}}'
  else '{{"owner":"tpch","repo":"S","endpoint":"lines","count":1,"batch_timestamp":"2026-04-06T02:00:00Z","data":[{{"order_id":' || s_suppkey || ',"line":1,"l_quantity":2.5}}]}}' end""".replace("{{", "{").replace("}}", "}")


@query(
    "run_audit_damage",
    """select count(*) as pages, count(*) filter (s_suppkey % 3 = 0) as corrupt_pages, count(*) filter (s_suppkey % 3 = 1) as misfit_pages,
    count(*) filter (s_suppkey % 3 = 0) as bad_counts, count(*) filter (s_suppkey % 3 = 0) as bad_data,
    2 * count(*) filter (s_suppkey % 3 = 1) as bad_quantities, count(*) filter (s_suppkey % 3 <> 2) as quarantined,
    2 * count(*) filter (s_suppkey % 3 = 1) + count(*) filter (s_suppkey % 3 = 2) as records,
    2 * count(*) filter (s_suppkey % 3 = 1) + count(*) filter (s_suppkey % 3 = 2) as rows_written from supplier""",
)
def run_audit_damage(spark, sf):
    """A page per supplier: error bodies in place of records, values that do not fit their field, and sound ones. What is
    damaged is counted by field and kept; the feed says that it does not stop the job."""
    store = _store(spark)
    pages = table(spark, sf, "supplier").select(F.expr(_PAGE).alias("value"))
    pages.write.text(store.landed("lines") + "/yyyy=2026/mm=04/dd=06/hh=02/owner=tpch/repo=S")
    feed = replace(LINE_FEED, damaged="warn", misfits="warn")
    run_entity(spark, store, feed, replace(LINE_TABLE, order=("l_quantity",)), None, Scope(DAY), RUN_TS)
    kept = spark.read.schema("text string").json(store.table("_quarantine")).agg(F.count("text").alias("quarantined"))
    return read_runs(spark, store.table("_runs")).crossJoin(F.broadcast(kept)).select(
        "pages", "corrupt_pages", "misfit_pages", F.col("misfits")["count"].alias("bad_counts"),
        F.col("misfits")["data"].alias("bad_data"), F.col("misfits")["data[].l_quantity"].alias("bad_quantities"),
        "quarantined", "records", F.col("rows_written")["lines"].alias("rows_written"),
    )


MIXED_FEED = Feed(
    "mixed",
    ENVELOPE + """, data array<struct<doc_id bigint, n_chars bigint, label struct<quality int, toxic int>>>""",
    (
        "record.doc_id as doc_id",
        "record.n_chars as n_chars",
        "concat_ws('/', owner, repo) as repo_full_name",
        "record.label.quality as quality",
        "record.label is not null as has_label",
        "to_timestamp(fetched_at) as bronze_ingested_at",
        "to_timestamp(batch_timestamp) as bronze_batch_timestamp",
    ),
)


def _mixed_table(name, **more):
    key = more.pop("key", "doc_id")
    return Table(
        name,
        dedupe_keys=("repo_full_name", key, "snapshot_date"),
        publish_keys=("repo_full_name", key),
        required=(key, "repo_full_name", "snapshot_date"),
        not_blank=("repo_full_name",),
        **more,
    )


WITHOUT = _mixed_table("without_label")
HAVING = _mixed_table("with_label", key="labelled_id", renames={"doc_id": "labelled_id"})


def _land_mixed(spark, sf, store, run_ts, where="true", more=0):
    label = F.when(F.col("quality").isNotNull(), F.struct("quality", "toxic")).alias("label")
    rows = documents_with_label(spark, sf).filter(where).select(
        F.lit("corpus").alias("owner"), F.col("lang").alias("repo"), "doc_id", (F.col("n_chars") + more).alias("n_chars"), label
    )
    land_records(
        spark, store, "mixed", rows, rows.select("owner", "repo").distinct(), run_ts, "doc_id", fetched_at=run_ts
    )


@query(
    "stream_two_dates",
    """select doc_id, n_chars + case when doc_id % 2 = 0 then 1 else 0 end as n_chars, quality,
      case when doc_id % 2 = 0 then date '2026-04-13' else date '2026-04-06' end as snapshot_date,
      case when quality is null then 'absent' else 'present' end as part, cast(1 as bigint) as runs
    from documents left join labels using (doc_id)""",
)
def stream_two_dates(spark, sf):
    """Two landed dates reach a mixed feed's stream in one batch: the later date wins, and a second start adds nothing."""
    store = _store(spark)
    checkpoint = Scratch(spark).path("stream")
    _land_mixed(spark, sf, store, RUN_TS + timedelta(days=7), "doc_id % 2 = 0", 1)
    _land_mixed(spark, sf, store, RUN_TS)
    for _ in range(2):
        stream_split(spark, store, MIXED_FEED, "has_label", WITHOUT, HAVING, checkpoint, run_ts=RUN_TS)
    absent = read_table(spark, store.table("without_label")).withColumn("part", F.lit("absent"))
    present = read_table(spark, store.table("with_label")).withColumn("part", F.lit("present"))
    present = present.withColumnRenamed("labelled_id", "doc_id")
    runs = read_runs(spark, store.table("_runs")).filter("status = 'SUCCESS'").agg(F.count("*").alias("runs"))
    columns = ["doc_id", "n_chars", "quality", "snapshot_date", "part"]
    return absent.select(*columns).unionByName(present.select(*columns)).crossJoin(F.broadcast(runs))


@query(
    "job_split",
    """select doc_id, n_chars, quality, case when quality is null then 'absent' else 'present' end as part
    from documents left join labels using (doc_id)""",
)
def job_split(spark, sf):
    """Document pages with an optional label struct to two tables, one with a renamed key."""
    store = _store(spark)
    _land_mixed(spark, sf, store, RUN_TS)
    run_split_entity(spark, store, MIXED_FEED, "has_label", WITHOUT, HAVING, None, Scope(DAY), RUN_TS)
    absent = read_table(spark, store.table("without_label")).withColumn("part", F.lit("absent"))
    present = read_table(spark, store.table("with_label")).withColumn("part", F.lit("present"))
    present = present.withColumnRenamed("labelled_id", "doc_id")
    columns = ["doc_id", "n_chars", "quality", "part"]
    return absent.select(*columns).unionByName(present.select(*columns))


STREAM_TABLE = Table(
    "events", dedupe_keys=("event_id",), publish_keys=("event_id",), order=("ts",), required=("event_id",)
)


@query(
    "land_incremental",
    """select event_type, count(*) as landed from events where ts >= timestamp '2024-01-16' group by event_type""",
)
def land_incremental(spark, sf):
    """A marked run up to 2024-01-16, then a run that takes only what the marks leave."""
    store = _store(spark)
    cut = datetime(2024, 1, 16)
    records = event_records(spark, sf).withColumn("at", F.to_timestamp("ts"))
    entities = records.select("owner", "repo").distinct()
    land_records(spark, store, "events", records, entities, cut, "at", until=cut, mark=True, fetched_at=RUN_TS)
    land_records(spark, store, "events", records, entities, RUN_TS, "at", mark=True, fetched_at=RUN_TS)
    newest = scan_envelopes(spark, store.landed("events"), EVENT_SCHEMA, Scope(DAY))
    return newest.groupBy(F.col("repo").alias("event_type")).agg(F.sum("count").alias("landed"))


@query(
    "stream_equals_batch",
    """select event_id, ts, user_id, event_type, value, timestamp '2026-04-06 02:00:00' as silver_ingested_at,
    date '2026-04-06' as snapshot_date from events""",
)
def stream_equals_batch(spark, sf):
    """Two rounds of new files, each taken once, end in the table one batch would give."""
    store = _store(spark)
    checkpoint = Scratch(spark).path("stream")
    batch_time = "to_timestamp(batch_timestamp) as bronze_batch_timestamp"
    feed = Feed("events", EVENT_SCHEMA, (*EVENT_FIELDS, batch_time))
    records = event_records(spark, sf).withColumn("at", F.to_timestamp("ts"))
    entities = records.select("owner", "repo").distinct()
    cut = datetime(2024, 1, 16)
    for since, until in ((None, cut), (cut, None)):
        land_records(spark, store, "events", records, entities, RUN_TS, "at", since, until, fetched_at=RUN_TS)
        stream_entity(spark, store, feed, STREAM_TABLE, checkpoint, run_ts=RUN_TS)
    ingested = F.col("silver_ingested_at").cast("timestamp_ntz")
    streamed = read_table(spark, store.table("events")).drop("bronze_batch_timestamp")
    return streamed.withColumn("silver_ingested_at", ingested)
