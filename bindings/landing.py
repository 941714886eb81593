"""Landing, scanning and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import (
    CUSTOMER_SCHEMA,
    CUSTOMER_SQL,
    DAY,
    EVENT_FIELDS,
    EVENT_SCHEMA,
    RUN_TS,
    customer_records,
    event_records,
    land_event_pages,
    query,
    table,
)
from silvermill.functions.columns import iso_text, parse_ts, snapshot_date, time_parts, url_param
from silvermill.operators.flatten import flatten_pages, flatten_snapshots
from silvermill.operators.paging import count_pages, plan_pages
from silvermill.plans.landing import land_snapshots
from silvermill.plans.specs import Store
from silvermill.session import Scratch
from silvermill.sinks.landing import land, landed_totals, page_envelopes
from silvermill.sources.entities import scope_entities
from silvermill.sources.envelopes import Scope, scan_envelopes
from silvermill.sources.paged import raw_envelopes

EVENTS_SQL = "select event_id, ts, user_id, event_type, value from events"


@query("bronze_page_scan", EVENTS_SQL)
def bronze_page_scan(spark, sf):
    root = land_event_pages(spark, sf)
    pages = scan_envelopes(spark, root, EVENT_SCHEMA, Scope(DAY), endpoint="events")
    return flatten_pages(pages, EVENT_FIELDS)


def _landed_customers(spark, sf) -> str:
    store = Store(Scratch(spark).path("bronze"), "")
    land_snapshots(store, "customers", customer_records(spark, sf), RUN_TS, fetched_at=RUN_TS)
    return store.landed("customers")


@query(
    "land_snapshot",
    CUSTOMER_SQL.format(
        columns="""r_name as owner, c_name as repo, '2026-04-06T02:00:00.000000Z' as fetched_at,
        'customers' as endpoint, '2026' as yyyy, '04' as mm, '06' as dd, '02' as hh"""
    ),
)
def land_snapshot(spark, sf):
    root = _landed_customers(spark, sf)
    landed = scan_envelopes(spark, root, CUSTOMER_SCHEMA, Scope(DAY), with_partitions=True)
    return landed.drop("batch_timestamp", "data")


@query(
    "bronze_snapshot_scan",
    CUSTOMER_SQL.format(
        columns="""c_custkey as id, r_name || '/' || c_name as full_name, c_acctbal as balance, n_name as nation,
        r_name as region"""
    ),
)
def bronze_snapshot_scan(spark, sf):
    landed = scan_envelopes(spark, _landed_customers(spark, sf), CUSTOMER_SCHEMA, Scope(DAY))
    return landed.select("data.id", "data.full_name", "data.balance", F.col("data.home.name").alias("nation"),
                         F.col("data.home.region.name").alias("region"))


@query(
    "nested_project",
    """select c_custkey as customer_id, cast(o_orderkey as bigint) as order_id, o_orderpriority as priority
    from customer left join (select * from orders qualify row_number() over (
      partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1) on c_custkey = o_custkey""",
)
def nested_project(spark, sf):
    """A customer without an order has a null parent struct, so its leaves are null."""
    newest = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.max_by(F.struct("o_orderkey", "o_orderpriority"), F.struct("o_orderdate", "o_orderkey")).alias("o"))
    )
    nested = table(spark, sf, "customer").join(newest, F.col("c_custkey") == F.col("o_custkey"), "left")
    envelopes = nested.select(F.struct(F.col("c_custkey").alias("id"), F.col("o").alias("newest")).alias("data"))
    return flatten_snapshots(
        envelopes,
        (
            "cast(data.id as bigint) as customer_id",
            "cast(data.newest.o_orderkey as bigint) as order_id",
            "data.newest.o_orderpriority as priority",
        ),
    )


@query("date_scope_scan", EVENTS_SQL + " where cast(ts as date) = date '2024-01-15'")
def date_scope_scan(spark, sf):
    root = land_event_pages(spark, sf, daily=True)
    return flatten_pages(scan_envelopes(spark, root, EVENT_SCHEMA, Scope("2024-01-15")), EVENT_FIELDS)


@query(
    "entity_scope_scan",
    EVENTS_SQL + " where cast(ts as date) = date '2024-01-15' and event_type = 'click'",
)
def entity_scope_scan(spark, sf):
    root = land_event_pages(spark, sf, daily=True)
    scope = Scope("2024-01-15", "shop", "click")
    return flatten_pages(scan_envelopes(spark, root, EVENT_SCHEMA, scope), EVENT_FIELDS)


@query(
    "time_partition_cols",
    """select event_id, strftime(ts, '%Y') as yyyy, strftime(ts, '%m') as mm, strftime(ts, '%d') as dd,
    strftime(ts, '%H') as hh from events""",
)
def time_partition_cols(spark, sf):
    parts = [c.alias(name) for name, c in time_parts("ts").items()]
    return table(spark, sf, "events").select("event_id", *parts)


@query(
    "land_pages",
    """with totals as (select event_type, count(*) as n from events group by 1),
    planned as (select event_type, n, unnest(generate_series(1, cast(ceil(n / 100.0) as bigint))) as page from totals)
    select event_type, cast(page as bigint) as page, cast(least(100, n - 100 * (page - 1)) as bigint) as count,
      'https://api.example.org/repos/shop/' || event_type || '/events?per_page=100&page=' || page as url
    from planned""",
)
def land_pages(spark, sf):
    """Every landed page: all are full but each entity's last."""
    root = land_event_pages(spark, sf)
    schema = EVENT_SCHEMA.replace(", data", ", params struct<per_page bigint, page bigint>, data")
    pages = scan_envelopes(spark, root, schema, Scope(DAY))
    return pages.select(
        F.col("repo").alias("event_type"),
        F.col("params.page").alias("page"),
        F.size("data").cast("long").alias("count"),
        "url",
    )


@query(
    "land_totals",
    """select event_type, cast(ceil(count(*) / 100.0) as bigint) as pages, count(*) as items
    from events group by event_type""",
)
def land_totals(spark, sf):
    pages = scan_envelopes(spark, land_event_pages(spark, sf), EVENT_SCHEMA, Scope(DAY))
    return landed_totals(pages, ["repo"]).withColumnRenamed("repo", "event_type")


@query(
    "page_plan",
    """with totals as (select user_id, event_type, count(*) as n from events group by 1, 2)
    select user_id, event_type, cast(unnest(generate_series(1, cast(ceil(n / 10.0) as bigint))) as bigint) as page
    from totals""",
)
def page_plan(spark, sf):
    keys = ["user_id", "event_type"]
    totals = count_pages(table(spark, sf, "events"), keys, page_size=10)
    return plan_pages(totals, keys).select(*keys, "page")


@query(
    "url_page_param",
    """select page_id, coalesce(nullif(regexp_extract(url, '^[^?#]*[?](?:[^#]*&)?page=([^&#]*)', 1), ''), '1') as page
    from pages""",
)
def url_page_param(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_param("url", "page", "1").alias("page"))


@query("paged_source", EVENTS_SQL)
def paged_source(spark, sf):
    """Responses as a paged remote would give them, their page numbers read from their own URLs, landed as
    received (variants), scanned and flattened."""
    with Scratch(spark) as scratch:
        records = event_records(spark, sf).withColumn("batch_ts", F.lit(RUN_TS))
        pages = page_envelopes(records, "events", scratch, F.lit(RUN_TS))
        responses = pages.select(
            "owner", "repo", F.lit(None).cast("string").alias("since"),
            url_param("url", "page", "1").cast("long").alias("page"), "url", "fetched_at",
            F.to_json("data").alias("body"),
        )
        root = Scratch(spark).path("bronze") + "/events"
        land(raw_envelopes(responses, "events", RUN_TS), root)
    return flatten_pages(scan_envelopes(spark, root, EVENT_SCHEMA, Scope(DAY)), EVENT_FIELDS)


@query(
    "entity_scope_filter",
    CUSTOMER_SQL.format(columns="r_name as owner, n_name as repo, c_custkey")
    + " where r_name = 'ASIA' and n_name = (select min(n_name) from nation join region on n_regionkey = r_regionkey"
    " where r_name = 'ASIA')",
)
def entity_scope_filter(spark, sf):
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    first = nation.filter("r_name = 'ASIA'").agg(F.min("n_name").alias("first"))
    customers = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    # The entity asked for is named ASIA/first wherever its nation is the first by name.
    asked = customers.join(first, F.col("n_name") == F.col("first"), "left")
    repo = F.when(F.col("first").isNotNull(), F.lit("first")).otherwise(F.col("n_name"))
    entities = asked.select(F.col("r_name").alias("owner"), repo.alias("repo"), F.col("n_name"), "c_custkey")
    return scope_entities(entities, "ASIA", "first").select("owner", F.col("n_name").alias("repo"), "c_custkey")


@query("parse_timestamps", "select event_id, ts from events")
def parse_timestamps(spark, sf):
    text = table(spark, sf, "events").select("event_id", iso_text("ts").alias("text"))
    return text.select("event_id", parse_ts("text").cast("timestamp_ntz").alias("ts"))


@query("snapshot_date", "select event_id, cast(ts as date) as snapshot_date from events")
def snapshot_day(spark, sf):
    return table(spark, sf, "events").select("event_id", snapshot_date(F.col("ts")).alias("snapshot_date"))
