"""Registry of the queries and the frames several of them share."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvermill.functions.columns import iso_text
from silvermill.session import Scratch, derived_session
from silvermill.sinks.landing import land, page_envelopes

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

RUN_TS = datetime(2026, 4, 6, 2, 0, tzinfo=timezone.utc)
DAY = "2026-04-06"

ENVELOPE = "owner string, repo string, fetched_at string, batch_timestamp string, endpoint string, url string, count bigint"
EVENT_RECORD = "struct<event_id bigint, ts string, user_id bigint, event_type string, value double, props string>"
EVENT_SCHEMA = f"{ENVELOPE}, data array<{EVENT_RECORD}>"
EVENT_FIELDS = (
    "record.event_id as event_id",
    "cast(to_timestamp(record.ts) as timestamp_ntz) as ts",
    "record.user_id as user_id",
    "record.event_type as event_type",
    "record.value as value",
)


def query(name: str, sql: str | None = None):
    def register(run):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(derived_session(spark), sf_dir)

        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def event_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw records of the entity (shop, event type)."""
    return table(spark, sf, "events").select(
        F.lit("shop").alias("owner"),
        F.col("event_type").alias("repo"),
        "event_id",
        iso_text("ts").alias("ts"),
        "user_id",
        "event_type",
        "value",
        "props",
    )


def land_event_pages(spark: SparkSession, sf: str, daily: bool = False) -> str:
    """Land all events in pages; one batch, or one per day at 02:00 of the day."""
    batch = F.date_trunc("day", F.to_timestamp("ts")) + F.expr("interval 2 hours")
    records = event_records(spark, sf).withColumn("batch_ts", batch if daily else F.lit(RUN_TS))
    root = Scratch(spark).path("bronze") + "/events"
    with Scratch(spark) as scratch:
        land(page_envelopes(records, "events", scratch, F.lit(RUN_TS)), root)
    return root


def customer_records(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as nested snapshot bodies of the entity (region, customer)."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("r_name").alias("owner"),
        F.col("c_name").alias("repo"),
        F.col("c_custkey").alias("id"),
        F.concat_ws("/", "r_name", "c_name").alias("full_name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.struct(
            F.col("n_nationkey").cast("long").alias("id"),
            F.col("n_name").alias("name"),
            F.struct(F.col("r_name").alias("name")).alias("region"),
        ).alias("home"),
    )


CUSTOMER_SCHEMA = """owner string, repo string, fetched_at string, batch_timestamp string, endpoint string,
data struct<id bigint, full_name string, balance double, segment string,
  home struct<id bigint, name string, region struct<name string>>>"""

CUSTOMER_SQL = """select {columns}
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
