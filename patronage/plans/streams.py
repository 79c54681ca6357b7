"""Streaming queries. Events derived from the tables arrive in two parts; every query is stopped in between and
goes on from its checkpoint, and the final state is returned, so the batch SQL checks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patronage.contracts import ACTIVATION, ORDER, PROFILE, Contract
from patronage.operators import joins as J
from patronage.operators import serving as V
from patronage.plans import batch as B
from patronage.plans import inputs as I
from patronage.plans.loose import _ORDER_FIELDS
from patronage.plans.registry import query
from patronage.plans.relations import given
from patronage.session import workspace
from patronage.sources import fs
from patronage.sources.events import append_records, as_records
from patronage.sources.lake import Lake
from patronage.streaming.pipeline import SILVER, Pipeline

Step = Callable[[], StreamingQuery]


def _events(spark: SparkSession, sf: str, spec: Contract, scale: int) -> DataFrame:
    if spec is ORDER:
        return I.order_events(spark, sf, scale)
    return I.profile_events(spark, sf) if spec is PROFILE else I.activation_events(spark, sf)


def new_pipeline(spark: SparkSession, name: str) -> Pipeline:
    root = workspace(spark, name)
    topics = {s.name: fs.make_dir(spark, f"{root}/topics/{s.name}") for s in (PROFILE, ORDER, ACTIVATION)}
    return Pipeline(spark, root, topics, fmt="parquet", buckets=16, compact_every=2)


def arrive_and_run(
    p: Pipeline, sf: str, specs: Sequence[Contract], stages: Sequence[Sequence[Step]], scale: int = 1
) -> None:
    """Append each half of the events (cut at one point of the common sequence), to all topics at once, then run the stages
    in turn; the queries of a stage run side by side."""
    events = {s.name: _events(p.spark, sf, s, scale) for s in specs}
    cut = next(iter(events.values())).agg(F.percentile_approx("source_seq", 0.5)).first()[0]
    for half in (F.col("source_seq") <= cut, F.col("source_seq") > cut):

        @inheritable_thread_target(p.spark)
        def append(spec: Contract) -> None:
            append_records(as_records(events[spec.name].where(half), spec.key), p.topics[spec.name], p.fmt)

        with ThreadPoolExecutor(len(specs)) as writers:
            list(writers.map(append, specs))
        for stage in stages:
            p.finish(*[step() for step in stage])


ALL = (ORDER, PROFILE, ACTIVATION)


def _to_bronze(p: Pipeline, specs: Sequence[Contract] = ALL) -> list[Step]:
    return [lambda s=s: p.run_bronze(s) for s in specs]


def _to_silver(p: Pipeline, specs: Sequence[Contract] = ALL) -> list[Step]:
    return [lambda n=n: p.run_silver(n) for n, (spec, _) in SILVER.items() if spec in specs]


_ORDERS_SQL = given("order_events") + f"SELECT source_seq, {_ORDER_FIELDS} FROM order_events"


@query("src_events_stream", _ORDERS_SQL)
def src_events_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "src_events_stream")
    target = f"{p.root}/out"
    arrive_and_run(p, sf, [ORDER], [[lambda: p.append_stream(p.events(ORDER), "events", target)]])
    return spark.read.parquet(target).select("source_seq", *_ORDER_FIELDS.split(", "))


@query("stream_resume", given("order_events") + """
SELECT COUNT(*) AS events, COUNT(DISTINCT order_id) AS orders, CAST(2 AS BIGINT) AS runs FROM order_events""")
def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written by two runs over one checkpoint, plus a third run that finds nothing new."""
    p = new_pipeline(spark, "stream_resume")
    target = f"{p.root}/out"

    def step() -> StreamingQuery:
        return p.append_stream(p.events(ORDER).withColumn("written_at", F.current_timestamp()), "events", target)

    arrive_and_run(p, sf, [ORDER], [[step]])
    p.finish(step())
    return spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("order_id").alias("orders"),
        F.count_distinct("written_at").alias("runs"),
    )


@query("bronze_append_stream", given("order_events") + f"""
SELECT order_id AS message_key, {_ORDER_FIELDS}, source_seq FROM order_events""")
def bronze_append_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "bronze")
    arrive_and_run(p, sf, [ORDER], [_to_bronze(p, [ORDER])])
    return spark.read.parquet(p.bronze_path(ORDER)).drop("items", "ingested_at")


@query("silver_upsert_stream", given("silver_customers") + f"SELECT {B._PROFILE_LIST} FROM silver_customers")
def silver_upsert_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "silver")
    arrive_and_run(p, sf, [PROFILE], [_to_bronze(p, [PROFILE]), _to_silver(p, [PROFILE])])
    rows = p.lake.read("silver", "customers").drop("ingested_at")
    return rows.withColumn("created_at", F.unix_millis("created_at"))


@query("gold_c360_stream", B.C360_SQL)
def gold_c360_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The whole lake path, topics to gold."""
    p = new_pipeline(spark, "gold")
    arrive_and_run(p, sf, ALL, [_to_bronze(p), _to_silver(p), [p.run_gold]])
    return V.with_last_order_ts(p.lake.read("gold", "c360").drop("updated_at"))


def run_gold_totals(spark: SparkSession, sf: str, name: str) -> Pipeline:
    """The lake path with gold kept by differences: both halves of the events, then orders that move."""
    p = new_pipeline(spark, name)
    facts = [lambda: p.run_facts("orders"), lambda: p.run_facts("activations")]
    steps = [_to_bronze(p), _to_silver(p), facts, [p.run_gold_totals]]
    arrive_and_run(p, sf, ALL, steps)
    append_records(as_records(I.moved_orders(spark, sf), ORDER.key), p.topics[ORDER.name], p.fmt)
    for stage in steps:
        p.finish(*[step() for step in stage])
    return p


@query("gold_totals_stream", B.C360_MOVED_SQL)
def gold_totals_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after orders moved to other customers, earlier times and other amounts."""
    p = run_gold_totals(spark, sf, "gold_totals")
    return V.with_last_order_ts(p.lake.read("gold", "c360").drop("updated_at"))


def after_each_gold_batch(
    spark: SparkSession, sf: str, name: str, steps: Sequence[Callable[[Pipeline], StreamingQuery]], scale: int = 1
) -> Pipeline:
    """Gold written twice, before and after the messages arrived, with the steps run after each write."""
    p = new_pipeline(spark, name)
    customers, orders = B.silver_customers_of(spark, sf), B.silver_orders_of(spark, sf, scale)
    for number, activations in enumerate((None, I.activation_events(spark, sf))):
        rows = J.build_c360(customers, orders, activations, unique_orders=True)
        p.lake.upsert_batch(rows.withColumn("updated_at", F.current_timestamp()), number, "gold", "c360")
        for step in steps:
            p.finish(step(p))
    return p


def _newest_messages(p: Pipeline, name: str) -> DataFrame:
    sent = p.spark.read.schema("key string, value string, source_seq bigint").json(p.published_path(name))
    return sent.groupBy("key").agg(F.max_by("value", "source_seq").alias("value"))


@query("publish_c360_stream", f"SELECT customer_id AS key, * FROM ({B.C360_SQL})")
def publish_c360_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The last message sent for each customer."""
    p = after_each_gold_batch(spark, sf, "publish", [Pipeline.run_publish_c360])
    return B.read_messages(_newest_messages(p, "c360"), B.MESSAGE_SCHEMA)


@query("publish_propensity_stream", B._propensity_sql(0.75, 0.25).replace("FROM consolidated", """
FROM (SELECT s.customer_id, p.email, p.lifecycle_stage, s.lifetime_value, s.order_count, s.delivered_messages, s.failed_messages
      FROM consolidated s LEFT JOIN (SELECT * FROM profile_events QUALIFY
      ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY source_seq DESC) = 1) p ON s.customer_id = p.customer_id)"""))
def publish_propensity_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = after_each_gold_batch(spark, sf, "propensity", [Pipeline.run_publish_propensity], B.SCORE_SCALE)
    schema = "customer_id string, email string, lifecycle_stage string, propensity double"
    return B.read_messages(_newest_messages(p, "propensity"), schema).drop("key")


@query("serving_stream", f"""SELECT *, CAST(NULL AS BIGINT) AS last_engagement_ts FROM (
SELECT customer_id, order_count, lifetime_value, last_order_ts, NULLIF(first_name, '') AS first_name, last_name, email,
       lifecycle_stage, is_active, delivered_messages, failed_messages FROM ({B.C360_SQL}))""")
def serving_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Serving rows merged from the published messages."""
    p = after_each_gold_batch(spark, sf, "serving", [Pipeline.run_publish_c360, Pipeline.run_serving])
    return p.lake.read("serving", "customers").drop("removed", "applied")


@query("src_lake_snapshot", given("silver_customers") + f"SELECT {B._PROFILE_LIST} FROM silver_customers")
def src_lake_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """First profiles written and compacted, updates written on top, then read at the latest version."""
    lake = Lake(spark, workspace(spark, "snapshot"), buckets=16)
    for number, events in enumerate((I.first_profiles(spark, sf), I.profile_updates(spark, sf))):
        rows = I.silver_form(events, "created_at").withColumn("ingested_at", F.current_timestamp())
        lake.upsert_batch(rows, number, "silver", "customers")
        if number == 0:
            lake.compact("silver", "customers")
    rows = lake.read("silver", "customers").drop("ingested_at")
    return rows.withColumn("created_at", F.unix_millis("created_at"))


@query("src_lake_changes", given("profile_events") + """
SELECT customer_id, CAST(0 AS BIGINT) AS batch, source_seq, is_active FROM first_profiles
UNION ALL
SELECT customer_id, 1, source_seq, is_active FROM profile_updates
QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY source_seq DESC) = 1""")
def src_lake_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The change stream of a keyed table: one row per key and batch."""
    p = new_pipeline(spark, "changes")
    target = f"{p.root}/out"
    for number, events in enumerate((I.first_profiles(spark, sf), I.profile_updates(spark, sf))):
        rows = I.silver_form(events, "created_at").withColumn("ingested_at", F.current_timestamp())
        p.lake.upsert_batch(rows, number, "silver", "customers")
        p.finish(p.append_stream(p.lake.read_changes("silver", "customers"), "copy", target))
    return spark.read.parquet(target).select("customer_id", "batch", "source_seq", "is_active")


@query("src_optional_activations", B.C360_NO_ACTIVATIONS_SQL)
def src_optional_activations(spark: SparkSession, sf: str) -> DataFrame:
    """The gold plan over a lake whose activations table nobody has written."""
    lake = Lake(spark, workspace(spark, "optional"), buckets=16)
    rows = J.build_c360(
        B.silver_customers_of(spark, sf), B.silver_orders_of(spark, sf), lake.read_or_empty("silver", "activations")
    )
    return V.with_last_order_ts(rows)


_STAGE_NOW = B._stage_sql("s.order_count", "s.lifetime_value", "COALESCE(a.delivered_messages, 0)", "COALESCE(a.failed_messages, 0)")


def run_serving_events(spark: SparkSession, sf: str, name: str) -> Pipeline:
    p = new_pipeline(spark, name)
    arrive_and_run(p, sf, [ORDER, ACTIVATION], [[lambda: p.run_serving(with_events=True)]], B.STAGE_SCALE)
    return p


@query("serving_events_stream", given("order_summary", "activation_summary", scale=B.STAGE_SCALE) + f"""
SELECT COALESCE(s.customer_id, a.customer_id) AS customer_id, COALESCE(s.order_count, 0) AS order_count,
       COALESCE(s.lifetime_value, 0.0) AS lifetime_value, s.last_order_ts, COALESCE(a.delivered_messages, 0) AS delivered_messages,
       COALESCE(a.failed_messages, 0) AS failed_messages, a.last_engagement_ts,
       CASE WHEN s.customer_id IS NULL THEN 'prospect' ELSE {_STAGE_NOW} END AS lifecycle_stage,
       CASE WHEN s.customer_id IS NOT NULL THEN TRUE END AS is_active
FROM order_summary s FULL OUTER JOIN activation_summary a ON s.customer_id = a.customer_id""")
def serving_events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Serving rows kept up to date from the events alone, before any gold message arrives."""
    p = run_serving_events(spark, sf, "serving_events")
    return p.lake.read("serving", "customers").drop("first_name", "last_name", "email", "removed", "applied")


@query("stage_transitions_stream", given("order_summary", "activation_summary", scale=B.STAGE_SCALE) + f"""
SELECT s.customer_id, {_STAGE_NOW} AS lifecycle_stage, TRUE AS is_active
FROM order_summary s LEFT JOIN activation_summary a ON s.customer_id = a.customer_id""")
def stage_transitions_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The last stage event of each customer; everybody starts as a prospect."""
    p = run_serving_events(spark, sf, "stages")
    return p.lake.read("live", "stage_events").select("customer_id", "lifecycle_stage", "is_active")


def recency_messages(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Serving rows as messages in two parts: all customers, every third with a much newer order; then these deleted, and
    most of them sent again as they are. After both, the rows stand as in the batch query, less those deleted for good."""
    rows = B.serving_of(spark, sf)
    number = F.regexp_extract("customer_id", "[0-9]+", 0).cast("bigint")
    newer = F.when(number % 3 == 0, F.coalesce("last_order_ts", F.lit(0)) + 10**12).otherwise(F.col("last_order_ts"))

    def records(messages: DataFrame, seq: int) -> DataFrame:
        return messages.select("key", "value", F.current_timestamp().alias("timestamp"), F.lit(seq).cast("bigint").alias("source_seq"))

    def sent(frame: DataFrame, seq: int) -> DataFrame:
        return records(V.to_message(frame, "customer_id", rows.columns), seq)

    gone = records(rows.where(number % 3 == 0).select(F.col("customer_id").alias("key"), F.lit(None).cast("string").alias("value")), 2)
    return sent(rows.withColumn("last_order_ts", newer), 1), gone.unionByName(sent(rows.where((number % 3 == 0) & (number % 4 != 0)), 3))


@query("recent_customers_indexed_stream", given("serving") + """
SELECT customer_id, order_count, lifetime_value, last_order_ts, NULLIF(first_name, '') AS first_name, last_name, email,
       lifecycle_stage, is_active, delivered_messages, failed_messages, CAST(NULL AS BIGINT) AS last_engagement_ts
FROM serving WHERE CAST(regexp_extract(customer_id, '[0-9]+') AS BIGINT) % 12 <> 0
ORDER BY COALESCE(last_order_ts, 0) DESC, customer_id DESC LIMIT 250""")
def recent_customers_indexed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The most recent customers from the recency index, after updates, deletes and returns."""
    p = new_pipeline(spark, "recent")
    p.keep_recent = 250
    for part in recency_messages(spark, sf):
        append_records(part, p.published_path("c360"))
        p.finish(p.run_serving())
    return p.recent_customers()


@query("lookup_served_stream", given("serving") + """
SELECT customer_id, order_count, lifetime_value, last_order_ts, NULLIF(first_name, '') AS first_name, last_name, email,
       lifecycle_stage, is_active, delivered_messages, failed_messages, CAST(NULL AS BIGINT) AS last_engagement_ts
FROM serving WHERE customer_id IN ('42', 'S-7')""")
def lookup_served_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two customers looked up in the written serving table, one with orders and one known by profile only."""
    p = new_pipeline(spark, "lookup")
    for part in recency_messages(spark, sf):
        append_records(part, p.published_path("c360"))
        p.finish(p.run_serving())
    return p.customer("42").unionByName(p.customer(" S-7 "))


# -- live path --------------------------------------------------------------------------------------------------


@query("order_summary_stream", given("order_summary") + "SELECT * FROM order_summary")
def order_summary_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "order_summary")
    arrive_and_run(p, sf, [ORDER], [[p.run_live_order_summary]])
    return p.lake.read("live", "order_summary")


@query("activation_summary_stream", given("activation_summary") + "SELECT * FROM activation_summary")
def activation_summary_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "activation_summary")
    arrive_and_run(p, sf, [ACTIVATION], [[p.run_live_activation_summary]])
    return p.lake.read("live", "activation_summary")


@query("asof_enrich_orders_stream", given("order_events", "profile_events") + f"""
, filled AS (
  SELECT customer_id, source_seq,
         LAST_VALUE(email IGNORE NULLS) OVER w AS email, LAST_VALUE(lifecycle_stage IGNORE NULLS) OVER w AS lifecycle_stage
  FROM profile_events WINDOW w AS (PARTITION BY customer_id ORDER BY source_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT o.source_seq, {B._ENRICHED}, p.email AS customer_email, p.lifecycle_stage
FROM order_events o ASOF LEFT JOIN filled p ON o.customer_id = p.customer_id AND o.source_seq >= p.source_seq""")
def asof_enrich_orders_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "live_orders")
    arrive_and_run(p, sf, [ORDER, PROFILE], [[p.run_live_orders]])
    return p.lake.read("live", "enriched_orders")


@query("live_c360_stream", given("serving") + f"SELECT {B._VIEW} FROM serving")
def live_c360_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "live_c360")
    arrive_and_run(p, sf, ALL, [[p.run_live_c360]])
    return p.lake.read("live", "c360")


def run_segments(spark: SparkSession, sf: str, name: str) -> Pipeline:
    p = new_pipeline(spark, name)
    stages = [
        [p.run_live_order_summary, p.run_live_profiles], [p.run_live_segment_source],
        [lambda: p.run_live_segments(now=F.lit(B.FIXED_NOW))],
    ]
    arrive_and_run(p, sf, [ORDER, PROFILE], stages, B.SEGMENT_SCALE)
    return p


@query("src_table_as_stream", given("order_summary", "profiles", scale=B.SEGMENT_SCALE) + """
SELECT s.customer_id, s.lifetime_value, s.order_count, s.last_order_ts, p.lifecycle_stage
FROM order_summary s LEFT JOIN profiles p ON s.customer_id = p.customer_id""")
def src_table_as_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The segment source as its consumers see it: the newest row of its change stream."""
    p = run_segments(spark, sf, "segment_source")
    target = f"{p.root}/out"
    p.finish(p.append_stream(p.lake.read_changes("live", "segment_source"), "copy", target))
    rows = spark.read.parquet(target)
    return B.K.latest_row(rows, ["customer_id"], ["batch"]).drop("batch")


@query("segments_stream", given("consolidated", scale=B.SEGMENT_SCALE) + f"""
SELECT customer_id,
       CASE WHEN lifetime_value >= 200 THEN 'vip' WHEN order_count >= 2 THEN 'growth'
            WHEN lifecycle_stage IS NULL THEN 'unknown' ELSE lifecycle_stage END AS segment,
       CAST(ROUND(CAST(lifetime_value / 200.0 + order_count * 0.1 AS DECIMAL(18,6)), 2) AS DOUBLE) AS score,
       CAST({B.FIXED_NOW} AS BIGINT) AS materialized_at
FROM consolidated""")
def segments_stream(spark: SparkSession, sf: str) -> DataFrame:
    p = run_segments(spark, sf, "segments")
    return p.lake.read("live", "segments")


@query("consolidated_stream", given("consolidated") + f"SELECT {B._SERVING_LIST} FROM consolidated")
def consolidated_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The consolidated table kept from the topics; profiles and messages arrive before and after the first order."""
    p = new_pipeline(spark, "consolidated")
    arrive_and_run(p, sf, ALL, [[p.run_live_consolidated]])
    return p.lake.read("live", "consolidated")


def _last_sent(p: Pipeline, name: str, schema: str) -> DataFrame:
    """The last message of a derived topic for each key."""
    return B.read_messages(_newest_messages(p, f"live_{name}"), schema)


@query("derived_consolidated_topic", given("consolidated") + f"SELECT customer_id AS key, {B._SERVING_LIST} FROM consolidated")
def derived_consolidated_topic(spark: SparkSession, sf: str) -> DataFrame:
    p = new_pipeline(spark, "derived_consolidated")
    arrive_and_run(p, sf, ALL, [[p.run_live_consolidated], [lambda: p.run_publish_live("consolidated")]])
    return _last_sent(p, "consolidated", (
        "customer_id string, order_count bigint, lifetime_value double, last_order_ts bigint, first_name string, last_name string, "
        "email string, lifecycle_stage string, is_active boolean, delivered_messages bigint, failed_messages bigint, last_engagement_ts bigint"
    ))


@query("derived_enriched_topic", given("order_events", "profile_events") + f"""
, filled AS (
  SELECT customer_id, source_seq,
         LAST_VALUE(email IGNORE NULLS) OVER w AS email, LAST_VALUE(lifecycle_stage IGNORE NULLS) OVER w AS lifecycle_stage
  FROM profile_events WINDOW w AS (PARTITION BY customer_id ORDER BY source_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT o.customer_id AS key, {B._ENRICHED}, p.email AS customer_email, p.lifecycle_stage
FROM (SELECT * FROM order_events QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY source_seq DESC) = 1) o
ASOF LEFT JOIN filled p ON o.customer_id = p.customer_id AND o.source_seq >= p.source_seq""")
def derived_enriched_topic(spark: SparkSession, sf: str) -> DataFrame:
    """The last enriched order sent for each customer."""
    p = new_pipeline(spark, "derived_enriched")
    arrive_and_run(p, sf, [ORDER, PROFILE], [[p.run_live_orders], [lambda: p.run_publish_live("enriched_orders")]])
    return _last_sent(p, "enriched_orders", (
        "order_id string, customer_id string, order_total double, order_channel string, order_placed_at bigint, customer_email string, "
        "lifecycle_stage string"
    ))


@query("derived_segment_topics", given("consolidated", scale=B.SEGMENT_SCALE) + f"""
SELECT customer_id AS key, lifetime_value, order_count, last_order_ts, lifecycle_stage,
       CASE WHEN lifetime_value >= 200 THEN 'vip' WHEN order_count >= 2 THEN 'growth'
            WHEN lifecycle_stage IS NULL THEN 'unknown' ELSE lifecycle_stage END AS segment,
       CAST(ROUND(CAST(lifetime_value / 200.0 + order_count * 0.1 AS DECIMAL(18,6)), 2) AS DOUBLE) AS score,
       CAST({B.FIXED_NOW} AS BIGINT) AS materialized_at
FROM consolidated""")
def derived_segment_topics(spark: SparkSession, sf: str) -> DataFrame:
    """The last messages of the segment source and of the segments, side by side."""
    p = run_segments(spark, sf, "derived_segments")
    p.finish(p.run_publish_live("segment_source"), p.run_publish_live("segments"))
    source = _last_sent(p, "segment_source", "lifetime_value double, order_count bigint, last_order_ts bigint, lifecycle_stage string")
    return source.join(_last_sent(p, "segments", "segment string, score double, materialized_at bigint"), "key")
