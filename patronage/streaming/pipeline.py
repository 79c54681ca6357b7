"""The customer-360 pipeline as checkpointed streaming queries.

Lake path:  topics -> bronze -> silver (keyed upsert) -> gold c360 -> published messages -> serving rows.
Live path:  topics -> as-of enriched orders, order and message summaries, consolidated rows, segments.

Every hop either uses the file sink or a keyed batch write whose batch id is recorded, so a replayed batch
changes nothing. Queries default to `availableNow`: they take in what is there and stop, and a later run goes on
from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from patronage.contracts import ACTIVATION, ORDER, PROFILE, PROFILE_COLUMNS, Contract
from patronage.operators import joins as J
from patronage.operators import metrics as M
from patronage.operators import recency as R
from patronage.operators import retract as D
from patronage.operators import segments as S
from patronage.operators import serving as V
from patronage.operators.curate import curate_activations, curate_customers, curate_orders
from patronage.operators.decode import decode_payload, flatten_payload, split_valid
from patronage.operators.keyed import fold_serving_batch, merge_column, newest_value
from patronage.operators.normalise import SERVING_COLUMNS, normalise_rows
from patronage.operators.skew import hot_keys, spread_join
from patronage.session import prefer_rocksdb
from patronage.sources import fs
from patronage.sources.events import RECORD, read_events
from patronage.sources.lake import Lake, Scope

Batch = Callable[[DataFrame, int], None]
KNOWN_BEFORE = -1  # sequence number given to stored profiles: before every event of a batch
FACTS = {"orders": ("order_id", ("customer_id", "order_total", "placed_at")), "activations": ("activation_id", ("customer_id", "status"))}
SILVER = {"customers": (PROFILE, curate_customers), "orders": (ORDER, curate_orders), "activations": (ACTIVATION, curate_activations)}


def bronze_schema(spec: Contract) -> T.StructType:
    return T.StructType([
        T.StructField("message_key", T.StringType()), *spec.schema.fields,
        T.StructField("ingested_at", T.TimestampType()), T.StructField("source_seq", T.LongType()),
    ])


@dataclass
class Pipeline:
    """`topics` maps contract names to a path or topic; `options` go to the event source and `hop_options` to the file
    streams between the hops. Set their rate limits (`maxOffsetsPerTrigger`, `maxBytesPerTrigger`, `maxFilesPerTrigger`)
    so that a backlog is taken in batches the cluster can hold. `keep_recent` is how many of the newest customers readers may
    ask the recency index for; 0 keeps none."""

    spark: SparkSession
    root: str
    topics: dict[str, str]
    fmt: str = "json"
    record: T.StructType = field(default_factory=lambda: RECORD)
    encoding: str = "json"
    options: dict[str, str] = field(default_factory=dict)
    hop_options: dict[str, str] = field(default_factory=dict)
    trigger: dict[str, object] = field(default_factory=lambda: {"availableNow": True})
    buckets: int = 64
    compact_every: int = 16
    keep_recent: int = 0

    def __post_init__(self) -> None:
        prefer_rocksdb(self.spark)
        self.lake = Lake(self.spark, f"{self.root}/lake", self.buckets)

    # -- plumbing -------------------------------------------------------------------------------------------

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def bronze_path(self, spec: Contract) -> str:
        return f"{self.root}/bronze/{spec.name}"

    def published_path(self, name: str) -> str:
        return f"{self.root}/published/{name}"

    def each_batch(
        self, stream: DataFrame, name: str, work: Batch, mode: str = "append", reread: bool = True
    ) -> StreamingQuery:
        """`reread` keeps the batch in memory or on disk, for work that reads it more than once."""

        def call(batch: DataFrame, batch_id: int) -> None:
            # streaming sessions switch adaptive planning off; the batch jobs below want it
            batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
            if not reread:
                work(batch, batch_id)
                return
            kept = batch.persist()
            try:
                work(kept, batch_id)
            finally:
                kept.unpersist()

        writer = stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", self._checkpoint(name))
        return writer.foreachBatch(call).trigger(**self.trigger).start()

    def upsert_stream(self, stream: DataFrame, layer: str, name: str, mode: str = "append") -> StreamingQuery:
        def write(batch: DataFrame, batch_id: int) -> None:
            if not self._upsert(batch, batch_id, layer, name):
                # a replayed batch is not written again, but a stateful query must still bring its state forward
                batch.write.format("noop").mode("overwrite").save()

        return self.each_batch(stream, f"{layer}_{name}", write, mode, reread=False)

    def _upsert(self, df: DataFrame, batch_id: int, layer: str, name: str) -> bool:
        written = self.lake.upsert_batch(df, batch_id, layer, name, self._writer(df))
        if written and batch_id % self.compact_every == self.compact_every - 1:
            self.lake.compact(layer, name)
        return written

    @staticmethod
    def _writer(df: DataFrame) -> str:
        """The id of the running query: batch numbers start again with every new checkpoint."""
        return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""

    def append_stream(self, stream: DataFrame, name: str, path: str, fmt: str = "parquet") -> StreamingQuery:
        writer = stream.writeStream.queryName(name).outputMode("append").format(fmt)
        return writer.option("checkpointLocation", self._checkpoint(name)).trigger(**self.trigger).start(path)

    def finish(self, *queries: StreamingQuery) -> None:
        for query in queries:
            query.awaitTermination()

    def _changes(self, layer: str, name: str) -> DataFrame:
        return self.lake.read_changes(layer, name, **self.hop_options)

    # -- events ---------------------------------------------------------------------------------------------

    def decoded(self, spec: Contract) -> DataFrame:
        raw = read_events(self.spark, self.topics[spec.name], self.fmt, schema=self.record, options=self.options)
        return decode_payload(raw, spec, self.encoding)

    def events(self, spec: Contract) -> DataFrame:
        """Readable events as a streaming frame of the contract's columns with `source_seq`."""
        good, _ = split_valid(self.decoded(spec), spec)
        key = F.coalesce(spec.key, "message_key").alias(spec.key)
        flat = flatten_payload(good)
        return flat.select(*[key if f.name == spec.key else F.col(f.name) for f in spec.schema.fields], "source_seq")

    # -- lake path ------------------------------------------------------------------------------------------

    def run_bronze(self, spec: Contract) -> StreamingQuery:
        good, _ = split_valid(self.decoded(spec), spec)
        return self.append_stream(flatten_payload(good), f"bronze_{spec.name}", self.bronze_path(spec))

    def run_quarantine(self, spec: Contract) -> StreamingQuery:
        _, bad = split_valid(self.decoded(spec), spec)
        return self.append_stream(bad, f"quarantine_{spec.name}", f"{self.root}/quarantine/{spec.name}")

    def run_silver(self, name: str) -> StreamingQuery:
        spec, curate = SILVER[name]
        source = fs.make_dir(self.spark, self.bronze_path(spec))
        bronze = self.spark.readStream.schema(bronze_schema(spec)).options(**self.hop_options).parquet(source)
        return self.upsert_stream(curate(bronze), "silver", name)

    def run_gold(self, follow_moves: bool = True) -> StreamingQuery:
        """One query over all three change streams. Only customers a batch touches are worked out again.

        `follow_moves` also refreshes the former customer of an order or message that was re-sent under another
        one; it scans two columns of the change history and can be switched off where that cannot happen.
        """
        changed = J.merge_streams(
            customers=self._changes("silver", "customers").select("customer_id"),
            orders=self._changes("silver", "orders").select("customer_id", "order_id", "batch"),
            activations=self._changes("silver", "activations").select("customer_id", "activation_id", "batch"),
        )

        def refresh(batch: DataFrame, batch_id: int) -> None:
            keys = batch.select("customer_id")
            if follow_moves:
                # a change batch holds a key once, so the former owners stand in batches before the newest one here
                newest = {r["kind"]: r["newest"] for r in batch.groupBy("kind").agg(F.max("batch").alias("newest")).collect()}
                for name, key in (("orders", "order_id"), ("activations", "activation_id")):
                    if newest.get(name):
                        ids = batch.where(F.col(key).isNotNull()).select(key)
                        owners = self.lake.versions("silver", name, newest[name]).select(key, "customer_id")
                        keys = keys.unionByName(owners.join(ids, key, "left_semi").select("customer_id"))
            keys = keys.where(F.col("customer_id").isNotNull()).distinct().persist()
            try:
                within = self.lake.scope(keys)
                # a customer whose last order went to another one has a gold row but gets none now
                before = self.lake.read_or_empty("gold", "c360", within).select("customer_id")
                rows = self.gold_rows(within).withColumn("_built", F.lit(True)).join(before, "customer_id", "full_outer")
                self._upsert(rows.withColumn("removed", F.col("_built").isNull()), batch_id, "gold", "c360")
            finally:
                keys.unpersist()

        return self.each_batch(changed, "gold_c360", refresh, reread=False)

    def gold_rows(self, within: Scope | None = None) -> DataFrame:
        customers, orders, activations = [
            self.lake.read_or_empty("silver", name, within, exact=False) for name in ("customers", "orders", "activations")
        ]
        rows = J.build_c360(customers, orders, activations, unique_orders=True)
        if within is not None and within.large:
            # after the aggregates, whose shuffle it shares and which a hot customer cannot skew
            rows = rows.join(within.keys, "customer_id", "left_semi")
        return rows.withColumn("updated_at", F.current_timestamp())

    def run_facts(self, name: str) -> StreamingQuery:
        """Silver orders or activations as changes with the row before: what `run_gold_totals` takes back and adds."""
        key, columns = FACTS[name]
        table = f"{name}_facts"

        def note(batch: DataFrame, batch_id: int) -> None:
            stored = self.lake.read_or_empty("gold", table, self.lake.scope(batch.select(key), distinct=True), exact=False)
            self._upsert(D.with_images(stored, batch, key, columns), batch_id, "gold", table)

        changes = self._changes("silver", name).select(key, *columns, "source_seq", "batch")
        return self.each_batch(changes, table, note, reread=False)

    def run_gold_totals(self) -> StreamingQuery:
        """Gold by differences, in place of `run_gold`: totals per customer take back what changed orders and messages
        counted and add what they count now; no history and no other order is read, but for customers whose newest order
        was taken back. A gold row is written only where it differs from the one that is there.

        The totals carry the batch they were brought forward by, in the same write, so a batch that comes again counts
        once. The gold rows follow from the totals, so writing them again changes nothing."""
        streams = {
            kind: D.signed(self._changes("gold", f"{name}_facts"), FACTS[name][1])
            for kind, name in (("order", "orders"), ("activation", "activations"))
        }
        merged = J.merge_streams(**streams, profile=self._changes("silver", "customers").select("customer_id"))

        def refresh(batch: DataFrame, batch_id: int) -> None:
            read = self.lake.read_or_empty
            changes = D.differences(batch).persist()
            within = self.lake.scope(changes.select("customer_id"))
            totals = D.apply_differences(read("gold", "totals", within), changes, f"{self._writer(batch)}-{batch_id}").persist()
            try:
                lost = self.lake.scope(totals.where("_lost").select("customer_id"))
                whole = D.with_newest_orders(totals, read("silver", "orders", lost, exact=False)) if lost.count else totals
                self._upsert(whole, batch_id, "gold", "totals")
                rows = D.c360_of_totals(read("gold", "totals", within), read("silver", "customers", within))
                changed = D.changed_rows(read("gold", "c360", within), rows, "customer_id")
                self._upsert(changed.withColumn("updated_at", F.current_timestamp()), batch_id, "gold", "c360")
            finally:
                changes.unpersist()
                totals.unpersist()

        return self.each_batch(merged, "gold_totals", refresh, reread=False)

    # -- publishing -----------------------------------------------------------------------------------------

    def publish(self, messages: DataFrame, name: str, fmt: str = "json", topic: str | None = None) -> StreamingQuery:
        """Messages to a directory, or to Kafka when `topic` and its connector are there."""
        if topic is None:
            return self.append_stream(messages, f"publish_{name}", self.published_path(name), fmt)
        writer = messages.select("key", "value").writeStream.format("kafka").options(**self.options)
        writer = writer.option("topic", topic).option("checkpointLocation", self._checkpoint(f"publish_{name}"))
        return writer.outputMode("append").trigger(**self.trigger).start()

    def _message_stream(self, rows: DataFrame, columns: tuple[str, ...], removed: Column | None = None) -> DataFrame:
        value = F.to_json(F.struct(*columns))
        if removed is not None:
            value = F.when(~F.coalesce(removed, F.lit(False)), value)
        return rows.select(
            F.col("customer_id").cast("string").alias("key"), value.alias("value"),
            F.current_timestamp().alias("timestamp"), F.col("batch").alias("source_seq"),
        )

    def run_publish_c360(self, topic: str | None = None) -> StreamingQuery:
        """A message for every changed gold row; a null value for a removed one, which deletes it in serving."""
        rows = V.with_last_order_ts(self._changes("gold", "c360"))
        messages = self._message_stream(rows, V.C360_MESSAGE, F.col("removed"))
        return self.publish(messages, "c360", topic=topic)

    def run_publish_propensity(self, topic: str | None = None) -> StreamingQuery:
        gold = self._changes("gold", "c360").where(~F.coalesce("removed", F.lit(False)))
        scored = gold.select(
            "customer_id", "email", "lifecycle_stage", S.propensity_column().alias("propensity"), "batch",
            F.current_timestamp().alias("scored_at"),
        )
        return self.publish(self._message_stream(scored, V.PROPENSITY_MESSAGE), "propensity", topic=topic)

    # -- serving --------------------------------------------------------------------------------------------

    def run_serving(self, source: str | None = None, with_events: bool = False) -> StreamingQuery:
        """Serving rows from the published messages. `with_events` also folds in order and message events as they
        arrive, ahead of the lake path, and writes a stage event for every customer whose stage that changes.

        A row carries the query and batch that wrote it, in the same write as what the batch folded in: a batch that is
        sent again after a crash, wherever that came, finds them and folds nothing in twice."""
        path = source or fs.make_dir(self.spark, self.published_path("c360"))
        messages = read_events(self.spark, path, "json", schema=RECORD, options=self.hop_options).drop("timestamp")
        streams = {"message": messages.withColumn("customer_id", F.col("key"))}
        if with_events:
            streams["order"] = self.events(ORDER).select("source_seq", "customer_id", "order_total", "placed_at")
            streams["activation"] = self.events(ACTIVATION).select("source_seq", "customer_id", "status", "delivered_at")

        def merge(batch: DataFrame, batch_id: int) -> None:
            within = self.lake.scope(batch.select("customer_id"))
            current = self.lake.read_or_empty("serving", "customers", within).drop("removed")
            applied = f"{self._writer(batch)}-{batch_id}"
            if with_events:
                before, orders, done = current, batch.where("kind = 'order'"), F.col("applied") == applied
                current = M.apply_engagements(M.apply_orders(before, orders, done), batch.where("kind = 'activation'"), done)
                # before the rows: a replay after a crash in between still finds the stage the customer had
                self._upsert(S.stage_transitions(before, current), batch_id, "live", "stage_events")
            sent = batch.where("kind = 'message'")
            rows = serving_batch(current, sent, hot_keys(sent, "key"))
            if with_events:
                others = current.join(rows.select("customer_id"), "customer_id", "left_anti").drop("applied")
                rows = rows.unionByName(others.withColumn("removed", F.lit(False)))
            self._upsert(rows.withColumn("applied", F.lit(applied)), batch_id, "serving", "customers")
            if self.keep_recent:
                self._keep_recent(within, batch_id)

        return self.each_batch(J.merge_streams(**streams), "serving_customers", merge)

    def _keep_recent(self, within: Scope, batch_id: int) -> None:
        """Bring the recency index forward by the customers of a batch. It is worked out from the rows as they stand, so
        doing it again changes nothing."""
        keep, slots = 2 * self.keep_recent, self.buckets
        index = self.lake.read_or_empty("serving", "recent")
        merged = R.merge_recent(index, within.keys, self.lake.read("serving", "customers", within), slots, keep).persist()
        try:
            short = R.short_slots(merged, self.keep_recent)
            whole = R.refill(merged, self.lake.read("serving", "customers"), short, slots, keep) if short else merged
            self._upsert(whole, batch_id, "serving", "recent")
        finally:
            merged.unpersist()

    def recent_customers(self, n: int | None = None) -> DataFrame:
        """The n customers with the newest orders, by id, from the recency index; n may be up to keep_recent."""
        n = self.keep_recent if n is None else n
        if n > self.keep_recent:
            raise ValueError(f"the index keeps {self.keep_recent} customers")
        return R.recent_from_index(self.lake.read_or_empty("serving", "recent"), n)

    def customer(self, customer_id: str) -> DataFrame:
        """The serving row of one customer, without looking through the others."""
        return self.lake.lookup("serving", "customers", customer_id).drop("applied")

    def run_publish_stages(self, topic: str | None = None) -> StreamingQuery:
        """Stage events as profile messages."""
        rows = self._changes("live", "stage_events")
        return self.publish(self._message_stream(rows, tuple(PROFILE.schema.fieldNames())), "stages", topic=topic)

    # -- live path ------------------------------------------------------------------------------------------

    def run_live_orders(self) -> StreamingQuery:
        """As-of enrichment and the profile table it needs, in arrival order across both topics."""
        merged = J.merge_streams(
            profile=self.events(PROFILE), order=self.events(ORDER).drop("items", "currency")
        )

        def enrich(batch: DataFrame, batch_id: int) -> None:
            known = self.lake.read_or_empty("live", "profile", self.lake.scope(batch.select("customer_id")))
            profiles = batch.where("kind = 'profile'").select("source_seq", "customer_id", *PROFILE_COLUMNS)
            versions = known.withColumn("source_seq", F.lit(KNOWN_BEFORE).cast("bigint")).unionByName(profiles)
            orders = batch.where("kind = 'order'")
            # orders first: if the run dies in between, the replay skips them and still sees the old profiles
            self._upsert(J.enrich_orders_asof(orders, versions), batch_id, "live", "enriched_orders")
            self._upsert(newest_profiles(versions), batch_id, "live", "profile")

        return self.each_batch(merged, "live_orders", enrich)

    def run_live_profiles(self) -> StreamingQuery:
        """The profile table alone, for consumers that need no enriched orders. `run_live_orders` keeps the same table: run
        one of the two."""

        def keep(batch: DataFrame, batch_id: int) -> None:
            # one row per customer before the stored rows are looked up, so a batch is read once
            new = newest_profiles(batch.select("source_seq", "customer_id", *PROFILE_COLUMNS)).persist()
            try:
                within = self.lake.scope(new.select("customer_id"), distinct=True)
                known = self.lake.read_or_empty("live", "profile", within)
                joined = new.alias("new").join(known.alias("old"), "customer_id", "left")
                rows = joined.select("customer_id", *[F.coalesce(f"new.{c}", f"old.{c}").alias(c) for c in PROFILE_COLUMNS])
                self._upsert(rows, batch_id, "live", "profile")
            finally:
                new.unpersist()

        return self.each_batch(self.events(PROFILE), "live_profiles", keep, reread=False)

    def run_live_order_summary(self) -> StreamingQuery:
        orders = self.events(ORDER).withColumnRenamed("placed_at", "order_placed_at")
        return self.upsert_stream(M.order_summary(orders), "live", "order_summary", "update")

    def run_live_activation_summary(self) -> StreamingQuery:
        return self.upsert_stream(M.activation_summary(self.events(ACTIVATION)), "live", "activation_summary", "update")

    def run_live_c360(self) -> StreamingQuery:
        """Customer 360 from the topics with one state row per customer: work per batch grows with the batch only."""
        merged = J.merge_streams(
            profile=self.events(PROFILE), order=self.events(ORDER).drop("items", "currency", "channel"),
            activation=self.events(ACTIVATION).drop("channel", "order_id"),
        )
        return self.upsert_stream(J.conditional_c360(merged), "live", "c360", "update")

    def run_live_consolidated(self) -> StreamingQuery:
        """The consolidated table, kept: customers appear with their first order and again with whatever changes."""
        merged = J.merge_streams(
            profile=self.events(PROFILE), order=self.events(ORDER).drop("items", "currency", "channel"),
            activation=self.events(ACTIVATION).drop("channel", "order_id"),
        )
        return self.upsert_stream(J.consolidated_state(merged), "live", "consolidated", "update")

    def run_publish_live(self, name: str, topic: str | None = None) -> StreamingQuery:
        """A derived topic: every changed row of a live table as a JSON message, keyed by customer. Rows of a table are
        ordered by their own sequence number where they have one, else by the table's batch."""
        rows = self._changes("live", name)
        columns = tuple(c for c in rows.columns if c not in ("batch", "source_seq"))
        seq = "source_seq" if "source_seq" in rows.columns else "batch"
        messages = self._message_stream(rows.withColumn("batch", F.col(seq)), columns)
        return self.publish(messages, f"live_{name}", topic=topic)

    def _changed_customers(self, *names: str) -> DataFrame:
        return J.merge_streams(**{n: self._changes("live", n).select("customer_id") for n in names})

    def run_live_segment_source(self) -> StreamingQuery:
        """A change on either side of the join emits the customer again, unless the row stays the same."""

        def join(batch: DataFrame, batch_id: int) -> None:
            within, read = self.lake.scope(batch.select("customer_id")), self.lake.read_or_empty
            rows = J.segment_source(read("live", "order_summary", within), read("live", "profile", within))
            rows = D.changed_rows(read("live", "segment_source", within), rows, "customer_id")
            self._upsert(rows, batch_id, "live", "segment_source")

        return self.each_batch(self._changed_customers("order_summary", "profile"), "live_segment_source", join)

    def run_live_segments(self, now: Column | None = None) -> StreamingQuery:
        """Segment events from the change stream of the segment source."""
        events = S.materialise_segments(self._changes("live", "segment_source"), now)
        return self.upsert_stream(events, "live", "segments")


def newest_profiles(versions: DataFrame) -> DataFrame:
    """The newest value of each column per customer, of customers with an event newer than what is stored."""
    state = versions.groupBy("customer_id").agg(
        *[newest_value(c, "source_seq").alias(c) for c in PROFILE_COLUMNS], F.max("source_seq").alias("_newest")
    )
    return state.where(F.col("_newest") > KNOWN_BEFORE)


def serving_batch(current: DataFrame, batch: DataFrame, hot: Sequence[str] = ()) -> DataFrame:
    """Rows to write for a batch of (key, value, source_seq) messages: deletes take effect where they stand in
    the order of messages, updates after them start from an empty row."""
    cut = batch.where(F.col("value").isNull()).groupBy(F.col("key").alias("customer_id")).agg(F.max("source_seq").alias("_cut"))
    rows = normalise_rows(batch.select("key", "value", "source_seq")).drop("last_order_at")
    rows = rows.where(F.coalesce(F.col("customer_id"), F.lit("")) != "")
    live = spread_join(rows, cut, "customer_id", "left", hot, spread_on="source_seq")
    live = live.where(F.col("_cut").isNull() | (F.col("source_seq") > F.col("_cut"))).drop("_cut")
    # one row per touched key: what is left of its updates, its last delete, and the stored row
    joined = (
        fold_serving_batch(live).withColumn("_updated", F.lit(True)).alias("new")
        .join(cut.alias("cut"), "customer_id", "full_outer")
        .join(current.alias("old"), "customer_id", "left")
    )
    kept = F.col("_cut").isNull()
    columns = [
        merge_column(c, F.when(kept, F.col(f"old.{c}")), F.col(f"new.{c}")) for c in SERVING_COLUMNS if c != "customer_id"
    ]
    return joined.select("customer_id", *columns, F.col("_updated").isNull().alias("removed"))
