"""The social tables, derived from the star-schema Parquet tables of a scale folder."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import json_object, uuid_text
from .tables import scan


@dataclass
class SocialTables:
    """Each property is an unevaluated DataFrame over whole input tables."""

    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        return scan(self.spark, f"{self.folder}/{name}.parquet")

    def _user_total(self):
        return self.raw("customer").select(F.count(F.lit(1))).scalar()

    @cached_property
    def users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("full_name"))

    @cached_property
    def user_counters(self) -> DataFrame:
        """Users with a stored post counter."""
        return self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"),
            F.floor(F.abs("c_acctbal") / 1000).cast("long").alias("post_count"))

    @cached_property
    def accounts(self) -> DataFrame:
        """A smaller registry of users, so that some requests name an unknown one."""
        stored = F.floor(F.abs("s_acctbal")).cast("long")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("username"),
            stored.alias("follower_count"), (stored % 7).alias("following_count"))

    @cached_property
    def posts(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("post_id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderpriority").alias("location"),
            F.floor(F.col("o_totalprice") / 100).cast("long").alias("like_count"),
            F.col("o_orderdate").alias("created_at"))

    @cached_property
    def like_candidates(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("post_id"),
            (F.col("l_partkey") % self._user_total()).alias("user_id"),
            F.col("l_shipdate").alias("created_at"))

    @cached_property
    def post_likes(self) -> DataFrame:
        newest = self.like_candidates.groupBy("post_id", "user_id").agg(
            F.max("created_at").alias("created_at"))
        return newest.select(
            (F.col("post_id") * self._user_total() + F.col("user_id")).alias("like_id"),
            "post_id", "user_id", "created_at")

    @cached_property
    def _event_k(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("long")
        return self.raw("events").withColumn("k", k)

    @cached_property
    def comments(self) -> DataFrame:
        return self._event_k.select(
            F.col("event_id").alias("comment_id"), F.col("k").alias("post_id"), "user_id",
            F.col("event_type").alias("content"), F.col("ts").alias("created_at"))

    @cached_property
    def follow_requests(self) -> DataFrame:
        return self._event_k.select(
            F.col("event_id").alias("request_id"), F.col("user_id").alias("follower_id"),
            F.col("k").alias("following_id"), F.col("ts").alias("at"))

    @cached_property
    def failing_requests(self) -> DataFrame:
        """The follow requests, with one kind of event marked to fail."""
        return self._event_k.select(
            F.col("event_id").alias("request_id"), F.col("user_id").alias("follower_id"),
            F.col("k").alias("following_id"), F.col("ts").alias("at"),
            (F.col("event_type") == "error").alias("simulate_error"))

    @cached_property
    def like_requests(self) -> DataFrame:
        return self._event_k.select(
            F.col("event_id").alias("request_id"), F.col("k").alias("post_id"), "user_id",
            F.col("ts").alias("at"))

    @cached_property
    def follow_candidates(self) -> DataFrame:
        return self.follow_requests.select(
            "follower_id", "following_id", F.col("at").alias("created_at"))

    @cached_property
    def followers(self) -> DataFrame:
        return (self.follow_candidates.filter(F.col("follower_id") != F.col("following_id"))
                .groupBy("follower_id", "following_id").agg(F.max("created_at").alias("created_at")))

    @cached_property
    def stored_edges(self) -> DataFrame:
        """Follower edges already stored before a request batch arrives."""
        return (self.raw("lineitem").select(
            F.col("l_suppkey").alias("follower_id"),
            (F.col("l_partkey") % self._user_total()).alias("following_id"),
            F.col("l_shipdate").alias("created_at"))
            .groupBy("follower_id", "following_id").agg(F.max("created_at").alias("created_at")))

    @cached_property
    def event_outbox(self) -> DataFrame:
        payload = json_object(
            post_id=F.col("k"), user_id=F.col("user_id"), content=F.col("event_type"),
            created_at=F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        return self._event_k.select(
            "event_id", "event_type", F.col("k").alias("aggregate_id"), payload.alias("payload"),
            (F.col("event_type") == "view").alias("processed"), F.col("ts").alias("created_at"))

    @cached_property
    def outbox_with_bad_payloads(self) -> DataFrame:
        """The outbox with truncated payloads for one event type and null ones for another."""
        cut = F.expr("substring(payload, 1, length(payload) - 3)")
        return self.event_outbox.withColumn(
            "payload", F.when(F.col("event_type") == "error", cut)
            .when(F.col("event_type") != "signup", F.col("payload")))

    @cached_property
    def read_model(self) -> DataFrame:
        """A read model built from earlier events."""
        return self.posts.select(
            "post_id", "user_id", F.col("location").alias("content"), "created_at",
            F.col("created_at").alias("indexed_at"), F.lit(-1).cast("long").alias("first_event_id"),
            F.lit(-1).cast("long").alias("last_event_id"))

    @cached_property
    def samples(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_type").alias("group"), F.col("event_id").alias("seq"),
            F.col("value").alias("latency_ms"),
            ((F.col("event_type") != "error") | (F.col("value") < 300)).alias("ok"))

    @cached_property
    def mode_runs(self) -> DataFrame:
        """Benchmark runs of two commit modes, one series per user."""
        mode = F.when(F.col("event_type").isin("click", "view"), "on").otherwise("off")
        return self.raw("events").select(
            F.col("user_id").alias("series"), mode.alias("commit_mode"),
            F.col("value").cast("decimal(12,3)").alias("elapsed_ms"), F.lit(97).cast("long").alias("inserted_rows"))

    @cached_property
    def transaction_events(self) -> DataFrame:
        """Status log: PREPARED for each event, then COMMITTED or ABORTED for most."""
        tx = uuid_text(F.lit("tx"), F.col("event_id"))
        events = self.raw("events")
        began = events.select(tx.alias("tx_id"), (F.col("event_id") * 2).alias("seq"),
                              F.lit("PREPARED").alias("status"), F.col("ts").alias("at"))
        final = F.when(F.col("event_type") == "error", "ABORTED").otherwise("COMMITTED")
        waited = F.make_dt_interval(secs=F.floor("value"))
        ended = events.filter(F.col("event_type") != "signup").select(
            tx.alias("tx_id"), (F.col("event_id") * 2 + 1).alias("seq"), final.alias("status"),
            (F.col("ts") + waited).alias("at"))
        return began.unionByName(ended)

    @cached_property
    def saga_events(self) -> DataFrame:
        """Publish-post sagas, one per order: F fails, O completes, P stops on the way."""
        steps = F.array(*[
            F.struct(F.lit(at).cast("long").alias("seq"), F.lit(status).alias("saga_status"),
                     F.lit(step).alias("step_name"), F.lit(ending).alias("ending"))
            for at, status, step, ending in [
                (1, "STARTED", "CREATE_POST", "any"),
                (2, "STARTED", "UPDATE_COUNTERS", "any"),
                (3, "STARTED", "SEND_NOTIFICATION", "any"),
                (4, "COMPLETED", "DONE", "O"),
                (4, "COMPENSATED", "ROLLBACK_DONE", "F"),
            ]])
        reached = F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") % 3 + 1).otherwise(4)
        taken = F.filter(steps, lambda s: (s["seq"] <= reached) & (
            (s["ending"] == "any") | (s["ending"] == F.col("o_orderstatus"))))
        return (self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                          F.explode(taken).alias("step"))
                .select(F.concat(F.lit("saga-"), F.col("o_orderkey").cast("string")).alias("saga_id"),
                        F.col("step.seq").alias("seq"), F.lit("PUBLISH_POST").alias("saga_type"),
                        F.col("step.saga_status").alias("saga_status"),
                        F.col("step.step_name").alias("step_name"),
                        json_object(user_id=F.col("o_custkey")).alias("payload"),
                        F.col("o_orderkey").alias("post_id"),
                        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("step.seq"))).alias("at")))

    @cached_property
    def post_commands(self) -> DataFrame:
        """Create-post commands whose content is a whole document text."""
        return self.raw("documents").select(
            F.col("doc_id").alias("post_id"), (F.col("doc_id") % self._user_total()).alias("user_id"),
            F.col("text").alias("content"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
             + F.make_dt_interval(secs=F.col("doc_id"))).alias("created_at"))
