"""Table maintenance as batch jobs: request tables and current tables in, new tables out.

Plain Parquet has no MERGE, so every operator returns the new rows and the caller writes them to
a fresh snapshot path. Requests are reduced per key by their map tasks before they meet a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import json_object, micros_between, shard_of, uuid_text, zero_if_null
from ..schema import SHARDS
from ..session import durable
from .ranks import number_rows
from .windows import top_per_key


def insert_ignore(target: DataFrame, requests: DataFrame, keys: Sequence[str],
                  order: Sequence[Column]) -> DataFrame:
    """Target plus the requested rows whose key is new; the earliest request of a key wins."""
    return target.unionByName(new_rows(target, requests, keys, order))


def new_rows(target: DataFrame, requests: DataFrame, keys: Sequence[str],
             order: Sequence[Column]) -> DataFrame:
    earliest = top_per_key(requests, keys, order, 1)
    return earliest.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)


def fold_events(events: DataFrame) -> DataFrame:
    """One row per post from decoded create-post events.

    The lowest event id gives user_id and created_at, the highest gives content, as when the
    events were applied one by one in id order. The fold is insensitive to order and repeats, so
    folded rows can be folded again with `merge_folds`.
    """
    return merge_folds(events.select(
        "post_id", "user_id", "content", "created_at", "indexed_at",
        F.col("event_id").alias("first_event_id"), F.col("event_id").alias("last_event_id")))


def merge_folds(rows: DataFrame) -> DataFrame:
    """Merge folded rows of the same post; see `fold_events`."""
    first = F.min_by(F.struct("user_id", "created_at"), "first_event_id")
    last = F.max_by(F.struct("content", "indexed_at"), "last_event_id")
    return (rows.groupBy("post_id")
            .agg(first.alias("first"), last.alias("last"),
                 F.min("first_event_id").alias("first_event_id"),
                 F.max("last_event_id").alias("last_event_id"))
            .select("post_id", "first.user_id", "last.content", "first.created_at",
                    "last.indexed_at", "first_event_id", "last_event_id"))


def upsert_posts(target: DataFrame, folded: DataFrame) -> DataFrame:
    """Insert new posts, else update content and indexed_at only.

    user_id and created_at keep their first values. An event at or below the last one applied to
    the post changes nothing, so replays are harmless. A stored row without a last event is older than all.
    """
    t, e = target.alias("t"), folded.alias("e")
    joined = t.join(e, F.col("t.post_id") == F.col("e.post_id"), "full_outer")
    applied = F.coalesce("t.last_event_id", F.lit(-2**63).cast("long"))
    newer = F.col("t.post_id").isNull() | (F.col("e.last_event_id") > applied)

    def kept(name):
        return F.coalesce(F.col(f"t.{name}"), F.col(f"e.{name}")).alias(name)

    def updated(name):
        return F.when(newer, F.col(f"e.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return joined.select(
        kept("post_id"), kept("user_id"), updated("content"), kept("created_at"),
        updated("indexed_at"), kept("first_event_id"),
        F.greatest("t.last_event_id", "e.last_event_id").alias("last_event_id"))


def apply_counters(table: DataFrame, deltas: DataFrame, key: str, counters: Sequence[str],
                   floor: int | None = None) -> DataFrame:
    """Add the summed deltas per key to the counters; with `floor`, never go below it."""
    summed = deltas.groupBy(key).agg(*[F.sum(c).alias(f"_d_{c}") for c in counters])
    joined = table.join(summed, key, "left")

    def moved(name):
        total = F.col(name) + zero_if_null(F.col(f"_d_{name}"))
        return (total if floor is None else F.greatest(total, F.lit(floor).cast("long"))).alias(name)

    return joined.select(*[moved(c) if c in counters else F.col(c) for c in table.columns])


def floor_decrement(table: DataFrame, key: str, counter: str, removals: DataFrame) -> DataFrame:
    """Lower a counter by the number of removal rows per key, never below zero."""
    deltas = removals.select(key, F.lit(-1).cast("long").alias(counter))
    return apply_counters(table, deltas, key, [counter], floor=0)


def delete_by_key(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed. The list is joined as it is, so that a hot join partition can be split."""
    return table.join(keys.select(key), key, "left_anti").select(*table.columns)


class FollowBatch(NamedTuple):
    edges: DataFrame
    added: DataFrame
    users: DataFrame
    log: DataFrame


def classify_follows(requests: DataFrame, users: DataFrame, edges: DataFrame) -> DataFrame:
    """Each request with its status.

    COMMITTED needs two known users, a pair that is not stored, and to be the first request for
    that pair; anything else is ABORTED, and so is a request marked in an optional boolean column
    `simulate_error`. Self-follows are accepted. Pairs are judged once and the verdict goes back
    to the requests, so repeated requests cost one row in the joins. A request id may stand with
    several pairs, but only once with the same pair.
    """
    pair = ["follower_id", "following_id"]
    tried = requests
    if "simulate_error" in requests.columns:
        tried = requests.filter(~F.coalesce("simulate_error", F.lit(False)))
    pairs = tried.groupBy(*pair).agg(F.min("request_id").alias("winner"))
    known = users.select("user_id")
    # The anti join comes first: the pairs are already partitioned by both columns.
    valid = (pairs.join(edges.select(*pair), pair, "left_anti")
             .join(known.withColumnRenamed("user_id", "follower_id"), "follower_id", "left_semi")
             .join(known.withColumnRenamed("user_id", "following_id"), "following_id", "left_semi")
             .select(F.col("winner").alias("request_id"), *pair, F.lit("COMMITTED").alias("verdict")))
    judged = requests.join(valid, ["request_id", *pair], "left")
    return judged.select(*requests.columns, F.coalesce("verdict", F.lit("ABORTED")).alias("status"))


def follow_batch(requests: DataFrame, users: DataFrame, edges: DataFrame,
                 shards: int = SHARDS, keep: bool = False) -> FollowBatch:
    """Process follow requests: new edges, both counters of each new edge, and an audit log.

    The follower's following_count and the followed user's follower_count go up by one per
    committed request. Aborted requests leave a log row and nothing else. `added` alone can be
    appended to the stored edges. Set `keep` when more than one of the outputs is written: the
    verdicts are then stored once and not worked out again.
    """
    judged = classify_follows(requests, users, edges)
    if keep:
        judged = durable(judged)
    done = judged.filter(F.col("status") == "COMMITTED")
    added = done.select("follower_id", "following_id", F.col("at").alias("created_at"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    deltas = done.select(F.inline(F.array(
        F.struct(F.col("follower_id").alias("user_id"), zero.alias("follower_count"),
                 one.alias("following_count")),
        F.struct(F.col("following_id").alias("user_id"), one.alias("follower_count"),
                 zero.alias("following_count")))))
    log = judged.select(
        uuid_text(F.lit("follow"), F.col("request_id")).alias("tx_id"), "status",
        shard_of(F.col("follower_id"), shards).alias("source_shard"),
        shard_of(F.col("following_id"), shards).alias("target_shard"),
        F.lit("ADD_FOLLOW").alias("operation_type"),
        json_object(follower_id=F.col("follower_id"),
                    following_id=F.col("following_id")).alias("operation_data"),
        F.col("at").alias("created_at"), F.col("at").alias("completed_at"))
    return FollowBatch(
        edges.unionByName(added), added,
        apply_counters(users, deltas, "user_id", ["follower_count", "following_count"]), log)


class LikeBatch(NamedTuple):
    likes: DataFrame
    added: DataFrame
    posts: DataFrame


def like_batch(requests: DataFrame, posts: DataFrame, likes: DataFrame, users: DataFrame,
               keep: bool = False) -> LikeBatch:
    """Insert-ignore likes, and raise like_count of a post by its newly inserted likes only.

    Requests of unknown users break the foreign key of the likes and have no effect; posts have no such key.
    `added` alone can be appended to the stored likes. `keep` stores the new likes once when more
    than one output is written. If the stored likes have a like_id, they keep it, and new ones get the ids after the
    highest, in the order of their requests; a batch that is repeated finds nothing new to number.
    """
    pair = ["post_id", "user_id"]
    # The key is checked on the requests as they are, so that a hot user can be split.
    valid = requests.join(users.select("user_id"), "user_id", "left_semi")
    earliest = top_per_key(valid, pair, [F.asc("at"), F.asc("request_id")], 1)
    fresh = earliest.join(likes.select(*pair), pair, "left_anti")
    if keep and "like_id" not in likes.columns:
        fresh = durable(fresh)
    names = [*pair, "created_at"]
    if "like_id" in likes.columns:
        names = ["like_id", *names]
        highest = lambda _: (likes.agg(F.max("like_id")).first()[0] or 0) + 1
        fresh = number_rows(fresh, ["request_id", *pair], "like_id", highest)
    rows = fresh.withColumn("created_at", F.col("at")).select(*names)
    deltas = fresh.select("post_id", F.lit(1).cast("long").alias("like_count"))
    return LikeBatch(likes.select(*names).unionByName(rows), rows,
                     apply_counters(posts, deltas, "post_id", ["like_count"]))


# The states of transactions and sagas, and the steps of the publish-post saga.
TX_STATUSES = ("PREPARED", "COMMITTED", "ABORTED")
SAGA_STATUSES = ("STARTED", "COMPLETED", "COMPENSATED")
SAGA_STEPS = ("CREATE_POST", "UPDATE_COUNTERS", "SEND_NOTIFICATION", "DONE", "ROLLBACK_DONE")


def _last_of(name: str, among: Sequence[str] | None) -> tuple[Column, Column]:
    """The aggregate for a column's last text by seq, and the text again from its result `_last_<name>`.

    Texts of a known list go as their place in it: an aggregate of numbers is hashed and needs no sort.
    """
    column, held = F.col(name), F.col(f"_last_{name}")
    if among is None:
        return F.max_by(column, "seq").alias(f"_last_{name}"), held
    texts = F.array(*[F.lit(text) for text in among])
    place = F.array_position(texts, column).cast("int")
    return F.max_by(place, "seq").alias(f"_last_{name}"), F.when(held > 0, F.get(texts, held - 1))


def fold_transactions(events: DataFrame, statuses: Sequence[str] | None = TX_STATUSES) -> DataFrame:
    """Current status, start, end and duration of each transaction from its status events.

    A status that is not in `statuses` comes back as null; None takes any text, and sorts before it aggregates.
    """
    last, status = _last_of("status", statuses)
    latest = events.groupBy("tx_id").agg(last, F.min("at").alias("created_at"), F.max("at").alias("_last"))
    ended = F.when(status.isin("COMMITTED", "ABORTED"), F.col("_last"))
    return latest.select(
        "tx_id", status.alias("status"), "created_at", ended.alias("completed_at"),
        (micros_between(F.col("created_at"), ended) / 1000).alias("duration_ms"))


def fold_sagas(events: DataFrame, statuses: Sequence[str] | None = SAGA_STATUSES,
               steps: Sequence[str] | None = SAGA_STEPS) -> DataFrame:
    """Current step and status of each saga from its step events.

    `counted` tells whether the saga got as far as raising the author's post counter. The lists are as in
    `fold_transactions`. A saga's events share their payload; the highest author counts should they not.
    """
    (last_status, status), (last_step, step) = _last_of("saga_status", statuses), _last_of("step_name", steps)
    raised = F.max(F.col("step_name") == "UPDATE_COUNTERS")
    author = F.max(F.get_json_object("payload", "$.user_id").try_cast("long"))
    return (events.groupBy("saga_id")
            .agg(last_status, last_step, F.max("post_id").alias("post_id"), author.alias("user_id"),
                 raised.alias("counted"), F.min("at").alias("created_at"), F.max("at").alias("updated_at"))
            .select("saga_id", status.alias("saga_status"), step.alias("step_name"), "post_id", "user_id", "counted",
                    "created_at", "updated_at"))


class SagaOutcome(NamedTuple):
    posts: DataFrame
    users: DataFrame


def apply_sagas(sagas: DataFrame, posts: DataFrame, users: DataFrame) -> SagaOutcome:
    """Undo compensated sagas once: drop their posts, lower their authors' counters to zero at least.

    Counters already hold the increments of sagas that reached that step.
    """
    undone = sagas.filter(F.col("saga_status") == "COMPENSATED")
    counted = undone.filter(F.col("counted") & F.col("post_id").isNotNull())
    return SagaOutcome(delete_by_key(posts, undone.filter(F.col("post_id").isNotNull()), "post_id"),
                       floor_decrement(users, "user_id", "post_count", counted))


class CreatedPosts(NamedTuple):
    posts: DataFrame
    outbox: DataFrame


def outbox_events(rows: DataFrame, event_type: str, event_id: str) -> DataFrame:
    """One outbox event for each row of post_id, user_id, content and created_at, a narrow projection."""
    payload = json_object(
        post_id=F.col("post_id"), user_id=F.col("user_id"), content=F.col("content"),
        created_at=F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return rows.select(
        F.col(event_id).alias("event_id"), F.lit(event_type).alias("event_type"),
        F.col("post_id").alias("aggregate_id"), payload.alias("payload"),
        F.lit(False).alias("processed"), "created_at")


def create_posts(commands: DataFrame, event_id: str = "post_id") -> CreatedPosts:
    """Each command row yields a post row and a POST_CREATED event.

    `event_id` names the column with the events' ids. Ids of a sequence of their own (`sources.sequences`) let one post have several
    events; ids taken from the post allow one.
    """
    return CreatedPosts(commands.select("post_id", "user_id", "content", "created_at"),
                        outbox_events(commands, "POST_CREATED", event_id))


def rejected_batch_check(requests: DataFrame, users: DataFrame, edges: DataFrame) -> DataFrame:
    """Edge counts before and after a request batch, and whether nothing changed."""
    result = follow_batch(requests, users, edges, keep=True)
    total = F.count(F.lit(1))
    committed = F.coalesce(F.sum((F.col("status") == "COMMITTED").cast("long")), F.lit(0).cast("long"))
    return result.log.agg(total.alias("requests"), committed.alias("committed")).select(
        "requests", "committed", edges.select(total).scalar().alias("count_before"),
        result.edges.select(total).scalar().alias("count_after"),
    ).withColumn("rolled_back", F.col("count_before") == F.col("count_after"))
