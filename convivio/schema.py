"""Schemas of the social-network tables (column defaults are applied by the generators)."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, TEXT, FLAG, NTZ = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


USERS = _table(
    user_id=LONG, username=TEXT, email=TEXT, full_name=TEXT, bio=TEXT, profile_picture_url=TEXT,
    follower_count=LONG, following_count=LONG, post_count=LONG, is_verified=FLAG, is_private=FLAG,
    created_at=NTZ, updated_at=NTZ, last_login=NTZ,
)
POSTS = _table(
    post_id=LONG, user_id=LONG, content=TEXT, media_urls=T.ArrayType(TEXT), location=TEXT,
    like_count=LONG, comment_count=LONG, share_count=LONG, is_deleted=FLAG,
    created_at=NTZ, updated_at=NTZ,
)
COMMENTS = _table(
    comment_id=LONG, post_id=LONG, user_id=LONG, content=TEXT, like_count=LONG, is_deleted=FLAG,
    created_at=NTZ, updated_at=NTZ,
)
POST_LIKES = _table(like_id=LONG, post_id=LONG, user_id=LONG, created_at=NTZ)
FOLLOWERS = _table(follower_id=LONG, following_id=LONG, created_at=NTZ)
DISTRIBUTED_TRANSACTIONS = _table(
    tx_id=TEXT, status=TEXT, source_shard=LONG, target_shard=LONG, operation_type=TEXT,
    operation_data=TEXT, created_at=NTZ, completed_at=NTZ,
)
SAGA_EVENTS = _table(
    saga_id=TEXT, seq=LONG, saga_type=TEXT, saga_status=TEXT, step_name=TEXT, payload=TEXT,
    post_id=LONG, at=NTZ,
)
POSTS_COMMAND = _table(post_id=LONG, user_id=LONG, content=TEXT, created_at=NTZ)
EVENT_OUTBOX = _table(
    event_id=LONG, event_type=TEXT, aggregate_id=LONG, payload=TEXT, processed=FLAG, created_at=NTZ,
)
POSTS_READ_MODEL = _table(
    post_id=LONG, user_id=LONG, content=TEXT, created_at=NTZ, indexed_at=NTZ,
    first_event_id=LONG, last_event_id=LONG,
)
MODE_BENCHMARKS = _table(
    benchmark_id=TEXT, commit_mode=TEXT, iterations=LONG, inserted_rows=LONG,
    elapsed_ms=T.DecimalType(12, 3), rows_visible_primary=LONG, created_at=NTZ,
)
GEO_PING = _table(id=TEXT, writer_region=TEXT, payload=TEXT, created_at=T.TimestampType())
SAMPLES = _table(group=TEXT, seq=LONG, latency_ms=T.DoubleType(), ok=FLAG)

ALL = {
    "users": USERS, "posts": POSTS, "comments": COMMENTS, "post_likes": POST_LIKES,
    "followers": FOLLOWERS, "distributed_transactions": DISTRIBUTED_TRANSACTIONS,
    "saga_events": SAGA_EVENTS, "posts_command": POSTS_COMMAND, "event_outbox": EVENT_OUTBOX,
    "posts_read_model": POSTS_READ_MODEL, "async_replication_benchmarks": MODE_BENCHMARKS,
    "geo_ping": GEO_PING, "samples": SAMPLES,
}
SHARDS = 3
