"""The registered queries: each reads whole tables of a scale folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import draws
from ..functions import scalars as S
from ..operators import (
    aggregates, experiments, filters, generate, joins, maintenance, ordering, quality, ranks, windows,
)
from ..session import durable, prepare, scratch_path
from ..sources import colocated, maintained, merges, sequences, tables
from ..sources.stand_ins import SocialTables
from ..streaming import outbox, status

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

POSTS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-02-01 00:00:00"


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def query(name: str):
    """Register a function of the social tables under a name."""
    def register(build: Callable[[SocialTables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            place = str(folder).rstrip("/")
            return build(SocialTables(prepare(spark, place), place))
        run.__name__ = name
        run.__doc__ = build.__doc__
        REGISTRY[name] = run
        return build
    return register


# --- sources and sinks -------------------------------------------------------------------------

@query("s1_scan")
def _(t):
    return tables.run_sql(t.spark, "SELECT user_id, username FROM {users} WHERE user_id >= :low",
                          {"low": 0}, users=t.users)


def _fresh(t, tag):
    return scratch_path(t.spark, tag)


@query("s2_append")
def _(t):
    """Two appended batches, read back."""
    path = _fresh(t, "append")
    tables.append(t.posts, path)
    tables.append(t.comments.select(F.col("comment_id").alias("post_id"), "user_id",
                                    F.col("content").alias("location"),
                                    F.lit(0).cast("long").alias("like_count"), "created_at"), path)
    return aggregates.group_sizes(tables.scan(t.spark, path), "user_id")


@query("s2_row_counts")
def _(t):
    """Two appended batches with the rows that each append reports."""
    path = _fresh(t, "append")
    sizes = [(n, tables.append_rows(df.select("post_id", "user_id"), path)) for n, df in (("posts", t.posts), ("likes", t.post_likes))]
    return t.spark.createDataFrame(sizes, "batch string, rows long").withColumn(
        "rows_read", tables.scan(t.spark, path).select(F.count(F.lit(1))).scalar())


@query("s3_insert_select")
def _(t):
    """Derive a posts table, write it, and read it with the table's schema."""
    path = tables.append(tables.conform(
        t.posts.withColumn("content", F.concat(F.lit("Post content #"), F.col("post_id").cast("string"))),
        schema.POSTS), _fresh(t, "insert"))
    return tables.scan(t.spark, path, schema.POSTS).select(
        "post_id", "user_id", "content", "location", "like_count", "created_at")


@query("s4_csv_sink")
def _(t):
    shape = t.users.schema
    return tables.read_csv(t.spark, tables.write_csv(t.users, _fresh(t, "csv")), shape)


@query("s4_csv_texts")
def _(t):
    """Whole document texts, with their line breaks and quotes, through CSV and back."""
    rows = t.raw("documents").select("doc_id", "text", "lang")
    return tables.read_csv(t.spark, tables.write_csv(rows, _fresh(t, "csv")), rows.schema)


@query("s5_json_sink")
def _(t):
    rows = t.comments.select("comment_id", "post_id", "user_id", "content")
    return tables.read_json(t.spark, tables.write_json(rows, _fresh(t, "json")), rows.schema)


def _latency_documents(t) -> DataFrame:
    """One nested result document per sample group."""
    stats = ranks.sample_stats(t.samples)
    body = F.struct("count", "error_count", "mean", "median", "p95", "p99")
    return stats.select("group", F.struct(body.alias("write_primary")).alias("doc"))


@query("s6_result_documents")
def _(t):
    """Nested result documents written as JSON and read back with their file names."""
    path = _fresh(t, "docs")
    _latency_documents(t).repartition("group").write.partitionBy("group").json(path)
    shape = T.StructType.fromDDL(
        "doc struct<write_primary: struct<count: long, error_count: long, median: double, p95: double>>")
    docs = tables.read_documents(t.spark, path, shape).select("*", "doc.write_primary")
    return docs.select("group", F.col("write_primary.count").alias("n"),
                       F.col("write_primary.error_count").alias("errors"),
                       F.col("write_primary.median").alias("median"),
                       F.col("write_primary.p95").alias("p95"),
                       F.col("file_name").endswith(".json").alias("from_json_file"))


@query("s6_expected_documents")
def _(t):
    """Expected result documents, of which one is missing and one cut off, as the summary sees them."""
    path, docs = _fresh(t, "docs"), _latency_documents(t)
    whole = F.to_json("doc")
    text = F.when(F.col("group") == "error", F.substring(whole, 1, 20)).otherwise(whole)
    for group, kind in (("click", "exp1"), ("error", "exp4")):
        docs.filter(F.col("group") == group).select(text.alias("value")).coalesce(1).write.text(f"{path}/{kind}")
    kinds = [("exp1", True), ("exp3", False), ("exp4", True)]
    found = None
    for kind, there in kinds:
        names = [f.rsplit("/", 1)[1] for f in t.spark.read.text(f"{path}/{kind}").inputFiles()] if there else ["absent.json"]
        part = tables.read_expected(t.spark, f"{path}/{kind}", {kind: names[0]})
        found = part if found is None else found.unionByName(part)
    return experiments.summarise(found).join(found.select(F.col("name").alias("experiment"), "broken"), "experiment").select(
        "experiment", "available", "broken", "status").distinct()


@query("s7_series")
def _(t):
    """A series as long as the users table, numbered from 1, against the users it should cover."""
    numbers = tables.series(t.spark, t.users.count(), "n")
    return numbers.join(t.users, numbers.n == t.users.user_id + 1, "left").select("n", "username")


@query("s8_hash_layout")
def _(t):
    path = tables.write_hash_layout(t.users, _fresh(t, "hash"), "user_id")
    placed = tables.scan(t.spark, path)
    return placed.select("user_id", "username", F.col("shard").cast("long").alias("shard"))


@query("s9_month_layout")
def _(t):
    path = tables.write_month_layout(t.posts, _fresh(t, "month"))
    months = tables.scan(t.spark, path).groupBy(F.col("created_month").cast("string").alias("created_month"))
    return months.agg(F.count(F.lit(1)).alias("row_count"), F.sum("like_count").alias("likes"))


@query("s10_provenance")
def _(t):
    """Rows per partition folder, taken from the path each row was read from."""
    path = tables.write_hash_layout(t.users, _fresh(t, "origin"), "user_id")
    rows = tables.with_origin(tables.scan(t.spark, path))
    folder = F.regexp_extract("origin_path", r"/(shard=\d+)/", 1)
    return aggregates.group_sizes(rows.withColumn("partition_name", folder), "partition_name")


@query("s11_summary_sink")
def _(t):
    """The experiment summary written with its metrics nested, and read back."""
    summary = experiments.summarise(_experiment_documents(t)).withColumn("value", F.round("value", 4))
    nested = experiments.nest_summary(summary)
    back = tables.read_json(t.spark, tables.write_json(nested, _fresh(t, "summary")), nested.schema)
    return back.select("experiment", "available", "status", "interpretation",
                       F.explode_outer("metrics").alias("metric", "value"))


# --- generators --------------------------------------------------------------------------------

def _ids(t, source, column, name):
    return t.raw(source).select((F.col(column) + 1).alias(name))


def _user_total(t):
    return t.users.select(F.count(F.lit(1))).scalar()


def _post_total(t):
    return t.posts.select(F.count(F.lit(1))).scalar()


@query("g1_users")
def _(t):
    return generate.users(_ids(t, "customer", "c_custkey", "user_id"), moment(EVENTS_AS_OF))


@query("g2_posts")
def _(t):
    return generate.posts(_ids(t, "orders", "o_orderkey", "post_id"), _user_total(t), moment(EVENTS_AS_OF))


@query("g3_comments")
def _(t):
    return generate.comments(_ids(t, "events", "event_id", "comment_id"), _post_total(t), _user_total(t),
                             moment(EVENTS_AS_OF))


@query("g1_plain_users")
def _(t):
    return generate.plain_users(_ids(t, "customer", "c_custkey", "user_id"))


@query("g2_plain_posts")
def _(t):
    return generate.plain_posts(_ids(t, "orders", "o_orderkey", "post_id"), _user_total(t), moment(EVENTS_AS_OF))


@query("g3_plain_comments")
def _(t):
    return generate.plain_comments(_ids(t, "events", "event_id", "comment_id"), _post_total(t), _user_total(t),
                                   moment(EVENTS_AS_OF))


@query("g4_followers")
def _(t):
    return generate.followers(_ids(t, "events", "event_id", "id"), _user_total(t), moment(EVENTS_AS_OF))


@query("g5_likes")
def _(t):
    """Few posts for many candidates, so that pairs repeat."""
    posts = t.accounts.select(F.count(F.lit(1))).scalar()
    return generate.likes(_ids(t, "orders", "o_orderkey", "id"), posts, _user_total(t), moment(EVENTS_AS_OF))


@query("g4_exact")
def _(t):
    """As many different edges as there are ids."""
    return generate.exact_followers(_ids(t, "events", "event_id", "id"), _user_total(t), moment(EVENTS_AS_OF))


@query("g5_exact")
def _(t):
    posts = t.accounts.select(F.count(F.lit(1))).scalar()
    return generate.exact_likes(_ids(t, "events", "event_id", "id"), posts, _user_total(t), moment(EVENTS_AS_OF))


@query("g4_random")
def _(t):
    """As many different edges as there are ids, spread like random draws."""
    return generate.random_followers(_ids(t, "events", "event_id", "id"), _user_total(t), moment(EVENTS_AS_OF))


@query("g5_random")
def _(t):
    posts = t.accounts.select(F.count(F.lit(1))).scalar()
    return generate.random_likes(_ids(t, "events", "event_id", "id"), posts, _user_total(t), moment(EVENTS_AS_OF))


@query("g6_random_time")
def _(t):
    drawn = draws.draw(F.col("user_id"), "time")
    return t.users.select("user_id", draws.moment_before(moment(EVENTS_AS_OF), drawn, 90).alias("at"))


@query("g7_tag_sample")
def _(t):
    size = draws.between(draws.draw(F.col("post_id"), "size"), 2, 4)
    return t.posts.select("post_id", draws.sample_words(
        F.col("post_id"), "tag", generate.HASHTAGS, size, 42).alias("tags"))


@query("g8_fk_sample")
def _(t):
    """Each post gets a random existing account; account ids need not be dense."""
    parents = t.accounts.select((F.col("user_id") * 7 + 3).alias("account_id"))
    children = t.posts.select("post_id")
    return generate.sample_parent(children, "post_id", parents, "account_id", "account_id")


# --- filters and derived columns ---------------------------------------------------------------

@query("f1_point_lookup")
def _(t):
    return filters.point_lookup(t.users, "user_id", 1)


@query("f1_pruned_lookup")
def _(t):
    """The same on a hash layout: only one shard folder is read."""
    path = tables.write_hash_layout(t.users, _fresh(t, "lookup"), "user_id", 8)
    return filters.point_lookup(tables.scan(t.spark, path), "user_id", 1, ("user_id", 8)).select(*t.users.columns)


@query("f2_text_lookup")
def _(t):
    found = filters.point_lookup(t.users, "username", "Customer#000000007")
    return joins.user_profile_with_posts(found, t.posts)


@query("f2_filtered_lookup")
def _(t):
    """The same from a table with a Bloom filter on the name."""
    path = tables.write_lookup_table(t.users, _fresh(t, "lookup"), "username", 200_000)
    found = filters.point_lookup(tables.scan(t.spark, path), "username", "Customer#000000007")
    return joins.user_profile_with_posts(found, t.posts)


@query("f3_key_range")
def _(t):
    chosen = filters.key_range(t.users, "user_id", 1, 100)
    return joins.social_stats(chosen, t.posts, t.post_likes, t.followers, few=True)


@query("f4_in_list")
def _(t):
    return filters.in_list(t.user_counters, "user_id", [1, 2])


@query("f5_like")
def _(t):
    patterns = ["Customer#00000001%", filters.benchmark_pattern("Customer", "00000012"), "%7_9"]
    return filters.like_any(t.users, "username", patterns)


@query("f6_not_self")
def _(t):
    return filters.not_self(t.follow_candidates)


@query("f7_recent")
def _(t):
    return filters.since(t.posts, moment(POSTS_AS_OF), 30)


@query("f7_recent_pruned")
def _(t):
    """The same on a month layout: older month folders are not read."""
    path = tables.write_month_layout(t.posts, _fresh(t, "recent"))
    start = moment(POSTS_AS_OF) - F.make_dt_interval(days=F.lit(30))
    return tables.read_since(t.spark, path, start).select(*t.posts.columns)


@query("f8_not_null")
def _(t):
    k = F.when(F.col("content") != "view", F.col("post_id"))
    return filters.not_null(t.comments.withColumn("post_id", k), "post_id", "user_id")


@query("f9_pending")
def _(t):
    return filters.pending(t.event_outbox).select("event_id", "event_type", "aggregate_id")


@query("f10_scalar_subquery")
def _(t):
    return joins.posts_per_user(filters.lowest_key_rows(t.users, "user_id"), t.posts)


@query("f11_case")
def _(t):
    place = filters.band(F.col("like_count"), [(3500, generate.LOCATIONS[0]), (1500, generate.LOCATIONS[1])],
                         generate.LOCATIONS[2])
    return t.posts.select("post_id", place.alias("place"))


@query("f11_case_draws")
def _(t):
    place = generate.weighted_location(F.col("post_id"), 0.4, 0.7)
    return t.posts.select("post_id", place.alias("place"))


@query("f12_shard_id")
def _(t):
    return filters.with_shard(t.users).select("user_id", "username", "shard_id")


@query("f13_status_text")
def _(t):
    status = F.col("o_orderstatus")
    flat = S.json_object(result=F.lit("FAILED"))
    nested = F.to_json(F.struct(F.struct(F.lit("COMMITTED").alias("result")).alias("success_scenario")))
    payload = F.when(status == "F", flat).when(status == "O", nested).otherwise("{}")
    return t.raw("orders").select(F.col("o_orderkey").alias("post_id"), filters.status_text(
        payload, ["$.result", "$.success_scenario.result"]).alias("status"))


# --- joins -------------------------------------------------------------------------------------

@query("j1_user_posts")
def _(t):
    return joins.posts_per_user(t.users, t.posts)


@query("j2_social_stats")
def social_stats(t):
    """Flagship: posts, likes received and followers of every user."""
    return joins.social_stats(t.users, t.posts, t.post_likes, t.followers)


@query("j2_social_stats_distinct")
def _(t):
    """The same over raw candidates with duplicates: distinct likers and followers are counted."""
    likes = t.like_candidates.withColumn("like_id", F.col("post_id") * t._user_total() + F.col("user_id"))
    return joins.social_stats(t.users, t.posts, likes, t.follow_candidates, keys_unique=False)


def _buckets(t, df, key, buckets=16):
    """A stored layout; keys with more than a hundredth of the rows are hot at any scale."""
    return colocated.write_colocated(df, _fresh(t, "buckets"), key, buckets, max(1, df.count() // 100))


@query("j1_colocated")
def _(t):
    """Users and posts in buckets of user_id."""
    return colocated.posts_per_user(_buckets(t, t.users, "user_id"), _buckets(t, t.posts, "user_id"))


@query("j2_colocated")
def _(t):
    """Posts and likes in buckets of post_id, followers and users in buckets of the user."""
    return colocated.social_stats(_buckets(t, t.users, "user_id"), _buckets(t, t.posts, "post_id"),
                                  _buckets(t, t.post_likes, "post_id"), _buckets(t, t.followers, "following_id"))


@query("j2_maintained")
def _(t):
    """Statistics after three batches: early rows; later ones, while urgent posts go; and those posts once more, twice."""
    base, wide = _fresh(t, "maintained"), 8
    # Likes and edges are aggregates, stored once for all batches that are cut from them.
    rows = {"posts": t.posts, "likes": durable(t.post_likes), "edges": durable(t.followers)}
    cuts = {"posts": "1998-06-01", "likes": "1997-01-01", "edges": "2024-01-20"}
    early = {n: df.filter(F.col("created_at") < moment(f"{cuts[n]} 00:00:00")) for n, df in rows.items()}
    late = {n: df.filter(F.col("created_at") >= moment(f"{cuts[n]} 00:00:00")) for n, df in rows.items()}
    urgent = t.posts.filter("location = '1-URGENT'")
    late_calm = late | {"posts": late["posts"].filter("location <> '1-URGENT'")}
    batches = [maintained.Batch(early, {}), maintained.Batch(late_calm, {"posts": urgent}),
               maintained.Batch({"posts": urgent}, {}), maintained.Batch({"posts": urgent}, {})]
    for number, batch in enumerate(batches):
        maintained.apply_batch(t.spark, base, batch, min(number, 2), wide)
    return maintained.maintained_stats(t.spark, base, t.users)


@query("j3_cross_shard_pair")
def _(t):
    return joins.first_cross_shard_pair(t.users)


@query("j4_shard_matrix")
def _(t):
    return joins.shard_matrix(t.followers)


@query("j4_cross_shard_share")
def _(t):
    return joins.cross_shard_share(t.followers)


@query("j5_foreign_keys")
def _(t):
    return quality.foreign_key_report([
        ("posts.user_id", t.posts, "user_id", t.users, "user_id"),
        ("comments.user_id", t.comments, "user_id", t.users, "user_id"),
        ("post_likes.user_id", t.post_likes, "user_id", t.users, "user_id"),
        ("followers.follower_id", t.followers, "follower_id", t.users, "user_id"),
        ("followers.following_id", t.followers, "following_id", t.users, "user_id"),
        ("requests.follower_id", t.follow_requests, "follower_id", t.accounts, "user_id"),
    ])


@query("j5_orphan_rows")
def _(t):
    return quality.orphans(t.posts, "user_id", t.accounts, "user_id")


@query("j6_cascade_delete")
def _(t):
    """Rows left per child table after the users with a negative balance are deleted."""
    gone = t.raw("customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    left = quality.cascade_delete(gone, {
        "posts": (t.posts, ["user_id"]), "comments": (t.comments, ["user_id"]),
        "post_likes": (t.post_likes, ["user_id"]),
        "followers": (t.followers, ["follower_id", "following_id"])})
    counts = [df.agg(F.count(F.lit(1)).alias("rows_left")).select(F.lit(n).alias("table_name"), "rows_left")
              for n, df in left.items()]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionByName(part)
    return merged


@query("j7_pair_count")
def _(t):
    return joins.pair_count(t.followers, 1, 2)


@query("j7_pair_counts")
def _(t):
    return joins.pair_counts(t.follow_requests, t.stored_edges)


# --- aggregates --------------------------------------------------------------------------------

@query("a1_posts_of_user")
def _(t):
    return joins.posts_per_user(filters.point_lookup(t.users, "user_id", 1), t.posts)


@query("a2_distinct_counts")
def _(t):
    return aggregates.distinct_counts(t.comments, "user_id", num_posts="post_id", num_contents="content",
                                      num_comments="comment_id")


@query("a2_bitmap_counts")
def _(t):
    """The same distinct counts from bitmaps of two batches, united later."""
    early = F.col("created_at") < moment("2024-01-10 00:00:00")
    parts = [aggregates.distinct_bitmaps(t.comments.filter(part), "user_id", "post_id", "comment_id") for part in (early, ~early)]
    united = aggregates.unite_bitmaps(parts[0].unionByName(parts[1]), "user_id")
    return aggregates.bitmap_counts(united, "user_id", num_posts="post_id", num_comments="comment_id")


@query("a3_daily_posts")
def _(t):
    return aggregates.daily_posts(t.posts)


@query("a3_daily_posts_recent")
def _(t):
    return aggregates.daily_posts(filters.since(t.posts, moment(POSTS_AS_OF), 30))


@query("a4_row_span")
def _(t):
    return aggregates.row_span(t.comments)


@query("a5_partition_distribution")
def _(t):
    return aggregates.partition_distribution({
        "users": (t.users, "pmod(user_id, 3)"), "comments": (t.comments, "pmod(comment_id, 3)"),
        "post_likes": (t.post_likes, "pmod(user_id, 3)"),
        "followers": (t.followers, "pmod(follower_id, 3)"),
        "posts": (t.posts, "date_format(created_at, 'yyyyMM')")})


@query("a5_layout_distribution")
def _(t):
    """Rows and size per folder of a written layout."""
    path = tables.write_hash_layout(t.post_likes, _fresh(t, "spread"), "user_id")
    found = aggregates.layout_distribution(t.spark, path, "shard")
    return found.select("partition_name", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


@query("a6_file_sizes")
def _(t):
    return aggregates.file_sizes(t.spark, {
        name: f"{t.folder}/{source}.parquet"
        for name, source in [("users", "customer"), ("posts", "orders"), ("post_likes", "lineitem"),
                             ("comments", "events")]})


@query("a6_group_megabytes")
def _(t):
    """Rows and text megabytes of the documents of each language."""
    return aggregates.group_megabytes(t.raw("documents"), "lang", F.octet_length("text"))


@query("a7_sample_stats")
def _(t):
    stats = ranks.sample_stats(t.samples)
    return stats.withColumn("mean", F.round("mean", 9)).withColumn("std_dev", F.round("std_dev", 9))


@query("a7_sample_stats_by_user")
def _(t):
    """The same with one group per user instead of five large ones."""
    by_user = t.raw("events").select(F.col("user_id").cast("string").alias("group"),
                                     F.col("value").alias("latency_ms"), (F.col("value") < 300).alias("ok"))
    stats = ranks.sample_stats(by_user)
    return stats.withColumn("mean", F.round("mean", 9)).withColumn("std_dev", F.round("std_dev", 9))


@query("a8_spread")
def _(t):
    return aggregates.spread(t.samples, "group", "latency_ms")


def _document(name, body):
    return body.select(F.lit(name).alias("name"), "payload")


def _mean_of(t, group):
    return F.avg(F.when(F.col("group") == group, F.col("latency_ms")))


def _experiment_documents(t) -> DataFrame:
    """Experiment documents made from the tables: latencies, mode costs and a cross-shard follow."""
    means = t.samples.agg(*[_mean_of(t, g).alias(g) for g in ["click", "purchase", "signup"]])
    nested = [F.struct(F.col(g).alias("mean")).alias(part) for g, part in [
        ("click", "write_primary"), ("purchase", "read_primary"), ("signup", "read_replica1")]]
    exp1 = means.select(F.to_json(F.struct(*nested)).alias("payload"))
    costs = experiments.compare_modes(t.mode_runs.withColumn("all", F.lit(1)), "all").drop("all")
    exp3 = costs.select(F.to_json(F.struct(F.struct("*").alias("summary"))).alias("payload"))
    log = t.transaction_events
    waited = S.micros_between(F.min("at"), F.max("at")) / 1000
    scenario = joins.first_cross_shard_pair(t.users).select(F.struct(
        log.select(F.max_by("status", "seq")).scalar().alias("result"),
        log.select(waited).scalar().alias("elapsed_ms"),
        F.col("follower_shard").alias("source_shard"), F.col("following_shard").alias("target_shard"),
    ).alias("success_scenario"))
    exp4 = scenario.select(F.to_json(F.struct("success_scenario")).alias("payload"))
    state = t.accounts.agg(F.sort_array(F.collect_set(F.col("user_id") % 3)).alias("replication_status"))
    exp5 = state.select(F.to_json(F.struct(F.lit("dry-run").alias("mode"), F.struct(
        "replication_status").alias("pre_failover_state"))).alias("payload"))
    missing = t.accounts.agg(F.count(F.lit(1))).select(F.lit(None).cast("string").alias("payload"))
    empty = missing.select(F.lit("{}").alias("payload"))
    docs = [_document(n, d) for n, d in [("exp1", exp1), ("exp2", empty), ("exp3", exp3), ("exp4", exp4),
                                         ("exp5", exp5), ("exp6", missing)]]
    merged = docs[0]
    for doc in docs[1:]:
        merged = merged.unionByName(doc)
    return merged


@query("a9_experiment_summary")
def _(t):
    summary = experiments.summarise(_experiment_documents(t))
    return summary.withColumn("value", F.round("value", 4))


@query("a10_mode_comparison")
def _(t):
    return experiments.compare_modes(t.mode_runs, "series")


@query("a10_mode_comparison_rounded")
def _(t):
    return experiments.compare_modes(t.mode_runs, "series", round_first=True)


@query("a11_engine_comparison")
def _(t):
    """Nested document of one system, flat document of the other, one field missing in each."""
    means = t.samples.agg(*[_mean_of(t, g).alias(g) for g in ["click", "view", "signup"]])
    first = means.select(F.to_json(F.struct(
        F.struct(F.col("click").alias("mean")).alias("write_primary"),
        F.col("view").alias("read_mean_ms"))).alias("payload"))
    second = means.select(F.to_json(F.struct(
        F.col("signup").alias("write_mean_ms"), F.col("view").alias("join_mean_ms"))).alias("payload"))
    compared = experiments.compare_engines(first, second)
    return compared.withColumn("first_ms", F.round("first_ms", 9)).withColumn("second_ms", F.round("second_ms", 9))


@query("a12_group_sizes")
def _(t):
    return aggregates.group_sizes(maintenance.fold_sagas(t.saga_events), "saga_status", "step_name")


# --- windows, sorts, limits --------------------------------------------------------------------

@query("w1_keep_latest_likes")
def _(t):
    return windows.latest_moment(t.like_candidates, ["post_id", "user_id"])


@query("w1_keep_latest_follows")
def _(t):
    latest = windows.keep_latest(t.comments.filter("user_id != post_id"), ["user_id", "post_id"],
                                 tie_break=[F.desc("comment_id")])
    return latest.select("comment_id", "user_id", "post_id", "content", "created_at")


@query("w2_number_rows")
def _(t):
    return ranks.number_rows(t.users, ["username", "user_id"], "row_number")


@query("w2_numbered_batches")
def _(t):
    """Users numbered in two batches of one ledger, the first batch twice."""
    path, big = _fresh(t, "sequence"), F.col("full_name") == "BUILDING"
    parts = [sequences.number_batch(t.users.filter(part), ["username", "user_id"], "row_number", path, batch, 100)
             for batch, part in (("a", big), ("b", ~big), ("a", big))]
    return parts[2].unionByName(parts[1])


@query("w2_number_likes")
def _(t):
    pairs = windows.latest_moment(t.like_candidates, ["post_id", "user_id"])
    return ranks.number_rows(pairs, ["post_id", "user_id"], "like_id")


@query("t1_user_feed")
def _(t):
    return ordering.user_feed(t.posts, 7)


@query("t2_all_feeds")
def _(t):
    return ordering.all_feeds(t.posts)


@query("t3_latest")
def _(t):
    return ordering.latest(maintenance.fold_transactions(t.transaction_events), "tx_id")


@query("t4_oldest_pending")
def _(t):
    return ordering.oldest_pending(t.event_outbox).select("event_id", "event_type", "aggregate_id", "created_at")


@query("t5_first_keys")
def _(t):
    return ordering.first_keys(t.users, "user_id", 50)


@query("t6_ordered_limit")
def _(t):
    return ordering.first_keys(social_stats(t), "user_id", 100)


@query("t7_random_row")
def _(t):
    return ordering.random_row(t.users, "user_id")


@query("t8_listing")
def _(t):
    counts = aggregates.group_sizes(t.comments, "content")
    return ordering.listing(counts, F.desc("row_count"), F.asc("content"))


# --- table maintenance -------------------------------------------------------------------------

@query("m1_insert_ignore")
def _(t):
    requests = t.follow_requests.withColumn("created_at", F.col("at"))
    return maintenance.insert_ignore(t.stored_edges, requests, ["follower_id", "following_id"],
                                     [F.asc("request_id")])


@query("m2_upsert")
def _(t):
    return maintenance.upsert_posts(t.read_model, outbox.project_batch(t.event_outbox))


@query("m3_counter_apply")
def _(t):
    deltas = t.comments.select("user_id", F.lit(1).cast("long").alias("post_count"))
    return maintenance.apply_counters(t.user_counters, deltas, "user_id", ["post_count"])


@query("m2_merged_upsert")
def _(t):
    """The same events merged folder by folder into a stored read model, the second half of them twice."""
    path, model = _fresh(t, "merge"), tables.conform(t.read_model, schema.POSTS_READ_MODEL)
    merges.write_shards(model, path, "post_id", 64)
    early = F.col("created_at") < moment("2024-01-15 00:00:00")
    for number, part in enumerate([early, ~early, ~early]):
        merges.merge_posts(path, outbox.project_batch(t.event_outbox.filter(part)), 64, number)
    return merges.read_shards(t.spark, path, schema.POSTS_READ_MODEL)


@query("m3_merged_counters")
def _(t):
    """The same deltas added folder by folder in two batches; a repeated batch id has no effect."""
    path, shape = _fresh(t, "merge"), t.user_counters.schema
    merges.write_shards(t.user_counters, path, "user_id", 16)
    deltas = t.comments.select("user_id", "content", F.lit(1).cast("long").alias("post_count"))
    viewed = F.col("content") == "view"
    for number, part in ((1, viewed), (2, ~viewed), (2, ~viewed), (1, viewed)):
        merges.merge_counters(path, deltas.filter(part), "user_id", shape, ["post_count"], 16, number)
    return merges.read_shards(t.spark, path, shape)


@query("m4_counter_drift")
def _(t):
    return quality.counter_drift(t.posts, "post_id", "like_count", t.post_likes, "post_id")


@query("m4_colocated_drift")
def _(t):
    """Posts and likes in buckets of post_id."""
    return colocated.counter_drift(_buckets(t, t.posts, "post_id"), "like_count", _buckets(t, t.post_likes, "post_id"))


@query("m4_post_counter_drift")
def _(t):
    return quality.counter_drift(t.user_counters, "user_id", "post_count", t.posts, "user_id")


@query("m5_floor_decrement")
def _(t):
    return maintenance.floor_decrement(t.user_counters, "user_id", "post_count", t.posts)


@query("m6_delete_by_key")
def _(t):
    gone = t.raw("orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("post_id"))
    return maintenance.delete_by_key(t.posts, gone, "post_id")


def _follows(t):
    return maintenance.follow_batch(t.follow_requests, t.accounts, t.stored_edges)


@query("m7_follow_log")
def _(t):
    log = _follows(t).log
    data = "follower_id long, following_id long"
    return log.withColumn("d", F.from_json("operation_data", data)).select(
        "tx_id", "status", "source_shard", "target_shard", "operation_type",
        "d.follower_id", "d.following_id", "created_at", "completed_at")


@query("m7_follow_edges")
def _(t):
    return _follows(t).edges


@query("m7_follow_counters")
def _(t):
    return _follows(t).users


@query("m7_follow_added")
def _(t):
    """Only the new edges, with one kind of event failing on purpose."""
    return maintenance.follow_batch(t.failing_requests, t.accounts, t.stored_edges).added


def _likes(t, ids=False):
    likes = t.post_likes if ids else t.post_likes.drop("like_id")
    return maintenance.like_batch(t.like_requests, t.posts, likes, t.accounts)


@query("m8_like_rows")
def _(t):
    return _likes(t).likes


@query("m8_like_ids")
def _(t):
    """Stored likes keep their ids, new ones go on after the highest in the order of their requests."""
    return _likes(t, ids=True).likes


@query("m8_like_counters")
def _(t):
    return _likes(t).posts


@query("m9_transaction_fold")
def _(t):
    return maintenance.fold_transactions(t.transaction_events)


@query("m10_saga_fold")
def _(t):
    return maintenance.fold_sagas(t.saga_events)


def _followed(t, events, start, shape):
    """Three runs of a stream over the events, late ones first, and then all of them once more."""
    base = _fresh(t, "status")
    parts = [events.filter(F.col("seq") % 3 == n) for n in (2, 0, 1)] + [events]
    for part in parts:
        tables.append(part, f"{base}/events")
        start(status.read_events(t.spark, f"{base}/events", events.schema), f"{base}/table",
              f"{base}/checkpoint", 16).awaitTermination()
    return merges.read_shards(t.spark, f"{base}/table", shape)


@query("m9_streamed_fold")
def _(t):
    """The transactions' status as a stream keeps it."""
    shape = maintenance.fold_transactions(t.transaction_events).schema
    return _followed(t, t.transaction_events, status.start_transactions, shape)


@query("m10_streamed_sagas")
def _(t):
    """The sagas' status as a stream keeps it."""
    return _followed(t, t.saga_events, status.start_sagas, maintenance.fold_sagas(t.saga_events).schema)


def _sagas(t):
    return maintenance.apply_sagas(maintenance.fold_sagas(t.saga_events), t.posts, t.user_counters)


@query("m10_saga_posts")
def _(t):
    return _sagas(t).posts


@query("m10_saga_counters")
def _(t):
    return _sagas(t).users


@query("m11_create_posts")
def _(t):
    return maintenance.create_posts(t.post_commands).posts


@query("m11_outbox_events")
def _(t):
    """The events of the same commands, with their payloads decoded again."""
    parsed = outbox.parse(maintenance.create_posts(t.post_commands).outbox)
    return parsed.filter("_whole").select(
        "event_id", "event_type", "aggregate_id", "processed", F.col("_p_post_id").alias("post_id"),
        F.col("_p_user_id").alias("user_id"), F.col("_p_content").alias("content"),
        F.col("_p_at").alias("created_at"), F.col("created_at").alias("indexed_at"))


def _event_batches(t):
    """Two batches of events of the same posts, made and then shortened, with ids of one ledger; the second batch runs twice."""
    path, commands = _fresh(t, "sequence"), t.post_commands
    edits = commands.withColumn("content", F.substring("content", 1, 100))
    made = []
    for batch, (rows, kind) in enumerate([(commands, "POST_CREATED"), (edits, "POST_EDITED"), (edits, "POST_EDITED")]):
        numbered = sequences.number_batch(rows, ["created_at", "post_id"], "event_id", path, min(batch, 1))
        made.append(maintenance.outbox_events(numbered, kind, "event_id"))
    return made[0].unionByName(made[2])


@query("m11_event_sequence")
def _(t):
    """Event ids are a sequence of their own, dense over the batches, and every post has two events."""
    return _event_batches(t).select("event_id", "event_type", "aggregate_id", "created_at")


@query("m11_edited_posts")
def _(t):
    """The read model of both events of every post."""
    return outbox.project_batch(_event_batches(t))


@query("m12_constraint_audit")
def _(t):
    rules = quality.Constraints
    parts = [
        quality.audit("users", t.users, rules(
            not_null=["user_id", "username"], unique=[["user_id"], ["username"], ["full_name"]],
            max_length={"username": 18, "full_name": 8})),
        quality.audit("posts", t.posts, rules(not_null=["post_id", "user_id"], unique=[["post_id"]],
                                              positive=["like_count"])),
        quality.audit("post_likes", t.like_candidates, rules(unique=[["post_id", "user_id"]])),
        quality.audit("followers", t.follow_candidates, rules(
            not_null=["follower_id", "following_id"], unique=[["follower_id", "following_id"]],
            positive=["following_id"])),
        quality.audit("transactions", t.transaction_events, rules(
            not_null=["tx_id"], allowed={"status": ["PREPARED", "COMMITTED"]})),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


@query("m13_rejected_batch")
def _(t):
    """Every stored edge requested again: all requests are rejected and nothing changes."""
    again = t.stored_edges.select(
        (F.col("follower_id") * t._user_total() + F.col("following_id")).alias("request_id"),
        "follower_id", "following_id", F.col("created_at").alias("at"))
    return maintenance.rejected_batch_check(again, t.users, t.stored_edges)


# --- streaming ---------------------------------------------------------------------------------

def _streamed(t, source, rounds=1, base=None):
    """Write the outbox, project it with an available-now stream, return the model path."""
    base = base or _fresh(t, "outbox")
    rows = tables.conform(source, schema.EVENT_OUTBOX)
    for _ in range(rounds):
        tables.append(rows, f"{base}/events")
        stream = outbox.read_outbox(t.spark, f"{base}/events")
        outbox.start_projection(stream, f"{base}/model", f"{base}/checkpoint").awaitTermination()
    return f"{base}/model"


@query("r1_outbox_projection")
def _(t):
    return outbox.read_model(t.spark, _streamed(t, t.event_outbox))


@query("r1_merged_projection")
def _(t):
    """All events arrive twice and are merged into a read model in hash layout, which is then only scanned."""
    base, rows = _fresh(t, "merged"), tables.conform(t.event_outbox, schema.EVENT_OUTBOX)
    for _ in range(2):
        tables.append(rows, f"{base}/events")
        stream = outbox.read_outbox(t.spark, f"{base}/events")
        outbox.start_merged_projection(stream, f"{base}/model", f"{base}/checkpoint", 16).awaitTermination()
    return outbox.merged_model(t.spark, f"{base}/model")


def _projected_once(t):
    return outbox.project_once(t.event_outbox, t.read_model)


@query("r1_batch_projection")
def _(t):
    """All pending events projected as one batch over an existing model."""
    return _projected_once(t).model


@query("r1_flagged_outbox")
def _(t):
    return _projected_once(t).outbox.select("event_id", "event_type", "aggregate_id", "processed")


@query("r2_idempotent_replay")
def _(t):
    """All events arrive twice, in two runs of the same stream."""
    return outbox.read_model(t.spark, _streamed(t, t.event_outbox, rounds=2))


@query("r1_compacted")
def _(t):
    """A snapshot after the first run of the stream, and the batches of a second run over it."""
    base = _fresh(t, "compact")
    path = _streamed(t, t.event_outbox, base=base)
    snapshot = outbox.compact(t.spark, path)
    _streamed(t, t.event_outbox, base=base)
    return outbox.read_model(t.spark, path, *snapshot)


@query("t1_layout_feed")
def _(t):
    """A user's newest posts from files in the order of user and moment."""
    path = tables.write_feed_layout(t.posts, _fresh(t, "feed"), 16)
    return ordering.user_feed(tables.read_feed_layout(t.spark, path, 7), 7)


@query("t1_model_feed")
def _(t):
    """A user's feed from the projected read model."""
    return ordering.user_feed(_projected_once(t).model, 7)


@query("r3_payload_decode")
def _(t):
    return outbox.decode(t.outbox_with_bad_payloads).events


@query("r3_payload_rejects")
def _(t):
    """Rejected rows of the streamed projection."""
    path = _streamed(t, t.outbox_with_bad_payloads)
    return outbox.rejects(t.spark, path).select("event_id", "event_type", "aggregate_id")


# --- scalar functions --------------------------------------------------------------------------

@query("fn_strings")
def _(t):
    name, uid = F.col("username"), F.col("user_id").cast("string")
    return t.users.select(
        "user_id", F.concat(F.lit("user_"), uid, F.lit("_"), name).alias("joined"),
        F.substring(name, 1, 8).alias("head"), F.replace(name, F.lit("#"), F.lit("_")).alias("replaced"),
        F.format_string("%s_%s_%s", F.lit("run"), F.lit("on"), uid).alias("formatted"),
        F.upper("full_name").alias("upper_name"), F.lower("full_name").alias("lower_name"),
        S.first_item(F.concat(name, F.lit(", rest"))).alias("first_item"),
        F.array_join(F.array(name, uid), " ").alias("listed"),
        draws.alphanumeric(draws.draw(F.col("user_id"), "token"), 6).alias("token"),
        S.uuid_text(F.lit(42), F.col("user_id")).alias("uuid"))


@query("fn_dates")
def _(t):
    at = F.col("created_at")
    as_of = moment(EVENTS_AS_OF)
    return t.comments.select(
        "comment_id", F.to_date(at).alias("day"), F.date_trunc("day", at).cast("timestamp_ntz").alias("day_start"),
        (S.micros_between(at, as_of) / 1000).alias("age_ms"),
        (as_of - S.seconds_interval(F.col("user_id"))).alias("earlier"), S.iso_text(at).alias("iso"))


@query("fn_math")
def _(t):
    v, uid = F.col("value"), F.col("user_id")
    return t.raw("events").select(
        "event_id", S.shard_of(uid - 50).alias("shard"), F.floor(v * 2.5).cast("long").alias("floored"),
        F.greatest(uid - 20, F.lit(0).cast("long")).alias("floor_zero"),
        F.greatest(F.lit(20).cast("long"), F.floor(uid / 5).cast("long")).alias("runs"),
        S.round_even(F.floor(v * 1000).cast("double") / 8, 2).alias("even"),
        S.size_text(F.pow(F.col("event_id") % 97, 6.0).cast("long")).alias("size"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"))


@query("fn_nulls_json")
def _(t):
    k = F.get_json_object("props", "$.k").cast("long")
    maybe = F.when(F.col("event_type") != "view", k)
    packed = S.json_object(user_id=F.col("user_id"), k=maybe)
    back = F.from_json(packed, "user_id long, k long")
    return t.raw("events").select(
        "event_id", F.coalesce(maybe, F.lit(-1).cast("long")).alias("k_or_default"),
        back["user_id"].alias("user_id"), back["k"].alias("k"),
        F.coalesce(F.get_json_object("props", "$.missing"), F.get_json_object("props", "$.k"),
                   F.lit("none")).alias("chained"))
