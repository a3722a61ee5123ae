"""Synthetic social data, one row per given id, repeatable under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import (
    alphanumeric, between, chance, draw, moment_before, pick, sample_words,
)
from ..functions.scalars import first_item, uuid_text
from .filters import not_self
from .ranks import number_rows
from .windows import latest_moment

# The word lists of the generated texts.
FIRST_NAMES = ["Juan", "María", "Carlos", "Ana", "Luis", "Rosa", "Pedro", "Sofia", "Miguel", "Laura"]
LAST_NAMES = ["García", "López", "Rodríguez", "Martínez", "Pérez", "Sánchez", "Torres", "Ramírez",
              "Flores", "Rivera"]
LOCATIONS = ["Bogotá, Colombia", "Medellín, Colombia", "Cali, Colombia", "Barranquilla, Colombia",
             "Cartagena, Colombia"]
HASHTAGS = ["#social", "#network", "#distributed", "#database", "#awesome", "#love", "#photography",
            "#travel", "#food", "#tech"]
EMAIL_DOMAINS = ["gmail.com", "example.com", "test.com", "social.com"]
BIOS = ["Passionate developer interested in databases", "Entrepreneur and coffee lover",
        "Photographer and traveler", "Software engineer at {city}",
        "Thinking about distributed systems", "Always learning new technologies",
        "Friend of nature and technology"]
POST_TEXTS = ["Check this out! Post #{post_id} {tags}", "Amazing day! {tags}",
              "Sharing my thoughts... {tags}", "What a moment! {tags}",
              "Feeling good about this {tags}"]
COMMENT_TEXTS = ["Great post! Love this!", "Amazing! Thanks for sharing!", "This is awesome!",
                 "Wow! Super interesting!", "Very nice, thanks!", "Totally agree!", "WOW!",
                 "This deserves more likes!"]


def users(ids: DataFrame, as_of: Column, seed: int = 42, key: str = "user_id") -> DataFrame:
    """User rows; 5 % verified, 30 % private, made in the year before `as_of`."""
    uid = F.col(key)

    def d(stream):
        return draw(uid, f"users/{stream}", seed)

    handle = F.concat(F.lit("user_"), uid.cast("string"), F.lit("_"))
    city = first_item(pick(d("city"), LOCATIONS))
    return ids.select(
        uid.cast("long").alias("user_id"),
        F.concat(handle, alphanumeric(d("username"), 6)).alias("username"),
        F.concat(handle, alphanumeric(d("email"), 4), F.lit("@"), pick(d("domain"), EMAIL_DOMAINS)).alias("email"),
        F.concat_ws(" ", pick(d("first"), FIRST_NAMES), pick(d("last"), LAST_NAMES)).alias("full_name"),
        F.replace(pick(d("bio"), BIOS), F.lit("{city}"), city).alias("bio"),
        between(d("follower_count"), 0, 100000).alias("follower_count"),
        between(d("following_count"), 0, 50000).alias("following_count"),
        between(d("post_count"), 0, 10000).alias("post_count"),
        chance(d("verified"), 0.05).alias("is_verified"),
        chance(d("private"), 0.30).alias("is_private"),
        moment_before(as_of, d("created"), 365).alias("created_at"))


def posts(ids: DataFrame, max_user_id: int | Column, as_of: Column, seed: int = 42,
          key: str = "post_id", days: int = 90) -> DataFrame:
    """Post rows by users 1..max_user_id; 5 % deleted, two to four hashtags, up to `days` old."""
    pid = F.col(key)

    def d(stream):
        return draw(pid, f"posts/{stream}", seed)

    tags = sample_words(pid, "posts/tag", HASHTAGS, between(d("tags"), 2, 4), seed)
    text = F.replace(pick(d("text"), POST_TEXTS), F.lit("{post_id}"), pid.cast("string"))
    return ids.select(
        pid.cast("long").alias("post_id"), between(d("user"), 1, max_user_id).alias("user_id"),
        F.replace(text, F.lit("{tags}"), tags).alias("content"),
        pick(d("location"), LOCATIONS).alias("location"),
        between(d("like_count"), 0, 10000).alias("like_count"),
        between(d("comment_count"), 0, 1000).alias("comment_count"),
        between(d("share_count"), 0, 100).alias("share_count"),
        chance(d("deleted"), 0.05).alias("is_deleted"),
        moment_before(as_of, d("created"), days).alias("created_at"))


def plain_users(ids: DataFrame, seed: int = 42, key: str = "user_id", token_length: int = 36,
                limits: tuple[int, int, int] = (1000, 500, 100)) -> DataFrame:
    """User rows of the SQL loaders: numbered names and texts, counters below `limits`.

    The name carries the first `token_length` characters of a uuid; 8 gives the short form.
    """
    uid = F.col(key)
    number = uid.cast("string")

    def handle(stream):
        token = F.substring(uuid_text(F.lit(f"{seed}/{stream}"), uid), 1, token_length)
        return F.concat(F.lit("user_"), number, F.lit("_"), token)

    counters = [between(draw(uid, f"plain/{name}", seed), 0, top - 1).alias(name) for name, top in zip(
        ["follower_count", "following_count", "post_count"], limits)]
    return ids.select(
        uid.cast("long").alias("user_id"), handle("username").alias("username"),
        F.concat(handle("email"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("User "), number).alias("full_name"),
        F.concat(F.lit("Bio for user "), number).alias("bio"), *counters)


def plain_posts(ids: DataFrame, max_user_id: int | Column, as_of: Column, seed: int = 42, key: str = "post_id",
                days: int = 390, tags: str = "#social", odds: tuple[float, float] = (0.4, 0.7)) -> DataFrame:
    """Post rows of the SQL loaders: numbered text and one of three cities."""
    pid = F.col(key)
    return ids.select(
        pid.cast("long").alias("post_id"), between(draw(pid, "plain/user", seed), 1, max_user_id).alias("user_id"),
        F.concat(F.lit("Post content #"), pid.cast("string"), F.lit(f" with some hashtags {tags}")).alias("content"),
        weighted_location(pid, *odds, seed).alias("location"),
        moment_before(as_of, draw(pid, "plain/created", seed), days).alias("created_at"))


def plain_comments(ids: DataFrame, max_post_id: int | Column, max_user_id: int | Column, as_of: Column,
                   seed: int = 42, key: str = "comment_id", days: int = 120) -> DataFrame:
    """Comment rows of the SQL loaders, all with the same text."""
    cid = F.col(key)
    return ids.select(
        cid.cast("long").alias("comment_id"), between(draw(cid, "plain/post", seed), 1, max_post_id).alias("post_id"),
        between(draw(cid, "plain/user", seed), 1, max_user_id).alias("user_id"),
        F.lit("Great post! #awesome #love").alias("content"),
        moment_before(as_of, draw(cid, "plain/created", seed), days).alias("created_at"))


def weighted_location(row_id: Column, first_odds: float, second_odds: float, seed: int = 42) -> Column:
    """One of three cities by CASE; each branch makes its own draw, as the SQL loaders do."""
    one = chance(draw(row_id, "location/1", seed), first_odds)
    two = chance(draw(row_id, "location/2", seed), second_odds)
    return F.when(one, LOCATIONS[0]).when(two, LOCATIONS[1]).otherwise(LOCATIONS[2])


def comments(ids: DataFrame, max_post_id: int | Column, max_user_id: int | Column, as_of: Column,
             seed: int = 42, key: str = "comment_id", days: int = 30) -> DataFrame:
    """Comment rows; 5 % deleted, up to `days` old."""
    cid = F.col(key)

    def d(stream):
        return draw(cid, f"comments/{stream}", seed)

    return ids.select(
        cid.cast("long").alias("comment_id"), between(d("post"), 1, max_post_id).alias("post_id"),
        between(d("user"), 1, max_user_id).alias("user_id"),
        pick(d("text"), COMMENT_TEXTS).alias("content"),
        between(d("like_count"), 0, 1000).alias("like_count"),
        chance(d("deleted"), 0.05).alias("is_deleted"),
        moment_before(as_of, d("created"), days).alias("created_at"))


def follow_candidates(ids: DataFrame, max_user_id: int | Column, as_of: Column, seed: int = 42,
                      key: str = "id", days: int = 60) -> DataFrame:
    cid = F.col(key)
    return ids.select(
        between(draw(cid, "follows/from", seed), 1, max_user_id).alias("follower_id"),
        between(draw(cid, "follows/to", seed), 1, max_user_id).alias("following_id"),
        moment_before(as_of, draw(cid, "follows/created", seed), days).alias("created_at"))


def followers(ids: DataFrame, max_user_id: int | Column, as_of: Column, count: int | None = None,
              seed: int = 42, key: str = "id", days: int = 60) -> DataFrame:
    """Distinct edges without self-follows from one candidate per id.

    `count` keeps that many of them, in random order, by dense row numbers, so no single task
    or driver holds the kept rows.
    """
    edges = latest_moment(not_self(follow_candidates(ids, max_user_id, as_of, seed, key, days)),
                          ["follower_id", "following_id"])
    if count is None:
        return edges
    return _keep(edges, ["follower_id", "following_id"], count, "_n").drop("_n")


def _keep(pairs: DataFrame, key: list[str], count: int, name: str) -> DataFrame:
    """Number the rows in random but repeatable order and keep the first `count`."""
    turned = pairs.withColumn("_turn", F.xxhash64(*key))
    return number_rows(turned, ["_turn", *key], name).filter(F.col(name) <= count).drop("_turn")


def likes(ids: DataFrame, max_post_id: int | Column, max_user_id: int | Column, as_of: Column,
          count: int | None = None, seed: int = 42, key: str = "id", days: int = 30) -> DataFrame:
    """Distinct (post, user) likes with dense like ids; `count` keeps that many, in random order."""
    cid = F.col(key)
    candidates = ids.select(
        between(draw(cid, "likes/post", seed), 1, max_post_id).alias("post_id"),
        between(draw(cid, "likes/user", seed), 1, max_user_id).alias("user_id"),
        moment_before(as_of, draw(cid, "likes/created", seed), days).alias("created_at"))
    pairs = latest_moment(candidates, ["post_id", "user_id"])
    key = ["post_id", "user_id"]
    numbered = number_rows(pairs, key, "like_id") if count is None else _keep(pairs, key, count, "like_id")
    return numbered.select("like_id", "post_id", "user_id", "created_at")


def _distinct_pair(number: Column, firsts: int | Column, seconds: int | Column, stream: str,
                   seed: int) -> tuple[Column, Column]:
    """The first (1..firsts) and the turn (0..seconds - 1) of the pair with this number; numbers start at 1.

    Each round of `firsts` numbers takes every first once, from a drawn start; a first's turns follow each other from
    a start drawn for it. So different numbers give different pairs, without a shuffle. A number beyond the pairs
    there are raises an error.
    """
    a, b = [(n if isinstance(n, Column) else F.lit(n)).cast("long") for n in (firsts, seconds)]
    at = F.when(number.between(F.lit(1), a * b), number.cast("long") - 1).otherwise(
        F.raise_error(F.lit("more pairs asked for than there are")).cast("long"))
    turn = F.call_function("div", at, a)
    first = (at % a + draw(turn, f"{stream}/turn", seed) % a) % a + 1
    return first, (turn + draw(first, f"{stream}/start", seed) % b) % b


def exact_followers(ids: DataFrame, max_user_id: int | Column, as_of: Column, seed: int = 42, key: str = "id",
                    days: int = 60) -> DataFrame:
    """One edge per id, all different and none to oneself; ids are 1..n, n at most max_user_id * (max_user_id - 1)."""
    total = (max_user_id if isinstance(max_user_id, Column) else F.lit(max_user_id)).cast("long")
    follower, turn = _distinct_pair(F.col(key), total, total - 1, "follows", seed)
    edges = ids.select(key, follower.alias("follower_id"), turn.alias("_turn"))
    return edges.select("follower_id", ((F.col("follower_id") + F.col("_turn")) % total + 1).alias("following_id"),
                        moment_before(as_of, draw(F.col(key), "follows/created", seed), days).alias("created_at"))


def exact_likes(ids: DataFrame, max_post_id: int | Column, max_user_id: int | Column, as_of: Column, seed: int = 42,
                key: str = "id", days: int = 30) -> DataFrame:
    """One like per id, all different, with the id as like id; ids are 1..n, n at most max_post_id * max_user_id."""
    post, turn = _distinct_pair(F.col(key), max_post_id, max_user_id, "likes", seed)
    return ids.select(F.col(key).cast("long").alias("like_id"), post.alias("post_id"), (turn + 1).alias("user_id"),
                      moment_before(as_of, draw(F.col(key), "likes/created", seed), days).alias("created_at"))


PAIR_ROUNDS = 4


def _permuted_pair(ids: DataFrame, number: Column, firsts: int | Column, seconds: int | Column, stream: str,
                   seed: int) -> DataFrame:
    """`ids` with `_first` (0..firsts - 1) and `_second` (0..seconds - 1) of the pair with this number; numbers start at 1.

    A keyed permutation of all pairs: the number's quotient and remainder are shifted in turn, each by a draw
    that follows from the other. Every shift can be undone, so different numbers give different pairs, for any two sizes and without
    a shuffle. A number beyond the pairs there are raises an error.
    """
    a, b = [(n if isinstance(n, Column) else F.lit(n)).cast("long") for n in (firsts, seconds)]
    at = F.when(number.between(F.lit(1), a * b), number.cast("long") - 1).otherwise(
        F.raise_error(F.lit("more pairs asked for than there are")).cast("long"))
    pairs = ids.withColumn("_at", at)
    pairs = pairs.withColumn("_first", F.call_function("div", F.col("_at"), b)).withColumn("_second", F.col("_at") % b)
    for n in range(PAIR_ROUNDS):
        # Remainders are taken first, so that no sum can overflow.
        pairs = pairs.withColumn("_first", (F.col("_first") + draw(F.col("_second"), f"{stream}/first{n}", seed) % a) % a)
        pairs = pairs.withColumn("_second", (F.col("_second") + draw(F.col("_first"), f"{stream}/second{n}", seed) % b) % b)
    return pairs.drop("_at")


def random_followers(ids: DataFrame, max_user_id: int | Column, as_of: Column, seed: int = 42, key: str = "id",
                     days: int = 60) -> DataFrame:
    """One edge per id, all different and none to oneself, spread like random draws; ids as in `exact_followers`."""
    total = (max_user_id if isinstance(max_user_id, Column) else F.lit(max_user_id)).cast("long")
    pairs = _permuted_pair(ids.select(key), F.col(key), total, total - 1, "follows", seed)
    return pairs.select((F.col("_first") + 1).alias("follower_id"),
                        ((F.col("_first") + 1 + F.col("_second")) % total + 1).alias("following_id"),
                        moment_before(as_of, draw(F.col(key), "follows/created", seed), days).alias("created_at"))


def random_likes(ids: DataFrame, max_post_id: int | Column, max_user_id: int | Column, as_of: Column, seed: int = 42,
                 key: str = "id", days: int = 30) -> DataFrame:
    """One like per id, all different, spread like random draws, with the id as like id; ids as in `exact_likes`."""
    pairs = _permuted_pair(ids.select(key), F.col(key), max_post_id, max_user_id, "likes", seed)
    return pairs.select(F.col(key).cast("long").alias("like_id"), (F.col("_first") + 1).alias("post_id"),
                        (F.col("_second") + 1).alias("user_id"),
                        moment_before(as_of, draw(F.col(key), "likes/created", seed), days).alias("created_at"))


def sample_parent(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str,
                  name: str, seed: int = 42) -> DataFrame:
    """Give each child a random existing parent.

    Parents get dense numbers once, each child draws a number, and an equi-join on the evenly
    spread numbers replaces the per-row random lookup. Without parents there are no rows.
    """
    numbered = number_rows(parents.select(F.col(parent_key).alias(name)).distinct(), [name], "_slot_no", start=0)
    total = numbered.select(F.count(F.lit(1))).scalar()
    drawn = draw(F.col(child_key), f"parent/{name}", seed) % F.nullif(total, F.lit(0).cast("long"))
    return children.withColumn("_slot_no", drawn).join(numbered, "_slot_no").drop("_slot_no")

