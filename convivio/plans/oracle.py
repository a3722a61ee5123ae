"""The same queries as ANSI SQL over the raw tables, for an independent check in DuckDB.

Social tables are spelled out as CTEs. The generators need the draw function; `drawn_sql` states
the public xxHash64 steps for one 64-bit value as exact integer arithmetic.
"""

from __future__ import annotations

import re

from ..functions.draws import BASE36, stream_key
from ..operators import generate
from ..operators.experiments import PENDING_READING, READINGS

# --- the social tables -------------------------------------------------------------------------

TABLES = {
    "n_users": "SELECT count(*) AS n FROM customer",
    "users": "SELECT c_custkey AS user_id, c_name AS username, c_mktsegment AS full_name FROM customer",
    "user_counters": """SELECT c_custkey AS user_id, c_name AS username,
        CAST(floor(abs(c_acctbal) / 1000) AS BIGINT) AS post_count FROM customer""",
    "accounts": """SELECT s_suppkey AS user_id, s_name AS username,
        CAST(floor(abs(s_acctbal)) AS BIGINT) AS follower_count,
        CAST(floor(abs(s_acctbal)) AS BIGINT) % 7 AS following_count FROM supplier""",
    "posts": """SELECT o_orderkey AS post_id, o_custkey AS user_id, o_orderpriority AS location,
        CAST(floor(o_totalprice / 100) AS BIGINT) AS like_count, o_orderdate AS created_at FROM orders""",
    "like_candidates": """SELECT l_orderkey AS post_id, l_partkey % (SELECT n FROM n_users) AS user_id,
        l_shipdate AS created_at FROM lineitem""",
    "post_likes": """SELECT post_id * (SELECT count(*) FROM customer) + user_id AS like_id, post_id, user_id,
        max(created_at) AS created_at FROM like_candidates GROUP BY post_id, user_id""",
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "comments": """SELECT event_id AS comment_id, k AS post_id, user_id, event_type AS content,
        ts AS created_at FROM ev""",
    "follow_candidates": "SELECT user_id AS follower_id, k AS following_id, ts AS created_at FROM ev",
    "followers": """SELECT follower_id, following_id, max(created_at) AS created_at FROM follow_candidates
        WHERE follower_id <> following_id GROUP BY follower_id, following_id""",
    "stored_edges": """SELECT l_suppkey AS follower_id, l_partkey % (SELECT n FROM n_users) AS following_id,
        max(l_shipdate) AS created_at FROM lineitem GROUP BY 1, 2""",
    "requests": "SELECT event_id AS request_id, user_id AS follower_id, k AS following_id, ts AS moment FROM ev",
    "judged": """SELECT r.*, CASE WHEN f.user_id IS NOT NULL AND g.user_id IS NOT NULL
            AND e.follower_id IS NULL
            AND r.request_id = min(r.request_id) OVER (PARTITION BY r.follower_id, r.following_id)
            THEN 'COMMITTED' ELSE 'ABORTED' END AS status
        FROM requests r LEFT JOIN accounts f ON r.follower_id = f.user_id
        LEFT JOIN accounts g ON r.following_id = g.user_id
        LEFT JOIN stored_edges e ON r.follower_id = e.follower_id AND r.following_id = e.following_id""",
    "samples": """SELECT event_type AS grp, event_id AS seq, value AS latency_ms,
        (event_type <> 'error' OR value < 300) AS ok FROM events""",
    "runs": """SELECT user_id AS series, CASE WHEN event_type IN ('click', 'view') THEN 'on' ELSE 'off' END AS mode,
        CAST(value AS DECIMAL(12, 3)) AS elapsed_ms, 97 AS inserted_rows FROM events""",
    "tx_id": "SELECT event_id, {uuid_tx} AS tx_id, event_type, ts, value FROM events",
    "transaction_events": """SELECT tx_id, event_id * 2 AS seq, 'PREPARED' AS status, ts AS moment FROM tx_id
        UNION ALL SELECT tx_id, event_id * 2 + 1, CASE WHEN event_type = 'error' THEN 'ABORTED' ELSE 'COMMITTED' END,
        ts + to_seconds(CAST(floor(value) AS BIGINT)) FROM tx_id WHERE event_type <> 'signup'""",
    "transactions": """SELECT tx_id, max_by(status, seq) AS status, min(moment) AS created_at,
        CASE WHEN max_by(status, seq) IN ('COMMITTED', 'ABORTED') THEN max(moment) END AS completed_at
        FROM transaction_events GROUP BY tx_id""",
    "sagas": """SELECT 'saga-' || o_orderkey AS saga_id,
        CASE o_orderstatus WHEN 'O' THEN 'COMPLETED' WHEN 'F' THEN 'COMPENSATED' ELSE 'STARTED' END AS saga_status,
        CASE WHEN o_orderstatus = 'O' THEN 'DONE' WHEN o_orderstatus = 'F' THEN 'ROLLBACK_DONE'
             WHEN o_orderkey % 3 = 0 THEN 'CREATE_POST' WHEN o_orderkey % 3 = 1 THEN 'UPDATE_COUNTERS'
             ELSE 'SEND_NOTIFICATION' END AS step_name,
        o_orderkey AS post_id, o_custkey AS user_id,
        (o_orderstatus <> 'P' OR o_orderkey % 3 > 0) AS counted,
        o_orderdate + to_seconds(1) AS created_at,
        o_orderdate + to_seconds(CASE WHEN o_orderstatus = 'P' THEN o_orderkey % 3 + 1 ELSE 4 END) AS updated_at
        FROM orders""",
    "commands": """SELECT doc_id AS post_id, doc_id % (SELECT n FROM n_users) AS user_id, text AS content,
        TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS created_at FROM documents""",
    "folded": """SELECT k AS post_id, min_by(user_id, event_id) AS user_id, max_by(event_type, event_id) AS content,
        min_by(ts, event_id) AS created_at, max_by(ts, event_id) AS indexed_at,
        min(event_id) AS first_event_id, max(event_id) AS last_event_id FROM ev GROUP BY k""",
    "pending_folded": """SELECT k AS post_id, min_by(user_id, event_id) AS user_id,
        max_by(event_type, event_id) AS content, min_by(ts, event_id) AS created_at,
        max_by(ts, event_id) AS indexed_at, min(event_id) AS first_event_id, max(event_id) AS last_event_id
        FROM ev WHERE event_type <> 'view' GROUP BY k""",
    "like_requests": "SELECT event_id AS request_id, k AS post_id, user_id, ts AS moment FROM ev",
    "new_likes": """SELECT post_id, user_id, min(moment) AS created_at FROM like_requests r
        WHERE NOT EXISTS (SELECT 1 FROM post_likes l WHERE l.post_id = r.post_id AND l.user_id = r.user_id)
        AND user_id IN (SELECT s_suppkey FROM supplier)
        GROUP BY post_id, user_id""",
    "ranked": """SELECT grp, latency_ms, row_number() OVER (PARTITION BY grp ORDER BY latency_ms) - 1 AS r,
        count(*) OVER (PARTITION BY grp) AS n FROM samples WHERE ok""",
    "ranks": """SELECT grp, max(CASE WHEN r = n // 2 THEN latency_ms END) AS median,
        max(CASE WHEN r = least(n - 1, CAST(floor(n * 0.95::DOUBLE) AS BIGINT)) THEN latency_ms END) AS p95,
        max(CASE WHEN r = least(n - 1, CAST(floor(n * 0.99::DOUBLE) AS BIGINT)) THEN latency_ms END) AS p99
        FROM ranked GROUP BY grp""",
    "sample_facts": """SELECT grp, count(*) FILTER (WHERE ok) AS count, count(*) AS requested_iterations,
        count(*) FILTER (WHERE NOT ok) AS error_count, min(latency_ms) FILTER (WHERE ok) AS min,
        max(latency_ms) FILTER (WHERE ok) AS max, round(avg(latency_ms) FILTER (WHERE ok), 9) AS mean,
        round(stddev_pop(latency_ms) FILTER (WHERE ok), 9) AS std_dev FROM samples GROUP BY grp""",
    "mode_costs": """SELECT series, CAST(sum(elapsed_ms) FILTER (WHERE mode = 'on') AS DOUBLE) / sum(inserted_rows) FILTER (WHERE mode = 'on') AS on_ms,
        CAST(sum(elapsed_ms) FILTER (WHERE mode = 'off') AS DOUBLE) / sum(inserted_rows) FILTER (WHERE mode = 'off') AS off_ms
        FROM runs GROUP BY series""",
    "lowest": "SELECT user_id, username, user_id % 3 AS shard FROM users ORDER BY user_id LIMIT 50",
    "cross_pair": """SELECT a.user_id AS follower_id, a.username AS follower_name, a.shard AS follower_shard,
        b.user_id AS following_id, b.username AS following_name, b.shard AS following_shard
        FROM lowest a JOIN lowest b ON a.user_id <> b.user_id AND a.shard <> b.shard
        ORDER BY a.user_id, b.user_id LIMIT 1""",
}


def _uuid(text: str) -> str:
    digest = f"sha256({text})"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {at}, {size})" for at, size in cuts)


TABLES["tx_id"] = TABLES["tx_id"].replace("{uuid_tx}", _uuid("'tx:' || event_id"))


def _with_tables(sql: str) -> str:
    """Prefix the CTEs that the query mentions, directly or through another CTE."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(TABLES[name])

    visit(sql)
    if not needed:
        return sql
    body = ", ".join(f"{name} AS ({TABLES[name]})" for name in TABLES if name in needed)
    return f"WITH {body} {sql}"


# --- the draw function -------------------------------------------------------------------------

_MOD = 2**64
# The five 64-bit primes of the public xxHash64 specification.
_P1, _P2, _P3, _P4, _P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                           0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def _hash_constant(value: int, seed: int) -> int:
    """xxHash64 of one 64-bit integer, for the constant first argument of a draw."""
    def rotate(v, n):
        return ((v << n) | (v >> (64 - n))) % _MOD

    h = (seed + _P5 + 8) % _MOD
    h ^= rotate(value * _P2 % _MOD, 31) * _P1 % _MOD
    h = (rotate(h, 27) * _P1 + _P4) % _MOD
    h = (h ^ (h >> 33)) * _P2 % _MOD
    h = (h ^ (h >> 29)) * _P3 % _MOD
    return h ^ (h >> 32)


def drawn_sql(row_id: str, stream: str, seed: int = 42) -> str:
    """The draw of a non-negative row id, as a BIGINT expression."""
    start = (_hash_constant(stream_key(stream, seed), 42) + _P5 + 8) % _MOD

    def big(n):
        return f"{n}::UHUGEINT"

    def times(v, p):
        return f"(({v}) * {big(p)} % {big(_MOD)})"

    def rotate(v, n):
        return f"(({v} * {big(2**n)}) % {big(_MOD)} + {v} // {big(2**(64 - n))})"

    def mixed(v, n):
        return f"xor({v}, {v} // {big(2**n)})"

    steps = [
        times("v", _P2), f"xor({big(start)}, {times(rotate('v', 31), _P1)})",
        f"(({times(rotate('v', 27), _P1)} + {big(_P4)}) % {big(_MOD)})",
        times(mixed("v", 33), _P2), times(mixed("v", 29), _P3), f"{mixed('v', 32)} // {big(2)}",
    ]
    chained = f"[({row_id})::UHUGEINT]"
    for step in steps:
        chained = f"list_transform({chained}, lambda v: {step})"
    return f"({chained}[1]::BIGINT)"


def _between(d: str, low: int, high: str | int) -> str:
    return f"({d} % (({high}) - {low - 1}) + {low})"


def _pick(d: str, options: list[str]) -> str:
    return f"([{', '.join(_text(o) for o in options)}])[{d} % {len(options)} + 1]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chance(d: str, p: float) -> str:
    return f"({d}::DOUBLE / {2.0**63!r}::DOUBLE < {p}::DOUBLE)"


def _chars(d: str, length: int) -> str:
    return " || ".join(f"substr('{BASE36}', CAST(({d} >> {10 * i}) % 36 + 1 AS BIGINT), 1)" for i in range(length))


def _before(as_of: str, d: str, days: int) -> str:
    return f"TIMESTAMP '{as_of}' - to_seconds({_between(d, 0, days * 86400)})"


def _words(row_id: str, stream: str, words: list[str], size: str) -> str:
    turns = ", ".join(f"{{'turn': {drawn_sql(row_id, f'{stream}/{i}')}, 'word': {_text(w)}}}"
                      for i, w in enumerate(words))
    return (f"array_to_string(list_transform(list_sort([{turns}])[1:{size}], lambda w: w.word), ' ')")


def _place(row_id: str) -> str:
    one, two = _chance(drawn_sql(row_id, "location/1"), 0.4), _chance(drawn_sql(row_id, "location/2"), 0.7)
    names = [_text(place) for place in generate.LOCATIONS[:3]]
    return f"CASE WHEN {one} THEN {names[0]} WHEN {two} THEN {names[1]} ELSE {names[2]} END"


def _permuted(source: str, stream: str) -> str:
    """Pairs (l, r) of the numbers `id` of a source that has the sizes a and b."""
    sql = f"SELECT *, (id - 1) // b AS l, (id - 1) % b AS r FROM ({source})"
    for n in range(generate.PAIR_ROUNDS):
        sql = f"SELECT * REPLACE ((l + {drawn_sql('r', f'{stream}/first{n}')} % a) % a AS l) FROM ({sql})"
        sql = f"SELECT * REPLACE ((r + {drawn_sql('l', f'{stream}/second{n}')} % b) % b AS r) FROM ({sql})"
    return sql


POSTS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-02-01 00:00:00"


def _generators() -> dict[str, str]:
    def u(s):
        return drawn_sql("user_id", f"users/{s}")

    def p(s):
        return drawn_sql("post_id", f"posts/{s}")

    def c(s):
        return drawn_sql("comment_id", f"comments/{s}")

    def e(s):
        return drawn_sql("id", s)

    users = "(SELECT n FROM n_users)"
    posts = "(SELECT count(*) FROM orders)"
    city = f"split_part({_pick(u('city'), generate.LOCATIONS)}, ',', 1)"
    tag_text = _words("post_id", "posts/tag", generate.HASHTAGS, _between(p("tags"), 2, 4))
    post_text = f"replace({_pick(p('text'), generate.POST_TEXTS)}, '{{post_id}}', CAST(post_id AS VARCHAR))"
    return {
        "g1_users": f"""SELECT user_id,
            'user_' || user_id || '_' || {_chars(u('username'), 6)} AS username,
            'user_' || user_id || '_' || {_chars(u('email'), 4)} || '@' || {_pick(u('domain'), generate.EMAIL_DOMAINS)} AS email,
            {_pick(u('first'), generate.FIRST_NAMES)} || ' ' || {_pick(u('last'), generate.LAST_NAMES)} AS full_name,
            replace({_pick(u('bio'), generate.BIOS)}, '{{city}}', {city}) AS bio,
            {_between(u('follower_count'), 0, 100000)} AS follower_count,
            {_between(u('following_count'), 0, 50000)} AS following_count,
            {_between(u('post_count'), 0, 10000)} AS post_count,
            {_chance(u('verified'), 0.05)} AS is_verified, {_chance(u('private'), 0.3)} AS is_private,
            {_before(EVENTS_AS_OF, u('created'), 365)} AS created_at
            FROM (SELECT c_custkey + 1 AS user_id FROM customer)""",
        "g2_posts": f"""SELECT post_id, {_between(p('user'), 1, users)} AS user_id,
            replace({post_text}, '{{tags}}', {tag_text}) AS content,
            {_pick(p('location'), generate.LOCATIONS)} AS location,
            {_between(p('like_count'), 0, 10000)} AS like_count,
            {_between(p('comment_count'), 0, 1000)} AS comment_count,
            {_between(p('share_count'), 0, 100)} AS share_count,
            {_chance(p('deleted'), 0.05)} AS is_deleted, {_before(EVENTS_AS_OF, p('created'), 90)} AS created_at
            FROM (SELECT o_orderkey + 1 AS post_id FROM orders)""",
        "g3_comments": f"""SELECT comment_id, {_between(c('post'), 1, posts)} AS post_id,
            {_between(c('user'), 1, users)} AS user_id, {_pick(c('text'), generate.COMMENT_TEXTS)} AS content,
            {_between(c('like_count'), 0, 1000)} AS like_count, {_chance(c('deleted'), 0.05)} AS is_deleted,
            {_before(EVENTS_AS_OF, c('created'), 30)} AS created_at
            FROM (SELECT event_id + 1 AS comment_id FROM events)""",
        "g1_plain_users": f"""SELECT user_id,
            'user_' || user_id || '_' || {_uuid("'42/username:' || user_id")} AS username,
            'user_' || user_id || '_' || {_uuid("'42/email:' || user_id")} || '@example.com' AS email,
            'User ' || user_id AS full_name, 'Bio for user ' || user_id AS bio,
            {_between(drawn_sql('user_id', 'plain/follower_count'), 0, 999)} AS follower_count,
            {_between(drawn_sql('user_id', 'plain/following_count'), 0, 499)} AS following_count,
            {_between(drawn_sql('user_id', 'plain/post_count'), 0, 99)} AS post_count
            FROM (SELECT c_custkey + 1 AS user_id FROM customer)""",
        "g2_plain_posts": f"""SELECT post_id, {_between(drawn_sql('post_id', 'plain/user'), 1, users)} AS user_id,
            'Post content #' || post_id || ' with some hashtags #social' AS content, {_place('post_id')} AS location,
            {_before(EVENTS_AS_OF, drawn_sql('post_id', 'plain/created'), 390)} AS created_at
            FROM (SELECT o_orderkey + 1 AS post_id FROM orders)""",
        "g3_plain_comments": f"""SELECT comment_id,
            {_between(drawn_sql('comment_id', 'plain/post'), 1, posts)} AS post_id,
            {_between(drawn_sql('comment_id', 'plain/user'), 1, users)} AS user_id,
            'Great post! #awesome #love' AS content,
            {_before(EVENTS_AS_OF, drawn_sql('comment_id', 'plain/created'), 120)} AS created_at
            FROM (SELECT event_id + 1 AS comment_id FROM events)""",
        "g4_followers": f"""SELECT follower_id, following_id, max(created_at) AS created_at FROM (
            SELECT {_between(e('follows/from'), 1, users)} AS follower_id,
                {_between(e('follows/to'), 1, users)} AS following_id,
                {_before(EVENTS_AS_OF, e('follows/created'), 60)} AS created_at
            FROM (SELECT event_id + 1 AS id FROM events))
            WHERE follower_id <> following_id GROUP BY follower_id, following_id""",
        "g5_likes": f"""SELECT row_number() OVER (ORDER BY post_id, user_id) AS like_id, post_id, user_id,
            max(created_at) AS created_at FROM (
            SELECT {_between(e('likes/post'), 1, '(SELECT count(*) FROM supplier)')} AS post_id, {_between(e('likes/user'), 1, users)} AS user_id,
                {_before(EVENTS_AS_OF, e('likes/created'), 30)} AS created_at
            FROM (SELECT o_orderkey + 1 AS id FROM orders)) GROUP BY post_id, user_id""",
        "g4_exact": f"""SELECT follower_id, (follower_id + (turn + {drawn_sql('follower_id', 'follows/start')} % (n - 1)) % (n - 1)) % n + 1
                AS following_id, {_before(EVENTS_AS_OF, e('follows/created'), 60)} AS created_at FROM (
            SELECT *, ((id - 1) % n + {drawn_sql('turn', 'follows/turn')} % n) % n + 1 AS follower_id FROM (
                SELECT event_id + 1 AS id, event_id // n AS turn, n FROM n_users, events))""",
        "g5_exact": f"""SELECT id AS like_id, post_id, (turn + {drawn_sql('post_id', 'likes/start')} % n) % n + 1 AS user_id,
                {_before(EVENTS_AS_OF, e('likes/created'), 30)} AS created_at FROM (
            SELECT *, ((id - 1) % m + {drawn_sql('turn', 'likes/turn')} % m) % m + 1 AS post_id FROM (
                SELECT event_id + 1 AS id, event_id // m AS turn, n, m
                FROM n_users, (SELECT count(*) AS m FROM supplier), events))""",
        "g4_random": f"""SELECT l + 1 AS follower_id, (l + 1 + r) % a + 1 AS following_id,
                {_before(EVENTS_AS_OF, e('follows/created'), 60)} AS created_at FROM (
            {_permuted("SELECT event_id + 1 AS id, n AS a, n - 1 AS b FROM n_users, events", "follows")})""",
        "g5_random": f"""SELECT id AS like_id, l + 1 AS post_id, r + 1 AS user_id,
                {_before(EVENTS_AS_OF, e('likes/created'), 30)} AS created_at FROM (
            {_permuted("SELECT event_id + 1 AS id, m AS a, n AS b FROM n_users, (SELECT count(*) AS m FROM supplier), events", "likes")})""",
        "g6_random_time": f"SELECT user_id, {_before(EVENTS_AS_OF, drawn_sql('user_id', 'time'), 90)} AS at FROM users",
        "g7_tag_sample": f"""SELECT post_id, {_words('post_id', 'tag', generate.HASHTAGS,
            _between(drawn_sql('post_id', 'size'), 2, 4))} AS tags FROM posts""",
        "g8_fk_sample": f"""SELECT c.post_id, p.account_id FROM (
            SELECT post_id, {drawn_sql('post_id', 'parent/account_id')} % (SELECT count(*) FROM accounts) AS slot FROM posts) c
            JOIN (SELECT user_id * 7 + 3 AS account_id, row_number() OVER (ORDER BY user_id) - 1 AS slot
                  FROM accounts) p USING (slot)""",
        "t7_random_row": f"SELECT user_id, username, full_name FROM users ORDER BY {drawn_sql('user_id', 'sample')}, user_id LIMIT 1",
        "f11_case_draws": f"SELECT post_id, {_place('post_id')} AS place FROM posts",
        "fn_strings": f"""SELECT user_id, 'user_' || user_id || '_' || username AS joined, substr(username, 1, 8) AS head,
            replace(username, '#', '_') AS replaced, format('{{}}_{{}}_{{}}', 'run', 'on', user_id) AS formatted,
            upper(full_name) AS upper_name, lower(full_name) AS lower_name, username AS first_item,
            username || ' ' || user_id AS listed, {_chars(drawn_sql('user_id', 'token'), 6)} AS token,
            {_uuid("'42:' || user_id")} AS uuid FROM users""",
    }


# --- everything else ---------------------------------------------------------------------------

_STATS = """SELECT {columns}, count(DISTINCT p.post_id) AS num_posts, count(DISTINCT pl.like_id) AS num_likes,
    count(DISTINCT f.follower_id) AS num_followers
    FROM users u LEFT JOIN posts p ON u.user_id = p.user_id LEFT JOIN {likes} pl ON p.post_id = pl.post_id
    LEFT JOIN {followers} f ON u.user_id = f.following_id {where} GROUP BY u.user_id, u.username"""


def _stats(where: str = "", likes: str = "post_likes", followers: str = "followers") -> str:
    return _STATS.format(columns="u.user_id, u.username", where=where, likes=likes, followers=followers)


_POST_COUNTS = """SELECT u.user_id, u.username, count(p.post_id) AS post_count
    FROM users u LEFT JOIN posts p ON u.user_id = p.user_id {where} GROUP BY u.user_id, u.username"""
_DAILY = """SELECT CAST(created_at AS DATE) AS creation_date, count(*) AS num_posts,
    avg(like_count) AS avg_likes FROM posts {where} GROUP BY 1 ORDER BY 1 DESC"""
_READ_MODEL = "SELECT * FROM pending_folded"
_UPSERTED = """SELECT coalesce(p.post_id, f.post_id) AS post_id, coalesce(p.user_id, f.user_id) AS user_id,
        coalesce(f.content, p.location) AS content, coalesce(p.created_at, f.created_at) AS created_at,
        coalesce(f.indexed_at, p.created_at) AS indexed_at,
        CASE WHEN p.post_id IS NULL THEN f.first_event_id ELSE -1 END AS first_event_id,
        coalesce(f.last_event_id, -1) AS last_event_id
        FROM posts p FULL JOIN {folded} f ON p.post_id = f.post_id"""
_RECENT = f"WHERE created_at >= TIMESTAMP '{POSTS_AS_OF}' - INTERVAL 30 DAY"
_SAMPLE_STATS = """SELECT f.grp AS "group", count, requested_iterations, error_count, min, max, mean, median, p95, p99,
    std_dev FROM sample_facts f LEFT JOIN ranks USING (grp)"""
_BY_USER = "SELECT CAST(user_id AS VARCHAR) AS grp, event_id AS seq, value AS latency_ms, value < 300 AS ok FROM events"
_MODES = """SELECT series, round_even(on_ms, 4) AS sync_per_insert_ms, round_even(off_ms, 4) AS async_per_insert_ms,
    round_even(CASE WHEN coalesce({on}, 0) = 0 THEN 0 ELSE ({on} - {off}) / {on} * 100 END, 2) + 0.0 AS async_improvement_pct
    FROM mode_costs"""
_SUMMARY = """SELECT * FROM (
    SELECT 'exp1' AS experiment, true AS available, 'ok' AS status, 'write_mean_ms' AS metric,
        avg(latency_ms) FILTER (WHERE grp = 'click') AS value FROM samples
    UNION ALL SELECT 'exp1', true, 'ok', 'read_primary_mean_ms', avg(latency_ms) FILTER (WHERE grp = 'purchase') FROM samples
    UNION ALL SELECT 'exp1', true, 'ok', 'read_replica1_mean_ms', avg(latency_ms) FILTER (WHERE grp = 'signup') FROM samples
    UNION ALL SELECT 'exp1', true, 'ok', 'read_replica2_mean_ms', 0 FROM n_users
    UNION ALL SELECT 'exp3', true, 'ok', 'sync_per_insert_ms', round_even(on_ms, 4) FROM all_costs
    UNION ALL SELECT 'exp3', true, 'ok', 'async_per_insert_ms', round_even(off_ms, 4) FROM all_costs
    UNION ALL SELECT 'exp3', true, 'ok', 'async_improvement_pct', round_even((on_ms - off_ms) / on_ms * 100, 2) FROM all_costs
    UNION ALL SELECT 'exp2', false, 'pending', NULL, NULL FROM n_users
    UNION ALL SELECT 'exp4', true, lower(max_by(status, seq)), 'elapsed_ms',
        (epoch_us(max(moment)) - epoch_us(min(moment))) / 1000 FROM transaction_events
    UNION ALL SELECT 'exp4', true, (SELECT lower(max_by(status, seq)) FROM transaction_events), 'source_shard',
        follower_shard FROM cross_pair
    UNION ALL SELECT 'exp4', true, (SELECT lower(max_by(status, seq)) FROM transaction_events), 'target_shard',
        following_shard FROM cross_pair
    UNION ALL SELECT 'exp5', true, 'dry-run', 'replica_count', count(DISTINCT user_id % 3) FROM accounts
    UNION ALL SELECT 'exp6', false, 'pending', NULL, NULL FROM n_users)"""
TABLES["all_costs"] = """SELECT CAST(sum(elapsed_ms) FILTER (WHERE mode = 'on') AS DOUBLE) / sum(inserted_rows) FILTER (WHERE mode = 'on') AS on_ms,
    CAST(sum(elapsed_ms) FILTER (WHERE mode = 'off') AS DOUBLE) / sum(inserted_rows) FILTER (WHERE mode = 'off') AS off_ms FROM runs"""


_READ_SUMMARY = f"""SELECT experiment, available, status, CASE experiment
    {" ".join(f"WHEN {_text(name)} THEN {_text(text)}" for name, text in READINGS.items())}
    ELSE experiment || {_text(PENDING_READING)} END AS interpretation, metric, round(value, 4) AS value FROM ({_SUMMARY})"""


def _violations(table: str, rule: str, test: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS violations "
            f"FROM {source}")


def _repeats(table: str, keys: str, source: str) -> str:
    return (f"SELECT '{table}', 'unique({keys})', count(*) FROM "
            f"(SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)")


def _orphans(link: str, child: str, column: str, parent: str) -> str:
    return (f"SELECT '{link}' AS link, count(DISTINCT c.{column}) AS orphan_keys, count(*) AS orphan_rows "
            f"FROM {child} c WHERE c.{column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.user_id = c.{column})")


def _placed(table: str, key: str) -> str:
    return f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS partition_name, count(*) AS row_count FROM {table} GROUP BY 1, 2"


_GONE = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"

PLAIN = {
    "s1_scan": "SELECT user_id, username FROM users",
    "s2_append": """SELECT user_id, count(*) AS row_count FROM (SELECT user_id FROM posts
        UNION ALL SELECT user_id FROM comments) GROUP BY user_id""",
    "s2_row_counts": """SELECT batch, "rows", sum("rows") OVER ()::BIGINT AS rows_read FROM (
        SELECT 'posts' AS batch, count(*) AS "rows" FROM posts UNION ALL SELECT 'likes', count(*) FROM post_likes)""",
    "s3_insert_select": """SELECT post_id, user_id, 'Post content #' || post_id AS content, location, like_count,
        created_at FROM posts""",
    "s4_csv_sink": "SELECT * FROM users",
    "s4_csv_texts": "SELECT doc_id, text, lang FROM documents",
    "s5_json_sink":"SELECT comment_id, post_id, user_id, content FROM comments",
    "s6_result_documents": """SELECT grp AS "group", count AS n, error_count AS errors, median, p95,
        true AS from_json_file FROM sample_facts JOIN ranks USING (grp)""",
    "s6_expected_documents": """SELECT * FROM (VALUES ('exp1', true, false, 'ok'), ('exp3', false, false, 'pending'),
        ('exp4', false, true, 'pending')) AS v(experiment, available, broken, status)
        WHERE EXISTS (SELECT 1 FROM samples WHERE grp IN ('click', 'error'))""",
    "s7_series": "SELECT user_id + 1 AS n, username FROM users",
    "s8_hash_layout": "SELECT user_id, username, user_id % 3 AS shard FROM users",
    "s9_month_layout": """SELECT strftime(created_at, '%Y%m') AS created_month, count(*) AS row_count,
        CAST(sum(like_count) AS BIGINT) AS likes FROM posts GROUP BY 1""",
    "s10_provenance": "SELECT 'shard=' || (user_id % 3) AS partition_name, count(*) AS row_count FROM users GROUP BY 1",
    "s11_summary_sink": _READ_SUMMARY,
    "f1_point_lookup": "SELECT * FROM users WHERE user_id = 1",
    "f1_pruned_lookup": "SELECT * FROM users WHERE user_id = 1",
    "f2_text_lookup": """SELECT u.user_id, u.username, u.full_name, count(p.post_id) AS post_count FROM users u
        LEFT JOIN posts p ON u.user_id = p.user_id WHERE u.username = 'Customer#000000007' GROUP BY ALL""",
    "f2_filtered_lookup": """SELECT u.user_id, u.username, u.full_name, count(p.post_id) AS post_count FROM users u
        LEFT JOIN posts p ON u.user_id = p.user_id WHERE u.username = 'Customer#000000007' GROUP BY ALL""",
    "f3_key_range": _stats("WHERE u.user_id BETWEEN 1 AND 100"),
    "f4_in_list": "SELECT * FROM user_counters WHERE user_id IN (1, 2)",
    "f5_like": """SELECT * FROM users WHERE username LIKE 'Customer#00000001%'
        OR username LIKE 'Customer_00000012_%' OR username LIKE '%7_9'""",
    "f6_not_self": "SELECT * FROM follow_candidates WHERE follower_id <> following_id",
    "f7_recent": f"SELECT * FROM posts {_RECENT}",
    "f7_recent_pruned": f"SELECT * FROM posts {_RECENT}",
    "f8_not_null": "SELECT * FROM comments WHERE content <> 'view' AND post_id IS NOT NULL AND user_id IS NOT NULL",
    "f9_pending": "SELECT event_id, event_type, k AS aggregate_id FROM ev WHERE event_type <> 'view'",
    "f10_scalar_subquery": _POST_COUNTS.format(
        where="WHERE u.user_id = (SELECT user_id FROM users ORDER BY user_id LIMIT 1)"),
    "f11_case": f"""SELECT post_id, CASE WHEN like_count > 3500 THEN {_text(generate.LOCATIONS[0])}
        WHEN like_count > 1500 THEN {_text(generate.LOCATIONS[1])} ELSE {_text(generate.LOCATIONS[2])} END AS place
        FROM posts""",
    "f12_shard_id": "SELECT user_id, username, mod(user_id, 3) AS shard_id FROM users",
    "f13_status_text": """SELECT o_orderkey AS post_id, CASE o_orderstatus WHEN 'F' THEN 'failed'
        WHEN 'O' THEN 'committed' ELSE 'ok' END AS status FROM orders""",
    "j1_user_posts": _POST_COUNTS.format(where=""),
    "j2_social_stats": _stats(),
    "j1_colocated": _POST_COUNTS.format(where=""),
    "j2_colocated": _stats(),
    "j2_maintained": _stats(),
    "j2_social_stats_distinct": """SELECT u.user_id, u.username,
        (SELECT count(DISTINCT post_id) FROM posts p WHERE p.user_id = u.user_id) AS num_posts,
        coalesce(l.n, 0) AS num_likes, coalesce(f.n, 0) AS num_followers
        FROM users u LEFT JOIN (SELECT p.user_id, count(DISTINCT c.post_id * (SELECT count(*) FROM customer) + c.user_id) AS n
            FROM posts p JOIN like_candidates c ON p.post_id = c.post_id GROUP BY p.user_id) l ON u.user_id = l.user_id
        LEFT JOIN (SELECT following_id, count(DISTINCT follower_id) AS n FROM follow_candidates
            GROUP BY following_id) f ON u.user_id = f.following_id""",
    "j3_cross_shard_pair": "SELECT * FROM cross_pair",
    "j4_shard_matrix": """SELECT follower_id % 3 AS source_shard, following_id % 3 AS target_shard, count(*) AS edges,
        follower_id % 3 <> following_id % 3 AS cross_shard,
        count(*) / (SELECT count(*) FROM followers) AS share FROM followers GROUP BY 1, 2, 4""",
    "j4_cross_shard_share": """SELECT count(*) AS edges, count(*) FILTER (WHERE follower_id % 3 <> following_id % 3) AS cross_edges,
        count(*) FILTER (WHERE follower_id % 3 <> following_id % 3) / count(*) AS cross_share FROM followers""",
    "j5_foreign_keys": " UNION ALL ".join([
        _orphans("posts.user_id", "posts", "user_id", "users"),
        _orphans("comments.user_id", "comments", "user_id", "users"),
        _orphans("post_likes.user_id", "post_likes", "user_id", "users"),
        _orphans("followers.follower_id", "followers", "follower_id", "users"),
        _orphans("followers.following_id", "followers", "following_id", "users"),
        _orphans("requests.follower_id", "requests", "follower_id", "accounts")]),
    "j5_orphan_rows": "SELECT * FROM posts p WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.user_id = p.user_id)",
    "j6_cascade_delete": " UNION ALL ".join(
        [f"SELECT '{t}' AS table_name, count(*) AS rows_left FROM {t} WHERE user_id NOT IN {_GONE}"
         for t in ("posts", "comments", "post_likes")]
        + [f"""SELECT 'followers', count(*) FROM followers WHERE follower_id NOT IN {_GONE}
            AND following_id NOT IN {_GONE}"""]),
    "j7_pair_count": "SELECT count(*) AS relationship_count FROM followers WHERE follower_id = 1 AND following_id = 2",
    "j7_pair_counts": """SELECT r.follower_id, r.following_id, count(e.follower_id) AS relationship_count
        FROM (SELECT DISTINCT follower_id, following_id FROM requests) r LEFT JOIN stored_edges e
        ON r.follower_id = e.follower_id AND r.following_id = e.following_id GROUP BY 1, 2""",
    "a1_posts_of_user": _POST_COUNTS.format(where="WHERE u.user_id = 1"),
    "a2_distinct_counts": """SELECT user_id, count(DISTINCT post_id) AS num_posts, count(DISTINCT content) AS num_contents,
        count(DISTINCT comment_id) AS num_comments FROM comments GROUP BY user_id""",
    "a2_bitmap_counts": """SELECT user_id, count(DISTINCT post_id) AS num_posts, count(DISTINCT comment_id) AS num_comments
        FROM comments GROUP BY user_id""",
    "a3_daily_posts": _DAILY.format(where=""),
    "a3_daily_posts_recent": _DAILY.format(where=_RECENT),
    "a4_row_span": "SELECT count(*) AS total_rows, min(created_at) AS first_write, max(created_at) AS last_write FROM comments",
    "a5_partition_distribution": f"""SELECT *, max(row_count) OVER (PARTITION BY table_name)
        / avg(row_count) OVER (PARTITION BY table_name) AS skew FROM ({" UNION ALL ".join([
            _placed("users", "user_id % 3"), _placed("comments", "comment_id % 3"),
            _placed("post_likes", "user_id % 3"), _placed("followers", "follower_id % 3"),
            _placed("posts", "strftime(created_at, '%Y%m')")])})""",
    "a5_layout_distribution": """SELECT 'shard=' || (user_id % 3) AS partition_name, count(*) AS row_count,
        true AS has_bytes FROM post_likes GROUP BY 1""",
    "a6_group_megabytes": """SELECT lang, count(*) AS num_rows, sum(strlen(text)) / 1048576.0::DOUBLE AS size_mb
        FROM documents GROUP BY lang""",
    "a7_sample_stats": _SAMPLE_STATS,
    "a8_spread": """SELECT grp AS "group", round_even(avg(latency_ms), 2) AS average, round_even(min(latency_ms), 2) AS minimum,
        round_even(max(latency_ms), 2) AS maximum FROM samples GROUP BY grp""",
    "a9_experiment_summary": _READ_SUMMARY,
    "a10_mode_comparison": _MODES.format(on="on_ms", off="off_ms"),
    "a10_mode_comparison_rounded": _MODES.format(on="round_even(on_ms, 4)", off="round_even(off_ms, 4)"),
    "a11_engine_comparison": """SELECT 'write' AS metric, round(avg(latency_ms) FILTER (WHERE grp = 'click'), 9) AS first_ms,
            round(avg(latency_ms) FILTER (WHERE grp = 'signup'), 9) AS second_ms FROM samples
        UNION ALL SELECT 'read', round(avg(latency_ms) FILTER (WHERE grp = 'view'), 9), 15 FROM samples
        UNION ALL SELECT 'join', 300, round(avg(latency_ms) FILTER (WHERE grp = 'view'), 9) FROM samples""",
    "a12_group_sizes": "SELECT saga_status, step_name, count(*) AS row_count FROM sagas GROUP BY 1, 2",
    "w1_keep_latest_likes": "SELECT post_id, user_id, created_at FROM post_likes",
    "w1_keep_latest_follows": """SELECT comment_id, user_id, post_id, content, created_at FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, post_id ORDER BY created_at DESC, comment_id DESC) AS rn FROM comments
        WHERE user_id <> post_id) WHERE rn = 1""",
    "w2_number_rows": "SELECT *, row_number() OVER (ORDER BY username, user_id) AS row_number FROM users",
    "w2_numbered_batches": """SELECT *, 99 + row_number() OVER (
        ORDER BY full_name <> 'BUILDING', username, user_id) AS row_number FROM users""",
    "w2_number_likes": """SELECT post_id, user_id, created_at, row_number() OVER (ORDER BY post_id, user_id) AS like_id
        FROM post_likes""",
    "t1_layout_feed": "SELECT * FROM posts WHERE user_id = 7 ORDER BY created_at DESC, post_id LIMIT 20",
    "t1_user_feed": "SELECT * FROM posts WHERE user_id = 7 ORDER BY created_at DESC, post_id LIMIT 20",
    "t2_all_feeds": """SELECT post_id, user_id, location, like_count, created_at FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY created_at DESC, post_id) AS rn FROM posts) WHERE rn <= 20""",
    "t3_latest": """SELECT *, (epoch_us(completed_at) - epoch_us(created_at)) / 1000 AS duration_ms FROM transactions
        ORDER BY created_at DESC, tx_id LIMIT 10""",
    "t4_oldest_pending": """SELECT event_id, event_type, k AS aggregate_id, ts AS created_at FROM ev
        WHERE event_type <> 'view' ORDER BY event_id LIMIT 100""",
    "t5_first_keys": "SELECT * FROM users ORDER BY user_id LIMIT 50",
    "t6_ordered_limit": _stats() + " ORDER BY u.user_id LIMIT 100",
    "t8_listing": "SELECT content, count(*) AS row_count FROM comments GROUP BY content ORDER BY 2 DESC, 1",
    "m1_insert_ignore": """SELECT * FROM stored_edges UNION ALL
        SELECT follower_id, following_id, min_by(moment, request_id) AS created_at FROM requests r
        WHERE NOT EXISTS (SELECT 1 FROM stored_edges e WHERE e.follower_id = r.follower_id
            AND e.following_id = r.following_id) GROUP BY follower_id, following_id""",
    "m2_upsert": _UPSERTED.format(folded="folded"),
    "m3_counter_apply": """SELECT u.user_id, u.username, u.post_count + count(c.comment_id) AS post_count
        FROM user_counters u LEFT JOIN comments c ON u.user_id = c.user_id GROUP BY u.user_id, u.username, u.post_count""",
    "m2_merged_upsert": _UPSERTED.format(folded="folded"),
    "m3_merged_counters": """SELECT u.user_id, u.username, u.post_count + count(c.comment_id) AS post_count
        FROM user_counters u LEFT JOIN comments c ON u.user_id = c.user_id GROUP BY u.user_id, u.username, u.post_count""",
    "m4_counter_drift": """SELECT p.post_id, like_count AS stored, count(l.like_id) AS actual,
        like_count - count(l.like_id) AS drift FROM posts p LEFT JOIN post_likes l ON p.post_id = l.post_id
        GROUP BY p.post_id, like_count HAVING like_count <> count(l.like_id)""",
    "m4_colocated_drift": """SELECT p.post_id, like_count AS stored, count(l.like_id) AS actual,
        like_count - count(l.like_id) AS drift FROM posts p LEFT JOIN post_likes l ON p.post_id = l.post_id
        GROUP BY p.post_id, like_count HAVING like_count <> count(l.like_id)""",
    "m4_post_counter_drift": """SELECT u.user_id, post_count AS stored, count(p.post_id) AS actual,
        post_count - count(p.post_id) AS drift FROM user_counters u LEFT JOIN posts p ON u.user_id = p.user_id
        GROUP BY u.user_id, post_count HAVING post_count <> count(p.post_id)""",
    "m5_floor_decrement": """SELECT u.user_id, u.username, greatest(u.post_count - count(p.post_id), 0) AS post_count
        FROM user_counters u LEFT JOIN posts p ON u.user_id = p.user_id GROUP BY u.user_id, u.username, u.post_count""",
    "m6_delete_by_key": "SELECT * FROM posts WHERE post_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    "m7_follow_log": f"""SELECT {_uuid("'follow:' || request_id")} AS tx_id, status, follower_id % 3 AS source_shard,
        following_id % 3 AS target_shard, 'ADD_FOLLOW' AS operation_type, follower_id, following_id,
        moment AS created_at, moment AS completed_at FROM judged""",
    "m7_follow_edges": """SELECT * FROM stored_edges UNION ALL SELECT follower_id, following_id, moment FROM judged
        WHERE status = 'COMMITTED'""",
    "m7_follow_counters": """SELECT user_id, username,
        follower_count + (SELECT count(*) FROM judged j WHERE status = 'COMMITTED' AND j.following_id = a.user_id) AS follower_count,
        following_count + (SELECT count(*) FROM judged j WHERE status = 'COMMITTED' AND j.follower_id = a.user_id) AS following_count
        FROM accounts a""",
    "m7_follow_added": """SELECT r.follower_id, r.following_id, min_by(r.moment, r.request_id) AS created_at FROM requests r
        JOIN events v ON r.request_id = v.event_id AND v.event_type <> 'error'
        WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = r.follower_id)
        AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = r.following_id)
        AND NOT EXISTS (SELECT 1 FROM stored_edges e WHERE e.follower_id = r.follower_id
            AND e.following_id = r.following_id) GROUP BY r.follower_id, r.following_id""",
    "m8_like_rows": "SELECT post_id, user_id, created_at FROM post_likes UNION ALL SELECT * FROM new_likes",
    "m8_like_ids": """SELECT like_id, post_id, user_id, created_at FROM post_likes UNION ALL
        SELECT (SELECT max(like_id) FROM post_likes) + row_number() OVER (ORDER BY request_id, post_id, user_id),
            post_id, user_id, created_at FROM (
            SELECT post_id, user_id, min(moment) AS created_at, min(request_id) AS request_id FROM like_requests r
            WHERE NOT EXISTS (SELECT 1 FROM post_likes l WHERE l.post_id = r.post_id AND l.user_id = r.user_id)
            AND user_id IN (SELECT s_suppkey FROM supplier) GROUP BY post_id, user_id)""",
    "m8_like_counters": """SELECT p.post_id, p.user_id, location, like_count + count(n.user_id) AS like_count, p.created_at
        FROM posts p LEFT JOIN new_likes n ON p.post_id = n.post_id
        GROUP BY p.post_id, p.user_id, location, like_count, p.created_at""",
    "m9_transaction_fold": """SELECT *, (epoch_us(completed_at) - epoch_us(created_at)) / 1000 AS duration_ms
        FROM transactions""",
    "m9_streamed_fold": """SELECT *, (epoch_us(completed_at) - epoch_us(created_at)) / 1000 AS duration_ms
        FROM transactions""",
    "m10_streamed_sagas": "SELECT * FROM sagas",
    "m10_saga_fold": "SELECT * FROM sagas",
    "m10_saga_posts": "SELECT * FROM posts WHERE post_id NOT IN (SELECT post_id FROM sagas WHERE saga_status = 'COMPENSATED')",
    "m10_saga_counters": """SELECT u.user_id, u.username, greatest(post_count - count(s.saga_id), 0) AS post_count
        FROM user_counters u LEFT JOIN sagas s ON u.user_id = s.user_id AND saga_status = 'COMPENSATED' AND counted
        GROUP BY u.user_id, u.username, post_count""",
    "m11_create_posts": "SELECT * FROM commands",
    "m11_outbox_events": """SELECT post_id AS event_id, 'POST_CREATED' AS event_type, post_id AS aggregate_id,
        false AS processed, post_id, user_id, content, created_at, created_at AS indexed_at FROM commands""",
    "m11_event_sequence": """SELECT row_number() OVER (ORDER BY edited, created_at, post_id) AS event_id,
        CASE WHEN edited THEN 'POST_EDITED' ELSE 'POST_CREATED' END AS event_type, post_id AS aggregate_id, created_at
        FROM commands, (VALUES (false), (true)) AS kinds(edited)""",
    "m11_edited_posts": """SELECT post_id, user_id, substr(content, 1, 100) AS content, created_at, created_at AS indexed_at,
        row_number() OVER (ORDER BY created_at, post_id) AS first_event_id,
        (SELECT count(*) FROM commands) + row_number() OVER (ORDER BY created_at, post_id) AS last_event_id FROM commands""",
    "m12_constraint_audit": " UNION ALL ".join([
        _violations("users", "not_null(user_id)", "user_id IS NULL", "users"),
        _violations("users", "not_null(username)", "username IS NULL", "users"),
        _violations("users", "max_length(username)", "length(username) > 18", "users"),
        _violations("users", "max_length(full_name)", "length(full_name) > 8", "users"),
        _repeats("users", "user_id", "users"), _repeats("users", "username", "users"),
        _repeats("users", "full_name", "users"),
        _violations("posts", "not_null(post_id)", "post_id IS NULL", "posts"),
        _violations("posts", "not_null(user_id)", "user_id IS NULL", "posts"),
        _violations("posts", "positive(like_count)", "like_count <= 0", "posts"),
        _repeats("posts", "post_id", "posts"), _repeats("post_likes", "post_id,user_id", "like_candidates"),
        _violations("followers", "not_null(follower_id)", "follower_id IS NULL", "follow_candidates"),
        _violations("followers", "not_null(following_id)", "following_id IS NULL", "follow_candidates"),
        _violations("followers", "positive(following_id)", "following_id <= 0", "follow_candidates"),
        _repeats("followers", "follower_id,following_id", "follow_candidates"),
        _violations("transactions", "not_null(tx_id)", "tx_id IS NULL", "transaction_events"),
        _violations("transactions", "allowed(status)", "status NOT IN ('PREPARED', 'COMMITTED')", "transaction_events")]),
    "m13_rejected_batch": """SELECT count(*) AS requests, CAST(0 AS BIGINT) AS committed, count(*) AS count_before,
        count(*) AS count_after, true AS rolled_back FROM stored_edges""",
    "r1_outbox_projection": _READ_MODEL,
    "r1_batch_projection": _UPSERTED.format(folded="pending_folded"),
    "r1_flagged_outbox": "SELECT event_id, event_type, k AS aggregate_id, true AS processed FROM ev",
    "r1_compacted": _READ_MODEL,
    "r1_merged_projection": _READ_MODEL,
    "t1_model_feed": f"""SELECT * FROM ({_UPSERTED.format(folded="pending_folded")}) WHERE user_id = 7
        ORDER BY created_at DESC, post_id LIMIT 20""",
    "r2_idempotent_replay": _READ_MODEL,
    "r3_payload_decode": """SELECT event_id, k AS post_id, user_id, event_type AS content, ts AS created_at,
        ts AS indexed_at FROM ev WHERE event_type NOT IN ('error', 'signup')""",
    "r3_payload_rejects": "SELECT event_id, event_type, k AS aggregate_id FROM ev WHERE event_type IN ('error', 'signup')",
    "fn_dates": f"""SELECT comment_id, CAST(created_at AS DATE) AS day, date_trunc('day', created_at)::TIMESTAMP AS day_start,
        (epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(created_at)) / 1000 AS age_ms,
        TIMESTAMP '{EVENTS_AS_OF}' - to_seconds(user_id) AS earlier,
        strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM comments""",
    "fn_math": """SELECT event_id, ((user_id - 50) % 3 + 3) % 3 AS shard, CAST(floor(value * 2.5::DOUBLE) AS BIGINT) AS floored,
        greatest(user_id - 20, 0) AS floor_zero, greatest(20, user_id // 5) AS runs,
        round_even(CAST(floor(value * 1000) AS DOUBLE) / 8, 2) AS even, epoch_us(ts) // 1000000 AS epoch,
        CASE WHEN b < 10240 THEN b || ' bytes' WHEN b // 512 < 20479 THEN (b // 512 + 1) // 2 || ' kB'
             WHEN b // 524288 < 20479 THEN (b // 524288 + 1) // 2 || ' MB'
             ELSE (b // 536870912 + 1) // 2 || ' GB' END AS size
        FROM (SELECT *, CAST((event_id % 97) ** 6 AS BIGINT) AS b FROM events)""",
    "fn_nulls_json": """SELECT event_id, CASE WHEN event_type <> 'view' THEN k ELSE -1 END AS k_or_default, user_id,
        CASE WHEN event_type <> 'view' THEN k END AS k, json_extract_string(props, '$.k') AS chained FROM ev""",
}


def oracle_sql() -> dict[str, str]:
    statements = {**PLAIN, **_generators()}
    by_user = _with_tables(_SAMPLE_STATS).replace(TABLES["samples"], _BY_USER)
    found = {name: _with_tables(sql) for name, sql in statements.items()}
    found["a7_sample_stats_by_user"] = by_user
    return found
