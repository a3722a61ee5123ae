import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from convivio import schema, session
from convivio.operators import aggregates, filters
from convivio.sources import tables


@pytest.fixture
def posts(spark):
    days = [dt.datetime(2025, 12, 31, 23, 59), dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 3),
            dt.datetime(2026, 4, 30), dt.datetime(2031, 7, 1)]
    return spark.createDataFrame([(i, i % 4, d) for i, d in enumerate(days * 4)],
                                 "post_id long, user_id long, created_at timestamp_ntz")


def test_month_layout_takes_any_month_and_prunes(spark, posts, tmp_path, rows):
    path = tables.write_month_layout(posts, f"{tmp_path}/m")
    assert sorted(d for d in os.listdir(path) if "=" in d) == [
        f"created_month={m}" for m in ("202512", "202601", "202602", "202604", "203107")]
    recent = tables.read_since(spark, path, F.lit(dt.datetime(2026, 2, 1)).cast("timestamp_ntz"))
    assert rows(recent.select(*posts.columns)) == rows(posts.filter("created_at >= '2026-02-01'"))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cast\(created_month#\d+ as string\) >= 202602", plan)


def test_hash_layout_prunes_point_lookups(spark, posts, tmp_path, rows):
    path = tables.write_hash_layout(posts, f"{tmp_path}/h", "user_id")
    for found in (tables.read_hash_layout_key(spark, path, "user_id", 3),
                  filters.point_lookup(tables.scan(spark, path), "user_id", 3, ("user_id", 3))):
        assert rows(found.select(*posts.columns)) == rows(posts.filter("user_id = 3"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(shard" in plan and "EqualTo(user_id,3)" in plan
    shards = {r.user_id: r.shard for r in tables.scan(spark, path).collect()}
    assert shards == {0: 0, 1: 1, 2: 2, 3: 0}


def test_origin_names_the_partition(spark, posts, tmp_path):
    path = tables.write_hash_layout(posts, f"{tmp_path}/o", "user_id")
    seen = tables.with_origin(tables.scan(spark, path)).collect()
    assert all(f"/shard={r.shard}/" in r.origin_path and r.origin_file.endswith(".parquet") for r in seen)


def test_csv_and_json_round_trips(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "ñandú", 2.5)], "id long, name string, v double")
    for path, read in ((tables.write_csv(df, f"{tmp_path}/c"), tables.read_csv),
                       (tables.write_json(df, f"{tmp_path}/j"), tables.read_json)):
        assert rows(read(spark, path, df.schema)) == rows(df)
    none = tables.write_csv(df.limit(0), f"{tmp_path}/none")
    assert tables.read_csv(spark, none, df.schema).collect() == []


def test_csv_keeps_every_text(spark, tmp_path, rows):
    texts = [None, "", " ", " pad ", "a\nb", "a\r\nb", "a\rb", '"', 'q "x", y', "back\\slash", '\\"', "tab\t", "# no comment", ",", "é" * 70000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert rows(tables.read_csv(spark, tables.write_csv(df, f"{tmp_path}/t"), df.schema)) == rows(df)


def test_documents_with_byte_order_mark(spark, tmp_path):
    with open(f"{tmp_path}/geo.json", "wb") as f:
        f.write(b"\xef\xbb\xbf" + b'{\n "writes": 2,\n "latency_ms": {"average": 480, "raw": [1.5, 2]}\n}\n')
    row = tables.read_documents(spark, str(tmp_path)).first()
    assert (row.writes, row.latency_ms.average, row.latency_ms.raw, row.file_name) == (2, 480, [1.5, 2.0], "geo.json")


def test_conform_fills_and_casts(spark):
    df = tables.conform(spark.createDataFrame([("7", 1)], "post_id string, user_id int"), schema.POSTS)
    assert df.schema.names == schema.POSTS.names
    row = df.first()
    assert (row.post_id, row.user_id, row.content, row.media_urls) == (7, 1, None, None)


def test_append_adds_rows(spark, posts, tmp_path):
    path = tables.append(posts, f"{tmp_path}/a")
    tables.append(posts, path)
    assert tables.scan(spark, path).count() == 40


def test_series(spark):
    assert [r.id for r in tables.series(spark, 4).orderBy("id").collect()] == [1, 2, 3, 4]
    assert tables.series(spark, 0).count() == 0


def test_sql_with_parameters(spark, posts):
    got = tables.run_sql(spark, "SELECT count(*) AS n FROM {p} WHERE user_id = :u", {"u": 1}, p=posts)
    assert got.first().n == 5


def test_row_span_of_nothing(spark, posts):
    assert tuple(aggregates.row_span(posts.limit(0)).first()) == (0, None, None)


def test_file_sizes_of_a_layout(spark, posts, tmp_path):
    path = tables.write_hash_layout(posts, f"{tmp_path}/s", "user_id")
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    row = aggregates.file_sizes(spark, {"posts": path}).first()
    assert row.num_ranges == len(files)
    assert row.size_mb == pytest.approx(sum(map(os.path.getsize, files)) / 1024 / 1024)


def test_layout_distribution(spark, posts, tmp_path):
    path = tables.write_hash_layout(posts, f"{tmp_path}/d", "user_id")
    got = {r.partition_name: r for r in aggregates.layout_distribution(spark, path, "shard").collect()}
    assert {n: r.row_count for n, r in got.items()} == {"shard=0": 10, "shard=1": 5, "shard=2": 5}
    for name, r in got.items():
        sizes = [os.path.getsize(f"{path}/{name}/{f}") for f in os.listdir(f"{path}/{name}") if f.endswith(".parquet")]
        assert (r.num_files, r.size_bytes, r["size"]) == (len(sizes), sum(sizes), f"{sum(sizes)} bytes")


def test_partition_skew(spark, posts):
    got = aggregates.partition_distribution({"posts": (posts, "pmod(user_id, 3)")}).collect()
    assert {r.partition_name: r.row_count for r in got} == {"0": 10, "1": 5, "2": 5}
    assert got[0].skew == pytest.approx(1.5)


def test_scratch_paths_use_the_shared_folder(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_task_sizes_grow_with_the_input(spark, data):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    session.size_tasks(spark, data)
    assert [spark.conf.get(k) for k in keys] == before
    mib, tib = 2**20, 2**40
    session._FOLDER_BYTES["/pretend"] = 300 * tib
    try:
        spark.conf.set(keys[1], "300MB")
        session.size_tasks(spark, "/pretend")
        assert [spark.conf.get(k) for k in keys] == ["100000", str(1024 * mib)]
        spark.conf.set(keys[1], "2GB")
        session.size_tasks(spark, "/pretend")
        assert spark.conf.get(keys[1]) == "2GB"
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)
    assert session.task_sizes(10 * mib) == (1, 128 * mib)
    assert session.task_sizes(tib) == (4096, 128 * mib)
    assert session.task_sizes(100 * tib) == (100_000, 1024 * mib)


def test_daily_posts_and_recent(spark):
    day = dt.datetime
    df = spark.createDataFrame([(1, day(2026, 1, 1, 5), 2), (2, day(2026, 1, 1, 6), 5), (3, day(2026, 2, 1), None),
                                (4, None, 9)], "post_id long, created_at timestamp_ntz, like_count long")
    got = [tuple(r) for r in aggregates.daily_posts(df.filter("created_at IS NOT NULL")).collect()]
    assert got == [(dt.date(2026, 2, 1), 1, None), (dt.date(2026, 1, 1), 2, 3.5)]
    edge = filters.since(df, F.lit("2026-01-31 06:00:00").cast("timestamp_ntz"), 30).collect()
    assert sorted(r.post_id for r in edge) == [2, 3]


def test_point_lookup_uses_only_the_layout_it_is_given(spark, tmp_path, rows):
    posts = spark.createDataFrame([(n, n % 5, f"t{n}") for n in range(20)], "post_id long, user_id long, name string")
    path = tables.write_hash_layout(posts, str(tmp_path / "eight"), "user_id", 8)
    stored, layout = tables.scan(spark, path), ("user_id", 8)
    assert filters.point_lookup(stored, "user_id", 4, layout).count() == 4
    assert filters.point_lookup(stored, "user_id", 4).count() == 4
    assert rows(filters.point_lookup(stored, "post_id", 11, layout).select("post_id")) == [(11,)]
    assert rows(filters.point_lookup(stored, "name", "t7", layout).select("post_id")) == [(7,)]
    plan = filters.point_lookup(stored, "user_id", 4, layout)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan


def test_shared_folder_is_required_off_local():
    from types import SimpleNamespace

    from convivio.session import shared_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def test_merged_partitions_are_bounded(spark, data):
    """AQE merges at most 16 MiB of a shuffle into a task, and a large folder is cut into enough partitions for that."""
    merged, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(merged)
    session._FOLDER_BYTES["/pretend-6"] = 6 * 2**30
    try:
        spark.conf.set(merged, "64MB")
        session.prepare(spark, data)
        assert spark.conf.get(merged) == str(16 * 2**20) and spark.conf.get(first, None) is None
        spark.conf.set(merged, "1MB")
        session.bound_tasks(spark, "/pretend-6")
        assert spark.conf.get(merged) == "1MB" and spark.conf.get(first) == "384"
        session.bound_tasks(spark, data)
        assert spark.conf.get(first) == "384"
    finally:
        spark.conf.set(merged, before)
        spark.conf.unset(first)


def test_insert_ignore_runs_with_bounded_partitions(spark, data):
    """The registered query lowers a session's larger size, and its plan is made under the lower one."""
    from convivio.plans.catalog import REGISTRY
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(merged)
    try:
        spark.conf.set(merged, "64MB")
        assert REGISTRY["m1_insert_ignore"](spark, data).columns == ["follower_id", "following_id", "created_at"]
        assert spark.conf.get(merged) == str(16 * 2**20)
    finally:
        spark.conf.set(merged, before)


def test_large_folders_are_read_in_bounded_splits(spark, data, tmp_path, monkeypatch):
    """The insert-ignore query of a folder of 40 pieces reads tables in 40 splits at least, so that map tasks aggregate few rows."""
    from convivio.plans.catalog import REGISTRY
    splits, cost = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"
    keys = (splits, cost, "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    path, piece = str(tmp_path / "rows"), 16 * 2**20
    spark.range(400_000).coalesce(1).write.option("parquet.block.size", str(2**16)).parquet(path)
    try:
        spark.conf.unset(splits)
        spark.conf.set(cost, "1")
        monkeypatch.setitem(session._FOLDER_BYTES, str(data).rstrip("/"), 40 * piece)
        REGISTRY["m1_insert_ignore"](spark, data)
        read = tables.scan(spark, path).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert len(read) >= 40 and sum(read) == 400_000 and max(read) < 400_000 / 10
        monkeypatch.setitem(session._FOLDER_BYTES, "/pretend-6t", 6 * 2**40)
        session.bound_tasks(spark, "/pretend-6t")
        assert spark.conf.get(splits) == "2000"
        spark.conf.set(splits, "3000")
        session.bound_tasks(spark, "/pretend-6t")
        assert spark.conf.get(splits) == "3000"
    finally:
        for key, value in zip(keys, before):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
