"""Hard negatives, whitening and exact duplicates against brute force."""

import hashlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from convivio.llm import exact_duplicates, hard_negatives, whitening
from convivio.llm.oracle import oracle_sql
from convivio.llm.queries import QUERIES
from oracle_check import compare, connect

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, anchor_id string, rank int, x int, q string"


def frame(spark, rows):
    """Vector rows with extra columns whose names clash with the operators' own."""
    rows = [(i, v if v is None else [c if c is None else float(c) for c in v], label, "a", 1, 2, "q") for i, v, label in rows]
    return spark.createDataFrame(rows, VECTORS)


def by_pairs(rows, every, dimension):
    """Hard negatives by comparing each anchor with all rows."""
    clean = {(i, label, tuple(int(np.floor(256 * np.float64(np.float32(c)))) for c in v) + (0,) * (dimension - len(v)))
             for i, v, label in rows
             if None not in (i, v, label) and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for a in (r for r in clean if r[0] % every == 0):
        scored = sorted((-sum(p * q for p, q in zip(a[2], r[2])), r[0], r[1]) for r in clean if r != a)
        for s, i, label in [r for r in scored if r[2] == a[1]][:5]:
            fit = [r for r in scored if r[2] != a[1] and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a[0], i, n, r[1], -s, -r[0]) for n, r in enumerate(fit, 1)]
    return sorted(out)


def clustered(count, dimension, clusters, seed, spread=0.02):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(clusters, dimension))
    own = draw.integers(clusters, size=count)
    return (middles[own] + spread * draw.normal(size=(count, dimension))).astype(np.float32), own, draw


def test_op11_by_brute_force(spark):
    v, own, draw = clustered(400, 6, 12, 1)
    v[draw.random(400) < 0.33] = v[0]
    rows = [(int(i), v[i].tolist(), int(draw.integers(3))) for i in range(400)]
    rows += rows[:20] + [(7, v[9].tolist(), 1), (50, v[11].tolist(), 2), (900, [0.0] * 6, 0), (950, [1.0, 0.5], 1)]
    rows += [(500, None, 1), (550, [1.0, None, 0, 0, 0, 0], 1), (600, [NAN] * 6, 0), (650, [INF] + [0.0] * 5, 1),
             (700, v[3].tolist(), None), (None, v[4].tolist(), 1)]
    got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, sample=200, block=16)
    assert sorted(map(tuple, got.collect())) == by_pairs(rows, 10, 6)


def test_op11_small_and_empty(spark):
    condition = F.col("vec_id") % 50 == 0
    for rows in ([], [(1, [1.0], 0)], [(0, [1.0], 0)], [(0, None, None)], [(0, [], 0), (1, [], 0), (2, [], 1)]):
        got = hard_negatives.mine(frame(spark, rows), condition)
        assert sorted(map(tuple, got.collect())) == by_pairs(rows, 50, 0 if not rows or not rows[0][1] else 1)


def test_tree_rules_out_siblings_and_loses_nothing():
    v, _, draw = clustered(4000, 8, 60, 2)
    x = np.floor(256 * v).astype(np.int64)
    norm = int((x * x).sum(axis=1).max())
    tree = hard_negatives.Tree(np.unique(x, axis=0)[::4], norm, leaf=16)
    leaves, seen = tree.route(x), {}
    for part in np.array_split(np.arange(4000), 5):
        tree.ranges(x[part], leaves[part], seen)
    tree.set_ranges([(n, c, p, a, b) for (n, c), (low, high) in seen.items() for p, (a, b) in enumerate(zip(low, high))])
    queries = x[draw.integers(4000, size=100)]
    scores = hard_negatives.products(queries, x)
    top = np.sort(scores, axis=1)[:, ::-1]
    for least, most in ((top[:, 5], top[:, 0]), (top[:, 60], top[:, 40]), (top[:, 0] // 2, top[:, 0] * 95 // 100)):
        query, leaf = tree.visit(queries, least, most)
        kept = np.zeros((100, tree.leaves), bool)
        kept[query, leaf] = True
        inside = (scores >= least[:, None]) & (scores <= most[:, None])
        assert all(kept[q, leaves[r]] for q, r in zip(*np.nonzero(inside)))
    query, _ = tree.visit(queries, top[:, 5], top[:, 0])
    assert tree.leaves > 50 and len(query) < 0.2 * 100 * tree.leaves


def test_products_are_exact_and_ties_go_by_place():
    big = np.array([[2**29, 2**29 - 1]])
    assert hard_negatives.products(big, big)[0, 0] == 2**58 + (2**29 - 1)**2
    scores = np.array([[5, 7, 7, 7, 1], [3, 3, 3, 3, 3]])
    row, column = hard_negatives.best_in_block(scores, scores != 5, 2)
    assert (row.tolist(), column.tolist()) == ([0, 0, 1, 1], [1, 2, 0, 1])
    row, column = hard_negatives.best_in_block(scores, scores == 1, 2)
    assert (row.tolist(), column.tolist()) == ([0], [4])


def exact_fit(vectors):
    """n, sums and covariance of the distinct whole vectors, in fractions."""
    fit = sorted(set(vectors))
    n, size = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(size)]
    cov = [[sum((Fraction(x[i]) - Fraction(sums[i], n)) * (Fraction(x[j]) - Fraction(sums[j], n)) for x in fit) / n
            for j in range(size)] for i in range(size)]
    return n, sums, cov


def test_op12_by_fractions(spark):
    v, _, draw = clustered(120, 5, 7, 3, 0.2)
    v[draw.random(120) < 0.33] = v[0]
    rows = [(i, [float(c) for c in v[i]], 0) for i in range(120)] + [(3, [float(c) for c in v[3]], 0)]
    bad = [(200, None, 0), (201, [1.0, None, 1.0, 1.0, 1.0], 0), (202, [NAN] * 5, 0), (203, [-INF] + [0.0] * 4, 0), (204, [1e30] * 5, 0)]
    rows += [(None, [0.25] * 5, 0), (205, [-0.0, 1.0], 0)]
    whole = {i: tuple(int(np.floor(256 * np.float64(np.float32(c)))) for c in x) + (0,) * (5 - len(x)) for i, x, _ in rows}
    n, sums, cov = exact_fit(whole.values())
    got = whitening.whiten(frame(spark, rows + bad)).toPandas()
    assert len(got) == 4 * len(rows) and set(got.n) == {n}
    matrix = np.array([[float(c) for c in line] for line in cov])
    e, u = np.linalg.eigh(matrix)
    for k in range(4):
        part = got[got.component == k + 1].drop_duplicates("vec_id")
        x = np.array([whole[None if i != i else i] for i in part.vec_id], float)
        want = (x - np.array(sums) / n) @ u[:, -1 - k] / np.sqrt(e[-1 - k])
        want *= np.sign(want @ part.whitened.to_numpy())
        assert np.allclose(want, part.whitened, atol=1e-9) and np.allclose(part.explained, e[-1 - k] / e.sum())
        for i, d in zip(part.vec_id, part.deviation):
            assert d == sum((n * a - s) ** 2 for a, s in zip(whole[None if i != i else i], sums))
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_op12_covariance_is_exact():
    rows = [(2**27 + k * k, -2**27 + k, 3 * k) for k in range(40)]
    n, sums, cov = exact_fit(rows)
    m = [s // n for s in sums]
    squares = {(i, j): sum((r[i] - m[i] + (r[j] - m[j] if i != j else 0)) ** 2 for r in rows) for i in range(3) for j in range(i, 3)}
    assert whitening.covariance(n, sums, squares).tolist() == [[float(c) for c in line] for line in cov]


def test_op12_without_variance(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 0), (2, [], 0)])).count() == 0
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained) for r in one} == {(1, 0, None, None)}
    line = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [2.0, 4.0], 0)])).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)}


def test_op12_whole_table(spark, data):
    got = QUERIES["op12_whitening"](spark, data).toPandas()
    raw = duckdb.sql(f"SELECT vec_id, embedding FROM '{data}/embeddings.parquet'").fetchall()
    whole = {i: tuple(int(np.floor(256 * c)) for c in x) for i, x in raw}
    fit = np.unique(np.array(list(whole.values())), axis=0)
    e, u = np.linalg.eigh(np.cov(fit.T, bias=True))
    assert len(got) == 4 * len(raw) and got.identity_error[0] < 1e-4
    for k in range(4):
        part = got[got.component == k + 1]
        want = (np.array([whole[i] for i in part.vec_id]) - fit.mean(axis=0)) @ u[:, -1 - k] / np.sqrt(e[-1 - k])
        assert np.allclose(want * np.sign(want @ part.whitened.to_numpy()), part.whitened, atol=1e-8)


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COPIES = [(1, "Same"), (2, "sAME"), (2, "same"), (9, None), (8, ""), (None, ""), (None, "alone"), (4, "É same"),
          (5, "é same"), (6, "x" * 200_000), (7, "X" * 200_000), (10, "b\nA"), (11, "b\na"), (11, "other")]


def plain_groups(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[hashlib.sha256((text or "").translate(UPPER).encode()).hexdigest()].append(i)
    return groups


@pytest.mark.parametrize("counters", [1, 3, 4096])
def test_op13_by_brute_force(spark, counters):
    rows = COPIES + [(100 + n, "Hot text" if n % 2 else "HOT text") for n in range(300)]
    docs = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "doc_id long, text string, digest int, keep_id string, kept boolean")
    got = exact_duplicates.find_copies(docs.repartition(5), counters).collect()
    groups = plain_groups(rows)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (best, len(ids)) and r.doc_id in ids
        assert r.doc_id == best or not r.kept
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted(groups)
    left = exact_duplicates.without_copies(docs.repartition(5), counters)
    assert left.columns == docs.columns
    stayed = [(r.doc_id, hashlib.sha256((r.text or "").translate(UPPER).encode()).hexdigest()) for r in left.collect()]
    assert sorted(stayed, key=repr) == sorted(((max((i for i in ids if i is not None), default=None), h) for h, ids in groups.items()), key=repr)


def test_op13_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates.find_copies(none).count() == 0 and exact_duplicates.without_copies(none).count() == 0


def test_summaries_keep_every_frequent_digest(spark):
    draw = np.random.default_rng(4)
    values = np.concatenate([np.repeat(np.arange(6), 400), np.arange(100, 1700)])
    draw.shuffle(values)
    digests = spark.createDataFrame([(str(v).encode(),) for v in values.tolist()], "digest binary").repartition(7)
    chosen = {bytes(r.digest) for r in exact_duplicates.candidates(digests, 10).collect()}
    assert {str(v).encode() for v in range(6)} <= chosen and len(chosen) <= 10
    assert exact_duplicates.cut(np.array([5, 3, 9]), 2).tolist() == [2, 0, 6]


def test_hot_digests_take_no_shuffle(spark, data):
    """The rows of verified winners are settled by a broadcast; only the others are exchanged."""
    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(3000)], "doc_id long, text string")
    plan = exact_duplicates.find_copies(docs)._jdf.queryExecution().executedPlan().toString()
    heavy, light = plan.split("BroadcastHashJoin", 2)[1:]
    assert "Exchange hashpartitioning" not in heavy.split("Window")[0] and "LeftAnti" in light + heavy


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_exact_duplicates"])
def test_matches_sql(spark, data, name):
    assert compare(spark, connect(data), data, QUERIES[name], oracle_sql()[name])["problems"] == {}


def test_packed_vectors_come_back(spark):
    from convivio.llm.vectors import pack, unpack
    df = spark.createDataFrame([(1, [1, -2]), (2, []), (3, [5, 6, 7])], "k int, x array<long>")
    got = pack(df, "x", 3).orderBy("k").collect()
    assert unpack(pa.array([r.x for r in got], pa.binary()), 3).tolist() == [[1, -2, 0], [0, 0, 0], [5, 6, 7]]
