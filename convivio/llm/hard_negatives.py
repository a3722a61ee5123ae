"""Hard negatives by exact search in a multiway hyperplane tree with distance ranges (GNAT, Brin 1995).

Vectors are whole numbers and a score is the inner product with the anchor. One more coordinate, sqrt(M^2 - |x|^2) with M the
largest norm, brings all rows to the norm M, and 0 is the anchors' own; then d^2 = |a|^2 + M^2 - 2 score, so a window of
scores is exactly an annulus of distances, whatever the norms.

* The tree is fitted on a bounded sample of distinct vectors. A node has up to `ARITY` split points, far apart from each
  other, and every vector belongs to the nearest one. All rows are routed to leaves.
* For each split point and each sibling subtree, the smallest and largest distance from the point to the rows of the
  subtree are aggregated over all rows, not over the sample.
* A query knows its distance to the split points. A sibling goes when, for some split point, no distance within its range can
  meet the annulus: by the triangle inequality its rows lie between the difference and the sum of the two distances.
* Leaves that are left are searched exactly, leaf block by query block, as a matrix product in a grouped task.

Each search has two rounds. The query's own leaf comes first; the k-th best found there narrows the window from below, and
the tree is asked again with the narrower annulus. The first search finds the best rows of the same label, which set
the windows of the second one.

Scale: equal vectors of one label are one point that keeps its first ids only, as no others can be among the first k;
searches run once for each distinct anchor vector. A leaf of any size is dealt by hash into blocks of about
`BLOCK` points, and queries into chunks of about as many, so a group is bounded. Where the tree rules nothing out, the
work is what comparing each anchor with all rows costs; that holds for vectors without structure in many dimensions.

Defined results: rows with a null id, a null label, or a vector that is null or has null, non-finite or excessively
large components (`vectors.usable`) take no part. Shorter vectors are filled up with zeros. Rows equal in id, label and vector
are one row; rows that share an id only are different rows. Scores that tie go by the smaller id. An empty table gives an empty
result. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .vectors import SCALE, dimension_of, pack, unpack, usable, whole

SAMPLE, ARITY, LEAF, BLOCK = 4096, 8, 128, 4096
POSITIVES, NEGATIVES, LOW_PERCENT, HIGH_PERCENT = 5, 3, 50, 95
_FAR = 2**62
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Node:
    """Split points (rows), and for each the child: a node's number, or -1 less a leaf's number."""

    points: np.ndarray
    children: list[int] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Tree:
    """Split points fitted on a sample; ranges are set from all rows."""

    def __init__(self, sample: np.ndarray, norm: int, arity: int = ARITY, leaf: int = LEAF):
        # norm: the largest squared norm of all rows.
        self.norm, self.arity, self.leaf = float(norm), arity, leaf
        self.nodes: list[Node] = []
        self.leaves = 0
        self.slack = 1e-6 * max(1.0, self.norm) ** 0.5
        self.root = self._grow(sample.astype(np.float64))
        # The way to each leaf: (node, child) from the root on.
        self.ways: list[list[tuple[int, int]]] = [[] for _ in range(self.leaves)]
        self._walk(self.root, [])

    def _grow(self, rows: np.ndarray) -> int:
        if len(rows) <= max(self.leaf, 1):
            self.leaves += 1
            return -self.leaves
        points = rows[self._apart(rows)]
        own, node = self._between(points, rows).argmin(axis=0), Node(points)
        self.nodes.append(node)
        number = len(self.nodes) - 1
        node.children = [self._grow(rows[own == k]) for k in range(len(points))]
        return number

    def _apart(self, rows: np.ndarray) -> list[int]:
        """Rows that are far from each other, the first from the middle of the sample's order."""
        chosen = [len(rows) // 2]
        nearest = self._between(rows[chosen], rows)[0]
        while len(chosen) < self.arity:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, self._between(rows[chosen[-1:]], rows)[0])
        return chosen

    def _lift(self, rows: np.ndarray) -> np.ndarray:
        """The added coordinate of rows."""
        return np.sqrt(np.maximum(self.norm - np.einsum("ab,ab->a", rows, rows), 0.0))

    def _between(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distances from split points to rows."""
        inner = points @ rows.T + np.outer(self._lift(points), self._lift(rows))
        return np.sqrt(np.maximum(2 * (self.norm - inner), 0.0))

    def from_queries(self, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances from queries, whose added coordinate is 0, to split points."""
        norms = np.einsum("ab,ab->a", queries, queries)[:, None]
        return np.sqrt(np.maximum(norms + self.norm - 2 * (queries @ points.T), 0.0))

    def _walk(self, child: int, way: list[tuple[int, int]]) -> None:
        if child < 0:
            self.ways[-child - 1] = way
            return
        for k, below in enumerate(self.nodes[child].children):
            self._walk(below, [*way, (child, k)])

    def route(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, rows = np.zeros(len(rows), np.int64), rows.astype(np.float64)
        open_ = [(self.root, np.arange(len(rows)))]
        while open_:
            child, at = open_.pop()
            if child < 0:
                out[at] = -child - 1
            elif len(at):
                node = self.nodes[child]
                own = self._between(node.points, rows[at]).argmin(axis=0)
                open_ += [(below, at[own == k]) for k, below in enumerate(node.children)]
        return out

    def ranges(self, rows: np.ndarray, leaves: np.ndarray, seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]) -> None:
        """Widen the ranges {(node, child): (low, high) for each split point} by these rows."""
        rows = rows.astype(np.float64)
        ways = [dict(way) for way in self.ways]
        for number, node in enumerate(self.nodes):
            child_of = np.array([way.get(number, -1) for way in ways])
            own = child_of[leaves]
            for k in range(len(node.children)):
                mine = rows[own == k]
                if len(mine):
                    far = self._between(node.points, mine)
                    low, high = seen.get((number, k), (np.inf, -np.inf))
                    seen[number, k] = np.minimum(low, far.min(axis=1)), np.maximum(high, far.max(axis=1))

    def set_ranges(self, rows: list[tuple[int, int, int, float, float]]) -> None:
        """(node, child, split point, low, high); subtrees without rows keep an empty range."""
        for node in self.nodes:
            size = len(node.points)
            node.low, node.high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
        for number, child, point, low, high in rows:
            self.nodes[number].low[point, child], self.nodes[number].high[point, child] = low, high

    def visit(self, queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) pairs whose rows may score from `least` to `most`; the others are ruled out."""
        queries = queries.astype(np.float64)
        base = np.einsum("ab,ab->a", queries, queries) + self.norm
        inner, outer = [np.sqrt(np.maximum(base - 2.0 * s.astype(np.float64), 0.0)) for s in (most, least)]
        found, open_ = [], [(self.root, np.flatnonzero(least <= most))]
        while open_:
            child, at = open_.pop()
            if child < 0:
                found.append((at, np.full(len(at), -child - 1)))
            elif len(at):
                node = self.nodes[child]
                own = self.from_queries(queries[at], node.points)
                for k, below in enumerate(node.children):
                    low, high = node.low[:, k], node.high[:, k]
                    # No row of the subtree is nearer than `near`, and none further than `far`.
                    near = np.maximum(low - own, own - high).max(axis=1)
                    far = (own + high).min(axis=1)
                    stays = (near <= outer[at] + self.slack) & (far >= inner[at] - self.slack)
                    open_.append((below, at[stays]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows."""
    size = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if size < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def best_in_block(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best allowed scores of each row, all ties at the k-th place included up to k, in order."""
    held = np.where(allowed, scores, -_FAR)
    if held.shape[1] > k:
        floor = np.partition(held, -k, axis=1)[:, -k]
    else:
        floor = np.full(len(held), -_FAR)
    row, column = np.nonzero(allowed & (held >= floor[:, None]))
    order = np.lexsort((column, -held[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, "left")
    return row[place < k], column[place < k]


def _points(rows: DataFrame, ids: int) -> DataFrame:
    """One row for each label and vector, with its first ids. The rank filter limits hot vectors before the shuffle."""
    group = Window.partitionBy("label", "x").orderBy("vec_id")
    first = rows.withColumn("at", F.row_number().over(group)).filter(F.col("at") <= ids)
    return first.groupBy("label", "x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def fit_tree(points: DataFrame, dimension: int, sample: int = SAMPLE) -> Tree:
    """A tree on the first `sample` distinct vectors by hash."""
    norm = points.select(F.max("norm")).first()[0]
    some = points.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(sample).collect()
    return Tree(unpack(pa.array([r["x"] for r in some], pa.binary()), dimension), norm)


def place_points(points: DataFrame, tree: Tree, dimension: int, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """All points with the block they are dealt to, and the first block of each leaf; sets the tree's ranges."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.route(unpack(batch.column(1), dimension))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], ["label", "x", "ids", "leaf"])

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            tree.ranges(unpack(batch.column(0), dimension), batch.column(1).to_numpy(), seen)
        rows = [(node, child, point, l, h) for (node, child), (low, high) in seen.items()
                for point, (l, h) in enumerate(zip(low.tolist(), high.tolist()))]
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.int32()] * 3 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "child", "point", "low", "high"])

    placed = durable(points.select("label", "x", "ids").mapInArrow(route, "label string, x binary, ids array<long>, leaf long"))
    # Nodes times the square of their arity: a few thousand rows.
    spans = placed.select("x", "leaf").mapInArrow(widen, "node int, child int, point int, low double, high double").groupBy(
        "node", "child", "point").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    tree.set_ranges([tuple(r) for r in spans.collect()])
    held = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    counts = np.array([-(-held.get(leaf, 0) // block) for leaf in range(tree.leaves)], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    starts, sizes = [F.array(*[F.lit(int(n)) for n in numbers]) for numbers in (first[:-1], np.maximum(counts, 1))]
    leaf = F.col("leaf").cast("int")
    salt = F.pmod(F.xxhash64("x", "label"), F.get(sizes, leaf).cast("long"))
    return placed.select((F.get(starts, leaf) + salt).alias("block"), "label", "x", "ids"), first


_QUERY = ["q", "label", "x", "w", "least", "most"]
_VISIT = "q long, label string, x binary, w array<int>, least array<long>, most array<long>, block long"


def visits(queries: DataFrame, tree: Tree, first: np.ndarray, dimension: int, own: bool) -> DataFrame:
    """(query, block) pairs with the windows to look for: the blocks of the query's own leaf, or all others left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, sizes = unpack(batch.column(2), dimension), np.diff(batch.column(3).offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            flat = [batch.column(c).flatten().to_numpy() for c in (3, 4, 5)]
            home = tree.route(x)
            if own:
                entry, leaf = np.arange(len(owner)), home[owner]
            else:
                entry, leaf = tree.visit(x[owner], flat[1], flat[2])
                other = leaf != home[owner[entry]]
                entry, leaf = entry[other], leaf[other]
            order = np.lexsort((entry, leaf, owner[entry]))
            entry, leaf = entry[order], leaf[order]
            # One list of windows for each query and leaf.
            key = owner[entry] * (len(first)) + leaf
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            lengths = np.diff(np.append(starts, len(key)))
            times = (first[1:] - first[:-1])[leaf[starts]]
            pick = np.repeat(np.arange(len(starts)), times)
            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + first[leaf[starts[pick]]]
            # Lists repeat for each block of the leaf.
            spread = lengths[pick]
            offsets = np.concatenate([[0], np.cumsum(spread)]).astype(np.int32)
            inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], spread) + np.repeat(starts[pick], spread)
            rows = pa.array(owner[entry[starts[pick]]])
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[entry[inside]], kind))
                     for values, kind in zip(flat, (pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(rows) for c in range(3)], *lists, pa.array(block, pa.int64())], [*_QUERY, "block"])

    return queries.select(*_QUERY).mapInArrow(run, _VISIT)


def search_blocks(asked: DataFrame, placed: DataFrame, chunks: int, k: int, same: bool, dimension: int) -> DataFrame:
    """(q, w, vec_id, score): the k best rows of each visited block for each window, of the same label or of others."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = {"q": pa.int64(), "w": pa.int32(), "vec_id": pa.int64(), "score": pa.int64()}
        parts = [pa.table({n: pa.array([], t) for n, t in kinds.items()})]
        left, right = left.combine_chunks(), right.combine_chunks()
        if left.num_rows and right.num_rows:
            ids = right["ids"].combine_chunks()
            firsts = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
            right = right.take(pa.array(np.argsort(firsts, kind="stable")))
            ids = right["ids"].combine_chunks()
            flat, starts = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            x = unpack(right["x"], dimension)
            codes = pa.chunked_array([*left["label"].chunks, *right["label"].chunks]).combine_chunks().dictionary_encode()
            codes = codes.indices.to_numpy()
            mine, theirs = codes[:left.num_rows], codes[left.num_rows:]
            q, vectors = left["q"].to_numpy(), unpack(left["x"], dimension)
            # A few megabytes of scores at a time.
            step = max(1, 1_000_000 // len(x))
            for at in range(0, left.num_rows, step):
                scores = products(vectors[at:at + step], x)
                some = left.slice(at, step)
                lists = some["w"].combine_chunks()
                owner = np.repeat(np.arange(len(some)), np.diff(lists.offsets.to_numpy()))
                w, least, most = [some[c].combine_chunks().flatten().to_numpy() for c in ("w", "least", "most")]
                label = (mine[at:at + step, None] == theirs[None, :]) == same
                for go in range(0, len(owner), step):
                    o = owner[go:go + step]
                    s = scores[o]
                    ok = label[o] & (s >= least[go:go + step, None]) & (s <= most[go:go + step, None])
                    row, column = best_in_block(s, ok, k)
                    times = starts[column + 1] - starts[column]
                    each = np.repeat(np.arange(len(row)), times)
                    vec = flat[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + starts[column[each]]]
                    row, score = row[each], s[row[each], column[each]]
                    # Of each window's rows again the k best only, by score and then id.
                    order = np.lexsort((vec, -score, row))
                    row, score, vec = row[order], score[order], vec[order]
                    keep = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
                    row, score, vec = row[keep], score[keep], vec[keep]
                    parts.append(pa.table({"q": pa.array(q[at:at + step][o[row]], pa.int64()), "w": pa.array(w[go:go + step][row], pa.int32()),
                                           "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.int64())}))
        return pa.concat_tables(parts)

    asked = durable(asked.withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks))))
    # Points go only where a query asks for them.
    wanted = asked.select(F.col("block").alias("to_block"), F.col("chunk").alias("to_chunk")).distinct()
    sides = placed.join(wanted, F.col("block") == F.col("to_block")).drop("block").groupBy("to_block", "to_chunk")
    return asked.groupBy("block", "chunk").cogroup(sides).applyInArrow(run, "q long, w int, vec_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def search(queries: DataFrame, placed: DataFrame, tree: Tree, first: np.ndarray, dimension: int, k: int, same: bool,
           block: int = BLOCK) -> DataFrame:
    """(q, w, vec_id, score, place): the k best rows of every window; `queries` has q, label, x and lists w, least, most."""
    chunks = max(1, -(-queries.count() // block))
    near = durable(_first(search_blocks(visits(queries, tree, first, dimension, True), placed, chunks, k, same, dimension), k))
    bound = near.groupBy("q", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    each = queries.select("q", F.inline(F.arrays_zip("w", "least", "most")))
    tight = each.join(bound.filter(F.col("n") >= k), ["q", "w"], "left").groupBy("q").agg(
        F.collect_list(F.struct("w", F.greatest("least", F.coalesce("worst", "least")).alias("least"), "most")).alias("a"))
    again = queries.select("q", "label", "x").join(tight, "q").select("q", "label", "x", "a.w", "a.least", "a.most")
    far = search_blocks(visits(again, tree, first, dimension, False), placed, chunks, k, same, dimension)
    return durable(_first(near.drop("place").unionByName(far), k))


def score_window(score: Column, low_percent: int, high_percent: int) -> tuple[Column, Column]:
    """Whole numbers n with low_percent * score <= 100 n <= high_percent * score."""
    # Whole-number floors: doubles would round large scores.
    floor = lambda c: F.call_function("div", c - F.pmod(c, F.lit(100).cast("long")), F.lit(100).cast("long"))
    return -floor(-(score * low_percent)), floor(score * high_percent)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, scale: int = SCALE, sample: int = SAMPLE,
         block: int = BLOCK) -> DataFrame:
    """Hard negatives of the anchors among `rows` (vec_id, embedding, label); `is_anchor` is a condition on vec_id.

    An anchor's positives are its best other rows of the same label. For each, the best rows of other labels whose
    scores lie between the two shares of the positive's score are ranked from 1.
    """
    spark, vector = rows.sparkSession, F.col("embedding")
    dimension = dimension_of(rows, "embedding")
    fit = usable(vector, dimension, scale) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    clean = rows.filter(fit).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                                    whole(vector, scale).alias("x"))
    normed = clean.withColumn("norm", F.aggregate("x", F.lit(0).cast("long"), lambda total, c: total + c * c))
    packed = durable(pack(normed.select("vec_id", "label", "norm", "x"), "x", dimension))
    whole_rows = packed.drop("norm").distinct()
    anchors = whole_rows.filter(is_anchor)
    queries = durable(anchors.select("label", "x").distinct().withColumn("q", F.monotonically_increasing_id()))
    if queries.isEmpty():
        return spark.createDataFrame([], FOUND)
    tree = fit_tree(packed, dimension, sample)
    points = _points(whole_rows, positives + 1)
    placed, first = place_points(points, tree, dimension, block)

    everything = [F.array(F.lit(v).cast(t)) for v, t in ((0, "int"), (-_FAR, "long"), (_FAR, "long"))]
    asked = queries.select("q", "label", "x", *[c.alias(n) for c, n in zip(everything, ("w", "least", "most"))])
    alike = search(asked, placed, tree, first, dimension, positives + 1, True, block)
    top = alike.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("top"))
    named = anchors.join(queries, ["label", "x"]).select("q", F.col("vec_id").alias("anchor_id"))
    # The anchor itself is one row of the list at most, if its own norm is large enough.
    self_at = F.array_position(F.transform("top", lambda t: t["vec_id"]), F.col("anchor_id"))
    others = F.filter("top", lambda t, at: (self_at == 0) | (at + 1 != self_at))
    pairs = durable(named.join(top, "q").select("q", "anchor_id", F.inline(F.slice(others, 1, positives))).select(
        "q", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    least, most = score_window(F.col("positive_score"), low_percent, high_percent)
    scored = pairs.select("q", "positive_score").distinct()
    number = F.row_number().over(Window.partitionBy("q").orderBy("positive_score")).cast("int")
    windows = durable(scored.select("q", "positive_score", number.alias("w"), least.alias("least"), most.alias("most")))
    lists = windows.filter("least <= most").groupBy("q").agg(F.collect_list(F.struct("w", "least", "most")).alias("a"))
    asked = durable(queries.join(lists, "q").select("q", "label", "x", "a.w", "a.least", "a.most"))
    unlike = search(asked, placed, tree, first, dimension, negatives, False, block)
    ranked = unlike.groupBy("q", "w").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    ranked = ranked.join(windows.select("q", "w", "positive_score"), ["q", "w"]).drop("w")
    return pairs.join(ranked, ["q", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.inline("found")).select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
