"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct five-word shingles; fewer words make one shingle. Equal sets are one class and
go on as one representative. Minima of many hashes form bands; representatives that share a band are candidates. Of
each minimum only the low bits are kept, packed into longs: bit counts of the packed signatures give a similarity,
corrected for chance collisions, which drops candidates far below the threshold. What is left is confirmed on the
full sets, and links become components by star contraction.

A bucket never yields all its pairs. Shingles that no other candidate holds cannot be shared, so the rest of a set
bounds its overlap with any other. Each member of a bucket is compared with two leaders (the member with the
largest shareable part, and the first one), which joins most of a group. After that only members of different components
whose bounds allow a link are compared with each other, so no link between components is lost.

With `rows` minima a band and `bands` from the threshold t, a pair at t is missed with probability
(1 - t**rows)**bands <= `miss`.

Defined results: a null text, or one without words, has an empty set and is linked with nothing. A null doc_id is
linked with nothing either, its component is null and it is kept. Rows with one doc_id are one document: they share
one component. An empty table gives an empty result. Extra columns pass through in `one_of_each`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .common import LOWER, UPPER, WORD, only_ids, without_ids

SHINGLE, ROWS, BITS, MISS = 5, 6, 2, 1e-6
# Deviations below the threshold at which the estimated similarity drops a candidate.
SLACK = 5.0

_words = re.compile(WORD).findall
_LOWER = str.maketrans(UPPER, LOWER)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53],
                np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _ODD[0]
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    """Hashes of words seen by this process; emptied when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_word_hashes = _WordHashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = _words(text.translate(_LOWER)) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += _mixed(h[k:k + n] + np.uint64(k)) * _ODD[k]
    return np.unique(_mixed(total))


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold ** rows))


def _factors(count: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)


def minima(shingles: np.ndarray, count: int) -> np.ndarray:
    """The minimum of each hash function over the set, in blocks that bound the memory of long texts."""
    factors, best = _factors(count), np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        block = shingles[at:at + 2048, None] * factors
        np.minimum(best, block.min(axis=0), out=best)
    return best


def signature(shingles: np.ndarray, bands: int, rows: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, low bits of the mixed minima packed into longs)."""
    least = _mixed(minima(shingles, bands * rows))
    grid = least.reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * _ODD[1]
    for k in range(rows):
        keys = _mixed(keys ^ grid[:, k])
    per = 64 // bits
    low = least & np.uint64((1 << bits) - 1)
    low = np.concatenate([low, np.zeros(-len(low) % per, np.uint64)]).reshape(-1, per)
    packed = np.bitwise_or.reduce(low << (np.arange(per, dtype=np.uint64) * np.uint64(bits)), axis=1)
    return keys, packed


def _signatures(docs: DataFrame, bands: int, rows: int, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, sets, keys, packs = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingle_set(text)
                ids.append(doc_id)
                sizes.append(len(found))
                if len(found) and doc_id is not None:
                    key, packed = signature(found, bands, rows, bits)
                    sets.append(xxhash.xxh3_128_digest(found.tobytes()))
                    keys.append(key.view(np.int64))
                    packs.append(packed.view(np.int64))
                else:
                    sets.append(None)
                    keys.append(None)
                    packs.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(keys, longs), pa.array(packs, longs)], ["doc_id", "n_shingles", "set_key", "bands", "packed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, bands array<long>, packed array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "set_key", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "node long, set_key binary, shingles array<long>")


def estimate(a: str, b: str, count: int, bits: int) -> Column:
    """Similarity from two packed signatures: share of equal fields, less what chance makes equal."""
    field = sum(1 << at for at in range(0, 64, bits))
    field -= 1 << 64 if field >= 1 << 63 else 0

    def unlike(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for k in range(1, bits):
            d = d.bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), k))
        return F.bit_count(d.bitwiseAND(F.lit(field)))

    longs = -(-count * bits // 64)
    differing = sum((unlike(F.col(a)[k], F.col(b)[k]) for k in range(1, longs)), unlike(F.col(a)[0], F.col(b)[0]))
    chance = 2.0 ** -bits
    return (1.0 - differing / F.lit(float(count)) - chance) / (1.0 - chance)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, root being the smallest node it reaches; `links` has a, b with a > b.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until nothing changes.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = durable(links.select("a", "b").distinct())
    seen = state(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = durable(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = durable(large.filter("a > b").distinct())
        low = durable(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                              F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = durable(small.select("e.a", "e.b").filter("a > b").distinct())
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _links(nodes: DataFrame, docs: DataFrame, threshold: tuple[int, int], bands: int, rows: int, bits: int) -> DataFrame | None:
    """Components of representatives; `nodes` has node, set_key, n, bands, packed. None if nothing is linked."""
    num, den = threshold
    t, count = num / den, bands * rows
    sure = (1 - 2.0 ** -bits) * t + 2.0 ** -bits
    floor = t - SLACK * math.sqrt(sure * (1 - sure) / count) / (1 - 2.0 ** -bits)
    # A document may represent several classes, so a class goes by its node and its set.
    banded = nodes.select("node", "set_key", F.explode("bands").alias("bucket"))
    shared = durable(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket"))
    member = durable(banded.join(shared, "bucket", "left_semi"))
    wanted = durable(member.select(F.col("node").alias("doc_id")).distinct())
    if wanted.isEmpty():
        return None
    sets = _sets(only_ids(docs.filter("doc_id is not null"), wanted)).dropDuplicates(["node", "set_key"])
    full = durable(sets.join(nodes.select("node", "set_key", "packed"), ["node", "set_key"]))
    # Shingles of one candidate alone; what is left of its set bounds its overlap with any other.
    lone = (full.select("node", "set_key", F.explode("shingles").alias("s")).groupBy("s")
            .agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"), F.min("set_key").alias("set_key"))
            .filter("c = 1").groupBy("node", "set_key").agg(F.count(F.lit(1)).alias("lone")))
    sized = full.select("node", "set_key", F.size("shingles").cast("long").alias("n"), "packed")
    bound = sized.join(lone, ["node", "set_key"], "left").select(
        "node", "set_key", "n", "packed", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("share"))
    # A partner has at least threshold * n shingles, all of them shareable at best.
    able = durable(bound.filter(F.col("share") * den >= F.col("n") * num))
    placed = durable(member.join(able, ["node", "set_key"]))
    side = lambda df, x: df.select("bucket", *[F.col(c).alias(f"{x}_{c}") for c in ("node", "set_key", "n", "packed", "share")])
    a = side(placed, "a")
    # overlap >= t / (1 + t) * (n_a + n_b), in whole numbers
    fits = F.least("a_share", "b_share") * (num + den) >= (F.col("a_n") + F.col("b_n")) * num
    alike = estimate("a_packed", "b_packed", count, bits) >= floor

    hub = placed.groupBy("bucket").agg(
        F.max(F.struct((F.col("share") / F.col("n")).alias("r"), (-F.col("node")).alias("k"), F.col("set_key").alias("s"))).alias("hub"),
        F.min(F.struct("node", "set_key")).alias("first"))
    both = F.array(F.struct((-F.col("hub.k")).alias("node"), F.col("hub.s").alias("set_key")), F.col("first"))
    leaders = durable(hub.select("bucket", F.explode(F.array_distinct(both)).alias("l")).select(
        "bucket", F.col("l.node").alias("b_node"), F.col("l.set_key").alias("b_set_key")))
    leaders = leaders.join(able.select(*[F.col(c).alias(f"b_{c}") for c in ("node", "set_key", "n", "packed", "share")]),
                           ["b_node", "b_set_key"])
    first = a.join(leaders, "bucket").filter((F.col("a_node") != F.col("b_node")) & fits & alike)
    found = _confirmed(first, full, num, den)
    roots = durable(components(found))
    linked = placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = durable(linked.groupBy("bucket").agg((F.min("root") != F.max("root")).alias("m")).filter("m").select("bucket"))
    rest = durable(linked.join(mixed, "bucket", "left_semi"))
    if rest.isEmpty():
        return roots
    rest = rest.join(nodes.select("node", "set_key", "bands"), ["node", "set_key"])
    used = ("node", "set_key", "n", "packed", "share", "root", "bands")
    a = rest.select("bucket", *[F.col(c).alias(f"a_{c}") for c in used])
    b = rest.select("bucket", *[F.col(c).alias(f"b_{c}") for c in used])
    # A pair that shares several buckets is made in the first of them only.
    before = lambda bands: F.slice(bands, F.lit(1), F.array_position(bands, a["bucket"]).cast("int") - 1)
    once = F.forall(F.zip_with(before(F.col("a_bands")), before(F.col("b_bands")), lambda x, y: x != y), lambda x: x)
    cross = a.join(b, (a["bucket"] == b["bucket"]) & (F.col("a_node") > F.col("b_node"))
                   & (F.col("a_root") != F.col("b_root")) & fits & alike & once)
    more = _confirmed(cross, full, num, den)
    return components(found.unionByName(more))


def _confirmed(pairs: DataFrame, full: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b), a > b, of nodes with classes whose full sets are similar enough."""
    sides = [F.struct(F.col(f"{x}_node").alias("node"), F.col(f"{x}_set_key").alias("set_key")) for x in "ab"]
    once = pairs.select(F.greatest(*sides).alias("h"), F.least(*sides).alias("l")).select(
        F.col("h.node").alias("a"), F.col("h.set_key").alias("a_key"), F.col("l.node").alias("b"), F.col("l.set_key").alias("b_key"))
    once = durable(once.distinct())
    sets = lambda x: full.select(
        F.col("node").alias(x), F.col("set_key").alias(f"{x}_key"), F.col("shingles").alias(f"{x}_set"))
    both = once.join(sets("a"), ["a", "a_key"]).join(sets("b"), ["b", "b_key"])
    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - common
    return durable(both.filter(common * den >= union * num).select("a", "b"))


def near_duplicates(docs: DataFrame, percent: int = 80, rows: int = ROWS, bits: int = BITS,
                    miss: float = MISS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept. Links have 100 * overlap >= percent * union."""
    if 64 % bits:
        raise ValueError("bits must divide 64")
    bands = bands_for(percent / 100, rows, miss)
    signed = durable(_signatures(docs, bands, rows, bits))
    full = signed.filter("set_key is not null")
    reps = durable(full.groupBy("set_key").agg(F.min("doc_id").alias("node")))
    nodes = full.join(reps, "set_key").filter("doc_id = node").select(
        "node", "set_key", F.col("n_shingles").alias("n"), "bands", "packed").dropDuplicates(["node", "set_key"])
    nodes = durable(nodes)
    roots = _links(nodes, docs, (percent, 100), bands, rows, bits)
    # Rows of one id with different texts link their classes.
    owned = durable(full.select("doc_id", "set_key").join(reps, "set_key").select("doc_id", "node"))
    final = owned if roots is None else owned.join(roots, "node", "left").withColumn("node", F.coalesce("root", "node"))
    best = final.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    best = durable(best)
    if not best.filter("low != high").isEmpty():
        links = best.filter("low != high").select(F.col("high").alias("a"), F.col("low").alias("b"))
        again = components(links).select(F.col("node").alias("low"), "root")
        best = best.join(again, "low", "left").withColumn("low", F.coalesce("root", "low"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))
    out = signed.select("doc_id", "n_shingles").join(best.select("doc_id", "low"), "doc_id", "left")
    out = out.withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without the later members of each group; rows that repeat one id are one document."""
    judged = durable(near_duplicates(docs, percent))
    dropped = durable(judged.filter(~F.col("kept")).select("doc_id").distinct())
    left = without_ids(docs, dropped)
    repeated = durable(judged.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return left
    return without_ids(left, repeated).unionByName(only_ids(left, repeated).dropDuplicates(["doc_id"]))
