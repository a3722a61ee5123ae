"""Exact duplicates with a heavy-hitter split.

A text's digest is the SHA-256 of its bytes after lower-casing A-Z; texts with one digest are equal. One digest may hold
a third of all rows, so frequent digests never meet a shuffle:

1. Each task keeps a Misra-Gries summary of its digests: `counters` counts, and whenever there are more, the next
   largest count is taken off all. Summaries are added up and cut once more in the same way. Every digest
   with more than n / (counters + 1) of the n rows is then among at most `counters` candidates.
2. Candidates are verified: an exact pass counts their rows and finds the one that stays.
3. The verified winners, at most `counters` rows of some 70 bytes, are broadcast, and settle their rows in the map tasks.
4. Remaining digests take one ordinary shuffle. A group there has at most n / (counters + 1) rows, a fraction of a
   mean shuffle partition, as `counters` follows the number of shuffle partitions.

Defined results: a null text counts as empty. Of equal texts the row with the largest doc_id stays; a null doc_id is
lower than all others. Of rows that share both id and text one stays. An empty table gives an empty result. Extra columns pass through in
`without_copies`, whatever their names; `find_copies` returns its own columns only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .common import ascii_lower, fresh, only_ids, without_ids

# The number of counters: at least LEAST, four for each shuffle partition, at most MOST (5 MB of winners).
LEAST, MOST = 4096, 65_536


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))).cast("binary"), 256))


def counters_for(df: DataFrame) -> int:
    return min(MOST, max(LEAST, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def cut(counts: np.ndarray, counters: int) -> np.ndarray:
    """Counts less the (counters + 1)-th largest of them, so that at most `counters` stay above zero."""
    if len(counts) <= counters:
        return counts
    return counts - np.partition(counts, -counters - 1)[-counters - 1]


def summaries(digests: DataFrame, counters: int) -> DataFrame:
    """The Misra-Gries summary of each task: (digest, count)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"digest": pa.array([], pa.binary()), "count": pa.array([], pa.int64())})
        for batch in batches:
            new = pa.table({"digest": batch.column(0), "count": pa.array(np.ones(batch.num_rows, np.int64))})
            summed = pa.concat_tables([held, new]).group_by("digest").aggregate([("count", "sum")])
            left = cut(summed["count_sum"].to_numpy(), counters)
            stay = np.flatnonzero(left > 0)
            held = pa.table({"digest": summed["digest"].take(stay), "count": pa.array(left[stay])})
        yield from held.combine_chunks().to_batches()

    return digests.select("digest").mapInArrow(run, "digest binary, count long")


def candidates(digests: DataFrame, counters: int) -> DataFrame:
    """At most `counters` digests, all with more than n / (counters + 1) rows among them."""
    merged = summaries(digests, counters).groupBy("digest").agg(F.sum("count").alias("count"))
    # At most counters + 1 rows reach the driver.
    top = merged.orderBy(F.desc("count"), "digest").limit(counters + 1).collect()
    left = cut(np.array([r["count"] for r in top], np.int64), counters)
    chosen = [(r["digest"],) for r, count in zip(top, left) if count > 0]
    return digests.sparkSession.createDataFrame(chosen, "digest binary")


def winners(digests: DataFrame, chosen: DataFrame) -> DataFrame:
    """The verified size of each candidate's group, and the id and row that stay."""
    held = digests.join(F.broadcast(chosen), "digest")
    stays = F.coalesce(F.max_by("row", "doc_id"), F.min("row"))
    return held.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"),
                                      stays.alias("keep_row"))


def _judged(docs: DataFrame, counters: int | None) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept."""
    counters = counters or counters_for(docs)
    digests = durable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"))
                      .withColumn("row", F.monotonically_increasing_id()))
    best = durable(winners(digests, candidates(digests, counters)))
    heavy = digests.join(F.broadcast(best), "digest").withColumn("kept", F.col("row") == F.col("keep_row"))
    light = digests.join(F.broadcast(best.select("digest")), "digest", "left_anti")
    group = Window.partitionBy("digest")
    place = F.row_number().over(group.orderBy(F.desc_nulls_last("doc_id"), "row"))
    light = (light.withColumn("kept", place == 1).withColumn("group_size", F.count(F.lit(1)).over(group))
             .withColumn("keep_id", F.max("doc_id").over(group)))
    names = ["doc_id", "digest", "keep_id", "group_size", "kept"]
    return heavy.select(*names).unionByName(light.select(*names))


def find_copies(docs: DataFrame, counters: int | None = None) -> DataFrame:
    """Every document with keep_id, group_size, kept and text_sha256."""
    return _judged(docs, counters).select("doc_id", "keep_id", "group_size", "kept",
                                          F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, counters: int | None = None) -> DataFrame:
    """The rows that stay, with all their columns. Texts are not shuffled but for ids that stand more than once."""
    judged = durable(_judged(docs, counters))
    by_id = judged.filter("doc_id is not null").groupBy("doc_id").agg(
        F.bool_or("kept").alias("some"), F.bool_and("kept").alias("all"))
    by_id = durable(by_id.filter("NOT all"))
    left = without_ids(docs, by_id.filter("NOT some").select("doc_id"))
    # Rows without an id, or with an id of which only some rows stay, go by their text as well.
    partly = durable(by_id.filter("some").select("doc_id"))
    digest, stay_id, stay_digest = fresh(docs, "digest", "stay_id", "stay_digest")
    marked = left.filter("doc_id is null").unionByName(only_ids(left, partly))
    marked = marked.withColumn(digest, digest_of(F.col("text"))).dropDuplicates(["doc_id", digest])
    stay = judged.filter("kept").select(F.col("doc_id").alias(stay_id), F.col("digest").alias(stay_digest))
    same = F.col("doc_id").eqNullSafe(F.col(stay_id)) & (F.col(digest) == F.col(stay_digest))
    marked = marked.join(stay, same, "left_semi").drop(digest)
    return without_ids(left.filter("doc_id is not null"), partly).unionByName(marked)
