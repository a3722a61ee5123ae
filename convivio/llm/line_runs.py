"""Line dedup with a suffix array over the documents' line sequences.

Lines become numbers: unique lines end every common run, so only lines that stand at least twice are ranked, by the
order of their hashes. Prefix doubling then ranks every suffix by its first 2, 4, ... lines: the pairs
(rank here, rank `h` lines on) are sorted and numbered in parallel by range partitions, and the last step overlaps so
that it ends at `min_lines`. Suffixes of equal rank at depth d are the intervals of the suffix array whose longest
common prefix is at least d lines. In each interval the first suffix, in the order of doc_id and line, is the
original and all others start later copies of a run; overlapping copies unite to the maximal repeated runs, which are
deleted. Deeper ranks could not change that union, so doubling stops at `min_lines`.

Single lines of at least `min_chars` characters are runs already (the intervals of depth one). Lines without a word
take no part and stay.

Defined results: a null text stays null, and a null doc_id orders last. Rows with equal doc_id and text are one
document and get the same result. Copies inside one document count too. Documents are never dropped here; a text of
which every line is a later copy becomes empty. An empty table gives an empty result. Extra columns pass through; the
operator's own columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import number_rows
from ..session import durable
from .common import WORD, sheltered

MIN_LINES, MIN_CHARS = 3, 24
_KEY = ["_id", "_key"]


def _keyed(docs: DataFrame) -> DataFrame:
    """A null id orders after all others."""
    last = F.lit(2**63 - 1).cast("long")
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), last)).withColumn("_key", F.xxhash64("text"))


def _lines(docs: DataFrame) -> DataFrame:
    """One narrow row per line with a word: _id, _key, seq (among such lines), no (among all), hashes, chars."""
    marked = F.transform(F.split("text", "\n"), lambda line, no: F.struct(no.alias("no"), line.alias("line")))
    worded = F.filter(marked, lambda e: e["line"].rlike(WORD))
    packed = F.transform(worded, lambda e: F.struct(
        e["no"].alias("no"), F.xxhash64(e["line"]).alias("h1"), F.xxhash64(F.lit(1), e["line"]).alias("h2"),
        F.length(e["line"]).alias("chars")))
    return _keyed(docs).select(*_KEY, F.posexplode(packed).alias("seq", "e")).select(
        *_KEY, "seq", "e.no", "e.h1", "e.h2", "e.chars")


def _doubled(ranks: DataFrame, depth: int, step: int) -> DataFrame:
    """Ranks by depth + step lines from ranks by depth lines (step <= depth); shorter suffixes drop out."""
    ahead = ranks.select(*_KEY, (F.col("seq") - step).alias("seq"), F.col("rank").alias("next"))
    pairs = durable(ranks.join(ahead, [*_KEY, "seq"]))
    # Only pairs that stand twice can begin a repeated run.
    shared = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("rank", "next")
    named = durable(number_rows(shared, ["rank", "next"], "deeper"))
    return durable(pairs.join(named, ["rank", "next"]).select(*_KEY, "seq", F.col("deeper").alias("rank")))


def suffix_ranks(lines: DataFrame, min_lines: int) -> tuple[DataFrame, DataFrame]:
    """(repeated lines with their rank at depth one, ranks at depth `min_lines`); equal rank: common prefix."""
    once = lines.dropDuplicates([*_KEY, "seq"])
    shared = once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h1", "h2")
    named = durable(number_rows(shared, ["h1", "h2"], "rank"))
    base = durable(once.join(named, ["h1", "h2"]).select(*_KEY, "seq", "no", "chars", "rank"))
    ranks, depth = base.select(*_KEY, "seq", "rank"), 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        ranks, depth = _doubled(ranks, depth, step), depth + step
    return base, ranks


def _later(ranks: DataFrame) -> DataFrame:
    """Starts of later copies: all members of an interval but the first."""
    first = durable(ranks.groupBy("rank").agg(F.min(F.struct(*_KEY, "seq")).alias("first")))
    return ranks.join(first, "rank").filter(F.struct(*_KEY, "seq") != F.col("first")).select(*_KEY, "seq")


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_id, _key, cut, n_runs): the line numbers to delete and the number of maximal runs they form."""
    base, ranks = suffix_ranks(_lines(docs.filter("text is not null")), min_lines)
    single = _later(base.filter(F.col("chars") >= min_chars).select(*_KEY, "seq", "rank"))
    runs = _later(ranks).select(*_KEY, F.explode(F.sequence("seq", F.col("seq") + (min_lines - 1))).alias("seq"))
    cut = single.unionByName(runs).distinct().join(base.select(*_KEY, "seq", "no"), [*_KEY, "seq"])
    # A document's own line numbers: as large as the document.
    gathered = cut.groupBy(*_KEY).agg(F.collect_list("no").alias("cut"), F.collect_list("seq").alias("seqs"))
    starts = F.array_except("seqs", F.transform("seqs", lambda s: s + 1))
    return gathered.select(*_KEY, "cut", F.size(starts).alias("n_runs"))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every document with its text without later copies, n_lines, n_cut and n_runs."""
    narrow, back = sheltered(docs, ["doc_id", "text"], ["n_lines", "n_cut", "n_runs"])
    cuts = durable(repeated_lines(narrow.select("doc_id", "text"), min_lines, min_chars))
    joined = _keyed(narrow).join(cuts, _KEY, "left")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("cut"))
    text = F.when(F.col("cut").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda no: F.get(lines, no)), "\n"))
    count = F.when(F.col("text").isNotNull(), F.size(lines)).otherwise(0)
    out = joined.withColumn("n_lines", count.cast("long")).withColumn("text", text)
    return back(out, "n_lines", F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_cut"),
                F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"))
