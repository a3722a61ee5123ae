"""Declared constraints checked as data-quality jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import zero_if_null


@dataclass
class Constraints:
    """What a table declares; `allowed` and `positive` are its CHECK rules."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    positive: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)


def audit(name: str, df: DataFrame, rules: Constraints) -> DataFrame:
    """Violations per rule. All row rules share one scan and one map-side sum."""
    tests = {f"not_null({c})": F.col(c).isNull() for c in rules.not_null}
    tests |= {f"allowed({c})": ~F.col(c).isin(list(v)) for c, v in rules.allowed.items()}
    tests |= {f"positive({c})": F.col(c) <= 0 for c in rules.positive}
    tests |= {f"max_length({c})": F.length(c) > n for c, n in rules.max_length.items()}
    parts = []
    if tests:
        sums = df.agg(*[F.coalesce(F.sum(F.when(t, 1).otherwise(0)), F.lit(0)).cast("long").alias(n)
                        for n, t in tests.items()])
        rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in tests])
        parts.append(sums.select(F.inline(rows)))
    parts += [_unique(df, keys) for keys in rules.unique]
    merged = reduce(DataFrame.unionByName, parts)
    return merged.select(F.lit(name).alias("table_name"), "rule", "violations")


def _unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_repeats")).filter("_repeats > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(f"unique({','.join(keys)})").alias("rule"), "violations")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with their number of rows.

    Child rows are counted per value before the anti join, so a value held by a third of the
    rows is one row there.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"))
    return values.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The orphan rows themselves; AQE splits the join partition of a hot value."""
    parents = parent.select(F.col(parent_key).alias(column))
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti").select(*child.columns)


def foreign_key_report(links: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per link (name, child, column, parent, parent key): orphan values and rows.

    Every child and every parent is scanned once, however many links it has: a child row yields a key for each of its
    links, and all links to one parent are counted side by side, so that a key is one row with a count for each link
    when it meets the parent. Tables are told apart as objects; pass the same DataFrame for the same table.
    """
    reports = []
    for parent, parent_key in {(id(p), k): (p, k) for _, _, _, p, k in links}.values():
        mine = [link for link in links if link[3] is parent and link[4] == parent_key]
        kind = parent.schema[parent_key].dataType
        keys = None
        for child in {id(link[1]): link[1] for link in mine}.values():
            found = F.array(*[F.struct(F.lit(n).alias("link"), F.col(link[2]).cast(kind).alias("key"))
                              for n, link in enumerate(mine) if link[1] is child])
            rows = child.select(F.inline(F.filter(found, lambda e: e["key"].isNotNull())))
            keys = rows if keys is None else keys.unionByName(rows)
        counts = keys.groupBy("key").agg(*[F.count_if(F.col("link") == n).alias(f"n{n}") for n in range(len(mine))])
        orphans_of = counts.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")
        sums = orphans_of.agg(*[c for n in range(len(mine)) for c in (
            F.count_if(F.col(f"n{n}") > 0).alias(f"keys{n}"), zero_if_null(F.sum(f"n{n}")).alias(f"rows{n}"))])
        reports.append(sums.select(F.inline(F.array(*[
            F.struct(F.lit(link[0]).alias("link"), F.col(f"keys{n}").alias("orphan_keys"), F.col(f"rows{n}").alias("orphan_rows"))
            for n, link in enumerate(mine)]))))
    return reduce(DataFrame.unionByName, reports)


def cascade_delete(deleted: DataFrame, children: Mapping[str, tuple[DataFrame, Sequence[str]]],
                   key: str = "user_id") -> dict[str, DataFrame]:
    """Children left after the listed parents go; each child names its referring columns.

    `deleted` meets the children without an aggregate in between: AQE splits the partition of a
    user with very many children only when both join inputs are plain exchanges.
    """
    gone = deleted.select(key)
    left = {}
    for name, (child, columns) in children.items():
        for column in columns:
            child = child.join(gone.withColumnRenamed(key, column), column, "left_anti").select(*child.columns)
        left[name] = child
    return left


def counter_drift(table: DataFrame, key: str, stored: str, actual: DataFrame, actual_key: str) -> DataFrame:
    """Rows whose stored counter differs from the real number of rows per key."""
    counted = actual.groupBy(F.col(actual_key).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    real = zero_if_null(F.col("_n"))
    return (table.select(key, F.col(stored).alias("stored")).join(counted, key, "left")
            .select(key, "stored", real.alias("actual"), (F.col("stored") - real).alias("drift"))
            .filter(F.coalesce(F.col("stored") != F.col("actual"), F.lit(True))))
