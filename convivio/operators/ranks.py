"""Row numbers and exact ranks over a whole table, without a one-task window."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

_SLOT, _PART = "_slot", "_part"


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Range-partitioned and sorted rows with a stored (partition, position) slot.

    Storing them fixes the slots, so all later readers see the same partitions even when tasks
    are retried.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = durable(ordered.withColumn(_SLOT, F.monotonically_increasing_id()))
    return fixed.withColumn(_PART, F.shiftrightunsigned(_SLOT, 33))


def number_rows(df: DataFrame, order: list[str], name: str = "row_index",
                start: int | Callable[[int], int] = 1) -> DataFrame:
    """Dense ids start, start+1, ... in the given order, which must be a key of the table.

    `start` may be a function of the number of rows, which is asked once they are counted.

    Only one count per range partition reaches the driver, and as many are broadcast: their
    number is the partition count, whatever the table holds.
    """
    fixed = _ranged(df, order)
    counts = sorted(tuple(row) for row in fixed.groupBy(_PART).count().collect())
    before = [0, *accumulate(count for _, count in counts)]
    start = start(before[-1]) if callable(start) else start
    rows = [(part, first) for (part, _), first in zip(counts, before)]
    offsets = df.sparkSession.createDataFrame(rows, f"{_PART} long, _before long")
    position = F.col("_before") + F.col(_SLOT).bitwiseAND(F.lit((1 << 33) - 1)) + start
    return fixed.join(F.broadcast(offsets), _PART).select(*df.columns, position.alias(name))


def sample_stats(samples: DataFrame, group: str = "group", value: str = "latency_ms",
                 ok: str = "ok") -> DataFrame:
    """Count, requested, errors, min, max, mean, median, p95, p99, population std dev per group.

    Ranks are zero-based positions in the sorted values: n // 2 for the median, and
    min(n - 1, int(n * q)) for the percentiles. A group without successes keeps its counts.

    Equal values collapse to one weighted row in the map tasks, and the weighted rows are range
    partitioned by (group, value), so a group of any size is spread over many tasks. Counts per
    (group, partition) tell which partitions hold the wanted positions; only their rows get
    running totals.
    """
    seen = F.when(F.col(ok), F.col(value))
    facts = samples.groupBy(group).agg(
        F.count(seen).alias("count"), F.count(F.lit(1)).alias("requested_iterations"),
        (F.count(F.lit(1)) - F.count(seen)).alias("error_count"), F.min(seen).alias("min"),
        F.max(seen).alias("max"), F.avg(seen).alias("mean"), F.stddev_pop(seen).alias("std_dev"))
    picks = _value_at_ranks(samples.select(F.col(group).alias("_group"), seen.alias("_value")))
    # Null-safe: samples without a group are a group of their own.
    joined = facts.join(picks, F.col(group).eqNullSafe(F.col("_group")), "left")
    return joined.select(group, "count", "requested_iterations", "error_count", "min", "max", "mean",
                         "median", "p95", "p99", "std_dev")


def _value_at_ranks(values: DataFrame) -> DataFrame:
    """Median, p95 and p99 of `_value` per `_group`."""
    weighted = (values.filter(F.col("_value").isNotNull())
                .groupBy("_group", "_value").agg(F.count(F.lit(1)).alias("_freq")))
    fixed = _ranged(weighted, ["_group", "_value"])
    # A group has at most as many cells as there are partitions.
    cells = fixed.groupBy("_group", _PART).agg(F.sum("_freq").alias("_cell"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("_n", F.sum("_cell").over(whole)).withColumn(
        "_before", F.sum("_cell").over(earlier) - F.col("_cell"))
    n = F.col("_n")
    # A bare 0.95 would be a decimal and could floor differently from a double.
    ranks = {"median": F.floor(n / 2)} | {
        name: F.least(n - 1, F.floor(n.cast("double") * F.lit(q))) for name, q in (("p95", 0.95), ("p99", 0.99))}
    held = [(F.col("_before") <= r) & (r < F.col("_before") + F.col("_cell")) for r in ranks.values()]
    wanted = cells.filter(held[0] | held[1] | held[2]).select(
        F.col("_group").alias("_g"), F.col(_PART).alias("_p"), "_before", "_n")
    rows = fixed.join(wanted, F.col("_group").eqNullSafe(F.col("_g")) & (F.col(_PART) == F.col("_p")))
    within = Window.partitionBy("_group", _PART).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, 0)
    upto = rows.withColumn("_upto", F.sum("_freq").over(within) + F.col("_before"))
    return upto.groupBy("_group").agg(*[
        F.min(F.when(F.col("_upto") > r, F.col("_value"))).alias(name) for name, r in ranks.items()])
