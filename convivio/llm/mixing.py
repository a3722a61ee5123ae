"""Mixing sources to target weights by Pfair scheduling.

Time is cut into slots of one block. Block k of a source with weight w is released at slot floor(k / w) and
due by slot ceil((k + 1) / w); in each slot the released block with the earliest deadline runs. With weights
that add up to one, every source has at every slot had its share to within less than one block.

Weights are rounded to whole parts of a cycle of `cycle` slots, so the schedule repeats after each cycle: it is
worked out once, from the weights alone, and block k of a source with c parts runs in cycle k div c at the
place of its (k mod c)-th slot. Everything else is DataFrame functions. A source with a third of all rows is
numbered in many hash ranges; only one count per source class and range is gathered, and counts add up to
offsets within a class.

When a source has no blocks left its slots stay empty; the others keep their places.

Defined results: sources without a weight, and null, form one class that shares the weight `rest`. Every row
gets a slot, none is dropped. Rows are dealt in the order of md5(doc_id), then doc_id, then text; equal rows
take consecutive places, and rows without an id are dealt by a hash of text and source. An empty table gives an empty result. Extra columns pass through; the operator's own
columns replace columns of the same name.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .common import sheltered

# Target weights: one dominant source is cut back to an eighth, the others share the remainder evenly.
WEIGHTS = {"src0": 0.125} | {f"src{n}": 0.045 for n in range(1, 20)}
REST, CYCLE, BLOCK_ROWS, RANGES = 0.02, 400, 16, 4096


def whole_parts(weights: dict[str, float], rest: float, cycle: int) -> dict[str | None, int]:
    """Slots of each class in one cycle, by largest remainder; None is the class of all other sources."""
    share = {**weights, None: rest}
    if any(w < 0 for w in share.values()) or sum(share.values()) <= 0:
        raise ValueError("weights must not be negative, and some must be positive")
    exact = {k: cycle * w / sum(share.values()) for k, w in share.items()}
    # Every class keeps at least one slot, so that no row waits for ever.
    parts = {k: max(1, int(x)) for k, x in exact.items()}
    ranked = sorted(exact, key=lambda k: (parts[k] - exact[k], str(k)))
    while sum(parts.values()) < cycle:
        for k in ranked[:cycle - sum(parts.values())]:
            parts[k] += 1
    while sum(parts.values()) > cycle:
        largest = max(parts, key=lambda k: (parts[k] - exact[k] if parts[k] > 1 else -1.0, str(k)))
        if parts[largest] == 1:
            raise ValueError("the cycle is shorter than the number of sources")
        parts[largest] -= 1
    return parts


def cycle_slots(parts: dict[str | None, int]) -> dict[str | None, list[int]]:
    """Earliest deadline first over one cycle: the slots of each class."""
    cycle = sum(parts.values())
    slots: dict[str | None, list[int]] = {k: [] for k in parts}
    for now in range(cycle):
        ready = [k for k, c in parts.items() if len(slots[k]) < c and len(slots[k]) * cycle // c <= now]
        due = min(ready, key=lambda k: (ceil((len(slots[k]) + 1) * cycle / parts[k]), str(k)))
        slots[due].append(now)
    return slots


def _class_of(source: Column, names: list[str]) -> Column:
    return F.when(source.isin(names), source)


def schedule(block: Column, group: Column, slots: dict[str | None, list[int]]) -> Column:
    """The slot of a block of a class, from the literal table of one cycle."""
    cycle = sum(map(len, slots.values()))
    places = F.map_from_arrays(F.array(*[F.lit(k if k is not None else "") for k in slots]),
                               F.array(*[F.array(*[F.lit(s) for s in places]) for places in slots.values()]))
    mine = F.element_at(places, F.coalesce(group, F.lit("")))
    c = F.size(mine).cast("long")
    return (F.floor(block / c) * cycle + F.element_at(mine, (block % c + 1).cast("int"))).cast("long")


def interleave(docs: DataFrame, weights: dict[str, float] | None = None, rest: float = REST, cycle: int = CYCLE,
               block_rows: int = BLOCK_ROWS, ranges: int = RANGES, source: str = "source") -> DataFrame:
    """All rows with `mix_class`, `mix_number` (in its class), `mix_block`, `mix_slot` and `mix_place` (in its block)."""
    weights = WEIGHTS if weights is None else weights
    if "" in weights:
        raise ValueError("the empty name is not a source")
    own = {"mix_class", "mix_number", "mix_block", "mix_slot", "mix_place"}
    slots = cycle_slots(whole_parts(weights, rest, cycle))
    narrow, back = sheltered(docs, ["doc_id", source, "text"], own)
    named = narrow.withColumn("mix_class", _class_of(F.col(source), list(weights)))
    # Rows without an id are spread by what else they hold.
    other = F.md5(F.xxhash64(*[F.col(c) for c in ("text", source) if c in docs.columns]).cast("string").cast("binary"))
    mark = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), other)
    # The leading digits of the order are the range: ranges follow one another, and each fits one task.
    width = (ranges - 1).bit_length()
    span = F.shiftright(F.coalesce(F.conv(F.substring(mark, 1, 8), 16, 10).cast("long"), F.lit(0).cast("long")), 32 - width)
    keyed = named.withColumn("_mark", mark).withColumn("_range", span)
    counts = keyed.groupBy("mix_class", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("mix_class").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most `ranges` rows for each class that has a weight: a few megabytes.
    offsets = durable(counts.select("mix_class", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    within = Window.partitionBy("mix_class", "_range").orderBy("_mark", "doc_id", *(["text"] if "text" in docs.columns else []))
    numbered = keyed.withColumn("_at", F.row_number().over(within).cast("long") - 1)
    offsets = offsets.withColumnsRenamed({"mix_class": "_class", "_range": "_r"})
    number = numbered.join(F.broadcast(offsets), (F.col("_range") == F.col("_r")) & F.col("mix_class").eqNullSafe(F.col("_class")))
    block = F.floor(F.col("mix_number") / block_rows)
    out = (number.withColumn("mix_number", F.col("_before") + F.col("_at")).withColumn("mix_block", block)
           .withColumn("mix_slot", schedule(F.col("mix_block"), F.col("mix_class"), slots))
           .withColumn("mix_place", F.col("mix_number") % block_rows))
    return back(out, "mix_class", "mix_number", "mix_block", "mix_slot", "mix_place")
