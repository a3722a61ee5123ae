"""Comparisons and summaries of recorded experiment results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import round_even


# The reading given with each experiment, and the one for a missing result.
READINGS = {
    "exp1": "La linea base compara escritura en el primary y lecturas por PK entre primary y replicas.",
    "exp3": "Este experimento cuantifica el costo de habilitar confirmacion sincronica de replicas.",
    "exp4": "Se documenta coordinacion manual entre shards logicos y una aproximacion de rollback controlado.",
    "exp5": "El failover queda documentado como procedimiento manual con evidencia del estado previo.",
}
PENDING_READING = " aun no tiene resultados persistidos."


def compare_modes(runs: DataFrame, group: str, round_first: bool = False) -> DataFrame:
    """Cost per inserted row of the modes `on` and `off`, and the improvement of `off` in percent.

    Decimal times, as the table declares them, sum exactly in any order. `round_first` takes the percentage from costs already rounded to four places. The percentage
    is zero when the `on` cost is zero or missing.
    """
    def cost(mode):
        here = F.col("commit_mode") == mode
        return (F.sum(F.when(here, F.col("elapsed_ms"))).cast("double")
                / F.nullif(F.sum(F.when(here, F.col("inserted_rows"))), F.lit(0)))

    costs = runs.groupBy(group).agg(cost("on").alias("on_ms"), cost("off").alias("off_ms"))
    on, off = F.col("on_ms"), F.col("off_ms")
    if round_first:
        on, off = round_even(on, 4), round_even(off, 4)
    gain = F.when(F.coalesce(on, F.lit(0.0)) == 0, F.lit(0.0)).otherwise((on - off) / F.nullif(on, F.lit(0.0)) * 100)
    return costs.select(
        group, round_even(F.col("on_ms"), 4).alias("sync_per_insert_ms"),
        round_even(F.col("off_ms"), 4).alias("async_per_insert_ms"),
        round_even(gain, 2).alias("async_improvement_pct"))


def _number(payload: Column, path: str, default: float | None = None) -> Column:
    found = F.get_json_object(payload, path).cast("double")
    return found if default is None else F.coalesce(found, F.lit(float(default)))


def summarise(documents: DataFrame, name: str = "name", payload: str = "payload") -> DataFrame:
    """One row per experiment and metric from (name, JSON text) documents.

    A null or empty payload is an experiment that has not run: available false, status pending, and
    one row without a metric. Each kind of experiment keeps its own metrics and reading.
    """
    doc = F.col(payload)

    def metrics(*pairs):
        return F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in pairs])

    def entry(status, rows):
        return F.struct(status.alias("status"), rows.alias("metrics"))

    latency = metrics(*[(f"{label}_mean_ms", _number(doc, f"$.{part}.mean", 0.0)) for label, part in [
        ("write", "write_primary"), ("read_primary", "read_primary"),
        ("read_replica1", "read_replica1"), ("read_replica2", "read_replica2")]])
    # The summary of exp3 is passed on whole, whatever its metrics are called.
    modes = F.transform(F.map_entries(F.from_json(F.get_json_object(doc, "$.summary"), "map<string,double>")),
                        lambda e: F.struct(e["key"].alias("metric"), e["value"].alias("value")))
    scenario = "$.success_scenario"
    follow = metrics(("elapsed_ms", _number(doc, f"{scenario}.elapsed_ms", 0.0)),
                     ("source_shard", _number(doc, f"{scenario}.source_shard")),
                     ("target_shard", _number(doc, f"{scenario}.target_shard")))
    follow_status = F.lower(F.coalesce(F.get_json_object(doc, "$.result"),
                                       F.get_json_object(doc, f"{scenario}.result"), F.lit("ok")))
    replicas = F.get_json_object(doc, "$.pre_failover_state.replication_status")
    replica_count = F.coalesce(F.json_array_length(replicas), F.lit(0)).cast("double")
    dry_run = F.coalesce(F.get_json_object(doc, "$.mode") == "dry-run", F.lit(False))
    ok, none = F.lit("ok"), F.lit(None).cast("array<struct<metric:string,value:double>>")
    kind = F.col(name)
    absent = doc.isNull() | doc.rlike(r"^\s*(\{\s*\})?\s*$")
    found = (F.when(absent, entry(F.lit("pending"), none))
             .when(kind == "exp1", entry(ok, latency))
             .when(kind == "exp3", entry(ok, modes))
             .when(kind == "exp4", entry(follow_status, follow))
             .when(kind == "exp5", entry(F.when(dry_run, "dry-run").otherwise("ok"),
                                         metrics(("replica_count", replica_count))))
             .otherwise(entry(ok, none)))
    reading = F.when(absent, F.concat(kind, F.lit(PENDING_READING)))
    for known, text in READINGS.items():
        reading = reading.when(kind == known, text)
    rows = documents.select(kind.alias("experiment"), (~absent).alias("available"), found.alias("found"),
                            reading.otherwise("").alias("interpretation"))
    return rows.select("experiment", "available", "found.status", "interpretation",
                       F.inline_outer("found.metrics"))


def nest_summary(summary: DataFrame) -> DataFrame:
    """One row per experiment with its metrics as a map; an experiment has a handful of them."""
    named = F.collect_list(F.when(F.col("metric").isNotNull(), F.struct("metric", "value")))
    return (summary.groupBy("experiment", "available", "status", "interpretation")
            .agg(F.map_from_entries(named).alias("metrics")))


def compare_engines(first: DataFrame, second: DataFrame, payload: str = "payload") -> DataFrame:
    """Write, read and join means of two systems side by side.

    The first document may hold nested groups or flat fields, the second flat fields; the
    defaults stand in for what is missing. Both inputs hold at most one document, reached as
    scalar subqueries; more than one fails the query.
    """
    # Nested group, flat field and the two defaults of each metric.
    fields = [("write", "write_primary", "write_mean_ms", 10.0, 20.0),
              ("read", "read_primary", "read_mean_ms", 5.0, 15.0),
              ("join", "secondary_join_metric", "join_mean_ms", 300.0, 120.0)]
    spark = first.sparkSession
    only = F.when(F.count(payload) > 1, F.raise_error(F.lit("more than one document"))).otherwise(F.max(payload))
    one, two = first.agg(only).scalar(), second.agg(only).scalar()
    docs = spark.range(1).select(one.alias("a"), two.alias("b"))
    a, b = F.col("a"), F.col("b")
    rows = F.array(*[
        F.struct(F.lit(metric).alias("metric"),
                 F.coalesce(_number(a, f"$.{nested}.mean"), _number(a, f"$.{flat}"), F.lit(left)).alias("first_ms"),
                 F.coalesce(_number(b, f"$.{flat}"), F.lit(right)).alias("second_ms"))
        for metric, nested, flat, left, right in fields])
    return docs.select(F.inline(rows))
