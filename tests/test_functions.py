import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from convivio.functions import draws
from convivio.functions import scalars as S


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("value, text", [
    (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (12345, "12 kB"), (1234567, "1206 kB"),
    (10485247, "10239 kB"), (10485248, "10 MB"), (2**33, "8192 MB"), (2**34, "16 GB"), (5 * 2**43, "40 TB")])
def test_size_text(spark, value, text):
    assert one(spark, S.size_text(F.lit(value).cast("long"))) == text


@pytest.mark.parametrize("value, shard", [(0, 0), (1, 1), (5, 2), (-5, 1), (-3, 0), (None, None)])
def test_shard_of(spark, value, shard):
    assert one(spark, S.shard_of(F.lit(value).cast("long"))) == shard


@pytest.mark.parametrize("value, digits, want", [(2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (0.375, 2, 0.38)])
def test_round_even(spark, value, digits, want):
    assert one(spark, S.round_even(F.lit(value), digits)) == want == round(value, digits)


def test_times(spark):
    a, b = dt.datetime(2026, 3, 29, 1, 30), dt.datetime(2026, 3, 29, 3, 30, 0, 250)
    assert one(spark, S.micros_between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))) == 7200000250
    assert one(spark, S.iso_text(F.lit(b).cast("timestamp_ntz"))) == "2026-03-29T03:30:00.000250"
    back = F.lit(b).cast("timestamp_ntz") - S.seconds_interval(F.lit(86400))
    assert one(spark, back) == b - dt.timedelta(days=1)


def test_texts(spark):
    assert one(spark, S.first_item(F.lit("Cali, Colombia"))) == "Cali"
    assert one(spark, S.first_item(F.lit(""))) == ""
    assert one(spark, S.json_object(a=F.lit(1), b=F.lit('x"y'))) == '{"a":1,"b":"x\\"y"}'
    made = one(spark, S.uuid_text(F.lit("tx"), F.lit(7)))
    assert re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", made)
    assert made == one(spark, S.uuid_text(F.lit("tx"), F.lit(7))) != one(spark, S.uuid_text(F.lit("tx"), F.lit(8)))
    assert one(spark, S.zero_if_null(F.lit(None).cast("long"))) == 0


def test_draws_cover_their_range(spark):
    d = draws.draw(F.col("id"), "s")
    row = spark.range(20000).select(
        F.min(d) >= 0, F.min(draws.unit(d)), F.max(draws.unit(d)), F.min(draws.between(d, 3, 9)),
        F.max(draws.between(d, 3, 9)), F.countDistinct(draws.pick(d, ["a", "b", "c"])), F.countDistinct(d)).first()
    assert row[0] and row[1] < 0.001 and 0.999 < row[2] < 1 and (row[3], row[4], row[5], row[6]) == (3, 9, 3, 20000)
