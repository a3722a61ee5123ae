"""Quality classifier by compression.

One zstandard dictionary is trained on texts labelled good and one on texts labelled bad. A text is cut into pieces of
`PIECE` bytes, all of which are compressed with either dictionary. The difference of the compressed sizes, divided by
the size of the text, says which kind of text it resembles; with the compressed share itself, which tells how
repetitive the text is whatever it repeats, it enters a logistic calibration fitted to labelled rows that did not
train the dictionaries.

Labels are used from training rows only, those whose crc32(doc_id as text) mod 5 is not 0. At most `DICT_ROWS` rows of
each label, of at most `DICT_CHARS` characters each, train the dictionaries, and at most `FIT_ROWS` others of any length
the calibration; they are chosen by a hash of the id. Every text is scored whole.

Defined results: a null text is scored as an empty one, and an empty text gets the prior share of good rows. A label
row with a null id or quality is ignored; of several labels for one id the lowest counts. Without labels of both
kinds the score is the share of good labels (0.5 without any). Rows with a null id are held out. Repeated rows score
alike. An empty table gives an empty result. Extra columns pass through; the operator's own columns replace columns of
the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sheltered

DICT_ROWS, DICT_CHARS, FIT_ROWS = 800, 20_000, 6_000
DICT_BYTES, PIECE, LEVEL = 64 * 1024, 2048, 3
THRESHOLD = 0.3


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[at:at + PIECE] for at in range(0, len(raw), PIECE)]


def train(texts: list[str]) -> bytes:
    """A dictionary for texts like these; too few of them are taken as they are."""
    pieces = [p for t in texts for p in _pieces(t)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICT_BYTES:]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def sizes(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[int, int, int]:
    """(bytes, compressed with the good dictionary, compressed with the bad one)."""
    pieces = _pieces(text or "")
    return (sum(map(len, pieces)), sum(len(good.compress(p)) for p in pieces), sum(len(bad.compress(p)) for p in pieces))


def _measure(good: bytes, bad: bytes):
    kept: list = []

    def run(texts: pd.Series) -> pd.DataFrame:
        # Compressors are made once per worker process.
        if not kept:
            kept.extend((compressor(good), compressor(bad)))
        return pd.DataFrame([sizes(t, *kept) for t in texts], columns=["raw", "good", "bad"], dtype="int64")

    kind = T.StructType([T.StructField(n, T.LongType()) for n in ("raw", "good", "bad")])
    return F.pandas_udf(run, kind).asNondeterministic()


@dataclass(frozen=True)
class Model:
    """The dictionaries and the calibration: score = sigmoid(weights . terms)."""

    good: bytes
    bad: bytes
    centre: tuple[float, float]
    scale: tuple[float, float]
    weights: tuple[float, ...]
    prior: float


def terms(x: np.ndarray) -> np.ndarray:
    """Second-order terms of the standardised measures."""
    a, b = x[:, 0], x[:, 1]
    return np.stack([np.ones(len(x)), a, b, a * a, b * b, a * b], axis=1)


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton steps with step halving."""
    z = terms(x)
    loss = lambda w: float(np.logaddexp(0, -(2 * y - 1) * (z @ w)).sum() + ridge * (w @ w) / 2)
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        slope = z.T @ (y - p) - ridge * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), slope)
        rate = 1.0
        while rate > 1e-6 and loss(w + rate * step) > loss(w):
            rate /= 2
        w = w + rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on bounded samples of the labelled training rows."""
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold_of(F.col("doc_id")) != 0))
              .groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("_y")))
    counts = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    prior = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    empty = Model(b"", b"", (0.0, 0.0), (1.0, 1.0), (0.0,) * 6, prior)
    if len(counts) < 2:
        return empty
    # Odd hashes train the dictionaries, even ones the calibration.
    turn = F.xxhash64("doc_id")
    ordered = lambda df, n: df.orderBy(turn, "doc_id").limit(n)
    odd = marked.filter(turn.bitwiseAND(F.lit(1)) == 1)
    teach = ordered(odd.filter("_y = 1"), DICT_ROWS).unionByName(ordered(odd.filter("_y = 0"), DICT_ROWS))
    texts = docs.filter(F.length("text") <= DICT_CHARS).select("doc_id", "text").join(F.broadcast(teach), "doc_id")
    # One text per id, so that repeated documents stay within the bound.
    rows = texts.groupBy("doc_id", "_y").agg(F.min("text").alias("text")).toPandas().sort_values("doc_id")
    sides = [train(list(rows.loc[rows["_y"] == y, "text"])) for y in (1, 0)]
    if not all(sides):
        return empty
    check = ordered(marked.filter(turn.bitwiseAND(F.lit(1)) == 0), FIT_ROWS)
    measured = docs.select("doc_id", "text").join(F.broadcast(check), "doc_id").select(
        "doc_id", "_y", _measure(*sides)("text").alias("m")).groupBy("doc_id", "_y").agg(F.min("m").alias("m"))
    got = measured.select("doc_id", "_y", "m.raw", "m.good", "m.bad").filter("raw > 0").toPandas().sort_values("doc_id")
    if got["_y"].nunique() < 2:
        return empty
    raw = got["raw"].to_numpy(float)
    x = np.stack([(got["bad"].to_numpy(float) - got["good"]) / raw, np.log(got["good"].to_numpy(float) / raw)], axis=1)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = calibrate((x - centre) / scale, got["_y"].to_numpy(float))
    return Model(*sides, tuple(map(float, centre)), tuple(map(float, scale)), tuple(map(float, weights)), prior)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Every document with held_out, score (likelihood of label 1) and predicted."""
    narrow, back = sheltered(docs, ["doc_id", "text"], ["held_out", "score", "predicted"])
    df = narrow.withColumn("_m", _measure(model.good, model.bad)("text"))
    raw = F.col("_m.raw").cast("double")
    a = ((F.col("_m.bad") - F.col("_m.good")) / raw - model.centre[0]) / model.scale[0]
    b = (F.log(F.col("_m.good") / raw) - model.centre[1]) / model.scale[1]
    w = model.weights
    if any(w):
        total = w[0] + w[1] * a + w[2] * b + w[3] * a * a + w[4] * b * b + w[5] * a * b
        likely = F.when(raw > 0, 1.0 / (1.0 + F.exp(F.least(F.greatest(-total, F.lit(-35.0)), F.lit(35.0)))))
    else:
        likely = F.lit(None).cast("double")
    out = df.withColumn("score", F.coalesce(likely, F.lit(model.prior)))
    return back(out, F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"), "score",
                (F.col("score") >= threshold).cast("int").alias("predicted"))
