"""Quality rules: an ordered decision list learned by sequential covering.

Text statistics are computed once per document. From labelled statistics, rules are grown one condition at
a time (information gain on a growing part), pruned back on a pruning part, and added while they are better
than chance there. The list becomes one ordered `CASE WHEN` expression over columns.

Defined results: a null text counts as empty (all statistics 0) and, as any text under `min_words`, fails the
base rule. A label row with a null id or quality is ignored; of several labels for one id the lowest counts.
Without usable labels the list is empty and only the base rule rejects. Repeated rows are judged alike. Extra
columns pass through; the operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, sheltered

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs")
STATS = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])
# Base rule: too few words, or too many words in repeated three-word windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# The learner reads at most so many labelled documents, chosen by a hash of the id.
SAMPLE_ROWS = 20_000

_words, _word = re.compile(WORD).findall, re.compile(WORD).search
_SYMBOL, _UPPER = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER[ord("A"):ord("Z") + 1] = True


def repeat_words(words: list[str]) -> int:
    """Words in three-word windows that stand twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    hit = bytearray(len(words))
    for at, window in enumerate(windows):
        if seen[window] > 1:
            hit[at:at + 3] = b"\x01\x01\x01"
    return sum(hit)


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in COUNTS, over the whole text."""
    text = text or ""
    words = _words(text)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    lines = [line for line in text.split("\n") if _word(line)]
    return (len(words), sum(map(len, words)), int(np.count_nonzero(_SYMBOL[raw])), len(lines) - len(set(lines)),
            repeat_words(words), len(lines), int(np.count_nonzero(_UPPER[raw])), text.count("!"))


@F.pandas_udf(STATS)
def _stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t) for t in texts], columns=list(COUNTS), dtype="int64")


# Nondeterministic, so that the optimizer does not run it once per use of its fields.
text_stats = _stats.asNondeterministic()


def features(stats: str) -> dict[str, Column]:
    """Ratios that the rules may test; none depends on the length of a text as such."""
    part = lambda name: F.col(f"{stats}.{name}").cast("double")
    over = lambda a, b: F.when(part(b) > 0, part(a) / part(b)).otherwise(F.lit(0.0))
    return {
        "symbols_per_word": over("n_symbols", "n_words"), "repeat_share": over("n_repeat_words", "n_words"),
        "dup_line_share": over("n_dup_lines", "n_lines"), "upper_per_char": over("n_upper", "word_chars"),
        "bangs_per_word": over("n_bangs", "n_words"), "word_length": over("word_chars", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.cut if self.above else x[self.feature] <= self.cut

    def column(self, columns: dict[str, Column]) -> Column:
        return columns[self.feature] > self.cut if self.above else columns[self.feature] <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], size: int) -> np.ndarray:
    hit = np.ones(size, bool)
    for condition in rule:
        hit &= condition.holds(x)
    return hit


def _best(x: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with the highest FOIL gain among the covered rows; cuts lie midway between values."""
    total_bad, total = int(bad[inside].sum()), int(inside.sum())
    base = np.log2(total_bad / total) if total_bad else 0.0
    best, found = 1e-9, None
    for name in sorted(x):
        values = x[name][inside]
        order = np.argsort(values, kind="stable")
        v, b = values[order], bad[inside][order]
        edges = np.flatnonzero(v[1:] > v[:-1])
        if not len(edges):
            continue
        low_bad, low = np.cumsum(b)[edges], edges + 1
        cuts = (v[edges] + v[edges + 1]) / 2
        for above in (True, False):
            p = (total_bad - low_bad) if above else low_bad
            n = (total - low) if above else low
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), 0.0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, found = float(gain[at]), Condition(name, above, float(cuts[at]))
    return best, found


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
               min_precision: float = 0.8, seed: int = 7) -> list[Rule]:
    """Sequential covering: rules for the bad class; what none covers is good."""
    size = len(bad)
    growing = np.random.default_rng(seed).random(size) < 2 / 3
    left, rules = np.ones(size, bool), []
    while len(rules) < max_rules and bad[left & growing].any():
        rule: Rule = ()
        inside = left & growing
        while len(rule) < max_conditions and not bad[inside].all():
            _, condition = _best(x, bad, inside)
            if condition is None:
                break
            rule += (condition,)
            inside = inside & condition.holds(x)
        test = left & ~growing if (left & ~growing).any() else left

        def worth(candidate: Rule) -> float:
            hit = _covers(candidate, x, size) & test
            p, n = int((bad & hit).sum()), int((~bad & hit).sum())
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())
        hit = _covers(rule, x, size) & left
        p, n = int((bad & hit).sum()), int((~bad & hit).sum())
        if not rule or worth(rule) < 2 * min_precision - 1 or p < min_precision * (p + n):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from at most `sample_rows` labelled documents; only their statistics reach the driver."""
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("_quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    # The limit bounds what is broadcast.
    found = (docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
             .select("doc_id", "_quality", text_stats("text").alias("_s")))
    # One row per id, so repeated documents cannot exceed the bound.
    one = found.groupBy("doc_id").agg(F.min(F.struct("_s", "_quality")).alias("_r")).select(
        F.col("_r._s").alias("_s"), F.col("_r._quality").alias("_quality"))
    columns = features("_s")
    rows = one.select(*[c.alias(n) for n, c in columns.items()], (F.col("_quality") <= 0).alias("_bad")).toPandas()
    if not len(rows):
        return []
    # A fixed order: the growing and pruning parts must not depend on how tasks were dealt.
    rows = rows.sort_values([*columns, "_bad"], kind="stable")
    return learn_list({n: rows[n].to_numpy(float) for n in columns}, rows["_bad"].to_numpy(bool))


def verdict(rules: list[Rule], stats: str) -> tuple[Column, Column]:
    """The ordered conditional expressions: (kept by the list, text of the rule that rejected)."""
    columns = features(stats)
    if not rules:
        return F.lit(True), F.lit(None).cast("string")
    name = None
    for rule in rules:
        test = rule[0].column(columns)
        for condition in rule[1:]:
            test = test & condition.column(columns)
        text = F.lit(" and ".join(map(str, rule)))
        name = F.when(test, text) if name is None else name.when(test, text)
    return name.isNull(), name


def judge(docs: DataFrame, rules: list[Rule], min_words: int = MIN_WORDS,
          max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Every document with its statistics `stats`, `base_failed`, `kept` and the rejecting `rule`."""
    own = {"stats", "base_failed", "kept", "rule"}
    df = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own], text_stats("text").alias("stats"))
    failed = (F.col("stats.n_words") < min_words) | (
        100 * F.col("stats.n_repeat_words") > max_repeat_percent * F.col("stats.n_words"))
    good, rule = verdict(rules, "stats")
    return df.withColumn("base_failed", failed).withColumn("rule", rule).withColumn("kept", ~F.col("base_failed") & good)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    narrow, back = sheltered(docs, ["doc_id", "text"], [])
    return back(judge(narrow, learn_rules(narrow, labels)).filter("kept"))
