"""Personal data: base patterns and a character-level bidirectional LSTM with CRF transitions.

The base patterns (email, ip, card, phone) always count. The tagger is trained in numpy on labelled spans: windows of a
bounded sample of the documents with their base spans, and windows of the same prose into which spans written in
other ways are planted, or numbers and words that are no personal data. It reads overlapping windows; where windows overlap
their character scores are averaged by the distance from the window's edge, and one Viterbi pass decodes the whole
stretch, so that a span on an edge is found once. A tagged span must hold an anchor, and it must be likely:
the best path has to win by `margin` (in log-likelihood) over the same path with the span outside. Spans that touch a
base span are left out.

An anchor is a digit, an `@`, or an `@` written out: `(at)` in brackets, or `at` with a `dot` after the next word. The tagger
reads all characters within a window of an anchor, and no others, because reading whole texts would take seven times the
CPU budget; the README has the figures. A span without any anchor, such as a name alone, is of no kind that is looked for.
Base patterns read the whole text, in time linear in its length, whatever its runs of digits or letters.

Defined results: a null text counts as empty: no spans, and the hash of the empty string. Repeated rows are tagged
alike. An empty table gives an empty result (the tagger then trains on planted spans alone). Extra columns pass
through; the operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sheltered

KINDS = ("email", "ip", "card", "phone")
# The base patterns of each kind.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Documents that give training windows, window and its step, hidden units of each direction.
SAMPLE_DOCS, WINDOW, STEP, HIDDEN = 600, 64, 32, 16
MARGIN = 2.0

# The same, written so that a long run is read once: an ip begins where a run of digits does, an email has one `@`.
_IP, _CARD, _PHONE = (re.compile(p) for p in ("(?<![0-9])" + IP, CARD, PHONE))
_LOCAL = frozenset(re.findall(EMAIL.split("+@")[0], "".join(map(chr, range(128)))))
_DOMAIN, _DIGIT = re.compile(EMAIL.split("@")[1]), re.compile("[0-9]")
# Where a span may be: a digit, an `@`, or one written out (`(at)`, `[at]`, `at ... dot`).
_ANCHOR = re.compile(r"[0-9@]|[\[({<]\s?at\s?[\])}>]|\bat\b(?=\s[^\s]{1,63}\sdot\b)", re.I)
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + at % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of EMAIL, in time linear in the text: each `@` is met once, and its local part read backwards.

    A match begins at the first character of the run of local characters that ends at its `@`.
    """
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        rest = _DOMAIN.match(text, at + 1)
        if rest:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((start, rest.end()))
                free = rest.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind as listed, then start."""
    spans: list[Span] = [("email", *span) for span in _emails(text)]
    if _DIGIT.search(text) is None:
        return spans
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
_OTHER = 96


def codes(text: str) -> np.ndarray:
    """ASCII characters by themselves, all letters beyond in one class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where((points >= 32) & (points < 127), points - 32, np.where(points < 32, 95, _OTHER))


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Log masks: an inside tag follows only its begin or itself, and none starts a window."""
    step, start = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        step[:, inside] = -1e4
        step[[inside - 1, inside], inside] = 0.0
    return step, start


STEP_MASK, START_MASK = _allowed()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Tagger:
    """A bidirectional LSTM over characters, a linear layer, and a linear-chain CRF."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 11, kind: type = np.float32):
        draw = np.random.default_rng(seed)
        self.hidden, self.kind = hidden, kind
        self.p: dict[str, np.ndarray] = {"w": draw.normal(0, 0.2, (2 * hidden, TAGS)), "b": np.zeros(TAGS),
                                         "t": draw.normal(0, 0.1, (TAGS, TAGS))}
        for side in "fr":
            self.p[f"x{side}"] = draw.normal(0, 0.2, (_OTHER + 1, 4 * hidden))
            self.p[f"h{side}"] = draw.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            # The forget gate starts open.
            self.p[f"x{side}"][:, hidden:2 * hidden] += 1.0
        self.p = {k: v.astype(kind) for k, v in self.p.items()}

    def _lstm(self, side: str, x: np.ndarray) -> tuple[np.ndarray, list]:
        """Outputs (steps, batch, hidden) and what the backward pass needs; x is (steps, batch)."""
        h, n = self.hidden, x.shape[1]
        out, c, kept = np.zeros((len(x), n, h), self.kind), np.zeros((n, h), self.kind), []
        last = np.zeros((n, h), self.kind)
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            z = self.p[f"x{side}"][x[t]] + last @ self.p[f"h{side}"]
            gates = _sigmoid(z[:, :3 * h])
            i, f, o, g = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:], np.tanh(z[:, 3 * h:])
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            kept.append((t, last, before, i, f, o, g, squashed))
            last = out[t] = o * squashed
        return out, kept

    def _lstm_back(self, side: str, x: np.ndarray, kept: list, d_out: np.ndarray, grads: dict) -> None:
        h, n = self.hidden, x.shape[1]
        dh, dc = np.zeros((n, h), self.kind), np.zeros((n, h), self.kind)
        for t, last, before, i, f, o, g, squashed in reversed(kept):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - squashed ** 2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o),
                                 dc * i * (1 - g ** 2)], axis=1)
            grads[f"x{side}"] += (np.arange(_OTHER + 1)[:, None] == x[t]).astype(self.kind) @ dz
            grads[f"h{side}"] += last.T @ dz
            dh, dc = dz @ self.p[f"h{side}"].T, dc * f

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (batch, steps, tags) of windows (batch, steps)."""
        steps = x.T
        both = np.concatenate([self._lstm("f", steps)[0], self._lstm("r", steps)[0]], axis=2)
        return (both @ self.p["w"] + self.p["b"]).transpose(1, 0, 2)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tag paths, and its gradients."""
        steps, gold = x.T, y.T
        n, count = steps.shape[1], len(steps)
        (out_f, kept_f), (out_r, kept_r) = self._lstm("f", steps), self._lstm("r", steps)
        both = np.concatenate([out_f, out_r], axis=2)
        e = both @ self.p["w"] + self.p["b"]
        move = self.p["t"] + STEP_MASK.astype(self.kind)
        a = np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, count):
            a[t] = e[t] + _lse(a[t - 1][:, :, None] + move, 1)
        z = _lse(a[-1], 1)
        b = np.zeros_like(e)
        for t in range(count - 2, -1, -1):
            b[t] = _lse((b[t + 1] + e[t + 1])[:, None, :] + move, 2)
        de = np.exp(a + b - z[None, :, None])
        d_move = np.zeros_like(move)
        for t in range(1, count):
            d_move += np.exp(a[t - 1][:, :, None] + move + (e[t] + b[t])[:, None, :] - z[:, None, None]).sum(axis=0)
        rows = np.arange(n)
        gold_score = np.zeros(n)
        for t in range(count):
            gold_score += e[t, rows, gold[t]]
            de[t, rows, gold[t]] -= 1.0
            if t:
                gold_score += move[gold[t - 1], gold[t]]
                np.add.at(d_move, (gold[t - 1], gold[t]), -1.0)
        de /= n
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["t"] = d_move / n
        grads["b"] = de.sum(axis=(0, 1))
        grads["w"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, TAGS)
        d_both = de @ self.p["w"].T
        self._lstm_back("f", steps, kept_f, d_both[:, :, :self.hidden], grads)
        self._lstm_back("r", steps, kept_r, d_both[:, :, self.hidden:], grads)
        return float((z - gold_score).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int = 24, batch: int = 128, rate: float = 0.03, seed: int = 5) -> float:
        """Adam with a falling rate; returns the last mean loss."""
        draw, moments = np.random.default_rng(seed), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step, mean = 0, 0.0
        total = rounds * -(-len(x) // batch)
        for _ in range(rounds):
            order, losses = draw.permutation(len(x)), []
            for at in range(0, len(x), batch):
                took = order[at:at + batch]
                loss, grads = self.loss(x[took], y[took])
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
                for k, g in grads.items():
                    m, v = moments[k]
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m[:] = 0.9 * m + 0.1 * g
                    v[:] = 0.99 * v + 0.01 * g * g
                    lower = rate * (1 - step / (total + 1))
                    self.p[k] -= (lower * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(self.kind)
            mean = float(np.mean(losses))
        return mean

    def decode(self, e: np.ndarray) -> np.ndarray:
        """The best tag path of one stretch of scores (steps, tags)."""
        move = self.p["t"] + STEP_MASK
        best, back = e[0] + np.where(np.arange(TAGS) % 2 + (np.arange(TAGS) == 0) > 0, 0.0, -1e4), []
        for t in range(1, len(e)):
            paths = best[:, None] + move
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + e[t]
        tags = [int(best.argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return np.array(tags[::-1])


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text that hold all characters within a window of an anchor."""
    found: list[tuple[int, int]] = []
    for m in _ANCHOR.finditer(text):
        low, high = max(0, m.start() - WINDOW), min(len(text), m.end() + WINDOW)
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], high)
        else:
            found.append((low, high))
    return found


def windowed_scores(tagger: Tagger, text: str, batch: int = 512) -> np.ndarray:
    """Scores of each character: those of all windows over it, weighted by the distance from the window's edge."""
    x = codes(text)
    size = max(len(x), WINDOW)
    starts = list(range(0, size - WINDOW + 1, STEP))
    if starts[-1] + WINDOW < size:
        starts.append(size - WINDOW)
    padded = np.zeros(size, np.int64)
    padded[:len(x)] = x
    weight = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0
    total, parts = np.zeros((size, TAGS)), np.zeros(size)
    for at in range(0, len(starts), batch):
        some = starts[at:at + batch]
        for start, e in zip(some, tagger.scores(np.stack([padded[s:s + WINDOW] for s in some]))):
            total[start:start + WINDOW] += e * weight[:, None]
            parts[start:start + WINDOW] += weight
    return (total / parts[:, None])[:len(x)]


def tagged_spans(tagger: Tagger, text: str, margin: float = MARGIN) -> list[Span]:
    """Likely spans of the tagger."""
    spans: list[Span] = []
    for low, high in stretches(text):
        e = windowed_scores(tagger, text[low:high])
        tags = tagger.decode(e)
        at = 0
        while at < len(tags):
            if tags[at] % 2 == 0:
                at += 1
                continue
            kind, end = int(tags[at]) // 2, at + 1
            while end < len(tags) and tags[end] == tags[at] + 1:
                end += 1
            if _gain(tagger, e, tags, at, end) >= margin and _ANCHOR.search(text, low + at, low + end) and plausible(KINDS[kind], text[low + at:low + end]):
                spans.append((KINDS[kind], low + at, low + end))
            at = end
    return spans


def _gain(tagger: Tagger, e: np.ndarray, tags: np.ndarray, start: int, end: int) -> float:
    """What the path gains by the span against leaving its characters outside."""
    rows, move = np.arange(start, end), tagger.p["t"]
    gain = float((e[rows, tags[rows]] - e[rows, 0]).sum())
    for t in range(max(start, 1), min(end + 1, len(tags))):
        before = 0 if t - 1 >= start else tags[t - 1]
        after = 0 if t < end else tags[t]
        gain += float(move[tags[t - 1], tags[t]] - move[before, after])
    return gain


def plausible(kind: str, text: str) -> bool:
    """What a span of its kind must have: an email two parts, numbers a fitting count of digits."""
    digits = len(_digits(text))
    ip = 4 <= digits <= 12 if "." in text else text.count(":") >= 2 and len(text) >= 6
    return {"email": len(text) >= 6, "ip": ip, "card": 13 <= digits <= 19, "phone": 7 <= digits <= 15}[kind]


def all_spans(tagger: Tagger, text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, base spans and the tagger's that touch none of them), by kind as listed, then start."""
    base = base_spans(text)
    if _ANCHOR.search(text) is None:
        return base, base
    taken = sorted((s, e) for _, s, e in base)
    added = [x for x in tagged_spans(tagger, text) if not any(s <= x[2] and x[1] <= e for s, e in taken)]
    return base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def _number(draw: np.random.Generator, shape: str, words: list[str]) -> str:
    """A text in which each 9 is a random digit and each L or X a random letter or hexadecimal digit.

    Three of four runs of L become a word of the prose instead, as names in addresses are words.
    """
    letters = {"9": "0123456789", "L": "abcdefghijklmnopqrstuvwxyz", "X": "0123456789abcdef"}
    shape = re.sub("L{3,}", lambda m: words[draw.integers(len(words))] if draw.integers(4) else m.group(), shape)
    return "".join(letters[c][draw.integers(len(letters[c]))] if c in letters else c for c in shape)


# Shapes of planted spans beside what the base patterns find, and of numbers and words that are none.
SHAPES = {"email": ["LLLL.99@LLLL9.example.com", "LLLLLL@LLL.LL", "LLLL (at) LLLLL.LLL", "LLL.99 @ LLLL.com", "LLLLL [at] LLLL.LL",
                    "LLL at LLLL dot LLL", "LLLL.LLLLL at LLLLLL dot com", "LLLLLL(at)LLLLLLL.org", "LLLL [at] LLLLL [dot] LLL"],
          "ip": ["999.999.99.9", "99.9.999.99", "XXXX:XXX:XXXX::XX", "XXXX:XXXX:XXXX:XXXX:XXXX:XXXX:XXXX:XXXX", "XXXX::XXXX:XXXX:XXX:XXXX"],
          "card": ["9999 9999 9999 9999", "9999-9999-9999-9999", "9999999999999999", "9999.9999.9999.9999", "9999 999999 99999"],
          "phone": ["(999) 999-9999", "999-999-9999", "+9 (999) 999-9999", "0099 999 9999999", "+99 999 9999999", "999.999.9999",
                    "099 9999 9999", "09999 999999", "999 999 9999"]}
OTHERS = ["9.9", "99", "9999", "9999-99-99", "99:99", "99,999", "$9.99", "v9.9.9", "99%", "X" * 40, "version 9.", "9999999",
          "XXXXXXXX-XXXX-XXXX", "#9999", "9/9", "9x9", "LL9", "9 9 9", "4.0.", "99:99:99", "(at) LLLL", "at LLLL dot", "9999 LLLL 9999",
          "999 999", "99.99.9999", "LLL (at 99:99)", "9.99.999"]


def _tags(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        first = 1 + 2 * KINDS.index(kind)
        tags[start:end], tags[start] = first + 1, first
    return tags


def training_windows(texts: list[str], count: int = 3000, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows of prose with base spans, planted spans, other numbers, or nothing, and their tags."""
    draw = np.random.default_rng(seed)
    prose = [t for t in texts if len(t) >= WINDOW] or ["the quick brown fox jumps over the lazy dog and on it goes again. " * 4]
    marked = [(t, s) for t in prose for s in [base_spans(t)] if s]
    # In lower case, so that no letter stands for others.
    words = sorted({w.lower() for t in prose[:200] for w in re.findall(r"\b[A-Za-z]{2,10}\b", t)}) or ["word"]
    xs, ys = [], []
    for n in range(count):
        if n % 4 == 0 and marked:
            text, spans = marked[draw.integers(len(marked))]
            _, start, end = spans[draw.integers(len(spans))]
            low = max(0, min(len(text) - WINDOW, int(start) - int(draw.integers(0, max(1, WINDOW - (end - start))))))
        else:
            text = prose[draw.integers(len(prose))]
            low = int(draw.integers(0, len(text) - WINDOW + 1))
            text, low = text[low:low + 2 * WINDOW], 0
            if n % 4:
                kind = KINDS[draw.integers(4)] if n % 4 < 3 else None
                shapes = SHAPES[kind] if kind else OTHERS
                put = _number(draw, shapes[draw.integers(len(shapes))], words)
                at = int(draw.integers(0, WINDOW // 2))
                # Put at a word's start, with a blank on either side.
                at = text.rfind(" ", 0, at) + 1
                tail = ["", "", "", ".", ",", "!", "#", "###"][draw.integers(8)] + " "
                text = text[:at] + put + tail + text[at:]
                spans = [(kind, at, at + len(put))] if kind else []
            else:
                spans = base_spans(text)
            spans = [*spans, *[s for s in base_spans(text) if not any(s[1] < e and b < s[2] for _, b, e in spans)]]
        tags = _tags(len(text), [s for s in spans if s[2] <= len(text)])[low:low + WINDOW]
        # A span cut at the window's start begins inside.
        if len(tags) and tags[0] and tags[0] % 2 == 0:
            tags[0] -= 1
        x = codes(text[low:low + WINDOW])
        xs.append(np.pad(x, (0, WINDOW - len(x))))
        ys.append(np.pad(tags, (0, WINDOW - len(tags))))
    return np.stack(xs), np.stack(ys)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, window_chars: int = 4000) -> Tagger:
    """Train on at most `sample_docs` documents, half of them with a digit or an `@`, chosen by a hash.

    Only documents of at most `window_chars` characters are taken, which bounds what the driver reads.
    """
    short = docs.filter(F.length("text") <= window_chars).select("text", F.xxhash64("doc_id", "text").alias("turn"))

    def pick(df: DataFrame) -> list[str]:
        # The hashes are drawn first, so that the driver never gets more texts than it uses.
        least = [r["turn"] for r in df.select("turn").distinct().orderBy("turn").limit(sample_docs // 2).collect()]
        if not least:
            return []
        return [r["text"] for r in df.filter(F.col("turn") <= least[-1]).dropDuplicates(["turn"]).orderBy("turn").collect()]

    texts = pick(short.filter(F.col("text").rlike("[0-9@]"))) + pick(short.filter(~F.col("text").rlike("[0-9@]")))
    tagger = Tagger()
    tagger.train(*training_windows(texts))
    return tagger


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _row(tagger: Tagger, text: str | None) -> tuple:
    base, spans = all_spans(tagger, text or "")
    counts = [sum(kind == k for k, _, _ in base) for kind in KINDS]
    return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """Every row with n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    names = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans"]
    kind = T.StructType([T.StructField(n, T.LongType() if n.startswith("n_") else T.StringType()) for n in names])

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_row(tagger, t) for t in texts], columns=names)

    found = F.pandas_udf(run, kind).asNondeterministic()
    narrow, back = sheltered(docs, ["text"], names)
    return back(narrow.withColumn("_found", found("text")), "_found.*")
