"""Recall of the embedding against the exact count filter, by the length of the items and up to the bound."""

import numpy as np
import pytest

from convivio.llm import decontaminate
from test_operators import edited, zipf


def exact(index, words):
    """Items found without the embedding."""
    symbols = index.symbols_of(words)
    at, every = index.pairs_at(symbols), np.ones(len(index.items), bool)
    return {n for n, low, high in index.counted(symbols, at, every) if index.parts(n, symbols, symbols.tolist(), low, high)}


@pytest.mark.parametrize("size", [5, 14, 60, 150, 300, 600])
def test_recall_up_to_the_bound(size):
    draw = np.random.default_rng(size)
    items = [(n, zipf(draw, size)) for n in range(24)]
    index, want, got = decontaminate.Index(items, 0.2), 0, 0
    for n, item in items:
        for share in (0.2, 0.1):
            words = zipf(draw, 60) + edited(draw, item, int(share * size)) + zipf(draw, 60)
            all_, found = exact(index, words), {x[0] for x in index.matches(" ".join(words))}
            assert found <= all_ and n in all_
            want, got = want + len(all_), got + len(all_ & found)
    assert got >= 0.99 * want


def test_repetitions_follow_from_the_target():
    few, many = [len(decontaminate.walks(8, 1, recall)) for recall in (0.9, 0.9999)]
    assert 1 < few < len(decontaminate.walks(8, 1, 0.999)) < many < 256
    assert len(decontaminate.walks(8, 0, 0.999)) == 1
    for size in range(5, 700):
        length, edits, firsts = decontaminate.cut_up(size, int(0.2 * size))
        # So many pieces that one has at most `edits` of all edits, and they do not overlap.
        assert len(firsts) * (edits + 1) > int(0.2 * size) and firsts[-1] + length <= size and edits <= 1


def test_other_items_and_other_texts_change_nothing():
    draw = np.random.default_rng(3)
    items = [(n, zipf(draw, 14 + n)) for n in range(30)]
    texts = [" ".join(zipf(draw, 40) + edited(draw, items[n % 30][1], 2) + zipf(draw, 30)) for n in range(60)] + ["", None, "a"]
    whole = decontaminate.Index(items, 0.2)
    together = whole.matches_of(texts)
    assert together == [whole.matches(t) for t in texts] and sum(map(len, together)) >= 60
    for n in range(0, 30, 7):
        alone = decontaminate.Index([items[n]], 0.2).matches_of(texts)
        assert [[m for m in found if m[0] == n] for found in together] == alone


def test_repeated_items_and_repeated_words():
    item = "one two three four five six seven eight nine ten".split()
    index = decontaminate.Index([(1, item), (1, item), (2, ["la"] * 12), (None, item)], 0.2)
    found = index.matches(" ".join(["x"] + item + ["y"] + ["la"] * 13))
    assert sorted((m for m in found if m[0] != 2), key=repr) == [(1, 1, 11, 0), (1, 1, 11, 0), (None, 1, 11, 0)]
    assert any(m[0] == 2 for m in found)
