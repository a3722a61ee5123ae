"""Benchmark decontamination by CGK embedding, bit-sampling LSH and the word edit distance.

An item of n words may differ from a part of a text by k = rate * n word edits. Edit distances this large do not survive
an embedding of whole items, so an item is cut into pieces with at most one edit each: of m pieces, one has no more
than k / m edits, and m is the least number for which that is one or none. A piece is some five to ten words at a rate of 0.2,
whatever the item's length.

Windows of a piece's size are laid over the text at every word. A CGK random walk (Chakraborty, Goldenberg, Koucky 2016) reads a
window from its first word: it emits the word under its pointer, and a random bit of that word and of the step moves the
pointer on or lets it stay. Strings that differ by an edit fall out of step and, by chance, into step again, which turns edits into a
few differing places of equally long walks. Each repetition has a walk and sampled places of its own; window and piece
collide if they agree in all sampled places. The number of repetitions follows from a piece's length, its edits and the
target recall (`repetitions`), measured on random pieces. Walks depend on words only, so an item's matches do not
depend on the other items.

A window is embedded only if it can match: it must hold as many word pairs of the items as a piece keeps after its
edits (each breaks two at most), which loses nothing. A piece so short that it may keep no pair is not embedded: such items, of
under five words or at high rates, are looked up by their words, of which n - k must stand close together.

Every collision is verified: the word edit distance between the item and a part of the text around must be at most
`rate` of the item's words. Of overlapping parts the nearest counts; what is left on either side of it is searched again, so an
item that stands twice is found twice.

The items are the stated query set. They are read to the driver in blocks of bounded size and each block is one pass
over the documents.

Defined results: null texts and items, and those without words, match nothing. A null id of a document or item is
carried as null. Items with under 1 / rate words must occur exactly. Repeated rows are matched alike. Empty tables
give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .common import without_ids

RATE = 0.2
# Share of the pieces with all their edits that collide at least once.
RECALL = 0.999
# Characters of items in one block.
BLOCK_CHARS = 4_000_000
# Words of the texts that are embedded at a time.
CHUNK_WORDS = 200_000
# Marks a word among the word pairs.
ALONE = np.uint64(1 << 63)

_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def best_part(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the part of `text` nearest to `item`, if within `most` edits.

    Sellers' dynamic programme over the item's words, one vector step per text word column: the row of starts is
    carried along. Of equal distances the earliest end counts.
    """
    m = len(item)
    cost, start = np.arange(m + 1), np.zeros(m + 1, np.int64)
    best = (cost[m], 0, 0)
    index = np.arange(m + 1)
    for at in range(len(text)):
        diagonal = cost[:-1] + (item != text[at])
        above = cost[1:] + 1
        step = np.concatenate([[0], np.minimum(diagonal, above)])
        from_start = np.concatenate([[at + 1], np.where(diagonal <= above, start[:-1], start[1:])])
        # Insertions of item words: running minimum of step[i] - i.
        shifted = step - index
        source = np.maximum.accumulate(np.where(shifted == np.minimum.accumulate(shifted), index, 0))
        cost, start = shifted[source] + index, from_start[source]
        if cost[m] < best[0]:
            best = (cost[m], int(start[m]), at + 1)
    return (int(best[0]), best[1], best[2]) if best[0] <= most else None


def bits_of(item: np.ndarray) -> dict[int, int]:
    """For each symbol of an item, the places where it stands, as bits of one number."""
    bits: dict[int, int] = {}
    for at, symbol in enumerate(item.tolist()):
        bits[symbol] = bits.get(symbol, 0) | 1 << at
    return bits


def nearest_end(bits: dict[int, int], size: int, text: Iterable[int], most: int = -1, ahead: int = 0) -> tuple[int, int]:
    """(distance, end) of the part of `text` nearest to an item of `size` symbols, the earliest end of equal ones.

    The search stops `ahead` symbols after the first end of a part within `most` edits.

    The programme of `best_part` in bits (Myers 1999, Hyyro 2003): differences of neighbouring costs of a column are
    +1 in `up`, -1 in `down`, else 0.
    """
    full, last = (1 << size) - 1, 1 << (size - 1)
    up, down, cost, best, stop = full, 0, size, (size, 0), None
    get = bits.get
    for end, symbol in enumerate(text, 1):
        equal = get(symbol, 0)
        flat = (((equal & up) + up) ^ up) | equal | down
        right_up, right_down = down | (full & ~(flat | up)), up & flat
        if right_up & last:
            cost += 1
        elif right_down & last:
            cost -= 1
            if cost < best[0]:
                best = (cost, end)
                if stop is None and cost <= most:
                    stop = end + ahead
        if end == stop:
            break
        right_up = (right_up << 1) & full
        up, down = ((right_down << 1) | ~(flat | right_up)) & full, right_up & flat
    return best


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + count[i] - 1 of all i in turn."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)


def cut_up(size: int, most: int) -> tuple[int, int, list[int]]:
    """(words, edits, first words) of the pieces of an item: so many that one of them has at most one edit."""
    count = most // 2 + 1
    length = size // count
    return length, most // count, [n * length for n in range(count)]


def _bit(words: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A random bit of each word, other for each seed."""
    x = (words ^ seed) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)


class Walk:
    """One repetition: the random bits of a CGK walk, and the places of it that are sampled."""

    def __init__(self, length: int, edits: int, number: int):
        draw = np.random.default_rng((length, edits, number))
        # The pointer moves on every other step, so these places read about three quarters of a window.
        steps = max(2, 3 * length // 2)
        self.seeds = draw.integers(0, 2**63, steps, np.uint64)
        self.sampled = frozenset(draw.choice(steps, 2 if length < 7 else 3, replace=False).tolist())
        self.last = max(self.sampled)

    def keys(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The sampled places of the windows that begin at `starts`, as one number; `words` goes on beyond them."""
        pointer, key = starts.copy(), np.zeros(len(starts), np.uint64)
        for step, seed in enumerate(self.seeds[:self.last + 1]):
            read = words[pointer]
            if step in self.sampled:
                key = (key ^ read) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            pointer += _bit(read, seed).astype(np.int64)
        return key


@lru_cache
def walks(length: int, edits: int, recall: float, patterns: int = 400, most: int = 256) -> tuple[Walk, ...]:
    """The repetitions for pieces of a length and number of edits.

    Random edits of random pieces are embedded by many walks. A pattern of edits that a walk keeps with a chance q
    is lost by r walks with (1 - q)^r; r is the least number for which the mean over all patterns is within 1 - recall.
    """
    made = [Walk(length, edits, n) for n in range(most)]
    if not edits:
        return tuple(made[:1])
    draw, room = np.random.default_rng((length, edits)), 4 * length
    pieces, texts = np.zeros((2, patterns, room), np.uint64)
    for n in range(patterns):
        words = draw.integers(1, 2**63, room + edits, np.uint64).tolist()
        pieces[n] = words[:room]
        for _ in range(edits):
            at, new = int(draw.integers(length)), int(draw.integers(1, 2**63))
            words[at:at + 1] = [[new], [], [new, words[at]]][draw.integers(3)]
        texts[n] = (words + [0] * room)[:room]
    hit, rows = np.zeros((most, patterns), bool), np.arange(patterns) * room
    for n, walk in enumerate(made):
        mine = walk.keys(pieces.ravel(), rows)
        for shift in range(edits + 1):
            # An edit at the front lets the window begin later.
            hit[n] |= walk.keys(texts.ravel(), rows + shift) == mine
    lost = 1 - hit.mean(axis=0)
    count = next((r for r in range(1, most) if (lost**r).mean() <= 1 - recall), most)
    return tuple(made[:count])


class Group(NamedTuple):
    """Pieces (item, first word) of one length, number of edits, and number of different pairs that they keep at least."""

    length: int
    edits: int
    need: int
    pieces: np.ndarray
    pairs: np.ndarray
    tables: list[tuple[Walk, np.ndarray, np.ndarray]]

    @property
    def size(self) -> int:
        """Places of a window at which a pair may stand."""
        return self.length - 1 + self.edits


class Index:
    """Pieces and word pairs of one block of items."""

    def __init__(self, items: list[tuple[int | None, list[str]]], rate: float, recall: float = RECALL):
        self.rate = rate
        self.items = [(i, words) for i, words in items if words]
        self.vocabulary: dict[str, int] = {}
        for _, words in self.items:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.symbols = [self.symbols_of(words) for _, words in self.items]
        self.bits = [bits_of(s) for s in self.symbols]
        cuts = [cut_up(len(s), self.most(n)) for n, s in enumerate(self.symbols)]
        # Different word pairs of each piece, of which it keeps all but two for each edit.
        kept = [[len(np.unique(self.pairs_of(self.symbols[n][first:first + length]))) - 2 * edits for first in firsts]
                for n, (length, edits, firsts) in enumerate(cuts)]
        # Items with a piece that may keep no pair go by their words.
        self.alone = np.array([min(k) < 1 for k in kept], bool)
        self.needs = np.array([max(1, len(s) - self.most(n)) if self.alone[n] else len(s) - 1 - 2 * self.most(n)
                               for n, s in enumerate(self.symbols)], np.int64)
        own = [np.unique(s | ALONE if self.alone[n] else self.pairs_of(s)) for n, s in enumerate(self.symbols)]
        owners = np.repeat(np.arange(len(own)), [len(p) for p in own])
        every = np.concatenate([*own, np.zeros(0, np.uint64)])
        order = np.argsort(every, kind="stable")
        # Word pairs in order, and for each the items that hold it.
        self.pairs, first = np.unique(every[order], return_index=True)
        self.owners, self.bounds = owners[order], np.append(first, len(every))
        self.own = [np.searchsorted(self.pairs, p) for p in own]
        # Words by a hash, so that walks do not depend on the block; a word of no item is 0.
        self.hashes = np.array([0, *map(xxhash.xxh64_intdigest, self.vocabulary)], np.uint64)
        grouped: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for n, (length, edits, firsts) in enumerate(cuts):
            if not self.alone[n]:
                for first, need in zip(firsts, kept[n]):
                    grouped.setdefault((length, edits, need), []).append((n, first))
        self.groups = [Group(length, edits, need, np.array(pieces), self._piece_pairs(pieces, length),
                             self._tables(pieces, walks(length, edits, recall)))
                       for (length, edits, need), pieces in sorted(grouped.items())]
        self.least = min((g.need for g in self.groups), default=0)
        self.widest = max((g.size for g in self.groups), default=0)
        # Words that a walk may read beyond its first one.
        self.room = 2 + max((len(t[0].seeds) for g in self.groups for t in g.tables), default=0)

    def _piece_pairs(self, pieces: list[tuple[int, int]], length: int) -> np.ndarray:
        """The numbers of each piece's word pairs, a repeated pair as -2."""
        out = np.full((len(pieces), length - 1), -2, np.int64)
        for row, (n, first) in zip(out, pieces):
            own = np.unique(np.searchsorted(self.pairs, self.pairs_of(self.symbols[n][first:first + length])))
            row[:len(own)] = own
        return out

    def _tables(self, pieces: list[tuple[int, int]], made: tuple[Walk, ...]) -> list[tuple[Walk, np.ndarray, np.ndarray]]:
        """For each walk the keys of a group's pieces in order, and the pieces' numbers."""
        room = max(len(w.seeds) for w in made) + 1
        rows = [np.concatenate([self.hashes[self.symbols[n][first:first + room].astype(np.int64)], np.zeros(room, np.uint64)])[:room]
                for n, first in pieces]
        flat, starts, tables = np.concatenate(rows), np.arange(len(pieces)) * room, []
        for walk in made:
            keys = walk.keys(flat, starts)
            order = np.argsort(keys, kind="stable")
            tables.append((walk, keys[order], order))
        return tables

    def symbols_of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))

    @staticmethod
    def pairs_of(symbols: np.ndarray) -> np.ndarray:
        return (symbols[:-1] << np.uint64(32)) | symbols[1:]

    def most(self, number: int) -> int:
        return int(self.rate * len(self.symbols[number]))

    def pairs_at(self, symbols: np.ndarray) -> np.ndarray:
        """For each place of the text the number of the items' word pair that stands there, else -1."""
        pairs = self.pairs_of(symbols)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, at, -1)

    def places(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, place) of all pairs, and of the words that go alone, in the text, in order."""
        place = np.flatnonzero(at >= 0)
        at = at[place]
        if self.alone.any():
            words = symbols | ALONE
            found = np.minimum(np.searchsorted(self.pairs, words), len(self.pairs) - 1)
            stands = np.flatnonzero(self.pairs[found] == words)
            at, place = np.concatenate([at, found[stands]]), np.concatenate([place, stands])
        order = np.argsort(at, kind="stable")
        return at[order], place[order]

    def counted(self, symbols: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, low, high) for the chosen items, by an exact count filter: no part within the bound is outside.

        Apart from items that go by their words it serves as the test of the embedding.
        """
        at, place = self.places(symbols, at)
        # Occurrences of pairs in the text, added up over the items that hold them.
        hit, times = np.unique(at, return_counts=True)
        each = self.bounds[hit + 1] - self.bounds[hit]
        owners = self.owners[spread(self.bounds[hit], each)]
        able = np.bincount(owners, np.repeat(times, each), len(self.items)) >= self.needs
        for number in np.flatnonzero(able & numbers):
            low = np.searchsorted(at, self.own[number], "left")
            mine = np.sort(place[spread(low, np.searchsorted(at, self.own[number], "right") - low)])
            need, longest = max(1, self.needs[number]), len(self.symbols[number]) + self.most(number)
            # The first and last of `need` neighbouring places must fit into one part.
            first, last = mine[:len(mine) - need + 1], mine[need - 1:] + (1 if self.alone[number] else 2)
            fits = last - first <= longest
            lows, highs = np.maximum(last[fits] - longest, 0), np.minimum(first[fits] + longest, len(symbols))
            yield from self._apart(int(number), lows, highs)

    @staticmethod
    def _apart(number: int, lows: np.ndarray, highs: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Stretches in order, those that overlap as one."""
        if len(lows):
            ends = np.maximum.accumulate(highs)
            apart = np.flatnonzero(lows[1:] >= ends[:-1])
            for begin, end in zip(lows[np.append(0, apart + 1)], ends[np.append(apart, len(ends) - 1)]):
                yield number, int(begin), int(end)

    def collisions(self, symbols: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(items, first words of their pieces, places) of windows that collide with a piece.

        The symbols may be of many texts with `room` zeros after each; there is one pass over all for each walk.
        """
        sums = np.concatenate([[0], np.cumsum(at >= 0)])

        def held(size: int, places: np.ndarray) -> np.ndarray:
            """Pairs of any item in the windows of a size."""
            return sums[np.minimum(places + size, len(at))] - sums[places]

        every = np.arange(len(at))
        every = every[held(self.widest, every) >= self.least]
        if not len(every):
            return
        words = np.concatenate([self.hashes[symbols.astype(np.int64)], np.zeros(self.room, np.uint64)])
        # Places beyond the text hold no pair.
        padded = np.concatenate([at, np.full(self.widest, -1)])
        for group in self.groups:
            starts = every[held(group.size, every) >= group.need]
            inside = np.sort(padded[starts[:, None] + np.arange(group.size)], axis=1)
            different = (inside[:, 0] >= 0) + ((inside[:, 1:] != inside[:, :-1]) & (inside[:, 1:] >= 0)).sum(axis=1)
            starts = starts[different >= group.need]
            if not len(starts):
                continue
            hits = []
            for walk, keys, order in group.tables:
                mine = walk.keys(words, starts)
                low, high = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                hit = np.flatnonzero(high > low)
                times = high[hit] - low[hit]
                hits.append(order[spread(low[hit], times)] * len(words) + np.repeat(starts[hit], times))
            piece, start = np.divmod(np.unique(np.concatenate(hits)), len(words))
            for some in range(0, len(piece), 4096):
                p, place = piece[some:some + 4096], start[some:some + 4096]
                window = padded[place[:, None] + np.arange(group.size)]
                # Pairs of the piece itself.
                same = (group.pairs[p][:, :, None] == window[:, None, :]).any(axis=2).sum(axis=1) >= group.need
                if same.any():
                    number, first = group.pieces[p[same]].T
                    yield number, first, place[same]

    def stretches(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, low, high): the stretches to verify, those of an item in a text apart from each other."""
        gap = np.zeros(self.room, np.uint64)
        flat = np.concatenate([x for text in texts for x in (text, gap)])
        begins = np.cumsum([0, *(len(text) + self.room for text in texts)])[:-1]
        at = self.pairs_at(flat)
        if self.alone.any():
            for n, (text, begin) in enumerate(zip(texts, begins.tolist())):
                for found in self.counted(text, at[begin:begin + len(text) - 1], self.alone):
                    yield n, *found
        every = list(self.collisions(flat, at)) if self.groups else []
        if not every:
            return
        number, first, place = map(np.concatenate, zip(*every))
        text = np.searchsorted(begins, place, "right") - 1
        begin = place - first - begins[text]
        order = np.lexsort((begin, number, text))
        number, begin, text = number[order], begin[order], text[order]
        change = np.flatnonzero((number[1:] != number[:-1]) | (text[1:] != text[:-1])) + 1
        for some in np.split(np.arange(len(number)), change):
            n, t = int(number[some[0]]), int(text[some[0]])
            # Edits before the piece move the item's begin, those after it its end.
            most, size = self.most(n), len(self.symbols[n])
            for found in self._apart(n, np.maximum(begin[some] - most, 0), np.minimum(begin[some] + size + most, len(texts[t]))):
                yield t, *found

    def parts(self, number: int, symbols: np.ndarray, text: list[int], low: int, high: int) -> list[tuple[int, int, int]]:
        """(first word, end word, distance) of the parts of a stretch within the bound, none over another."""
        item, most = self.symbols[number], self.most(number)
        out, left = [], [(low, high)]
        while left:
            low, high = left.pop()
            if high - low < len(item) - most:
                continue
            # The nearest of the parts about the first one within the bound.
            ahead = len(item) + 2 * most
            nearest, end = nearest_end(self.bits[number], len(item), map(text.__getitem__, range(low, high)), most, ahead)
            if nearest > most:
                continue
            # A part within `most` edits is at most so much longer than the item.
            end += low
            begin = max(low, end - len(item) - most)
            _, start, size = best_part(item, symbols[begin:end], most)
            out.append((begin + start, begin + size, nearest))
            # Nothing ends before the first end within the bound.
            left += [(end, high), (max(low, end - ahead - len(item) - most), begin + start)]
        return sorted(out)

    def matches_of(self, texts: Iterable[str | None]) -> list[list[tuple[int | None, int, int, int]]]:
        """For each text (item_id, first word, end word, distance) of the verified matches, each item's apart from each other."""
        out: list[list] = []
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def settle() -> None:
            numbers: dict[int, list[int]] = {}
            for n, item, low, high in self.stretches([symbols for _, symbols in held]) if held else ():
                symbols = held[n][1]
                listed = numbers[n] if n in numbers else numbers.setdefault(n, symbols.tolist())
                out[held[n][0]] += [(self.items[item][0], *part) for part in self.parts(item, symbols, listed, low, high)]
            held.clear()

        for text in texts:
            out.append([])
            symbols = self.symbols_of(words_of(text))
            if len(symbols) and self.items:
                held.append((len(out) - 1, symbols))
                size += len(symbols)
                if size >= CHUNK_WORDS:
                    settle()
                    size = 0
        settle()
        return out

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        return self.matches_of([text])[0]


def find_items(docs: DataFrame, items: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Matches (doc_id, item_id, first_word, end_word, distance) of items (item_id, text) in documents (doc_id, text)."""
    used = items.filter("text is not null").select("item_id", "text")
    total = used.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    out = None
    for block in range(blocks):
        rows = used.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        found = _block(docs, Index([(r["item_id"], words_of(r["text"])) for r in rows], rate))
        out = found if out is None else out.unionByName(found)
    return out


def _block(docs: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "first_word", "end_word", "distance"]
        for batch in batches:
            found = index.matches_of(batch.column(1).to_pylist())
            rows = [(doc_id, *match) for doc_id, some in zip(batch.column(0).to_pylist(), found) for match in some]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, item_id long, first_word long, end_word long, distance long")


def clean_documents(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents that hold no item; documents without an id are kept."""
    return without_ids(docs, durable(find_items(docs, items, rate).select("doc_id").filter("doc_id is not null").distinct()))
