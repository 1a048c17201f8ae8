"""Periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q that is at least
max(LEAST, TIMES * q) words long and that no neighbouring word extends keeping period q.

The words of a batch of texts form one sequence, a symbol of its own before, between and
behind the texts.  Recompression shortens it level by level: maximal blocks of one symbol
become a symbol named by (symbol, length), then pairs of a left and a right symbol (by a
drawn bit for each symbol) become a symbol named by the pair.  The names are the rules of a
run-length grammar; equal stretches get equal names but for a few symbols at their ends.
How far two places agree (an LCE query) is answered on the grammar: climb while both places
begin a symbol, step over the rest of a block or pair where they don't, and descend at the
first difference.  Read from the right, the same levels answer extensions to the left.

A run with period q holds at least TIMES multiples of q, so TIMES - 1 neighbouring pairs of
places on the grid q, 2q, 3q, ... carry equal words.  Those pairs, over all q a harmonic
number of places, are the candidates; their exact extensions give the runs.  No suffix array
is built.  All steps are numpy operations on whole levels.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowmedallion.llm.batches import append_columns

LEAST = 6
"""Fewest words of a run."""
TIMES = 4
"""Fewest repetitions of the period in a run."""
RUN = "struct<start: long, length: long, period: long>"


@dataclass(frozen=True)
class Level:
    """Symbols of one level; ``child[k]`` is the first of them in symbol k of the next level, ``up`` the way back."""

    symbols: np.ndarray
    child: np.ndarray
    up: np.ndarray
    pairs: bool

    def mirrored(self) -> Level:
        """The same level read from the right."""
        above = len(self.child) - 2
        return Level(self.symbols[::-1], len(self.symbols) - self.child[::-1], above - self.up[::-1], self.pairs)


def level(symbols: np.ndarray, heads: np.ndarray, pairs: bool) -> Level:
    """A level whose next one has a symbol for every head."""
    child = np.append(np.flatnonzero(heads), len(symbols))
    return Level(symbols, child, np.cumsum(heads) - 1, pairs)


def named(symbols: np.ndarray, chosen: np.ndarray, key: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """Give the chosen symbols new names by their keys, from ``free`` on; the next free name."""
    known, inverse = np.unique(key, return_inverse=True)
    out = symbols.copy()
    out[chosen] = free + inverse
    return out, free + len(known)


def recompress(words: np.ndarray, seed: int = 0) -> list[Level]:
    """The levels over a sequence of symbols, up to one symbol."""
    draw = np.random.default_rng(seed)
    levels, now, free = [], words.astype(np.int64), int(words.max(initial=0)) + 1
    while len(now) > 1:
        heads = np.append(True, now[1:] != now[:-1])
        if not heads.all():
            made = level(now, heads, False)
            levels.append(made)
            sizes = np.diff(made.child)
            blocks = np.flatnonzero(sizes > 1)
            now = now[made.child[:-1]]
            now, free = named(now, blocks, now[blocks] * (int(sizes.max()) + 1) + sizes[blocks], free)
            continue
        right = draw.integers(0, 2, free, dtype=np.int8)[now] == 1
        joined, flipped = ~right[:-1] & right[1:], right[:-1] & ~right[1:]
        if flipped.sum() > joined.sum():
            joined = flipped
        if not joined.any():
            continue
        heads = np.append(True, ~joined)
        made = level(now, heads, True)
        levels.append(made)
        first = made.child[:-1]
        pairs = np.flatnonzero(np.diff(made.child) == 2)
        key = now[first[pairs]] * free + now[first[pairs] + 1]
        now, free = named(now[first], pairs, key, free)
    return levels


def agreement(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair of different places, how many symbols from there on are equal.

    The sequence must end with a symbol that is found nowhere else.
    """
    x, y = i.astype(np.int64), j.astype(np.int64)
    stopped = np.zeros(len(x), dtype=np.int64)
    active = np.arange(len(x))
    for h, now in enumerate(levels):
        if not len(active):
            break
        a, b = x[active], y[active]
        differ = now.symbols[a] != now.symbols[b]
        stopped[active[differ]] = h
        active, a, b = active[~differ], a[~differ], b[~differ]
        ua, ub = now.up[a], now.up[b]
        both = (now.child[ua] == a) & (now.child[ub] == b)
        left_a, left_b = now.child[ua + 1] - a, now.child[ub + 1] - b
        uneven = ~both & (left_a != left_b)  # rests of two blocks: behind the shorter one symbols differ
        step = np.minimum(left_a, left_b)[uneven]
        out = active[uneven]
        x[out], y[out], stopped[out] = a[uneven] + step, b[uneven] + step, h
        on = ~uneven
        active = active[on]
        beyond = ~both[on]
        x[active], y[active] = ua[on] + beyond, ub[on] + beyond
    for h in range(len(levels) - 1, 0, -1):
        low = levels[h - 1]
        at = np.flatnonzero(stopped >= h)
        a, b = low.child[x[at]], low.child[y[at]]
        same = low.symbols[a] == low.symbols[b]
        if low.pairs:
            step = same.astype(np.int64)
        else:
            step = same * np.minimum(low.child[x[at] + 1] - a, low.child[y[at] + 1] - b)
        x[at], y[at] = a + step, b + step
    return x - i


def candidates(words: np.ndarray, longest: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``period, place, stretch``: grid places that equal the next grid places, TIMES - 1 times in a row.

    ``longest`` holds the texts' numbers of words in falling order, ``ends`` where they end.
    """
    found: list[tuple[np.ndarray, ...]] = []
    stretches = 0
    for q in range(1, int(longest[0]) // TIMES + 1 if len(longest) else 0):
        enough = int(np.searchsorted(-longest, -max(LEAST, TIMES * q), side="right"))
        if not enough:
            break
        grid = words[: ends[enough - 1] + 1 : q]
        equal = grid[1:] == grid[:-1]
        held = len(equal) - TIMES + 2
        if held <= 0 or not equal.any():
            continue
        row = equal[:held].copy()
        for k in range(1, TIMES - 1):
            row &= equal[k : held + k]
        at = np.flatnonzero(row)
        if len(at):
            new = np.append(True, np.diff(at) > 1)
            found.append((np.full(len(at), q), at * q, stretches + np.cumsum(new)))
            stretches += int(new.sum())
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*found))


def runs_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, length, period`` of all runs of texts given as symbols >= 0, by text, start and period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= LEAST]
    nothing = (np.empty(0, dtype=np.int64),) * 4
    if not len(order):
        return nothing
    free = 1 + max(int(texts[k].max()) for k in order)
    parts = [np.array([free], dtype=np.int64)]
    for n, k in enumerate(order):
        parts += [texts[k], np.array([free + n + 1], dtype=np.int64)]
    words = np.concatenate(parts)
    ends = np.cumsum(sizes[order] + 1)  # place of the symbol behind each text
    period, place, stretch = candidates(words, sizes[order], ends)
    if not len(period):
        return nothing
    levels = recompress(words)
    back = [one.mirrored() for one in levels]
    starts, stops, periods = [], [], []
    while len(period):
        first = np.append(True, stretch[1:] != stretch[:-1])
        q, i = period[first], place[first]
        stop = i + q + agreement(levels, i, i + q)
        start = i - agreement(back, len(words) - i - q, len(words) - i)
        fits = stop - start >= np.maximum(LEAST, TIMES * q)
        starts.append(start[fits])
        stops.append(stop[fits])
        periods.append(q[fits])
        # places whose pair lies within this extension belong to it; the others go on
        open_ = place + period >= stop[np.cumsum(first) - 1]
        period, place, stretch = period[open_], place[open_], stretch[open_]
    start, stop, q = (np.concatenate(x) for x in (starts, stops, periods))
    by = np.lexsort((q, stop, start))
    start, stop, q = start[by], stop[by], q[by]
    smallest = np.append(True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1]))[: len(start)]
    start, stop, q = start[smallest], stop[smallest], q[smallest]
    n = np.searchsorted(ends, start)
    text, start, length = order[n], start - (ends[n] - sizes[order[n]]), stop - start
    by = np.lexsort((q, start, text))
    return text[by], start[by], length[by], q[by]


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds behind its first period, joined by one space."""
    if not len(start):
        return b" ".join(words)
    turn = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(turn, start + period, 1)
    np.add.at(turn, start + length, -1)
    return b" ".join(compress(words, (np.cumsum(turn[:-1]) == 0).tolist()))


def with_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words`` (long), ``runs`` (array of start, length, period, by start and period; word numbers
    from 0) and ``collapsed`` (the text without repetitions of a period).

    Words are parts between ASCII white space.  Null, empty and blank texts have no words, no runs and an
    empty ``collapsed``.  Every row, repeated or without an id, comes back once; columns called like an added
    one are replaced.  A batch holds about 4 MB of text, one whole text at least.
    """

    def make() -> Callable:
        def work(texts: list[bytes | None]) -> list[pa.Array]:
            split = [(data or b"").split() for data in texts]
            codes = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode().indices.to_numpy()
            bounds = np.cumsum([0, *map(len, split)])
            text, start, length, period = runs_of([codes[a:b] for a, b in zip(bounds, bounds[1:])])
            cut = np.searchsorted(text, np.arange(len(split) + 1))
            short = [
                collapsed(words, start[a:b], length[a:b], period[a:b]) for words, a, b in zip(split, cut.tolist(), cut[1:].tolist())
            ]
            found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), found)
            return [pa.array(list(map(len, split)), pa.int64()), runs, pa.array(short, pa.binary()).view(pa.string())]

        return work

    return append_columns(df, text, f"n_words long, runs array<{RUN}>, collapsed string", make)
