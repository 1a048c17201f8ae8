"""Audit of how sources of a language diverge in their use of words.

The groups (language, source) and the terms kept in a language make a matrix of counts that is
mostly zero.  Pairs of groups are compared over all terms on K-squared quadtrees: the matrix of a
tile of rows and a block of columns is a row of squares, each halved in both directions down to
leaves of LEAF x LEAF cells; a quadrant without counts is one zero bit and has no cells.  Two trees
are walked jointly, from the top, over all pairs of row quadrants: where both quadrants are zero,
every pair of their groups differs by the same amount in each of their columns and the quadrant
is priced by its width; where one is not, the walk descends, and leaves are compared cell by cell.

Counting happens in tasks on whole texts, and equal terms of a group are added up before and after
the shuffle.  The matrix is stored as its nonzero cells.  A task holds BLOCK columns of two tiles
of TILE rows at most, whatever one group or language holds of the rows.  All numbers are integers and exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmedallion.llm.batches import slices, small_batches, utf8
from flowmedallion.llm.components import store

MIN_DOCS = 30
TOP = 50
PRIOR = 5
SCALE_STEPS = 3
"""Shares are floored in units of 1000 ** -SCALE_STEPS."""
TILE = 256
BLOCK = 4_096
LEAF = 8
ENTRIES = 300_000
"""Terms that a task counts before it passes the counts on."""
CELLS = 1 << 12
"""Leaf pairs that are compared at once."""


def count_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, n, n_docs`` summed over all rows; a row with term '' stands for the group itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(rb"[A-Za-z\x80-\xff]+")
        held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        entries = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (own_lang, own_source), (times, rows) in held.items():
                terms = [b"", *times]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array([x] * len(terms), pa.binary()).view(pa.string()) for x in (own_lang, own_source)],
                        pa.array(terms, pa.binary()).view(pa.string()),
                        pa.array([0, *times.values()], pa.int64()),
                        pa.array([0, *[rows[t] for t in times]], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "n_docs"],
                )
            held.clear()

        for batch in batches:
            for piece in slices(batch, "text"):
                columns = [[x or b"" for x in utf8(piece.column(c))] for c in ("lang", "source", "text")]
                for own_lang, own_source, data in zip(*columns):
                    times, rows = held.setdefault((own_lang, own_source), (Counter(), Counter()))
                    entries -= len(times) - 1
                    words = letters.findall(data.lower())
                    times.update(words)
                    rows.update(set(words))
                    entries += len(times) + 1
                    if entries > ENTRIES:
                        yield from passed_on()
                        entries = 0
            pa.default_memory_pool().release_unused()
        yield from passed_on()

    named = docs.select(*[F.col(f"`{c}`").cast("string").alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = small_batches(named).mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(count: Column, size: Column) -> Column:
    """1 + floor(10^9 * (count + PRIOR) / size) by long division, exact for sizes under 9 * 10^15; 1 for size 0."""

    def step(at: Column, _: Column) -> Column:
        rest = at.rest * 1000
        whole = F.call_function("div", rest, at.size)
        return F.struct((at.quotient * 1000 + whole).alias("quotient"), (rest - whole * at.size).alias("rest"), at.size.alias("size"))

    over = count + F.lit(PRIOR).cast("long")
    whole = F.call_function("div", over, size)
    start = F.struct(whole.alias("quotient"), (over - whole * size).alias("rest"), size.alias("size"))
    steps = F.array(*[F.lit(k) for k in range(SCALE_STEPS)])
    return F.when(size > 0, F.aggregate(steps, start, step, lambda at: at.quotient) + 1).otherwise(F.lit(1).cast("long"))


def shares(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same on arrays of integers."""
    sizes = np.maximum(sizes, 1)
    quotient, rest = np.divmod(counts + PRIOR, sizes)
    for _ in range(SCALE_STEPS):
        whole, rest = np.divmod(rest * 1000, sizes)
        quotient = quotient * 1000 + whole
    return quotient + 1


class Quadtree:
    """A tile of groups and a block of columns; ``bits[0]`` says which leaves hold counts, ``bits[-1]`` has one row."""

    def __init__(self, row: np.ndarray, column: np.ndarray, count: np.ndarray, sizes: np.ndarray, side: int, width: int):
        self.zero = np.ones(side, dtype=np.int64)
        self.zero[: len(sizes)] = np.where(sizes > 0, shares(np.zeros_like(sizes), sizes), 1)
        grid = np.zeros((side // LEAF, width // LEAF), dtype=bool)
        grid[row // LEAF, column // LEAF] = True
        self.bits = [grid]
        while len(self.bits[-1]) > 1:
            now = self.bits[-1]
            self.bits.append(now.reshape(len(now) // 2, 2, now.shape[1] // 2, 2).any(axis=(1, 3)))
        self.number = np.where(grid, np.cumsum(grid).reshape(grid.shape) - 1, -1)
        self.leaves = np.empty((int(grid.sum()), LEAF, LEAF), dtype=np.int64)
        self.leaves[:] = self.zero.reshape(-1, LEAF)[np.nonzero(grid)[0]][:, :, None]
        own = shares(count, sizes[row]) if len(row) else count
        self.leaves[self.number[row // LEAF, column // LEAF], row % LEAF, column % LEAF] = own

    def cells(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Shares in leaves, zero leaves filled from their groups' share for a count of zero."""
        number = self.number[row, column]
        made = np.repeat(self.zero.reshape(-1, LEAF)[row][:, :, None], LEAF, axis=2)
        full = number >= 0
        made[full] = self.leaves[number[full]]
        return made


def joint_walk(one: Quadtree, other: Quadtree, same: bool) -> np.ndarray:
    """Sum over all columns of the difference of each group of one tree and each of the other.

    With ``same``, both are one tree and only quadrants on and above the diagonal are walked.
    """
    side = len(one.zero)
    zero_columns = np.zeros((side, side), dtype=np.int64)
    total = np.zeros((side // LEAF, side // LEAF, LEAF, LEAF), dtype=np.int64)
    c = np.arange(one.bits[-1].shape[1])
    a = b = np.zeros_like(c)
    for height in range(len(one.bits) - 1, -1, -1):
        span = LEAF << height
        full = one.bits[height][a, c] | other.bits[height][b, c]
        priced = np.zeros((side // span, side // span), dtype=np.int64)
        np.add.at(priced, (a[~full], b[~full]), span)
        zero_columns += np.kron(priced, np.ones((span, span), dtype=np.int64))
        a, b, c = a[full], b[full], c[full]
        if height:
            a, b, c = (
                (2 * x[:, None] + np.array(d)).ravel()
                for x, d in ((a, [0, 0, 0, 0, 1, 1, 1, 1]), (b, [0, 0, 1, 1, 0, 0, 1, 1]), (c, [0, 1] * 4))
            )
            if same:
                a, b, c = a[a <= b], b[a <= b], c[a <= b]
    for at in range(0, len(a), CELLS):
        x, y, z = (v[at : at + CELLS] for v in (a, b, c))
        mine, its = one.cells(x, z), other.cells(y, z)
        apart = np.zeros((len(x), LEAF, LEAF), dtype=np.int64)
        for k in range(LEAF):  # one column of all leaves at a time
            apart += np.abs(mine[:, :, None, k] - its[:, None, :, k])
        np.add.at(total, (x, y), apart)
    return total.transpose(0, 2, 1, 3).reshape(side, side) + zero_columns * np.abs(one.zero[:, None] - other.zero[None, :])


def compare_block(rows: pd.DataFrame) -> pd.DataFrame:
    """``lang, source, item, value`` for the pairs of groups of two tiles over one block of columns.

    Rows with term '' list the tiles' groups with their size; ``width`` is the block's number of terms.
    """
    head = rows["term"] == ""
    groups, cells = rows[head].sort_values("row"), rows[~head]
    low, high = int(groups["low"].iloc[0]), int(groups["high"].iloc[0])
    tiles = {t: groups[groups["row"] // TILE == t] for t in {low, high}}
    side = LEAF
    while side < max(len(t) for t in tiles.values()):
        side *= 2
    real = int(groups["width"].iloc[0])
    width = max(-(-real // side) * side, side)
    found, code = np.unique(cells["term"].to_numpy(dtype=object), return_inverse=True) if len(cells) else ([], np.empty(0, dtype=int))
    by_use = np.empty(len(found), dtype=np.int64)
    by_use[np.argsort(-np.bincount(code, minlength=len(found)), kind="stable")] = np.arange(len(found))  # frequent terms first
    column = by_use[code] if len(cells) else code
    place, tile = cells["row"].to_numpy() % TILE, cells["row"].to_numpy() // TILE
    trees = {
        t: Quadtree(place[tile == t], column[tile == t], cells["n"].to_numpy()[tile == t], own["size"].to_numpy(), side, width)
        for t, own in tiles.items()
    }
    sums = joint_walk(trees[low], trees[high], low == high)
    sums -= (width - real) * np.abs(trees[low].zero[:, None] - trees[high].zero[None, :])  # columns that fill the last square
    names = [tiles[t]["source"].to_numpy(dtype=object) for t in (low, high)]
    sums = sums[: len(names[0]), : len(names[1])]
    a, b = np.triu_indices(len(names[0]), 1) if low == high else np.indices(sums.shape).reshape(2, -1)
    out = {"source": names[0][a], "item": names[1][b], "value": sums[a, b]}
    return pd.DataFrame({"lang": np.full(len(a), groups["lang"].iloc[0], dtype=object), **out})


def pair_values(cells: DataFrame, groups: DataFrame, kept: DataFrame, langs: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for both directions of all pairs of groups of a language."""
    blocks = F.greatest(F.ceil(F.col("v") / BLOCK), F.lit(1)).cast("int")
    plan = langs.select("lang", blocks.alias("blocks"), F.ceil(F.col("groups") / TILE).cast("int").alias("tiles"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    widths = kept.join(plan, "lang").select("lang", block).groupBy("lang", "block").agg(F.count("*").alias("width"))
    mate = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    ends = [F.least(F.floor(F.col("row") / TILE).cast("int"), "mate").alias("low"), F.greatest(F.floor(F.col("row") / TILE).cast("int"), "mate").alias("high")]
    heads = (
        groups.join(plan, "lang")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("mate", mate)
        .join(widths, ["lang", "block"], "left")
        .select("lang", "block", *ends, "source", "row", F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), "size",
                F.coalesce("width", F.lit(0)).cast("long").alias("width"))
    )
    body = (
        cells.join(groups.select("lang", "source", "row"), ["lang", "source"])
        .join(plan, "lang")
        .withColumn("mate", mate)
        .select("lang", block, *ends, "source", "row", "term", "n", F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("width"))
    )
    schema = "lang string, source string, item string, value long"
    parts = heads.unionByName(body).groupBy("lang", "block", "low", "high").applyInPandas(compare_block, schema)
    once = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return once.select("lang", F.explode(both).alias("p"), "value").select("lang", "p.source", "p.item", "value")


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for all groups of the frame.

    Terms are runs of letters and of characters beyond ASCII, lower-cased A-Z; a language keeps those in at
    least ``min_docs`` of its rows.  A group gives each kept term the share 1 + floor(10^9 (count + 5) / (N + 5 V)).
    Part ``pair``: for every other source of the language, the sum over all kept terms of the difference of the
    two shares (0 if no term is kept).  Part ``term``: the ``top`` terms that the group has and gives a greater share than
    its language does, by the difference.  Ranks go by falling value, then by item.

    Null texts, languages and sources count as ''.  Groups without terms, repeated rows and languages of one
    source (no pair) are treated like others; an empty frame gives an empty one; further columns don't matter.
    """
    counts, _ = store(count_terms(docs, lang, source, text), "terms")
    by_term = counts.filter("term <> ''").groupBy("lang", "term")
    kept, _ = store(by_term.agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("docs")).filter(F.col("docs") >= min_docs), "kept")
    cells, _ = store(counts.filter("term <> ''").join(kept.select("lang", "term", "lang_n"), ["lang", "term"]).drop("n_docs"), "cells")
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_size"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    present = counts.filter("term = ''").select("lang", "source")
    langs = (
        present.groupBy("lang")
        .agg(F.count("*").alias("groups"))
        .join(vocabulary, "lang", "left")
        .select("lang", "groups", F.coalesce("v", F.lit(0)).alias("v"), (F.col("lang_size") + PRIOR * F.col("v")).alias("lang_size"))
    )
    groups = (
        present.join(sums, ["lang", "source"], "left")
        .join(langs, "lang")
        .select(
            "lang", "source", (F.coalesce("own", F.lit(0)) + PRIOR * F.col("v")).alias("size"), "lang_size",
            (F.row_number().over(Window.partitionBy("lang").orderBy(F.coalesce("own", F.lit(0)).desc(), "source")) - 1).alias("row"),
        )
    )
    groups, _ = store(groups, "groups")
    pairs = pair_values(cells, groups, kept, langs).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    more = share(F.col("n"), F.col("size")) - share(F.col("lang_n"), F.col("lang_size"))
    terms = (
        cells.join(groups.select("lang", "source", "size", "lang_size"), ["lang", "source"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), more.alias("value"))
        .filter("value > 0")
    )
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    return pairs.select("*", place).unionByName(terms.select("*", place).filter(F.col("rank") <= top))
