"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Documents with equal texts form a group (null counts as empty); a group is placed whole in
the shard where the dot product of its vector (bytes, tokens, rows, each as a share of a
shard's capacity) with the shard's residual capacity is highest, large groups first, the
lowest shard among equals.

Groups are placed level by level.  The first level is one cell and takes the groups of
over 1/FINE of a shard in some coordinate, of which there are few; the next has SPLIT
times as many cells, each with its share of what is left of every shard, and takes the
groups of over 1/FINE of that, and so on; the last level takes the rest in cells of about
CELL groups.  Cells of a level are packed in parallel and none grows with the data.  Each
level starts from the capacities that the levels before it left, so it evens them out.

Only a group that fits in no shard's residual capacity is cut, into runs of its rows of at
most 1/WHOLE of a shard that are placed like groups.  Slots number the rows of a shard from
0 without gaps; the rows of large groups are numbered in pieces of about PIECE_ROWS, by as
many tasks, which has no part in where they are placed.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmedallion.llm.components import store

SHARDS = 40
FINE = 100
SPLIT = 64
CELL = 20_000
WHOLE = 4
PIECE_ROWS = 20_000
BROADCAST_ROWS = 100_000
"""Most groups cut into pieces that are broadcast to their rows; more meet them by shuffle."""
ROW_BYTES = 16
SIDES = ("bytes", "tokens", "rows")
WEIGHTS = np.array([16.0, 1.0, 1.0])
"""Weights of the sides in the dot product: bytes first, so that they come out nearest to equal."""


def pack(sizes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The shard of each group, greedily.  ``sizes`` (groups x 3) and ``room`` (shards x 3, changed in
    place) are in shares of a shard's capacity."""
    shards = np.empty(len(sizes), dtype=np.int32)
    for i, own in enumerate(sizes):
        best = int(np.argmax(room @ (own * WEIGHTS)))
        room[best] -= own
        shards[i] = best
    return shards


def spans(sizes: np.ndarray, rows: np.ndarray, room: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(group, first row, rows, shard) of every group in order; ``room`` is changed in place.  A group stays
    whole where a shard has room for it or it is at most 1/FINE of one; its rows are all alike."""
    out = []
    for i, (own, n) in enumerate(zip(sizes, rows.tolist(), strict=True)):
        fits = (room >= own - 1e-9).all(axis=1)
        if n < 2 or fits.any() or own.max() <= 1 / FINE:
            value = room @ (own * WEIGHTS)
            best = int(np.argmax(np.where(fits, value, -np.inf) if fits.any() and own.max() > 1 / FINE else value))
            room[best] -= own
            out.append((i, 0, n, best))
            continue
        cuts = np.linspace(0, n, min(n, math.ceil(own.max() * WHOLE)) + 1).astype(np.int64)
        runs = np.diff(cuts)
        for first, m, shard in zip(cuts.tolist(), runs.tolist(), pack(own * (runs / n)[:, None], room).tolist(), strict=False):
            out.append((i, first, m, shard))
    return out


def place_level(items: DataFrame, cells: int, room: np.ndarray, capacity: np.ndarray) -> DataFrame:
    """Pack the groups of one level; adds each run's first row, rows, shard, cell and the rows that the
    cell put there before it."""

    def cell_of(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf[["bytes", "tokens", "rows"]].to_numpy(dtype=float) / capacity
        order = np.lexsort((pdf["grp"].map(bytes), -(sizes @ WEIGHTS)))
        pdf, sizes = pdf.iloc[order].reset_index(drop=True), sizes[order]
        at, first, n, shard = (np.array(c) for c in zip(*spans(sizes, pdf["rows"].to_numpy(), room / cells), strict=True))
        out = pdf.iloc[at].reset_index(drop=True)
        for side in ("bytes", "tokens"):
            out[side] = out[side] // out["rows"] * n
        out["first"], out["rows"], out["shard"] = first, n, shard
        out["before"] = out.groupby("shard")["rows"].cumsum() - out["rows"]
        return out[["grp", "first", "level", "cell", "shard", "before", "rows", "bytes", "tokens"]]

    return (
        items.withColumn("cell", F.pmod(F.xxhash64("grp"), F.lit(cells)))
        .groupBy("cell")
        .applyInPandas(
            cell_of, "grp binary, first long, level int, cell long, shard int, before long, rows long, bytes long, tokens long"
        )
    )


def shard_rows(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; size is the text's UTF-8 bytes plus ROW_BYTES."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows, _ = store(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            (F.octet_length(whole) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.regexp_count(whole, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
            F.unhex(F.md5(whole.cast("binary"))).alias("grp"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "rows",
    )
    sums = (F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"))
    total = rows.agg(*sums).first()
    capacity = np.array([max(total[s] or 0, 1) / shards for s in SIDES])
    part = F.greatest(*[F.col(s) / c for s, c in zip(SIDES, capacity.tolist(), strict=True)])  # of a shard
    cut, _ = store(
        rows.groupBy("grp").agg(*sums)
        .select("grp", F.greatest(F.ceil(part * WHOLE), F.ceil(F.col("rows") / PIECE_ROWS)).alias("pieces"))
        .filter("pieces > 1"),
        "cut",
    )
    few = cut.count() <= BROADCAST_ROWS  # then no task gets all rows of a large group
    parted, _ = store(
        rows.join(F.broadcast(cut) if few else cut, "grp", "left")
        .withColumn("piece", F.coalesce(F.pmod(F.xxhash64("at"), F.col("pieces")), F.lit(0)).cast("int"))
        .repartition("grp", "piece")  # a join by shuffle leaves rows by group, pieces of one together
        .withColumn("number", F.row_number().over(Window.partitionBy("grp", "piece").orderBy("doc_id", "at")))
        .drop("pieces", "at"),
        "parted",
    )
    numbered, _ = store(parted.groupBy("grp", "piece").agg(*sums), "pieces")
    items, _ = store(numbered.groupBy("grp").agg(*[F.sum(s).alias(s) for s in SIDES]), "items")
    last = max(1, -(-items.count() // CELL))
    cells = [1]
    while cells[-1] * SPLIT < last:
        cells.append(cells[-1] * SPLIT)
    cells.append(max(last, 1))
    level = reduce(
        lambda rest, i: F.when(part > 1 / (FINE * cells[i]), i).otherwise(rest), range(len(cells) - 2, -1, -1), F.lit(len(cells) - 1)
    )
    leveled = items.withColumn("level", level.cast("int"))
    room, placed = np.ones((shards, 3)), []
    for i, n in enumerate(cells):
        table, _ = store(place_level(leveled.filter(F.col("level") == i), n, room, capacity), "placed")
        placed.append(table)
        for r in table.groupBy("shard").agg(*[F.sum(s).alias(s) for s in SIDES]).collect():  # at most one for each shard
            room[r["shard"]] -= np.array([r[s] for s in SIDES], dtype=float) / capacity
    everything = reduce(DataFrame.unionByName, placed)
    ahead = Window.partitionBy("shard").orderBy("level", "cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        everything.groupBy("shard", "level", "cell").agg(F.sum("rows").alias("own"))
        .withColumn("offset", F.coalesce(F.sum("own").over(ahead), F.lit(0)))
        .drop("own")
    )
    runs = everything.join(offsets, ["shard", "level", "cell"]).select(
        "grp", "first", F.col("rows").alias("n"), "shard", (F.col("offset") + F.col("before")).alias("start")
    )
    earlier = Window.partitionBy("grp").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    ranges = numbered.select("grp", "piece", "rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("ahead"))
    starts = (
        ranges.join(runs, "grp")  # a piece meets the runs that its rows are in, by their numbers within the piece
        .select(
            "grp", "piece", "shard", F.greatest(F.col("first") - F.col("ahead"), F.lit(0)).alias("low"),
            F.least(F.col("first") + F.col("n") - F.col("ahead"), F.col("rows")).alias("high"), (F.col("start") + F.col("ahead") - F.col("first")).alias("base"),
        )
        .filter("low < high")
    )
    inside = (F.col("number") > F.col("low")) & (F.col("number") <= F.col("high"))
    return parted.join(starts.withColumnsRenamed({"grp": "own", "piece": "part"}), (F.col("grp") == F.col("own")) & (F.col("piece") == F.col("part")) & inside).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("number") - 1).alias("slot")
    )
