"""Near-duplicate classes by SimHash fingerprints and pivot distance tables.

A pair of fingerprints that differ in at most 3 of 64 bits agrees in at least 3 of 6 bit
blocks, so rows meet in 20 bands, each keyed by the bits of 3 blocks.  Within a key, every
fingerprint has a row of distances to reference fingerprints (pivots); by the triangle
inequality a pair whose distances to any pivot differ by more than 3 cannot be a link.
Rows are ordered by their distance to the first pivot and compared while that differs by 3
at most, pairs are discarded by the largest difference over all pivots, and the rest are
verified bit by bit.  No link is lost.

Equal fingerprints are one row from the start.  Of the links within one key only those of a
spanning forest leave the task.  Keys that hold many fingerprints (estimated on a hashed
share of them, which changes no result) are cut into chunks, and pairs of chunks are
compared in different tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmedallion.llm.batches import append_columns, numbered, place, restored
from flowmedallion.llm.components import components, store

SEED = 42
BITS = 3
"""Most differing bits of a link."""
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
MASKS = [sum(((1 << n) - 1) << at for at, n in three) for three in combinations(BLOCKS, 3)]
PIVOTS = 32
CHUNK = 4_000
"""Fingerprints of one key that are compared in one task."""
SHARE = 16
"""One in so many fingerprints counts for the estimate of a key's size."""


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint(data: bytes | None, digest: Callable[[bytes, int], int], width: int = 3) -> int:
    """SimHash of the word shingles of a text, lower-cased A-Z, as a signed 64-bit integer."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fp`` (long); null and empty texts have 0.  A column called fp is replaced."""

    def make() -> Callable:
        import xxhash

        def work(texts: list[bytes | None]) -> list[pa.Array]:
            return [pa.array([fingerprint(data, xxhash.xxh64_intdigest) for data in texts], pa.int64())]

        return work

    return append_columns(df, text, "fp long", make)


def linked_within(run: np.ndarray, fps: np.ndarray, near: np.ndarray, pivots: np.ndarray, bits: int) -> np.ndarray:
    """Index pairs (n, 2) of links between rows of one run; rows are ordered by run and near,
    their distance to the first pivot."""
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)
    at, found, step = np.arange(len(fps)), [], 1
    while True:
        at = at[at + step < len(fps)]
        other = at + step
        open_ = (run[at] == run[other]) & (near[other] - near[at] <= bits)
        at, other = at[open_], other[open_]  # rows are ordered: who is out now stays out
        if not len(at):
            break
        for i in range(0, len(at), 1 << 15):
            a, b = at[i : i + (1 << 15)], other[i : i + (1 << 15)]
            close = np.abs(table[a] - table[b]).max(axis=1) <= bits
            a, b = a[close], b[close]
            real = np.bitwise_count(fps[a] ^ fps[b]) <= bits
            found.append(np.stack([a[real], b[real]], axis=1))
        step += 1
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that join two trees, in their order."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    kept = []
    for a, b in pairs.tolist():
        ta, tb = top(a), top(b)
        if ta != tb:
            up[tb] = ta
            kept.append((a, b))
    return kept


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges ``a, b`` that connect exactly the fingerprints that chains of links connect.

    ``prints`` has one row for each distinct ``fp``.
    """
    if bits != BITS:
        raise ValueError(f"the bands are made for {BITS} bits")
    chosen = [r.fp for r in prints.orderBy(F.xxhash64("fp"), "fp").limit(PIVOTS).collect()] or [0]
    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(MASKS)])
    keyed = prints.select("fp", F.explode(bands).alias("k")).select("fp", "k.band", "k.key")
    counted = keyed.filter(F.pmod(F.xxhash64("fp"), F.lit(SHARE)) == 0).groupBy("band", "key").count()
    hot = counted.filter(F.col("count") * SHARE > CHUNK).select(
        "band", "key", F.ceil(F.col("count") * SHARE / CHUNK).cast("int").alias("chunks")
    )
    spread = (
        keyed.join(hot, ["band", "key"], "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks")).cast("int"))
        .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "band", "key", F.least("own", "mate").alias("low"), F.greatest("own", "mate").alias("high"), "fp",
            F.bit_count(F.col("fp").bitwiseXOR(F.lit(chosen[0]))).alias("near"),
        )
    )
    cell = ["band", "key", "low", "high"]
    sorted_ = spread.repartition(*cell).sortWithinPartitions(*cell, "near", "fp")
    pivots = np.array(chosen, dtype=np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def work(table: pa.Table) -> pa.RecordBatch:
            cols = [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in cell]
            fps = table.column("fp").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
            near = table.column("near").combine_chunks().to_numpy(zero_copy_only=False)
            new = np.zeros(len(fps), dtype=bool)
            for col in cols:
                new[1:] |= col[1:] != col[:-1]
            pairs = forest(linked_within(np.cumsum(new), fps, near, pivots, bits))
            ends = fps.view(np.int64)[np.array(pairs, dtype=np.int64).reshape(-1, 2)]
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["a", "b"])

        def gathered() -> Iterator[pa.Table]:
            waiting: list[pa.RecordBatch] = []
            for batch in batches:
                waiting.append(batch)
                if sum(b.num_rows for b in waiting) >= 1 << 16:
                    yield pa.Table.from_batches(waiting)
                    waiting = []
            if waiting:
                yield pa.Table.from_batches(waiting)

        for piece in gathered():
            if not piece.num_rows:
                continue
            held = piece if held is None else pa.concat_tables([held, piece])
            last = [held.column(c)[-1] for c in cell]
            same = np.ones(held.num_rows, dtype=bool)
            for c, value in zip(cell, last, strict=True):
                same &= held.column(c).combine_chunks().to_numpy(zero_copy_only=False) == value.as_py()
            start = int(np.argmax(same))  # rows from here on may go on in the next batch
            if start:
                yield work(held.slice(0, start))
                held = held.slice(start)
        if held is not None and held.num_rows:
            yield work(held)

    return sorted_.mapInArrow(run, "a long, b long")


def classes(rows: DataFrame) -> DataFrame:
    """Add ``root`` (the fingerprint that names the class) and ``component_id`` (its smallest id)
    to a stored table with ``doc_id`` and ``fp``."""
    prints, _ = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = components(links(prints)).select(F.col("node").alias("fp"), "root")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(rooted.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the fingerprint and the smallest id that chains
    of links reach, the row's own included.

    Rows without an id are linked like others but name no class (a class of such rows only
    has none).  Repeated rows come back repeated; no row is lost.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, _ = store(with_fingerprints(named).select("doc_id", "fp"), "fingerprints")
    return classes(rows).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate class stays, with the columns it had: the one with the
    smallest id (rows without an id come last; among equal ids, any one whole row)."""
    printed = with_fingerprints(numbered(docs), place(docs, text))
    rows, _ = store(printed.withColumn("at", F.monotonically_increasing_id()), "rows")
    first = (
        classes(rows.select(F.col(place(docs, doc_id)).alias("doc_id"), "fp", "at"))
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")).alias("first"))
        .select(F.col("first.at").alias("at"))
    )
    return restored(rows.join(first, "at", "left_semi"), docs)
