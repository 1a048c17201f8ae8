"""Samples and splits that do not depend on partitioning.

Every draw is a hash of the row's key columns, so a repeated or re-partitioned
run, or a recomputed task, picks the same rows.  Rows that share a key go the
same way; use key columns that identify a row (all columns, by default, after
exact duplicates were removed).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowmedallion import vocabulary as V
from flowmedallion.functions.hashing import digest_below, digest_unit, row_digest
from flowmedallion.sources.session import materialize

SPLIT = "split"
TRAIN = "train"
TEST = "test"
VOLATILE = ("_ingestion_ts",)
BUCKET_DIGITS = 4


def default_keys(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in VOLATILE]


def random_rows(df: DataFrame, n: int, key_cols: Sequence[str] | None = None, seed: int = V.SEED) -> DataFrame:
    """``n`` pseudo-random rows: each task keeps its own best ``n``, then they are merged."""
    digest = row_digest(key_cols or default_keys(df), seed)
    return df.orderBy(digest).limit(n)


def stratified_sample(
    df: DataFrame,
    class_col: str = "is_attack",
    key_cols: Sequence[str] | None = None,
    sample_size: int = V.SAMPLE_SIZE,
    seed: int = V.SEED,
    classes: Sequence[int] = (0, 1),
) -> DataFrame:
    """About ``sample_size`` rows, each class at the same fraction of its rows.

    The fraction comes from a count inside the same plan (answered from file
    footers when ``df`` is a bare table).  An empty frame stays empty.
    """
    total = df.agg(F.nullif(F.count("*"), F.lit(0)).cast("double")).scalar()
    fraction = F.coalesce(F.least(F.lit(1.0), F.lit(float(sample_size)) / total), F.lit(1.0))
    draw = digest_unit(row_digest(key_cols or default_keys(df), seed))
    return df.filter(F.col(class_col).isin(*classes) & (draw < fraction))


def stratified_split(
    df: DataFrame,
    key_cols: Sequence[str] | None = None,
    test_share: float = V.TEST_SHARE,
    seed: int = V.SEED,
) -> DataFrame:
    """Tag each row ``train`` or ``test`` without any shuffle.

    The draw is independent of the class, so every class has the test share up
    to chance; ``stratified_split_exact`` gives exact shares.
    """
    digest = row_digest(key_cols or default_keys(df), seed)
    return df.withColumn(SPLIT, F.when(digest_below(digest, test_share), TEST).otherwise(TRAIN))


def stratified_split_exact(
    df: DataFrame,
    class_col: str = "is_attack",
    key_cols: Sequence[str] | None = None,
    test_share: float = V.TEST_SHARE,
    seed: int = V.SEED,
) -> DataFrame:
    """Tag exactly ``round(share * rows of the class)`` rows of each class as ``test``.

    Every value of the class column is a class, null among them; no row is lost.  The rows of a class with the smallest digests form its test part (exact when
    the key columns identify a row; copies of a key stay together).  No class
    is ever sorted as a whole: a histogram over 65,536 digest prefixes finds the
    prefix in which the quota ends, only keys with that prefix are ranked, and
    the resulting cut-off digest (one row per class, hence the broadcast) is
    compared with every row.
    """
    return _cut_classes(df, *_draws(df, class_col, key_cols, seed), test_share)


def _draws(df: DataFrame, class_col: str, key_cols: Sequence[str] | None, seed: int) -> tuple[Column, Column]:
    digest = row_digest(key_cols or default_keys(df), seed)
    return digest, F.coalesce(F.concat(F.lit("="), F.col(class_col).cast("string")), F.lit("null"))


def stratified_split_stored(
    df: DataFrame,
    class_col: str = "is_attack",
    key_cols: Sequence[str] | None = None,
    test_share: float = V.TEST_SHARE,
    seed: int = V.SEED,
) -> DataFrame:
    """``stratified_split_exact`` that reads its input and hashes each row once.

    Eager: the rows are written to the scratch folder with class and digest.  The histogram reads the class and
    the digest's first digits, the ranking the class and the digest, the result the stored rows; the
    input, which may be a costly plan, is not run again.
    """
    taken = {c.lower() for c in df.columns} & {"_class", "_digest"}
    if taken:
        raise ValueError(f"columns of the frame are called like those of the split: {', '.join(sorted(taken))}")
    digest, class_key = _draws(df, class_col, key_cols, seed)
    stored = materialize(df.withColumns({"_class": class_key, "_digest": digest}), "digests")
    return _cut_classes(stored, F.col("_digest"), F.col("_class"), test_share).drop("_class", "_digest")


def _drawn(digest: Column, class_key: Column, df: DataFrame) -> DataFrame:
    return df.select(
        class_key.alias("_class"),
        digest.alias("_digest"),
        F.substring(digest, 1, BUCKET_DIGITS).alias("_bucket"),
    )


def _bucket_counts(drawn: DataFrame) -> DataFrame:
    """Rows of each class by the first digits of their digests."""
    return drawn.groupBy("_class", "_bucket").agg(F.count("*").alias("_rows"))


def _cuts(drawn: DataFrame, counts: DataFrame, test_share: float) -> DataFrame:
    """The cut-off digest of each class and the rows up to it; classes without test rows have none."""
    in_order = Window.partitionBy("_class").orderBy("_bucket")
    whole = Window.partitionBy("_class")
    edges = (
        counts.withColumns(
            {
                "_before": F.sum("_rows").over(in_order) - F.col("_rows"),
                "_quota": F.round(F.sum("_rows").over(whole) * F.lit(test_share)).cast("bigint"),
            }
        )
        .filter(F.col("_quota").between(F.col("_before") + 1, F.col("_before") + F.col("_rows")))
        .select("_class", "_bucket", "_before", (F.col("_quota") - F.col("_before")).alias("_place"))
    )
    # copies of a key share a digest and collapse here, so that a hot key is one row to rank
    through = F.sum("_rows").over(Window.partitionBy("_class").orderBy("_digest"))
    return (
        drawn.join(F.broadcast(edges), ["_class", "_bucket"])
        .groupBy("_class", "_digest")
        .agg(F.count("*").alias("_rows"), F.first("_place").alias("_place"), F.first("_before").alias("_before"))
        .withColumn("_through", through)
        .filter(F.col("_place").between(F.col("_through") - F.col("_rows") + 1, F.col("_through")))
        .select("_class", F.col("_digest").alias("_cut"), (F.col("_before") + F.col("_through")).alias("_test_rows"))
    )


def _cut_classes(df: DataFrame, digest: Column, class_key: Column, test_share: float) -> DataFrame:
    """Tag the rows of each class up to its cut-off digest as ``test``."""
    drawn = _drawn(digest, class_key, df)
    cuts = _cuts(drawn, _bucket_counts(drawn), test_share).select(F.col("_class").alias("_cut_class"), "_cut")
    is_test = F.coalesce(digest <= F.col("_cut"), F.lit(False))
    return (
        df.join(F.broadcast(cuts), class_key == F.col("_cut_class"), "left")
        .withColumn(SPLIT, F.when(is_test, TEST).otherwise(TRAIN))
        .drop("_cut_class", "_cut")
    )


@dataclass(frozen=True)
class Sides:
    """The exact split of a frame as conditions on its rows, and the rows of the train side."""

    is_test: Column
    train_rows: int

    def test(self, df: DataFrame) -> DataFrame:
        return df.filter(self.is_test)

    def train(
        self, df: DataFrame, bound: int | None = None, key_cols: Sequence[str] | None = None, seed: int = V.SEED
    ) -> DataFrame:
        """The train side, or about ``bound`` rows of it, drawn as ``bound_train`` draws them."""
        rows = df.filter(~self.is_test)
        if bound is None or bound >= self.train_rows:
            return rows
        keys = key_cols or [c for c in default_keys(df) if c != SPLIT]
        return rows.filter(digest_unit(row_digest(keys, seed)) < float(bound) / self.train_rows)


def stratified_sides(
    df: DataFrame,
    class_col: str = "is_attack",
    key_cols: Sequence[str] | None = None,
    test_share: float = V.TEST_SHARE,
    seed: int = V.SEED,
) -> Sides:
    """The split of ``stratified_split_exact`` for frames of few classes, of which each side is read on its own.

    Eager: one pass counts the digests, a second ranks one bucket of each class; one row for each class reaches the
    driver, and the cuts are plain values in the conditions.  The sizes of both sides follow from the same counts.
    """
    digest, class_key = _draws(df, class_col, key_cols, seed)
    drawn = _drawn(digest, class_key, df)
    counts = materialize(_bucket_counts(drawn), "digest-counts")
    cuts = _cuts(drawn, counts, test_share).collect()
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    is_test = F.lit(False)
    if cuts:  # a lookup names the class once, so that a costly class column is worked out once for each row
        cut = F.create_map(*[F.lit(x) for row in cuts for x in (row["_class"], row["_cut"])])
        is_test = F.coalesce(digest <= F.try_element_at(cut, class_key), F.lit(False))
    return Sides(is_test, total - sum(row["_test_rows"] for row in cuts))


def bound_train(df: DataFrame, train_rows: int, key_cols: Sequence[str] | None = None, seed: int = V.SEED) -> DataFrame:
    """About ``train_rows`` rows of the train side stay; rows of other sides all stay.

    Every class keeps the same fraction up to chance, drawn by hash without a shuffle.
    The draw must not be the split's own, so give it another seed.
    """
    keys = key_cols or [c for c in default_keys(df) if c != SPLIT]
    total = df.agg(F.nullif(F.sum(F.when(F.col(SPLIT) == TRAIN, 1)), F.lit(0)).cast("double")).scalar()
    fraction = F.coalesce(F.least(F.lit(1.0), F.lit(float(train_rows)) / total), F.lit(1.0))
    return df.filter((F.col(SPLIT) != TRAIN) | (digest_unit(row_digest(keys, seed)) < fraction))


def temporal_split(
    df: DataFrame,
    train_days: Sequence[str] = V.TRAIN_DAYS,
    test_days: Sequence[str] = V.TEST_DAYS,
    day_col: str = "day_of_week",
) -> DataFrame:
    """Tag rows by day; rows of other days are dropped at the scan."""
    day = F.col(day_col)
    kept = df.filter(day.isin(*train_days, *test_days))
    return kept.withColumn(SPLIT, F.when(day.isin(*train_days), TRAIN).otherwise(TEST))


def part(df: DataFrame, name: str) -> DataFrame:
    """The rows of one side of a split."""
    return df.filter(F.col(SPLIT) == name).drop(SPLIT)
