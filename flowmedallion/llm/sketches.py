"""Bottom-k sketches of word shingles: resemblance, containment and number of distinct shingles.

A text's shingles are its runs of WIDTH words (parts between ASCII white space, lower-cased); a
text of fewer words has one shingle, all its words, and a text without words none.  A shingle's
hash is the first DIGITS hexadecimal digits of its MD5, and the sketch holds the KEPT smallest
distinct hashes in order.  The sketch of a union is the smallest hashes of the sketches' union, so
sketches of parts merge without the texts.  While a sketch is not full it holds all hashes, and
what it tells is exact but for equal hashes of different shingles.

Only DataFrame functions are used, so everything stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 5
KEPT = 128
DIGITS = 12
SPACE = r"[\x20\x09-\x0D]+"
RANGE_ROWS = 2_000
"""Rows of one range of ids, while there are at most MOST_RANGES; beyond, ranges grow."""
MOST_RANGES = 20_000
"""Most range limits that reach the driver and go into the plan."""


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingles(text: Column, width: int = WIDTH) -> Column:
    """The text's shingles in order, repeats included; null counts as empty."""

    def cut(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1)))
        return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(
            F.transform(places, lambda i: F.array_join(F.slice(words, i, width), " "))
        )

    return let(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), ""), cut)


def smallest(hashes: Column, kept: int = KEPT) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, kept)


def sketch(text: Column, width: int = WIDTH, kept: int = KEPT) -> Column:
    """The text's sketch, an array of hashes in rising order."""
    return smallest(F.transform(shingles(text, width), lambda s: F.left(F.md5(s.cast("binary")), F.lit(DIGITS))), kept)


def merged(one: Column, other: Column, kept: int = KEPT) -> Column:
    """The sketch of the shingles of both."""
    return smallest(F.concat(one, other), kept)


def merge_groups(df: DataFrame, keys: Sequence[str], column: str, kept: int = KEPT) -> DataFrame:
    """One row ``*keys, <column>`` for each group: the sketch of all its rows' shingles.

    Equal hashes meet by group and hash, and each task passes on only the smallest of a group, so a
    group of any size is no burden.  Groups whose rows hold no hash have an empty sketch; null keys
    are a group like others.
    """
    parts = [F.col(f"`{k}`") for k in keys]
    hashes = df.select(*parts, F.explode_outer(F.col(f"`{column}`")).alias("_hash")).distinct()
    first = F.row_number().over(Window.partitionBy(*parts).orderBy(F.col("_hash").asc_nulls_last()))
    low = hashes.withColumn("_place", first).filter(F.col("_place") <= kept)
    return low.groupBy(*parts).agg(F.array_sort(F.collect_list("_hash")).alias(column))


def resemblance(one: Column, other: Column, kept: int = KEPT) -> Column:
    """Estimated share of shingles in common among those of both (0 to 1); two empty sketches: 1."""

    def share(union: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(union, one), other))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))

    return let(merged(one, other, kept), share)


def containment(one: Column, other: Column, kept: int = KEPT) -> Column:
    """Estimated share of the first one's shingles that the other has (0 to 1); 1 where the first has none.

    Only hashes up to the smaller limit of the two full sketches can be compared; 0 where none is.
    """

    def limit(of: Column) -> Column:
        return F.when(F.size(of) < kept, F.lit("g")).otherwise(F.element_at(of, -1))

    def share(low: Column) -> Column:
        found = F.size(F.array_intersect(low, other))
        return F.when(F.size(low) == 0, F.lit(0.0)).otherwise(found / F.size(low))

    bound = F.least(limit(one), limit(other))
    compared = let(bound, lambda b: F.filter(one, lambda h: h <= b))
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(let(compared, share))


def distinct_shingles(of: Column, kept: int = KEPT) -> Column:
    """Number of distinct shingles: exact for a sketch that is not full, else estimated from its largest hash."""
    reach = (F.conv(F.element_at(of, -1), 16, 10).cast("double") + 1) / F.lit(float(16**DIGITS))
    return F.when(F.size(of) < kept, F.size(of).cast("double")).otherwise((kept - 1) / reach)


def printed(of: Column) -> Column:
    """The sketch as one string, its hashes one after another."""
    return F.array_join(of, "")


def id_ranges(df: DataFrame, doc_id: str) -> list[int]:
    """First ids of ranges of about RANGE_ROWS rows, rising, the smallest id first; none for no ids."""
    ids = df.select(F.col(f"`{doc_id}`").alias("id")).filter("id is not null")
    rows = ids.count()
    if not rows:
        return []
    ranges = min(MOST_RANGES, -(-rows // RANGE_ROWS))
    shares = [k / ranges for k in range(1, ranges)] or [0.5]
    found = ids.agg(F.min("id").alias("least"), F.percentile_approx("id", shares, 10 * ranges + 1000).alias("cuts")).first()
    return sorted({found.least, *(found.cuts if ranges > 1 else [])})


def with_next_text(df: DataFrame, doc_id: str, text: str, added: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Add what ``added`` makes of each row's text, and under ``next_text`` and ``next_<name>`` the same of the next row.

    Rows follow each other by id, rows of one id by text; the first row follows the last.  Rows
    without an id have no next row.  Ids must be integers.  Rows go by ranges of ids; the
    first ids of ranges are rows' own ids, and such a row also goes, as the one to look ahead to,
    to the range before.  So the texts are shuffled once and no range has to know another.
    """
    firsts = id_ranges(df, doc_id)
    named = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    lone = named.filter("doc_id is null")
    lone = lone.withColumns({name: make(F.col("text")) for name, make in added.items()})
    lone = lone.withColumns({f"next_{c}": F.lit(None).cast(lone.schema[c].dataType) for c in ("text", *added)})
    if not firsts:
        return lone
    limits = F.split(F.lit(",".join(map(str, firsts))), ",").cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(firsts).bit_length()))]

    def search(at: Column, step: Column) -> Column:
        beyond = at + step
        inside = F.when(beyond <= len(firsts), F.element_at(limits, F.least(beyond, F.lit(len(firsts)))) <= F.col("doc_id"))
        return F.when(inside, beyond).otherwise(at)

    own = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), search)
    before = F.when(F.col("own") == 1, F.lit(len(firsts))).otherwise(F.col("own") - 1)
    here, there = (F.struct(at.alias("range"), F.lit(ahead).alias("ahead")) for at, ahead in ((F.col("own"), False), (before, True)))
    first = F.element_at(limits, F.col("own")) == F.col("doc_id")
    dealt = (
        named.filter("doc_id is not null")
        .withColumn("own", own)
        .select("doc_id", "text", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))).alias("to"))
        .select("doc_id", "text", "to.range", "to.ahead")
        .repartition("range")
        .withColumns({name: make(F.col("text")) for name, make in added.items()})
    )
    order = Window.partitionBy("range").orderBy("ahead", "doc_id", "text")
    following = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("text", *added)})
    return following.filter("not ahead").drop("range", "ahead").unionByName(lone)


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter of code points (rounded down) replaced by as many, or all, first ones of the other."""
    size = F.char_length(text)
    cut = F.floor(size / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - cut), F.substring(F.coalesce(following, F.lit("")), F.lit(1), cut))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's sketch beside that of its edited text and of the next row.

    ``doc_id, text, sketch, next_text, next_sketch, edited, edited_sketch``; null texts count as
    empty, empty and blank texts have an empty sketch, rows without an id have no next row (null) and
    lose the last quarter, repeated rows come back repeated.  Columns of other names don't come back.
    """
    near = with_next_text(docs, doc_id, text, {"sketch": sketch})
    changed = near.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return changed.withColumn("edited_sketch", sketch(F.col("edited")))
