"""Repeatable draws: the same row gets the same draw under any partitioning.

md5 is used because it mixes well, is the same in every SQL engine, and so can
be checked outside Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

MISSING = "~"
UNIT = 16**8
DIGEST = ["_digest_a", "_digest_b"]
PLACE, PLACES = "_place", 1 << 16
_FLAT = (T.NumericType, T.BooleanType, T.BinaryType, T.DatetimeType)


def row_digest(columns: Iterable[Column | str], seed: int | str) -> Column:
    """md5 (hex text) of the seed and the given columns; null counts as a value."""
    parts = [F.lit(str(seed))]
    for column in columns:
        column = F.col(column) if isinstance(column, str) else column
        parts.append(F.coalesce(column.cast("string"), F.lit(MISSING)))
    return F.md5(F.concat_ws("|", *parts))


def digest_unit(digest: Column) -> Column:
    """The first 32 bits of a digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(UNIT))


def digest_below(digest: Column, share: float) -> Column:
    """True for about ``share`` of all digests; compares text, so no conversion per row."""
    if share >= 1.0:
        return F.lit(True)
    return F.substring(digest, 1, 8) < F.lit(format(int(share * UNIT), "08x"))


def is_flat(kind: T.DataType) -> bool:
    """Whether equal values of the type have one hash: plain numbers, texts without a collation, and times."""
    return isinstance(kind, _FLAT) or kind == T.StringType()


def _hashed(columns: Sequence[str]) -> list[Column]:
    values = []
    for c in columns:  # Spark's hashes pass over nulls, so (null, 1) and (1, null) need the flags
        value = F.col(f"`{c.replace('`', '``')}`")
        values += [value.isNull(), value]
    return values


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits that equal rows of flat columns share; rows with a hash of their own have no equal."""
    return F.xxhash64(*_hashed(columns))


def row_place(columns: Sequence[str]) -> Column:
    """A small number that equal rows of flat columns share, to bring them together."""
    return F.pmod(row_hash(columns), F.lit(PLACES)).cast("int")


def digest_columns(columns: Sequence[str]) -> dict[str, Column]:
    """The two 64-bit halves of the digest of these columns; it stands for their values (null is one)."""
    return {name: F.xxhash64(F.lit(seed), *_hashed(columns)) for seed, name in enumerate(DIGEST)}


def row_keys(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Columns to group equal rows by where only counts are wanted: 16 bytes in place of the values.

    Plain numbers, texts and times go into the digest; nested values and texts with a collation, whose
    equality the digest does not follow, are keys themselves.
    """
    columns = df.columns if columns is None else list(columns)
    flat = [c for c in columns if is_flat(df.schema[c].dataType)]
    rest = [F.col(f"`{c}`").alias(f"_key_{i}") for i, c in enumerate(columns) if c not in flat]
    return [*[value.alias(name) for name, value in digest_columns(flat).items()], *rest]
