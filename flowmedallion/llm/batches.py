"""Arrow batches in and out of Spark, shared by the operators that work inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 4 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FEW_ROWS = "1000"


def small_batches(df: DataFrame) -> DataFrame:
    """The frame, in a session that sends texts to Python in batches of FEW_ROWS rows at most.

    Spark's default of 10,000 rows takes much memory where texts are long.  A setting that
    differs from the default is the user's and stays.
    """
    session = df.sparkSession
    if session.conf.get(BATCH_ROWS) == "10000":
        session.conf.set(BATCH_ROWS, FEW_ROWS)
    return df


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns of these names, whatever their case."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in taken])


def numbered(df: DataFrame) -> DataFrame:
    """The frame with its columns called c0, c1, ..., so that none is called like an added one."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> str:
    """The name in ``numbered(df)`` of a column of df."""
    return f"c{[c.lower() for c in df.columns].index(name.lower())}"


def restored(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``numbered(like)`` under their own names; added ones go."""
    return df.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(like.columns)])


def utf8(column) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes, without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch that hold about SLICE_BYTES of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def append_columns(
    df: DataFrame, text: str, added: str, make: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]]
) -> DataFrame:
    """Add columns that are worked out from one text column, row by row.

    ``added`` is their DDL.  ``make`` runs once in each task and returns the function
    from texts (UTF-8, None for null) to one Arrow array for each added column.  Columns
    of the frame that are called like an added one are replaced.
    """
    fields = StructType.fromDDL(added).fields
    names = [field.name for field in fields]
    kept = without(df, *names)
    columns = kept.columns
    if len(set(columns)) < len(columns) or text not in columns:
        raise ValueError(f"the frame needs one column {text} and no two columns of one name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in slices(batch, text):
                made = work(utf8(piece.column(text)))
                yield pa.RecordBatch.from_arrays([*piece.columns, *made], names=[*columns, *names])
            pa.default_memory_pool().release_unused()  # workers live on; others need the memory

    return small_batches(kept).mapInArrow(run, StructType([*kept.schema.fields, *fields]))
