"""Bronze to Silver to Gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flowmedallion.operators import cleaning as C
from flowmedallion.operators import features as X
from flowmedallion.operators.schema import cast_types
from flowmedallion.sources.session import materialize


def valid_rows(df: DataFrame, critical_columns: Sequence[str] | None = None) -> DataFrame:
    """The rows that pass every rule that looks at one row."""
    if critical_columns is None:
        critical_columns = C.default_critical_columns(df)
    return df.filter(C.not_null(critical_columns) & C.valid_values(df))


def polished(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Texts filled, labels in their canonical spelling, types cast."""
    return cast_types(C.standardize_labels(C.handle_nulls(df), label_col))


def cleaned_rows(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Silver with the copies still in it: every step that looks at one row."""
    return C.add_derived_columns(polished(valid_rows(df), label_col), label_col)


def constants_of(bronze: DataFrame, columns: Sequence[str], label_col: str = "label") -> dict[str, str | None]:
    """The one value, as text, of columns that cleaning found constant."""
    row = polished(valid_rows(bronze), label_col).select(*[F.col(f"`{c}`").cast("string") for c in columns]).first()
    return dict(zip(columns, row)) if row else {}


def clean_bronze_to_silver(
    df: DataFrame,
    critical_columns: Sequence[str] | None = None,
    label_col: str = "label",
    drop_constants: bool = True,
    subset: list[str] | None = None,
    together: Sequence[str] = (),
    stored: bool = False,
) -> DataFrame:
    """The seven cleaning steps with one shuffle.

    Row rules look at one row only, so they run before de-duplication and reach
    the scan.  Whether a column is constant does not depend on copies, so constant
    columns are found on the frame before the de-duplication shuffle.
    ``drop_constants=False`` keeps the whole thing lazy.  ``together`` as in ``remove_duplicates``.
    A frame that is ``stored`` is read twice for the de-duplication, which then shuffles whole only rows that may
    have a copy (``remove_stored_duplicates``, which is eager).
    """
    valid = valid_rows(df, critical_columns)

    def polish(rows: DataFrame) -> DataFrame:
        return polished(rows, label_col)

    if stored and subset is None:
        distinct = C.remove_stored_duplicates(valid, together)
    else:
        distinct = C.remove_duplicates(valid, subset, together=together)
    if subset is not None and drop_constants:
        # any row of a group may stay, so the choice is stored before it is measured
        distinct = materialize(distinct, "distinct")
    silver = polish(distinct)
    if drop_constants:
        if subset is None:
            silver = C.drop_constant_columns(silver, measured_on=polish(valid))
        else:  # which rows stay decides, so the result itself is measured, once
            silver = C.drop_constant_columns(silver, probe_rows=0)
    return C.add_derived_columns(silver, label_col)


def transform_silver_to_gold(df: DataFrame, label_col: str = "label", accept_names: bool = False) -> DataFrame:
    """All feature groups; one projection, no row lost."""
    df = X.add_packet_aggregate_features(df)
    df = X.add_flag_aggregate_features(df)
    df = X.add_iat_features(df)
    df = X.add_protocol_name(df, accept_names)
    df = X.add_binary_target(df, label_col)
    return X.add_flow_efficiency_features(df)
