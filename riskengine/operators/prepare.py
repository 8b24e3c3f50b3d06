"""Projections and casts: preprocessing, label parsing, vector assembly and flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..constants import FEATURE_COLUMNS, LABEL_COLUMN
from ..functions.columns import label_as_double, label_int_of, lenient_cast


def preprocess(df: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """``amount`` -> double, ``timestamp`` -> timestamp (zone-free ``timestamp_ntz``).

    Text columns are cast with ``try_cast`` (malformed text becomes null rather
    than failing under ANSI); typed columns are cast only when their type
    differs.  Pass ``{"timestamp": "timestamp"}`` for session-zone timestamps.
    """
    casts = casts if casts is not None else {"amount": "double", "timestamp": "timestamp_ntz"}
    types = {f.name: f.dataType for f in df.schema.fields}
    todo = {}
    for c, t in casts.items():
        if c not in types:
            continue
        if isinstance(types[c], StringType):
            todo[c] = lenient_cast(c, t)
        elif types[c].simpleString() != t:
            todo[c] = F.col(c).cast(t)
    return df.withColumns(todo) if todo else df


def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """P5: cast every column named in ``casts`` in one projection (null on bad text)."""
    return df.withColumns({c: lenient_cast(c, t) for c, t in casts.items()})


def label_to_int(df: DataFrame, label_col: str = LABEL_COLUMN) -> DataFrame:
    """Boolean / numeric / text label -> int (true -> 1; text read as a boolean)."""
    return df.withColumn(label_col, label_int_of(df, label_col))


def label_to_double(df: DataFrame, label_col: str = LABEL_COLUMN) -> DataFrame:
    """``"true"`` -> 1.0, ``"false"`` -> 0.0, anything else -> null."""
    return df.withColumn(label_col, label_as_double(label_col))


def label_slice(df: DataFrame, value: int = 1, label_col: str = LABEL_COLUMN) -> DataFrame:
    """The rows of one class (``label == value``, the label read as an int).

    A plain filter: on a label derived from stored columns Catalyst pushes it into
    the scan."""
    return df.where(label_int_of(df, label_col) == F.lit(value))


def assemble_features(df: DataFrame, feature_columns: Sequence[str] = FEATURE_COLUMNS,
                      output_column: str = "features",
                      handle_invalid: str = "error") -> DataFrame:
    """Numeric columns -> one ML vector column (``VectorAssembler``)."""
    assembler = VectorAssembler(inputCols=list(feature_columns), outputCol=output_column,
                                handleInvalid=handle_invalid)
    return assembler.transform(df)


def flatten_probability(df: DataFrame, probability_col: str = "probability",
                        prefix: str = "prob_") -> DataFrame:
    """``probability`` vector -> ``prob_0``, ``prob_1`` doubles, on the executors."""
    arr = vector_to_array(F.col(probability_col))
    return df.withColumns({f"{prefix}0": arr[0], f"{prefix}1": arr[1]})
