"""Column expressions shared by the operators.  All are JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType

from ..constants import AMOUNT_TYPE, LARGE_AMOUNT


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_cast(c: str | Column, data_type: str | DataType) -> Column:
    """Cast that yields null on malformed input instead of failing (ANSI-safe)."""
    return as_col(c).try_cast(data_type)


def epoch_seconds(ts: str | Column) -> Column:
    """Whole epoch seconds of a timestamp (zone-free for ``timestamp_ntz``)."""
    return F.unix_timestamp(as_col(ts))


def label_as_double(c: str | Column) -> Column:
    """``"true"`` -> 1.0, ``"false"`` -> 0.0, anything else (``"True"``, 1, null) -> null.

    Works on boolean and text columns alike because the comparison is made on
    the text form; an integer column gives null rather than an ANSI error.
    """
    text = as_col(c).cast("string")
    return (F.when(text == F.lit("true"), F.lit(1.0))
            .when(text == F.lit("false"), F.lit(0.0))
            .otherwise(F.lit(None).cast("double")))


def label_as_int(c: str | Column, text: bool = False) -> Column:
    """Label -> int: boolean true -> 1, numbers truncated; unparsable -> null.

    With ``text=True`` (a string column) the label is read as a boolean first, so
    ``"true"`` / ``"false"`` (any case) and ``"1"`` / ``"0"`` give 1 / 0.
    """
    col = as_col(c)
    return col.try_cast("boolean").cast("int") if text else col.try_cast("int")


def label_int_of(df, label_col: str) -> Column:
    """:func:`label_as_int` chosen by the column's type in ``df``."""
    return label_as_int(label_col, text=isinstance(df.schema[label_col].dataType, StringType))


def exact_amount(c: str | Column, scale: int | None = None) -> Column:
    """Amount as an exact decimal, so that sums don't depend on their order.

    ``scale=None`` keeps ten decimals, enough not to change an amount that is held as a
    double to six places; a number of decimals rounds to them.  An amount that the type
    can't hold (see :func:`odd_amount`) gives null.
    """
    digits, places = AMOUNT_TYPE
    return as_col(c).try_cast(DecimalType(digits, places if scale is None else scale))


def large_amount(c: str | Column) -> Column:
    """A finite amount that :func:`exact_amount` can't hold, as a decimal without places, up to ``LARGE_AMOUNT``."""
    x = as_col(c).cast("double")
    digits, places = AMOUNT_TYPE
    fits = (F.abs(x) >= F.lit(10.0 ** (digits - places))) & (F.abs(x) < F.lit(LARGE_AMOUNT))
    return F.when(fits, x.cast(DecimalType(31, 0)))


def odd_amount(c: str | Column, kind: str) -> Column:
    """Whether an amount is outside the exact types: ``nan``, or ``high`` / ``low`` for
    infinities and amounts of ``LARGE_AMOUNT`` and more."""
    x = as_col(c).cast("double")
    if kind == "nan":
        return F.isnan(x)
    return ~F.isnan(x) & ((x >= F.lit(LARGE_AMOUNT)) if kind == "high" else (x <= F.lit(-LARGE_AMOUNT)))


def null_safe_keys(left, right, keys) -> Column:
    """``left.k <=> right.k`` for every key: null keys join like values (still an equi-join)."""
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[k])
        cond = term if cond is None else cond & term
    return cond
