"""Column -> Column scalar functions. All JVM-side Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_header(name: str) -> str:
    """Header text → column name: drop byte-order marks, trim blanks."""
    return name.replace("\ufeff", "").strip()


def _is_text(dtype: T.DataType | None) -> bool:
    return dtype is None or isinstance(dtype, T.StringType)


def null_tokens(c: ColumnOrName, tokens: Sequence[str] = ("",), dtype: T.DataType | None = None) -> Column:
    """Read listed texts (after trimming) as NULL; other values pass unchanged (typed input as is)."""
    c = _col(c)
    if not tokens or not _is_text(dtype):
        return c
    return F.when(F.trim(c.cast("string")).isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


# Spellings accepted as numbers — decimal/scientific notation, and the
# special values NaN / Infinity (any case, optional sign).
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
SPECIAL_PATTERN = r"^\s*[+-]?(?i:nan|inf|infinity)\s*$"


def key_normalise(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Numeric id in any spelling → canonical integer text.

    ``1105354``, ``1105354.0`` and ``1.105354E6`` all give ``'1105354'``; text that is not a
    number (``'36_13_81756'``, ``''``) gives NULL. Text goes through ``decimal(38,6)`` (a
    direct ``try_cast('1105354.0' as bigint)`` is NULL) after a cheap pattern test that keeps
    non-numeric ids away from the parser, whose failures cost an exception each. Typed
    numeric input (``dtype``) skips the text path.
    """
    c = _col(c)
    if isinstance(dtype, T.IntegralType):
        return c.cast("string")
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return c.try_cast("bigint").cast("string")
    c = c.cast("string")
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("decimal(38,6)").try_cast("bigint")).cast("string")


def lookup_key(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Join key for ids that may be numeric or alphanumeric: normalised when numeric, else as given."""
    c = _col(c)
    if not _is_text(dtype):
        return key_normalise(c, dtype)
    return F.coalesce(key_normalise(c, dtype), c.cast("string"))


def lenient_number(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Text → double; unparsable text (``'NULL'``, ``'n/a'``) → NULL instead of an error.

    Accepts decimal and scientific notation and NaN / Infinity. Typed numeric input is cast.
    """
    c = _col(c)
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    t = c.cast("string")
    return F.when(t.rlike(NUMBER_PATTERN) | t.rlike(SPECIAL_PATTERN), t.try_cast("double"))


def lenient_ts(c: ColumnOrName, fmt: str | None = None, dtype: T.DataType | None = None) -> Column:
    """Text → timestamp; unparsable text → NULL. ``fmt`` is a Spark datetime pattern.

    Typed date/timestamp input is cast (a zone-less value is read as session-time wall clock).
    """
    c = _col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    c = c.cast("string")
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def wide_to_label(
    columns: Iterable[tuple[ColumnOrName, str]],
    flag: ColumnOrName | None = None,
    multi_label: str = "Hybrid",
    none_label: str = "Unknown",
    dtypes: dict[str, T.DataType] | None = None,
) -> Column:
    """Several numeric indicator columns → one label.

    A column counts when its lenient numeric value is ``> 0`` (missing/garbage → 0; NaN
    counts, as ``NaN > 0`` holds in Spark). Flag ``'Y'`` (any case) or more than one
    counting column → ``multi_label``; exactly one → its label; none → ``none_label``.
    One CASE expression of plain comparisons (whole-stage codegen, no lambda functions).
    ``dtypes`` (column → type) lets typed numeric columns skip text parsing.
    """
    dtypes = dtypes or {}
    positive = [(F.coalesce(lenient_number(c, dtypes.get(c) if isinstance(c, str) else None), F.lit(0.0)) > 0, label)
                for c, label in columns]
    if not positive:
        first = F.lit(None).cast("string")
        count = F.lit(0)
    else:
        first = F.coalesce(*[F.when(p, F.lit(label)) for p, label in positive])
        count = sum((p.cast("int") for p, _ in positive[1:]), positive[0][0].cast("int"))
    multi = count > 1
    if flag is not None:
        multi = (F.upper(_col(flag)) == F.lit("Y")) | multi
    return F.when(multi, F.lit(multi_label)).otherwise(F.coalesce(first, F.lit(none_label)))
