"""Text -> typed values.

Every parser gives the same answer with ``spark.sql.ansi.enabled`` on or
off: bad text becomes null instead of failing the job (``try_cast``,
``try_to_date``, ``try_to_timestamp``), and a double is turned into a long
only when it is finite and in range.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics import fixed

def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _double_to_long(d: Column) -> Column:
    """Truncate a double toward zero; NaN, infinities and out-of-range -> null.

    ``try_cast`` evaluates the input once and behaves the same whatever the
    session's ANSI setting.
    """
    return d.try_cast("long")


def parse_count(c: str | Column, strip: str | None = fixed.COUNT_STRIP_CHARS) -> Column:
    """``"10,000,000+"`` -> 10000000, ``"64.0"`` -> 64, junk -> null.

    ``strip`` is a set of characters removed first (None: nothing removed).
    Whole numbers are read as such, so those above 2**53 keep every digit.  Text with a dot
    is no whole number; trying it as one costs an exception a row.
    """
    cleaned = F.translate(_col(c), strip, "") if strip else _col(c)
    whole = F.when(~cleaned.contains("."), cleaned.try_cast("long"))
    return F.coalesce(whole, _double_to_long(cleaned.try_cast("double")))


def parse_price(c: str | Column, strip: str = fixed.PRICE_STRIP_CHARS) -> Column:
    """``"$4.99"`` -> 4.99."""
    return F.translate(_col(c), strip, "").try_cast("double")


def parse_double(c: str | Column) -> Column:
    """D3: plain numeric text -> double, junk -> null."""
    return _col(c).try_cast("double")


def parse_size_kb(
    c: str | Column,
    units: dict[str, float] | None = None,
    keep: str = fixed.SIZE_KEEP_PATTERN,
) -> Column:
    """Size text -> kilobytes by case-sensitive unit letter; otherwise null.

    Units are tested in the order given (``M`` before ``k``); the number is
    what is left after removing everything but digits and dots.
    """
    units = units if units is not None else fixed.SIZE_UNITS
    text = _col(c)
    number = F.regexp_replace(text, keep, "").try_cast("double")
    expr = None
    for letter, factor in units.items():
        value = number * F.lit(factor) if factor != 1.0 else number
        cond = text.contains(letter)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr if expr is not None else F.lit(None).cast("double")


def parse_date(c: str | Column, fmt: str = fixed.DATE_FORMAT) -> Column:
    """Trimmed text -> date; unparsable -> null."""
    return F.try_to_date(F.trim(_col(c)), fmt)


def parse_timestamp(c: str | Column, fmt: str = fixed.TIMESTAMP_FORMAT) -> Column:
    """Text -> timestamp; unparsable -> null."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def parse_version(c: str | Column, pattern: str = fixed.VERSION_PATTERN) -> Column:
    """First version number, ``"4.0.3 and up"`` -> 4.0; no number -> null."""
    return F.regexp_extract(_col(c), pattern, 1).try_cast("double")


def parse_flag(c: str | Column) -> Column:
    """Trimmed, case-folded ``true``/``false`` -> boolean, else null."""
    norm = F.lower(F.trim(_col(c)))
    return F.when(norm == fixed.FLAG_TRUE, F.lit(True)).when(
        norm == fixed.FLAG_FALSE, F.lit(False)
    )


def free_flag(price: str | Column) -> Column:
    """Price exactly 0 -> true; anything else, null included -> false."""
    return F.when(_col(price) == 0, F.lit(True)).otherwise(F.lit(False))


def flag_to_number(c: str | Column) -> Column:
    """True -> 1.0, false -> 0.0, null -> null."""
    return _col(c).cast("double")


def replace_sentinel(
    c: str | Column,
    sentinel: str = fixed.CURRENCY_SENTINEL,
    default: str = fixed.CURRENCY_DEFAULT,
) -> Column:
    """Null or sentinel text -> default."""
    return F.coalesce(F.nullif(_col(c), F.lit(sentinel)), F.lit(default))


def coerce_long(c: str | Column, dtype: T.DataType, default: int | None = 0) -> Column:
    """P10: a value of any numeric/text type -> long, with a fallback.

    Integral types are widened, fractional ones truncated toward zero, text
    is parsed as a number; whatever cannot be read becomes ``default``.
    """
    col = _col(c)
    if isinstance(dtype, T.IntegralType):
        out = col.cast("long")
    elif isinstance(dtype, (T.FractionalType, T.DecimalType)):
        out = _double_to_long(col.cast("double"))
    else:
        text = col.cast("string")
        out = F.coalesce(text.try_cast("long"), _double_to_long(text.try_cast("double")))
    return out if default is None else F.coalesce(out, F.lit(default).cast("long"))


def coerce_double(c: str | Column, dtype: T.DataType, default: float | None = 0.0) -> Column:
    """P10: a value of any numeric/text type -> double, with a fallback."""
    col = _col(c)
    if isinstance(dtype, (T.NumericType,)):
        out = col.cast("double")
    else:
        out = col.cast("string").try_cast("double")
    return out if default is None else F.coalesce(out, F.lit(float(default)))
