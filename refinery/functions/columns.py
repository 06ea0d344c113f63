"""Column expressions shared by the layers. All built-in, all code-generated."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T


def normalized(text: Column, *, fold_case: bool = False) -> Column:
    """Strip blanks at both ends (not tabs or newlines) and optionally lower-case."""
    stripped = F.trim(text)
    return F.lower(stripped) if fold_case else stripped


# A failed conversion of text costs an exception, many times the price of a good one. The
# guards below keep the usual junk (``n/a``, ``x9``, ``12 USD``, empty text) away from
# it by looking at the first and last character only. They are comparisons and not patterns,
# which would cost more per good row than the conversion itself. Intended beside that:
# a number with a type letter, such as ``5d`` or ``3f``, counts as junk, though the
# plain cast would read it as 5.0 or 3.0.


def _ascii_number(text: Column) -> Column:
    """No letter, nor anything beyond ASCII digits in the code table, at either end."""
    return (text > "") & (text < ":") & (F.right(text, F.lit(1)) < ":")


def _any_number(text: Column) -> Column:
    """No ASCII letter at either end; decimals accept the digits of other scripts."""

    def no_letter(edge: Column) -> Column:
        return (edge < ":") | (edge >= "{")

    return (text > "") & no_letter(text) & no_letter(F.right(text, F.lit(1)))


def to_decimal(value: Column, type_name: str, *, text: bool) -> Column:
    """Decimal by half-up rounding; NULL for junk or where it does not fit.

    ``text`` tells whether the column holds text.
    """
    number = value.try_cast(type_name)
    return F.when(_any_number(value), number) if text else number


def to_double(value: Column, *, text: bool) -> Column:
    """Double, ``NaN`` and ``Infinity`` included; NULL for junk."""
    number = value.try_cast("double")
    if not text:
        return number
    special = value.rlike(r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$")
    return F.when(_ascii_number(value) | special, number)


def to_whole_number(value: Column, type_name: str = "int", *, text: bool) -> Column:
    """Lenient integer: ``'7'``, ``'7.0'`` and ``'3.9'`` give 7, 7 and 3; junk gives NULL.

    Text goes through a double, which holds every 32-bit integer exactly. For ``bigint`` only
    text with a fraction or an exponent does.
    """
    number = value.try_cast(type_name)
    if not text:
        return number
    # A double is also written in hexadecimal (``0x1p3``), a whole number is not.
    decimal_digits = ~value.contains("x") & ~value.contains("X")
    through_double = value.try_cast("double").try_cast(type_name)
    if type_name == "bigint":
        fractional = value.contains(".") | value.contains("e") | value.contains("E")
        through_double = F.when(fractional, through_double).otherwise(number)
    return F.when(_ascii_number(value) & decimal_digits, through_double)


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def is_absent(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the column is floating point."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(name)
    return missing


def has_rating(rating: Column) -> Column:
    return rating.isNotNull()


def is_valid(price: Column, title: Column) -> Column:
    """Positive price and non-empty title; NULL where price is NULL and title is not empty."""
    return (price > 0) & (F.length(title) > 0)


def tier(value: Column, bounds: Sequence, labels: Sequence[str]) -> Column:
    """Label of the half-open interval that holds ``value``; NULL goes to the last label."""
    chain = F
    for upper, label in zip(bounds, labels):
        chain = chain.when(value < F.lit(upper), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def tier_position(label: Column, labels: Sequence[str]) -> Column:
    """Ordinal of a tier label, so that tiers sort from cheap to dear and not by text."""
    return F.array_position(F.array(*[F.lit(name) for name in labels]), label)


def instant(df: DataFrame, name: str, inside: str = "") -> Column:
    """The column as an instant; ISO text with any offset is parsed, junk becomes NULL.

    ``inside`` is the prefix of a struct that holds a row of ``df``, for example ``"new."``.
    """
    column = F.col(f"{inside}`{name}`")
    if is_text(df.schema[name].dataType):
        return column.try_cast("timestamp")
    return column


def utc_date(df: DataFrame, name: str) -> Column:
    """Calendar date in UTC, whatever the session time zone is."""
    moment = instant(df, name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.to_date(moment)
    return F.to_date(F.to_utc_timestamp(moment, F.current_timezone()))


def utc_stamp(moment: datetime | None = None) -> str:
    """ISO-8601 text of ``moment`` (default: now) in UTC."""
    moment = moment or datetime.now(timezone.utc)
    if moment.tzinfo is None:
        raise ValueError("a batch stamp needs a time zone")
    return moment.astimezone(timezone.utc).isoformat()


def sortable_values(df: DataFrame, settled: Iterable[str] = (), inside: str = "") -> list[Column]:
    """Every column not in ``settled``, in a form that can be compared (maps as JSON text)."""
    done = set(settled)
    values = []
    for field in df.schema.fields:
        if field.name in done:
            continue
        column = F.col(f"{inside}`{field.name}`")
        values.append(column if _orderable(field.dataType) else F.to_json(F.struct(column)))
    return values


def total_order(df: DataFrame, settled: Iterable[str] = ()) -> list[Column]:
    """Descending sort keys over every column not in ``settled``.

    Appended to a ranking they leave no tie between rows that differ at all, so a
    rerun, or a task repeated after a lost executor, picks the same row again. A
    sort looks at them only where the earlier keys are equal.
    """
    return [value.desc() for value in sortable_values(df, settled)]


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))
