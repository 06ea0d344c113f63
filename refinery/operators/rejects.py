"""Required fields and type checks: which raw rows silver takes, and why not the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from refinery.functions import is_absent, is_text, to_decimal, to_whole_number
from refinery.roles import DEFAULT_ROLES, Roles

REASON = "_reject_reason"
CORRUPT = "_corrupt_record"
# Converted once, for the check and for the silver row.
KEY, PRICE = "__key", "__price"


def require_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the rows in which none of the named columns is NULL (or NaN).

    One condition per column: each can be pushed into the scan, or to its side of a join.
    """
    for name in names:
        df = df.where(~is_absent(df, name))
    return df


def typed_key(df: DataFrame, roles: Roles) -> Column:
    text = is_text(df.schema[roles.key].dataType)
    return to_whole_number(F.col(roles.key), roles.key_type, text=text)


def typed_price(df: DataFrame, roles: Roles) -> Column:
    text = is_text(df.schema[roles.price].dataType)
    return to_decimal(F.col(roles.price), roles.price_type, text=text)


def _converted(bronze: DataFrame, roles: Roles) -> DataFrame:
    return bronze.withColumns({KEY: typed_key(bronze, roles), PRICE: typed_price(bronze, roles)})


def usable(bronze: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The rows that :func:`checked` finds no fault with, with their converted key and price.

    Plain conditions instead of reasons: less code to generate, and the scan can apply some.
    """
    complete = require_fields(bronze, roles.required)
    return _converted(complete, roles).where(F.col(KEY).isNotNull() & F.col(PRICE).isNotNull())


def checked(bronze: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Add the converted key and price, and the reason why silver refuses a row, or NULL.

    The first that applies: ``corrupt`` (unreadable file or line, without a key),
    ``required:<column>``, ``type:<column>`` (text that is no number, or one outside the column's
    range). A readable record of which another field has the wrong type is taken without it; bronze
    keeps its text.
    """
    checks = []
    if CORRUPT in bronze.columns:
        unreadable = F.col(CORRUPT).isNotNull() & is_absent(bronze, roles.key)
        checks.append(F.when(unreadable, F.lit("corrupt")))
    for name in roles.required:
        checks.append(F.when(is_absent(bronze, name), F.lit(f"required:{name}")))
    for name, typed in ((roles.key, KEY), (roles.price, PRICE)):
        checks.append(F.when(F.col(typed).isNull(), F.lit(f"type:{name}")))
    return _converted(bronze, roles).withColumn(REASON, F.coalesce(*checks))


def label_rejects(bronze: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The rows as they are, with the reason of :func:`checked`."""
    return checked(bronze, roles).drop(KEY, PRICE)


def accepted(labelled: DataFrame) -> DataFrame:
    """Rows without a reject reason."""
    return labelled.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(labelled: DataFrame) -> DataFrame:
    """Rows with a reject reason, raw text untouched."""
    return labelled.filter(F.col(REASON).isNotNull()).drop(KEY, PRICE)
