"""Column expressions shared by the layers.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

# --- fixed values: these must equal the reference's contract definitions ---
# e-mail pattern of the customer contract, anchored, as written there
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
# allowed customer regions
REGION_VALUES = ("NA", "EMEA", "APAC", "LATAM")
# default tolerance of the e-mail rule
EMAIL_MOSTLY = 0.99
# --- end of fixed values ---


def cast_column(name: str, data_type: DataType, mode: str = "permissive") -> Column:
    """Cast one column to ``data_type``.

    ``permissive`` gives null for a value that does not parse (``try_cast``),
    which is what a non-ANSI ``cast`` did; ``strict`` fails the query on the
    first bad value, as an ANSI ``cast`` does, whatever the session's ANSI
    flag (which is never touched).
    """
    col = F.col(name)
    if mode == "permissive":
        return col.try_cast(data_type).alias(name)
    if mode == "strict":
        # independent of the session's ANSI flag (a non-ANSI cast gives null)
        parsed = col.try_cast(data_type)
        bad = F.concat(F.lit(f"cannot cast {name} value '"), col.cast("string"),
                       F.lit(f"' to {data_type.simpleString()}"))
        return F.when(col.isNotNull() & parsed.isNull(), F.raise_error(bad)).otherwise(parsed).alias(name)
    raise ValueError(f"unknown cast mode {mode!r}; use 'permissive' or 'strict'")


def round2(col: Column) -> Column:
    """Money rounding: two decimals, half-up (``round(x, 2)``)."""
    return F.round(col, 2)


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """``concat_ws(' ', first, last)``: nulls are skipped, both null gives ''."""
    return F.concat_ws(" ", F.col(first), F.col(last))


def year_month_of(date_key: str = "date_key") -> Column:
    """First six characters of a ``yyyyMMdd`` key (1-based ``substring``)."""
    return F.substring(F.col(date_key).cast("string"), 1, 6)


def date_key_of(ts: Column) -> Column:
    """``yyyyMMdd`` string key of a timestamp or date."""
    return F.date_format(ts, "yyyyMMdd")


def money_sum(col: Column, data_type: DataType | None = None) -> Column:
    """Order-independent sum of two-decimal amounts.

    Decimal amounts (``data_type``) are summed as they are: exact, decimal out. Double amounts are
    turned into whole cents (a long), so partial sums computed
    in any order (map-side combine, AQE re-plans) are exact and give the same
    bits; the total is returned in currency units as a double. Long addition keeps the aggregate buffer fixed-width
    (a decimal(28,2) buffer is object-backed and about 40 % slower here).
    A group that holds NaN, an infinity or an amount beyond 9e13, or whose cents pass a long, gets the plain
    double sum: NaN stays NaN and infinities stay infinite, and no row fails the run.
    """
    if isinstance(data_type, DecimalType):
        return F.sum(col)
    wild = F.isnan(col) | (F.abs(col) > F.lit(9e13))
    cents = F.when(~wild, F.rint(col * 100).cast("long"))
    exact = F.when(F.count_if(wild) == 0, (F.try_sum(cents) / 100).cast("double"))
    # null when no amount is known, as a sum is
    return F.coalesce(exact, F.sum(col.cast("double")))


def unanchored(pattern: str) -> str:
    """Drop ``^``/``$`` anchors so a pattern finds values inside free text."""
    if pattern.startswith("^"):
        pattern = pattern[1:]
    if pattern.endswith("$") and not pattern.endswith("\\$"):
        pattern = pattern[:-1]
    return pattern
