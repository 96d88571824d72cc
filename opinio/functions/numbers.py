"""Number formatting and the sheet-derived scores."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(count: Column, total: Column, decimals: int = 4) -> Column:
    """``count / total`` as a percent string with ``decimals`` places and a '%' sign.

    Computed in integers (half-up rounding of the exact ratio), so every engine writes the
    same text; printf-style formatting of a double differs between Java and C on ties.
    """
    scale = 10 ** decimals
    num = count.cast("decimal(38,0)") * (200 * scale) + total.cast("decimal(38,0)")
    units = F.call_function("div", num, total.cast("decimal(38,0)") * 2)
    return F.concat(F.call_function("div", units, F.lit(scale)).cast("string"),
                    F.lit("."), F.lpad((units % scale).cast("string"), decimals, "0"), F.lit("%"))


def sheet_number(text: Column) -> Column:
    """Numeric part of a percent cell: ``'1.2345%'`` → 1.2345 (NULL when not numeric)."""
    return F.replace(text, F.lit("%"), F.lit("")).try_cast("decimal(20,10)")


def heat_score(freq_text: Column, count: Column) -> Column:
    """The percent number if the cell has a '%', else the count; stored as DECIMAL(5,2)."""
    raw = F.when(F.instr(freq_text, "%") > 0, sheet_number(freq_text)).otherwise(count.cast("decimal(20,10)"))
    return raw.try_cast("decimal(5,2)")


def keyword_weight(freq_text: Column, count: Column) -> Column:
    """Percent / 100 if the cell has a '%', else count / 1000; stored as DECIMAL(5,2)."""
    # Multiply by exact decimal constants (no division), so every engine rounds the same value.
    raw = F.when(F.instr(freq_text, "%") > 0, sheet_number(freq_text) * F.lit(Decimal("0.01"))) \
        .otherwise(count.cast("decimal(20,10)") * F.lit(Decimal("0.001")))
    return raw.try_cast("decimal(5,2)")
