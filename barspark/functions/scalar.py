"""Scalar column helpers shared by reports and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half(c: Column | str, digits: int = 4) -> Column:
    """Round to ``digits`` decimals, ties away from zero like SQL ``ROUND``.

    ``trunc(x * 10^d + sign(x) / 2) / 10^d``, in double arithmetic throughout
    (``v - v % 1`` truncates without a 64-bit integer, so large values stay
    what they are), and written the same way in the SQL twins, so both engines
    round identical doubles identically."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    scale = float(10 ** digits)
    v = x * scale + F.signum(x) * 0.5
    return (v - v % 1.0) / scale + 0.0


def currency_sign(symbol: Column) -> Column:
    """Rupee sign when the symbol contains 'NS' anywhere (a substring test, as in the
    dashboard), otherwise dollar."""
    return F.when(symbol.contains("NS"), F.lit("₹")).otherwise(F.lit("$"))


def money(symbol: Column, value: Column) -> Column:
    """``<sign><value with 2 decimals>``."""
    return F.concat(currency_sign(symbol), F.format_string("%.2f", value))


def signed(value: Column) -> Column:
    """``+1.23`` / ``-1.23``."""
    return F.format_string("%+.2f", value)


def shares(volume: Column) -> Column:
    """``1,234,567 shares``."""
    return F.concat(F.format_number(volume.cast("double"), 0), F.lit(" shares"))


# The RSI report's alert texts and thresholds (inclusive).
RSI_OVERBOUGHT, RSI_OVERSOLD = 70, 30
RSI_TEXTS = ("OVERBOUGHT (SELL ALERT)", "OVERSOLD (BUY OPPORTUNITY)", "NEUTRAL")


def rsi_signal(rsi: Column) -> Column:
    """Alert text of the RSI report."""
    return (F.when(rsi >= RSI_OVERBOUGHT, F.lit(RSI_TEXTS[0]))
            .when(rsi <= RSI_OVERSOLD, F.lit(RSI_TEXTS[1]))
            .otherwise(F.lit(RSI_TEXTS[2])))
