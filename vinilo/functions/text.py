"""Prices and durations as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number at the start of the text, as the web shop reads prices.
LEADING_NUMBER = r"^\s*([+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?))"


def parse_price(text: Column) -> Column:
    """Leading number of the text as a double; 0 where there is none."""
    number = F.regexp_extract(text.cast("string"), LEADING_NUMBER, 1)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def format_price(price: Column) -> Column:
    """``$0.00`` text of a price given as a number or as text.

    The formatter rounds the exact binary value and sends ties to the even
    digit, while prices send them away from zero. A tie is an odd number of
    eighths, so it is nudged outwards first.
    """
    number = parse_price(price)
    # A negative zero is shown as zero.
    x = F.when(number == 0, F.lit(0.0)).otherwise(number)
    eighths = x * 8
    tie = (eighths == F.floor(eighths)) & (F.abs(eighths) % 2 == 1)
    shown = F.when(tie, x + F.signum(x) * F.lit(0.001)).otherwise(x)
    digits = F.call_function("format_number", shown, F.lit("0.00"))
    infinite = F.abs(x) == F.lit(float("inf"))
    return F.concat(F.lit("$"), F.when(infinite, x.cast("string")).otherwise(digits))


def format_duration(milliseconds: Column) -> Column:
    """``M:SS`` text; missing, zero and negative lengths give ``0:00``."""
    ms = F.floor(milliseconds).cast("bigint")
    minutes = F.floor(ms / 60000).cast("string")
    seconds = F.floor((ms % 60000) / 1000).cast("string")
    return F.when(
        milliseconds > 0, F.concat(minutes, F.lit(":"), F.lpad(seconds, 2, "0"))
    ).otherwise(F.lit("0:00"))
