"""Text, JSON and display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display patterns.
DATE_PATTERN = "yyyy-MM-dd"
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fmt_time(ts, pattern: str = TIME_PATTERN) -> Column:
    return F.date_format(_col(ts), pattern)


def days_between(start, end) -> Column:
    """Calendar days crossed from start to end."""
    return F.datediff(_col(end), _col(start))


def or_default(c, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def null_if(c, value) -> Column:
    return F.nullif(_col(c), F.lit(value))


def to_uint_or_zero(c) -> Column:
    """Digits to a 64-bit unsigned number; anything else is 0."""
    c = _col(c).cast("string")
    number = F.when(c.rlike("^[0-9]+$"), c.try_cast("decimal(38,0)"))
    return F.when(number < F.lit("18446744073709551616").cast("decimal(20,0)"), number.cast("decimal(20,0)")).otherwise(
        F.lit(0).cast("decimal(20,0)")
    )


def to_float_or_zero(c) -> Column:
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def json_field(v, path: str, kind: str = "string") -> Column:
    """A path of a VARIANT column, NULL where it is missing or of another type."""
    return F.try_variant_get(_col(v), f"$.{path}", kind)


def trunc_div(a, b) -> Column:
    """Whole quotient of non-negative numbers as decimal(38,0); NULL where b is 0.

    The remainder is taken off first, so the decimal division is exact and cannot round up.
    """
    a, b = _col(a).cast("decimal(38,0)"), F.nullif(_col(b).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return ((a - a % b) / b).cast("decimal(38,0)")


def tx_type_name(c) -> Column:
    return F.regexp_replace(_col(c), "Tx$", "")


def _fixed(c: Column, places: int) -> Column:
    """Text with a fixed number of decimals: nearest to the exact double value, exact ties away from zero."""
    nearest = F.call_function("format_number", c, F.lit("0" if places == 0 else "0." + "0" * places))
    halves = c * F.lit(float(2 ** (places + 1)))
    tie = (halves == F.floor(halves)) & (F.abs(halves % 2) == 1)
    return F.when(tie, F.round(c, places).cast(f"decimal(38,{places})").cast("string")).otherwise(nearest)


def readable(c) -> Column:
    """1234567 -> 1.23M, with K, M and B; smaller numbers without decimals."""
    c = _col(c).cast("double")
    return (
        F.when(c >= 1e9, F.concat(_fixed(c / 1e9, 2), F.lit("B")))
        .when(c >= 1e6, F.concat(_fixed(c / 1e6, 2), F.lit("M")))
        .when(c >= 1e3, F.concat(_fixed(c / 1e3, 2), F.lit("K")))
        .otherwise(_fixed(c, 0))
    )


def readable_quantity(c) -> Column:
    """12345678 -> '12.35 million', the long form of large quantities."""
    c = _col(c).cast("double")
    out = F.when(F.abs(c) < 1e3, _fixed(c, 2))
    for size, name in ((1e3, "thousand"), (1e6, "million"), (1e9, "billion"), (1e12, "trillion"), (1e15, "quadrillion")):
        out = out.when(F.abs(c) < size * 1e3, F.concat(_fixed(c / size, 2), F.lit(f" {name}")))
    return out.otherwise(c.cast("string"))


def nano_amount(c) -> Column:
    """Nano-units as whole coins: 2 decimals with K/M from a thousand up, 4 decimals below one coin."""
    coins = _col(c).cast("double") / 1e9
    return (
        F.when(coins >= 1e6, F.concat(_fixed(coins / 1e6, 2), F.lit("M")))
        .when(coins >= 1e3, F.concat(_fixed(coins / 1e3, 2), F.lit("K")))
        .when(coins >= 1, _fixed(coins, 2))
        .otherwise(_fixed(coins, 4))
    )


def gigabytes(c) -> Column:
    return F.concat(_fixed(_col(c).cast("double") / 2**30, 3), F.lit(" GB"))


def bytes_text(c) -> Column:
    c = _col(c).cast("double")
    return (
        F.when(c < 2**10, F.concat(_fixed(c, 0), F.lit(" B")))
        .when(c < 2**20, F.concat(_fixed(c / 2**10, 2), F.lit(" KB")))
        .when(c < 2**30, F.concat(_fixed(c / 2**20, 2), F.lit(" MB")))
        .otherwise(F.concat(_fixed(c / 2**30, 2), F.lit(" GB")))
    )


def age_text(ts, as_of) -> Column:
    """'12s ago', '5m ago', '3h ago', and the time itself from one day on."""
    seconds = F.unix_timestamp(_col(as_of)) - F.unix_timestamp(_col(ts))
    whole = lambda n: F.floor(seconds / n).cast("string")
    return (
        F.when(seconds < 60, F.concat(seconds.cast("string"), F.lit("s ago")))
        .when(seconds < 3600, F.concat(whole(60), F.lit("m ago")))
        .when(seconds < 86400, F.concat(whole(3600), F.lit("h ago")))
        .otherwise(fmt_time(ts))
    )


def humanize_field(c) -> Column:
    """camelCase field name to words: stakeAmount -> Stake Amount."""
    spaced = F.trim(F.regexp_replace(_col(c), "([A-Z])", " $1"))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, 2, 2**31 - 1))


# Field-name parts that mark amounts and times.
AMOUNT_FIELDS = ("balance", "weight", "wght", "amt", "amount", "stake", "delegationfee")
TIME_FIELDS = ("start", "end", "time", "timestamp")


def _names(c: Column, parts) -> Column:
    lowered = F.lower(c)
    hit = F.lit(False)
    for part in parts:
        hit = hit | lowered.contains(part)
    return hit


def field_display(name, value) -> Column:
    """Value text by field name: nano-amounts as coins, epoch times as time, the rest unchanged."""
    name, value = _col(name), _col(value)
    number = value.try_cast("bigint")
    seconds = F.when(number > 9999999999, F.floor(number / 1000)).otherwise(number)
    return (
        F.when(_names(name, AMOUNT_FIELDS) & (number > 1000000), nano_amount(number))
        .when(
            _names(name, TIME_FIELDS) & (number > 1000000000) & (number < 9999999999999),
            fmt_time(F.timestamp_seconds(seconds)),
        )
        .otherwise(value)
    )
