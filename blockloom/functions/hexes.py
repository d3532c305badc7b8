"""Hex text to numbers and bytes (all JVM expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockloom.constants import ZERO_ADDRESS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits(c) -> Column:
    """Hex digits without a 0x prefix; NULL counts as empty."""
    c = F.coalesce(_col(c), F.lit(""))
    # cut as bytes, in one block; a text is cut by counting its characters
    return F.when(c.startswith("0x"), F.substring(c.cast("binary"), 3, 2**31 - 1).cast("string")).otherwise(c)


def _or_fail(value: Column, h, kind: str, strict: bool, what: str) -> Column:
    if not strict:
        return value
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"bad {what}: "), _col(h))).cast(kind))


# The *_of functions take bare digits.  A job that decodes many fields strips the prefixes in a
# projection of its own first, which keeps the generated code of the decoding step small.


def uint_of(h, bits: int = 64, strict: bool = False, kind: str | None = None) -> Column:
    h = _col(h)
    kind = kind or ("int" if bits <= 16 else "bigint" if bits <= 32 else "decimal(20,0)")
    # zeros in front are looked for only where there are too many digits
    short = (F.octet_length(h) <= bits // 4) | (F.length(F.ltrim(h, F.lit("0"))) <= bits // 4)
    ok = short & F.unhex(h).isNotNull()
    # conv gives NULL for no digits
    return _or_fail(F.when(ok, F.coalesce(F.conv(h, 16, 10), F.lit("0")).cast(kind)), h, kind, strict, f"{bits}-bit quantity")


def bytes_of(h, strict: bool = False) -> Column:
    return _or_fail(F.unhex(_col(h)), h, "binary", strict, "hex")


def fixed_of(h, size: int, strict: bool = False) -> Column:
    h = _col(h)
    # zeros by repeat, which copies them in blocks; lpad copies one at a time.  Digits are single bytes, so nothing
    # counts characters: a text that holds others is no hex, whatever its length
    zeros = F.repeat(F.lit("0"), F.lit(2 * size) - F.octet_length(h))
    return _or_fail(F.when(F.octet_length(h) <= 2 * size, F.unhex(F.concat(zeros, h))), h, "binary", strict, f"{size}-byte value")


def hex_to_uint(c, bits: int = 64, strict: bool = False) -> Column:
    """Hex quantity to an unsigned number; empty is 0, bad or too wide is NULL (an error if strict)."""
    return uint_of(digits(c), bits, strict)


def hex_to_bytes(c, strict: bool = False) -> Column:
    """Hex to bytes; an odd digit count gets a leading zero, empty gives zero bytes."""
    return bytes_of(digits(c), strict)


def hex_to_fixed(c, size: int, strict: bool = False) -> Column:
    """Hex to exactly ``size`` bytes, zero-padded on the left; too long or bad is NULL."""
    return fixed_of(digits(c), size, strict)


def hex_to_u256(c, strict: bool = False) -> Column:
    """Hex to the canonical 256-bit form: 32 bytes, big-endian."""
    return hex_to_fixed(c, 32, strict)


def from_hex(text: str) -> Column:
    """A byte literal from hex text, folded to a constant so that it can be pushed to the scan."""
    return F.lit(bytes.fromhex(text.removeprefix("0x")))


def to_hex(c) -> Column:
    return F.lower(F.hex(_col(c)))


def topic_address(c) -> Column:
    """The address in a 32-byte topic: its last 20 bytes."""
    return F.substring(_col(c), 13, 20)


def byte_length(c) -> Column:
    return F.length(_col(c))


def non_zero(c) -> Column:
    """True for an address that is present and not all zero bytes."""
    c = _col(c)
    return c.isNotNull() & (c != from_hex(ZERO_ADDRESS))


def bytes_of_long(number, size: int) -> Column:
    """The last ``size`` bytes of a bigint, with zero bytes in front if it has fewer.

    Bytes are cut and joined in blocks, where lpad and substring go through a text one character at a time.
    """
    return F.substring(F.concat(F.lit(bytes(size)), F.unhex(F.hex(_col(number).cast("bigint")))), -size, size)


def long_of(b, start: int, size: int) -> Column:
    """``size`` bytes (seven at most) of a binary as a bigint, ``start`` counted from 1."""
    return F.conv(F.hex(F.substring(_col(b), start, size)), 16, 10).cast("bigint")


def word_of(number) -> Column:
    """A bigint as 16 hex digits."""
    return F.hex(bytes_of_long(number, 8))


def wide_of(number, size: int) -> Column:
    """A bigint as the hex digits of ``size`` bytes, at least eight; only the digits of the number itself are padded."""
    return F.concat(F.lit("0" * (2 * size - 16)), word_of(number))


def text_of(number, size: int) -> Column:
    """A bigint as 0x and the lower-case digits of ``size`` bytes, at least eight; only its own digits are looked at."""
    own = F.lower(F.hex(_col(number).cast("bigint")))
    return F.concat(F.lit("0x"), F.repeat(F.lit("0"), F.lit(2 * size) - F.octet_length(own)), own)


def address_of(number) -> Column:
    """20-byte address holding a whole number (test mapping and genesis-style addresses)."""
    return bytes_of_long(number, 20)


def hash_of(number) -> Column:
    return bytes_of_long(number, 32)
