"""Exact 256-bit unsigned integers.

Canonical form: 32 bytes, big-endian, so binary comparison is numeric comparison.
Sums split each value into eleven limbs of 24 bits kept in bigint accumulators: that
stays inside code generation, combines map-side, and a group can hold 2^39 rows before
an accumulator could overflow (ANSI mode then fails instead of wrapping).
Carrying happens once per group, after the aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions.hexes import bytes_of_long, long_of

LIMB_BITS = 24
LIMBS = 11
_MASK = (1 << LIMB_BITS) - 1
_DIGIT = 10**11
_DIGITS = 8


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def u256_lit(value: int) -> Column:
    return F.lit(value.to_bytes(32, "big"))


def u256_from_long(c) -> Column:
    """Non-negative whole number to the canonical form."""
    return bytes_of_long(c, 32)


def u256_from_words(high, low) -> Column:
    """high * 2^64 + low, for non-negative bigint words."""
    return F.concat(bytes_of_long(high, 24), bytes_of_long(low, 8))


def u256_limbs(c) -> list[Column]:
    """Eleven bigint limbs, most significant first: six parsed words, the lower five split in two."""
    c = _col(c)
    mask = F.lit(_MASK).cast("bigint")
    limbs = [long_of(c, 1, 2)]
    for i in range(5):
        word = long_of(c, 3 + 6 * i, 6)
        limbs += [F.shiftright(word, LIMB_BITS), word.bitwiseAND(mask)]
    return limbs


def u256_from_sums(sums: list[Column]) -> Column:
    """Carry signed limb sums into the canonical form (modulo 2^256): a fold that writes hex digits."""
    mask = F.lit(_MASK).cast("bigint")
    start = F.struct(F.lit("").alias("digits"), F.lit(0).cast("bigint").alias("carry"))

    def step(state, limb):
        total = state["carry"] + limb
        return F.struct(
            F.concat(F.lpad(F.hex(total.bitwiseAND(mask)), 6, "0"), state["digits"]).alias("digits"),
            F.shiftright(total, LIMB_BITS).alias("carry"),
        )

    return F.unhex(F.substring(F.aggregate(F.array(*sums[::-1]), start, step)["digits"], 3, 64))


def _from_columns(sums: list[Column]) -> Column:
    """The same unrolled into plain arithmetic: several times faster, but only where the sums are
    columns already; inside an aggregation the generated method would be too large to compile."""
    mask = F.lit(_MASK).cast("bigint")
    low, carry = [], None
    for limb in reversed(sums):
        total = limb if carry is None else limb + carry
        low.append(total.bitwiseAND(mask))
        carry = F.shiftright(total, LIMB_BITS)
    up, down = F.shiftleft, F.shiftright
    words = [
        low[8].bitwiseOR(up(low[9], 24)).bitwiseOR(up(low[10], 48)),
        down(low[5], 8).bitwiseOR(up(low[6], 16)).bitwiseOR(up(low[7], 40)),
        down(low[2], 16).bitwiseOR(up(low[3], 8)).bitwiseOR(up(low[4], 32)).bitwiseOR(up(low[5], 56)),
        low[0].bitwiseOR(up(low[1], 24)).bitwiseOR(up(low[2], 48)),
    ]
    return F.concat(*[bytes_of_long(w, 8) for w in words])


def u256_sums_by(df: DataFrame, keys: list, sums: dict[str, tuple[str, Column | None]], others: list[Column] = ()) -> DataFrame:
    """Group by ``keys`` with many exact sums: ``sums`` maps a result name to (column, condition or None).

    For results with very many groups.  The aggregation yields plain limb sums, and a projection
    behind it carries them.
    """
    limb_sums = [F.coalesce(F.sum(limb), F.lit(0).cast("bigint")).alias(f"_{name}_{i}") for name, (c, where) in sums.items() for i, limb in enumerate(_counted(c, where))]
    grouped = df.groupBy(*keys).agg(*limb_sums, *others)
    plain = [c for c in grouped.columns if not any(c.startswith(f"_{name}_") for name in sums)]
    return grouped.select(*plain, *[_from_columns([F.col(f"_{name}_{i}") for i in range(LIMBS)]).alias(name) for name in sums])


def _counted(c, where: Column | None) -> list[Column]:
    limbs = u256_limbs(c)
    if where is None:
        return limbs
    # a factor instead of a condition, so that sums with different filters share the parsed limbs
    counted = F.coalesce(where, F.lit(False)).cast("int").cast("bigint")
    return [limb * counted for limb in limbs]


def u256_sum(c, where: Column | None = None) -> Column:
    """Aggregate: exact sum of canonical values, optionally only of rows where ``where`` holds; no rows give 0."""
    return u256_from_sums([F.coalesce(F.sum(limb), F.lit(0).cast("bigint")) for limb in _counted(c, where)])


def u256_diff(a, b) -> Column:
    """a - b as struct(negative, magnitude)."""
    a, b = _col(a), _col(b)
    greater, less = F.greatest(a, b), F.least(a, b)
    # no sums are taken, so that five pieces do: four bytes, and four times seven
    out, carry = [], None
    for start, size in [(26, 7), (19, 7), (12, 7), (5, 7), (1, 4)]:
        piece = long_of(greater, start, size) - long_of(less, start, size)
        piece = piece if carry is None else piece + carry
        out.insert(0, bytes_of_long(piece, size))
        carry = F.shiftright(piece, 8 * size)
    return F.struct((a < b).alias("negative"), F.concat(*out).alias("magnitude"))


def u256_sub(a, b) -> Column:
    """a - b modulo 2^256."""
    return u256_from_sums([x - y for x, y in zip(u256_limbs(a), u256_limbs(b))])


def u256_cmp(a, b) -> Column:
    a, b = _col(a), _col(b)
    return F.when(a < b, -1).when(a > b, 1).when(a == b, 0)


def limb_sums(limbs: list[Column]) -> Column:
    """Aggregate: the sum of each limb, not carried, so that a total may pass 256 bits; such sums can be summed again."""
    return F.array(*[F.coalesce(F.sum(limb), F.lit(0).cast("bigint")) for limb in limbs])


def _carried(sums: Column) -> Column:
    """Limb sums, most significant first, as limbs of a number of up to 24 * (LIMBS + 2) bits."""
    mask = F.lit(_MASK).cast("bigint")
    start = F.struct(F.expr("cast(array() as array<bigint>)").alias("out"), F.lit(0).cast("bigint").alias("carry"))

    def step(state, limb):
        total = state["carry"] + limb
        return F.struct(F.concat(F.array(total.bitwiseAND(mask)), state["out"]).alias("out"), F.shiftright(total, LIMB_BITS).alias("carry"))

    zeros = F.array(*[F.lit(0).cast("bigint")] * 2)
    return F.aggregate(F.concat(F.reverse(sums), zeros), start, step)["out"]


def quotient_text(sums, divisor: int) -> Column:
    """Exact decimal text of the whole quotient of limb sums by a constant.

    The argument is used several times: give computed sums a column of their own first.
    """
    limbs = _carried(_col(sums))
    for step in _steps(divisor):
        limbs = _divided(limbs, step)
    return F.coalesce(_short_quotient(_col(sums), divisor), _limbs_text(limbs))


def _short_quotient(sums: Column, divisor: int) -> Column:
    """The same in decimal arithmetic, or NULL where the total or the quotient needs more digits than that has."""
    whole = "decimal(38,0)"
    if divisor >= 10**31:
        return F.lit(None).cast("string")
    total = sums[LIMBS - 1].cast(whole)
    for i in range(1, 5):
        power = F.lit(str(1 << LIMB_BITS * i)).cast("decimal(30,0)")
        total = F.try_add(total, F.try_multiply(sums[LIMBS - 1 - i].cast("decimal(19,0)"), power).try_cast(whole)).try_cast(whole)
    d = F.lit(str(divisor)).cast(whole)
    # what is divided leaves no remainder, so the fraction that a decimal quotient keeps is zero
    quotient = F.try_divide(F.try_subtract(total, F.try_mod(total, d)), d).try_cast(whole)
    high = reduce(lambda x, y: x.bitwiseOR(y), [sums[i] for i in range(LIMBS - 5)])
    return F.when(high == 0, quotient.cast("string"))


def u256_div(c, divisor: int) -> Column:
    """Whole quotient by a small constant; larger powers of ten divide in steps."""
    limbs = u256_limbs(c)
    for step in _steps(divisor):
        limbs = _divided_columns(limbs, step)
    # the first limb holds 16 bits; NULL gives no bytes
    return F.coalesce(F.unhex(F.concat(F.lpad(F.hex(limbs[0]), 4, "0"), *[F.lpad(F.hex(x), 6, "0") for x in limbs[1:]])), F.lit(b""))


def _steps(divisor: int) -> list[int]:
    if divisor <= 0:
        raise ValueError("divisor must be positive")
    steps = []
    while divisor >= 2**38:
        for factor in (10**9, 2**24, 10, 2, 3, 5, 7):
            if divisor % factor == 0:
                break
        else:
            raise ValueError("divisor is too large and has no small factor")
        steps.append(factor)
        divisor //= factor
    return [*steps, divisor]


def _divided(limbs: Column, divisor: int) -> Column:
    """Long division of a limb array; the remainder goes down with the fold."""
    d = F.lit(divisor).cast("bigint")
    base = F.lit(1 << LIMB_BITS).cast("bigint")
    start = F.struct(F.expr("cast(array() as array<bigint>)").alias("out"), F.lit(0).cast("bigint").alias("rest"))

    def step(state, limb):
        total = state["rest"] * base + limb
        return F.struct(F.concat(state["out"], F.array(F.call_function("div", total, d))).alias("out"), (total % d).alias("rest"))

    return F.aggregate(limbs, start, step)["out"]


def _divided_columns(limbs: list[Column], divisor: int) -> list[Column]:
    """The same unrolled into plain arithmetic, which generated code shares between the limbs."""
    d = F.lit(divisor).cast("bigint")
    base = F.lit(1 << LIMB_BITS).cast("bigint")
    out, rest = [], None
    for limb in limbs:
        total = limb if rest is None else rest * base + limb
        out.append(F.call_function("div", total, d))
        rest = total % d
    return out


def u256_to_decimal(c) -> Column:
    """decimal(38,0), or NULL where the value needs more digits."""
    c = _col(c)
    word = lambda start: F.conv(F.hex(F.substring(c, start, 8)), 16, 10).cast("decimal(20,0)")
    high = F.try_multiply(word(17), F.lit("18446744073709551616").cast("decimal(20,0)"))
    total = F.try_add(high.cast("decimal(38,0)"), word(25).cast("decimal(38,0)"))
    return F.when(F.substring(c, 1, 16) == F.lit(bytes(16)), total.cast("decimal(38,0)"))


def u256_to_text(c) -> Column:
    """Exact decimal text of any 256-bit value.

    The argument is used several times: give a computed value a column of its own first.
    """
    return F.coalesce(u256_to_decimal(c).cast("string"), _long_text(c))


def _long_text(c) -> Column:
    return F.when(_col(c).isNotNull(), _limbs_text(F.array(*u256_limbs(c))))


def _limbs_text(limbs: Column) -> Column:
    base = F.lit(1 << LIMB_BITS).cast("bigint")
    ten = F.lit(_DIGIT).cast("bigint")
    zeros = F.array(*[F.lit(0).cast("bigint")] * _DIGITS)

    def absorb(number, limb):
        # number is little-endian in base 10^11; multiply by 2^24 and add the limb
        start = F.struct(F.expr("cast(array() as array<bigint>)").alias("out"), limb.alias("carry"))

        def step(state, digit):
            total = digit * base + state["carry"]
            rest = total % ten
            return F.struct(
                F.concat(state["out"], F.array(rest)).alias("out"),
                F.call_function("div", total, ten).alias("carry"),
            )

        return F.aggregate(number, start, step)["out"]

    number = F.aggregate(limbs, zeros, absorb)
    text = F.array_join(F.transform(F.reverse(number), lambda d: F.lpad(d.cast("string"), 11, "0")), "")
    trimmed = F.regexp_replace(text, "^0+", "")
    return F.when(trimmed == "", "0").otherwise(trimmed)


def u256_to_double(c) -> Column:
    limbs = u256_limbs(c)
    total = limbs[0].cast("double")
    for limb in limbs[1:]:
        total = total * F.lit(float(1 << LIMB_BITS)) + limb
    return total


def u256_to_hex(c) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(_col(c))))


def signed_text(diff) -> Column:
    """Text of a struct(negative, magnitude)."""
    d = _col(diff)
    return F.concat(F.when(d["negative"], F.lit("-")).otherwise(F.lit("")), u256_to_text(d["magnitude"]))
