import random
from datetime import datetime

from pyspark.sql import functions as F

from blockloom.functions import hexes as H
from blockloom.functions import periods as P
from blockloom.functions import text as X
from blockloom.functions import u256 as U

MAX = 2**256


def _numbers():
    rng = random.Random(7)
    edge = [0, 1, 2**24 - 1, 2**24, 2**63, 2**64 - 1, 2**64, 10**38 - 1, 10**38, 2**128, 2**255, MAX - 1]
    return edge + [rng.getrandbits(rng.randint(1, 256)) for _ in range(60)]


def test_wide_integers_match_python(spark):
    values = _numbers()
    pairs = [(i, v, values[(i * 7 + 3) % len(values)]) for i, v in enumerate(values)]
    df = spark.createDataFrame([(i, bytearray(a.to_bytes(32, "big")), bytearray(b.to_bytes(32, "big"))) for i, a, b in pairs], "i int, a binary, b binary")
    staged = df.withColumns({"d": U.u256_diff("a", "b"), "m": U.u256_div("a", 10**6), "c": U.u256_div("a", 10**18), "s": U.u256_sub("a", "b")})
    out = staged.select("i", U.u256_to_text("a").alias("a"), U.u256_to_text("m").alias("m"), U.u256_to_text("c").alias("c"), U.signed_text("d").alias("d"), U.u256_to_text("s").alias("s"), U.u256_to_decimal("a").alias("dec"), U.u256_cmp("a", "b").alias("cmp"))
    for r in out.collect():
        _, a, b = pairs[r.i]
        assert (int(r.a), int(r.m), int(r.c), int(r.d), int(r.s)) == (a, a // 10**6, a // 10**18, a - b, (a - b) % MAX)
        assert r.a == str(a) and (r.dec is None) == (a >= 10**38) and r.cmp == (a > b) - (a < b)


def test_wide_sums_match_python(spark):
    values = _numbers()
    df = spark.createDataFrame([(i % 3, i % 2 == 0, bytearray(v.to_bytes(32, "big"))) for i, v in enumerate(values)], "k int, even boolean, v binary")
    one = df.groupBy("k").agg(U.u256_sum("v").alias("all"), U.u256_sum("v", F.col("even")).alias("some"), U.u256_sum("v", F.col("k") > 5).alias("none"))
    two = U.u256_sums_by(df, ["k"], {"all": ("v", None), "some": ("v", F.col("even")), "none": ("v", F.col("k") > 5)})
    for frame in (one, two):
        for r in frame.select("k", *[U.u256_to_text(c).alias(c) for c in ("all", "some", "none")]).collect():
            mine = [(i, v) for i, v in enumerate(values) if i % 3 == r.k]
            assert int(r.all) == sum(v for _, v in mine) % MAX
            assert int(r.some) == sum(v for i, v in mine if i % 2 == 0) % MAX and r.none == "0"


def test_hex_decoding_edges(spark):
    texts = ["0x", "", None, "0x0", "0x1f", "0xabc", "zz", "0xffffffffffffffff", "0x1ffffffffffffffff", "0x" + "0" * 30 + "1"]
    df = spark.createDataFrame([(t,) for t in texts], "h string")
    rows = df.select(H.hex_to_uint("h").alias("u"), H.hex_to_uint("h", 8).alias("u8"), H.hex_to_bytes("h").alias("b"), H.hex_to_fixed("h", 4).alias("f")).collect()
    assert [None if r.u is None else int(r.u) for r in rows] == [0, 0, 0, 0, 31, 2748, None, 2**64 - 1, None, 1]
    assert [r.u8 for r in rows] == [0, 0, 0, 0, 31, None, None, None, None, 1]
    assert [None if r.b is None else bytes(r.b).hex() for r in rows][:7] == ["", "", "", "00", "1f", "0abc", None]
    assert [None if r.f is None else bytes(r.f).hex() for r in rows][:8] == ["00000000"] * 4 + ["0000001f", "00000abc", None, None]


def test_strict_decoding_fails_loudly(spark):
    import pytest

    df = spark.createDataFrame([("0xzz",)], "h string")
    for c in (H.hex_to_uint("h", strict=True), H.hex_to_fixed("h", 4, strict=True), H.hex_to_bytes("h", strict=True)):
        with pytest.raises(Exception, match="bad"):
            df.select(c).collect()


def test_driver_periods():
    t = datetime(2024, 2, 29, 13, 45, 1)
    assert [P.floor_period(t, g) for g in ("hour", "day", "week", "month")] == [datetime(2024, 2, 29, 13), datetime(2024, 2, 29), datetime(2024, 2, 25), datetime(2024, 2, 1)]
    assert P.following_period(datetime(2023, 12, 31, 5), "month") == datetime(2024, 1, 1)
    assert P.pending_range(datetime(2024, 1, 1), datetime(2024, 1, 3, 5), "day") == (datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert P.pending_range(datetime(2024, 1, 2), datetime(2024, 1, 3, 5), "day") is None
    # a period is complete exactly when a block at its end exists
    assert P.pending_range(datetime(2024, 1, 1), datetime(2024, 1, 3), "day") == (datetime(2024, 1, 2), datetime(2024, 1, 3))


def test_weeks_start_on_sunday_and_february_has_its_length(spark):
    df = spark.sql("select cast(t as timestamp) t from values ('2024-02-25 00:00:00'), ('2024-02-24 23:59:59.999') v(t)")
    weeks = [r.w for r in df.select(F.date_format(P.period_start("t", "week"), "yyyy-MM-dd").alias("w")).collect()]
    assert weeks == ["2024-02-25", "2024-02-18"]
    seconds = df.select(P.period_seconds(P.period_start("t", "month"), "month").alias("s")).first().s
    assert seconds == 29 * 86400


def test_display_text(spark):
    one = spark.range(1)
    texts = lambda *cols: list(one.select(*[c.alias(str(i)) for i, c in enumerate(cols)]).first())
    assert texts(*[X.readable(F.lit(n)) for n in (999, 1234, 269775, 1500000, 7.25e9)]) == ["999", "1.23K", "269.77K", "1.50M", "7.25B"]
    assert texts(*[X.nano_amount(F.lit(n)) for n in (123456789, 1500000000, 2350000000000)]) == ["0.1235", "1.50", "2.35K"]
    assert texts(X.bytes_text(F.lit(2048)), X.readable_quantity(F.lit(12345678.0)), X.humanize_field(F.lit("stakeAmount"))) == ["2.00 KB", "12.35 million", "Stake Amount"]
    assert texts(X.field_display(F.lit("stakeAmount"), F.lit("2500000000")), X.field_display(F.lit("endTime"), F.lit("1700000000")), X.field_display(F.lit("memo"), F.lit("x"))) == ["2.50", "2023-11-14 22:13:20", "x"]
    assert texts(X.to_uint_or_zero(F.lit("18446744073709551616")), X.to_uint_or_zero(F.lit("12")), X.to_float_or_zero(F.lit("x"))) == [0, 12, 0.0]
    assert texts(X.trunc_div(F.lit(19999999999), F.lit(10000000000)), X.trunc_div(F.lit(1), F.lit(0))) == [1, None]


def test_bytes_are_cut_in_blocks(spark):
    """Numbers become bytes, limbs and text without passing through padded or cut texts, whatever their sign and length."""
    longs = [None, 0, 1, 15, 255, 256, 2**31, 2**63 - 1, -1, -(2**63)]
    rows = spark.createDataFrame([(n,) for n in longs], "n bigint").select("n", H.address_of("n").alias("a"), H.word_of("n").alias("w"), U.u256_from_words("n", F.lit(3)).alias("u"))
    for r in rows.collect():
        want = None if r.n is None else (r.n % 2**64).to_bytes(20, "big")
        assert (None if r.a is None else bytes(r.a)) == want and r.w == (want and want[-8:].hex().upper())
        assert (None if r.u is None else bytes(r.u)) == (want and bytes(4) + want + bytes(7) + b"\x03")
    wide = spark.createDataFrame([(bytearray(32),)], "v binary").select(*U.u256_limbs("v"), U.u256_to_text("v"))
    assert "lpad" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(hex" not in wide._jdf.queryExecution().optimizedPlan().toString()
