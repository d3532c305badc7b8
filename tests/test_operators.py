import os
import random

import pytest
from pyspark.sql import functions as F

from blockloom.operators import joins as J
from blockloom.operators import quality as D
from blockloom.operators import sorting as K
from blockloom.operators import windows as W


@pytest.fixture(scope="module")
def series(spark):
    """One key holds most rows, spread over many buckets."""
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), n, rng.randint(0, 9), rng.choice([None, n])) for n in rng.sample(range(5000), 900)]
    return spark.createDataFrame(rows, "k string, n bigint, v bigint, x bigint").persist()


def _same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)


def test_bucketed_windows_equal_plain_ones(series):
    _same(W.running_sum(series, "v", "n", ["k"]), W.running_sum(series, "v", "n", ["k"], width=37))
    _same(W.next_value(series, "n", "n", ["k"]), W.next_value(series, "n", "n", ["k"], width=37))
    _same(W.previous_event(series, ["k"], "n"), W.previous_event(series, ["k"], "n", width=37))
    _same(W.last_known(series, "x", "n", ["k"], 30), W.last_known(series, "x", "n", ["k"], 30, width=37))


def test_previous_event_skips_equal_times(spark):
    df = spark.sql("select 'a' k, cast(t as timestamp) t from values ('2024-01-01'), ('2024-01-02'), ('2024-01-02'), ('2024-01-05') v(t)")
    for width in (None, 86400):
        out = W.previous_event(df, ["k"], "t", width=width).select(F.dayofmonth("t"), F.dayofmonth("previous")).collect()
        assert sorted(map(tuple, out), key=repr) == sorted([(1, None), (2, 1), (2, 1), (5, 2)], key=repr)


def test_sum_in_span_matches_brute_force(spark):
    rng = random.Random(5)
    events = [(rng.choice("ab"), rng.randint(0, 50), rng.randint(1, 9)) for _ in range(300)]
    spans = [(i, rng.choice("ab"), *sorted((rng.randint(0, 50), rng.randint(0, 50))), rng.random() < 0.5) for i in range(80)]
    e = spark.createDataFrame(events, "k string, block_time bigint, amount bigint")
    s = spark.createDataFrame(spans, "id int, k string, start_time bigint, end_time bigint, start_exclusive boolean")
    for width in (None, 7):
        got = {r.id: int(r.total) for r in J.sum_in_span(s, e, "k", "id", width=width).collect()}
        for i, k, a, b, exclusive in spans:
            want = sum(v for kk, t, v in events if kk == k and (t > a if exclusive else t >= a) and t <= b)
            if not (exclusive and a == b):
                assert got[i] == want


def test_ranges_and_missing_numbers(spark):
    rng = random.Random(9)
    numbers = sorted(set(rng.sample(range(3000), 1500)) | set(range(1000, 2000)))
    df = spark.createDataFrame([("c", n) for n in numbers] * 2, "k string, n bigint")
    want, start = [], numbers[0]
    for a, b in zip(numbers, numbers[1:] + [None]):
        if b != a + 1:
            want.append((start, a))
            start = b
    for width in (10, 64, 1_000_000):
        got = sorted((r.range_start, r.range_end) for r in D.ranges(df, "n", ["k"], width).collect())
        assert got == want
        missing = sorted(r.n for r in D.missing_blocks(df, "n", ["k"], width).collect())
        assert missing == sorted(set(range(numbers[0], numbers[-1])) - set(numbers))


def test_orders(spark):
    df = spark.createDataFrame([("r", 1, "9"), ("l1", 2, "10"), ("p", 3, "x"), ("l1", 4, "7")], "t string, n int, w string")
    assert [r.n for r in K.rank_order(df, "t", ["p", "l1"], [F.desc("n")]).collect()] == [3, 4, 2, 1]
    assert [r.n for r in K.sort_numeric_text(df, "w", ["n"]).collect()] == [2, 1, 4, 3]
    assert [r.n for r in K.sort_limit(df, "n", "desc", 2).collect()] == [4, 3]
    assert [r.n for r in K.page(df, ["n"], 1, 3).collect()] == [4] and [r.n for r in K.page_after(df, "n", 2, 1).collect()] == [3]
    assert [r.n for r in K.merge_sorted(df.where("n > 2"), df.where("n <= 2"), "n").collect()] == [1, 2, 3, 4]


def test_scalar_subquery_is_no_cross_join(spark):
    df = J.with_scalar(spark.range(5), "top", spark.range(9).agg(F.max("id")))
    assert {r.top for r in df.collect()} == {8}
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_pages_by_a_unique_order_lose_no_ties(spark):
    df = spark.createDataFrame([(k, i) for k in range(4) for i in range(5)], "k int, i int")
    seen, last = [], None
    while rows := K.page_after(df, ["k", "i"], last, 3).collect():
        seen += [tuple(r) for r in rows]
        last = seen[-1]
    assert seen == sorted((k, i) for k in range(4) for i in range(5))


def test_sizes_of_stored_tables(spark, folder):
    from blockloom.sources.tables import gb_per_billion, table_stats

    paths = {n: f"{folder}/{n}.parquet" for n in ("orders", "lineitem")}
    stats = table_stats(spark, paths)
    sizes = {n: os.path.getsize(p) for n, p in paths.items()}
    got = {r.table: r for r in stats.collect()}
    assert {n: r.size_bytes for n, r in got.items()} == sizes
    assert all(abs(r.bytes_per_row - sizes[n] / r.rows) < 1e-9 for n, r in got.items())
    one = gb_per_billion(stats, "lineitem").first()
    assert one.total_bytes == sum(sizes.values()) and one.total_rows == sum(r.rows for r in got.values())
    assert abs(one.gb_per_billion - sum(sizes.values()) / got["lineitem"].rows * 1e9 / 2**30) < 1e-6
    assert gb_per_billion(stats, "absent").first().gb_per_billion == 0
