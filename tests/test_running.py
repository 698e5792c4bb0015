"""Running counts against a loop over all rows."""

import random

import pytest
from frames import attend, cust, ts, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from studiolens.functions import prefix
from studiolens.functions.prefix import Mark, prefix_before, time_levels
from studiolens.operators import running
from studiolens.session import work_dir


def _loop(rows, counts=None, total=0):
    """Ride and studio numbers the slow way: one pass in order."""
    counts = dict(counts or {})
    out = {}
    for r in sorted(rows, key=lambda r: (r.classdate, r.datein, r.id)):
        if r.status == "Enrolled":
            counts[r.custid] = counts.get(r.custid, 0) + 1
            total += 1
        out[r.id] = (counts.get(r.custid, 0), total)
    return out


def _random(spark, seed, n=400, hot=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        who = 1 if hot and rng.random() < 0.5 else rng.randint(2, 6)
        at = f"2024-01-{rng.randint(1, 4):02d} {rng.randint(6, 8):02d}:00:00"
        booked = f"2024-01-01 00:00:{rng.randint(0, 3):02d}.{rng.randint(0, 2)}00000"
        rows.append((i, who, rng.choice(["Enrolled", "Enrolled", "Cancelled"]), at, booked))
    return attend(spark, rows)


def _stored(spark, df):
    path = work_dir(spark, "attend")
    df.write.parquet(path)
    return spark.read.parquet(path)


# With a limit of 20 rows a task, most customers and days of the small tables are large.
LIMITS = [running.TASK_ROWS, 20]


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("seed", [1, 2])
def test_both_numbers_equal_the_loop(spark, seed, limit):
    df = _random(spark, seed)
    got = running.with_both_numbers(df, task_rows=limit).collect()
    want = _loop(df.collect())
    assert {r.id: (r.num, r.totnum) for r in got} == want


@pytest.mark.parametrize("limit", LIMITS)
def test_a_second_load_goes_on_from_the_first(spark, limit):
    df = _random(spark, 3)
    first = df.where(F.col("classdate") < "2024-01-03")
    later = df.where(F.col("classdate") >= "2024-01-03")
    done = _stored(spark, running.with_both_numbers(first))
    more = running.with_both_numbers(later, done, limit)
    got = {r.id: (r.num, r.totnum) for r in done.unionByName(more).collect()}
    assert got == _loop(df.collect())


def test_an_empty_store_changes_nothing(spark):
    df = _random(spark, 4, n=50)
    empty = _stored(spark, running.with_both_numbers(df)).where("id < 0")
    got = running.with_both_numbers(df, empty)
    assert {r.id: (r.num, r.totnum) for r in got.collect()} == _loop(df.collect())


def test_rows_without_a_time_come_first(spark):
    df = attend(
        spark, [(1, 1, "Enrolled", "2024-01-01 06:00:00"), (2, 1, "Enrolled", None, None)]
    )
    assert values(running.with_ride_number(df), "id", "num") == [(1, 2), (2, 1)]


@pytest.mark.parametrize("limit", LIMITS)
def test_rows_without_customer_are_numbered_like_a_customer(spark, limit):
    """As a plain window does, within a load and across two."""
    df = _random(spark, 5).withColumn("custid", F.when(F.col("custid") > 1, F.col("custid")))
    first, later = (df.where(F.expr(f"classdate {op} timestamp_ntz'2024-01-03'")) for op in ("<", ">="))
    order = Window.partitionBy("custid").orderBy("classdate", "datein", "id")
    plain = df.withColumn("num", F.sum(F.when(F.col("status") == "Enrolled", 1).otherwise(0)).over(order))
    want = values(plain, "id", "num")
    assert values(running.with_ride_number(df, task_rows=limit), "id", "num") == want
    done = _stored(spark, running.with_ride_number(first, task_rows=limit))
    more = running.with_ride_number(later, done, limit)
    assert values(done.unionByName(more), "id", "num") == want


def test_a_large_customer_is_spread_over_tasks(spark):
    # One customer holds most rows, half of them copies that differ in the id alone.
    n = 40_000
    rows = spark.range(n).select(
        (F.col("id") * 512).alias("id"),
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).cast("bigint").alias("custid"),
        F.lit("Enrolled").alias("status"),
        F.timestamp_seconds(
            F.lit(1_700_000_000) + F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") * 60)
        ).cast("timestamp_ntz").alias("classdate"),
    ).withColumn("datein", F.col("classdate"))
    got = running.with_ride_number(rows, task_rows=5_000).where("custid = 1")
    assert got.agg(F.countDistinct("num"), F.max("num")).first()[:] == (n * 8 // 10, n * 8 // 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < n * 8 // 10 // 4


def test_bucket_totals_of_a_large_day_are_spread(spark):
    """Bookings of one class at a different second each: no task orders most of the totals."""
    n = 60_000
    rows = spark.range(n).select(
        "id", (F.col("id") % 500).alias("custid"), F.lit("Enrolled").alias("status"),
        F.lit("2024-01-20 06:00:00").cast("timestamp_ntz").alias("classdate"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 20).cast("timestamp_ntz").alias("datein"),
    )
    got = running.with_studio_number(rows, task_rows=1_000)
    assert got.where(F.col("totnum") != F.col("id") + 1).count() == 0
    # Of the buckets of each level within one bucket above it, there are few.
    levels = rows.select(F.to_date("datein").alias("d"), F.hour("datein").alias("h"), F.date_trunc("second", "datein").alias("s")).distinct()
    assert levels.select("d").distinct().count() < 20
    assert levels.groupBy("d", "h").agg(F.countDistinct("s").alias("n")).agg(F.max("n")).first()[0] <= 3600


@settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 2), st.integers(-5, 5)),
        min_size=1, max_size=30,
    ),
    st.sampled_from([0, 3, 1000]),
)
def test_prefix_sum_and_max_of_any_rows(spark, rows, limit):
    data = [
        (i, k, ts(f"2024-01-0{d + 1} 00:00:0{s}"), v) for i, (k, d, s, v) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, "id int, k int, t timestamp_ntz, v int")
    start = spark.createDataFrame([(0, 100, -3)], "k int, before bigint, top int")
    got = prefix_before(
        df, ["k"], time_levels(["t"], "id"), ["t", "id"],
        {"before": ("sum", F.col("v")), "top": ("max", F.col("v"))}, start, limit,
    ).collect()
    ordered = sorted(data, key=lambda r: (r[2], r[0]))
    for row in got:
        earlier = [
            v for i, k, t, v in ordered if k == row.k and (t, i) < (row.t, row.id)
        ]
        if row.k == 0:
            earlier_top = [*earlier, -3]
            assert row.before == 100 + sum(earlier) and row.top == max(earlier_top)
        else:
            assert row.before == sum(earlier)
            assert row.top == (max(earlier) if earlier else None)


@pytest.mark.parametrize("limit", [0, 7, 1000])
def test_a_mark_is_the_sum_after_the_last_flagged_row(spark, limit):
    rng = random.Random(limit)
    data = [
        (i, rng.choice([1, 1, 1, 2, None]), ts(f"2024-01-0{rng.randint(1, 3)} 00:00:0{rng.randint(0, 2)}"),
         rng.randint(0, 3), rng.random() < 0.2)
        for i in range(120)
    ]
    df = spark.createDataFrame(data, "id int, k int, t timestamp_ntz, v int, hit boolean")
    start = spark.createDataFrame([(2, 10, -4)], "k int, total bigint, at bigint")
    got = prefix_before(
        df, ["k"], time_levels(["t"], "id"), ["t", "id"],
        {"total": ("sum", F.col("v")), "at": Mark("total", F.col("hit"))}, start, limit,
    )
    state, want = {2: (10, -4)}, {}
    for i, k, _, v, hit in sorted(data, key=lambda r: (r[2], r[0])):
        total, at = state.get(k, (0, None))
        want[i] = (total, at)
        state[k] = (total + v, total + v if hit else at)
    assert {r.id: (r.total, r.at) for r in got.collect()} == want


def test_the_set_of_large_keys_is_bounded(spark, monkeypatch):
    """With a limit of no rows every key is large, but no more are told apart than the bound."""
    df = _random(spark, 6)
    monkeypatch.setattr(prefix, "MOST_LARGE", 3)
    got = running.with_ride_number(df, task_rows=0)
    assert {r.id: r.num for r in got.collect()} == {i: n for i, (n, _) in _loop(df.collect()).items()}
    assert "GlobalLimit 3" in got._jdf.queryExecution().analyzed().toString()


def test_last_or_upcoming_keeps_copies_and_skips_those_that_come(spark):
    day = "2024-01-10"
    rows = [
        (1, 1, "2024-01-05 06:00:00", 97), (2, 1, "2024-01-06 06:00:00", 98),
        (3, 2, "2024-01-05 06:00:00", 98), (4, 2, "2024-01-11 06:00:00", 99), (4, 2, "2024-01-11 06:00:00", 99),
        (5, 3, "2024-01-05 06:00:00", 99), (6, 3, "2024-02-20 06:00:00", 100),
        (7, None, "2024-01-05 06:00:00", 100), (8, 4, None, 98),
    ]
    df = spark.createDataFrame(
        [(c, "f", "l", ts(at) if at else None, n) for _, c, at, n in rows],
        "custid bigint, firstname string, lastname string, classdate timestamp_ntz, num bigint",
    )
    got = running.last_known_or_upcoming(df, day).collect()
    assert sorted(((r.custid or 0, r.num) for r in got)) == [(0, 100), (1, 98), (2, 99), (2, 99)]


def test_milestones_carry_cancelled_rows_unless_asked(spark):
    rows = [(i, 1, "Enrolled", f"2024-01-{i:02d} 06:00:00") for i in range(1, 11)]
    rows.append((11, 1, "Cancelled", "2024-01-10 18:00:00"))
    numbered = running.with_ride_number(attend(spark, rows))
    people = cust(spark, [(1, None, "2023-01-01")])
    got = running.milestones_next(numbered, people, "2024-01-10", step=10, approach=1)
    assert values(got, "num", "classdate") == [
        (10, ts("2024-01-10 06:00:00")), (10, ts("2024-01-10 18:00:00"))
    ]
    only = running.milestones_next(
        numbered, people, "2024-01-10", step=10, approach=1, enrolled_only=True
    )
    assert only.count() == 1
    # Rides near the milestone show ahead of it, too.
    assert values(
        running.milestones_next(numbered, people, "2024-01-09", step=10, approach=1), "num"
    ) == [(10,), (10,), (9,)]


def test_number_on_read_counts_all_rides_of_the_same_time(spark):
    df = attend(
        spark,
        [(1, 1, "Enrolled", "2024-01-01 06:00:00"), (2, 1, "Enrolled", "2024-01-02 06:00:00"),
         (3, 1, "Enrolled", "2024-01-02 06:00:00"), (4, 1, "Cancelled", "2024-01-03 06:00:00")],
    )
    assert values(running.ride_number_on_read(df, "2024-01-02"), "id", "num") == [
        (1, 1), (2, 3), (3, 3)
    ]
