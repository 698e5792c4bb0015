"""Streams over several batches against the batch operators."""

import random
import time
from functools import reduce

import numpy as np
import pytest
from frames import attend, ts, values
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from test_alerts import KNOWN, samples

from studiolens.operators import alerts, occupancy, running
from studiolens.session import work_dir
from studiolens.sources import tables
from studiolens.streaming import files, outages, polls, rides


@pytest.fixture
def stream(spark, tmp_path):
    """Frames as a stream, one file and one batch each, in the given order."""

    def put(*frames):
        folder = tmp_path / "in"
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(str(folder))
            time.sleep(1.1)  # files are taken by their time
        return files.parquet_stream(spark, str(folder), frames[0].schema, files_per_batch=1)

    return put


def _rides(spark, source):
    home = work_dir(spark, "rides")
    rides.stream_ride_number(
        source, f"{home}/out", f"{home}/state", f"{home}/check"
    ).awaitTermination()
    return spark.read.parquet(f"{home}/out")


def test_ride_numbers_go_on_across_batches(spark, stream):
    rows = [(i, i % 3, "Enrolled" if i % 4 else "Cancelled", f"2024-01-{1 + i // 4:02d} 06:00:00")
            for i in range(40)]
    df = attend(spark, rows)
    got = _rides(spark, stream(df.where("id < 16"), df.where("id between 16 and 27"), df.where("id > 27")))
    assert not got.where("late").count()
    assert values(got, "id", "num") == values(running.with_ride_number(df), "id", "num")
    assert got.select("epoch").distinct().count() == 3


def test_late_rides_are_marked_and_not_counted(spark, stream):
    one = attend(spark, [(1, 1, "Enrolled", "2024-01-05 06:00:00")])
    two = attend(spark, [(2, 1, "Enrolled", "2024-01-04 06:00:00"),
                         (3, 2, "Enrolled", "2024-01-04 06:00:00")])
    three = attend(spark, [(4, 1, "Enrolled", "2024-01-06 06:00:00")])
    got = _rides(spark, stream(one, two, three))
    assert values(got, "id", "num", "late") == [
        (1, 1, False), (2, None, True), (3, 1, False), (4, 2, False)
    ]


def test_outages_go_on_across_batches(spark, stream):
    parts = [samples(spark, KNOWN[:7]), samples(spark, KNOWN[7:9], first=7),
             samples(spark, KNOWN[9:], first=9), samples(spark, [1], target=2, first=20)]
    home = work_dir(spark, "outages")
    outages.stream_outage_alerts(
        stream(*parts), f"{home}/out", f"{home}/state", f"{home}/check"
    ).awaitTermination()
    got = outages.alerts_of(spark.read.parquet(f"{home}/out"))
    want = alerts.outage_alerts(samples(spark, KNOWN).unionByName(parts[3]))
    assert values(got, *want.columns) == values(want, *want.columns)


def test_a_late_sample_changes_no_run(spark, stream):
    parts = [samples(spark, [0, 1], first=5), samples(spark, [1], first=1), samples(spark, [1, 0], first=7)]
    home = work_dir(spark, "outages")
    outages.stream_outage_alerts(
        stream(*parts), f"{home}/out", f"{home}/state", f"{home}/check"
    ).awaitTermination()
    written = spark.read.parquet(f"{home}/out")
    want = alerts.outage_alerts(parts[0].unionByName(parts[2]))
    assert values(outages.alerts_of(written), *want.columns) == values(want, *want.columns)
    assert written.where("reason = 'late'").count() == 1


def test_latest_poll_wins_across_batches(spark, stream):
    columns = "dt timestamp_ntz, site string, instr string, unavail int, total int, poll_ts timestamp_ntz"

    def seen(*rows):
        return spark.createDataFrame(
            [(ts(d), s, "Ann", n, 10, ts(p)) for d, s, n, p in rows], columns
        )

    six, seven = "2024-01-02 06:00:00", "2024-01-02 07:00:00"
    parts = [
        seen((six, "a", 1, "2024-01-01 10:00:00"), (six, "b", 2, "2024-01-01 10:00:00")),
        seen((six, "a", 5, "2024-01-01 10:04:00"), (six, "a", 3, "2024-01-01 10:02:00")),
        seen((six, "a", 9, "2024-01-01 09:00:00"), (seven, "a", 4, "2024-01-01 10:06:00")),
        seen((seven.replace("01-02", "02-20"), "a", 6, "2024-02-19 10:00:00")),
        # Weeks late, yet the newest of its class.
        seen((six, "b", 7, "2024-01-01 10:08:00"), (six, "a", 8, "2024-01-01 10:03:00")),
    ]
    home = work_dir(spark, "polls")
    polls.keep_latest(stream(*parts), f"{home}/occ", f"{home}/check").awaitTermination()
    got = tables.read_table(spark, f"{home}/occ")
    want = occupancy.occ_latest(reduce(DataFrame.unionByName, parts))
    assert values(got, *want.columns) == values(want, *want.columns)
    assert [r[0] for r in values(got, "unavail")] == [4, 5, 6, 7]


def test_restarts_touch_only_their_keys(spark, tmp_path):
    """Each batch is a run of its own; its state is that of the customers it holds."""
    days = [f"2024-01-{d:02d} 06:00:00" for d in range(1, 9)]
    parts = [
        attend(spark, [(10 * i + c, c, "Enrolled", day) for c in range(1, 6) if i == 0 or c == i % 3 + 1])
        for i, day in enumerate(days)
    ]
    home, touched = work_dir(spark, "rides"), []
    for part in parts:
        part.write.mode("append").parquet(f"{tmp_path}/in")
        source = files.parquet_stream(spark, f"{tmp_path}/in", part.schema)
        query = rides.stream_ride_number(source, f"{home}/out", f"{home}/late", f"{home}/check")
        query.awaitTermination()
        own = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
        touched.append(sum(p["numRowsUpdated"] for p in own))
        assert own[-1]["numRowsTotal"] == 5
    assert touched == [part.select("custid").distinct().count() for part in parts]
    got = spark.read.parquet(f"{home}/out")
    want = running.with_ride_number(reduce(DataFrame.unionByName, parts))
    assert values(got, "id", "num") == values(want, "id", "num")


def test_late_rows_have_an_output_of_their_own(spark, stream):
    one = attend(spark, [(1, 1, "Enrolled", "2024-03-05 06:00:00"), (2, 2, "Cancelled", None)])
    two = attend(spark, [(3, 1, "Enrolled", "2024-03-04 06:00:00"), (4, 9, "Enrolled", "2024-01-01 06:00:00"), (5, 2, "Enrolled", None)])
    home = work_dir(spark, "rides")
    rides.stream_ride_number(stream(one, two), f"{home}/out", f"{home}/late", f"{home}/check").awaitTermination()
    # Row 4 is the first of its customer, but two months behind; rows without a time are never late.
    assert values(spark.read.parquet(f"{home}/late"), "id", "num", "late") == [(3, None, True), (4, None, True)]
    assert values(spark.read.parquet(f"{home}/out").where("NOT late"), "id", "num") == [(1, 1), (2, 0), (5, 1)]


def test_columns_come_back_as_they_were(spark, stream):
    """Long integers beside nulls, exact times and money survive the state function."""
    df = attend(spark, [(2**60 + 1, 1, "Enrolled", "2024-01-05 06:00:00.123456"), (2**60 + 3, None, "Enrolled", "2024-01-06 06:00:00")])
    got = _rides(spark, stream(df))
    assert values(got, *df.columns) == values(df, *df.columns)
    assert values(got, "id", "num") == [(2**60 + 1, 1), (2**60 + 3, 1)]


def test_late_polls_are_marked_and_kept(spark, stream):
    columns = "dt timestamp_ntz, site string, instr string, unavail int, total int, poll_ts timestamp_ntz"
    row = lambda d, n, p: (ts(d), "a", None, n, 10, ts(p))
    first, later = "2024-01-02 06:00:00", "2024-01-20 06:00:00"
    parts = [
        spark.createDataFrame([row(first, 1, "2024-01-01 10:00:00"), row(first, 2, "2024-01-01 10:00:00")], columns),
        spark.createDataFrame([row(later, 3, "2024-01-19 10:00:00")], columns),
        spark.createDataFrame([row(first, 4, "2024-01-01 10:05:00"), row(first, 5, "2024-01-01 09:00:00")], columns),
    ]
    home = work_dir(spark, "polls")
    polls.keep_latest(stream(*parts), f"{home}/occ", f"{home}/check", late_out=f"{home}/late").awaitTermination()
    assert values(tables.read_table(spark, f"{home}/occ"), "dt", "unavail") == [(ts(first), 4), (ts(later), 3)]
    assert values(spark.read.parquet(f"{home}/late"), "unavail") == [(4,), (5,)]


def _frames(rows, size, *names):
    for i in range(0, len(rows), size):
        yield {n: np.array([r[k] for r in rows[i : i + size]]) for k, n in enumerate(names)}


class _State:
    """What the step functions use of a state."""

    def __init__(self, *value):
        self.get, self.exists = value, bool(value)

    def getCurrentWatermarkMs(self):
        return 0

    def update(self, value):
        self.get, self.exists = value, True


def test_a_run_needs_no_order_and_holds_no_samples_before_a_success():
    """Samples of a batch, shuffled, in frames of any size, against the same in order."""
    chance = random.Random(7)
    for _ in range(200):
        rows = [(chance.randrange(5, 15), i, chance.choice([0, 1, 1, 1, -1])) for i in range(chance.randrange(1, 30))]
        state, old = _State(2, 3, 4), 2
        for row in sorted(rows):
            old = 0 if row[2] == 0 else old + 1
        chance.shuffle(rows)
        assert sum(len(f["late"]) for f in outages.carry_run(_frames(rows, 4, "__at", "__id", "__down"), state)) == len(rows)
        last = max(rows)
        assert state.get == (old if last[2] == 1 else 0, last[1], last[0])
    run = outages._Run(0, (0, 0))
    for at in range(1, 1000):
        run.add(np.arange(at * 10, at * 10 + 10), np.arange(10), np.array([1, 0] * 5))
        assert not run.after


def test_counts_pass_frame_by_frame():
    """A frame goes out before the next one is asked for, so no task holds a customer's rows."""
    seen = []

    def frames():
        for part in _frames([(i, 1) for i in range(100, 0, -1)], 10, "__at", "__one"):
            seen.append(len(part["__at"]))
            yield part

    state = _State(5, 50)
    for n, out in enumerate(rides.carry_count(frames(), state), 1):
        assert len(seen) == n and set(out["__before"]) == {5}
    assert state.get == (56, 100)


def test_only_few_columns_reach_the_state_of_a_customer(spark, tmp_path):
    df = attend(spark, [(1, 1, "Enrolled", "2024-01-05 06:00:00")])
    df.write.parquet(f"{tmp_path}/in")
    got = rides.with_stored_count(files.parquet_stream(spark, f"{tmp_path}/in", df.schema))
    plan = got._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("FlatMapGroupsInPandasWithState") :].splitlines()[1]
    assert "__row" in below and "firstname#" not in below.partition("to_json")[0]


def test_a_hot_customer_of_a_batch_is_split(spark):
    df = attend(spark, [(i, 1, "Enrolled", f"2024-01-{1 + i % 9:02d} 06:00:00") for i in range(60)])
    batch = df.withColumn("__before", F.lit(7).cast("bigint")).withColumn("late", F.lit(False))
    want = running.with_ride_number(df).withColumn("num", F.col("num") + 7)
    assert values(rides.number_rows(batch, task_rows=10), "id", "num") == values(want, "id", "num")
