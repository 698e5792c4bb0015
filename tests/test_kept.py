"""Side tables of a nightly load: same results, less of the history read."""

import datetime as dt
import os
import random

import pytest
from frames import attend, values
from pyspark.sql import functions as F

from studiolens.plans import load
from studiolens.session import remove_dir, work_dir
from studiolens.sources import kept, tables, versions

SIDES = (tables.RANGES, tables.COUNTERS)


def _day(n: int) -> str:
    return f"2024-01-{n:02d} 06:00:00"


def _load(table, batch):
    """One load by brute force; ``table`` maps ids to (customer, status, num, totnum)."""
    for row in batch:
        table.pop(row[0], None)
    nums, total = {}, max((row[3] for row in table.values()), default=0)
    for custid, _, num, _ in table.values():
        nums[custid] = max(num, nums.get(custid, 0))
    for id_, custid, status, time, _ in sorted(batch, key=lambda row: (row[3] or "", row[0])):
        one = int(status == "Enrolled")
        nums[custid] = nums.get(custid, 0) + one
        total += one
        table[id_] = (custid, status, nums[custid], total)


def _batches():
    """Nights that replace rows of days before, a late file, rows without a time."""
    draw = random.Random(5)
    batches, ids = [], 0
    for first, last in [(1, 6), (5, 9), (3, 4), (8, 11)]:
        rows = []
        for _ in range(12):
            ids += 1
            id_ = draw.randrange(max(1, ids - 15), ids) if draw.random() < 0.3 else ids
            time = None if draw.random() < 0.1 else _day(draw.randint(first, last))
            rows.append((id_, draw.randint(1, 3), draw.choice(["Enrolled", "Cancelled"]), time, "2024-01-01 00:00:00"))
        batches.append(list({row[0]: row for row in rows}.values()))
    return batches


@pytest.mark.parametrize("grain,nights", [("day", 4), ("month", 2)])
def test_loads_number_as_they_do_from_the_whole_table(spark, grain, nights):
    path, plain = work_dir(spark, "attend"), {}
    for batch in _batches()[:nights]:
        load.load_attendance(spark, path, attend(spark, batch), grain)
        _load(plain, batch)
    got = values(tables.read_table(spark, path), "id", "custid", "status", "num", "totnum")
    assert sorted(got) == [(id_, *plain[id_]) for id_ in sorted(plain)]
    assert max(row[3] for row in got) > 3


def _spoil(path, day):
    folder = f"{path}/{tables.PART}={day}"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"no parquet")
        else:
            os.remove(f"{folder}/{name}")


def test_a_nightly_load_reads_no_day_before_those_it_touches(spark):
    path = work_dir(spark, "attend")
    load.load_attendance(spark, path, attend(spark, [(n, 1, "Enrolled", _day(n)) for n in range(1, 6)]))
    load.load_attendance(spark, path, attend(spark, [(5, 1, "Cancelled", _day(5)), (6, 1, "Enrolled", _day(6))]))
    for day in ("2024-01-02", "2024-01-03", "2024-01-04"):
        _spoil(path, day)
    load.load_attendance(spark, path, attend(spark, [(6, 2, "Enrolled", _day(6)), (7, 1, "Enrolled", _day(7))]))
    late = tables.stored_rows(spark, path).where(F.col(tables.PART) >= dt.date(2024, 1, 5))
    assert values(late, "id", "status", "num", "totnum") == [
        (5, "Cancelled", 4, 4), (6, "Enrolled", 1, 5), (7, "Enrolled", 5, 6)
    ]


def test_other_loads_take_the_side_tables_away(spark):
    path = work_dir(spark, "attend")
    first = attend(spark, [(1, 1, "Enrolled", _day(1)), (2, 1, "Enrolled", _day(2))])
    load.load_attendance(spark, path, first)
    load.load_attendance(spark, path, attend(spark, [(3, 1, "Enrolled", _day(3))]))
    assert all(os.path.exists(f"{path}/{side}") for side in SIDES)
    gone = tables.read_table(spark, path).where("id = 1").withColumn("num", F.lit(0).cast("long"))
    tables.upsert_at(spark, path, gone.withColumn("custid", F.lit(9).cast("long")), ["id"], "classdate")
    assert not any(os.path.exists(f"{path}/{side}") for side in SIDES)
    load.load_attendance(spark, path, attend(spark, [(4, 9, "Enrolled", _day(4)), (1, 9, "Cancelled", _day(1))]))
    assert values(tables.read_table(spark, path), "id", "custid", "num") == [
        (1, 9, 0), (2, 1, 2), (3, 1, 3), (4, 9, 1)
    ]


def test_a_load_broken_off_leaves_side_tables_that_hold(spark, monkeypatch):
    path = work_dir(spark, "attend")
    load.load_attendance(spark, path, attend(spark, [(n, 1, "Enrolled", _day(n)) for n in range(1, 5)]))
    batch = attend(spark, [(4, 1, "Enrolled", _day(6)), (5, 1, "Enrolled", _day(5))])
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_swap_parts", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            load.load_attendance(spark, path, batch)
    load.load_attendance(spark, path, attend(spark, [(6, 1, "Enrolled", _day(7)), (4, 1, "Enrolled", _day(7))]))
    assert values(tables.read_table(spark, path), "id", "classdate", "num")[3:] == [
        (4, dt.datetime(2024, 1, 7, 6), 5), (5, dt.datetime(2024, 1, 5, 6), 4), (6, dt.datetime(2024, 1, 7, 6), 6)
    ]


def test_ranges_and_counters(spark):
    path = work_dir(spark, "attend")
    load.load_attendance(spark, path, attend(spark, [(1, 1, "Enrolled", _day(1)), (2, 2, "Enrolled", None)]))
    load.load_attendance(spark, path, attend(spark, [(3, 1, "Enrolled", _day(2))]))
    ranges = versions.current(spark, f"{path}/{tables.RANGES}")
    assert values(ranges, "part_day", "first_id", "last_id") == [
        (tables.NO_DAY, 2, 2), (dt.date(2024, 1, 1), 1, 1), (dt.date(2024, 1, 2), 3, 3)
    ]
    counters = versions.current(spark, f"{path}/{tables.COUNTERS}")
    assert values(counters, "custid", "num", "totnum", "before") == [(1, 1, 2, dt.date(2024, 1, 2))]
    empty = attend(spark, []).withColumn(tables.PART, F.lit(None).cast("date"))
    assert kept.near_parts(spark, path, None, empty, "id") == []
