"""Strict CSV, load modes at rest, the load of a site."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from frames import attend, sale, ts, values
from pyspark.sql import functions as F

from studiolens import schema
from studiolens.plans import load
from studiolens.session import work_dir
from studiolens.sources import exports, tables, versions

HEAD = "DT,CUSTID,PMTYPE,TOTAL,ITEM,TYP,FIRST,LAST,STUDIO"
GOOD = '2014-07-08 06:00:00.0,7,"Card",75.0,"Shirt, ""blue""",retail,Ann,,"Main"'


@pytest.fixture
def write(tmp_path):
    def put(*lines, encoding="utf-8"):
        path = tmp_path / "export.csv"
        path.write_bytes("\r".join(lines).encode(encoding))
        return str(path)

    return put


def test_quotes_commas_blanks_and_a_blank_last_line(spark, write):
    rows = exports.read_export(spark, write(HEAD, GOOD, ""), schema.SALES).collect()
    assert len(rows) == 1
    row = rows[0]
    assert row.item == 'Shirt, "blue"' and row.lastname is None and row.custid == 7
    assert row.dt == ts("2014-07-08 06:00:00") and row.total == Decimal("75.00")


@pytest.mark.parametrize("bad", ["2014-07-08 06:00:00.0,7,Card", GOOD + ",x"])
def test_one_row_of_another_length_fails_the_file(spark, write, bad):
    df = exports.read_export(spark, write(HEAD, GOOD, bad), schema.SALES)
    with pytest.raises(Exception, match="(?i)malformed"):
        df.select("custid").collect()


def test_a_value_of_another_type_fails_the_file(spark, write):
    df = exports.read_export(spark, write(HEAD, GOOD.replace(",7,", ",seven,")), schema.SALES)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


def test_encoding_is_a_parameter(spark, write):
    path = write(HEAD, GOOD.replace("Ann", "Zoé"), encoding="latin-1")
    row = exports.read_export(spark, path, schema.SALES, encoding="ISO-8859-1").first()
    assert row.firstname == "Zoé"


def test_missing_header_names_are_refused(spark, write):
    names = schema.ATTENDANCE_HEADER
    with pytest.raises(ValueError, match="CUSTOMERID"):
        exports.read_export(spark, write(HEAD, GOOD), schema.ATTENDANCE, required_header=names)


def test_header_names_must_stand_in_their_places(spark, write):
    names = {"dt": "DT", "custid": "CUSTID"}
    good = exports.read_export(spark, write(HEAD, GOOD), schema.SALES, required_header=names)
    assert good.count() == 1
    swapped = HEAD.replace("DT,CUSTID", "CUSTID,DT")
    with pytest.raises(ValueError, match="DT, CUSTID"):
        exports.read_export(spark, write(swapped, GOOD), schema.SALES, required_header=names)


def test_text_keeps_its_blanks_and_numbers_lose_them(spark, write, tmp_path):
    line = GOOD.replace("Ann", "  Ann ").replace(",7,", ", 7 ,").replace("75.0", " 75.0").replace(",,", ',"  ",')
    row = exports.read_export(spark, write(HEAD, line), schema.SALES).first()
    assert (row.firstname, row.lastname, row.custid, row.total) == ("  Ann ", "  ", 7, Decimal("75.00"))
    df = spark.createDataFrame([row], schema.SALES)
    exports.write_export(df, str(tmp_path / "back"), schema.SALES)
    assert exports.read_export(spark, str(tmp_path / "back"), schema.SALES).first() == row


def test_a_bad_file_leaves_the_table_as_it_is(spark, write):
    path = work_dir(spark, "sale")
    versions.full_refresh(exports.read_export(spark, write(HEAD, GOOD), schema.SALES), path)
    for bad in ("2014-07-08 06:00:00.0,7,Card", GOOD.replace(",7,", ",seven,")):
        with pytest.raises(Exception, match="(?i)malformed|CAST_INVALID_INPUT"):
            versions.full_refresh(exports.read_export(spark, write(HEAD, GOOD, bad), schema.SALES), path)
        assert versions.current(spark, path).count() == 1
    again = versions.current(spark, path)
    versions.full_refresh(again.unionByName(again), path)  # a table may be made from itself
    assert versions.current(spark, path).count() == 2
    # The version before stays for its readers, nothing else does.
    assert len([name for name in os.listdir(path) if name.startswith("_rows-")]) == 2


def test_a_reader_sees_one_whole_version(spark):
    path = work_dir(spark, "cust")
    assert versions.current(spark, path) is None
    versions.full_refresh(spark.range(3), path)
    reading = versions.current(spark, path)
    # A load that is killed before its marker is there.
    spark.range(100, 200).write.parquet(f"{path}/_rows-{2:012d}-killed")
    assert versions.current(spark, path).count() == 3
    versions.full_refresh(spark.range(5), path)
    assert (reading.count(), versions.current(spark, path).count()) == (3, 5)
    for n in range(6, 18):
        versions.full_refresh(spark.range(n), path)
        assert versions.current(spark, path).count() == n


def _break_off(monkeypatch):
    """The process ends after the new files are committed, before emptied days are removed."""

    def killed(spark, path):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "remove_dir", killed)


def test_a_broken_off_replace_is_finished_by_the_next_load(spark, monkeypatch):
    path = work_dir(spark, "sale")
    times = ["2024-01-01 09:00:00", "2024-01-02 09:00:00", "2024-01-03 09:00:00", None]
    old = spark.createDataFrame([(i, ts(t) if t else None) for i, t in enumerate(times)], "id int, dt timestamp_ntz")
    new = spark.createDataFrame(
        [(10, ts(times[0])), (11, ts(times[2])), (12, None)], "id int, dt timestamp_ntz"
    )
    tables.replace_range_at(spark, path, old, "dt")
    with monkeypatch.context() as patch:
        _break_off(patch)
        with pytest.raises(KeyboardInterrupt):
            tables.replace_range_at(spark, path, new, "dt")
    assert os.path.exists(f"{path}/part_day=2024-01-02")
    tables.recover(spark, path)
    want = [(3,), (10,), (11,), (12,)]
    assert sorted(values(tables.read_table(spark, path), "id")) == want
    assert not os.path.exists(f"{path}/part_day=2024-01-02")
    assert all(name.startswith("part_day") for name in os.listdir(path) if not name.startswith((".", "_SUCCESS")))
    tables.recover(spark, path)
    assert sorted(values(tables.read_table(spark, path), "id")) == want


@pytest.mark.parametrize("begun", [True, False])
def test_a_broken_off_upsert_is_finished_by_the_next_load(spark, monkeypatch, begun):
    path = work_dir(spark, "attend")
    old = attend(spark, [(1, 1, "Enrolled", "2024-01-01 06:00:00"), (2, 1, "Enrolled", "2024-01-02 06:00:00")])
    new = attend(spark, [(1, 1, "Cancelled", "2024-01-03 06:00:00"), (3, 1, "Enrolled", None)])
    tables.upsert_at(spark, path, old, ["id"], "classdate")
    with monkeypatch.context() as patch:
        if begun:
            _break_off(patch)
        else:
            patch.setattr(tables, "_swap_parts", lambda *_: _break_off(patch) or tables.remove_dir(None, None))
        with pytest.raises(KeyboardInterrupt):
            tables.upsert_at(spark, path, new, ["id"], "classdate")
    tables.upsert_at(spark, path, attend(spark, [(4, 1, "Enrolled", "2024-01-05 06:00:00")]), ["id"], "classdate")
    assert values(tables.read_table(spark, path), "id", "status") == [
        (1, "Cancelled"), (2, "Enrolled"), (3, "Enrolled"), (4, "Enrolled")
    ]
    assert not os.path.exists(f"{path}/part_day=2024-01-01")


def test_ids_are_looked_up_within_the_range_of_the_batch(spark):
    stored = spark.createDataFrame([(i, i) for i in range(10)], "id long, v int")
    path = work_dir(spark, "ids")
    stored.write.parquet(path)
    near = tables.matching(spark.read.parquet(path), stored.where("id in (3, 5)"), ["id"])
    assert values(near, "id") == [(3,), (4,), (5,)]
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,3)" in plan and "LessThanOrEqual(id,5)" in plan
    assert tables.matching(stored, stored.limit(0), ["id"]).count() == 0


def test_leading_zeros_stay(spark, tmp_path):
    row = [""] * len(schema.CUSTOMERS)
    row[[f.name for f in schema.CUSTOMERS].index("zip")] = "06877"
    path = tmp_path / "c.csv"
    path.write_text("\r".join([",".join(f.name for f in schema.CUSTOMERS), ",".join(row)]))
    assert exports.read_export(spark, str(path), schema.CUSTOMERS).first().zip == "06877"


def test_lines(spark):
    df = spark.createDataFrame([("a@x",), ("b@x",)], "emailaddress string")
    path = work_dir(spark, "lines")
    assert exports.write_lines(df, path) == 2
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a@x", "b@x"]


def _sales(spark, *days, total="1.00"):
    return sale(spark, [(d, 1, "Card", total, "x", "t") for d in days])


def test_range_replace_also_empties_days_without_new_rows(spark):
    path = work_dir(spark, "sale")
    old = ["2014-07-01 09:00:00", "2014-07-01 12:00:00", "2014-07-02 10:00:00",
           "2014-07-03 08:00:00", "2014-07-03 20:00:00", "2014-07-04 10:00:00"]
    tables.replace_range_at(spark, path, _sales(spark, *old), "dt")
    new = ["2014-07-01 12:00:00", "2014-07-03 08:00:00"]
    for _ in range(2):  # loading twice changes nothing more
        tables.replace_range_at(spark, path, _sales(spark, *new, total="2.00"), "dt")
        assert values(tables.read_table(spark, path), "dt", "total") == [
            (ts("2014-07-01 09:00:00"), Decimal("1.00")),
            (ts("2014-07-01 12:00:00"), Decimal("2.00")),
            (ts("2014-07-03 08:00:00"), Decimal("2.00")),
            (ts("2014-07-03 20:00:00"), Decimal("1.00")),
            (ts("2014-07-04 10:00:00"), Decimal("1.00")),
        ]
    assert not os.path.exists(f"{path}/part_day=2014-07-02")


def test_range_replace_rewrites_only_days_of_the_range(spark):
    path = work_dir(spark, "sale")
    tables.replace_range_at(
        spark, path, _sales(spark, "2014-07-01 09:00:00", "2014-07-09 09:00:00"), "dt"
    )
    before = sorted(os.listdir(f"{path}/part_day=2014-07-01"))
    tables.replace_range_at(spark, path, _sales(spark, "2014-07-09 09:00:00"), "dt")
    assert sorted(os.listdir(f"{path}/part_day=2014-07-01")) == before


def test_an_empty_file_replaces_nothing(spark):
    old = _sales(spark, "2014-07-01 09:00:00")
    assert tables.replace_range(old, old.where("false"), "dt").count() == 1


NEVER = None
OLD = [("2014-07-01 09:00:00", 1), (NEVER, 2), ("2014-07-03 09:00:00", 3)]


@pytest.mark.parametrize(
    "batch",
    [
        [(NEVER, 9)],
        [(NEVER, 9), ("2014-07-03 10:00:00", 4)],
        [("2014-07-03 09:00:00", 4)],
        [("2014-07-01 09:00:00", 5), (NEVER, 6), ("2014-07-05 09:00:00", 7)],
        [],
    ],
)
@pytest.mark.parametrize("grain", ["day", "month"])
def test_rows_without_a_time_are_never_lost(spark, batch, grain):
    """Both forms agree, on batches with, without and of nothing but such rows."""

    def frame(rows):
        return sale(spark, [(d, n, "Card", "1.00", "x", "t") for d, n in rows or OLD]).where(F.lit(bool(rows)))

    for load, whole in (
        (lambda p, df: tables.replace_range_at(spark, p, df, "dt", grain), lambda a, b: tables.replace_range(a, b, "dt")),
        (lambda p, df: tables.upsert_at(spark, p, df, ["custid"], "dt", grain=grain), lambda a, b: tables.upsert(a, b, ["custid"])),
    ):
        path = work_dir(spark, "sale")
        load(path, frame(OLD))
        load(path, frame(batch))
        want = values(whole(frame(OLD), frame(batch)), "custid", "dt")
        assert values(tables.read_table(spark, path), "custid", "dt") == want
        assert {n for _, n in batch} <= {r[0] for r in want}
        assert (2, None) in want


def test_attendance_without_a_customer_is_refused(spark):
    path = work_dir(spark, "attend")
    load.load_attendance(spark, path, attend(spark, [(1, 1, "Enrolled", "2024-01-01 06:00:00")]))
    bad = attend(spark, [(2, 1, "Enrolled", "2024-01-02 06:00:00"), (3, None, "Enrolled", "2024-01-02 06:00:00")])
    with pytest.raises(Exception, match="without a customer"):
        load.load_attendance(spark, path, bad)
    assert tables.read_table(spark, path).count() == 1


def test_upsert_moves_a_row_to_its_new_day(spark):
    path = work_dir(spark, "attend")
    old = attend(spark, [(1, 1, "Enrolled", "2024-01-01 06:00:00"),
                         (2, 1, "Enrolled", "2024-01-02 06:00:00")])
    new = attend(spark, [(1, 1, "Cancelled", "2024-01-03 06:00:00")])
    tables.upsert_at(spark, path, old, ["id"], "classdate")
    tables.upsert_at(spark, path, new, ["id"], "classdate")
    assert values(tables.read_table(spark, path), "id", "status", "classdate") == [
        (1, "Cancelled", ts("2024-01-03 06:00:00")), (2, "Enrolled", ts("2024-01-02 06:00:00"))
    ]
    assert not os.path.exists(f"{path}/part_day=2024-01-01")


def test_last_write_wins_within_a_file(spark):
    target = spark.createDataFrame([(1, 1, "old")], "k int, v int, s string")
    incoming = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (2, 1, "c")], target.schema)
    assert values(tables.upsert(target, incoming, ["k"], latest_by="v"), "k", "v", "s") == [
        (1, 3, "b"), (2, 1, "c")
    ]


def _attendance_file(spark, df, name):
    path = work_dir(spark, name)
    exports.write_export(df, path, schema.ATTENDANCE, schema.ATTENDANCE_HEADER)
    return path


def test_site_load_numbers_on_and_keeps_sites_apart(spark):
    store = work_dir(spark, "store")
    people = spark.createDataFrame(
        [(1, "a@x", dt.date(1990, 1, 1))], "id bigint, emailaddress string, birthdate date"
    )
    series = spark.createDataFrame([("a@x", "Ten", 10, 4)], "emailaddress string, series string,"
                                   " count int, remaining int")  # fmt: skip
    first = attend(spark, [(1, 1, "Enrolled", "2024-01-01 06:00:00"),
                           (2, 1, "Cancelled", "2024-01-02 06:00:00"),
                           (3, 2, "Enrolled", "2024-01-02 06:00:00")])
    # Row 3 comes again as cancelled: it is taken out of the counts before numbering goes on.
    second = attend(spark, [(3, 2, "Cancelled", "2024-01-02 06:00:00"),
                            (4, 1, "Enrolled", "2024-01-03 06:00:00")])
    paths = {
        "series": work_dir(spark, "s"), "customers": work_dir(spark, "c"),
        "sales": work_dir(spark, "v"),
    }
    exports.write_export(series, paths["series"], schema.OPEN_SERIES)
    exports.write_export(people, paths["customers"], schema.CUSTOMERS)
    exports.write_export(_sales(spark, "2024-01-01 09:00:00"), paths["sales"], schema.SALES)
    for site, batches in {"north": [first, second], "south": [first]}.items():
        for batch in batches:
            files = load.SiteFiles(attendance=_attendance_file(spark, batch, "a"), **paths)
            load.ingest(spark, site, files, store)
    stored = spark.read.parquet(f"{store}/attend")
    assert values(stored, "site", "id", "status", "num", "totnum") == [
        ("north", 1, "Enrolled", 1, 1), ("north", 2, "Cancelled", 1, 1),
        ("north", 3, "Cancelled", 0, 1), ("north", 4, "Enrolled", 2, 2),
        ("south", 1, "Enrolled", 1, 1), ("south", 2, "Cancelled", 1, 1),
        ("south", 3, "Enrolled", 1, 2),
    ]
    assert spark.read.parquet(f"{store}/sale").groupBy("site").count().where("count = 1").count() == 2
    assert versions.current_sites(spark, f"{store}/cust").where(F.col("id") == 1).count() == 2


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session(), "x")


def test_exports_of_all_sites_come_from_one_pass(spark, tmp_path):
    rows = [(1, 1, "Enrolled", "2024-01-05 06:00:00"), (2, 2, "Enrolled", None), (3, None, "Enrolled", None), (4, 3, "Cancelled", None)]
    df = attend(spark, rows)
    site, table = F.col("custid") % 2, schema.ATTENDANCE
    for wanted, name in (([0, 1], "both"), ([0, 1, 7], "empty")):
        places = exports.write_site_exports(df, site, wanted, f"{tmp_path}/{name}", table, schema.ATTENDANCE_HEADER)
        assert list(places) == wanted
        for one, place in places.items():
            exports.write_export(df.where(site == one), f"{tmp_path}/{name}-{one}", table, schema.ATTENDANCE_HEADER)
            got, want = (
                exports.read_export(spark, p, table, required_header=schema.ATTENDANCE_HEADER)
                for p in (place, f"{tmp_path}/{name}-{one}")
            )
            assert got.columns == want.columns
            assert values(got, *want.columns) == values(want, *want.columns)
