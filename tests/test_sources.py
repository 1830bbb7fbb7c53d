"""Archive round trips, header CSV, dumps and staging policies on small files."""

import io
import os
import tarfile
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.operators import staging as sg
from quayside.operators.store import Store
from quayside.plans.registry import all_tables, column_name, columns_from_header, with_database_ddl
from quayside.plans.run import Warehouse
from quayside.sources import archives as ar
from quayside.sources.csv_tables import by_header, read_csv
from quayside.sources.sql_dump import read_sql_dump

PIERS = 'Id,Extra,Name,MarinaLocationId\r\n1,e,"A, ""one""\nline",5\r\n\r\n2,,,\r\n3,e,C\r\n'


def _zip(path, members, mtime):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members:
            z.writestr(name, text if isinstance(text, bytes) else text.encode())
    os.utime(path, (mtime, mtime))


def _tar(path, members):
    with tarfile.open(path, "w:gz") as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


@pytest.fixture
def drop(tmp_path):
    _zip(tmp_path / "old.zip", [("export/Piers.csv", "Id,Name\n9,old\n")], 1000)
    _zip(tmp_path / "new.ZIP", [
        ("export/Piers.csv", "Id\n8\n"), ("again/Piers.csv", PIERS), ("export/Cities.CSV", "Id,Name\n1,X\n"),
        ("export/Other.csv", "Id\n1\n"), ("export/SlipTypes.txt", "Id\n1\n")], 2000)
    (tmp_path / "newest.txt").write_text("no archive")
    return tmp_path


def test_latest_archive(spark, drop):
    listing = ar.list_archives(spark, str(drop))
    assert ar.latest_archive(listing, ".zip", ignore_case=True).first()["path"].endswith("new.ZIP")
    assert ar.latest_archive(listing, ".zip", ignore_case=False).first()["path"].endswith("old.zip")
    assert ar.latest_archive(listing, ".rar", ignore_case=True).isEmpty()


def test_zip_members(spark, drop):
    newest = ar.latest_archive(ar.list_archives(spark, str(drop)), ".zip", ignore_case=True)
    headers = {"Piers": ["Id", "Name", "marina_location_id", "gone"], "Cities": ["Name"], "SlipTypes": ["Id"]}
    records = ar.zip_records(newest, headers).cache()
    got = sorted((r["table_name"], r["record_no"], r["fields"]) for r in ar.rows_of(records).collect())
    assert got == [
        ("Cities", 0, ["X"]),
        ("Piers", 0, ["1", 'A, "one"\nline', "5", None]),
        ("Piers", 1, ["2", "", "", None]),
        ("Piers", 2, ["3", "C", None, None]),
    ]
    piers = ar.one_table(records, "Piers", headers["Piers"]).orderBy("Id").collect()
    assert piers[1].asDict() == {"Id": "2", "Name": None, "marina_location_id": None, "gone": None}
    assert [r[0] for r in ar.missing_tables(records, list(headers)).collect()] == ["SlipTypes"]
    assert [r["member"] for r in ar.skipped_members(newest, list(headers)).collect()] == ["export/Other.csv"]


def test_undecodable_bytes(spark, tmp_path):
    _zip(tmp_path / "a.zip", [("Piers.csv", b"Id,Name\n1,caf\xe9\n")], 1000)
    one = ar.list_archives(spark, str(tmp_path))
    assert ar.rows_of(ar.zip_records(one, {"Piers": ["Name"]}, on_bad_utf8="drop")).first()["fields"] == ["caf"]
    with pytest.raises(Exception, match="utf-8"):
        ar.zip_records(one, {"Piers": ["Name"]}).collect()


def test_tar_members(spark, tmp_path):
    _tar(tmp_path / "x-DATA.sql.gz", {
        "data/holidays.csv": b"location_id,holiday_date\n5,2024-01-01\n5,2024-12-25\n", "data/coupons.csv": b"id,code\n",
        "other/styles.csv": b"id\n1\n"})
    headers = {"holidays": ["location_id", "holiday_date"], "coupons": ["id"], "styles": ["id"]}
    records = ar.tar_records(ar.list_archives(spark, str(tmp_path)), headers)
    assert sorted(r["fields"] for r in ar.rows_of(records).collect()) == [["5", "2024-01-01"], ["5", "2024-12-25"]]


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "piers.csv").write_bytes(PIERS.encode())
    got = by_header(read_csv(spark, str(tmp_path / "piers.csv")), {"name": "NAME", "marina": "marina_location_id", "gone": "Nowhere"}).collect()
    assert [tuple(r) for r in got] == [('A, "one"\nline', "5", None), (None, None, None), ("C", None, None)]


def test_sql_dump(spark, tmp_path):
    (tmp_path / "dump.sql").write_text(
        "CREATE TABLE `customers` (id int);\nINSERT INTO `customers` VALUES (1,'O\\'Neil, (x)',2.5,NULL),(2,'back\\\\slash',x,'NULL');\n"
        "insert into `CUSTOMERS` values (3,'',-1,'y');\nINSERT INTO `customers_old` VALUES (4,'n',0,'n');\n")
    got = read_sql_dump(spark, str(tmp_path / "dump.sql"), "customers", "id bigint, name string, n double, s string").collect()
    assert sorted(tuple(r) for r in got) == [(1, "O'Neil, (x)", 2.5, None), (2, "back\\slash", None, "NULL"), (3, "", -1.0, "y")]


def test_sql_dump_escapes(spark, tmp_path):
    long = "x, (y) " * 50_000
    (tmp_path / "dump.sql").write_text(
        r"INSERT INTO `customers` VALUES (4,'it''s\n(a) \\n', 1.5 , 'q\''), (5, now(1,2), 0, ',');" + "\n"
        + f"INSERT INTO `customers` VALUES (6,'{long}',2,'''');\n")
    got = read_sql_dump(spark, str(tmp_path / "dump.sql"), "customers", "id bigint, name string, n double, s string").collect()
    assert sorted(tuple(r) for r in got) == [(4, "it's\n(a) \\n", 1.5, "q'"), (5, "now(1,2)", 0.0, ","), (6, long, 2.0, "'")]


# --- files read by ranges

def _random_csv(rnd, n):
    fields = lambda: [rnd.choice(['a', '', 'b c', 'é' * 5, 'say ""x""', 'line\nfeed', 'line\r\nfeed', ',', '""', '\n\n', 'x' * 70]) for _ in range(3)]
    return "".join(",".join([str(i), *(f'"{f}"' for f in fields())]) + rnd.choice(["\n", "\r\n", "\n\n"]) for i in range(n))


@pytest.mark.parametrize("size", [1, 13, 200, 1 << 20])
def test_csv_ranges_equal_one_task(spark, tmp_path, size):
    import random

    rnd = random.Random(size)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_bytes(("id,A,b,a\n" + _random_csv(rnd, 60 * i)).encode()[:None if i < 2 else -1])  # one empty, one without a last line feed
    got = read_csv(spark, str(tmp_path), range_bytes=size)
    want = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path))
    assert got.columns == want.columns == ["id", "A1", "b", "a3"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 180


def test_csv_ranges_go_to_several_tasks(spark, tmp_path):
    from quayside.sources.ranges import records

    (tmp_path / "a.csv").write_text("id,t\n" + "".join(f'{i},"{i}\n{i}"\n' for i in range(2000)))
    parts = records(spark, str(tmp_path / "a.csv"), "csv", 1000).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 4 and sum(r["count"] for r in parts) == 2001


def test_an_empty_csv_has_no_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_csv(spark, str(tmp_path)).columns == []


@pytest.mark.parametrize("size", [1, 37, 300, 1 << 20])
def test_dump_ranges_equal_plain_parsing(spark, tmp_path, size):
    import random

    rnd = random.Random(size)
    texts = ["a;\nb", "it''s", "x\\'y;\n", "(a), (b)", "end\\\\", "-- no comment", ";\nINSERT INTO `t` VALUES (9,'no')", "", "`tick", "é" * 30]
    plain = {"it''s": "it's", "x\\'y;\n": "x'y;\n", "end\\\\": "end\\"}
    dump, want = "-- it's a dump\n/*!40101 SET x='y' */;\n", []
    for i in range(80):
        some = [(i * 10 + k, rnd.choice(texts)) for k in range(rnd.choice([1, 1, 3]))]
        want += [(k, plain.get(t, t)) for k, t in some]
        dump += rnd.choice(["", "\n", "-- don't\n", "LOCK TABLES `t` WRITE;\n"]) + "INSERT INTO `t` VALUES" + rnd.choice([" ", "\n"]) + ",\n".join(
            f"({k},'{t}')" for k, t in some) + ";" + rnd.choice(["\n", "\r\n", " \n"])
    (tmp_path / "d.sql").write_bytes((dump + "INSERT INTO `t` VALUES (5000,'last')").encode())
    got = read_sql_dump(spark, str(tmp_path / "d.sql"), "t", "id bigint, note string", range_bytes=size)
    assert sorted(map(tuple, got.collect())) == sorted([*want, (5000, "last")])


def test_members_are_cut_at_records_whatever_the_chunks(spark, tmp_path, monkeypatch):
    import random

    text = "Id,A,B,C\n" + _random_csv(random.Random(3), 200)
    _zip(tmp_path / "a.zip", [("Piers.csv", text)], 1000)
    one, headers = ar.list_archives(spark, str(tmp_path)), {"Piers": ["c", "id"]}
    whole = sorted(map(str, ar.rows_of(ar.zip_records(one, headers)).collect()))
    monkeypatch.setattr(ar, "_CHUNK", 17)
    assert sorted(map(str, ar.rows_of(ar.zip_records(one, headers)).collect())) == whole and len(whole) == 200
    import csv

    plain = [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    got = {r["record_no"]: r["fields"] for r in ar.rows_of(ar.zip_records(one, headers)).collect()}
    assert [got[i] for i in range(200)] == [[r[3], r[0]] for r in plain]


# --- registry, conversion, staging -----------------------------------------------

def test_registry():
    specs = all_tables()
    assert len(specs) == 79 and sum(s.system == "marina" for s in specs.values()) == 50
    assert sum(s.at_once for s in specs.values()) == 19 and sum(s.change_test for s in specs.values()) == 33
    assert specs["holidays"].keys == ("location_id", "holiday_date") and specs["customers"].keys == ("user_id",)
    assert "checkin_notes" not in specs["booking_boats"].merge.compare and specs["slip_types"].merge.compare is None
    with pytest.raises(ValueError, match="no staging schema"):
        specs["styles"].columns


def test_schema_by_naming_rule(spark):
    assert [column_name(h) for h in ("MarinaLocationId", "Pier_Id", "HashID", "LOA", "boat_id", "QBOVendorId")] == [
        "marina_location_id", "pier_id", "hash_id", "loa", "boat_id", "qbo_vendor_id"]
    types = [f.dataType.simpleString() for f in columns_from_header(["Id", "CreationTime", "IsActive", "TaxTotal", "Notes"])]
    assert types == ["bigint", "timestamp_ntz", "int", "double", "varchar(1000)"]


def test_database_ddl(spark):
    ddl = """CREATE TABLE STG_ANY_STYLES (
        ID NUMBER(10,0), -- key
        LABEL NVARCHAR2(40) NOT NULL,
        TAX NUMBER(9,2),
        SHOWN NUMBER(1,0) DEFAULT 0,
        TOTAL NUMBER(20,0),
        FEE BINARY_DOUBLE,
        MADE_ON DATE,
        MADE_AT TIMESTAMP,
        NOTE NCLOB
    );
    CREATE TABLE UNKNOWN (
        ID NUMBER
    );"""
    specs = with_database_ddl(all_tables(), ddl)
    styles = specs["styles"]
    assert [(f.name, f.dataType.simpleString()) for f in styles.schema] == [
        ("id", "bigint"), ("label", "varchar(40)"), ("tax", "decimal(9,2)"), ("shown", "int"), ("total", "decimal(20,0)"),
        ("fee", "double"), ("made_on", "date"), ("made_at", "timestamp_ntz"), ("note", "string")]
    assert styles.merge.compare == tuple(f.name for f in styles.schema)[:-1] and "unknown" not in specs
    assert [c.name for c in styles.columns if c.required] == ["label"]


def test_members_go_to_several_tasks(spark, drop):
    newest = ar.latest_archive(ar.list_archives(spark, str(drop)), ".zip", ignore_case=True)
    tasks = ar.zip_records(newest, {"Piers": ["Id"], "Cities": ["Id"]}).rdd.getNumPartitions()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_required_values(spark, rows):
    good, bad = sg.convert_table(rows("Id string, Name string", ("1", "Wet"), ("2", " ")), all_tables()["slip_types"])
    assert [r["id"] for r in good.collect()] == [1] and bad.first()["_bad_columns"] == ["name"]


def test_text_lengths(spark, rows):
    spec = all_tables()["piers"].with_schema("id bigint, name varchar(3)")
    assert sg.convert_table(rows("Id string, Name string", ("1", "abcdef")), spec)[0].first()["name"] == "abc"
    spec = all_tables()["style_boats"].with_schema("id bigint, boat_number varchar(3)")
    good, bad = sg.convert_table(rows("id string, boat_number string", ("1", "abcd"), ("2", "abc")), spec)
    assert good.first()["id"] == 2 and bad.first()["_bad_columns"] == ["boat_number"]


def test_archive_to_warehouse(spark, tmp_path):
    """Both systems from their archives to the warehouse, twice; a table the second archive lacks stays."""
    drop, root = tmp_path / "drop", str(tmp_path / "wh")
    drop.mkdir()
    specs = all_tables()
    marina = {n: specs[n] for n in ("piers", "slip_types", "reservations")}
    rental = {n: specs[n] for n in ("holidays", "style_boats", "coupons")}
    rental["coupons"] = rental["coupons"].with_schema("id bigint, code varchar(10)")
    wh = Warehouse(spark, root)
    assert wh.unpack(str(drop), "marina", marina) == {}

    _zip(drop / "1.zip", [
        ("x/Piers.csv", PIERS), ("x/SlipTypes.csv", "Id,Name\n1,Wet\n2,\n"),
        ("x/Reservations.csv", "Id,SlipId,Rate,ScheduledArrivalTime\n1,5,123.45,01/02/2024 03:04:05\n2,oops,1,\n")], 1000)
    _tar(drop / "1-DATA.sql.gz", {"data/holidays.csv": b"location_id,holiday_date\n5,2024-01-01\n5,2024-12-25\n",
                                  "data/coupons.csv": b"id,code\n", "data/style_boats.csv": b"id,boat_number\n1,A\n"})
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    loaded = wh.load(wh.unpack(str(drop), "marina", marina), marina, t1).unionByName(
        wh.load(wh.unpack(str(drop), "rental", rental), rental, t1))
    assert {r["table_name"]: (r["records"], r["outcome"]) for r in loaded.collect()} == {
        "piers": (3, "replaced"), "slip_types": (1, "replaced"), "reservations": (1, "replaced"),
        "holidays": (2, "replaced"), "style_boats": (1, "replaced"), "coupons": (0, "left as it was")}
    messages = {r["table_name"]: r["message"] for r in loaded.collect()}
    assert messages["coupons"] == "No data rows in CSV file"  # its member holds a header only
    report = {r["table_name"]: (r["bad_rows"], r["columns_not_found"]) for r in loaded.collect()}
    assert report["reservations"][0] == 1 and "boat_id" in report["reservations"][1] and report["holidays"] == (0, None)
    assert sg.set_aside(wh.staging, "reservations").first()["_bad_columns"] == ["slip_id"]
    wh.merge_all({**marina, **rental}, t1, skip_at_once=True)
    r = wh.tables.read("reservations").first()
    assert (int(r["rate"]), r["scheduled_arrival_time"], r["dw_id"]) == (123, datetime(2024, 1, 2, 3, 4, 5), 1)

    _zip(drop / "2.zip", [("x/Piers.csv", "Id,Name\n1,New\n4,D\n")], 2_000_000_000)
    wh.load(wh.unpack(str(drop), "marina", marina), {"piers": marina["piers"]}, t2)
    stats = {r["table_name"]: (r["inserted"], r["updated"], r["kept"]) for r in wh.merge_all({**marina, **rental}, t2).collect()}
    assert stats["holidays"] == (0, 2, 0)  # unconditional; composite key, so no ambiguity
    assert sorted((r["dw_id"], r["id"], r["name"]) for r in wh.tables.read("piers").collect())[3:] == [(4, 4, "D")]


def test_a_whole_day_is_checked_and_leaves_no_scratch(spark, tmp_path):
    drop, root = tmp_path / "drop", tmp_path / "wh"
    drop.mkdir()
    _zip(drop / "1.zip", [("x/Piers.csv", PIERS), ("x/SlipTypes.csv", "Id,Name\n1,Wet\n")], 1000)
    _tar(drop / "1-DATA.sql.gz", {"data/style_boats.csv": b"id,boat_number\n1,A\n2,B\n"})
    specs = {n: all_tables()[n] for n in ("piers", "slip_types", "style_boats")}
    wh = Warehouse(spark, str(root))
    loaded, merged, checked = wh.run(str(drop), specs, datetime(2024, 1, 1))
    assert {r["table_name"]: r["records"] for r in loaded.collect()} == {"piers": 3, "slip_types": 1, "style_boats": 2}
    assert {r["table_name"]: r["inserted"] for r in merged.collect()}["style_boats"] == 2
    assert {r["table_name"] for r in checked.collect()} == set(specs) and all(r["passed"] for r in checked.collect())
    assert not list(root.rglob("landing-*")) and {n: df.count() for n, df in wh.tables.read_together().items()} == {
        "piers": 3, "slip_types": 1, "style_boats": 2}


def test_failed_tables(spark, rows, tmp_path):
    """A failing marina table is emptied, a failing rental one stays; neither stops the others."""
    store, specs = Store(spark, str(tmp_path)), {n: all_tables()[n] for n in ("reservations", "holidays", "piers")}
    good = {"reservations": rows("Id string", ("1",)), "holidays": rows("location_id string, holiday_date string", ("1", "2024-01-01")),
            "piers": rows("Id string", ("1",))}
    sg.load_all(store, good, specs)
    bad = {"reservations": rows("Id string", ("x",)), "holidays": rows("location_id string, holiday_date string", ("1", "soon"))}
    outcome = {r["table_name"]: r["outcome"] for r in sg.load_all(store, bad, specs, on_bad_rows="fail").collect()}
    assert outcome == {"reservations": "failed", "holidays": "failed", "piers": "emptied"}
    assert {n: sg.staged(store, n).count() for n in specs} == {"reservations": 0, "holidays": 1, "piers": 0}


def test_stamped_dates(spark, tmp_path):
    from datetime import date

    spec = all_tables()["boats"].with_schema("id bigint, registration_expiration date")
    wh = Warehouse(spark, str(tmp_path))
    raw = spark.createDataFrame([("1", "13/02/2024")], "Id string, RegistrationExpiration string")
    wh.load({"boats": raw}, {"boats": spec}, datetime(2024, 1, 1))
    assert sg.staged(wh.staging, "boats").first()["registration_expiration"] == date(2024, 2, 13)
    assert wh.tables.read("boats").first()["registration_expiration"] == datetime(2024, 2, 13)


def test_replace_policies(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path))
    full, empty = rows("a int", (1,)), rows("a int")
    sg.stage(store, "t", full, only_if_filled=True)
    assert sg.stage(store, "t", empty, only_if_filled=True).first()["message"] == "No data rows in CSV file"
    assert sg.staged(store, "t").count() == 1
    sg.stage(store, "t", empty)
    assert sg.staged(store, "t").count() == 0
