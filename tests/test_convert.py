"""Converter truth tables: literal text in, value out."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quayside.functions import convert as cv

NOON = datetime(2024, 1, 2, 3, 4, 5)
CASES = {
    "stamp": (cv.stamp, {
        "01/02/2024 03:04:05": NOON, "1/2/2024 3:04:05": NOON, "2024-01-02 03:04:05": NOON, "2024-01-02  03:04:05": NOON,
        "01/02/2024 03:04": NOON.replace(second=0), "2024-1-2 3:4": NOON.replace(second=0), "01/02/2024": None, "": None,
        "02/30/2024 00:00": None, "x": None, " 01/02/2024 03:04:05": None, "01/02/24 03:04:05": None, "01/02/2024 24:00": None}),
    "day": (cv.day, {
        "2024-01-02": date(2024, 1, 2), "01/02/2024": date(2024, 1, 2), "2024/01/02": date(2024, 1, 2),
        "01-02-2024": date(2024, 1, 2), "13/02/2024": date(2024, 2, 13), "02/03/2024": date(2024, 2, 3), "02/30/2024": None,
        "2024-01-02 00:00:00": None}),
    "person_stamp": (cv.person_stamp, {
        " 2024-01-02 03:04:05 ": NOON, "13/02/2024": datetime(2024, 2, 13), "N/A": None, "NONE": None, "none": None}),
    "person_day": (cv.person_day, {"01/02/2024 03:04:05": date(2024, 1, 2), "2024-01-02 03:04:05": None, "NULL": None}),
    "iso_stamp": (cv.iso_stamp, {"2024-01-02T03:04:05": NOON, "2024-01-02": datetime(2024, 1, 2), "N/A": None, "13/02/2024": None}),
    "number_or_zero": (cv.number_or_zero, {"1.5": 1.5, "": 0.0, "x": 0.0, "1d": 0.0, " 2 ": 2.0, "1e3": 1000.0, None: 0.0}),
    "whole": (cv.whole, {" 12 ": 12, "1.0": None, "": None, "x": None, "+7": 7, "-7": -7, "99999999999999999999": None}),
    "flag": (cv.flag, {"true": 1, "T": 1, "1": 1, "yes": 1, "Y": 1, "FALSE": 0, "f": 0, "0": 0, "no": 0, "": None, "maybe": None}),
    "whole_or": (cv.whole_or, {"1.0": 1, "1.5": 0, "NULL": 0, "N/A": 0, "NONE": 0, "": 0, "null": 0, "7": 7, "1e3": 0, "1.0e3": 1000}),
    "flag_or": (cv.flag_or, {"T": 0, "Y": 1, "no": 0, "true": 1, "": 0}),
    "tx_whole": (cv.tx_whole, {"1.9": 1, "-1.9": -1, "none": None, "": None, "x": None}),
    "tx_number": (cv.tx_number, {"1.9": 1.9, "7": 7.0, "1e3": None, "null": None}),
    "tx_flag": (cv.tx_flag, {"2": 2, "yes": 1, "T": 0, "n/a": 0, "1.9": 1}),
    "yes_no": (cv.yes_no, {"1": "Yes", "0": "No", "": "No", "yes": "No", None: "No"}),
    "boat_number": (cv.boat_number, {
        "BOAT-123": 123, "1_2": 12, "___": 0, "abc": 0, "": 0, "_1": 0, "1_": 0, "1__2": 0, None: 0, "-5": 5}),
    "text": (lambda c: cv.text(c, 3), {"  abcdef ": "abc", "   ": None, "": None, "NULL": "NUL", "\tx ": "x", "äöüß": "äöü"}),
    "worded_text": (lambda c: cv.worded_text(c, 3), {" N/A ": None, "none": "non", "NONE": None}),
    "text_or": (lambda c: cv.text_or(c, "Unknown", 4), {"": "Unknown", "NULL": "Unknown", " harbor": "harb"}),
    "loaded": (lambda c: cv.loaded(c, "decimal(10,0)").cast("int"), {"123.45": 123, "\xa07\n": 7, "2.5": 3, "-2.5": -3, "x": None, " 4 ": 4}),
}


@pytest.mark.parametrize("name", CASES)
def test_truth_table(rows, name):
    convert, table = CASES[name]
    df = rows("raw string", *[(k,) for k in table]).select("raw", convert(F.col("raw")).alias("value"))
    assert {r["raw"]: r["value"] for r in df.collect()} == table


def test_slash_text_round_trip(rows):
    df = rows("t timestamp_ntz", (NOON,)).select(cv.slash_text(F.col("t")).alias("x"))
    df = df.select("x", cv.from_slash_text(F.col("x")).alias("t"))
    assert df.first().asDict() == {"x": "02/01/2024 03:04:05", "t": NOON}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.+-eE_/: xNT", max_size=12), min_size=1, max_size=60))
def test_numbers_as_python_reads_them(rows, texts):
    """Underscores aside, a text is a number exactly when Python says so; nothing raises."""
    df = rows("raw string", *[(t,) for t in texts]).select(
        "raw", cv.number(F.col("raw")).alias("n"), cv.whole(F.col("raw")).alias("i"), cv.stamp(F.col("raw")).alias("t"))
    for r in df.collect():
        if "_" in r["raw"]:
            continue
        try:
            want = float(r["raw"])
        except ValueError:
            want = None
        assert r["n"] == want
        try:
            whole = int(r["raw"])
        except ValueError:
            whole = None
        assert r["i"] == whole
