from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D

NOW = datetime(2026, 7, 19, 12, 0, 0)
NOW_COL = F.lit("2026-07-19T12:00:00Z").cast("timestamp")
X = F.col("x")

CASES = [
    ("2 hours ago", NOW - timedelta(hours=2)),
    ("3 days ago", NOW - timedelta(days=3)),
    ("Posted 5minutes  ago!", NOW - timedelta(minutes=5)),
    ("1 month ago", NOW - timedelta(days=30)),
    ("2 WEEKS AGO", NOW - timedelta(weeks=2)),
    ("0 seconds ago", NOW),
    ("yesterday", NOW - timedelta(days=1)),
    (" Just now ", NOW),
    ("now", NOW),
    ("moments ago", NOW),
    ("Sun, 19 Jul 2026 10:00:00 GMT", datetime(2026, 7, 19, 10)),
    ("19 Jul 2026 10:00:00 +0000", datetime(2026, 7, 19, 10)),
    ("Sun, 19 Jul 2026 10:00:00 +0530", datetime(2026, 7, 19, 4, 30)),
    ("Sunday, 19 July 2026 10:00 -07:00", datetime(2026, 7, 19, 17)),
    ("19 Jul 2026 10:00:00 EST", datetime(2026, 7, 19, 10)),
    ("2026-07-19T09:30:00Z", datetime(2026, 7, 19, 9, 30)),
    ("2026-07-19T09:30:00.123456+00:00", datetime(2026, 7, 19, 9, 30, 0, 123456)),
    ("2026-07-19T07:00:00-0700", datetime(2026, 7, 19, 14)),
    ("2026-07-19 09:30", datetime(2026, 7, 19, 9, 30)),
    ("2026-07-19T09:30:15", datetime(2026, 7, 19, 9, 30, 15)),
    ("2026-7-9", datetime(2026, 7, 9)),
    ("2026/07/19", datetime(2026, 7, 19)),
    ("July 19, 2026", datetime(2026, 7, 19)),
    ("jul 19 2026 10:15", datetime(2026, 7, 19, 10, 15)),
    ("19-Jul-2026", datetime(2026, 7, 19)),
    ("07/19/2026", datetime(2026, 7, 19)),
    ("19/07/2026", datetime(2026, 7, 19)),
    ("20260719", datetime(2026, 7, 19)),
    ("Jul 19, 2026 10:30 AM", datetime(2026, 7, 19, 10, 30)),
    ("2026-07-19 10:00:00 PM", datetime(2026, 7, 19, 22)),
    ("19 Jul 2026 12:05 a.m.", datetime(2026, 7, 19, 0, 5)),
    ("July 19, 2026, 9pm", datetime(2026, 7, 19, 21)),
    ("Sun, 19 Jul 26 10:00:00 GMT", datetime(2026, 7, 19, 10)),
    ("19 Jul 99 10:00:00 GMT", datetime(1999, 7, 19, 10)),
    ("Sun Jul 19 10:00:00 2026", datetime(2026, 7, 19, 10)),
    ("Sun Jul 19 10:00:00 UTC 2026", datetime(2026, 7, 19, 10)),
    ("20260719T100000Z", datetime(2026, 7, 19, 10)),
    ("20260719T1000", datetime(2026, 7, 19, 10)),
    ("20260719T100000+0200", datetime(2026, 7, 19, 8)),
    ("0000000000005 days ago", NOW - timedelta(days=5)),
    ("000000000000000000000000000000000000000000000 days ago", NOW),
    ("2026-07-19 13:00 PM", None), ("19 Jul 26", None), ("1" * 60 + " days ago", None),
    ("", None), ("  ", None), (None, None), ("not a date at all", None), ("2026-02-30", None), ("32 Jul 2026", None),
    ("99999999999999999999 days ago", None), ("999999999999 weeks ago", None), ("13/13/2026", None),
]


def test_normalize_date(values):
    got = values([raw for raw, _ in CASES], D.normalize_date(X, NOW_COL))
    assert got == [expected for _, expected in CASES]


@pytest.mark.parametrize("age,fresh", [
    (timedelta(hours=23, minutes=59), True), (timedelta(hours=24), True), (timedelta(hours=24, seconds=1), False),
    (timedelta(hours=25), False), (timedelta(days=-3), True),
])
def test_freshness_boundary(values, age, fresh):
    assert values([NOW - age], D.is_fresh(X, NOW_COL), "timestamp") == [fresh]


def test_unknown_date_is_not_fresh(values):
    assert values([None], D.is_fresh(X, NOW_COL), "timestamp") == [False]


def test_epoch_millis(values):
    assert values([1784451600123, 0, None], D.epoch_millis(X), "bigint") == [
        datetime(2026, 7, 19, 9, 0, 0, 123000), None, None]


def test_parse_parts_alone(values):
    assert values(["2 days ago", "2026-07-19"], D.parse_relative(X, NOW_COL)) == [NOW - timedelta(days=2), None]
    assert values(["2 days ago", "2026-07-19"], D.parse_absolute(X)) == [None, datetime(2026, 7, 19)]


def test_iso_text(values):
    assert values([NOW], D.iso_utc(X), "timestamp") == ["2026-07-19T12:00:00Z"]
