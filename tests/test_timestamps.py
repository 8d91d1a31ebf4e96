import random
from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from siftwork.operators import timestamps as ts

CRAWL = "2024-03-31T10:00:00Z"

VALUES = [
    ("2020-01-31T08:05:09.987+01:00", "2020-01-31T07:05:09Z"),
    ("2020-01-31 08:05", "2020-01-31T07:05:00Z"),
    ("2020-07-31T08:05:09-0500", "2020-07-31T13:05:09Z"),
    ("2020-07-31 08:05:09 CEST", "2020-07-31T06:05:09Z"),
    ("28.03.2010 01:04", "2010-03-28T00:04:00Z"),
    ("23/12/2010 23:24:52", "2010-12-23T22:24:52Z"),
    ("28 wrz 2016, o 04:44", "2016-09-28T02:44:00Z"),
    ("5 października 2012 2:39", "2012-10-05T00:39:00Z"),
    ("5 PAŹDZIERNIKA 2012 2:39", "2012-10-05T00:39:00Z"),
    ("Wed, 01 Feb 2012 19:58:25 +0000", "2012-02-01T19:58:25Z"),
    ("środa, 1 lutego 2012 19:58", "2012-02-01T18:58:00Z"),
    ("poniedziałkowego 2 lipca 2012 10:00", "2012-07-02T08:00:00Z"),
    ("Feb 29, 2016 at 6:26 AM", "2016-02-29T05:26:00Z"),
    ("12 Mar 2016, 12:58", "2016-03-12T11:58:00Z"),
    ("1462842895", "2016-05-10T01:14:55Z"),
    ("1462842895.25", "2016-05-10T01:14:55Z"),
    ("1389816655788", "2014-01-15T20:10:55Z"),
    ("99999999999", "1973-03-03T09:46:39Z"),
    ("1389816655788999", "2014-01-15T20:10:55Z"),
    ("1389816655788999111", "2014-01-15T20:10:55Z"),
    ("20200131T080509Z", "2020-01-31T08:05:09Z"),
    ("20200131T0805+0100", "2020-01-31T07:05:00Z"),
    ("20200131080509", "2020-01-31T07:05:09Z"),
    ("2016-12-31T23:59:60Z", "2017-01-01T00:00:00Z"),
    ("2020-01-31T08:05:09+01:00[Europe/Warsaw]", "2020-01-31T07:05:09Z"),
    ("2020-07-31 08:05 America/New_York", "2020-07-31T12:05:00Z"),
    ("31.01.20 08:05", "2020-01-31T07:05:00Z"),
    ("31.01.98 08:05", "1998-01-31T07:05:00Z"),
    ("wczoraj, o 18:08", "2024-03-30T17:08:00Z"),
    ("dziś 03:30", "2024-03-31T01:30:00Z"),
    ("Today at 1:32 AM", "2024-03-31T00:32:00Z"),
    ("2 godziny temu", "2024-03-31T08:00:00Z"),
    ("an hour ago", "2024-03-31T09:00:00Z"),
    ("2024-03-31 02:30", "2024-03-31T01:30:00Z"),  # skipped: the offset before
    ("2024-10-27 02:30", "2024-10-27T00:30:00Z"),  # twice: the earlier
    ("0000-00-00 00:00", None),
    ("2019-02-29 10:00", None),
    ("1900-02-29 10:00", None),
    ("2019-01-01 25:00", None),
    ("2019-01-01 10:30:60", None),
    ("2020-01-31 08:05 Nowhere/Land", None),
    ("2020-01-31", None),
    ("12:58 PM", None),
    ("99999999999999999999 days ago", None),
    ("13:00", None),
    ("brak daty", None),
    ("", None),
    ("  ", None),
    ("7" * 5000, None),
    (None, None),
]


def utc(spark, rows):
    """The instants of rows (value, zone, order, crawled)."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v string, z string, o string, c string")
    return [r.utc for r in ts.normalise_times(df, "v", "z", "utc", "o", "c").orderBy("i").collect()]


def test_values(spark):
    got = utc(spark, [(v, "Europe/Warsaw", "dmy", CRAWL) for v, _ in VALUES])
    assert [(v, g) for (v, _), g in zip(VALUES, got, strict=True)] == VALUES


def test_order_and_zone(spark):
    rows = [("8/17/2014 4:50 PM", "America/Chicago", "mdy", CRAWL), ("8/17/2014 4:50 PM", "America/Chicago", "dmy", CRAWL), ("2020-01-01 00:00", None, None, CRAWL), ("2020-01-01 00:00", "No/Where", None, CRAWL), ("wczoraj 10:00", "UTC", None, None), ("2 days ago", "UTC", None, "not a time")]
    assert utc(spark, rows) == ["2014-08-17T21:50:00Z", None, None, None, None, None]


def test_local_times_as_the_zone_library_reads_them(spark):
    rng = random.Random(9)
    zones = ["Europe/Warsaw", "America/Chicago", "Europe/London", "Asia/Kolkata", "UTC", "Australia/Lord_Howe"]
    rows, want = [], []
    for _ in range(3000):
        t = datetime.fromtimestamp(rng.randrange(-1_000_000_000, 2_000_000_000), UTC).replace(tzinfo=None)
        zone = rng.choice(zones)
        rows.append((t.isoformat(sep=" "), zone, None, None))
        want.append(datetime.fromtimestamp(int(t.replace(tzinfo=ZoneInfo(zone)).timestamp()), UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    assert utc(spark, rows) == want


def test_days_and_calendar_as_the_library_has_them(spark):
    days = spark.range(-719162, 2932896, 97).select("id", F.date_from_unix_date(F.col("id").cast("int")).alias("day"))
    y, m, d = F.year("day"), F.month("day"), F.dayofmonth("day")
    assert days.where((ts.days_of(y, m, d) != F.col("id")) | ~ts.in_calendar(y, m, d)).count() == 0


def test_operator_on_nulls_repeats_empty_and_clashing_names(spark):
    df = spark.createDataFrame([("2020-01-01 00:00", "UTC", "x"), (None, None, "y"), ("2020-01-01 00:00", "UTC", "x"), ("z" * 100_000, "UTC", None)], "v string, zone string, utc string")
    got = ts.normalise_times(df, "v", "zone")
    assert got.columns == ["v", "zone", "utc"] and sorted(str(r.utc) for r in got.collect()) == ["2020-01-01T00:00:00Z"] * 2 + ["None"] * 2
    assert ts.normalise_times(df.where("false"), "v", "zone").count() == 0
