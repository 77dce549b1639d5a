import hashlib

import pytest
from pyspark.sql import functions as F

from newsloom.functions.dates import iso_date, iso_timestamp
from newsloom.functions.text import article_id, content_hash, strip_space, tag_list


def applied(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_strip_matches_python_for_every_code_point(spark):
    points = [chr(c) for c in range(0x3101)]
    texts = [p + "x" + p + "y" + p for p in points]
    assert applied(spark, texts, strip_space) == [t.strip() for t in texts]


def test_tag_list(spark):
    assert applied(spark, [" A, ,b,A ", "", " , ", None, "X"], tag_list) == [
        "a, b, a", None, None, None, "x",
    ]


def test_keys(spark):
    long = "é" * 5000
    got = applied(spark, [long, ""], lambda v: content_hash(F.lit("t"), v))
    assert got == [hashlib.sha1(f"t|{x}".encode()).hexdigest() for x in (long, "")]
    assert applied(spark, ["http://x"], article_id) == [hashlib.sha1(b"http://x").hexdigest()[:12]]
    no_title = applied(spark, ["b"], lambda v: content_hash(F.lit(""), v))
    assert no_title == [hashlib.sha1(b"|b").hexdigest()]


DATES = [
    ("2025-12-01", "2025-12-01T00:00:00"),
    ("2025-12-01T10:00:00.000Z", "2025-12-01T10:00:00+00:00"),
    ("2025-12-01T10:00:00.25", "2025-12-01T10:00:00.250000"),
    ("2025-12-01T10:00:00.123456789-0530", "2025-12-01T10:00:00.123456-05:30"),
    ("2025-12-01 10:00 +02", "2025-12-01T10:00:00+02:00"),
    ("2025-12-01T10:00:00-00:00", "2025-12-01T10:00:00+00:00"),
    ("20251201T101112Z", "2025-12-01T10:11:12+00:00"),
    ("20251201", "2025-12-01T00:00:00"),
    ("2025/1/2", "2025-01-02T00:00:00"),
    ("Mon, 01 Dec 2025 10:00:00 +0200", "2025-12-01T10:00:00+02:00"),
    ("1 Dec 2025 10:00 GMT", "2025-12-01T10:00:00+00:00"),
    ("December 1, 2025", "2025-12-01T00:00:00"),
    ("Dec 1, 2025 at 5:07 PM", "2025-12-01T17:07:00"),
    ("Monday, 29 February 2024", "2024-02-29T00:00:00"),
    ("2025-12-01 10:00:00 EST", "2025-12-01T10:00:00"),
    ("Mon Dec  1 10:00:00 2025", "2025-12-01T10:00:00"),
    ("Mon Dec 1 10:00:00 UTC 2025", "2025-12-01T10:00:00+00:00"),
    ("12/01/2025", "2025-12-01T00:00:00"),
    ("12/01/2025 10:00", "2025-12-01T10:00:00"),
    ("31/12/2025", "2025-12-31T00:00:00"),
    ("2025-12-01T10", "2025-12-01T10:00:00"),
    ("1st December 2025", "2025-12-01T00:00:00"),
    ("December 2nd, 2025 10:00", "2025-12-02T10:00:00"),
    ("2025.12.01", "2025-12-01T00:00:00"),
    ("2025-02-29", None),
    ("2025-13-01", None),
    ("2025-12-01T24:00:00", None),
    ("2025-12-01T10:60:00", None),
    ("0000-12-01", None),
    ("10:00", None),
    ("December", None),
    ("not a date", None),
    ("", None),
    (None, None),
]


def test_dates(spark):
    assert applied(spark, [d for d, _ in DATES], iso_date) == [i for _, i in DATES]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_timestamp_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = applied(
            spark,
            ["2025-12-01T10:00:00+02:00", "2025-12-01T08:00:00", None],
            lambda v: F.unix_seconds(iso_timestamp(v)),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1764576000, 1764576000, None]
