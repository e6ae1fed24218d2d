import datetime

import pytest
from msgflow.functions import (
    as_int,
    as_text,
    as_utc_timestamp,
    base64_text,
    int_or_default,
    open_document,
    text_or_default,
    utf8_text,
)
from pyspark.sql import functions as F

# JSON value, as int, as text, int or -1, text or "Unknown".
COERCED = [
    ("25", 25, "25", 25, "Unknown"),
    ("-2147483648", -2147483648, "-2147483648", -2147483648, "Unknown"),
    ("2147483648", -2147483648, "2147483648", -1, "Unknown"),
    ("99999999999", 1215752191, "99999999999", -1, "Unknown"),
    ("-99999999999", -1215752191, "-99999999999", -1, "Unknown"),
    ("12345678901234567890123", 1900168395, "12345678901234567890123", -1, "Unknown"),
    ("2.7", 2, "2.7", -1, "Unknown"),
    ("-2.7", -2, "-2.7", -1, "Unknown"),
    ("2.0", 2, "2.0", -1, "Unknown"),
    ("1.10", 1, "1.1", -1, "Unknown"),
    ("1e20", 2147483647, "1.0E20", -1, "Unknown"),
    ("-1e20", -2147483648, "-1.0E20", -1, "Unknown"),
    ("true", 1, "true", -1, "Unknown"),
    ("false", 0, "false", -1, "Unknown"),
    ("null", 0, "null", -1, "Unknown"),
    ('{"a":1}', 0, "", -1, "Unknown"),
    ("[1]", 0, "", -1, "Unknown"),
    ('"25"', 25, "25", -1, "25"),
    ('" 7 "', 7, " 7 ", -1, " 7 "),
    ('"+5"', 5, "+5", -1, "+5"),
    ('"2.7"', 2, "2.7", -1, "2.7"),
    ('"1e20"', 2147483647, "1e20", -1, "1e20"),
    ('"x"', 0, "x", -1, "x"),
    ('""', 0, "", -1, ""),
    ('"99999999999"', 0, "99999999999", -1, "99999999999"),
    ('"-99999999999"', 0, "-99999999999", -1, "-99999999999"),
    ('"true"', 0, "true", -1, "true"),
]


def test_coercion(spark):
    rows = spark.createDataFrame([(f'{{"v":{case[0]}}}',) for case in COERCED], "json string").coalesce(1)
    node = F.col("d").getField("v")
    read = rows.select("json", open_document(F.col("json"), ["v"]).alias("d")).select(
        "json", as_int(node), as_text(node), int_or_default(node), text_or_default(node)
    )
    assert [tuple(row)[1:] for row in read.collect()] == [case[1:] for case in COERCED]


def test_absent_value_stays_null(spark):
    rows = spark.createDataFrame([("{}",)], "json string")
    node = open_document(F.col("json"), ["v"]).getField("v")
    assert rows.select(as_int(node)).first()[0] is None


TIMESTAMPS = [
    ("2024-03-22T14:35:00Z", "2024-03-22 14:35:00"),
    ("2024-03-22", "2024-03-22 00:00:00"),
    ("2024-03-22 14:35", "2024-03-22 14:35:00"),
    ("2024-03-22T14:35", "2024-03-22 14:35:00"),
    ("2024-03-22T14:35Z", "2024-03-22 14:35:00"),
    ("2024-03-22T14:35:00+05:30", "2024-03-22 09:05:00"),
    ("2024-03-22T14:35-05:00", "2024-03-22 19:35:00"),
    ("2024-03-22T14:35:00.123456Z", "2024-03-22 14:35:00.123456"),
    ("20240322", None),
    ("2024-W12-5", None),
    ("14:35", None),
    ("2024", None),
    ("2024-02-30", None),
    ("2024-03-22T25:00:00Z", None),
    ("hello", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    rows = spark.createDataFrame([(t,) for t, _ in TIMESTAMPS], "t string").coalesce(1)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = [r[0] for r in rows.select(F.unix_micros(as_utc_timestamp(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def expected(text):
        if text is None:
            return None
        moment = datetime.datetime.fromisoformat(text).replace(tzinfo=datetime.UTC)
        return (moment - datetime.datetime(1970, 1, 1, tzinfo=datetime.UTC)) // datetime.timedelta(microseconds=1)

    assert micros == [expected(text) for _, text in TIMESTAMPS]


def test_complete_timestamps_that_end_with_z(spark):
    texts = ["2024-03-22T14:35:00Z", "2024-03-22 14:35:00.5Z", "2024-03-22T14:35Z", "2024-03-22T14:35:00Z\n"]
    wrong = ["2024-03-22T14:35:00ZZ", "2024-03-22T14:35:Z", "2024-03-22Z", "2024-02-30T14:35:00Z", "x024-03-22T14:35:00Z"]
    rows = spark.createDataFrame([(t,) for t in texts + wrong], "t string").coalesce(1)
    found = [r[0] for r in rows.select(as_utc_timestamp(F.col("t")).cast("string")).collect()]
    minute = "2024-03-22 14:35:00"
    assert found == [minute, f"{minute}.5", minute, minute, *[None] * len(wrong)]


def test_encoding(spark):
    rows = spark.createDataFrame([(b"\xff{",), (b"caf\xc3\xa9",), (b"x" * 200,)], "b binary").coalesce(1)
    texts = rows.select(utf8_text(F.col("b")), base64_text(F.col("b"))).collect()
    assert texts[0][0] is None and texts[1][0] == "café"
    assert "\n" not in texts[2][1] and len(texts[2][1]) == 268
