from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from railweave.functions import event_json, gtfs_time, identity, labels


def one(spark, column, schema="x STRING", value=None):
    return spark.createDataFrame([(value,)], schema).select(column.alias("r")).first().r


def many(spark, values, make, schema="x STRING"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, {schema}")
    return [r.r for r in df.select("i", make(F.col("x")).alias("r")).orderBy("i").collect()]


def test_gtfs_clock_passes_24_hours(spark):
    assert many(spark, ["08:00:00", "29:00:00", "00:00:59", None], gtfs_time.gtfs_seconds) == [
        28_800, 104_400, 59, None,
    ]


def test_service_day_starts_at_local_midnight(spark):
    def due(day, seconds):
        return one(
            spark, gtfs_time.service_timestamp(F.col("x"), F.lit(seconds)).cast("string"), value=day
        )

    assert due("20260830", 104_400) == "2026-08-31 09:00:00"
    # The clocks go forward on this day: eight elapsed hours end at nine o'clock local time.
    assert due("20260308", 8 * 3600) == "2026-03-08 13:00:00"


@pytest.mark.parametrize(("micros", "seconds"), [(2_500_000, 3), (-2_500_000, -3), (2_400_000, 2), (0, 0)])
def test_delay_rounds_half_away_from_zero(spark, micros, seconds):
    base = datetime(2026, 8, 30, 12, tzinfo=UTC)
    df = spark.createDataFrame([(base + timedelta(microseconds=micros), base)], "a TIMESTAMP, b TIMESTAMP")
    assert df.select(gtfs_time.delay_seconds(F.col("a"), F.col("b"))).first()[0] == seconds


def test_weekdays_start_on_sunday(spark):
    df = spark.createDataFrame([(datetime(2026, 8, 30, tzinfo=UTC),), (datetime(2026, 8, 31, tzinfo=UTC),)], "t TIMESTAMP")
    found = df.select(gtfs_time.day_of_week(F.col("t")), gtfs_time.is_weekend(F.col("t"))).collect()
    assert [tuple(r) for r in found] == [(0, True), (1, False)]


def test_friendly_value(spark):
    values = ["  Red ", "", "nan", "None", "UNAVAILABLE", None, "\tx\n"]
    assert many(spark, values, labels.friendly_value) == [
        "Red", "Unknown", "Unknown", "Unknown", "Unknown", "Unknown", "x",
    ]


def test_route_label(spark):
    rows = [
        ("1", "Red Line", "r1"), ("Mattapan", "mattapan", "r2"), (None, "Blue Line", "r3"),
        ("SL1", None, "r4"), (None, "unavailable", "r5"), (None, None, None),
    ]
    df = spark.createDataFrame(rows, "s STRING, l STRING, r STRING")
    found = [r[0] for r in df.select(labels.route_label(F.col("s"), F.col("l"), F.col("r"))).collect()]
    assert found == ["1 - Red Line", "Mattapan", "Blue Line", "SL1", "r5", "Unknown"]


def test_status_is_title_cased_like_python(spark):
    values = ["IN_TRANSIT_TO", "INCOMING_AT", "STOPPED_AT", "out_of_service", "o'neil-st 5th", None]
    expected = ["In transit", "Approaching stop", "Stopped", *(v.replace("_", " ").title() for v in values[3:5]), "Unknown"]
    assert many(spark, values, labels.friendly_status) == expected


def test_timestamps_are_shown_in_local_time(spark):
    values = [datetime(2026, 8, 30, 16, tzinfo=UTC), datetime(2026, 1, 5, 4, 5, 6, tzinfo=UTC), None]
    assert many(spark, values, labels.format_timestamp, "x TIMESTAMP") == [
        "Aug 30, 12:00:00 PM EDT", "Jan 04, 11:05:06 PM EST", "Unknown",
    ]
    short = many(spark, values[:1], lambda c: labels.format_timestamp(c, include_date=False), "x TIMESTAMP")
    assert short == ["12:00:00 PM EDT"]


def test_marker_colors(spark):
    values = [
        "Red", "Green-D", "Orange", "Blue", "SL1", "CR-Fitchburg", "Boat-F1", "East Ferry", "39",
        "Mattapan", None, "Zürich", "x",
    ]
    found = many(spark, values, labels.route_marker_color)
    assert found[:2] == [[218, 41, 28, 220], [0, 132, 61, 220]]
    assert found[6] == found[7] and found[9] == found[0] and found[10] == [120, 120, 120, 210]
    for value, color in zip(values[11:], found[11:]):
        assert color == [*labels.ROUTE_PALETTE[crc32(value.encode()) % 8], 220]
    assert many(spark, ["Red"], lambda c: labels.color_hex(labels.route_marker_color(c))) == ["#da291c"]


def test_human_formats_match_python(spark):
    ages = [0.0, 2.5, 3.5, 59.4, 60.0, 63.0, 81.0, 97.0, 117.0, 3599.0, None]
    expected = ["Unknown" if a is None else f"{a:.0f} seconds" if a < 60 else f"{a / 60:.1f} minutes" for a in ages]
    assert many(spark, ages, labels.format_age, "x DOUBLE") == expected
    sizes = [0, 1023, 1024, 1280, 1_363_149, 5 * 1024**3, 3 * 1024**5, None]
    assert many(spark, sizes, labels.format_bytes, "x BIGINT") == [
        "0.0 B", "1023.0 B", "1.0 KiB", "1.2 KiB", "1.3 MiB", "5.0 GiB", "3072.0 TiB", None,
    ]
    assert many(spark, [1234567, None], labels.format_count, "x BIGINT") == ["1,234,567", "Unavailable"]
    assert many(spark, [1234.5, None], lambda c: labels.format_decimal(c, " s"), "x DOUBLE") == ["1,234.50 s", "Unavailable"]
    assert many(spark, [2.7344, None], labels.format_seconds, "x DOUBLE") == ["2.734s", "n/a"]


def test_event_id_is_the_hash_of_sorted_json(spark):
    at = datetime(2026, 8, 30, 12, 0, 0, tzinfo=UTC)
    cases = [
        ("src", "e", "v", at), ("src", None, "", None), ('q"\\\n\t\x01\x7f', "é", "日本😀", at),
        ("s", "e", "v", at.replace(microsecond=1500)),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i INT, s STRING, e STRING, v STRING, t TIMESTAMP")
    key = identity.build_event_id(F.col("s"), F.col("e"), F.col("v"), F.col("t"))
    found = [r.k for r in df.select("i", key.alias("k")).orderBy("i").collect()]
    for (source, entity, vehicle, feed), value in zip(cases, found):
        members = {
            "source": source, "entity_id": entity, "vehicle_id": vehicle,
            "feed_timestamp": feed.isoformat() if feed else None,
        }
        assert value == sha256(json.dumps(members, sort_keys=True).encode()).hexdigest()


@pytest.mark.parametrize(
    "text",
    [
        "2026-08-30T12:00:00+00:00", "2026-08-30 12:00:00.5Z", "2026-08-30T12:00:00.123456-04:00",
        "2026-08-30", "20260830T120000Z", "2026-08-30T12:30", "2026-08-30T12+0530", "2026",
        "", "soon", "2026-13-01T00:00:00Z", "2026-08-30T25:00:00Z", " 2026-08-30", "2026-8-3",
        "2026-08-30T12:00:00,25+01:00", "2026-08-30T12:00:00+0100",
    ],
)
def test_iso_times_are_read_like_python(spark, text):
    try:
        expected = datetime.fromisoformat(text)
        naive = expected.tzinfo is None
        expected = (expected.replace(tzinfo=UTC) if naive else expected).astimezone(UTC)
    except ValueError:
        expected, naive = None, None
    df = spark.createDataFrame([(text,)], "x STRING")
    row = df.select(
        event_json.parse_iso(F.col("x")).cast("string").alias("at"),
        event_json.has_iso_offset(F.col("x")).alias("zoned"),
    ).first()
    if expected is None:
        assert row.at is None
    else:
        assert datetime.fromisoformat(row.at).replace(tzinfo=UTC) == expected
        assert row.zoned is (not naive)
