from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.operators.timestamps import learned_orders, normalize_timestamps, readings

UTC = dt.UTC


def micros(*a):
    return int(dt.datetime(*a, tzinfo=UTC).timestamp()) * 1_000_000


@pytest.mark.parametrize(
    ("text", "zone", "want"),
    [
        ("2025-05-03T11:08:33+07:00", None, micros(2025, 5, 3, 4, 8, 33)),
        ("2025-05-03 11:08:33", "Asia/Jakarta", micros(2025, 5, 3, 4, 8, 33)),
        ("2025-05-03 11:08:33.250", "Asia/Jakarta", micros(2025, 5, 3, 4, 8, 33) + 250_000),
        ("20250503T110833Z", None, micros(2025, 5, 3, 11, 8, 33)),
        ("1746270513", None, micros(2025, 5, 3, 11, 8, 33)),
        ("1746270513250", None, micros(2025, 5, 3, 11, 8, 33) + 250_000),
        ("1746270513.5", None, micros(2025, 5, 3, 11, 8, 33) + 500_000),
        ("Sabtu, 3 Mei 2025, 18.08 WIB", None, micros(2025, 5, 3, 11, 8)),
        ("May 3, 2025 7:08 AM EDT", None, micros(2025, 5, 3, 11, 8)),
        ("12/31/2024 12:05 AM", "America/New_York", micros(2024, 12, 31, 5, 5)),
        ("3 de mayo de 2025, 13:08 CEST", None, micros(2025, 5, 3, 11, 8)),
        ("3 mai 2025 à 13h08 CEST", None, micros(2025, 5, 3, 11, 8)),
        ("Sat May 03 11:08:33 +0000 2025", None, micros(2025, 5, 3, 11, 8, 33)),
        ("Sat, 03 May 2025 11:08:33 GMT", None, micros(2025, 5, 3, 11, 8, 33)),
    ],
)
def test_formats(text, zone, want):
    assert [r[1] for r in readings(text, zone)] == [want]


@pytest.mark.parametrize(
    ("text", "zone", "status"),
    [
        (None, None, "empty"), ("  ", None, "empty"), ("kemarin", "Asia/Jakarta", "unreadable"), ("2025-05-03", "Asia/Jakarta", "no_time"), ("3 Mei 2025", None, "no_time"),
        ("2024-03-31 02:30:00", "Europe/Paris", "clock_never"), ("2024-10-27 02:30:00", "Europe/Paris", "clock_twice"), ("2025-05-03 11:08:33", None, "no_zone"), ("0000-00-00 00:00:00", "Asia/Jakarta", "unreadable"), ("2025-02-30 10:00:00", "Asia/Jakarta", "unreadable"),
    ],
)
def test_no_instant(text, zone, status):
    assert [(r[1], r[2]) for r in readings(text, zone)] == [(None, status)]


@given(st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2090, 1, 1)), st.integers(-840, 840))
def test_iso_round_trip(at, minutes):
    text = at.replace(tzinfo=dt.timezone(dt.timedelta(minutes=minutes))).isoformat()
    want = (at - dt.timedelta(minutes=minutes) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert readings(text, None)[0][1] == want


@given(st.text(max_size=60))
def test_any_text_is_read_or_refused(text):
    assert readings(text, "Asia/Jakarta")


def _run(spark, rows, catalog):
    docs = spark.createDataFrame(rows, "document_id long, published_at string, source_name string, ingested_at timestamp")
    return {r.document_id: r for r in normalize_timestamps(docs, catalog).collect()}


def test_mixture_learns_the_order_of_an_uncatalogued_source(spark):
    catalog = spark.createDataFrame([("known", "UTC", "mdy", "x")], "source_name string, time_zone string, date_order string, zone string")
    at = dt.datetime(2025, 12, 1)
    # Days over twelve show that this source writes the day first; its zone is written, so it needs no clock.
    rows = [(i, f"{13 + i % 15}/0{1 + i % 9}/2025 10:00 UTC", "unlisted", at) for i in range(40)] + [(100, "03/04/2025 10:00 UTC", "unlisted", at), (101, "03/04/2025 10:00", "known", at), (102, "25/04/2025 10:00", "known", at), (103, None, None, None)]
    got = _run(spark, rows, catalog)
    assert got[100].format == "numeric_dmy" and got[100].utc_micros == micros(2025, 4, 3, 10)
    assert got[101].utc_micros == micros(2025, 3, 4, 10)
    assert got[102].status == "against_order" and got[102].utc_micros is None
    assert got[103].status == "empty"


def test_ambiguity_is_marked(spark):
    catalog = spark.createDataFrame([], "source_name string, time_zone string, date_order string")
    got = _run(spark, [(1, "03/04/2025 10:00 UTC", "a", dt.datetime(2025, 6, 1))], catalog)
    assert got[1].status == "ambiguous" and got[1].utc_micros is None


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "document_id long, published_at string, source_name string, ingested_at timestamp, zone string, source string, text string")
    catalog = spark.createDataFrame([], "source_name string, time_zone string, date_order string")
    assert normalize_timestamps(docs, catalog).count() == 0
    one = spark.createDataFrame([(1, "2025-05-03T11:08:33Z", "a", None, "x", "y", "z")] * 2, docs.schema)
    assert [r.utc_micros for r in normalize_timestamps(one, catalog).collect()] == [micros(2025, 5, 3, 11, 8, 33)] * 2
    assert normalize_timestamps(one.withColumn("published_at", F.lit("9" * 100_000)), catalog).first().status == "unreadable"


def test_orders_are_learned_against_what_is_stated(spark):
    rows, at = [], dt.datetime(2025, 3, 12, 12)
    for i in range(60):
        day = dt.datetime(2025, 3, 1 + i % 12, 9)
        rows += [(i, f"{day.day:02d}/{day.month:02d}/2025 09:00", "d", at), (1000 + i, f"{day.month:02d}/{day.day:02d}/2025 09:00", "m", at), (2000 + i, f"{day.month:02d}/{day.day:02d}/2025 09:00", "wrong", at)]
    rows += [(3000, "14/03/2025 09:00", "d", at), (3001, "03/14/2025 09:00", "m", at), (3002, "03/14/2025 09:00", "wrong", at), (3003, "2025-03-01 09:00:00", "iso", at), (3004, None, None, None)]
    docs = spark.createDataFrame(rows, "document_id long, published_at string, source_name string, ingested_at timestamp")
    catalog = spark.createDataFrame([("d", "UTC", None), ("m", "UTC", "mdy"), ("wrong", "UTC", "dmy"), ("iso", "UTC", "dmy")], "source_name string, time_zone string, date_order string")
    got = {r.source_name: (r.stated_order, r.learned_order) for r in learned_orders(docs, catalog).collect()}
    assert got == {"d": (None, "dmy"), "m": ("mdy", "mdy"), "wrong": ("dmy", "mdy")}
    # Without a stated order the mixture decides each contested date.
    found = {r.document_id: r for r in normalize_timestamps(docs, catalog).collect()}
    assert found[0].utc_micros == micros(2025, 3, 1, 9) and found[4].utc_micros == micros(2025, 3, 5, 9) and found[4].status == "ok"
    assert found[2004].utc_micros == micros(2025, 5, 3, 9)  # the stated order decides, right or wrong
