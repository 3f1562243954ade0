from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.sources import connectors
from quern.streaming import state as st

NOW = dt.datetime(2025, 6, 1, tzinfo=dt.UTC)


def test_values_expire_and_survive(tmp_path):
    at = [0.0]
    s = st.FileState(str(tmp_path / "s.json"), lambda: at[0])
    s.put("a", "1", 10)
    assert s.increase("n") == 1 and s.increase("n") == 2
    at[0] = 10.0
    again = st.FileState(str(tmp_path / "s.json"), lambda: at[0])
    assert again.get("a") is None and again.get("n") == "2"
    (tmp_path / "s.json").write_text("broken")
    assert st.FileState(str(tmp_path / "s.json")).get("n") is None


def test_marks_and_windows():
    s = st.FileState()
    assert st.window_start(s, "c", NOW) == NOW - dt.timedelta(days=90)
    st.advance_mark(s, "c", NOW)
    assert st.window_start(s, "c", NOW) == NOW - dt.timedelta(hours=6)
    st.advance_mark(s, "c", NOW - dt.timedelta(days=5))
    assert st.window_start(s, "c", NOW) == NOW - dt.timedelta(hours=6)
    assert st.window_start(s, "c", NOW + dt.timedelta(days=60)) == NOW + dt.timedelta(days=46)


def test_status_machine():
    s = st.FileState()

    def boom(_):
        raise ValueError

    def away(_):
        raise st.Unavailable

    assert st.run_connector("c", boom, s, NOW, ready=False)[0] == "skipped_no_credentials"
    assert st.run_connector("c", away, s, NOW)[0] == "unavailable"
    assert [st.run_connector("c", boom, s, NOW)[0] for _ in range(4)] == ["failed"] * 3 + ["skipped_circuit_open"]
    assert st.run_connector("c", boom, s, NOW, since=NOW)[0] == "failed"
    assert st.run_connector("d", lambda t: t, s, NOW, cooldown=60) == ("success", NOW - dt.timedelta(days=90))
    assert st.run_connector("d", lambda t: t, s, NOW)[0] == "skipped_cooldown"
    assert st.run_connector("d", lambda t: t, s, NOW, since=NOW) == ("success", NOW)


def test_retries():
    pauses, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return 7

    assert st.retried(flaky, sleep=pauses.append, jitter=lambda: 1.0) == 7 and pauses == [1.0, 2.0]
    with pytest.raises(OSError):
        st.retried(lambda: (_ for _ in ()).throw(OSError()), tries=2, sleep=pauses.append)


def test_feed_helpers(spark):
    c, t = spark.createDataFrame([("a",), ("b",)], "channel string"), spark.createDataFrame([("x",), ("y",)], "term string")
    assert connectors.search_plan(c, t).count() == 4
    assert [r.title for r in connectors.with_titles(c, spark.createDataFrame([("a", "T"), ("a", "S")], "channel string, title string"), "channel").orderBy("channel").collect()] == ["T", None]
    v = spark.createDataFrame([("1746270513",), ("2025-05-03T11:08:33Z",), ("x",), (None,)], "v string").select(F.unix_micros(connectors.parse_instant(F.col("v"))).alias("m")).collect()
    assert [r.m for r in v] == [1746270513000000, 1746270513000000, None, None]
    pages = spark.createDataFrame([(1, '{"review":[{"author":{"name":"A"},"reviewRating":{"ratingValue":"4"},"reviewBody":"ok","datePublished":"2025-01-01"}]}'), (2, "broken")], "id int, j string")
    assert [tuple(r) for r in connectors.json_ld_reviews(pages, "id", "j").collect()] == [(1, "A", 4.0, "ok", "2025-01-01")]
    w = spark.createDataFrame([(NOW - dt.timedelta(days=30), NOW)], "s timestamp, n timestamp").select(connectors.clamp_window(F.col("s"), F.col("n")).alias("c")).first().c
    assert w == (NOW - dt.timedelta(days=7) + dt.timedelta(minutes=5)).astimezone().replace(tzinfo=None) or w == (NOW - dt.timedelta(days=7) + dt.timedelta(minutes=5)).replace(tzinfo=None)
    apps = spark.createDataFrame([("a", i) for i in range(120)] + [("b", i) for i in range(3)], "app string, at int")
    assert connectors.newest_per_app(apps, "app", "at", 120).count() == 63
    keep = F.lit("news.example")
    assert spark.range(1).select(connectors.outlet_allowed(keep, ("example",), (), ".id", F.lit("en")).alias("o")).first().o
