from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from gleanspark.functions import dates as D

S = F.col("s")


def test_strict_dates(values):
    cases = {
        "Wed, 22 Apr 2026 10:00:00 +0000": "2026-04-22T10:00:00+00:00", "wed, 2 APR 2026 1:02:03 -0530": "2026-04-02T01:02:03-05:30",
        "Wed, 22 Apr 2026 10:00:00 GMT": None, "2026-04-22T18:00:00": None, "2026-04-22": "2026-04-22T00:00:00", " 2026-4-2 ": "2026-04-02T00:00:00",
        "2026-04-22T18:00:00Z": "2026-04-22T18:00:00+00:00", "2026-04-22T18:00:00+02:00": "2026-04-22T18:00:00+02:00",
        "2026-04-22T18:00:00.5Z": None, "2026-02-30": None, "2026-04-22T18:00:60Z": None, "": None, None: None,
    }
    assert values(D.parse_date(S, parity=True), list(cases)) == list(cases.values())


def test_lenient_dates(values):
    cases = {
        "Wed, 22 Apr 2026 10:00:00 GMT": "2026-04-22T10:00:00+00:00", "Wed, 22 Apr 2026 10:00:00 EST": "2026-04-22T10:00:00-05:00",
        "2026-04-22T18:00:00": "2026-04-22T18:00:00", "2026-04-22 18:00:00.5Z": "2026-04-22T18:00:00.500000+00:00", "soon": None,
    }
    assert values(D.parse_date(S), list(cases)) == list(cases.values())


def test_recent_includes_the_limit_and_what_cannot_be_read(values):
    as_of = datetime(2026, 4, 29, 12, tzinfo=timezone.utc)
    cases = {
        None: True, "": True, "soon": True, "2026-04-22T12:00:00+00:00": True, "2026-04-22T11:59:59+00:00": False, "2026-04-22T12:00:00": True,
        "2026-04-22T13:00:00+02:00": False, "2026-04-22": False, "20260420T101112": False, "2026-W16-1": False, "2026-W18": True,
        "2026-04-20T18:00:00.123Z": False, "2026-04-20T18": False,
    }
    assert values(D.is_recent(S, as_of), list(cases)) == list(cases.values())


def test_results_do_not_depend_on_the_session_zone(spark, values):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(D.parse_date(S, parity=True), ["2026-03-08T02:30:00Z"]) == ["2026-03-08T02:30:00+00:00"]
        assert values(D.is_recent(S, "2026-03-15T02:30:00"), ["2026-03-08T02:30:00", "2026-03-08T02:29:59"]) == [True, False]
        assert values(D.epoch_to_iso(S.cast("bigint")), ["1704067265"]) == ["2024-01-01T00:01:05+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch(values):
    assert values(D.epoch_to_iso(S.cast("bigint")), ["0", None, "-1"]) == [
        "1970-01-01T00:00:00+00:00", "1970-01-01T00:00:00+00:00", "1969-12-31T23:59:59+00:00"]
