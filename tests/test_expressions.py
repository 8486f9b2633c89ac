"""Expected values are written by hand."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from freshet.functions import dates, geometry, keys, text, units


def lit(value):
    return F.lit(value)


def test_keys(one):
    got = one(
        plain=keys.uid(lit("a"), lit(1), lit("b")),
        null=keys.uid(lit("a"), lit(None)),
        printed=keys.uid(lit("a"), lit(None), null_text="None"),
        md5=keys.uid_md5(lit("a"), lit("b")),
        short=keys.zfill(lit("7"), 3),
        long=keys.zfill(lit("12345"), 3),
        storm=keys.storm_uid(lit("S1"), lit("2020-01-02 03:04:05")),
        last=keys.part(lit("x_y_z"), "_", -1),
        date=keys.date_in_name(lit("run_20240229.nc"), r"(\d{8})", "yyyyMMdd"),
        nodate=keys.date_in_name(lit("run.nc"), r"(\d{8})", "yyyyMMdd"),
    )
    assert got == {
        "plain": "a_1_b", "null": None, "printed": "a_None", "md5": hashlib.md5(b"a_b").hexdigest(),
        "short": "007", "long": "12345", "storm": "S1_2020_01_02_03_04_05", "last": "z",
        "date": dt.date(2024, 2, 29), "nodate": None,
    }


def test_decimal_year_is_leap_aware(one):
    got = one(leap=dates.from_decimal_year(lit("2016.5")), plain=dates.from_decimal_year(lit(2015.5)))
    assert got == {"leap": dt.datetime(2016, 7, 2), "plain": dt.datetime(2015, 7, 2, 12)}


def test_day_of_year(one):
    got = one(
        last=dates.from_day_of_year(lit("2020366 2359")),
        over=dates.from_day_of_year(lit("2021366 0000")),
        early=dates.from_day_of_year(lit("2021001 030")),
        bad=dates.from_day_of_year(lit("n/a")),
    )
    assert got == {
        "last": dt.datetime(2020, 12, 31, 23, 59), "over": dt.datetime(2022, 1, 1),
        "early": dt.datetime(2021, 1, 1, 0, 30), "bad": None,
    }


@pytest.mark.parametrize("day", ["2021-01-01", "2020-12-31", "2024-12-30", "2018-06-15", "2026-01-01"])
def test_iso_week_matches_python(one, day):
    date = dt.date.fromisoformat(day)
    year, week, weekday = date.isocalendar()
    key = dates.iso_week_key(lit(day).cast("date"))
    got = one(key=key, back=dates.iso_week_date(key, weekday))
    assert got == {"key": f"{year}0{week:02d}", "back": date}


def test_epoch(one):
    got = one(
        ms=dates.from_epoch(lit(1577934245123), "ms"), null=dates.from_epoch(lit(None)),
        zero=dates.from_epoch(lit(None), zero_fill=True),
    )
    assert got == {
        "ms": dt.datetime(2020, 1, 2, 3, 4, 5, 123000), "null": None, "zero": dt.datetime(1970, 1, 1),
    }


def test_dates(one):
    feb = lit("2024-02-10").cast("date")
    got = one(
        end=dates.month_end_365(lit(2024), lit(2)), start=dates.year_start(lit(0)), bce=dates.year_end(lit(-5)),
        mid=dates.mid_next_month(lit("2023-12-31").cast("date")),
        future=dates.repair_future(lit("2030-05-06").cast("date"), lit(2019), "2024-01-01"),
        past=dates.repair_future(lit("2020-05-06").cast("date"), lit(2019), "2024-01-01"),
        leap=dates.repair_future(lit("2028-02-29").cast("date"), lit(2019), "2024-01-01"),
        cf=dates.cf_time(lit(31.5), lit("days since 1800-1-1 00:00:00")),
        rfc=dates.parse_rfc822(lit("Thu, 02 Jan 2020 03:04:05 -0500")),
        gmt=dates.parse_rfc822(lit("Thu, 2 Jan 2020 03:04:05 GMT")),
        bad=dates.date_from_parts(lit("2020"), lit("2"), lit(None).cast("string")),
        no=dates.date_from_parts(lit(2021), lit(2), lit(29)),
        month=dates.comparison_dates(feb)["last_month"], year=dates.comparison_dates(feb)["last_year"],
        noon=dates.noon_day(lit("2024-01-01 12:00:00").cast("timestamp_ntz")),
        before=dates.noon_day(lit("2024-01-01 11:59:59").cast("timestamp_ntz")),
    )
    assert got == {
        "end": dt.date(2024, 2, 28), "start": None, "bce": None, "mid": dt.date(2024, 1, 15),
        "future": dt.date(2019, 5, 6), "past": dt.date(2020, 5, 6), "leap": dt.date(2019, 2, 28),
        "cf": dt.date(1800, 2, 1), "rfc": dt.datetime(2020, 1, 2, 8, 4, 5), "gmt": dt.datetime(2020, 1, 2, 3, 4, 5),
        "bad": None, "no": None,
        # 10 February 2024 is a Saturday; the Saturdays on or after 10 January and 10 February 2023
        "month": dt.date(2024, 1, 13), "year": dt.date(2023, 2, 11),
        "noon": dt.date(2024, 1, 2), "before": dt.date(2024, 1, 1),
    }


def test_durations_and_scenarios(one):
    t = lambda s: lit(s).cast("timestamp_ntz")
    d = lit("2020-10-31").cast("date")
    got = one(
        night=dates.duration_text(t("2020-01-01 23:30:00"), t("2020-01-02 01:05:09")),
        days=dates.duration_text(t("2020-01-01 00:00:00"), t("2020-01-03 00:00:01")),
        cs=F.struct(*dates.scenario_interval(lit("CS"), d)), ml1=F.struct(*dates.scenario_interval(lit("ML1"), d)),
        ml2=F.struct(*dates.scenario_interval(lit("ML2"), d)),
    )
    assert got["night"] == "1:35:09" and got["days"] == "2 days, 0:00:01"
    oct_, feb, jun = dt.date(2020, 10, 31), dt.date(2021, 2, 28), dt.date(2021, 6, 30)
    assert [tuple(got[k]) for k in ("cs", "ml1", "ml2")] == [(oct_, oct_), (oct_, feb), (feb, jun)]


@pytest.mark.parametrize(
    "text_, days",
    [("Daily", 4), (" weekly ", 10), ("monthly", 45), ("annual", 410), ("varies", 15), ("every 30 minutes", 1),
     ("3 hours", 1), ("8 days", 11), ("2 weeks", 17), ("3 months", 120), ("sometimes", 2)],
)
def test_allowed_lag(one, text_, days):
    assert one(d=dates.allowed_lag(lit(text_)))["d"] == days


def test_text(one):
    pair = lambda p: F.struct(*p)
    got = one(
        title=text.title(lit("o'higgins SAN-pedro 3rd ñuble")),
        section=pair(text.split_section(lit("<p>A b</p>Sources: X, Y"))),
        single=pair(text.split_section(lit("<p>A</p> Source: X"))),
        none=pair(text.split_section(lit("<p>A</p>"))),
        paren=pair(text.split_paren(lit("Etna (Italy) - Report for 1 May"))),
        after=text.after_first(lit("Americas: Dengue: 2019"), ": "), whole=text.after_first(lit("Flood"), ": "),
        anchor=text.anchor_text(lit('moved <a href="http://x/y">here</a>')),
        href=text.anchor_href(lit('moved <a href="http://x/y">here</a>')), nohref=text.anchor_href(lit("moved")),
        latlon=pair(text.parse_latlon(lit("(12.5, -7)"))), empty=pair(text.parse_latlon(lit("n/a"))),
        yes=text.py_bool(lit(True)), no=text.parse_bool(lit("False")),
    )
    assert got["title"] == "O'Higgins San-Pedro 3Rd Ñuble"
    assert tuple(got["section"]) == ("A b", " X, Y") and tuple(got["single"]) == ("A ", " X")
    assert tuple(got["none"]) == ("A", None)
    assert tuple(got["paren"]) == ("Etna", "Italy")
    assert got["after"] == "Dengue: 2019" and got["whole"] == "Flood"
    assert (got["anchor"], got["href"], got["nohref"]) == ("moved ", "http://x/y", None)
    assert tuple(got["latlon"]) == (12.5, -7.0) and tuple(got["empty"]) == (None, None)
    assert (got["yes"], got["no"]) == ("True", False)


def test_units(one):
    got = one(
        ppb=units.ugm3_to_ppb(lit("no2"), lit(3.76)), other=units.ugm3_to_ppb(lit("co"), lit(1.0)),
        ppm=units.ugm3_to_ppm(lit("so2"), lit("µg/m³"), lit(64000.0)), same=units.ugm3_to_ppm(lit("so2"), lit("ppm"), lit(5.0)),
        pm=units.ugm3_to_ppm(lit("pm25"), lit("ug/m3"), lit(5.0)),
        gap=units.bin_ranges(lit(500.5)), bin=units.bin_ranges(lit(500)), top=units.bin_ranges(lit(2001)),
        classes=F.array(*[units.classify(lit(v)) for v in (0.24, 0.25, 1.0, 2.0)]),
        null=units.classify(lit(None).cast("double")), even=units.scale_round(lit(2.5), 1.0, 0),
    )
    assert got["ppb"] == pytest.approx(2.0) and got["other"] is None
    assert got["ppm"] == pytest.approx(22.414) and got["same"] == 5.0 and got["pm"] == 5.0
    assert (got["gap"], got["bin"], got["top"]) == (None, "0-500", ">2000")
    assert got["classes"] == ["Normal", "Stress", "Alert", "Crisis"] and got["null"] is None
    assert got["even"] == 2.0


def test_geometry(one):
    ring = [(0.0, 0.0), (3.0, 0.0), (3.0, 4.0), (0.0, 0.0)]
    column = lambda pts: F.array(*[F.array(*map(lit, p)) for p in pts])
    triangle = geometry.polygon(F.array(column(ring)))
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    holed = geometry.polygon(F.array(column([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]), column(hole)))
    inside = lambda g, x, y: geometry.covers(g, lit(x), lit(y))
    little = "0101000000000000000000F03F0000000000000040"
    got = one(
        perimeter=geometry.perimeter(triangle), point=geometry.point(lit(1.0), lit(None).cast("double")),
        inner=inside(triangle, 2.0, 1.0), edge=inside(triangle, 3.0, 2.0), corner=inside(triangle, 0.0, 0.0),
        outer=inside(triangle, 1.0, 2.0), in_hole=inside(holed, 1.5, 1.5), ring=inside(holed, 0.5, 1.5),
        wkb=geometry.wkb_point(lit(little)), ewkb=geometry.wkb_point(lit("0101000020E6100000" + little[10:])),
        bad=geometry.wkb_point(lit("zz")),
    )
    assert got["perimeter"] == 12.0 and got["point"] is None
    assert [got[k] for k in ("inner", "edge", "corner", "outer", "in_hole", "ring")] == [True, True, True, False, False, True]
    assert tuple(got["wkb"]) == tuple(got["ewkb"]) == (1.0, 2.0)
    assert got["bad"] is None or tuple(got["bad"]) == (None, None)


def test_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame(
        [(0, "2024-03-10 02:30:00", "2024-03-10T02:30:00-0500", "Sun, 10 Mar 2024 02:30:00 +0000"),
         (1710052200, "2024-11-03 01:30:00", "2024-11-03T01:30:00+0200", "03 Nov 2024 01:30:00 GMT")],
        "n bigint, plain string, offset string, feed string",
    )
    times = lambda: [tuple(map(str, r)) for r in rows.select(
        dates.from_epoch(F.col("n")), dates.from_epoch(F.col("n") * 1000, "ms"), dates.parse_ts(F.col("plain"), "yyyy-MM-dd HH:mm:ss"),
        dates.parse_ts(F.col("offset"), "yyyy-MM-dd'T'HH:mm:ssZ"), dates.parse_rfc822(F.col("feed")),
    ).collect()]
    before, zone = times(), spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert times() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert before[0] == ("1970-01-01 00:00:00", "1970-01-01 00:00:00", "2024-03-10 02:30:00", "2024-03-10 07:30:00", "2024-03-10 02:30:00")
