"""Whole datasets on small feeds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.plans import areas, countries, events, grids, prices, series, stations
from freshet.schemas import from_served, indicator_schema, schema

D = dt.datetime


def empty(spark, name):
    return spark.createDataFrame([], schema(name))


def test_earthquakes(spark, rows):
    def quake(i, when, lon=10.0):
        return ("f", i, int(when.replace(tzinfo=dt.timezone.utc).timestamp() * 1000), 5.5, "here", 600, (None, [lon, 20.0, 7.5]))

    feed = spark.createDataFrame(
        [quake(0, D(2024, 1, 30)), quake(1, D(2024, 1, 30)), quake(2, D(2024, 1, 23)), quake(3, D(2024, 1, 2))],
        "file string, position int, time long, mag double, place string, sig int, geometry struct<type: string, coordinates: array<double>>",
    )
    got = events.earthquakes(feed, empty(spark, "earthquakes"), "2024-02-01")
    assert got.columns == schema("earthquakes").names
    assert rows(got, "uid", "depth_in_km", "alert") == [
        ("20.0_10.0_7.5_2024-01-23 00:00:00", 7.5, None), ("20.0_10.0_7.5_2024-01-30 00:00:00", 7.5, None),
    ]
    assert events.earthquakes(feed, got, "2024-02-01").count() == 0
    assert events.earthquakes(feed, got, "2024-02-01", history=True).count() == 1
    assert events.retained(got, "datetime", "2024-01-01", 1, "uid").count() == 1


def test_disasters(spark, rows):
    record = """id string, fields struct<name: string, status: string, date: struct<created: string>, featured: boolean,
        primary_country: struct<iso3: string>, current: boolean, type: array<struct<id: int, name: string>>,
        country: array<struct<id: int, name: string, shortname: string, iso3: string, location: struct<lon: double, lat: double>>>,
        related_glide: array<string>, url: string>"""
    place = lambda c, x: (1, c, c, c[:3].upper(), (x, 2.0))
    feed = spark.createDataFrame(
        [
            ("7", ("Americas: Dengue - 2019", "ongoing", ("2019-06-01T00:00:00+00:00",), True, ("PER",), True, [(4, "Epidemic"), (5, "Flood")],
                   [place("Peru", 1.0), place("Chile", 3.0)], ["G1", "G2"], "u7")),
            ("8", ("Flood", "past", ("2019-07-01T00:00:00+00:00",), False, ("PER",), True, [(5, "Flood")], [place("Peru", 1.0)], None, "u8")),
        ],
        record,
    )
    got = events.disasters(feed, empty(spark, "disasters"))
    assert rows(got, "event_id", "country_iso3", "related_glide", "featured", "event_type_ids") == [
        (7, "CHI", "G1, G2", "True", "4, 5"), (7, "PER", "G1, G2", "True", "4, 5"), (8, "PER", "", "False", "5"),
    ]
    assert rows(events.disaster_summaries(got), "country_iso3", "interaction") == [
        ("CHI", "Dengue - 2019 (u7)"), ("PER", "Dengue - 2019 (u7); Flood (u8)"),
    ]
    assert events.disasters(feed, got).count() == 0


def test_volcano_reports(spark, rows):
    feed = spark.createDataFrame(
        [("Etna (Italy) - Report", "37.7 15.0", "Thu, 02 Jan 2020 03:04:05 +0000", "<p>Ash.</p>Sources: A, B")],
        "title string, point string, pubDate string, description string",
    )
    got = events.volcano_reports(feed, empty(spark, "volcano_reports"))
    assert rows(got, "uid", "volcano_name", "country_name", "description", "sources") == [
        ("37.7_15.0_2020-01-02 03:04:05", "Etna", "Italy", "Ash.", " A, B"),
    ]


def test_smoke_spills_incidents(spark, rows):
    feed = spark.createDataFrame(
        [("smoke20200101.zip", 0, "2020001 2300", "2020002 0130", "GOES", "5", None)],
        "file string, position int, Start string, End string, Satellite string, Density string, geometry struct<type: string, coordinates: array<array<array<double>>>>",
    )
    got = events.smoke_plumes(feed, empty(spark, "smoke_plumes"))
    assert rows(got, "_UID", "_end", "duration") == [("20200101_0", D(2020, 1, 2, 1, 30), "2:30:00")]
    lines = [(0, "id,name,lat,lon,description"), (1, "5,a,1.5,2.5,broken"), (2, "\ttext"), (3, ""), (4, "6,b,,,ok")]
    broken = spark.createDataFrame([("f", n, v) for n, v in lines], "file string, line_no long, value string")
    got = events.spill_records(broken, ["id", "name", "lat", "lon", "description"])
    assert rows(got, "uid", "description", "the_geom.coordinates") == [("5", "broken text", [2.5, 1.5]), ("6", "ok", None)]
    raw = spark.createDataFrame(
        [("1", "Europe", "2023-05-01", "(1.0, 2.0)"), ("2", "Asia", "2023-05-01", ""), ("3", "Asia", "May", "(1, 2)"), ("4", "Asia", "2001-01-01", "(1, 2)")],
        "`Main ID` string, `Region of Incident` string, `Website Date` string, Coordinates string",
    ).withColumnRenamed("Main ID", "Main_ID")
    stored = spark.createDataFrame([], "uid string")
    new, rejected = events.incidents(raw, stored, "2014-01-01")
    assert rows(new, "uid", "Region", "Incident_Date", "the_geom.coordinates") == [("1", "Europe", D(2023, 5, 1), [2.0, 1.0])]
    assert rows(rejected) == [("no_coordinates", 1), ("no_date", 1), ("too_old", 1)]


def test_tsunamis_displacements_crises(spark, rows):
    raw = spark.createDataFrame([("2020", "1", " ", "1.5", "2.5", "X"), ("2021", "2", "3", None, "1", "Y")], "year string, month string, day string, latitude string, longitude string, locationName string")
    assert rows(events.tsunamis(raw)) == [(2020.0, 1.0, None, 1.5, 2.5, "X")]
    raw = spark.createDataFrame([(1, "2030-02-03", 2019, 'went <a href="http://l">x</a>', 1.0, 2.0)], "id int, displacement_date string, year int, standard_popup_text string, latitude double, longitude double")
    got = events.displacements(raw, spark.createDataFrame([], "id int"), "2024-01-01")
    assert rows(got, "displacement_date_timestamp", "link", "standard_popup_text") == [(D(2019, 2, 3), "http://l", "went ")]
    raw = spark.createDataFrame([("a", "f1", "1", "2"), (" ", "f2", "1", None), ("c", "bad", "1", "2")], "`Event Text` string, file_id string, Latitude string, Longitude string")
    assert rows(events.crisis_events(raw, ["bad"])) == [("a", "f1", "1", "2")]
    assert events.ratifications(raw).columns[0] == "event_text"


def forecast(station, hour, o3, no2=1.88):
    at = D(2024, 1, 1) + dt.timedelta(hours=hour)
    return ("2024-01-01 00:00:00", at.strftime("%Y-%m-%d %H:%M:%S"), station, (o3, no2, 4.0, None))


def test_station_forecasts(spark, rows):
    feed = spark.createDataFrame(
        [forecast(1, h, 1.96 * h) for h in range(12, 36)] + [forecast(2, h, 1.96) for h in range(12, 19)] + [forecast(1, 12, 99.0)],
        "created string, date string, station int, gas struct<o3: double, no2: double, pm25_gcc: double, pm25_gocart: double>",
    ).dropDuplicates(["station", "date"])
    got = stations.station_forecasts(feed, empty(spark, "station_forecasts"))
    assert got.count() == 31
    metrics = {r["name"]: r for r in stations.forecast_metrics(got).collect()}
    assert metrics["1"]["uid"] == "20240101T00_20240102T00_1" and metrics["1"]["date"] == D(2024, 1, 2)
    assert metrics["1"]["o3_ppb_max8houravg"] == pytest.approx(31.5) and metrics["1"]["no2_ppb_max1houravg"] == 1.0
    assert metrics["2"]["o3_ppb_max8houravg"] is None and metrics["2"]["pm25_gcc_ugm3_24houravg"] == 4.0
    assert metrics["2"]["pm25_gocart_ugm3_24houravg"] is None
    known = got.filter("name = '1' and date = timestamp_ntz '2024-01-01 20:00:00'")
    strict = stations.station_forecasts(feed, known, strict=True)
    assert strict.filter("name = '1'").count() == 15 and strict.filter("name = '2'").count() == 7
    have = spark.createDataFrame([("1", 5)], "name string, x int")
    grown = stations.stations_with_new(got, have, spark.createDataFrame([("2", 6), ("3", 7)], "name string, x int"))
    assert rows(grown) == [("1", 5), ("2", 6)]


def test_sensor_readings(spark, rows):
    feed = spark.createDataFrame(
        [
            (("2024-01-01T00:00:00.000Z",), "no2", 46000.0, "µg/m³", "L1", "C", "X", (1.0, 2.0), "a"),
            (("2024-01-01T01:00:00.000Z",), "no2", -1.0, "ppm", "L1", "C", "X", (1.0, 2.0), "a"),
            (("2024-01-02T00:00:00.000Z",), "no2", 1.0, "ppm", "L1", "C", "X", (1.0, 2.0), "a"),
            (("2024-01-01T02:00:00.000Z",), "o3", 3.0, "ppm", "L2", "C", "X", None, "a"),
            (("2024-01-01T03:00:00.000Z",), "co", 3.0, "ppm", "L3", "C", "X", (3.0, 4.0), "a"),
        ],
        "date struct<utc: string>, parameter string, value double, unit string, location string, city string, country string, coordinates struct<longitude: double, latitude: double>, attribution string",
    )
    stored = spark.createDataFrame([("x", "co", D(2024, 1, 1, 3))], "_UID string, parameter string, utc timestamp_ntz")
    got = stations.sensor_readings(feed, stored, "2024-01-01", "2024-01-02")
    assert [(r[0], r[1], round(r[2], 6)) for r in rows(got, "parameter", "utc", "ppm")] == [("no2", D(2024, 1, 1), 22.414)]
    place = stations.sensor_locations(got, spark.createDataFrame([], got.select("_UID", "the_geom", "location", "city", "country").schema))
    assert rows(place, "location", "the_geom.coordinates") == [("L1", [1.0, 2.0])]


def test_transit_feeds(spark, rows):
    feed = spark.createDataFrame([("f1", None, ("l", 1.0, 2.0), (86400,)), ("f2", None, ("m", None, 2.0), (None,))], "id string, none string, l struct<t: string, lat: double, lng: double>, latest struct<ts: long>")
    got = stations.transit_feeds(feed, ["id", "title", "lat", "lng", "ts"], ["l", "latest"])
    assert rows(got, "id", "updated", "the_geom.coordinates") == [("f1", D(1970, 1, 2), [2.0, 1.0]), ("f2", None, None)]


PRICE = "commodityPriceDate string, analysisValueEstimatedPrice double, analysisValuePewiValue double, analysisValuePriceFlag string, marketID int, marketName string, commodityID int, commodityName string, priceTypeID int, priceTypeName string, commodityUnitID int, commodityUnitName string, currencyName string"


def test_price_alerts(spark, rows):
    def price(date, pewi, commodity=1, market=10, flag="actual"):
        return (f"{date}T00:00:00", 5.0, pewi, flag, market, f"M{market}", commodity, f"C{commodity}", 1, "Retail", 2, "KG", "USD")

    raw = spark.createDataFrame(
        [price("2024-03-01", 0.3), price("2024-04-01", 0.2), price("2024-05-01", 9.0, flag="forecast"), price("2024-03-15", 1.0, 2),
         price("2023-01-01", 5.0, 3), price("2024-04-01", 2.0, 1, 11), price("2024-04-01", 2.0, 1, 99), price("2024-04-01", 0.2)],
        PRICE,
    )
    markets = spark.createDataFrame([(10, "M10", 7, "A"), (11, "M11", 7, "A")], "marketId int, marketName string, admin1Code int, admin1Name string")
    commodities = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id int, categoryId int")
    categories = spark.createDataFrame([(1, "cereals and tubers")], "id int, name string")
    got = prices.prices(raw, markets, commodities, categories, empty(spark, "prices"))
    assert got.count() == 6 and rows(got.filter("mktid = 11"), "uid", "alps", "forecast") == [("11_1_1_2_2024-04-01 00:00:00_False", "Crisis", "False")]
    summaries = prices.summarize(got, "2024-05-10")
    expected = "[1] C1 - Retail markets were at a 'normal' level as of 2024-04-01;\n[2] C2 - Retail markets were at a 'alert' level as of 2024-03-15"
    assert rows(summaries.filter("market_id = 10"), "market_interaction", "highest_pewi", "highest_alps", "oldest_interaction_date") == [
        (expected, 1.0, "Alert", D(2024, 3, 15)),
    ]
    only = prices.refreshed_summaries(got.filter("mktid = 11"), got, summaries, "2024-05-10")
    assert rows(only, "market_id") == [(11,)]
    later = prices.refreshed_summaries(got.limit(0), got, summaries, "2024-06-20")
    assert rows(later, "market_id", "market_interaction") == [(10, "[1] C1 - Retail markets were at a 'normal' level as of 2024-04-01")]


def test_energy_prices(spark, rows):
    wide = "FECHA date, ID_NODO string, arrival int, " + ", ".join(f"H{h} double" for h in range(1, 25))
    day = lambda d, node, arrival, v: (d, node, arrival, *[v] * 24)
    frame = spark.createDataFrame([day(dt.date(2024, 1, 8), "N1", 1, 9.0), day(dt.date(2024, 1, 8), "N1", 2, 500.5)], wide)
    hourly = prices.hourly_prices(frame)
    assert hourly.count() == 24 and hourly.agg(F.max("ts")).first()[0] == D(2024, 1, 9)
    assert rows(hourly.select("value").distinct()) == [(500.5,)]
    at = [D(2023, 1, 9, 1), D(2023, 12, 11, 1), D(2024, 1, 1, 1), D(2024, 1, 8, 1)]
    pml = spark.createDataFrame([("N1", t, v) for t, v in zip(at, (50.0, 80.0, 100.0, 500.5))] + [("N2", at[3], 99.5)], "node_id string, ts timestamp_ntz, value double")
    loss = spark.createDataFrame([("N1", at[3], 1.0)], "node_id string, ts timestamp_ntz, value double")
    nodes = spark.createDataFrame([("N1", "S"), ("N2", "S"), ("N3", "S")], "node_id string, system string")
    got = prices.node_prices({"pml": pml, "losses": loss}, nodes, "2024-01-08")
    r = {r["node_id"]: r for r in got.collect()}
    assert set(r) == {"N1", "N2"} and r["N1"]["losses"] == 1.0 and r["N1"]["pml_label"] is None
    assert [round(r["N1"][c], 6) for c in ("last_week_pct_change", "last_month_pct_change", "last_year_pct_change")] == [4.005, 5.25625, 9.01]
    assert r["N2"]["pml_syst_avg"] == 300.0 and r["N2"]["last_week_pct_change"] is None
    loads = spark.createDataFrame([("S", "Z1", "d", 30.0), ("S", "Z2", "d", 10.0)], "system string, load_zone string, entry_date string, load double")
    zones = spark.createDataFrame([("S", "Z1", "north")], "system string, load_zone string, area string")
    assert rows(prices.zone_loads(loads, zones), "load_zone", "area", "load_syst_pct") == [("Z1", "north", 75.0), ("Z2", None, 25.0)]
    nodes_raw = spark.createDataFrame([("N1", "a b ", "S1", "1", "2", "SAN JUAN")], "node_id string, node_name string, system string, state_code string, municipality_code string, municipality string")
    places = spark.createDataFrame([("01", "002", 5.0)], "state_code string, municipality_code string, lat double")
    catalog = prices.node_catalog([nodes_raw, nodes_raw.withColumn("system", F.lit("S2"))], places)
    assert rows(catalog, "node_id", "node_name", "system", "municipality", "lat") == [("N1", "ab", "S1", "San Juan", 5.0)]


def test_node_prices_compare_with_any_earlier_day(spark):
    days = [D(2023, 12, 29, 1), D(2024, 1, 3, 1), D(2024, 1, 5, 1), D(2024, 1, 8, 1)]
    pml = spark.createDataFrame([("N1", t, v) for t, v in zip(days, (10.0, 20.0, 40.0, 60.0))], "node_id string, ts timestamp_ntz, value double")
    nodes = spark.createDataFrame([("N1", "S")], "node_id string, system string")
    r = prices.node_prices({"pml": pml}, nodes, "2024-01-08").first()
    assert [r[c] for c in ("last_week_pct_change", "last_month_pct_change", "last_year_pct_change")] == [0.5, 2.0, 5.0]


def test_countries(spark, rows):
    ddl = "country_name string, year int, value double"
    one = spark.createDataFrame([("France", 2020, 1.0), ("World", 2020, 9.0), ("France", 2021, float("nan"))], ddl)
    two = spark.createDataFrame([("France", 2019, 3.0), ("Nowhere", 2020, 5.0)], ddl)
    codes = spark.createDataFrame([("France", "FRA")], "name string, country_code string")
    got = countries.indicators([(one, "%", "I1"), (two, "m", "I2")], codes)
    assert got.schema == indicator_schema(2) or got.columns == indicator_schema(2).names
    assert rows(got, "year", "indicator_value_1", "indicator_value_2", "indicator_code2") == [
        (2019, None, 3.0, "I2"), (2020, 1.0, None, None), (2021, None, None, None),
    ]
    raw = spark.createDataFrame(
        [("2020", "France", "FRA", "1.5", "u"), ("2020", "France", "FRA", "1.5", "u"), ("2020", "World", "WLD", "2", "u"), ("2020", "G", "A+B", "2", "u"),
         ("2019", "France", "FRA", "--", "u"), ("2018", "France", "FRA", "NA", "u"), ("2020", "OPEC - South America", "OSA", "1", "u")],
        "period string, countryRegionName string, countryRegionId string, value string, unitName string",
    )
    assert rows(countries.energy_by_country(raw), "country", "year", "yr_data") == [("France", 2020, 1.5)]
    asylum = spark.createDataFrame([("A", "B", 2024, 2, "*")], "country_of_origin string, country_of_asylum string, year int, month int, value string")
    assert rows(countries.asylum_totals(asylum, spark.createDataFrame([], "uid string")), "uid", "value") == [
        ("A_2024-02-28_country_of_origin", 0.0), ("B_2024-02-28_country_of_asylum", 0.0),
    ]
    area = spark.createDataFrame([("KE", s, dt.date(2020, 10, 1), 0, "Kenya", "N", 2, None) for s in ("CS", "ML1", "ML2")], "country string, scenario string, file_date date, position int, ADMIN0 string, ADMIN1 string, ifc int, geometry string")
    got = countries.food_scenarios(area, spark.createDataFrame([("KE_202010_CS_0",)], "_uid string"))
    assert rows(got, "_uid", "start_date", "end_date") == [
        ("KE_202010_ML1_0", dt.date(2020, 10, 1), dt.date(2021, 2, 1)), ("KE_202010_ML2_0", dt.date(2021, 2, 1), dt.date(2021, 6, 1)),
    ]
    wars = spark.createDataFrame([(1, "a", "-20", "5"), (2, "a", "-20", "6")], "row_no int, title string, start_year string, end_year string")
    assert rows(countries.water_conflicts(wars), "start_dt", "end_dt") == [(None, dt.date(5, 12, 31))]


def square(x, y, size):
    return ("Polygon", [[[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]])


def test_areas(spark, rows):
    shape = "geometry struct<type: string, coordinates: array<array<array<double>>>>"
    districts = spark.createDataFrame([("d1", "KEN", square(0.0, 0.0, 2.0)), ("d2", "KEN", square(2.0, 0.0, 2.0)), ("d3", "XXX", square(0.0, 0.0, 9.0))], f"objectid string, gid_0 string, {shape}")
    found = spark.createDataFrame([("e1", "Riots", 1.0, 2.0), ("e1", "Riots", 1.0, 2.0), ("e2", "Battles", 1.0, 1.0), ("e3", "Riots", 50.0, 1.0)], "event_id_cnty string, event_type string, latitude double, longitude double")
    got = areas.conflict_by_district(found, districts, spark.createDataFrame([("KEN",)], "gid_0 string"))
    assert rows(got, "objectid", "riots", "battles", "protests", "total") == [("d1", 1, 1, 0, 2), ("d2", 1, 0, 0, 1)]
    features = spark.createDataFrame([("1\r\n", 1, 0, square(0.0, 0.0, 100.0)), ("2", 2, 1999, square(0.0, 0.0, 1.0)), ("3", 3, 1, square(0.0, 0.0, 1.0))], f"WDPA_PID string, WDPAID int, STATUS_YR int, {shape}")
    long, short = areas.protected_areas(features, spark.createDataFrame([("3",)], "WDPA_PID string"))
    assert rows(long, "WDPA_PID", "legal_status_updated_at") == [("1", None)]
    assert rows(short, "WDPA_PID", "legal_status_updated_at") == [("2", dt.date(1999, 1, 1))]
    zones = spark.createDataFrame([("All",), ("None",), ("Part",)], "no_take string")
    assert areas.fully_protected(zones).count() == 2
    nested = spark.createDataFrame(
        [(1, "Park ", [("A", "AAA"), ("B", "BBB")], ("Nat", ("Reg",)), (None,), "12/31/2005")],
        "id int, name string, countries array<struct<name: string, iso_3: string>>, designation struct<name: string, jurisdiction: struct<name: string>>, no_take_status struct<area: double>, legal_status_updated_at string",
    )
    stored = areas.nested_areas(nested, spark.createDataFrame([], "id int"))
    assert rows(stored, "id", "name", "iso3", "jurisdiction", "status_date") == [(1, "Park", "AAA, BBB", "Reg", D(2005, 12, 31))]
    old = stored.unionByName(stored.withColumn("id", F.lit(9)))
    assert rows(areas.nested_areas(nested, old), "id") == [(1,)]
    drought = spark.createDataFrame([("usdm_20240102.json", 4, 2, None)], f"file string, OBJECTID int, DM int, {shape}")
    assert rows(areas.drought_areas(drought, spark.createDataFrame([], "_UID string")), "_UID", "date") == [("20240102_4", D(2024, 1, 2))]


def test_grids(spark, rows):
    hours = [("NO2", D(2024, 1, 1, 12) + dt.timedelta(hours=h), 0, 0, 1.0) for h in range(24)]
    part = [("O3", D(2024, 1, 1, 12) + dt.timedelta(hours=h), 0, 0, 1.0) for h in range(23)]
    cells = spark.createDataFrame(hours + part, "var string, ts timestamp_ntz, row int, col int, value double")
    got = grids.daily_air_quality(cells)
    assert rows(got) == [("NO2", dt.date(2024, 1, 2), 0, 0, 1e9)]
    series_ = spark.createDataFrame([(dt.date(2024, 1, 1), 0, 0, 2.0), (dt.date(2024, 1, 30), 0, 0, 4.0), (dt.date(2024, 1, 31), 0, 0, 6.0)], "date date, row int, col int, value double")
    assert rows(grids.composite(series_), "date", "value") == [(dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 30), 3.0), (dt.date(2024, 1, 31), 5.0)]
    named = series_.withColumn("var", F.lit("chl"))
    assert rows(grids.chlorophyll(named, 2), "date") == [(dt.date(2024, 1, 30),), (dt.date(2024, 1, 31),)]
    assert rows(grids.vegetation(named), "week", "value")[0] == ("2024001", 0.02)
    two = spark.createDataFrame([("bleaching_alert", "d", 0, 0, 251.0), ("dhw", "d", 0, 0, 3.0)], "var string, date string, row int, col int, value double")
    assert rows(grids.coral(two, ["bleaching_alert", "dhw"])) == [("d", 0, 0, -32768.0, 3.0)]
    deep = two.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(7)]))).withColumn("value", F.col("level").cast("double"))
    assert {r["value"] for r in grids.nutrients(deep).collect()} == {2.0}
    tiles = spark.createDataFrame([("d", 1, 0, 0, 5.0), ("d", 2, 0, 0, 0.0), ("d", 1, 0, 1, 7.0), ("d", 2, 0, 1, None)], "date string, order int, row int, col int, value double")
    assert rows(grids.deforestation_alerts(tiles)) == [("d", 0, 1, 7.0)]
    odd = spark.createDataFrame([(270.0, 45.0, "days since 1800-01-01 00:00:0.0", 1.0)], "lon double, offset double, units string, value double")
    assert rows(grids.temperature_anomalies(odd), "lon", "date") == [(-90.0, dt.date(1800, 2, 15))]
    ice = spark.createDataFrame([(0.0, -1000.0, 1), (0.0, -9e6, 2)], "x double, y double, value int")
    assert rows(grids.sea_ice(ice, "north"), "value") == []
    near = spark.createDataFrame([(0.0, -1e6, 1), (0.0, -9e6, 2)], "x double, y double, value int")
    assert rows(grids.sea_ice(near, "north"), "value") == [(1,)]
    run = spark.createDataFrame([("r", s, z, 190.0, 1.0) for s in range(3) for z in range(2)], "run string, step int, level int, lon double, value double")
    assert rows(grids.model_run(run, 2), "band", "lon") == [(b, -170.0) for b in range(4)]
    assert rows(grids.gridded_anomaly(two), "value") == [(3.0,), (None,)]


def test_series(spark, rows):
    lines = spark.createDataFrame([("# note",), ("2016 7 2016.5 404.4 0.1 404.0 0.1",), ("short line",)], "value string")
    assert rows(series.carbon_dioxide(lines), "date", "average") == [(D(2016, 7, 2), 404.4)]
    sea = spark.createDataFrame([("HDR x",), ("0 1 2015.5 1 1 1.5 1 1 1 1 1 1",)], "value string")
    assert rows(series.sea_level(sea, spark.createDataFrame([], "date timestamp_ntz")), "date", "gmsl") == [(D(2015, 7, 2, 12), 1.5)]
    land = spark.createDataFrame([("1880 -0.1 0.2",), ("Year No Smooth",), ("1881 0.1 0.2",)], "value string")
    assert rows(series.land_temperature(land, spark.createDataFrame([(dt.date(1880, 12, 31),)], "date date")), "date", "mean") == [(dt.date(1881, 12, 31), 0.1)]
    ice = spark.createDataFrame([(2020, 9, 15, 3.7412)], "year int, month int, day int, extent double")
    assert rows(series.ice_minimum(ice, spark.createDataFrame([], "date date"))) == [(dt.date(2020, 9, 15), 3741200.0)]


def test_schemas():
    assert [f.dataType.simpleString() for f in from_served({"a": "text", "b": "numeric", "c": "timestamp"})] == ["string", "double", "timestamp_ntz"]


def test_layers_show_measured_and_forecast_dates(spark, rows):
    layers = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d")], "order int, shown string")
    measured = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "date string")
    forecast = spark.createDataFrame([("2024-01-04",), ("2024-01-03",)], "date string")
    got = grids.layer_dates(layers, measured, forecast)
    assert rows(got) == [(0, "2024-01-02"), (1, "2024-01-03"), (2, "2024-01-04"), (3, "d")]
    none = grids.layer_dates(layers, measured.limit(0), forecast.limit(0))
    assert rows(none, "shown") == [("a",), ("b",), ("c",), ("d",)]
