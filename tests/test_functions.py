import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import address, attributes, geo, numbers, payload, text, times
from tidemark.functions import krovak
from tidemark.functions.krovak import to_wgs84


def one(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_clean_text_collapses_every_kind_of_space(spark):
    assert one(spark, ["  a  b\t\nc ", "", None, " "], "string", text.clean_text) == ["a b c", None, None, None]


def test_folds(spark):
    assert one(spark, ["Růžová-12, ŽIŽKOV", None], "string", text.fold) == ["ruzova 12 zizkov", None]
    assert one(spark, ["Růžová-12"], "string", lambda c: text.fold(c, "letters")) == ["ruzova-12"]
    assert one(spark, ["5. května!"], "string", text.slug) == ["5-kvetna"]


def test_street_key_of_four_spellings(spark):
    spellings = ["Nurmiho, Hostivar, Praha", "NURMIHO 12, Praha 15", "nurmiho 12/3", " Nurmiho "]
    assert one(spark, spellings, "string", text.street_key) == ["nurmiho"] * 4
    assert one(spark, ["Praha 4", "", None, "praha"], "string", text.street_key) == [None] * 4


def test_locality_and_layout(spark):
    assert sorted(one(spark, ["Ulice, Praha 4 - Spořilov, Praha"], "string", text.address_locality)[0]) == ["sporilov"]
    assert one(spark, ["2+KK", "3 + 1", "Garsonka garsoniera", "Ostatní", None, ""], "string", text.layout) == ["2+kk", "3+1", "1+kk", None, None, None]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Ke Slatinam, Dolni Mecholupy, Praha", ("Ke Slatinam", "Dolni Mecholupy", "Praha")),
        ("Roháčova, Praha 3 - Žižkov", ("Rohacova", "Zizkov", "Praha")),
        ("Hostivar, Praha", ("", "Hostivar", "Praha")),
        ("Praha 2 - Vinohrady", ("", "Vinohrady", "Praha")),
        ("5. května, Praha 4 - Nusle", ("5. kvetna", "Nusle", "Praha")),
        ("Dlouha 5, Kladno, okres Kladno", ("Dlouha", "", "Kladno")),
        ("", ("", "", "")),
        (None, ("", "", "")),
    ],
)
def test_address(spark, raw, want):
    assert tuple(one(spark, [raw], "string", address.parse)[0]) == want


def test_numbers(spark):
    assert one(spark, ["12,5 m2", "-3", "x", None, "1 000 Kc"], "string", lambda c: numbers.safe_float(c)) == [12.52, -3.0, None, None, 1000.0]
    assert one(spark, ["2.5", "3.5"], "string", numbers.safe_int) == [2, 4]
    assert one(spark, [999, 1000, None], "long", numbers.real_price) == [None, 1000, None]
    assert one(spark, ["inf", "nan", "2", ""], "string", numbers.as_number) == [None, None, 2.0, None]
    assert one(spark, ["True", "yes", "1", "no", None], "string", numbers.as_bool) == [True, True, True, False, False]
    rows = spark.createDataFrame([(1_000_000, 40.0), (1, None), (1, 0.0)], "p long, a double")
    assert [r[0] for r in rows.select(numbers.price_per_m2(F.col("p"), F.col("a"))).collect()] == [25_000, None, None]
    same = spark.createDataFrame([("1", "1.0"), ("A ", "a"), ("a", "b"), (None, "")], "a string, b string")
    assert [r[0] for r in same.select(numbers.same_value(F.col("a"), F.col("b"))).collect()] == [True, True, False, True]
    ranks = spark.createDataFrame([(x,) for x in (1, 2, 4, 9)], "x int").agg(numbers.nearest_rank(F.col("x"), 0.5), numbers.median(F.col("x")), numbers.mean(F.col("x"), 4)).first()
    assert tuple(ranks) == (4, None, 4.0)


def test_days(spark):
    texts = ["2026-09-21T22:30:00Z", "2026-09-21T20:30:00Z", "2026-01-15T23:30:00Z", "2026-01-15T22:30:00Z", "2026-01-15", None, "", "not-a-timestamp-at-all"]
    assert one(spark, texts, "string", times.day_text) == ["2026-09-22", "2026-09-21", "2026-01-16", "2026-01-15", "2026-01-15", "", "", "not-a-time"]
    d = [dt.date(2026, 9, 21), dt.date(2026, 9, 20), dt.date(2027, 1, 1)]
    assert one(spark, d, "date", times.closed_week_end)[:2] == [dt.date(2026, 9, 20), dt.date(2026, 9, 13)]
    assert one(spark, d, "date", times.week_label) == ["2026-W39", "2026-W38", "2026-W53"]
    assert one(spark, [dt.date(2026, 3, 10)], "date", lambda c: times.month_ends(c, 2)) == [[dt.date(2026, 2, 28), dt.date(2026, 1, 31)]]


def test_overlap_hours(spark):
    rows = spark.createDataFrame([("2026-09-19 22:00:00", "2026-09-20 03:30:00"), ("2026-09-20 05:00:00", "2026-09-21 05:00:00")], "a string, b string").select(F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    assert [r[0] for r in rows.select(times.overlap_hours(F.col("a"), F.col("b"), 1.0, 6.0, (6,))).collect()] == [2.5, 1.0]


def test_geo(spark):
    rows = spark.createDataFrame([(50.0444, 14.4789), (50.10, 14.40), (49.0, 14.4), (None, 14.4)], "lat double, lon double")
    got = rows.select(geo.in_box(F.col("lat"), F.col("lon")), geo.in_priority_zone(F.col("lat"), F.col("lon")), geo.shape_of(F.col("lat"), F.col("lon"))).collect()
    assert [tuple(r) for r in got] == [(True, True, "pas-sporilov-horni-mecholupy"), (True, False, None), (False, False, None), (False, False, None)]
    metres = rows.limit(1).select(geo.haversine_m(F.lit(50.0), F.lit(14.0), F.lit(51.0), F.lit(14.0))).first()[0]
    assert abs(metres - 111_195) < 5


def test_krovak_lands_on_the_house(monkeypatch):
    """Three surveyed points of the castle; a shift without rotations is ten metres off, wrong signs would be far more."""
    for y, x in ((744384.54, 1042569.73), (744016.88, 1042411.79), (744100.09, 1042446.40)):
        lat, lon = to_wgs84(np.array([x]), np.array([y]))
        assert 50.089 < lat[0] < 50.092 and 14.398 < lon[0] < 14.407
    # Distances in the grid and on the sphere agree.
    (a, b), (c, d) = (to_wgs84(np.array([x]), np.array([y])) for y, x in ((744384.54, 1042569.73), (744016.88, 1042411.79)))
    metres = math.hypot((a - c)[0] * 111_229, (b - d)[0] * 111_320 * math.cos(math.radians(50.09)))
    assert abs(metres - math.hypot(744384.54 - 744016.88, 1042569.73 - 1042411.79)) < 1
    for name, value in (("SHIFT", (589.0, 76.0, 480.0)), ("TURN", (0, 0, 0)), ("SCALE", 0)):
        monkeypatch.setattr(krovak, name, value)
    p, q = to_wgs84(np.array([1042569.73]), np.array([744384.54]))
    assert 9 < math.hypot((a - p)[0] * 111_229, (b - q)[0] * 111_320 * math.cos(math.radians(50.09))) < 11
    # EPSG's own worked example of the projection, before any change of datum: 50d12'32.442"N 16d50'59.179"E of Greenwich.
    on_bessel = krovak.to_bessel(np.array([1050538.63]), np.array([568991.00]))
    assert abs(np.degrees(on_bessel[0][0]) - 50.2090117) < 1e-6 and abs(np.degrees(on_bessel[1][0]) - 16.8497719) < 1e-6


def test_segment_is_true_to_scale_at_its_mean_latitude(spark):
    def plain(lat, lon, lat_a, lon_a, lat_b, lon_b):
        k = geo.EARTH_M * math.pi / 180
        flat = lambda p, q: (q * k * math.cos(math.radians((lat_a + lat_b) / 2)), p * k)
        (px, py), (ax, ay), (bx, by) = flat(lat, lon), flat(lat_a, lon_a), flat(lat_b, lon_b)
        t = max(0.0, min(1.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))

    points = [(50.0, 14.0), (49.2, 15.5), (52.0, 13.0), (50.5, 14.5)]
    rows = spark.createDataFrame(points, "lat double, lon double")
    got = [r[0] for r in rows.select(geo.segment_m(F.col("lat"), F.col("lon"), 49.0, 14.0, 51.0, 15.0)).collect()]
    assert all(abs(g - plain(*p, 49.0, 14.0, 51.0, 15.0)) < 1e-6 for g, p in zip(got, points, strict=True))


def test_attributes_and_payload(spark):
    assert one(spark, ["BRICK", "nothing", None], "string", lambda c: attributes.by_code("construction", c)) == ["cihla", "", ""]
    assert one(spark, ["Osobní", "státní/obecní"], "string", lambda c: attributes.by_name("ownership", c)) == ["osobni", "obecni"]
    assert one(spark, ["g - very bad", "x"], "string", attributes.energy_class) == ["G", ""]
    assert [tuple(x) for x in one(spark, ["UNDEFINED", "MANUAL_BZR_RK_PRODEJ", "Developer"], "string", attributes.seller)] == [("soukromy", ""), ("rk", ""), ("firma", "developer")]
    records = ['{"premise_id": 7}', '{"premise_id": null}', "{}"]
    assert [tuple(x) for x in one(spark, records, "string", attributes.seller_by_agency)] == [("rk", "7"), ("soukromy", ""), ("", "")]
    assert one(spark, ["6&nbsp;500 000 K&#269;", "cena na vyžádání"], "string", lambda c: payload.price_of(payload.unescape(c))) == [6500000, None]
    assert [tuple(x) for x in one(spark, ["Prodej bytu 2+kk 54,5 m²"], "string", payload.title_parts)] == [("2+kk", 54.5)]
    assert one(spark, ["<b>a&amp;b</b>\n c"], "string", payload.text_of) == ["a&b c"]
    page = '<script type="application/json">{"a":{"id":1,"price":2,"gps":{}},"b":{"id":3}}</script>'
    assert one(spark, [page, None], "string", payload.embedded_advert) == ['{"gps": {}, "id": 1, "price": 2}', None]
    rules = [("/", True), ("/a", False), ("/a/b*c$", True)]
    assert one(spark, ["/x", "/a/z", "/a/b1c", "/a/b1cd"], "string", lambda c: payload.robots_allows(c, rules)) == [True, False, True, False]
