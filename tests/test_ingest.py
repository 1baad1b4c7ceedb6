"""A run from end to end, and what it is made of, against plain walks over small rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import ingest, register

D, TS = dt.date, dt.datetime
FETCHED = "internal_id string, source string, source_id string, url string, property_type string, transaction_type string, disposition string, area_m2 double, street string, district string, municipality string, lat double, lon double, price long, presence_only boolean"


def moment():
    """When the run is, and its day."""
    return F.lit("2026-03-10 08:00:00").cast("timestamp"), F.lit("2026-03-10").cast("date")


def listings(spark, *rows):
    """Rows given as dicts over blank defaults."""
    base = {f.name: None for f in schemas.LISTINGS} | {"source": "a", "property_type": "byt", "transaction_type": "prodej", "status": "active", "first_seen_at": TS(2026, 1, 1), "last_seen_at": D(2026, 3, 9), "cluster_id": "", "dedup_confidence": "", "relisted_from": "", "coords_origin": ""}
    return spark.createDataFrame([tuple((base | r)[f.name] for f in schemas.LISTINGS) for r in rows], schemas.LISTINGS)


def shown(spark, *rows):
    base = dict.fromkeys(("internal_id", "source_id", "url", "disposition", "area_m2", "street", "district", "municipality", "lat", "lon", "price")) | {"source": "a", "property_type": "byt", "transaction_type": "prodej", "presence_only": False}
    names = [x.split()[0] for x in FETCHED.split(", ")]
    return spark.createDataFrame([tuple((base | r)[c] for c in names) for r in rows], FETCHED)


def state(spark, *rows):
    return spark.createDataFrame(list(rows), "internal_id string, price long, status string")


def scopes(spark, *rows):
    return spark.createDataFrame(list(rows), "property_type string, transaction_type string")


def by_id(df):
    return {r.internal_id: r for r in df.collect()}


def test_merge_source(spark):
    stored = listings(spark, {"internal_id": "seen", "area_m2": 50.0, "disposition": "2+kk"}, {"internal_id": "back", "status": "missing_2"}, {"internal_id": "gone"}, {"internal_id": "late", "last_seen_at": D(2026, 3, 4)}, {"internal_id": "rent", "transaction_type": "pronajem"}, {"internal_id": "other", "source": "b"}, {"internal_id": "quiet"})
    rows = shown(spark, {"internal_id": "seen", "area_m2": 52.0, "disposition": "", "price": 5_200_000}, {"internal_id": "back", "price": 10}, {"internal_id": "new", "area_m2": 40.0, "price": 4_000_000}, {"internal_id": "new", "area_m2": 40.0, "price": 4_000_000}, {"internal_id": "quiet", "presence_only": True})
    before = state(spark, ("seen", 5_300_000, "active"), ("gone", 1_000_000, "active"), ("back", 2_000_000, "missing_2"))
    m = ingest.merge_source(stored, before, ingest.Fetched("a", rows, scopes(spark, ("byt", "prodej")), ["[planned] time budget exhausted"]), *moment())
    got = by_id(m.listings)
    assert {k: r.status for k, r in got.items()} == {"seen": "active", "back": "active", "gone": "missing_1", "late": "removed", "rent": "active", "other": "active", "new": "active", "quiet": "active"}
    assert got["seen"].area_m2 == 52.0 and got["seen"].disposition == "2+kk" and got["seen"].last_seen_at == D(2026, 3, 10) and got["other"].last_seen_at == D(2026, 3, 9)
    assert got["new"].first_seen_at == TS(2026, 3, 10, 8) and got["seen"].first_seen_at == TS(2026, 1, 1)
    assert {(r.internal_id, r.price, r.price_per_m2, r.status) for r in m.observations.collect()} == {("seen", 5_200_000, 100_000, "active"), ("back", None, None, "active"), ("new", 4_000_000, 100_000, "active"), ("gone", None, None, "missing_1"), ("late", None, None, "removed")}
    assert [(r.internal_id, r.field, r.old_value, r.new_value) for r in m.changes.collect()] == [("seen", "area_m2", "50.0", "52.0")]
    assert {k: (r.price, r.status) for k, r in by_id(m.state).items()} == {"seen": (5_200_000, "active"), "back": (2_000_000, "active"), "new": (4_000_000, "active"), "gone": (1_000_000, "missing_1"), "late": (None, "removed")}
    assert [r[0] for r in m.new_ids.collect()] == ["new"]
    s = m.stats
    assert (s["fetched"], s["new"], s["updated"], s["reactivated"], s["missing_marked"], s["removed_confirmed"]) == (4, 1, 2, 1, 2, 1)
    assert s["run_complete"] and s["scopes_absence_marked"] == ["byt/prodej"] and s["interruptions"] == ["time budget exhausted"] and s["errors"] == []


def test_nothing_returned_marks_nothing_absent(spark):
    stored = listings(spark, {"internal_id": "x"})
    m = ingest.merge_source(stored, state(spark), ingest.Fetched("a", shown(spark), scopes(spark, ("byt", "prodej"))), *moment())
    assert by_id(m.listings)["x"].status == "active" and m.observations.count() == 0
    assert len(m.stats["errors"]) == 1 and not m.stats["run_complete"] and m.stats["scopes_absence_marked"] == []


def test_under_half_of_a_scope_marks_nothing_absent(spark):
    stored = listings(spark, *[{"internal_id": f"x{k}"} for k in range(20)])
    few = ingest.merge_source(stored, state(spark), ingest.Fetched("a", shown(spark, *[{"internal_id": f"x{k}"} for k in range(9)]), scopes(spark, ("byt", "prodej"))), *moment())
    half = ingest.merge_source(stored, state(spark), ingest.Fetched("a", shown(spark, *[{"internal_id": f"x{k}"} for k in range(10)]), scopes(spark, ("byt", "prodej"))), *moment())
    assert few.stats["missing_marked"] == 0 and few.stats["errors"] and half.stats["missing_marked"] == 10


def test_observer_collects_or_not_and_sees_strays(spark):
    walk = ingest.Fetched("a", shown(spark, {"internal_id": "n"}), scopes(spark, ("byt", "prodej")))
    inside, outside = listings(spark, {"internal_id": "x", "municipality": "Praha"}), listings(spark, {"internal_id": "x", "municipality": "Brno"})
    assert {k: r.status for k, r in by_id(ingest.observe(inside, state(spark), walk, *moment()).listings).items()} == {"x": "missing_1", "n": "active"}
    assert set(by_id(ingest.observe(inside, state(spark), walk, *moment(), collect=False).listings)) == {"x"}
    stray = ingest.observe(outside, state(spark), walk, *moment())
    assert by_id(stray.listings)["x"].status == "active" and "Brno" in stray.stats["errors"][0]


POINT = {f.name: None for f in schemas.REGISTER}


def points(spark, *rows):
    return spark.createDataFrame([tuple((POINT | r)[f.name] for f in schemas.REGISTER) for r in rows], schemas.REGISTER)


def test_run_from_end_to_end(spark):
    """Two portals show one flat, one of them without a place: it is clustered by street, lent the place, and numbered."""
    flat = {"disposition": "2+kk", "area_m2": 50.0, "price": 5_000_000, "street": "Nurmiho 3", "municipality": "Praha"}
    gone = {"internal_id": "old", "source": "b", "status": "removed", "disposition": "2+kk", "area_m2": 50.0, "lat": 50.05, "lon": 14.5, "last_seen_at": D(2026, 2, 1)}
    register_points = points(spark, {"point_id": "1", "street": "nurmiho", "house_number": "10", "orientation_number": "3", "orientation_letter": "a", "lat": 50.0501, "lon": 14.5}, {"point_id": "2", "street": "nurmiho", "house_number": "12", "lat": 50.0599, "lon": 14.5})
    a = ingest.Fetched("a", shown(spark, flat | {"internal_id": "a1", "lat": 50.05, "lon": 14.5, "street": "Nurmiho"}), scopes(spark, ("byt", "prodej")))
    b = ingest.Fetched("b", shown(spark, flat | {"internal_id": "b1", "source": "b", "street": "Nurmiho"}), scopes(spark, ("byt", "prodej")))
    c = ingest.Fetched("c", shown(spark), scopes(spark), crash="Traceback: no")
    out = ingest.run(listings(spark, gone, {"internal_id": "c1", "source": "c"}), state(spark), [a, b, c], *moment(), register_points, {"a": {"cursor": 4, "precteno": {"x": 1, "y": 2}}})
    got = by_id(out.listings)
    assert out.listings.columns == schemas.LISTINGS.names
    assert set(got) == {"old", "a1", "b1", "c1"} and got["c1"].status == "active"
    assert got["a1"].cluster_id == got["b1"].cluster_id != "" and got["c1"].cluster_id == ""
    assert (got["b1"].lat, got["b1"].lon, got["b1"].coords_origin) == (50.05, 14.5, "cluster")
    assert [(got[k].house_number, got[k].orientation_number, got[k].match_candidates) for k in ("a1", "b1")] == [("10", "3a", 1)] * 2
    assert got["a1"].relisted_from == "old"
    s = out.stats
    assert s["gps_lent_within_clusters"] == 1 and s["numbers_matched"] == 2 and s["total_listings"] == 4 and s["total_observations_written"] == 2 == out.observations.count() and s["total_changes_written"] == 0
    assert s["sources"]["c"]["crashed"] and not s["ok"] and s["progress"] == {"a": {"cursor": 4, "precteno": 2}}
    # The same page again logs nothing and changes nothing.
    again = ingest.merge_source(out.listings, out.state, a, *moment())
    assert again.observations.count() == again.changes.count() == 0 and by_id(again.listings) == got


def test_run_without_rows(spark):
    out = ingest.run(listings(spark), state(spark), [], *moment(), points(spark))
    assert out.listings.count() == out.observations.count() == out.stats["total_listings"] == 0 and out.stats["ok"]


def test_budget_and_messages():
    now = iter([0.0, 1.0, 2.0, 3.0, 100.0, 100.0])
    b = ingest.Budget(60, 2, lambda: next(now))
    assert [b.take() for _ in range(4)] == [True, True, False, False]
    assert b.summary() == {"elapsed_s": 100.0, "max_seconds": 60, "details_used": 2, "details_skipped": 2, "max_details": 2, "stopped_reasons": ["detail budget exhausted", "time budget exhausted"]}
    assert ingest.split_messages(["x", "[planned] y"]) == (["x"], ["y"])


def test_cursors(spark):
    old = spark.createDataFrame([("a", 8, 1), ("b", 3, 0)], "source string, cursor long, cycle long")
    used = spark.createDataFrame([("a", 25, 10), ("c", 5, 0), ("b", -1, 10)], "source string, consumed long, queue_length long")
    assert {tuple(r) for r in ingest.advanced(old, used).collect()} == {("a", 3, 4), ("b", 3, 0), ("c", 5, 0)}
    queue = spark.range(5)
    assert [r.id for r in ingest.rotated(queue, "id", 13, 5).orderBy("turn").collect()] == [3, 4, 0, 1, 2]
    assert ingest.rotated(queue.limit(0), "id", 3, 0).count() == 0
    head, left = ingest.within_budget(queue, ["id"], 2)
    assert [r.id for r in head.collect()] == [0, 1] and left == 3


def test_row_street_and_parts(spark):
    rows = spark.createDataFrame([("Nurmiho 3", "Jina, Praha"), ("", "Jina 5, Praha 2"), (None, "Praha 2 - Vinohrady"), (None, None)], "s string, a string")
    assert [r[0] for r in rows.select(register.row_street(F.col("s"), F.col("a"))).collect()] == ["nurmiho", "jina", None, None]
    got = rows.select(register.located(F.col("a")).alias("x")).select("x.*").collect()
    assert [(r.district, r.district_origin) for r in got] == [("", ""), ("Praha 2", "portal"), ("Vinohrady", "portal"), ("", "")]
    numbers = spark.createDataFrame([("3", "a"), ("3", None), ("", "a"), (None, None)], "n string, l string")
    assert [r[0] for r in numbers.select(register.orientation(F.col("n"), F.col("l"))).collect()] == ["3a", "3", None, None]


@pytest.fixture(scope="module")
def town(spark):
    return points(
        spark,
        {"point_id": "1", "street": "Dlouhá", "house_number": "1", "orientation_number": "1", "district": "Staré Město", "borough": "Praha 1", "lat": 50.09, "lon": 14.42},
        {"point_id": "2", "street": "Dlouhá", "house_number": "2", "district": "Staré Město", "borough": "Praha 1", "lat": 50.0901, "lon": 14.42},
        {"point_id": "3", "street": "Evropská", "house_number": "3", "district": "Dejvice", "lat": 50.1, "lon": 14.39},
        {"point_id": "4", "street": "Evropská", "house_number": "4", "district": "Vokovice", "lat": 50.1, "lon": 14.35},
    )


def test_register_backfill(spark, town):
    rows = listings(
        spark,
        {"internal_id": "hit", "street": "dlouha", "lat": 50.09004, "lon": 14.42, "municipality": "Praha"},
        {"internal_id": "agree", "street": "Dlouha", "district": "Praha 1", "lat": 50.09, "lon": 14.42},
        {"internal_id": "differ", "street": "Dlouha", "district": "Zizkov", "lat": 50.09, "lon": 14.42},
        {"internal_id": "own", "street": "Dlouha", "district": "Stare Mesto", "district_origin": "ruian", "lat": 50.09, "lon": 14.42},
        {"internal_id": "far", "street": "Dlouha", "lat": 50.2, "lon": 14.42, "municipality": "Praha"},
        {"internal_id": "two", "street": "Evropska", "municipality": "Praha"},
        {"internal_id": "out", "street": "Dlouha", "municipality": "Brno"},
        {"internal_id": "unknown", "street": "Kratka", "lat": 50.09, "lon": 14.42, "municipality": "Praha"},
        {"internal_id": "blank", "lat": 50.09, "lon": 14.42, "house_number": "9", "match_distance_m": 1.0},
    )
    got = by_id(register.register_backfill(rows, town))
    assert {k: r.reason for k, r in got.items()} == {"hit": "matched", "agree": "matched", "differ": "matched", "own": "matched", "far": "nearest point too far", "two": "no coordinates", "out": "no coordinates", "unknown": "street not in the register", "blank": "no street"}
    h = got["hit"]
    assert (h.house_number, h.orientation_number, h.match_candidates, h.match_distance_m) == ("1", "1", 2, 4.4) and (h.district, h.district_origin) == ("Stare Mesto", "ruian")
    assert {k: r.district_check for k, r in got.items() if r.district_check} == {"hit": "portal named no district", "agree": "agrees", "differ": "disagrees", "own": "not the portal's district"}
    assert (got["far"].district, got["far"].district_origin) == ("Stare Mesto", "ulice") and got["two"].district is None and got["out"].district is None
    assert got["differ"].district == "Zizkov"
    assert {k for k, r in got.items() if not r.changed} == {"two", "out", "unknown"} and got["blank"].house_number is None
    counts = {(r.what, r.value): r.n for r in register.backfill_counts(register.register_backfill(rows, town)).collect()}
    assert counts["reason", "matched"] == 4 and counts["changed", "true"] == 6 and counts["district_reason", "from the street"] == 1
    assert register.register_backfill(rows.limit(0), town).count() == 0
    assert {r.reason for r in register.register_backfill(rows, town.limit(0)).collect()} == {"no coordinates", "no street", "street not in the register"}


def test_fill_only_unmatched(spark, town):
    rows = listings(spark, {"internal_id": "a", "street": "Dlouha", "lat": 50.09, "lon": 14.42, "house_number": "7", "match_distance_m": 3.0}, {"internal_id": "b", "street": "Dlouha", "lat": 50.09, "lon": 14.42}, {"internal_id": "c", "street": "Dlouha"})
    assert {k: r.house_number for k, r in by_id(register.fill_house_numbers(rows, town)).items()} == {"a": "7", "b": "1", "c": None}


def test_matched_is_what_all_distances_give(spark):
    """Against every distance, points up to twice the limit counted, on a street that holds all rows."""
    import math
    import random

    rng = random.Random(5)
    near = [(str(k), "s", str(rng.randrange(30)), 50 + rng.random() / 100, 14 + rng.random() / 100) for k in range(120)]
    rows = [(k, "S", 50 + rng.random() / 90 - 0.001, 14 + rng.random() / 90 - 0.001) for k in range(150)]
    p = points(spark, *[{"point_id": i, "street": s, "house_number": n, "lat": y, "lon": x} for i, s, n, y, x in near])

    def metres(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    want = {}
    for k, _, y, x in rows:
        away = sorted((metres(y, x, b, a), i, n) for i, _, n, b, a in near)
        if away[0][0] <= 250:
            want[k] = (away[0][2], len({n for m, _, n in away if m <= max(5, 2 * away[0][0])}))
    got = register.matched(spark.createDataFrame(rows, "k long, street string, lat double, lon double"), p).collect()
    assert len(got) == 150 and {r.k: (r.match.house_number, r.match.match_candidates) for r in got if r.match} == want and 50 < len(want)


def test_address_backfill(spark):
    rows = spark.createDataFrame([("a", "Dlouha 3, Praha 1", "Dlouha", "Praha 1", "Praha"), ("b", "Kratka 1, Brno", None, "", "Praha"), ("c", None, None, None, None)], "internal_id string, address string, street string, district string, municipality string")
    got = by_id(register.address_backfill(rows))
    assert not got["a"].changed and not got["c"].changed and got["b"].changed and (got["b"].street, got["b"].municipality) == ("Kratka", "Brno")


def test_borrowed_coordinates_again(spark):
    cols = "internal_id string, source string, property_type string, transaction_type string, disposition string, area_m2 double, lat double, lon double, street string, places array<string>, prices array<double>, seen_from date, seen_to date"
    row = lambda i, s, price, lat: (i, s, "byt", "prodej", "2+kk", 50.0, lat, 14.0, "dlouha", [], [price], None, None)
    borrowed = spark.createDataFrame([row("moved", "a", 1e6, 50.0), row("same", "a", 2e6, 50.2), row("gone", "a", 3e6, 50.3), row("torn", "a", 4e6, 50.4)], cols)
    donors = spark.createDataFrame([row("d1", "s", 1e6, 50.1), row("d2", "s", 2e6, 50.2), row("d4", "s", 4e6, 50.4), row("d5", "s", 4e6, 50.5)], cols)
    verdicts = register.reverified(borrowed, donors, [None])
    assert {k: (r.lat, r.verdict) for k, r in by_id(verdicts).items()} == {"moved": (50.1, "changed"), "same": (50.2, "confirmed"), "gone": (50.3, "kept"), "torn": (50.4, "kept")}
    rows = listings(spark, *[{"internal_id": i, "lat": 50.0, "lon": 14.0, "house_number": "1", "match_distance_m": 1.0, "match_candidates": 1} for i in ("moved", "same")])
    after = by_id(register.apply_reverified(rows, verdicts))
    assert (after["moved"].lat, after["moved"].house_number, after["moved"].match_distance_m) == (50.1, None, None) and (after["same"].lat, after["same"].house_number) == (50.0, "1")


def test_donors_of_a_walk(spark):
    walk = spark.createDataFrame([("7", "byt", "prodej", "2+kk", 50.0, 5e6, 50.0, 14.0, "Dlouha, Praha"), ("8", "byt", "prodej", "2+kk", 50.0, 5e6, None, 14.0, "")], "source_id string, property_type string, transaction_type string, disposition string, area_m2 double, price double, lat double, lon double, address string")
    (got,) = register.donors_from(walk, moment()[1]).collect()
    assert got.internal_id == "sreality-donor-7" and got.first_seen_at == got.last_seen_at == D(2026, 3, 10) and got.status == "active"


def test_a_street_of_many_copies_is_matched_once_a_spot(spark, monkeypatch):
    """2,000 rows and 2,000 points of one street at a few spots: four spots are searched."""
    met, real = [], register.crowds
    monkeypatch.setattr(register, "crowds", lambda *a: met.append(real(*a)) or met[-1])
    point = {c: F.lit(None).cast("string") for c in ("orientation_number", "orientation_letter", "number_kind", "postcode")}
    points = spark.range(2000).select(F.col("id").cast("string").alias("point_id"), F.lit("S").alias("street"), (F.col("id") % 7).cast("string").alias("house_number"), *[v.alias(k) for k, v in point.items()], (50.0 + (F.col("id") % 2) / 1000.0).alias("lat"), F.lit(14.5).alias("lon"))
    rows = spark.range(2000).select("id", F.lit("s").alias("street"), (50.0 + (F.col("id") % 4) / 1000.0).alias("lat"), F.lit(14.5).alias("lon"))
    got = register.matched(rows, points).select("id", "match.house_number", "match.match_candidates", "match.point.point_id").collect()
    assert met[0].count() == 4
    assert {(r.id % 4, r.point_id, r.match_candidates) for r in got} == {(0, "0", 7), (1, "1", 7), (2, "1", 7), (3, "1", 7)} and len(got) == 2000


def test_a_backfill_of_many_copies_joins_no_points_to_rows(spark, monkeypatch):
    """The register is searched for each spot of the listings, and every listing gets its spot's reason."""
    met, real = [], register.crowds
    monkeypatch.setattr(register, "crowds", lambda *a: met.append(real(*a)) or met[-1])
    point = {c: F.lit(None).cast("string") for c in ("orientation_number", "orientation_letter", "number_kind", "postcode", "borough", "quarter")}
    points = spark.range(500).select(F.col("id").cast("string").alias("point_id"), F.lit("S").alias("street"), F.lit("1").alias("house_number"), F.lit("D1").alias("district"), *[v.alias(k) for k, v in point.items()], F.lit(50.0).alias("lat"), F.lit(14.5).alias("lon"))
    rows = spark.range(500).select("id", F.lit("s").alias("street"), F.when(F.col("id") % 4 > 0, 50.0 + (F.col("id") % 4) / 1000.0).alias("lat"), F.lit(14.5).alias("lon"), F.lit("").alias("district"), F.lit("portal").alias("district_origin"), F.lit("Praha").alias("municipality"), *[v.alias(k) for k, v in register.blank_match().items()])
    got = {(r.id % 4, r.reason, r.district) for r in register.register_backfill(rows, points).collect()}
    assert got == {(0, "no coordinates", "D1"), (1, "matched", "D1"), (2, "matched", "D1"), (3, "nearest point too far", "D1")}
    assert met[-1].count() == 2


def test_a_backfill_searches_once_and_puts_a_match_together_once_a_spot(spark, monkeypatch):
    """One search, also for the rows without a street; names of the register are folded where a point is, not for each row."""
    met, real = [], register.crowds
    monkeypatch.setattr(register, "crowds", lambda *a: met.append(a) or real(*a))
    register_points = points(spark, {"point_id": "1", "street": "Dlouhá", "house_number": "1", "district": "Staré Město", "borough": "Praha 1", "lat": 50.09, "lon": 14.42}, {"point_id": "2", "street": "Krátká", "house_number": "2", "district": " ", "quarter": "Žižkov", "lat": 50.09, "lon": 14.42})
    rows = listings(
        spark,
        {"internal_id": "a", "street": "DLOUHA", "district": "stare mesto", "lat": 50.09, "lon": 14.42},
        {"internal_id": "b", "street": "dlouhá", "district": "PRAHA 1", "lat": 50.09, "lon": 14.42},
        {"internal_id": "c", "street": "Kratka", "district": "zizkov", "lat": 50.09, "lon": 14.42},
        {"internal_id": "d", "street": "Kratka", "district": "Karlin", "lat": 50.09, "lon": 14.42},
        {"internal_id": "e", "street": "Kratka", "lat": 50.09, "lon": 14.42},
        {"internal_id": "f", "street": " \\u0301 ", "lat": 50.09, "lon": 14.42},
        {"internal_id": "g", "lat": 50.09, "lon": 14.42},
        {"internal_id": "h", "street": "Dlouha", "municipality": "Praha"},
    )
    out = register.register_backfill(rows, register_points)
    got = by_id(out)
    assert {k: r.district_check for k, r in got.items()} == {"a": "agrees", "b": "agrees", "c": "agrees", "d": "disagrees", "e": "portal named no district", "f": None, "g": None, "h": None}
    assert {k: r.reason for k, r in got.items()} == dict.fromkeys("abcde", "matched") | {"f": "street not in the register", "g": "no street", "h": "no coordinates"}
    assert got["h"].district == "Stare Mesto" and got["e"].district is None and out.columns[: len(rows.columns)] == rows.columns
    assert len(met) == 1 and {"__plain", "__spelled"} <= set(met[0][1].columns)
