import datetime as dt
import json
import math
import random
import statistics
from collections import Counter

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators import cluster, events, health, inventory, linked, market, match, merge, nearest, quality, spans, views

D = dt.date


def test_status_machine(spark):
    rows = spark.createDataFrame([("active", 0), ("missing_1", 2), ("missing_2", 5), ("active", None), ("missing_3", None), ("removed", 1)], "s string, d int")
    assert [r[0] for r in rows.select(merge.next_status(F.col("s"), F.col("d"))).collect()] == ["missing_1", "missing_2", "removed", "missing_1", "missing_3", "removed"]
    assert [r[0] for r in rows.select(merge.is_live(F.col("s"))).collect()] == [True, True, True, True, True, False]


def advert(i, first, last, status="removed", cluster_id="", relisted="", source="idnes", area=50.0):
    return Row(internal_id=i, source=source, property_type="byt", transaction_type="prodej", disposition="2+kk", area_m2=area, street="a", house_number="", district="d", municipality="m", priority_zone=False, first_seen_at=dt.datetime.combine(first, dt.time(12)), last_seen_at=last, status=status, cluster_id=cluster_id, relisted_from=relisted)


def built(spark, adverts, prices, gap=14, as_of="2026-12-31"):
    listings = spark.createDataFrame(adverts)
    obs = spark.createDataFrame([(i, dt.datetime.combine(d, dt.time(10)), p, "active") for i, d, p in prices], "internal_id string, observed_at timestamp, price long, status string")
    changes = spark.createDataFrame([], "internal_id string, changed_at timestamp, field string")
    return spans.episodes(listings, obs, changes, cluster.property_keys(listings), F.lit(as_of).cast("date"), gap).orderBy("property_key", "episode").collect()


def test_three_portals_are_one_episode(spark):
    rows = [advert("a", D(2026, 1, 1), D(2026, 1, 5), cluster_id="c1", source="sreality"), advert("b", D(2026, 1, 1), D(2026, 1, 5), cluster_id="c1", source="bezrealitky"), advert("c", D(2026, 1, 2), D(2026, 1, 5), cluster_id="c1")]
    out = built(spark, rows, [("a", D(2026, 1, 1), 7_000_000), ("b", D(2026, 1, 1), 7_000_000)])
    assert len(out) == 1 and out[0].listing_count == 3 and out[0].sources == ["bezrealitky", "idnes", "sreality"] and out[0].last_price == 7_000_000 and out[0].price_changes == 0


def test_relisted_twice_is_one_episode(spark):
    rows = [advert("a", D(2026, 1, 1), D(2026, 1, 31)), advert("b", D(2026, 2, 3), D(2026, 2, 28), relisted="a"), advert("c", D(2026, 3, 2), D(2026, 3, 31), relisted="b")]
    out = built(spark, rows, [("a", D(2026, 1, 1), 8_000_000), ("b", D(2026, 2, 3), 7_700_000), ("c", D(2026, 3, 2), 7_400_000)])
    assert len(out) == 1 and out[0].days_on_market == 89 and out[0].discount == 600_000 and abs(out[0].discount_pct - 7.5) < 1e-9 and out[0].outcome == "removed"


def test_gap_is_inclusive(spark):
    rows = [advert("a", D(2026, 1, 1), D(2026, 1, 6)), advert("b", D(2026, 1, 20), D(2026, 1, 30), relisted="a"), advert("c", D(2026, 2, 14), D(2026, 2, 20), relisted="b")]
    out = built(spark, rows, [])
    assert [(e.episode, e.listing_count, e.gap_before_days) for e in out] == [(1, 2, None), (2, 1, 15)]


def episode_rows(spark, rows):
    return spark.createDataFrame([Row(row_id=i, segment_type="byt", segment_deal="prodej", start=s, end=e, gone=g, price=7_000_000.0, days=(e - s).days, discount_pct=None if i else 1.0, cuts=c) for i, (s, e, g, c) in enumerate(rows)], "row_id long, segment_type string, segment_deal string, start date, end date, gone boolean, price double, days int, discount_pct double, cuts array<date>")


def test_market_counts_and_truncated_windows(spark):
    day = dt.timedelta(days=1)
    rows = [(D(2026, 2, 1) + k * day, D(2026, 3, 31), False, []) for k in range(10)]
    e = market.with_segments(episode_rows(spark, rows))
    flow = market.flows(market.daily_supply(e, market.day_grid(e))).filter("segment = 'vse/prodej' AND day = '2026-02-10'").orderBy("window_days").collect()
    assert [r.arrived for r in flow] == [1, 7, 10] and flow[2].covered == 10 and flow[2].arrived_daily == 1.0
    assert [r.departures_confirmed for r in flow] == ["ne", "ano", "ano"]


def test_market_inventory_and_cuts(spark):
    rows = [(D(2026, 2, 1), D(2026, 2, 28), False, [D(2026, 2, 10), D(2026, 2, 12)] if k < 3 else []) for k in range(10)] + [(D(2026, 2, 1), D(2026, 2, 28), True, []) for _ in range(5)]
    e = market.with_segments(episode_rows(spark, rows))
    flow = market.flows(market.daily_supply(e, market.day_grid(e))).filter("segment = 'byt/prodej' AND day = '2026-02-28' AND window_days = 30").first()
    assert flow.supply == 15 and flow.departed == 5 and abs(flow.months_of_inventory - 15 / (5 * 30 / 28)) < 1e-9
    cuts = market.changes_in_window(e, "cuts").filter("segment = 'byt/prodej' AND day = '2026-02-14'").orderBy("window_days").collect()
    assert [(r.window_days, r.changed, r.times_each) for r in cuts] == [(7, 3, 2.0), (30, 3, 2.0)]


def flat(i, lat=50.0755, lon=14.4378, area=55.0, price=6_500_000.0, street="nurmiho", places=("hostivar",), layout="2+kk", deal="prodej"):
    return Row(internal_id=i, property_type="byt", transaction_type=deal, disposition=layout, area_m2=area, lat=lat, lon=lon, street=street, places=list(places), prices=[price] if price else [], seen_from=D(2026, 1, 1), seen_to=D(2026, 1, 4))


FLAT = "internal_id string, property_type string, transaction_type string, disposition string, area_m2 double, lat double, lon double, street string, places array<string>, prices array<double>, seen_from date, seen_to date"


def ranks(spark, *rows):
    return {(r.a_id, r.b_id): r["rank"] for r in match.match_pairs(spark.createDataFrame(rows, FLAT)).collect()}


def test_confidence_tiers(spark):
    metre = 1 / 111_195
    assert ranks(spark, flat("a"), flat("b", lat=50.0755 + 20 * metre)) == {("a", "b"): 3}
    assert ranks(spark, flat("a"), flat("b", lat=50.0755 + 50 * metre, area=57.0)) == {("a", "b"): 2}
    assert ranks(spark, flat("a"), flat("b", lat=50.0755 + 150 * metre, area=60.0)) == {("a", "b"): 1}
    assert ranks(spark, flat("a"), flat("b", lat=50.0755 + 250 * metre)) == {}
    assert ranks(spark, flat("a"), flat("b", street="jina")) == {}
    assert ranks(spark, flat("a"), flat("b", layout="3+kk")) == {} and ranks(spark, flat("a", layout="-"), flat("b", layout="-")) == {}
    assert ranks(spark, flat("a"), flat("b", price=6_400_000.0)) == {} and ranks(spark, flat("a"), flat("b", price=None)) == {}


def test_without_coordinates_street_and_place_decide(spark):
    assert ranks(spark, flat("a", lat=None), flat("b")) == {("a", "b"): 1}
    assert ranks(spark, flat("a", lat=None), flat("b", places=["branik"])) == {}
    assert ranks(spark, flat("a", lat=None, street=None), flat("b", street=None)) == {}


def test_chain_and_star_are_not_cliques(spark):
    edges = spark.createDataFrame([("a", "b", 3), ("b", "c", 3), ("c", "d", 1), ("x", "y", 2), ("y", "z", 2), ("x", "z", 1)], "a string, b string, rank int")
    groups = {}
    for r in cluster.cliques(edges).collect():
        groups.setdefault(r.seed, set()).add(r.internal_id)
    assert groups == {"b": {"a", "b"}, "c": {"c", "d"}, "x": {"x", "y", "z"}}


def brute_names(members, old):
    """One cluster after another, as the rule says."""
    import hashlib

    out, taken = {}, set()
    fresh = lambda ids: "clu_" + hashlib.sha1(",".join(sorted(ids)).encode()).hexdigest()[:10]
    for seed, (_, ids) in sorted(members.items(), key=lambda x: (-x[1][0], x[0])):
        name = next((old[m] for m in sorted(ids) if old.get(m) and old[m] not in taken), None)
        out[seed] = name
        taken.add(name)
    inherited = {n for n in out.values() if n}
    for seed, name in out.items():
        if not name:
            own = fresh(members[seed][1])
            out[seed] = fresh([*members[seed][1], own]) if own in inherited else own
    return out


def test_cluster_ids_go_to_the_first_free_claim(spark):
    cases = [({"a": (3, ["a", "b"]), "c": (2, ["c", "d"])}, {"a": "X", "b": "Y", "c": "X", "d": "Z"})]
    rng = random.Random(3)
    for _ in range(3):
        members = {f"s{k}": (rng.randint(1, 4), [f"s{k}", *(f"m{k}_{j}" for j in range(rng.randint(1, 4)))]) for k in range(30)}
        cases.append((members, {m: f"old{rng.randrange(12)}" for _, ids in members.values() for m in ids if rng.random() < 0.7}))
    cases.append(({"a": (3, ["a", "q"]), "c": (2, ["c", "d"])}, {"a": cluster.cluster_hash(["c", "d"])}))
    for members, old in cases:
        rows = [(m, s, d, 3, len(ids)) for s, (d, ids) in members.items() for m in ids]
        listings = spark.createDataFrame([(m, old.get(m, "")) for _, ids in members.values() for m in ids], "internal_id string, cluster_id string")
        got = {r.internal_id: r.cluster_id for r in cluster.named_clusters(spark.createDataFrame(rows, "internal_id string, seed string, degree long, rank int, members long"), listings).collect()}
        want = brute_names(members, old)
        assert got == {m: want[s] for s, (_, ids) in members.items() for m in ids}


def test_components_of_a_long_chain(spark):
    nodes = spark.createDataFrame([(f"{k:04d}",) for k in range(300)], "id string")
    edges = spark.createDataFrame([(f"{k:04d}", f"{k + 1:04d}") for k in range(299)], "a string, b string")
    assert {r.component for r in cluster.components(nodes, edges).collect()} == {"0000"}


def test_cluster_ids_are_kept_once(spark):
    members = spark.createDataFrame([("a", "a", 1, 3, 2), ("b", "a", 1, 3, 2), ("c", "c", 1, 2, 2), ("d", "c", 1, 2, 2)], "internal_id string, seed string, degree long, rank int, members long")
    listings = spark.createDataFrame([(i, "clu_old") for i in "abcd"], "internal_id string, cluster_id string")
    got = {r.internal_id: (r.cluster_id, r.dedup_confidence) for r in cluster.named_clusters(members, listings).collect()}
    assert got["a"] == got["b"] == ("clu_old", "exact") and got["c"] == got["d"] == (cluster.cluster_hash(["c", "d"]), "high")


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in (*range(61), 100, 101, 200)], "id long")
    got = {r.id: r.component for r in cluster.components(nodes, edges).collect()}
    assert set(got[i] for i in range(61)) == {0} and got[101] == 100 and got[200] == 200


def test_nearest_point_and_crowd(spark):
    metre = 1 / 110_574
    points = spark.createDataFrame([(f"p{k}", "s", str(k // 2), 50.03 + 15 * k * metre, 14.51) for k in range(6)], "point_id string, street string, number string, lat double, lon double")
    rows = spark.createDataFrame([(1, "s", 50.03, 14.51), (2, "s", 50.03 + 400 * metre, 14.51), (3, "other", 50.03, 14.51), (4, "s", None, 14.5)], "id long, street string, lat double, lon double")
    got = {r.id: r for r in nearest.nearest_point(rows, points, "street").collect()}
    assert set(got) == {1} and got[1].point_id == "p0" and got[1].candidates == 1 and got[1].metres < 1


def test_merge_keeps_blanks_out_and_logs_changes(spark):
    old = spark.createDataFrame([("a", "2+kk", "x", "missing_1", D(2026, 1, 1), D(2026, 1, 2)), ("b", None, "x", "active", D(2026, 1, 1), D(2026, 1, 2))], "id string, layout string, url string, status string, first_seen_at date, last_seen_at date")
    new = spark.createDataFrame([("a", "3+kk", ""), ("b", "1+1", "y"), ("c", "4+1", "z")], "id string, layout string, url string")
    today = F.lit("2026-02-01").cast("date")
    table, changes = merge.merge_snapshot(old, new, "id", ["layout"], ["url"], today, today)
    got = {r.id: r for r in table.collect()}
    assert (got["a"].layout, got["a"].url, got["a"].status) == ("3+kk", "x", "active") and got["c"].first_seen_at == D(2026, 2, 1)
    assert [(r.id, r.old_value, r.new_value) for r in changes.collect()] == [("a", "2+kk", "3+kk")]
    assert {r.id for r in merge.merge_snapshot(old, new, "id", ["layout"], ["url"], today, today, insert_new=False)[0].collect()} == {"a", "b"}


def test_suspicious_drop_is_not_absence(spark):
    table = spark.createDataFrame([(i, "s" if i < 30 else "t", "active", D(2026, 1, 1)) for i in range(35)], "id long, scope string, status string, last_seen_at date")
    seen = spark.createDataFrame([(0,), (30,)], "id long")
    scopes = merge.guarded_scopes(table, table.join(seen, "id", "left_semi"), "id", ["scope"], table.select("scope").distinct())
    assert {r.scope: r.trusted for r in scopes.collect()} == {"s": False, "t": True}
    out = merge.mark_absent(table, seen, "id", ["scope"], scopes.filter("trusted"), F.lit("2026-01-04").cast("date"))
    assert {r.status for r in out.filter("id > 30").collect()} == {"missing_3"} and out.filter("id <= 30 AND status <> 'active'").count() == 0


def test_events_keep_the_remembered_price(spark):
    state = spark.createDataFrame([("a", 100, "active"), ("b", 5, "active")], "internal_id string, price long, status string")
    seen = spark.createDataFrame([("a", None, None, "missing_1"), ("b", 5, None, "active"), ("c", 7, None, "active")], "internal_id string, price long, price_per_m2 long, status string")
    out, after = merge.emit_events(seen, state, F.lit("2026-01-01").cast("timestamp"))
    assert {(r.internal_id, r.price) for r in out.collect()} == {("a", None), ("c", 7)}
    assert {(r.internal_id, r.price, r.status) for r in after.collect()} == {("a", 100, "missing_1"), ("b", 5, "active"), ("c", 7, "active")}


def test_change_only_log_repairs_and_maps(spark):
    log = spark.createDataFrame([("a", 1, 100, "x"), ("a", 2, None, "x"), ("a", 3, None, "y"), ("a", 4, 100, "y"), ("a", 5, 90, "y")], "id string, at int, price long, status string")
    assert [r["at"] for r in events.change_only(log, "id", "at", "price", "status", "at").orderBy("at").collect()] == [1, 3, 5]
    m = spark.range(1).select(merge.merge_maps(F.create_map(F.lit("a"), F.lit(1)), F.create_map(F.lit("a"), F.lit(9), F.lit("b"), F.lit(2)))).first()[0]
    assert m == {"a": 1, "b": 2}


def test_quality_faults(spark):
    history = spark.createDataFrame([(D(2026, 1, d), "gps_pct", v) for d, v in ((1, 90.0), (2, 91.0), (3, 92.0), (4, 70.0))], "day date, metric string, value double")
    assert [(r.metric, r.median) for r in quality.drops(history).collect()] == [("gps_pct", 91.0)]
    kept = quality.recorded(history, history.filter("day = '2026-01-04'"), keep=2)
    assert kept.count() == 2
    rows = spark.createDataFrame([("s", "prodej", "active", D(2026, 1, 1))] * 30, "source string, transaction_type string, status string, last_seen_at date")
    stale = quality.stale_groups(rows, ["source", "transaction_type"], "last_seen_at", F.lit("2026-01-10").cast("date"))
    today = spark.createDataFrame([(80.0,)], "agreement_pct double")
    assert {r.check for r in quality.faults(today, stale, history, ["source", "transaction_type"]).collect()} == {"stale", "agreement", "drop"}


def test_health_report(spark, tmp_path):
    from tidemark.sources.tables import read_runs

    def line(at, deals, errors=(), fetched=5, scopes=("byt/prodej",)):
        return json.dumps({"started_at": at, "finished_at": at, "transactions": deals, "sources": {"idnes": {"fetched": fetched, "errors": list(errors), "scopes_absence_marked": list(scopes)}}, "ok": True})

    (tmp_path / "log.jsonl").write_text("\n".join([line("2026-09-21T10:00:00Z", ["prodej"]), "{broken", line("2026-09-21T10:10:00Z", ["prodej"], ["boom"], 0)]))
    runs = read_runs(spark, str(tmp_path / "log.jsonl"))
    assert runs.count() == 2 and read_runs(spark, str(tmp_path / "log.jsonl"), keep_bad=True).filter("bad_line IS NOT NULL").count() == 1
    days = spark.createDataFrame([(D(2026, 9, 1),), (D(2026, 9, 3),)], "day date")
    files = spark.createDataFrame([("x.csv", 60 << 20)], "path string, length long")
    found = {r.check for r in health.report(runs, days, files, F.lit("2026-10-05 12:00:00").cast("timestamp")).collect()}
    assert found == {"gap", "spacing", "rent", "errors", "empty", "freshness", "days", "files"}


def test_inventory_and_views(spark):
    rows = spark.createDataFrame([(1, float(v)) for v in range(1, 12)], "g int, v double")
    q = inventory.quantiles(rows, ["g"], "v").first()
    assert (q.p10, q.p50, q.p90) == (2.0, 6.0, 10.0)
    b = inventory.bootstrap_median(rows, "g", "v").first()
    assert b.low <= 6.0 <= b.high
    docs = spark.createDataFrame([('{"a": {"b": 1}, "c": "{\\"d\\": 2}"}',)], "body string")
    assert {r.path for r in inventory.json_paths(docs, "body").collect()} == {"a", "a.b", "c", "c.d"}
    names = spark.createDataFrame([("nurmiho",), ("nurmih",), ("dlouha",)], "name string")
    assert [r.name for r in nearest.nearest_names(names, "nurmiho").collect()] == ["nurmiho", "nurmih"]
    view = spark.createDataFrame([("a", "Růžová", "active", 1), ("b", "Jiná", "active", 2), ("c", "Růžová", "removed", 3)], "internal_id string, street string, status string, price long").withColumns({"url": F.lit(""), "description": F.lit("")})
    assert [r.internal_id for r in views.on_street(view, "ruzova").collect()] == ["a"] and views.on_street(view, "").count() == 0


def test_bootstrap_equals_resampling_by_two_columns(spark):
    rng = random.Random(3)
    rows = [(g, h, rng.choice([None, float("nan"), *range(30), 1e9, -0.5])) for g, h, n in (("a", "x", 61), ("a", "y", 200), (None, "x", 40), ("b", None, 6), ("c", "x", 3)) for _ in range(n)]
    rows = [(g, h, None if v is None else float(v)) for g, h, v in rows]
    want = {}
    for key in {r[:2] for r in rows}:
        values = sorted(v for *k, v in rows if tuple(k) == key and v is not None and v == v)
        draw = random.Random(7)
        m = sorted(statistics.median(draw.choices(values, k=len(values))) for _ in range(400)) if len(values) >= 5 else None
        want[key] = (len(values), m and m[10], m and m[389])
    df = spark.createDataFrame(rows, "g string, h string, v double")
    assert {(r.g, r.h): (r.n, r.low, r.high) for r in inventory.bootstrap_median(df, ["g", "h"], "v").collect()} == want


def test_json_paths_enter_arrays(spark):
    texts = [
        {"a": [{"b": 1}, {"b": 2, "c": [[{"d": None}]]}, 3, "x"], "e": []}, [{"b": 1}, [{"f": {"g": 1}}]], {"s": json.dumps([{"h": json.dumps({"i": [1]})}])}, {"s": "[no json", "t": "{nor this", "u": '[{"v": 1}, oops]'},
        {"a": {"a": {"a": {"a": {"a": {"a": {"a": {"a": 1}}}}}}}}, [], 5, {"a": [[[[[[[{"z": 1}]]]]]]]}, {"k": [{"l": [{"m": [{"n": 1}]}]}]},
    ]
    want = Counter()

    def walk(x, path, depth, out):
        if depth > 6:
            return
        if isinstance(x, str) and x[:1] in ("{", "["):
            try:
                x = json.loads(x)
            except ValueError:
                return
        if isinstance(x, dict):
            for k, v in x.items():
                out.add(p := f"{path}.{k}" if path else k)
                walk(v, p, depth + 1, out)
        elif isinstance(x, list):
            for v in x:
                walk(v, path + "[]", depth + 1, out)

    for t in texts:
        walk(t, "", 0, out := set())
        want.update(out)
    docs = spark.createDataFrame([(pad + json.dumps(t),) for pad, t in zip(["", " \n", *[""] * len(texts)], texts)] + [(None,), ("",), ("[1, 2",)], "body string")
    assert {r.path: r.n for r in inventory.json_paths(docs, "body").collect()} == want and {"a[].c[][].d", "[][].f.g", "s[].h.i"} <= set(want)


def most_joined(df):
    """The most rows that a join of a frame makes, after it ran."""
    def walk(p):
        if "AdaptiveSparkPlan" in p.nodeName():
            yield from walk(p.executedPlan())
        elif "QueryStage" in p.getClass().getSimpleName():
            yield from walk(p.plan())
        else:
            if "Join" in p.nodeName() and p.metrics().contains("numOutputRows"):
                yield p.metrics().apply("numOutputRows").value()
            kids = p.children()
            for k in range(kids.size()):
                yield from walk(kids.apply(k))

    return max(walk(df._jdf.queryExecution().executedPlan()), default=0)


def test_nearest_points_of_one_key_are_not_paired(spark):
    """A key with 3,000 rows and 3,000 points makes no pairs of them, and copies of spots change nothing."""
    points = spark.range(3000).selectExpr("id AS point_id", "'s' AS street", "id % 7 AS number", "50.0 + (id % 30) / 1000.0 AS lat", "14.5D AS lon")
    rows = spark.range(3000).selectExpr("id", "'s' AS street", "50.0 + (id % 50) / 1000.0 AS lat", "14.5D AS lon")
    df = nearest.nearest_point(rows, points, "street")
    got = {r.id: (r.point_id, r.number, r.candidates) for r in df.collect()}
    assert got == {k: (k % 50 if k % 50 < 30 else 29, (k % 50 if k % 50 < 30 else 29) % 7, 7) for k in range(3000) if k % 50 < 32}
    assert most_joined(df) <= 3000


def test_nearest_point_of_an_id_at_several_spots(spark):
    points = spark.createDataFrame([(1, "s", 1, 50.0, 14.5), (2, "t", 2, 50.0, 14.5), (3, "t", 3, 50.001, 14.5)], "point_id long, street string, number long, lat double, lon double")
    rows = spark.createDataFrame([(1, "s", 50.0, 14.5), (1, "s", 50.0, 14.5), (2, "s", 50.0, 14.5), (2, "t", 50.001, 14.5), (3, "t", 50.0001, 14.5)], "id long, street string, lat double, lon double")
    got = {r.id: (r.point_id, r.candidates) for r in nearest.nearest_point(rows, points, "street").collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (2, 1)}


def test_crowds_of_one_key_are_counted_without_pairs(spark):
    """Only the crowd is asked for, as ``crowd_count`` does: still no pairs, and the farthest of a crowd counts."""
    points = spark.range(3000).selectExpr("id AS point_id", "'s' AS street", "id % 30 AS number", "50.0 + (id % 30) / 10000.0 AS lat", "14.5D AS lon")
    rows = spark.range(3000).selectExpr("id", "'s' AS street", "50.0 - (id % 2) / 1000.0 AS lat", "14.5D AS lon")
    df = nearest.nearest_point(rows, points, "street").select("id", "candidates")
    assert {(r.id % 2, r.candidates) for r in df.collect()} == {(0, 1), (1, 11)}
    assert most_joined(df) <= 3000


def test_a_search_compares_few_places_of_a_spot(spark, monkeypatch):
    """Of 400 places only those in reach are told apart by distance, block by block; results are those of all distances."""
    rng = random.Random(7)
    monkeypatch.setattr(nearest, "BLOCK", 16)
    places = [(k, "s", k % 9, 50 + rng.random() / 10, 14 + rng.random() / 10) for k in range(400)]
    spots = [(k, "s", 50 + rng.random() / 9, 14 + rng.random() / 9) for k in range(200)]
    spots += [(200 + k, *places[k][1:2], *places[k][3:]) for k in range(9)]
    points = spark.createDataFrame(places, "point_id long, street string, number long, lat double, lon double")
    got = {r.id: (r.point_id, r.candidates) for r in nearest.nearest_point(spark.createDataFrame(spots, "id long, street string, lat double, lon double"), points, "street", 600.0).collect()}
    want = {}
    for k, _, lat, lon in spots:
        away = sorted((metres(lat, lon, y, x), i, n) for i, _, n, y, x in places)
        if away[0][0] <= 600:
            want[k] = (away[0][1], len({n for m, _, n in away if m <= max(5, 2 * away[0][0])}))
    assert got == want and 100 < len(want) < 209
    sides = [np.array(c) for c in (*zip(*[s[2:] for s in spots]), *zip(*[p[3:] for p in places]))]
    counts, which = nearest.reached(*sides, 600.0)
    assert len(counts) == 209 and counts.sum() == len(which) < 209 * 12
    assert {k for k, n in enumerate(counts) if n} == set(want)


def metres(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def test_reach_of_odd_coordinates():
    """Ends of the Earth, its date line, turns of longitude and coordinates that are no numbers; a reach is at least five metres."""
    nan, inf = float("nan"), float("inf")
    lat, lon = np.array([90.0, 50.0, -90.0, nan, 50.0, 50.0, 0.0]), np.array([7.0, 179.99999, 3.0, 14.0, inf, 374.0, 0.0])
    p_lat, p_lon = np.array([90.0, 50.0, nan, 50.0, 50.00004, 50.0, 50.00006]), np.array([-100.0, -179.99999, 14.0, inf, 14.0, 14.0, 14.0])
    counts, which = nearest.reached(lat, lon, p_lat, p_lon, 250.0)
    assert counts.tolist() == [1, 1, 0, 0, 0, 2, 0] and which.tolist() == [0, 1, 4, 5]
    assert nearest.reached(np.array([0.0]), np.array([0.0]), np.array([0.0, 0.0]), np.array([179.9, 180.0]), 2.1e7)[0].tolist() == [2]
    assert nearest.reached(np.array([0.0]), np.array([0.0]), np.array([0.0]), np.array([0.0]), 250.0)[0].tolist() == [1]


def test_an_id_that_is_null_stands_at_all_its_spots(spark):
    points = spark.createDataFrame([(1, "s", 1, 50.0, 14.5), (2, "t", 2, 50.0, 14.5)], "point_id long, street string, number long, lat double, lon double")
    rows = spark.createDataFrame([(None, "s", 50.0, 14.5), (None, "t", 50.0, 14.5), (1, "s", 50.0, 14.5)], "id long, street string, lat double, lon double")
    assert sorted((r.id or 0, r.point_id, r.candidates) for r in nearest.nearest_point(rows, points, "street").collect()) == [(0, 1, 2), (1, 1, 1)]


def linked_rows(n, seed):
    """Rows of few values, near the limits of distance, area and price, with nulls, zeros, NaN, repeated ids and several prices and places."""
    rng, step = random.Random(seed), math.degrees(25.0 / 6_371_000.0)
    spot = lambda: rng.choice([None, 0.0, step, step * (1 + 1e-13), step * (1 - 1e-13), 2.4 * step, 8 * step, 8 * step * (1 + 1e-9), 30 * step, math.nan])
    prices = lambda: rng.choice([None, [], [rng.choice([100.0, 105.0, 106.0, 200.0, 210.6, 0.0, -5.0, None, math.nan, math.inf]) for _ in range(rng.choice([1, 1, 1, 3]))]])
    places = lambda: rng.choice([None, [], [rng.choice(["x", "y", "z", "", None]) for _ in range(rng.choice([1, 1, 2]))]])
    for _ in range(n):
        k, up, price = rng.randrange(2 * n), spot(), rng.choice([[100.0], prices()])
        yield (rng.choice([k, k, k, k, None]), rng.choice(["s", "s", "s", "t", None]), rng.choice(["a", "a", "a", "b", None]), "d", rng.choice(["2+1", "2+1", " 2+1 ", "other", None]), rng.choice([50.0, 51.0, 54.0, 60.0, 71.0, 5.0, 0.0, None, math.nan, math.inf]), up, None if up is None else rng.choice([14.0, 14.0, 14.0, None]), places(), price)


def test_linked_equals_components_of_all_pairs(spark, monkeypatch):
    """However blocks are cut, and whatever is left to the rule's own expression."""
    read = "internal_id long, street string, property_type string, transaction_type string, disposition string, area_m2 double, lat double, lon double, places array<string>, prices array<double>"
    for seed, block, cells, slack in ((1, 8192, 1 << 16, 1e-7), (2, 7, 3, 1e-7), (3, 8192, 50, 0.3), (4, 5, 1, 0.3)):
        for name, value in {"BLOCK": block, "CELLS": cells}.items():
            monkeypatch.setattr(linked, name, value)
        rows = spark.createDataFrame(list(linked_rows(400, seed)), read).cache()
        pairs = match.street_pairs(rows, most=1 << 30).filter(match.confidence(match._side("a"), match._side("b"), overlap=False, price_rel_pct=5.0).isNotNull())
        edges = pairs.select(F.col("a.internal_id").alias("a"), F.col("b.internal_id").alias("b"))
        want = {r.id: r.component for r in cluster.components(rows.select(F.col("internal_id").alias("id")), edges).collect()}
        got = cluster.joined(linked.linked(rows, 5.0, slack)).collect()
        assert len(got) == len(want) and {r.id: r.component for r in got} == want and len(set(want.values())) < len(want) - 20
