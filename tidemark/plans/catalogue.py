"""Registered queries over the driver's tables, each with the DuckDB SQL of the same result where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import geo, numbers, payload, text, times
from tidemark.operators import cluster, events, inventory, linked, market, match, merge, nearest, quality, spans, views
from tidemark.plans import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
Q = Callable[[SparkSession, str], DataFrame]


def query(sql: str | None = None) -> Callable[[Q], Q]:
    def add(f: Q) -> Q:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def cte(*names: str) -> str:
    return "WITH " + ", ".join(A.SQL[n] for n in names)


# Event log


@query(f"""{cte("obs")} SELECT internal_id, c_name AS name, observed_at, status, price
FROM (SELECT *, row_number() OVER (PARTITION BY internal_id ORDER BY observed_at DESC) AS n FROM obs) LEFT JOIN customer ON c_custkey = internal_id WHERE n = 1 AND status <> 'error'""")
def latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is on the market and for how much: listings with their newest observation, live ones only."""
    top = events.newest(A.observations(spark, sf_dir), "internal_id", "observed_at", ["status", "price"])
    names = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("internal_id"), F.col("c_name").alias("name"))
    return top.filter("status <> 'error'").join(names, "internal_id", "left").select("internal_id", "name", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "status", "price")


@query(f"""{cte("obs")} SELECT internal_id, arg_max(price, observed_at) AS price, max(observed_at) AS observed_at FROM obs WHERE price IS NOT NULL GROUP BY internal_id""")
def latest_nonnull_price(spark, sf_dir):
    out = events.newest(A.observations(spark, sf_dir), "internal_id", "observed_at", ["price"], F.col("price").isNotNull())
    return out.select("internal_id", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "price")


@query(f"""{cte("obs")}, k AS (SELECT *, last_value(price IGNORE NULLS) OVER (PARTITION BY internal_id ORDER BY observed_at, event_id ROWS UNBOUNDED PRECEDING) AS known_price FROM obs),
m AS (SELECT *, lag(known_price) OVER w AS p0, lag(status) OVER w AS s0, row_number() OVER w AS n FROM k WINDOW w AS (PARTITION BY internal_id ORDER BY observed_at, event_id))
SELECT internal_id, event_id, price, known_price, status FROM m WHERE n = 1 OR known_price IS DISTINCT FROM p0 OR status IS DISTINCT FROM s0""")
def change_only_log(spark, sf_dir):
    return events.change_only(A.observations(spark, sf_dir), "internal_id", "observed_at", "price", "status", "event_id").select("internal_id", "event_id", "price", "known_price", "status")


@query(f"""{cte("obs")}, m AS (SELECT *, lag(status) OVER w AS before, lag(observed_at) OVER w AS since FROM obs WINDOW w AS (PARTITION BY internal_id ORDER BY observed_at, event_id))
SELECT before, status AS after, count(*) AS n, avg(date_diff('day', since::DATE, observed_at::DATE)) AS mean_days FROM m WHERE before <> status GROUP BY ALL""")
def lifecycle_transitions(spark, sf_dir):
    return events.transitions(A.observations(spark, sf_dir), "internal_id", "observed_at", "status", "event_id")


@query(f"""{cte("obs")}, m AS (SELECT *, lag(price) OVER (PARTITION BY internal_id ORDER BY observed_at, event_id) AS was FROM obs WHERE price IS NOT NULL)
SELECT internal_id, count(*) AS n_prices, count(*) FILTER (was IS NOT NULL AND was <> price) AS price_changes, count(*) FILTER (price < was) AS price_cuts,
coalesce(string_agg(strftime(observed_at, '%Y-%m-%d'), '|' ORDER BY strftime(observed_at, '%Y-%m-%d')) FILTER (was IS NOT NULL AND was <> price), '') AS change_days,
arg_min(price, observed_at) AS first_price, arg_max(price, observed_at) AS last_price, min(price) AS min_price, max(price) AS max_price FROM m GROUP BY internal_id""")
def price_moves(spark, sf_dir):
    return events.price_moves(A.observations(spark, sf_dir), "internal_id", "observed_at", "price", "event_id")


@query(f"""{cte("obs")} SELECT internal_id, string_agg(p::VARCHAR, '|' ORDER BY p) AS prices FROM (SELECT DISTINCT internal_id, floor(price)::BIGINT AS p FROM obs WHERE price IS NOT NULL) GROUP BY internal_id""")
def distinct_price_history(spark, sf_dir):
    rows = A.observations(spark, sf_dir).withColumn("price", F.floor("price"))
    return events.distinct_prices(rows, "internal_id", "price").select("internal_id", F.array_join(F.col("prices").cast("array<string>"), "|").alias("prices"))


@query(f"""{cte("obs")}, d AS (SELECT internal_id AS id, observed_at::DATE AS "day", max(floor(price))::BIGINT AS price FROM obs WHERE price IS NOT NULL GROUP BY ALL),
k AS (SELECT * FROM d WHERE "day" > (SELECT max("day") FROM d) - 7), f AS (SELECT id, price, max("day") AS newest FROM k GROUP BY ALL)
SELECT id, string_agg(price::VARCHAR, '|' ORDER BY newest DESC, price DESC) AS prices FROM f GROUP BY id""")
def price_memory(spark, sf_dir):
    """Prices of the last seven days, newest first, one a day and id."""
    o = A.observations(spark, sf_dir).filter("price IS NOT NULL")
    d = o.groupBy(F.col("internal_id").alias("id"), F.to_date("observed_at").alias("day")).agg(F.max(F.floor("price")).alias("price"))
    last = d.agg(F.max("day")).first()[0]
    return events.remembered_prices(d, F.lit(last)).select("id", F.array_join(F.col("prices").cast("array<string>"), "|").alias("prices"))


# Spans and episodes


_ISLANDS = """, r AS (SELECT *, max("end") OVER (PARTITION BY l_partkey ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM span),
i AS (SELECT *, sum(CASE WHEN "start" - reach <= 14 THEN 0 ELSE 1 END) OVER (PARTITION BY l_partkey ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM r),
x AS (SELECT l_partkey, island::BIGINT AS island, min("start") AS "start", max("end") AS "end", count(*) AS n_spans, max("end") - min("start") AS days FROM i GROUP BY ALL),
y AS (SELECT *, "start" - lag("end") OVER (PARTITION BY l_partkey ORDER BY island) AS gap_before FROM x)"""


@query(f"""{cte("span")}{_ISLANDS} SELECT * FROM y""")
def span_islands(spark, sf_dir):
    return spans.island_rollup(A.spans(spark, sf_dir), "l_partkey")


@query(f"""{cte("span")}{_ISLANDS} SELECT l_partkey, count(*) AS episodes, max(days) AS longest, sum(days)::BIGINT AS total_days, avg(gap_before) AS mean_gap FROM y GROUP BY l_partkey""")
def episode_rollup(spark, sf_dir):
    rows = spans.island_rollup(A.spans(spark, sf_dir), "l_partkey")
    return rows.groupBy("l_partkey").agg(F.count("*").alias("episodes"), F.max("days").alias("longest"), F.sum("days").alias("total_days"), F.avg("gap_before").alias("mean_gap"))


_ADVERTS = """, prop AS (SELECT o_orderkey AS internal_id, o_custkey AS property_key, o_orderdate::DATE AS s, o_orderdate::DATE + (o_orderkey % 30)::INT AS e, CASE o_orderstatus WHEN 'F' THEN 'removed' WHEN 'O' THEN 'active' ELSE 'missing_1' END AS status, o_totalprice AS price FROM orders),
r AS (SELECT *, max(e) OVER (PARTITION BY property_key ORDER BY s, e, internal_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM prop),
i AS (SELECT *, sum(CASE WHEN s - reach <= 14 THEN 0 ELSE 1 END) OVER (PARTITION BY property_key ORDER BY s, e, internal_id ROWS UNBOUNDED PRECEDING) AS island FROM r)"""


@query(f"""WITH one AS (SELECT 1){_ADVERTS}, g AS (SELECT property_key::VARCHAR AS property_key, island::BIGINT AS episode, count(*) AS listing_count, max(e) - min(s) AS days_on_market, CASE WHEN bool_or(status = 'active') THEN 'active' WHEN bool_and(status = 'removed') THEN 'removed' ELSE 'disappearing' END AS outcome,
arg_min(floor(price)::BIGINT, (s, floor(price))) AS first_price, arg_max(floor(price)::BIGINT, (s, floor(price))) AS last_price, min(s) AS s, max(e) AS e FROM i GROUP BY ALL)
SELECT property_key, episode, listing_count, days_on_market, outcome, first_price, last_price, first_price - last_price AS discount, s - lag(e) OVER (PARTITION BY property_key ORDER BY episode) AS gap_before_days FROM g""")
def full_episodes(spark, sf_dir):
    """Episodes of customers' orders, each order an advert with one price."""
    o = A.table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    blank = [F.lit(None).cast("string").alias(c) for c in ("disposition", "street", "house_number", "district", "municipality", "source")]
    status = F.when(F.col("o_orderstatus") == "F", "removed").when(F.col("o_orderstatus") == "O", "active").otherwise("missing_1")
    rows = o.select(F.col("o_orderkey").alias("internal_id"), F.lit("byt").alias("property_type"), F.lit("prodej").alias("transaction_type"), *blank, F.lit(None).cast("double").alias("area_m2"), F.lit(False).alias("priority_zone"), day.alias("first_seen_at"), F.date_add(day, (F.col("o_orderkey") % 30).cast("int")).alias("last_seen_at"), status.alias("status"))
    prices = o.select(F.col("o_orderkey").alias("internal_id"), day.cast("timestamp").alias("observed_at"), F.floor("o_totalprice").alias("price"))
    keys = o.select(F.col("o_orderkey").alias("internal_id"), F.col("o_custkey").cast("string").alias("property_key"))
    none = spark.createDataFrame([], "internal_id long, changed_at timestamp, field string")
    out = spans.episodes(rows, prices, none, keys, F.lit("2000-01-01").cast("date"))
    return out.select("property_key", "episode", "listing_count", "days_on_market", "outcome", "first_price", "last_price", "discount", "gap_before_days")


# Market series


_GRID = """, days AS (SELECT unnest(generate_series((SELECT min("start") FROM epi), (SELECT max("end") FROM epi), INTERVAL 1 DAY))::DATE AS "day"), grid AS (SELECT segment, "day" FROM (SELECT DISTINCT segment FROM epi), days),
u AS (SELECT segment, "start" AS "day", count(*) AS arrived FROM epi GROUP BY ALL), v AS (SELECT segment, "end" + 1 AS "day", count(*) AS after FROM epi GROUP BY ALL), g AS (SELECT segment, "end" AS "day", count(*) AS departed FROM epi WHERE gone GROUP BY ALL),
daily AS (SELECT segment, "day", coalesce(arrived, 0) AS arrived, coalesce(departed, 0) AS departed, (sum(coalesce(arrived, 0) - coalesce(after, 0)) OVER (PARTITION BY segment ORDER BY "day"))::BIGINT AS supply FROM grid LEFT JOIN u USING (segment, "day") LEFT JOIN v USING (segment, "day") LEFT JOIN g USING (segment, "day"))"""
_FLOW = (
    _GRID
    + """, f AS (SELECT segment, "day", w AS window_days, least(w, "day" - min("day") OVER (PARTITION BY segment) + 1) AS covered, supply,
CASE w WHEN 1 THEN arrived WHEN 7 THEN sum(arrived) OVER a ELSE sum(arrived) OVER b END::BIGINT AS arrived, CASE w WHEN 1 THEN departed WHEN 7 THEN sum(departed) OVER a ELSE sum(departed) OVER b END::BIGINT AS departed, CASE w WHEN 1 THEN supply WHEN 7 THEN sum(supply) OVER a ELSE sum(supply) OVER b END::DOUBLE AS total
FROM daily, (SELECT unnest([1, 7, 30]) AS w) WINDOW a AS (PARTITION BY segment, w ORDER BY "day" ROWS 6 PRECEDING), b AS (PARTITION BY segment, w ORDER BY "day" ROWS 29 PRECEDING)),
flow AS (SELECT segment, "day", window_days::INT AS window_days, covered::INT AS covered, supply, arrived, departed, total / covered AS supply_mean, arrived / covered AS arrived_daily, departed / covered AS departed_daily,
CASE WHEN total / covered >= 5 THEN 100.0::DOUBLE * (departed * (30.0::DOUBLE / covered)) / (total / covered) END AS absorption_pct, CASE WHEN departed > 0 AND total / covered >= 5 THEN (total / covered) / (departed * (30.0::DOUBLE / covered)) END AS months_of_inventory, CASE WHEN window_days >= 6 THEN 'ano' ELSE 'ne' END AS departures_confirmed FROM f WHERE supply > 0)"""
)


def _episodes(spark, sf_dir) -> DataFrame:
    return market.with_segments(A.market_episodes(spark, sf_dir))


@query(f"""{cte("epi")}{_GRID} SELECT segment, "day", arrived, departed, supply FROM daily""")
def daily_supply(spark, sf_dir):
    rows = _episodes(spark, sf_dir)
    return market.daily_supply(rows, market.day_grid(rows))


def _flows(spark, sf_dir) -> DataFrame:
    return market.flows(daily_supply(spark, sf_dir))


@query(f"""{cte("epi")}{_FLOW} SELECT * FROM flow""")
def market_flow_windows(spark, sf_dir):
    return _flows(spark, sf_dir)


_HELD = """(SELECT unnest([1, 7, 30]) AS w), LATERAL (SELECT unnest(range(0, w)) AS k)"""


@query(f"""{cte("epi")}, x AS (SELECT segment, "end" + k::INT AS "day", w::INT AS window_days, price, days FROM epi, {_HELD} WHERE gone)
SELECT segment, "day", window_days, CASE WHEN count(price) >= 5 THEN median(price) END AS price_median, CASE WHEN count(*) FILTER (days <= 14) >= 5 THEN median(price) FILTER (days <= 14) END AS quick_price_median, CASE WHEN count(days) >= 5 THEN median(days)::DOUBLE END AS days_median, CASE WHEN count(days) >= 5 THEN avg(days) END AS days_mean, count(*) AS n FROM x GROUP BY ALL""")
def market_medians(spark, sf_dir):
    return market.departure_medians(_episodes(spark, sf_dir))


@query(f"""{cte("epi")}, c AS (SELECT segment, row_id, "start", "end", discount_pct, unnest(["start" + (row_id % 20)::INT, "start" + (row_id % 7)::INT]) AS c FROM epi WHERE row_id % 3 = 0),
x AS (SELECT segment, row_id, c + k::INT AS "day", w::INT AS window_days, "start", "end", discount_pct FROM c, {_HELD}), e AS (SELECT segment, "day", window_days, row_id, count(*) AS times, any_value(discount_pct) AS discount_pct FROM x WHERE "day" BETWEEN "start" AND "end" GROUP BY ALL)
SELECT segment, "day", window_days, count(*) AS changed, avg(times) AS times_each, CASE WHEN count(*) >= 5 THEN median(discount_pct) END AS discount_median, CASE WHEN count(*) >= 5 THEN avg(discount_pct) END AS discount_mean FROM e GROUP BY ALL""")
def cuts_in_window(spark, sf_dir):
    return market.changes_in_window(_episodes(spark, sf_dir), "cuts")


@query("""SELECT coalesce(o_orderpriority, 'vse') || '/' || o_orderstatus AS segment, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), (o_orderstatus))""")
def segment_rollup(spark, sf_dir):
    return _episodes(spark, sf_dir).groupBy("segment").agg(F.count("*").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"))


@query(f"""{cte("epi")}{_FLOW}, r AS (SELECT *, dense_rank() OVER (PARTITION BY segment, window_days ORDER BY "day" DESC) - 1 AS back FROM flow), m AS (SELECT *, least(30, max(back) OVER (PARTITION BY segment, window_days)) AS then_back FROM r),
p AS (SELECT segment, window_days, back, then_back, unnest(['supply', 'supply_mean', 'arrived_daily']) AS measure, unnest([supply::DOUBLE, supply_mean, arrived_daily]) AS value FROM m WHERE back IN (0, then_back)),
q AS (SELECT segment, window_days, measure, max(value) FILTER (back = 0) AS now, max(value) FILTER (back = then_back) AS "then" FROM p GROUP BY ALL)
SELECT *, CASE WHEN "then" <> 0 THEN 100.0::DOUBLE * (now - "then") / "then" END AS change_pct FROM q""")
def market_summary(spark, sf_dir):
    flows = _flows(spark, sf_dir).withColumn("supply", F.col("supply").cast("double"))
    return market.summary(flows, ["supply", "supply_mean", "arrived_daily"], 30)


@query("""WITH d AS (SELECT DISTINCT ts::DATE AS "day" FROM events WHERE event_type = 'signup' AND value > 200) SELECT "day" FROM (SELECT unnest(generate_series((SELECT min("day") FROM d), (SELECT max("day") FROM d), INTERVAL 1 DAY))::DATE AS "day") WHERE "day" NOT IN (SELECT "day" FROM d)""")
def missing_days(spark, sf_dir):
    """Days without a large sign-up."""
    d = A.table(spark, sf_dir, "events").filter("event_type = 'signup' AND value > 200")
    return market.missing_days(d.select(F.to_date("ts").alias("day")))


@query("""WITH s AS (SELECT ts::DATE AS "day", max(value) AS value FROM events WHERE event_type = 'signup' AND day(ts) % 9 = 0 GROUP BY ALL), q AS (SELECT DISTINCT ts::DATE AS "day" FROM events)
SELECT q."day", CASE WHEN q."day" - s."day" <= 7 THEN s."day" END AS stated_on, CASE WHEN q."day" - s."day" <= 7 THEN s.value END AS value FROM q ASOF LEFT JOIN s ON q."day" >= s."day" """)
def asof_value(spark, sf_dir):
    """The last value stated on or up to seven days before each day."""
    e = A.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    series = e.filter("event_type = 'signup' AND day(ts) % 9 = 0").groupBy("day").agg(F.max("value").alias("value"))
    return market.as_of_value(e.select("day").distinct(), series)


@query("""WITH d AS (SELECT event_type AS segment, ts::DATE AS "day", count(*) AS n FROM events GROUP BY ALL) SELECT *, lag(n) OVER w AS before, n - lag(n) OVER w AS change FROM d WINDOW w AS (PARTITION BY segment ORDER BY "day")""")
def day_to_day_change(spark, sf_dir):
    d = A.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("segment"), F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return market.day_to_day(d, "n")


@query("""WITH d AS (SELECT event_type AS segment, ts::DATE AS "day", count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY "day") AS nth, count(*) OVER (PARTITION BY segment) AS c FROM d)
SELECT segment, "day", n FROM r WHERE c >= 3 AND ((nth - 1) % greatest(1, ceil(c / 60.0))::BIGINT = 0 OR nth = c)""")
def thinned_chart(spark, sf_dir):
    d = A.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("segment"), F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return market.thinned(d)


# Matching


_CONF = f"""CASE WHEN least(a.price, b.price) >= 0 AND abs(a.price - b.price) <= 0.05::DOUBLE * greatest(a.price, b.price) THEN
CASE WHEN a.lat IS NOT NULL AND b.lat IS NOT NULL THEN CASE WHEN m <= 25 AND abs(a.area_m2 - b.area_m2) <= greatest(1.0, 0.02::DOUBLE * greatest(a.area_m2, b.area_m2)) THEN 3 WHEN m <= 60 AND abs(a.area_m2 - b.area_m2) <= greatest(1.0, 0.06::DOUBLE * greatest(a.area_m2, b.area_m2)) THEN 2
WHEN m <= 200 AND abs(a.area_m2 - b.area_m2) <= greatest(1.0, 0.15::DOUBLE * greatest(a.area_m2, b.area_m2)) THEN 1 END
WHEN abs(a.area_m2 - b.area_m2) <= greatest(1.0, 0.15::DOUBLE * greatest(a.area_m2, b.area_m2)) AND a.place = b.place THEN 1 END END"""
_PAIRS = f"""pairs AS (SELECT a.internal_id AS a_id, b.internal_id AS b_id, {_CONF.replace(" m <= ", f" {A.haversine_sql('a', 'b')} <= ")} AS rank FROM ent a JOIN ent b ON a.street = b.street AND a.internal_id < b.internal_id)"""


def _pairs(spark, sf_dir) -> DataFrame:
    e = A.entities(spark, sf_dir)
    rank = match.confidence(match._side("a"), match._side("b"), overlap=False, price_rel_pct=5.0)
    return match.street_pairs(e, most=1 << 30).select(F.col("a.internal_id").alias("a_id"), F.col("b.internal_id").alias("b_id"), rank.alias("rank")).filter("rank IS NOT NULL")


@query(f"""{cte("ent")}, {_PAIRS} SELECT a_id, b_id, rank FROM pairs WHERE rank IS NOT NULL""")
def pair_confidence(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(f"""{cte("cust", "supp")} SELECT a.id AS a_id, b.id AS b_id FROM cust a, supp b WHERE {A.haversine_sql("a", "b")} <= 200""")
def grid_pairs(spark, sf_dir):
    """Customers and suppliers within 200 m, by grid cells."""
    pairs = match.grid_pairs(A.points(spark, sf_dir, "customer"), A.points(spark, sf_dir, "supplier"))
    away = geo.haversine_m(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    return pairs.filter(away <= 200).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


@query(f"""{cte("ent")}, s AS (SELECT *, count(*) OVER (PARTITION BY street) AS c FROM ent) SELECT a.internal_id AS a_id, b.internal_id AS b_id FROM s a JOIN s b ON a.street = b.street AND a.internal_id < b.internal_id WHERE a.c <= 16""")
def street_block_capped(spark, sf_dir):
    """Pairs on streets of at most sixteen rows, as its SQL states; ``street_block_pairs`` has the limit of the rule."""
    return match.street_pairs(A.entities(spark, sf_dir), most=16).select(F.col("a.internal_id").alias("a_id"), F.col("b.internal_id").alias("b_id"))


@query(f"""{cte("ent")}, s AS (SELECT *, count(*) OVER (PARTITION BY street) AS c FROM ent) SELECT a.internal_id AS a_id, b.internal_id AS b_id FROM s a JOIN s b ON a.street = b.street AND a.internal_id < b.internal_id WHERE a.c <= 400""")
def street_block_pairs(spark, sf_dir):
    """Pairs on one street; streets above the limit of the rule are skipped."""
    return match.street_pairs(A.entities(spark, sf_dir)).select(F.col("a.internal_id").alias("a_id"), F.col("b.internal_id").alias("b_id"))


@query(f"""{cte("span")} SELECT a.l_partkey, count(*) AS overlapping FROM span a JOIN span b USING (l_partkey) WHERE a."start" - 30 <= b."end" AND b."start" - 30 <= a."end" GROUP BY ALL""")
def interval_overlap_pairs(spark, sf_dir):
    """Ordered pairs of a part's spans that overlap within 30 days, each with itself too."""
    s = A.spans(spark, sf_dir).select("l_partkey", F.col("start").alias("seen_from"), F.col("end").alias("seen_to"))
    pairs = s.select("l_partkey", F.struct("seen_from", "seen_to").alias("a")).join(s.select("l_partkey", F.struct("seen_from", "seen_to").alias("b")), "l_partkey")
    return pairs.filter(match.windows_overlap(match._side("a"), match._side("b"))).groupBy("l_partkey").agg(F.count("*").alias("overlapping"))


def _edges(spark, sf_dir) -> DataFrame:
    return _pairs(spark, sf_dir).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "rank")


@query(f"""WITH RECURSIVE {A.SQL["ent"]}, {_PAIRS}, e AS (SELECT a_id AS a, b_id AS b FROM pairs WHERE rank IS NOT NULL UNION SELECT b_id, a_id FROM pairs WHERE rank IS NOT NULL), r AS (SELECT internal_id AS id, internal_id AS c FROM ent UNION SELECT e.b, r.c FROM r JOIN e ON r.id = e.a) SELECT id, min(c) AS component FROM r GROUP BY id""")
def components(spark, sf_dir):
    """Components of matches, without their pairs."""
    return cluster.joined(linked.linked(A.entities(spark, sf_dir), 5.0))


@query()
def clique_clusters(spark, sf_dir):
    """Greedy cliques with confidence by name and stable ids."""
    e = _edges(spark, sf_dir).select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "rank")
    listings = A.entities(spark, sf_dir).select(F.col("internal_id").cast("string").alias("internal_id"), "cluster_id")
    return cluster.named_clusters(cluster.cliques(e), listings)


_ORDER_ADVERTS = "x AS (SELECT o_orderkey AS internal_id, o_orderpriority AS disposition, o_orderstatus, o_orderdate::DATE AS d, (o_custkey % 50 + 30)::DOUBLE AS area_m2, 50.0::DOUBLE + (o_custkey * 7919 % 2000) / 10000.0::DOUBLE AS lat, 14.4::DOUBLE + (o_custkey * 104729 % 2000) / 10000.0::DOUBLE AS lon FROM orders)"


@query(f"""WITH {_ORDER_ADVERTS}, p AS (SELECT a.internal_id, b.internal_id AS relisted_from, {A.haversine_sql("a", "b")} AS m, abs(a.area_m2 - b.area_m2) AS df, greatest(a.area_m2, b.area_m2) AS gr FROM x a JOIN x b ON a.disposition = b.disposition AND a.o_orderstatus = 'O' AND b.o_orderstatus = 'F' AND b.d <= a.d AND a.d - b.d <= 365 AND b.lat BETWEEN a.lat - 0.004 AND a.lat + 0.004),
s AS (SELECT internal_id, relisted_from, CASE WHEN m <= 25 AND df <= greatest(1.0, 0.02::DOUBLE * gr) THEN 3 WHEN m <= 60 AND df <= greatest(1.0, 0.06::DOUBLE * gr) THEN 2 WHEN m <= 200 AND df <= greatest(1.0, 0.15::DOUBLE * gr) THEN 1 END AS rank FROM p)
SELECT internal_id, relisted_from, rank FROM (SELECT *, row_number() OVER (PARTITION BY internal_id ORDER BY rank DESC, relisted_from) AS n FROM s WHERE rank IS NOT NULL) WHERE n = 1""")
def relist_candidate(spark, sf_dir):
    k = F.col("o_custkey")
    day = F.to_date("o_orderdate")
    rows = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("internal_id"), F.lit("byt").alias("property_type"), F.lit("prodej").alias("transaction_type"), F.col("o_orderpriority").alias("disposition"), F.lit(None).cast("string").alias("street"), F.array().cast("array<string>").alias("places"), F.array().cast("array<double>").alias("prices"), (k % 50 + 30).cast("double").alias("area_m2"), (50.0 + (k * 7919 % 2000) / 10000.0).alias("lat"), (14.4 + (k * 104729 % 2000) / 10000.0).alias("lon"), day.alias("first_seen"), day.alias("last_seen"), "o_orderstatus")
    return match.relist_candidates(rows.filter("o_orderstatus = 'O'"), rows.filter("o_orderstatus = 'F'"))


_NEAR = f"""{cte("cust", "supp")}, away AS (SELECT a.id, b.id AS point_id, b.id % 7 AS number, {A.haversine_sql("a", "b")} AS metres, b.lat, b.lon FROM cust a JOIN supp b USING (nation)), low AS (SELECT *, min(metres) OVER (PARTITION BY id) AS least FROM away)"""


def _nearest(spark, sf_dir) -> DataFrame:
    places = A.points(spark, sf_dir, "supplier").select(F.col("id").alias("point_id"), "nation", (F.col("id") % 7).alias("number"), "lat", "lon")
    return nearest.nearest_point(A.points(spark, sf_dir, "customer"), places, "nation", 5000.0)


@query(_NEAR + """SELECT id, arg_min(point_id, (metres, point_id)) AS point_id, arg_min(number, (metres, point_id)) AS number, min(metres) AS metres FROM low WHERE least <= 5000 GROUP BY id""")
def nearest_point(spark, sf_dir):
    return _nearest(spark, sf_dir).select("id", "point_id", "number", "metres")


@query(_NEAR + """SELECT id, count(DISTINCT number) FILTER (metres <= greatest(5.0, 2 * least)) AS candidates FROM low WHERE least <= 5000 GROUP BY id""")
def crowd_count(spark, sf_dir):
    return _nearest(spark, sf_dir).select("id", "candidates")


@query(_NEAR + """, r AS (SELECT id, point_id AS donor, CASE WHEN metres <= 2000 THEN 3 WHEN metres <= 5000 THEN 2 ELSE 1 END AS rank, lat, lon FROM away WHERE metres <= 10000), t AS (SELECT *, max(rank) OVER (PARTITION BY id) AS best FROM r)
SELECT id, min(donor) AS donor, max(rank) AS rank, min(lat) AS lat, min(lon) AS lon FROM t WHERE rank = best GROUP BY id HAVING min(lat) = max(lat) AND min(lon) = max(lon)""")
def unambiguous_donor(spark, sf_dir):
    c, s = A.points(spark, sf_dir, "customer"), A.points(spark, sf_dir, "supplier")
    pairs = c.select("id", "nation", F.col("lat").alias("la"), F.col("lon").alias("lo")).join(s.select(F.col("id").alias("donor"), "nation", "lat", "lon"), "nation")
    away = geo.haversine_m(F.col("la"), F.col("lo"), F.col("lat"), F.col("lon"))
    scored = pairs.filter(away <= 10000).withColumn("rank", F.when(away <= 2000, 3).when(away <= 5000, 2).otherwise(1))
    return match.unambiguous_donor(scored.select("id", "donor", "rank", "lat", "lon"))


_STAGE = """SELECT r.internal_id AS id, d.internal_id AS donor, d.lat, d.lon FROM ent r JOIN ent d ON r.street = d.street AND r.source = 's0' AND d.source <> 's0' AND abs(r.area_m2 - d.area_m2) <= 3 AND r.place = d.place"""


@query(f"""{cte("ent")}, p1 AS ({_STAGE} AND r.price = d.price), f1 AS (SELECT id, min(donor) AS donor, min(lat) AS lat, min(lon) AS lon FROM p1 GROUP BY id HAVING min(lat) = max(lat) AND min(lon) = max(lon)),
p2 AS ({_STAGE} AND abs(r.price - d.price) <= 0.1::DOUBLE * greatest(r.price, d.price) WHERE r.internal_id NOT IN (SELECT id FROM f1)), f2 AS (SELECT id, min(donor) AS donor, min(lat) AS lat, min(lon) AS lon FROM p2 GROUP BY id HAVING min(lat) = max(lat) AND min(lon) = max(lon))
SELECT *, 1 AS stage FROM f1 UNION ALL SELECT *, 2 FROM f2""")
def staged_match(spark, sf_dir):
    """Donors at an equal price first, then within a tenth, for parts without coordinates."""
    e = A.entities(spark, sf_dir)
    return match.staged(e.filter("source = 's0'"), e.filter("source <> 's0'"), [None, 10.0], area_abs_m=3.0).select("id", "donor", "lat", "lon", "stage")


@query(f"""{cte("ent")}, d AS (SELECT street, arg_min(lat, internal_id) AS dl, arg_min(lon, internal_id) AS dn FROM ent WHERE lat IS NOT NULL GROUP BY street) SELECT internal_id, coalesce(lat, dl) AS lat, coalesce(lon, CASE WHEN lat IS NULL THEN dn END) AS lon, CASE WHEN lat IS NULL AND dl IS NOT NULL THEN 'cluster' ELSE '' END AS coords_origin FROM ent LEFT JOIN d USING (street)""")
def cluster_lend(spark, sf_dir):
    e = A.entities(spark, sf_dir).select("internal_id", F.col("street").alias("cluster_id"), "lat", "lon", F.lit("").alias("coords_origin"))
    return nearest.lend_in_clusters(e).drop("cluster_id")


@query("""SELECT c_nationkey, min(c_mktsegment) AS "only" FROM customer WHERE c_acctbal < -800 GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) = 1""")
def sole_value_lookup(spark, sf_dir):
    """The segment of a nation's indebted customers, if they have one only; ``sole_value_all`` leaves no customer out."""
    return nearest.sole_value(A.table(spark, sf_dir, "customer").filter("c_acctbal < -800"), "c_nationkey", "c_mktsegment")


@query("""SELECT c_acctbal, min(c_mktsegment) AS "only" FROM customer GROUP BY c_acctbal HAVING count(DISTINCT c_mktsegment) = 1""")
def sole_value_all(spark, sf_dir):
    """The segment that all customers of one balance are in."""
    return nearest.sole_value(A.table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment")


@query(f"""{cte("ent")} SELECT a.internal_id AS a_internal_id, b.internal_id AS b_internal_id FROM ent a JOIN ent b ON round(a.lat, 4) = round(b.lat, 4) AND round(a.lon, 4) = round(b.lon, 4) AND a.disposition = b.disposition AND a.internal_id < b.internal_id AND a.source <> b.source AND abs(a.area_m2 - b.area_m2) <= 1""")
def near_misses(spark, sf_dir):
    return nearest.near_misses(A.entities(spark, sf_dir))


@query(f"""{cte("ent")}, p AS (SELECT r.internal_id AS id, r.price AS pa, d.price AS pb, r.area_m2 AS aa, d.area_m2 AS ab FROM ent r JOIN ent d ON r.street = d.street AND r.source = 's0' AND d.source = 's1'), t AS (SELECT id, u.rule, u.pct, u.m, count(*) FILTER ((u.pct IS NULL OR abs(pa - pb) <= u.pct / 100.0::DOUBLE * greatest(pa, pb)) AND abs(aa - ab) <= u.m) AS n FROM p, (VALUES ('exact', 0.0::DOUBLE, 1.0::DOUBLE), ('tenth', 10.0, 5.0), ('any', NULL, 5.0)) u(rule, pct, m) GROUP BY ALL)
SELECT rule, count(*) FILTER (n = 1) AS one, count(*) FILTER (n > 1) AS ambiguous, count(*) FILTER (n = 0) AS "none" FROM t GROUP BY rule""")
def donor_rule_grid(spark, sf_dir):
    e = A.entities(spark, sf_dir)
    side = lambda s, p, i: e.filter(F.col("source") == s).select("street", F.col("internal_id").alias(i), F.col("price").alias(f"price_{p}"), F.col("area_m2").alias(f"area_{p}"))
    return match.rule_grid(side("s0", "a", "id").join(side("s1", "b", "donor"), "street"), [("exact", 0.0, 1.0), ("tenth", 10.0, 5.0), ("any", None, 5.0)])


# Merging


_OLD = "old AS (SELECT o_orderkey AS internal_id, o_totalprice AS price, o_orderpriority AS priority, o_orderdate::DATE AS first_seen_at, o_orderdate::DATE AS last_seen_at, CASE WHEN o_orderkey % 4 = 0 THEN 'missing_2' ELSE 'active' END AS status FROM orders WHERE o_orderkey % 10 < 8)"
_NEW = "new AS (SELECT o_orderkey AS internal_id, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 100 WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN lower(o_orderpriority) WHEN o_orderkey % 13 = 0 THEN 'changed' ELSE o_orderpriority END AS priority FROM orders WHERE o_orderkey % 10 >= 3)"


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as a stored table and a newer snapshot that share half their keys."""
    o, k, p, d = A.table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_totalprice"), F.to_date("o_orderdate")
    old = o.filter(k % 10 < 8).select(k.alias("internal_id"), p.alias("price"), F.col("o_orderpriority").alias("priority"), d.alias("first_seen_at"), d.alias("last_seen_at"), F.when(k % 4 == 0, "missing_2").otherwise("active").alias("status"))
    word = F.when(k % 6 == 0, "").when(k % 11 == 0, F.lower("o_orderpriority")).when(k % 13 == 0, "changed").otherwise(F.col("o_orderpriority"))
    return old, o.filter(k % 10 >= 3).select(k.alias("internal_id"), F.when(k % 5 == 0, p + 100).when(k % 7 != 0, p).alias("price"), word.alias("priority"))


def _today() -> F.Column:
    return F.lit("2000-01-01").cast("date")


@query(f"""WITH {_OLD}, {_NEW} SELECT coalesce(old.internal_id, new.internal_id) AS internal_id, coalesce(new.price, old.price) AS price, CASE WHEN new.priority <> '' THEN new.priority ELSE old.priority END AS priority, CASE WHEN old.internal_id IS NULL THEN DATE '2000-01-01' ELSE first_seen_at END AS first_seen_at,
CASE WHEN new.internal_id IS NULL THEN last_seen_at ELSE DATE '2000-01-01' END AS last_seen_at, CASE WHEN new.internal_id IS NULL THEN status ELSE 'active' END AS status FROM old FULL JOIN new ON old.internal_id = new.internal_id""")
def merge_snapshot(spark, sf_dir):
    return merge.merge_snapshot(*_halves(spark, sf_dir), "internal_id", ["price", "priority"], [], _today(), _today())[0]


@query(f"""WITH {_OLD}, {_NEW} SELECT old.internal_id, 'price' AS field FROM old JOIN new USING (internal_id) WHERE abs(old.price - new.price) >= 1e-9 UNION ALL SELECT old.internal_id, 'priority' FROM old JOIN new USING (internal_id) WHERE new.priority <> '' AND lower(old.priority) <> lower(new.priority)""")
def merge_changes(spark, sf_dir):
    return merge.merge_snapshot(*_halves(spark, sf_dir), "internal_id", ["price", "priority"], [], _today(), _today())[1].select("internal_id", "field")


@query(f"""WITH {_OLD}, {_NEW}, t AS (SELECT *, left(priority, 1) AS scope FROM old), b AS (SELECT scope, count(*) FILTER (status = 'active') AS active_before FROM t GROUP BY scope), n AS (SELECT t.scope, count(*) AS seen_now FROM t JOIN new USING (internal_id) WHERE t.scope <> '1' GROUP BY t.scope),
g AS (SELECT scope, NOT (active_before >= 20 AND coalesce(seen_now, 0) < active_before * 0.5) AS trusted FROM b LEFT JOIN n USING (scope))
SELECT t.internal_id, CASE WHEN trusted AND t.internal_id NOT IN (SELECT internal_id FROM new) AND status <> 'removed' THEN CASE WHEN DATE '2000-01-01' - last_seen_at >= 5 THEN 'removed' ELSE 'missing_' || greatest(1, DATE '2000-01-01' - last_seen_at) END ELSE status END AS status FROM t JOIN g USING (scope)""")
def absence_scope_guard(spark, sf_dir):
    """Absence in scopes that passed the guard; one scope shows nothing and is not trusted."""
    old, new = _halves(spark, sf_dir)
    t = old.withColumn("scope", F.substring("priority", 1, 1))
    seen = t.join(new.select("internal_id"), "internal_id", "left_semi")
    scopes = merge.guarded_scopes(t, seen.filter("scope <> '1'"), "internal_id", ["scope"], t.select("scope").distinct())
    return merge.mark_absent(t, new, "internal_id", ["scope"], scopes.filter("trusted"), _today()).select("internal_id", "status")


@query("""SELECT o_orderkey, CASE WHEN s = 'removed' THEN s WHEN d IS NULL THEN 'missing_' || greatest(1, coalesce(TRY_CAST(nullif(regexp_extract(s, '^missing_(\\d+)$', 1), '') AS INT), 0)) WHEN d >= 5 THEN 'removed' ELSE 'missing_' || greatest(1, d) END AS status
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 8 END AS d, CASE o_orderstatus WHEN 'F' THEN 'removed' WHEN 'O' THEN 'active' ELSE 'missing_' || o_orderkey % 4 END AS s FROM orders)""")
def status_machine(spark, sf_dir):
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "removed").when(F.col("o_orderstatus") == "O", "active").otherwise(F.concat(F.lit("missing_"), (k % 4).cast("string")))
    return A.table(spark, sf_dir, "orders").select("o_orderkey", merge.next_status(status, F.when(k % 11 > 0, (k % 8).cast("int"))).alias("status"))


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderpriority AS p, o_orderdate::DATE AS f, o_orderdate::DATE + 9 AS l FROM orders WHERE o_orderkey % 3 <> 0), t AS (SELECT o_orderkey AS id, 'their ' || o_orderpriority AS p, o_orderdate::DATE - 3 AS f, o_orderdate::DATE AS l FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.id, t.id) AS id, CASE WHEN o.id IS NOT NULL THEN o.p ELSE t.p END AS priority, least(o.f, t.f) AS first_seen, greatest(o.l, t.l) AS last_seen FROM o FULL JOIN t ON o.id = t.id WHERE (o.id IS NOT NULL AND t.id IS NOT NULL) OR coalesce(o.id, t.id) NOT IN (SELECT id FROM b)""")
def three_way_merge(spark, sf_dir):
    """Two copies as its SQL splits them, which leaves orders divisible by fifteen out; ``three_way_all`` leaves none out."""
    o, k, d = A.table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.to_date("o_orderdate")
    ours = o.filter(k % 3 != 0).select(k.alias("id"), F.col("o_orderpriority").alias("priority"), d.alias("first_seen"), F.date_add(d, 9).alias("last_seen"))
    theirs = o.filter(k % 5 != 0).select(k.alias("id"), F.concat(F.lit("their "), "o_orderpriority").alias("priority"), F.date_sub(d, 3).alias("first_seen"), d.alias("last_seen"))
    return merge.three_way(ours, theirs, o.filter(k % 2 == 0).select(k.alias("id")), "id", ["priority"], "first_seen", "last_seen")


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderpriority AS p, o_orderdate::DATE AS f, o_orderdate::DATE + 9 AS l FROM orders WHERE o_orderkey % 10 < 8), t AS (SELECT o_orderkey AS id, 'their ' || o_orderpriority AS p, o_orderdate::DATE - 3 AS f, o_orderdate::DATE AS l FROM orders WHERE o_orderkey % 10 >= 3), b AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.id, t.id) AS id, CASE WHEN o.id IS NOT NULL THEN o.p ELSE t.p END AS priority, least(o.f, t.f) AS first_seen, greatest(o.l, t.l) AS last_seen FROM o FULL JOIN t ON o.id = t.id WHERE (o.id IS NOT NULL AND t.id IS NOT NULL) OR coalesce(o.id, t.id) NOT IN (SELECT id FROM b)""")
def three_way_all(spark, sf_dir):
    """Two copies that share half their orders and hold every one between them; those a side lacks of the base are deleted."""
    o, k, d = A.table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.to_date("o_orderdate")
    ours = o.filter(k % 10 < 8).select(k.alias("id"), F.col("o_orderpriority").alias("priority"), d.alias("first_seen"), F.date_add(d, 9).alias("last_seen"))
    theirs = o.filter(k % 10 >= 3).select(k.alias("id"), F.concat(F.lit("their "), "o_orderpriority").alias("priority"), F.date_sub(d, 3).alias("first_seen"), d.alias("last_seen"))
    return merge.three_way(ours, theirs, o.filter(k % 2 == 0).select(k.alias("id")), "id", ["priority"], "first_seen", "last_seen")


@query("""SELECT event_id, user_id, event_type FROM events WHERE event_id % 3 <> 0 UNION SELECT event_id, user_id, event_type FROM events WHERE event_id % 2 = 0""")
def log_union_distinct(spark, sf_dir):
    """Two logs as its SQL splits them, which leaves a sixth of the events out; ``log_union_all`` leaves none out."""
    e = A.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return merge.union_logs(e.filter("event_id % 3 <> 0"), e.filter("event_id % 2 = 0"))


@query("""SELECT event_id, user_id, event_type FROM events WHERE event_id % 10 < 8 UNION SELECT event_id, user_id, event_type FROM events WHERE event_id % 10 >= 3""")
def log_union_all(spark, sf_dir):
    """Two logs that share half their events and hold every one between them."""
    e = A.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return merge.union_logs(e.filter("event_id % 10 < 8"), e.filter("event_id % 10 >= 3"))


_ALL = "l_shipdate DESC, (l_returnflag = 'R')::INT DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus"


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ALL}) AS n FROM lineitem) WHERE n = 1""")
def dedupe_copies(spark, sf_dir):
    """One row a key: the latest, then the returned one, then by all other columns."""
    rows = A.table(spark, sf_dir, "lineitem").withColumn("status", F.when(F.col("l_returnflag") == "R", "removed"))
    out = merge.newest_copy(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", "status", ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events), s AS (SELECT user_id, value AS p0, event_type AS s0 FROM e WHERE n = 2), o AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN value END AS price, event_type FROM e WHERE n = 1)
SELECT o.user_id AS internal_id, o.price, o.event_type AS status FROM o LEFT JOIN s USING (user_id) WHERE s.user_id IS NULL OR coalesce(o.price, p0) IS DISTINCT FROM p0 OR o.event_type IS DISTINCT FROM s0""")
def event_emission(spark, sf_dir):
    """Events for the newest sightings against the state before them."""
    from pyspark.sql.window import Window

    e = A.table(spark, sf_dir, "events").withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))))
    state = e.filter("n = 2").select(F.col("user_id").alias("internal_id"), F.col("value").alias("price"), F.col("event_type").alias("status"))
    now = e.filter("n = 1").select(F.col("user_id").alias("internal_id"), F.when(F.col("event_type") != "error", F.col("value")).alias("price"), F.lit(None).cast("long").alias("price_per_m2"), F.col("event_type").alias("status"))
    return merge.emit_events(now, state, F.lit("2000-01-01").cast("timestamp"))[0].select("internal_id", "price", "status")


# Aggregates and quality


@query("""SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.1) AS p10, quantile_cont(l_extendedprice, 0.25) AS p25, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.75) AS p75, quantile_cont(l_extendedprice, 0.9) AS p90 FROM lineitem GROUP BY ALL""")
def quantiles_linear(spark, sf_dir):
    return inventory.quantiles(A.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


@query("""WITH s AS (SELECT l_suppkey, list_sort(list(l_extendedprice)) AS x FROM lineitem GROUP BY l_suppkey) SELECT l_suppkey, x[least(len(x) - 1, floor(len(x) * 0.9::DOUBLE)::BIGINT) + 1] AS p90, x[least(len(x) - 1, floor(len(x) * 0.5::DOUBLE)::BIGINT) + 1] AS upper_median FROM s""")
def percentile_nearest(spark, sf_dir):
    c = F.col("l_extendedprice")
    return A.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(numbers.nearest_rank(c, 0.9).alias("p90"), numbers.nearest_rank(c, 0.5).alias("upper_median"))


@query("""SELECT source, column_name, filled_pct FROM (SELECT source, avg(CASE WHEN trim(text) <> '' THEN 100.0::DOUBLE ELSE 0 END) AS "text", avg(CASE WHEN trim(lang) <> '' THEN 100.0::DOUBLE ELSE 0 END) AS lang, avg(CASE WHEN n_chars IS NOT NULL THEN 100.0::DOUBLE ELSE 0 END) AS n_chars FROM documents GROUP BY source) UNPIVOT (filled_pct FOR column_name IN ("text", lang, n_chars))""")
def fill_rates(spark, sf_dir):
    return quality.fill_rates(A.table(spark, sf_dir, "documents"), ["source"], ["text", "lang", "n_chars"])


@query("""WITH h AS (SELECT 'small' AS rule, p_partkey AS k FROM part WHERE p_size < 3 UNION ALL SELECT 'dear', p_partkey FROM part WHERE p_retailprice > 1900), r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY k) AS n, count(*) OVER (PARTITION BY rule) AS c FROM h) SELECT rule, any_value(c) AS n, string_agg(k::VARCHAR, '|' ORDER BY k) AS examples FROM r WHERE n <= 5 GROUP BY rule""")
def implausible_flags(spark, sf_dir):
    out = quality.flagged(A.table(spark, sf_dir, "part"), "p_partkey", {"small": F.col("p_size") < 3, "dear": F.col("p_retailprice") > 1900})
    return out.select("rule", "n", F.array_join(F.col("examples").cast("array<string>"), "|").alias("examples"))


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def counts_cube(spark, sf_dir):
    return A.table(spark, sf_dir, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT user_id, max(ts)::DATE AS seen, arg_max(event_type, ts) AS status FROM events GROUP BY user_id) SELECT status AS last_type, count(*) AS stale FROM l WHERE seen <= (SELECT max(seen) FROM l) - 1 GROUP BY ALL""")
def stale_groups(spark, sf_dir):
    """Users not seen on the day before the last day, by their last event."""
    rows = events.newest(A.observations(spark, sf_dir), "internal_id", "observed_at", ["status"]).select(F.col("status").alias("last_type"), F.lit("active").alias("status"), "observed_at")
    last = rows.agg(F.max(F.to_date("observed_at"))).first()[0]
    return quality.stale_groups(rows, ["last_type"], "observed_at", F.lit(last), days=1)


@query("""WITH d AS (SELECT event_type AS metric, ts::DATE AS "day", avg(value) AS value FROM events GROUP BY ALL), l AS (SELECT *, max("day") OVER (PARTITION BY metric) AS last FROM d), a AS (SELECT metric, max(value) FILTER ("day" = last) AS value, median(value) FILTER ("day" < last) AS median, count(value) FILTER ("day" < last) AS days FROM l GROUP BY metric) SELECT * FROM a WHERE days >= 3 AND median - value > 1""")
def drop_below_median(spark, sf_dir):
    d = A.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric"), F.to_date("ts").alias("day")).agg(F.avg("value").alias("value"))
    return quality.drops(d, points=1.0)


@query("""WITH d AS (SELECT event_type AS metric, ts::DATE AS "day", count(*)::DOUBLE AS value FROM events GROUP BY ALL), r AS (SELECT *, dense_rank() OVER (ORDER BY "day" DESC) AS n FROM d) SELECT metric, "day", value FROM r WHERE n <= 10""")
def history_retention(spark, sf_dir):
    """The newest ten days of a history whose last day was recorded twice."""
    d = A.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric"), F.to_date("ts").alias("day")).agg(F.count("*").cast("double").alias("value"))
    last = d.agg(F.max("day")).first()[0]
    return quality.recorded(d, d.filter(F.col("day") == F.lit(last)), keep=10)


@query()
def bootstrap_ci(spark, sf_dir):
    """95 % interval of the median price by return flag and status."""
    return inventory.bootstrap_median(A.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


@query("""SELECT 'k' AS path, count(*) AS n FROM events WHERE json_extract(props, '$.k') IS NOT NULL""")
def json_paths(spark, sf_dir):
    return inventory.json_paths(A.table(spark, sf_dir, "events"), "props")


@query("""WITH m AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS was FROM events) SELECT count(*) FILTER (event_type = 'error' AND was <> 'error') AS removals, count(*) FILTER (event_type = 'view' AND was <> 'view') AS returns, 0::BIGINT AS went_missing FROM m WHERE was IS NOT NULL""")
def lifecycle_counts(spark, sf_dir):
    o = A.observations(spark, sf_dir).replace({"error": "removed", "view": "active"}, subset=["status"])
    return inventory.lifecycle(o.withColumn("status", F.col("status")))


@query("""WITH d AS (SELECT ts::DATE AS "day", count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (ORDER BY "day" DESC) AS k FROM d) SELECT median(n)::DOUBLE AS per_day, median(n)::DOUBLE * 1095 AS projected FROM r WHERE k BETWEEN 2 AND 8""")
def growth_projection(spark, sf_dir):
    return inventory.growth(A.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n")))


# Scalars


@query("""SELECT event_id, ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Prague')::DATE AS "day" FROM events""")
def prague_day(spark, sf_dir):
    return A.table(spark, sf_dir, "events").select("event_id", times.local_day(F.col("ts").cast("timestamp")).alias("day"))


@query("""SELECT o_orderkey, isoyear(d) || '-W' || lpad(week(d)::VARCHAR, 2, '0') AS week, d - isodow(d)::INT AS closed FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def iso_week(spark, sf_dir):
    d = F.to_date("o_orderdate")
    return A.table(spark, sf_dir, "orders").select("o_orderkey", times.week_label(d).alias("week"), times.closed_week_end(d).alias("closed"))


@query("""SELECT doc_id, sha1(trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))) AS words FROM documents""")
def fold_text(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", F.sha1(text.fold(F.col("text"))).alias("words"))


@query("""WITH f AS (SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(trim(regexp_replace(split_part(text, ',', 1), '[0-9/]+\\s*$', '')))), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS k FROM documents) SELECT doc_id, CASE WHEN k <> '' AND NOT regexp_full_match(k, 'praha( \\d+)?') THEN k END AS street FROM f""")
def street_keys(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", text.street_key(F.col("text")).alias("street"))


@query("""SELECT doc_id, sha1(nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '')) AS clean FROM documents""")
def clean_text(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", F.sha1(text.clean_text(F.col("text"))).alias("clean"))


@query("""SELECT p_partkey, TRY_CAST(regexp_replace(replace(p_size || ',5 m2 of ' || p_brand, ',', '.'), '[^0-9.-]', '', 'g') AS DOUBLE) AS number FROM part""")
def safe_float(spark, sf_dir):
    return A.table(spark, sf_dir, "part").select("p_partkey", numbers.safe_float(F.concat(F.col("p_size").cast("string"), F.lit(",5 m2 of "), "p_brand")).alias("number"))


@query("""SELECT page_id, regexp_extract(url, '/(\\d+)(?:-[^/]*)?/?(?:[?#].*)?$', 1) AS id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages""")
def url_and_markup(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", payload.url_parts(F.col("url"))["id"].alias("id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))


def _shape_sql() -> str:
    name, a, b, c, d, half = geo.BELT
    scale = geo.EARTH_M * 0.017453292519943295
    cos_a = f"cos(radians(({a}::DOUBLE + {c}::DOUBLE) / 2))"
    x, y = f"((lon - {b}) * ({scale!r}::DOUBLE * {cos_a}))", f"((lat - {a}) * {scale!r}::DOUBLE)"
    bx, by = f"(({d}::DOUBLE - {b}) * ({scale!r}::DOUBLE * {cos_a}))", f"(({c}::DOUBLE - {a}) * {scale!r}::DOUBLE)"
    t = f"greatest(0.0, least(1.0, ({x} * {bx} + {y} * {by}) / ({bx} * {bx} + {by} * {by})))"
    tests = [f"WHEN sqrt(pow({x} - {t} * {bx}, 2) + pow({y} - {t} * {by}, 2)) <= {half * 1000} THEN '{name}'"]
    tests += [f"WHEN {A.haversine_sql('p', n)} <= {r * 1000} THEN '{label}'".replace(f"{n}.lat", f"{la}::DOUBLE").replace(f"{n}.lon", f"{lo}::DOUBLE") for k, (label, la, lo, r) in enumerate(geo.CIRCLES) for n in [f"q{k}"]]
    return "CASE " + " ".join(tests) + " END"


@query(f"""{cte("cust")} SELECT id, {_shape_sql().replace("p.lat", "lat").replace("p.lon", "lon")} AS shape, lat BETWEEN 49.9 AND 50.2 AND lon BETWEEN 14.15 AND 14.75 AS in_box FROM cust""")
def geo_shapes(spark, sf_dir):
    return A.points(spark, sf_dir, "customer").select("id", geo.shape_of(F.col("lat"), F.col("lon")).alias("shape"), geo.in_box(F.col("lat"), F.col("lon")).alias("in_box"))


@query("""SELECT o_orderkey, sha1('orders:' || o_orderkey)[1:16] AS internal_id, 'clu_' || sha1(o_custkey || ',' || o_orderkey)[1:10] AS cluster_id FROM orders""")
def surrogate_keys(spark, sf_dir):
    pair = F.array(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    return A.table(spark, sf_dir, "orders").select("o_orderkey", numbers.internal_id(F.lit("orders"), F.col("o_orderkey").cast("string")).alias("internal_id"), numbers.cluster_id(pair).alias("cluster_id"))


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0 AND o_totalprice <= 400000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def topk_positive(spark, sf_dir):
    return views.top_positive(A.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 5, 400000)


@query("""WITH e AS (SELECT event_id, ts, ts + INTERVAL 1 HOUR * (event_id % 50) AS e FROM events), d AS (SELECT event_id, ts, e, unnest(generate_series(ts::DATE, e::DATE, INTERVAL 1 DAY)) AS "day" FROM e)
SELECT event_id, sum(CASE WHEN isodow("day") = 7 THEN greatest(0, least(floor(epoch(e)), epoch("day") + 21600) - greatest(floor(epoch(ts)), epoch("day") + 3600)) ELSE 0 END) / 3600.0 AS hours FROM d GROUP BY event_id""")
def reserved_hours(spark, sf_dir):
    """Hours of an interval on Sundays between one and six."""
    start = F.col("ts").cast("timestamp")
    end = start + F.make_interval(hours=(F.col("event_id") % 50).cast("int"))
    return A.table(spark, sf_dir, "events").select("event_id", times.overlap_hours(start, end, 1.0, 6.0, (6,)).alias("hours"))


@query("""WITH g AS (SELECT *, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events) SELECT user_id, count(*) FILTER (gap IS NULL OR gap > 432000) AS sessions, max(gap) AS longest FROM g GROUP BY user_id""")
def sessions_of_gaps(spark, sf_dir):
    """Sessions of a user, split by five days of silence, and the longest gap in seconds."""
    from pyspark.sql.window import Window

    e = A.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = (micros - F.lag(micros).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))) / 1e6
    return e.withColumn("gap", gap).groupBy("user_id").agg(F.count_if(F.col("gap").isNull() | (F.col("gap") > 432000)).alias("sessions"), F.max("gap").alias("longest"))


@query("""SELECT doc_id FROM documents WHERE contains(trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), 'erung')""")
def street_search(spark, sf_dir):
    """Accent-blind search in texts."""
    return A.table(spark, sf_dir, "documents").filter(text.contains_folded(F.col("text"), "Érung")).select("doc_id")

