"""Registered queries of row-wise functions and of the register, beside those of ``catalogue``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import attributes, geo, numbers, payload, text, times
from tidemark.operators import health, ingest, market, register, views
from tidemark.plans import adapters as A
from tidemark.plans.catalogue import cte, query


def _pick(key, words: list[str]):
    """One of the words by a number."""
    return F.element_at(F.array(*map(F.lit, words)), (key % len(words)).cast("int") + 1)


def _picked(key: str, words: list[str]) -> str:
    return f"list_extract({words!r}, ({key} % {len(words)})::INT + 1)"


@query("""SELECT p_partkey, round_even(p_size + 0.5::DOUBLE, 0)::BIGINT AS number FROM part""")
def safe_int(spark, sf_dir):
    """Sizes and a half, as texts with a decimal comma."""
    return A.table(spark, sf_dir, "part").select("p_partkey", numbers.safe_int(F.concat(F.col("p_size").cast("string"), F.lit(",5 Kč"))).alias("number"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 50 > 0 THEN round_even(o_totalprice / (o_custkey % 50), 0)::BIGINT END AS per_m2, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE o_totalprice / 2 END AS asking FROM orders""")
def unit_prices(spark, sf_dir):
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    return A.table(spark, sf_dir, "orders").select("o_orderkey", numbers.price_per_m2(p, F.col("o_custkey") % 50).alias("per_m2"), numbers.asking_price(F.when(k % 3 == 1, 0.0).when(k % 3 == 2, p / 2), F.when(k % 3 == 1, p / 2).otherwise(p)).alias("asking"))


@query("""SELECT doc_id, sha1(regexp_replace(regexp_replace(trim(strip_accents(lower(text))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM documents""")
def slugs(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", F.sha1(text.slug(F.col("text"))).alias("slug"))


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(p_name, ' '), lambda w: length(w) > 2))), '|') AS words FROM part""")
def locality_words(spark, sf_dir):
    """Telling words of part names, with words put beside them that tell nothing."""
    words = text.locality_tokens(F.concat(F.lit("Praha, "), F.upper("p_name"), F.lit(" (Česká republika, cz)")))
    return A.table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_sort(words), "|").alias("words"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN (p_size % 7) || '+kk' WHEN 1 THEN (p_size % 7) || '+1' WHEN 2 THEN '1+kk' END AS layout FROM part""")
def layouts(spark, sf_dir):
    n, k = (F.col("p_size") % 7).cast("string"), F.col("p_partkey")
    stated = F.when(k % 4 == 0, F.concat(F.lit("byt "), n, F.lit(" + KK"))).when(k % 4 == 1, F.concat(n, F.lit("_1"))).when(k % 4 == 2, "Garsoniéra").otherwise("Ostatní")
    return A.table(spark, sf_dir, "part").select("p_partkey", text.layout(stated).alias("layout"))


_BUILT = ["BRICK", " panel ", "WOOD", "straw"]
_KINDS = ["", "STALY_NAJEM", "MANUAL_BZR_RK_PRODEJ", "Firma_X"]


@query(f"""SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 END, 0), nullif(o_custkey % 4 + o_orderkey % 5, 0)) AS charges,
CASE WHEN o_orderkey % 2 = 0 AND o_custkey * 100 > round_even(o_totalprice, 0) THEN o_custkey * 100 END AS was, {_picked("o_custkey", ["cihla", "panel", "drevostavba", ""])} AS built, {_picked("o_custkey", ["soukromy", "soukromy", "rk", "firma"])} AS seller, CASE WHEN o_custkey % 4 = 3 THEN 'firma_x' ELSE '' END AS agency, CASE o_custkey % 3 WHEN 0 THEN 'B' WHEN 1 THEN '' ELSE 'G' END AS energy FROM orders""")
def advert_facts(spark, sf_dir):
    """Charges, original price, construction, seller and energy class, from orders' keys."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    who = attributes.seller(_pick(c, _KINDS))
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey", attributes.charges(F.when(k % 3 == 0, k % 7), c % 4, k % 5).alias("charges"), attributes.original_price(k % 2 == 0, c * 100, F.col("o_totalprice")).alias("was"),
        attributes.by_code("construction", _pick(c, _BUILT)).alias("built"), who["seller"].alias("seller"), who["agency_id"].alias("agency"), attributes.energy_class(_pick(c, ["b - good", "x", "G"])).alias("energy"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN (o_custkey % 90 + 10)::DOUBLE WHEN o_orderkey % 4 = 1 THEN o_custkey % 90 + 0.5::DOUBLE WHEN o_orderkey % 4 = 2 AND round_even(o_totalprice / 1000.0, 6) BETWEEN 5 AND 2000 THEN round_even(o_totalprice / 1000.0, 0) END AS area FROM orders""")
def area_fallback(spark, sf_dir):
    """As stated, else in the title, else from prices."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    title = F.when(k % 4 == 1, F.concat(F.lit("Byt 2+kk "), (c % 90).cast("string"), F.lit(",5 m²"))).otherwise("Byt")
    return A.table(spark, sf_dir, "orders").select("o_orderkey", payload.area_m2(F.when(k % 4 == 0, (c % 90 + 10).cast("double")).otherwise(0.0), title, F.col("o_totalprice"), F.when(k % 4 == 2, 1000.0).otherwise(0.0)).alias("area"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Dlouha' WHEN 1 THEN 'Kratka' WHEN 2 THEN 'Rovna' ELSE '' END AS street, CASE c_custkey % 4 WHEN 0 THEN 'Praha ' || c_nationkey WHEN 2 THEN 'Krc' WHEN 3 THEN 'Vinohrady' ELSE '' END AS district,
CASE c_custkey % 4 WHEN 1 THEN 'Brno' ELSE 'Praha' END AS municipality, CASE c_custkey % 4 WHEN 1 THEN '' ELSE 'portal' END AS district_origin, CASE c_custkey % 4 WHEN 0 THEN 'dlouha' WHEN 1 THEN 'kratka' WHEN 2 THEN 'rovna' END AS key FROM customer""")
def addresses(spark, sf_dir):
    """Address lines in the forms that portals use, parsed."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    line = F.when(k % 4 == 0, F.concat(F.lit("Dlouhá "), k.cast("string"), F.lit(", Praha "), n)).when(k % 4 == 1, F.concat(F.lit("Krátká "), n, F.lit("/3a, okres Brno-město, Brno")))
    line = line.when(k % 4 == 2, F.concat(F.lit("Rovná, Praha "), n, F.lit(" - Krč"))).otherwise(F.concat(F.lit("Vinohrady, Praha"), F.when(k % 8 == 3, " 2 - Vinohrady").otherwise(" 1 - Vinohrady")))
    p = register.located(line)
    return A.table(spark, sf_dir, "customer").select("c_custkey", *[p[c].alias(c) for c in ("street", "district", "municipality", "district_origin")], register.row_street(F.lit(" "), line).alias("key"))


def _numbered(spark, sf_dir):
    """Customers as listings and suppliers as register, a nation as a street."""
    c = A.points(spark, sf_dir, "customer")
    none = register.blank_match()
    name = F.concat(F.lit("Street "), F.col("nation").cast("string"))
    rows = c.select("id", F.when(F.col("id") % 11 > 0, name).alias("street"), F.when(F.col("id") % 13 > 0, F.col("lat")).alias("lat"), "lon", F.when(F.col("id") % 2 == 0, F.concat(F.lit("D"), (F.col("id") % 5).cast("string"))).alias("district"), F.lit("portal").alias("district_origin"), F.lit("Praha").alias("municipality"), *[v.alias(k) for k, v in none.items()])
    s = A.points(spark, sf_dir, "supplier")
    points = s.select(F.col("id").cast("string").alias("point_id"), F.upper(name).alias("street"), (F.col("id") % 7).cast("string").alias("house_number"), F.lit("c.p.").alias("number_kind"), F.col("id").cast("string").alias("orientation_number"), F.lit("a").alias("orientation_letter"), F.concat(F.lit("D"), (F.col("id") % 5).cast("string")).alias("district"), F.lit("").alias("borough"), F.lit(None).cast("string").alias("quarter"), F.lit("10000").alias("postcode"), "lat", "lon")
    return rows, points


_AWAY = f"""{cte("cust", "supp")}, l AS (SELECT *, id % 11 > 0 AS named, id % 13 > 0 AS placed FROM cust), away AS (SELECT a.id, b.id AS point_id, (b.id % 7)::VARCHAR AS number, 'D' || (b.id % 5) AS d, {A.haversine_sql("a", "b")} AS metres FROM l a JOIN supp b USING (nation) WHERE named AND placed),
low AS (SELECT *, min(metres) OVER (PARTITION BY id) AS least FROM away), m AS (SELECT id, arg_min(number, (metres, point_id::VARCHAR)) AS number, arg_min(point_id, (metres, point_id::VARCHAR)) AS point, arg_min(d, (metres, point_id::VARCHAR)) AS d, count(DISTINCT number) FILTER (metres <= greatest(5.0, 2 * least))::INT AS crowd FROM low WHERE least <= 2000 GROUP BY id),
st AS (SELECT nation, min('D' || (id % 5)) AS lo, max('D' || (id % 5)) AS hi FROM supp GROUP BY nation)"""


@query(f"""{_AWAY} SELECT l.id, m.number AS house_number, m.point || 'a' AS orientation_number, m.crowd AS match_candidates FROM l LEFT JOIN m USING (id)""")
def house_numbers(spark, sf_dir):
    """The nearest point of the own street within two kilometres, and how many numbers it competes with."""
    rows, points = _numbered(spark, sf_dir)
    return register.fill_house_numbers(rows, points, 2000.0).select("id", "house_number", "orientation_number", "match_candidates")


@query(f"""{_AWAY} SELECT l.id, CASE WHEN m.id IS NOT NULL THEN 'matched' WHEN NOT placed THEN 'no coordinates' WHEN NOT named THEN 'no street' WHEN lo IS NOT NULL THEN 'nearest point too far' ELSE 'street not in the register' END AS reason, CASE WHEN l.id % 2 = 0 THEN 'D' || (l.id % 5) WHEN m.id IS NOT NULL THEN m.d WHEN named AND lo = hi THEN lo END AS district,
CASE WHEN l.id % 2 = 0 THEN 'portal' WHEN m.id IS NOT NULL THEN 'ruian' WHEN named AND lo = hi THEN 'ulice' ELSE 'portal' END AS district_origin, CASE WHEN m.id IS NULL THEN NULL WHEN l.id % 2 = 1 THEN 'portal named no district' WHEN m.d = 'D' || (l.id % 5) THEN 'agrees' ELSE 'disagrees' END AS district_check, m.id IS NOT NULL OR (l.id % 2 = 1 AND named AND coalesce(lo = hi, false)) AS changed
FROM l LEFT JOIN m USING (id) LEFT JOIN st USING (nation)""")
def register_reasons(spark, sf_dir):
    rows, points = _numbered(spark, sf_dir)
    return register.register_backfill(rows, points, 2000.0).select("id", "reason", "district", "district_origin", "district_check", "changed")


@query("""SELECT n_name AS source, CASE WHEN s > 0 THEN (n_nationkey + c) % s ELSE n_nationkey + c END::BIGINT AS cursor, CASE WHEN s > 0 THEN (n_nationkey + c) // s ELSE 0 END::BIGINT AS cycle FROM (SELECT n_name, n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS c, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS s FROM nation)""")
def cursors(spark, sf_dir):
    """Nations' queues of suppliers, moved on by their customers."""
    n = A.table(spark, sf_dir, "nation").select(F.col("n_name").alias("source"), "n_nationkey")
    count = lambda t, k, a: A.table(spark, sf_dir, t).groupBy(F.col(k).alias("n_nationkey")).agg(F.count("*").alias(a))
    used = n.join(count("customer", "c_nationkey", "consumed"), "n_nationkey", "left").join(count("supplier", "s_nationkey", "queue_length"), "n_nationkey", "left")
    return ingest.advanced(n.select("source", F.col("n_nationkey").alias("cursor"), F.lit(0).alias("cycle")), used.select("source", "consumed", "queue_length"))


@query("""SELECT p_brand AS property_type, p_type AS disposition, count(*) AS n, min(p_retailprice) AS low, list_sort(list(p_retailprice))[(count(*) // 2 + 1)::INT] AS middle, max(p_retailprice) AS high FROM part GROUP BY ALL""")
def price_summary(spark, sf_dir):
    return views.street_summary(A.entities(spark, sf_dir)).drop("transaction_type")


@query("""WITH d AS (SELECT event_type AS segment, ts::DATE AS "day", count(*) AS n FROM events GROUP BY ALL), m AS (SELECT max("day") AS last FROM d) SELECT segment, "day", n FROM d, m WHERE "day" <= last - isodow(last)::INT""")
def closed_weeks(spark, sf_dir):
    """Daily counts up to the last closed week, as seen on the last day."""
    d = A.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("segment"), F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    last = d.agg(F.max("day")).first()[0]
    return market.until_closed_week(d, F.lit(last))


@query(f"""{cte("cust")} SELECT id, least({A.haversine_sql("a", "b").replace("b.lat", "50.0444::DOUBLE").replace("b.lon", "14.4789::DOUBLE").replace("a.", "")}, {A.haversine_sql("a", "b").replace("b.lat", "50.0489::DOUBLE").replace("b.lon", "14.5244::DOUBLE").replace("a.", "")}) <= 1600 AS watched FROM cust""")
def priority_zones(spark, sf_dir):
    return A.points(spark, sf_dir, "customer").select("id", geo.in_priority_zone(F.col("lat"), F.col("lon")).alias("watched"))


@query("""SELECT o_orderkey, (last_day(o_orderdate::DATE - INTERVAL 1 MONTH))::DATE AS newest_export, (last_day(o_orderdate::DATE - INTERVAL 13 MONTH))::DATE AS oldest_export, o_orderkey % 7 = 0 OR o_orderkey % 50 >= 24 AS due FROM orders""")
def schedules(spark, sf_dir):
    """Month-end exports to look for, and jobs that are due after a day."""
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    now = F.col("o_orderdate").cast("timestamp")
    ends = times.month_ends(d)
    last = F.when(k % 7 > 0, now - F.make_interval(hours=(k % 50).cast("int")))
    return A.table(spark, sf_dir, "orders").select("o_orderkey", F.element_at(ends, 1).alias("newest_export"), F.element_at(ends, -1).alias("oldest_export"), health.due(last, now, 24.0).alias("due"))


@query("""SELECT event_id, TRY_CAST(props->>'$.k' AS DOUBLE) AS number, event_id % 3 < 2 AS flag, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment FROM events""")
def lenient_values(spark, sf_dir):
    """Numbers, flags and moments out of texts."""
    k = F.col("event_id")
    moment = times.parse_moment(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"))
    return A.table(spark, sf_dir, "events").select("event_id", numbers.as_number(payload.enum_value(F.get_json_object("props", "$.k"))).alias("number"), numbers.as_bool(_pick(k, [" True", "1", "no"])).alias("flag"), F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("""SELECT page_id, contains(url, 'praha') OR page_id % 3 <> 2 AS local FROM pages""")
def local_slugs(spark, sf_dir):
    """Addresses of pages, two in three with a place of the area put behind."""
    return A.table(spark, sf_dir, "pages").select("page_id", payload.may_be_local(F.concat("url", _pick(F.col("page_id"), ["-dolni-brezany", "-praha-4", "-ostrava"]))).alias("local"))
