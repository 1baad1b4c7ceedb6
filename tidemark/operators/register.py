"""Adverts against the register of address points: house numbers, districts, parsed addresses, borrowed coordinates.

Listings have the columns of ``schemas.LISTINGS``, points those of ``schemas.REGISTER``. A listing is matched where
``match_distance_m`` is stated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.address import parse
from tidemark.functions.geo import GRID_DEG, cell, cells_around
from tidemark.functions.text import blank_to_null, fold, street_key, strip_accents
from tidemark.operators.match import staged
from tidemark.operators.nearest import CROWD_FACTOR, MAX_M, crowds

# Where a district or a coordinate was taken from.
FROM_PORTAL, FROM_REGISTER, FROM_STREET, FROM_DONOR = "portal", "ruian", "ulice", "sreality"
CITY = "Praha"
#: What a match states, and its types.
MATCH = {"house_number": "string", "orientation_number": "string", "number_kind": "string", "postcode": "string", "match_distance_m": "double", "match_candidates": "int"}


def row_street(street: Column, address: Column) -> Column:
    """Folded street of a row: the parsed column, else the street that the raw address names; a bare borough is none."""
    return street_key(F.coalesce(blank_to_null(street), parse(address)["street"]))


def located(address: Column) -> Column:
    """``parse`` with ``district_origin``: the portal's, where it names a district."""
    p = parse(address)
    return F.struct(p["street"].alias("street"), p["district"].alias("district"), p["municipality"].alias("municipality"), F.when(p["district"] != "", FROM_PORTAL).otherwise("").alias("district_origin"))


def orientation(number: Column, letter: Column) -> Column:
    """``3`` or ``3a``; null without a number."""
    return F.concat(blank_to_null(number), F.coalesce(F.trim(letter), F.lit("")))


def blank_match() -> dict[str, Column]:
    """The columns of a match, empty."""
    return {c: F.lit(None).cast(t) for c, t in MATCH.items()}


def _street(c: Column) -> Column:
    return F.nullif(fold(c, "letters"), F.lit(""))


def matched(rows: DataFrame, points: DataFrame, max_m: float = MAX_M) -> DataFrame:
    """Rows (``street``, ``lat``, ``lon`` all stated) with ``match``: the nearest point of their street within ``max_m``, or null.

    The struct holds the columns of ``MATCH`` and ``point``, the register's row. ``match_candidates`` counts the distinct
    house numbers within twice the distance found, at least five metres. Equal distances go to the smaller point id.

    Spots are met by ``nearest.crowds`` in cells as wide as the farthest crowd can reach: each spot of rows once, with the
    spots of points round it; the rows then take what was found where they stand.
    """
    return _matched(rows.withColumn("__street", _street(F.col("street"))), points, max_m).select(*rows.columns, "match")


def _matched(keyed: DataFrame, points: DataFrame, max_m: float) -> DataFrame:
    """``matched`` for rows with ``__street``. A match is put together where a spot is, not for each of its rows."""
    size = GRID_DEG * max(1.0, CROWD_FACTOR * max_m / 250.0)
    stated = points.filter("lat IS NOT NULL AND lon IS NOT NULL").withColumn("__street", _street(F.col("street"))).filter("__street IS NOT NULL")
    x, y = cell(F.col("lat"), F.col("lon"), size)
    number = F.coalesce("house_number", F.lit(""))
    found = crowds(keyed.filter("__street IS NOT NULL"), stated, "__street", number, F.struct(x.alias("x"), y.alias("y")), cells_around(F.col("lat"), F.col("lon"), size), max_m)
    top = F.col("__top")["point"]
    match = F.struct(
        top["house_number"].alias("house_number"), orientation(top["orientation_number"], top["orientation_letter"]).alias("orientation_number"), top["number_kind"].alias("number_kind"), top["postcode"].alias("postcode"),
        F.round("__top.metres", 1).alias("match_distance_m"), F.col("__crowd").alias("match_candidates"), F.struct(*[top[c].alias(c) for c in points.columns]).alias("point"),
    )
    spot = ["__street", "lat", "lon"]
    return keyed.join(found.select(*spot, match.alias("match")), spot, "left").select(*keyed.columns, "match")


def _can_match() -> Column:
    return F.col("lat").isNotNull() & F.col("lon").isNotNull() & blank_to_null(F.col("street")).isNotNull()


def fill_house_numbers(listings: DataFrame, points: DataFrame, max_m: float = MAX_M) -> DataFrame:
    """Listings that are not matched yet, but can be, matched; all others stay as they are."""
    wanted = F.col("match_distance_m").isNull() & _can_match()
    found = matched(listings.filter(wanted), points, max_m)
    filled = found.select(*[F.when(F.col("match").isNotNull(), F.col(f"match.{c}").cast(MATCH[c])).otherwise(F.col(c)).alias(c) if c in MATCH else F.col(c) for c in listings.columns])
    return listings.filter(~wanted).unionByName(filled)


def register_backfill(listings: DataFrame, points: DataFrame, max_m: float = MAX_M) -> DataFrame:
    """Every listing matched anew, and districts filled where the portal names none.

    A row that doesn't match any more loses the number it had. A blank district is taken from the matched point, else, in
    the register's own city, from the street, if all of it lies in one district. Added columns: ``reason``;
    ``district_reason`` (null if nothing was tried); ``district_check``, whether the register agrees with a district that
    the portal named; ``changed``.
    """
    district, spelled = blank_to_null(F.col("district")), F.array(*[fold(F.col(c), "letters") for c in ("district", "borough", "quarter")])
    keyed, named_points = listings.withColumn("__street", _street(F.col("street"))), points.withColumns({"__plain": blank_to_null(strip_accents(F.col("district"))), "__spelled": spelled})
    # Without a street a row has no key to join by; parted before the search, so that rows are searched for once.
    key = F.col("__street")
    can = _can_match() & key.isNotNull()
    hits = _matched(keyed.filter(can), named_points, max_m)
    rest = keyed.filter(~can).withColumn("match", F.lit(None).cast(hits.schema["match"].dataType))
    streets = points.select(_street(F.col("street")).alias("__street"), district.alias("d")).filter("__street IS NOT NULL").groupBy("__street").agg(F.min("d").alias("__low"), F.max("d").alias("__high"))
    named = hits.unionByName(rest.filter(key.isNotNull())).join(streets.withColumn("__known", F.lit(True)), "__street", "left")
    unnamed = rest.filter(key.isNull()).withColumns({"__low": F.lit(None).cast("string"), "__high": F.lit(None).cast("string"), "__known": F.lit(None).cast("boolean")})
    all_rows = named.unionByName(unnamed)

    hit, stated = F.col("match").isNotNull(), blank_to_null(F.col("district"))
    by_point = F.when(hit, F.col("match.point.__plain"))
    in_city = F.coalesce(F.trim("municipality") == CITY, F.lit(False))
    by_street = F.when(~hit & in_city & (F.col("__low") == F.col("__high")), strip_accents(F.col("__low")))
    filled = stated.isNull() & F.coalesce(by_point, by_street).isNotNull()
    reason = F.when(hit, "matched").when(F.col("lat").isNull() | F.col("lon").isNull(), "no coordinates").when(blank_to_null(F.col("street")).isNull(), "no street").when(F.col("__known"), "nearest point too far").otherwise("street not in the register")
    why = F.when(stated.isNotNull(), F.lit(None).cast("string")).when(by_point.isNotNull(), "from the register").when(hit, F.lit(None).cast("string")).when(~in_city, "outside the register's city").when(by_street.isNotNull(), "from the street")
    same = fold(stated, "letters")
    agrees = F.coalesce(F.array_contains("match.point.__spelled", same), F.lit(False))
    check = F.when(hit, F.when(~F.coalesce(F.col("district_origin"), F.lit("")).isin("", FROM_PORTAL), "not the portal's district").when(stated.isNull(), "portal named no district").when(agrees, "agrees").otherwise("disagrees"))
    differs = F.lit(False)
    for c, t in MATCH.items():
        old = blank_to_null(F.col(c)) if t == "string" else F.col(c)
        new = F.col(f"match.{c}").cast(t)
        differs = differs | ~old.eqNullSafe(blank_to_null(new) if t == "string" else new)
    values = {c: F.col(f"match.{c}").cast(t) for c, t in MATCH.items()}
    values["district"] = F.when(filled, F.coalesce(by_point, by_street)).otherwise(F.col("district"))
    values["district_origin"] = F.when(filled, F.when(by_point.isNotNull(), FROM_REGISTER).otherwise(FROM_STREET)).otherwise(F.col("district_origin"))
    return all_rows.select(*[values.get(c, F.col(c)).alias(c) for c in listings.columns], reason.alias("reason"), why.alias("district_reason"), check.alias("district_check"), (differs | filled).alias("changed"))


def backfill_counts(rows: DataFrame) -> DataFrame:
    """``what``, ``value`` and ``n`` of a backfill's added columns."""
    each = F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("string").alias("value")) for c in ("reason", "district_reason", "district_check", "changed")])
    return rows.select(F.explode(each).alias("x")).filter("x.value IS NOT NULL").groupBy("x.what", "x.value").agg(F.count("*").alias("n"))


def address_backfill(listings: DataFrame) -> DataFrame:
    """Listings with raw ``address`` parsed anew into ``street``, ``district`` and ``municipality``, and ``changed``."""
    p = parse(F.col("address"))
    fields = ("street", "district", "municipality")
    differs = F.lit(False)
    for c in fields:
        differs = differs | (F.coalesce(F.col(c), F.lit("")) != p[c])
    return listings.select(*[p[c].alias(c) if c in fields else F.col(c) for c in listings.columns], differs.alias("changed"))


def donors_from(walk: DataFrame, today: Column) -> DataFrame:
    """Rows of a walk that can lend a coordinate, in the shape of listings; an advert that is up was seen today."""
    given = {"internal_id": F.concat(F.lit(f"{FROM_DONOR}-donor-"), F.col("source_id")), "source": F.lit(FROM_DONOR), "first_seen_at": today, "last_seen_at": today, "status": F.lit("active")}
    kept = [c for c in ("source_id", "property_type", "transaction_type", "disposition", "area_m2", "price", "lat", "lon", "address")]
    return walk.filter("lat IS NOT NULL AND lon IS NOT NULL").select(*[v.alias(k) for k, v in given.items()], *kept)


def reverified(borrowed: DataFrame, donors: DataFrame, stages: list[float | None], area_abs_m: float = 1.0) -> DataFrame:
    """``internal_id``, ``lat``, ``lon`` and ``verdict`` of borrowed coordinates matched anew, without those they have.

    Both sides have the columns of ``match``. ``kept`` where no donor matches now, or donors disagree on the place: that
    an advert is gone says nothing against what it lent.
    """
    probes = borrowed.withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    found = staged(probes, donors, stages, area_abs_m).select(F.col("id").alias("internal_id"), F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    same = F.col("lat").eqNullSafe(F.col("__lat")) & F.col("lon").eqNullSafe(F.col("__lon"))
    verdict = F.when(F.col("__lat").isNull(), "kept").when(same, "confirmed").otherwise("changed")
    out = borrowed.select("internal_id", "lat", "lon").join(found, "internal_id", "left").withColumn("verdict", verdict)
    return out.select("internal_id", F.coalesce("__lat", "lat").alias("lat"), F.coalesce("__lon", "lon").alias("lon"), "verdict")


def apply_reverified(listings: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Listings with changed coordinates; a number that was found by the old ones goes."""
    new = verdicts.filter("verdict = 'changed'").select("internal_id", F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), F.lit(True).alias("__moved"))
    moved = F.coalesce(F.col("__moved"), F.lit(False))
    values = {"lat": F.when(moved, F.col("__lat")).otherwise(F.col("lat")), "lon": F.when(moved, F.col("__lon")).otherwise(F.col("lon"))}
    values |= {c: F.when(~moved, F.col(c)) for c in MATCH}
    return listings.join(new, "internal_id", "left").select(*[values.get(c, F.col(c)).alias(c) for c in listings.columns])
