"""Numbers, keys and value comparison as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Below this a price is a placeholder.
LEAST_PRICE = 1000
MIN_SAMPLE = 5


def safe_float(c: Column) -> Column:
    """Decimal commas read as points, other signs dropped; null where no number is left."""
    return F.regexp_replace(F.translate(c.cast("string"), ",", "."), r"[^0-9.\-]", "").try_cast("double")


def safe_int(c: Column) -> Column:
    """Nearest whole number, halves to even."""
    return F.rint(safe_float(c)).cast("bigint")


def as_number(c: Column) -> Column:
    """Lenient number without infinities and NaN."""
    x = c.cast("string").try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def as_int(c: Column) -> Column:
    return as_number(c).cast("bigint")


def as_bool(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def real_price(c: Column, least: float = LEAST_PRICE) -> Column:
    return F.when(c >= least, c)


def price_per_m2(price: Column, area: Column) -> Column:
    return F.when(area > 0, F.rint(price / area).cast("bigint"))


def asking_price(last: Column, first: Column) -> Column:
    """What an episode asks now: its last price, else its first; zero is unknown."""
    return F.coalesce(F.nullif(as_number(last), F.lit(0.0)), as_number(first))


def share(part: Column, whole: Column, least: int = MIN_SAMPLE) -> Column:
    """Percentage, null below the least denominator."""
    return F.when(whole >= least, 100.0 * part / whole)


def median(c: Column, least: int = MIN_SAMPLE) -> Column:
    return F.when(F.count(c) >= least, F.median(c))


def mean(c: Column, least: int = MIN_SAMPLE) -> Column:
    return F.when(F.count(c) >= least, F.avg(c))


def nearest_rank(c: Column, q: float) -> Column:
    """The element at ``floor(q n)`` of the sorted values, the last one at most."""
    ordered = F.sort_array(F.collect_list(c))
    return F.when(F.count(c) > 0, F.element_at(ordered, F.least(F.count(c) - 1, F.floor(F.count(c) * q)).cast("int") + 1))


def same_value(a: Column, b: Column) -> Column:
    """Equality across typings: numbers within 1e-9, else trimmed text without case."""
    x, y = as_number(a), as_number(b)
    text = lambda c: F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    return F.when(x.isNotNull() & y.isNotNull(), F.abs(x - y) < 1e-9).otherwise(text(a) == text(b))


def internal_id(source: Column, source_id: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", source, source_id)), 1, 16)


def cluster_id(sorted_ids: Column, salt: str = "") -> Column:
    joined = F.array_join(sorted_ids, ",")
    return F.concat(F.lit("clu_"), F.substring(F.sha1(F.concat(joined, F.lit(salt))), 1, 10))
