"""Calendar days, weeks and intervals as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/Prague"


def parse_moment(c: Column) -> Column:
    """Timestamp of an ISO moment or bare date (UTC where no zone is named), null on failure."""
    return F.try_to_timestamp(c)


def local_day(moment: Column, zone: str = ZONE) -> Column:
    """Calendar day of a UTC timestamp in the zone."""
    return F.to_date(F.from_utc_timestamp(moment, zone))


def day_text(c: Column, zone: str = ZONE) -> Column:
    """Day of an ISO moment as text: a bare date stands, an unreadable one keeps its first ten characters."""
    day = F.date_format(F.from_utc_timestamp(parse_moment(c), zone), "yyyy-MM-dd")
    return F.coalesce(F.when(F.length(c) == 10, c), day, F.substring(c, 1, 10), F.lit(""))


def closed_week_end(day: Column) -> Column:
    """The Sunday strictly before."""
    return F.date_sub(day, F.weekday(day) + 1)


def week_label(day: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def month_ends(as_of: Column, back: int = 13) -> Column:
    """The last ``back`` month ends before ``as_of``, newest first."""
    return F.array(*[F.last_day(F.add_months(as_of, -k)) for k in range(1, back + 1)])


def overlap_hours(start: Column, end: Column, from_hour: float, to_hour: float, weekdays: tuple[int, ...]) -> Column:
    """Hours of an interval inside a weekly window (weekday 0 is Monday)."""
    days = F.filter(F.sequence(F.to_date(start), F.to_date(end)), lambda d: F.weekday(d).isin(*weekdays))

    def part(d: Column) -> Column:
        midnight = F.unix_timestamp(d.cast("timestamp"))
        low = F.greatest(F.unix_timestamp(start), midnight + F.lit(int(from_hour * 3600)))
        return F.greatest(F.lit(0), F.least(F.unix_timestamp(end), midnight + F.lit(int(to_hour * 3600))) - low)

    return F.when(end >= start, F.aggregate(F.transform(days, part), F.lit(0).cast("bigint"), lambda a, x: a + x) / 3600.0).otherwise(0.0)
