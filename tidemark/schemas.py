"""Explicit schemas of the tables; readers never infer and writers select exactly these columns."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B, _I, _DT, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.DateType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


LISTINGS = struct(
    internal_id=_S, source=_S, source_id=_S, url=_S, property_type=_S, transaction_type=_S, disposition=_S, area_m2=_D, floor=_S, ownership=_S, construction=_S, condition=_S, energy=_S, furnishing=_S, charges=_L,
    deposit=_L, discounted=_S, original_price=_L, seller=_S, agency_id=_S, street=_S, house_number=_S, orientation_number=_S, number_kind=_S, postcode=_S, district=_S, district_origin=_S, municipality=_S, match_distance_m=_D,
    match_candidates=_I, priority_zone=_B, lat=_D, lon=_D, coords_origin=_S, description=_S, first_seen_at=_TS, last_seen_at=_DT, status=_S, cluster_id=_S, dedup_confidence=_S, relisted_from=_S,
)
OBSERVATIONS = struct(internal_id=_S, observed_at=_TS, price=_L, price_per_m2=_L, status=_S)
CHANGES = struct(internal_id=_S, changed_at=_TS, field=_S, old_value=_S, new_value=_S)
REGISTER = struct(point_id=_S, street=_S, street_original=_S, house_number=_S, number_kind=_S, orientation_number=_S, orientation_letter=_S, district=_S, borough=_S, quarter=_S, postcode=_S, lat=_D, lon=_D)
RUN_SOURCE = struct(fetched=_L, new=_L, updated=_L, reactivated=_L, missing_marked=_L, removed_confirmed=_L, run_complete=_B, scopes_absence_marked=T.ArrayType(_S), interruptions=T.ArrayType(_S), errors=T.ArrayType(_S))
RUN_LOG = struct(started_at=_TS, finished_at=_TS, kind=_S, scope=_S, transactions=T.ArrayType(_S), sources=T.MapType(_S, RUN_SOURCE), total_listings=_L, ok=_B)
