"""Portal vocabularies onto common values, and the price facts of an advert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import fold

# Codes of the portal that names values in English or Czech capitals.
CODES = {
    "ownership": {"OSOBNI": "osobni", "DRUZSTEVNI": "druzstevni", "OBECNI": "obecni", "STATNI": "obecni", "OSTATNI": "ostatni"},
    "construction": {"BRICK": "cihla", "PANEL": "panel", "MIXED": "smisena", "SKELET": "skelet", "WOOD": "drevostavba", "STONE": "kamen", "PREFAB": "montovana"},
    "condition": {
        "NEW": "novostavba", "VERY_GOOD": "velmi dobry", "GOOD": "dobry", "AFTER_RECONSTRUCTION": "po rekonstrukci", "AFTER_PARTIAL_RECONSTRUCTION": "castecne po rekonstrukci",
        "BEFORE_RECONSTRUCTION": "pred rekonstrukci", "IN_RECONSTRUCTION": "v rekonstrukci", "CONSTRUCTION": "ve vystavbe", "PROJECT": "projekt", "BAD": "spatny",
    },
    "furnishing": {"VYBAVENY": "ano", "CASTECNE": "castecne", "NEVYBAVENY": "ne"},
}
# Names of the portal that states values as words, folded.
NAMES = {
    "ownership": {"osobni": "osobni", "druzstevni": "druzstevni", "statni/obecni": "obecni"},
    "construction": {"cihlova": "cihla", "panelova": "panel", "smisena": "smisena", "skeletova": "skelet", "drevostavba": "drevostavba", "kamenna": "kamen", "montovana": "montovana", "modularni": "modularni"},
    "condition": {x: x for x in ("novostavba", "velmi dobry", "dobry", "po rekonstrukci", "pred rekonstrukci", "v rekonstrukci", "ve vystavbe", "projekt", "spatny", "k demolici")},
    "furnishing": {x: x for x in ("ano", "castecne", "ne")},
}
# Advert types that are a private seller's or an agency's.
PRIVATE_TYPES = ("", "UNDEFINED", "DOKONALY_NAJEMNIK", "STALY_NAJEM", "BZR_COMFORT", "MANUAL_BZR_SPRAVCE_PRONAJEM")
AGENCY_TYPES = ("MANUAL_BZR_RK_PRODEJ",)


def by_code(field: str, c: Column) -> Column:
    return F.coalesce(_look(CODES[field], F.upper(F.trim(c))), F.lit(""))


def by_name(field: str, c: Column) -> Column:
    return F.coalesce(_look(NAMES[field], fold(c, "letters")), F.lit(""))


def _look(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def energy_class(c: Column) -> Column:
    first = F.upper(F.substring(F.trim(c), 1, 1))
    return F.when(first.isin(*"ABCDEFG"), first).otherwise("")


def positive(c: Column) -> Column:
    """A whole number above zero, else null: zero is mostly "not given"."""
    x = F.rint(c.cast("string").try_cast("double")).cast("bigint")
    return F.when(x > 0, x)


def charges(total: Column, *parts: Column) -> Column:
    """The total, else the sum of the parts given."""
    summed = sum((F.coalesce(positive(p), F.lit(0)) for p in parts[1:]), F.coalesce(positive(parts[0]), F.lit(0))) if parts else F.lit(0)
    return F.coalesce(positive(total), F.nullif(summed, F.lit(0)))


def original_price(discounted: Column, original: Column, price: Column) -> Column:
    """Only of a discounted advert whose original price is above its price."""
    return F.when(F.coalesce(discounted, F.lit(False)) & (positive(original) > positive(price)), positive(original))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "ano").when(~flag, "ne").otherwise("")


def seller(kind: Column) -> Column:
    """Struct of ``seller`` and ``agency_id`` by advert type."""
    up = F.upper(F.coalesce(kind, F.lit("")))
    who = F.when(up.isin(*PRIVATE_TYPES), "soukromy").when(up.isin(*AGENCY_TYPES), "rk").otherwise("firma")
    return F.struct(who.alias("seller"), F.when(who == "firma", F.lower(up)).otherwise("").alias("agency_id"))


def seller_by_agency(record: Column) -> Column:
    """By a JSON record's agency field: an agency, none (the field is there but empty), or not said (it is absent)."""
    agency = F.coalesce(F.get_json_object(record, "$.premise_id"), F.get_json_object(record, "$.premise.id"))
    said = F.arrays_overlap(F.json_object_keys(record), F.array(F.lit("premise_id"), F.lit("premise")))
    real = F.nullif(F.nullif(agency, F.lit("")), F.lit("0"))
    return F.struct(F.when(real.isNotNull(), "rk").when(said, "soukromy").otherwise("").alias("seller"), F.coalesce(real, F.lit("")).alias("agency_id"))
