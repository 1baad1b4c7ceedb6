"""Portal address lines into street, district and municipality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import fold, strip_accents

# The city's cadastral districts, folded.
DISTRICTS = """
bechovice benice bohnice branik brevnov bubenec cakovice chodov cimice
dablice dejvice dubec haje hloubetin hlubocepy hodkovicky holesovice
hostavice hostivar hradcany hrdlorezy jinonice josefov kamyk karlin kbely
klanovice kobylisy kolodeje kolovraty komorany kosire kralovice krc kunratice
kyje lahovice letnany lhotka liben liboc libus lipence lochkov lysolaje
malesice michle miskovice modrany motol nebusice nusle petrovice pisnice
pitkovice podoli prosek radlice radotin reporyje repy ruzyne satalice
seberov sedlec slivenec smichov sobin sterboholy stodulky strasnice
stresovice strizkov suchdol tocna trebonice treboradice troja uhrineves
veleslavin vinohrady vinor vokovice vrsovice vysehrad vysocany zabehlice
zbraslav zizkov zlicin
""".split() + ["cerny most", "dolni chabry", "dolni mecholupy", "dolni pocernice", "horni mecholupy", "horni pocernice", "mala strana", "nove mesto", "predni kopanina", "stare mesto", "velka chuchle", "nedvezi u rican", "ujezd nad lesy", "ujezd u pruhonic"]
_BOROUGH = r"^praha\s*\d+$"


def parse(raw: Column) -> Column:
    """Struct of ``street``, ``district`` and ``municipality`` (ASCII, empty where not named).

    The last part names the municipality; ``borough - district`` names a district; further parts from the right that are
    boroughs or districts are consumed; the first part left is the street, without a trailing number.
    """
    key = lambda c: F.lower(F.trim(c))
    known = lambda c: key(c).rlike(_BOROUGH) | key(c).isin(DISTRICTS)
    parts = F.transform(F.split(strip_accents(F.coalesce(raw, F.lit(""))), ","), lambda p: F.trim(p))
    parts = F.filter(parts, lambda p: (p != "") & ~key(p).rlike(r"^okres\b"))
    dashed = F.filter(parts, lambda p: p.contains(" - "))
    named = F.trim(F.regexp_extract(F.try_element_at(dashed, F.lit(-1)), r"^.*? - (.*)$", 1))
    heads = F.transform(parts, lambda p: F.trim(F.when(p.contains(" - "), F.regexp_extract(p, r"^(.*?) - .*$", 1)).otherwise(p)))
    last = F.try_element_at(heads, F.lit(-1))
    in_city = key(last).rlike(_BOROUGH)
    municipality = F.when(in_city, "Praha").otherwise(last)
    body = F.slice(heads, 1, F.greatest(F.size(heads) - 1, F.lit(0)))
    # From the right: how many parts name boroughs or districts without a break.
    taken = F.aggregate(F.reverse(body), F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda s, p: F.struct((s.n + (s.go & known(p)).cast("int")).alias("n"), (s.go & known(p)).alias("go"))).n
    street_part = F.try_element_at(F.slice(body, 1, F.greatest(F.size(body) - taken, F.lit(0))), F.lit(1))
    nearest = F.when(taken > 0, F.try_element_at(body, F.lit(-1)))
    district = F.coalesce(F.nullif(named, F.lit("")), F.when(in_city, last), nearest, F.lit(""))
    street = F.trim(F.regexp_replace(F.coalesce(street_part, F.lit("")), r"\s+[\d/]+[a-zA-Z]?\s*$", ""))
    empty = F.size(parts) == 0
    return F.struct(
        F.when(empty | (key(street) == key(municipality)), "").otherwise(street).alias("street"),
        F.when(empty, "").otherwise(district).alias("district"),
        F.when(empty, "").otherwise(municipality).alias("municipality"),
    )


def street_fold(c: Column) -> Column:
    return fold(c)
