"""Fields of portal payloads: JSON records, cards, description lines and addresses of adverts."""

from __future__ import annotations

import html
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import clean_text, fold

#: An advert carries at least two of these beside its id.
MARKERS = ("price", "surface", "disposition", "gps", "offerType", "estateType")

# Words of an advert's address that may lie in the collected area.
AREA_SLUGS = """
praha modrany chodov haje letnany zbraslav ricany jesenice pruhonice cestlice dolni-brezany zdiby klecany roztoky
horomerice cernosice jinocany hostivice rudna jirny sulice vestec psary mnisek kamenice brandys celakovice uvaly
sestajovice zelenec mratin vodochody
""".split()


def may_be_local(slug: Column) -> Column:
    """Whether a slug names a place of the area; a cheap test before a page is fetched, places are tested after."""
    return F.coalesce(slug.rlike("|".join(AREA_SLUGS)), F.lit(False))


def enum_value(c: Column) -> Column:
    """A code given bare or as an object with ``value``."""
    return F.coalesce(F.get_json_object(c, "$.value"), c)


def first_of(body: Column, *paths: str) -> Column:
    """The first path of a JSON text that holds a value other than null, empty or zero."""
    return F.coalesce(*[F.nullif(F.nullif(F.get_json_object(body, p), F.lit("")), F.lit("0")) for p in paths])


def coordinates(body: Column, *pairs: tuple[str, str]) -> Column:
    """Struct of the first (lat, lon) whose two paths both hold numbers."""
    found = [F.when(F.get_json_object(body, a).try_cast("double").isNotNull() & F.get_json_object(body, b).try_cast("double").isNotNull(), F.struct(F.get_json_object(body, a).try_cast("double").alias("lat"), F.get_json_object(body, b).try_cast("double").alias("lon"))) for a, b in pairs]
    return F.coalesce(*found)


def area_m2(stated: Column, title: Column, price: Column, unit_price: Column) -> Column:
    """As stated, else the title's first square metres, else price by unit price where that is plausible."""
    named = F.translate(F.regexp_extract(title, r"(\d+(?:[.,]\d+)?)\s*m(?:²|2)", 1), ",", ".").try_cast("double")
    ratio = F.when(unit_price > 0, price / unit_price)
    return F.coalesce(F.when(stated > 0, stated), named, F.when(ratio.between(5, 2000), F.rint(ratio)))


def url_parts(url: Column) -> Column:
    """Struct of ``id``, ``property_type`` and ``transaction_type`` that an advert's address states."""
    low = F.lower(url)
    return F.struct(
        F.regexp_extract(url, r"/(\d+)(?:-[^/]*)?/?(?:[?#].*)?$", 1).alias("id"),
        F.when(low.rlike(r"\b(byt|bytu|byty|flat)\b"), "byt").when(low.rlike(r"\b(dum|domu|domy|house)\b"), "dum").otherwise("").alias("property_type"),
        F.when(low.contains("pronajem") | low.contains("rent"), "pronajem").when(low.contains("prodej") | low.contains("sale"), "prodej").otherwise("").alias("transaction_type"),
    )


def url_of(base: str, *parts: Column) -> Column:
    return F.concat_ws("/", F.lit(base), *parts)


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML entities resolved; Spark has no built-in for all of them."""
    return texts.map(lambda x: html.unescape(x) if x else x)


def text_of(markup: Column) -> Column:
    """Text of a markup fragment: tags out, entities resolved, white space collapsed."""
    return clean_text(unescape(F.regexp_replace(markup, "<[^>]*>", " ")))


def price_of(text: Column) -> Column:
    """Digits of a price text as a number, null where it names none."""
    return F.nullif(F.regexp_replace(text, r"[^0-9]", ""), F.lit("")).try_cast("bigint")


def title_parts(title: Column) -> Column:
    """Struct of ``disposition`` and ``area_m2`` in an advert's title."""
    rooms = F.regexp_extract(fold(title, "letters"), r"(\d+)\s*\+\s*(kk|1)\b", 0)
    area = F.translate(F.regexp_extract(title, r"(\d+(?:[.,]\d+)?)\s*m(?:²|2)", 1), ",", ".").try_cast("double")
    return F.struct(F.nullif(F.regexp_replace(rooms, r"\s", ""), F.lit("")).alias("disposition"), area.alias("area_m2"))


def cards(page: Column, marker: str) -> Column:
    """The pieces of a page that follow each card marker."""
    return F.slice(F.split(page, marker), 2, 1 << 20)


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("what", "price", "address")]))
def description_parts(texts: pd.Series) -> pd.DataFrame:
    """A description sentence's subject, price and address; initials and abbreviations do not end a sentence."""
    rows = []
    for text in texts:
        sentence = re.split(r"(?<![A-ZÁ-Ž])(?<!\b[a-zá-ž]{2})(?<!\b[a-zá-ž])\.\s+", text or "", maxsplit=1)[0].rstrip(".")
        m = re.match(r"(?P<what>[^,]+),\s*(?:(?P<price>[\d\s ]+)\s*Kč[^,]*,\s*)?(?P<address>.*)$", sentence)
        rows.append((m["what"].strip(), (m["price"] or "").strip() or None, m["address"].strip()) if m else (None, None, None))
    return pd.DataFrame(rows, columns=["what", "price", "address"])


def _largest(node, found: list) -> None:
    if isinstance(node, dict):
        if "id" in node and sum(k in node for k in MARKERS) >= 2:
            found.append(node)
        for x in node.values():
            _largest(x, found)
    elif isinstance(node, list):
        for x in node:
            _largest(x, found)


@F.pandas_udf(T.StringType())
def embedded_advert(pages: pd.Series) -> pd.Series:
    """The largest object with an id and two marker fields in a page's embedded JSON, as JSON."""
    out = []
    for page in pages:
        found: list = []
        for script in re.findall(r"<script[^>]*type=\"application/json\"[^>]*>(.*?)</script>", page or "", re.S):
            try:
                _largest(json.loads(script), found)
            except ValueError:
                continue
        out.append(json.dumps(max(found, key=len), ensure_ascii=False, sort_keys=True) if found else None)
    return pd.Series(out, dtype=object)


def excluded(advert_type: Column, in_area: Column) -> Column:
    """Why a record is left out, or null."""
    return F.when(F.upper(advert_type).isin("WANTED", "POPTAVKA"), "wanted").when(~in_area, "outside")


def robots_allows(path: Column, rules: list[tuple[str, bool]]) -> Column:
    """Longest matching rule decides, Allow on ties, nothing matching allows; ``*`` and a closing ``$`` are wildcards."""
    best = F.struct(F.lit(-1).alias("n"), F.lit(1).alias("ok"))
    for pattern, allow in rules:
        body, end = (pattern[:-1], "$") if pattern.endswith("$") else (pattern, "")
        regex = "^" + ".*".join(re.escape(p) for p in body.split("*")) + end
        mine = F.struct(F.lit(len(pattern)).alias("n"), F.lit(int(allow)).alias("ok"))
        best = F.when(path.rlike(regex), F.greatest(best, mine)).otherwise(best)
    return best["ok"] == 1
