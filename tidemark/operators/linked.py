"""Links among adverts of a street without their pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.geo import EARTH_M
from tidemark.operators.cluster import saved
from tidemark.operators.match import AREA_FLOOR_M2, TIERS, _side, confidence, known, stated

#: All that matching reads of a row.
READ = ["street", "property_type", "transaction_type", "disposition", "area_m2", "lat", "lon", "places", "prices"]
#: Kinds of a street that meet in one task, about; pairs that are held at a time; and the share by which a squared distance is left open.
BLOCK = 8192
CELLS = 1 << 16
SLACK = 1e-7


def _padded(lists: pa.ListArray, values: np.ndarray, fill: float) -> np.ndarray:
    """A column for each place in the lists; ``values`` are those of all lists."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    at = np.arange(max(1, n.max(initial=0))) < n[:, None]
    out = np.full(at.shape, fill, dtype=values.dtype)
    out[at] = values
    return out.T


def links(area: pa.Array, lat: pa.Array, lon: pa.Array, prices: pa.ListArray, places: pa.ListArray, copies: np.ndarray, share: float, slack: float = SLACK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of kinds alike in type, deal, layout and street: ``i``, ``j`` and ``sure``.

    Sure: ``j`` is the first kind of the component of ``i``, for each kind that any other or a copy of it matches. Else a pair
    so near a limit of distance that only the rule's own expression can tell. A kind that was reached is left out of what
    comes after, so components cost their kinds times those that are in none yet. Areas are positive, prices known.
    """
    size, spot = area.to_numpy(zero_copy_only=False), pc.and_(pc.is_valid(lat), pc.is_valid(lon)).to_numpy(zero_copy_only=False)
    la, lo = (np.radians(c.to_numpy(zero_copy_only=False)) for c in (lat, lon))
    unit = (np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la))
    paid = _padded(prices, prices.flatten().to_numpy(zero_copy_only=False), np.nan)
    words = places.flatten().dictionary_encode()
    word = _padded(places, pc.fill_null(words.indices, -1).to_numpy(), -1)
    # As in the rule, unstated places are never apart.
    stating = (word[0] >= 0) & ((word >= 0).sum(axis=0) == pc.fill_null(pc.list_value_length(places), 0).to_numpy())
    # To Spark NaN equals itself and is above all numbers, so what is no number is close to all.
    no_area, no_price = np.isnan(size), np.zeros(len(size), bool)
    np.logical_or.at(no_price, pc.list_parent_indices(prices).to_numpy(), np.isnan(prices.flatten().to_numpy(zero_copy_only=False)))

    def meets(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        off, most = np.abs(size[a] - size[b]), np.maximum(size[a], size[b])
        fits = lambda rel: (off <= np.maximum(AREA_FLOOR_M2, rel * most)) | no_area[a] | no_area[b]
        agree, common = no_price[a] | no_price[b], ~stating[a] | ~stating[b]
        for p in paid:
            for q in paid:
                agree = agree | (np.abs(p[a] - q[b]) <= share * np.maximum(p[a], q[b]))
        for p in word:
            for q in word:
                common = common | ((p[a] == q[b]) & (p[a] >= 0))
        chord2 = sum((u[a] - u[b]) ** 2 for u in unit)
        near = over = np.zeros(off.shape, bool)
        for _, _, metres, rel in TIERS:
            limit, close = (2 * np.sin(metres / (2 * EARTH_M))) ** 2, fits(rel)
            near, over = near | (close & (chord2 <= limit * (1 - slack))), over | (close & (chord2 <= limit * (1 + slack)))
        both = spot[a] & spot[b]
        return agree & np.where(both, near, common & fits(TIERS[-1][3])), agree & both & over & ~near

    with np.errstate(invalid="ignore"):
        label, left, open_ = np.arange(len(size)), np.arange(len(size)), []
        while left.size:
            root, queue, left = left[0], left[:1], left[1:]
            while queue.size and left.size:
                step = max(1, CELLS // left.size)
                head, queue = queue[:step], queue[step:]
                sure, maybe = meets(head[:, None], left)
                if maybe.any():
                    r, c = np.nonzero(maybe)
                    open_.append((head[r], left[c]))
                new = sure.any(axis=0)
                label[left[new]] = root
                queue, left = np.concatenate([queue, left[new]]), left[~new]
        twice = np.nonzero(copies)[0]
        sure, maybe = meets(twice, twice)
    linked = np.bincount(label, minlength=len(size))[label] > 1
    linked[twice[sure]] = True
    i, j = (np.concatenate(x) for x in zip(*open_, (twice[maybe], twice[maybe])))
    asked = (label[i] != label[j]) | ((i == j) & ~linked[i])
    sure = np.nonzero(linked)[0]
    return np.concatenate([sure, i[asked]]), np.concatenate([label[sure], j[asked]]), np.arange(len(sure) + asked.sum()) < len(sure)


def _links(share: float, slack: float):
    """``links`` for rows of arrays."""

    def run(area: pa.Array, lat: pa.Array, lon: pa.Array, prices: pa.Array, places: pa.Array, copies: pa.Array) -> pa.Array:
        ends, found = [0], [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool))]
        for *row, twice in zip(area, lat, lon, prices, places, copies):
            found.append(links(*[c.values for c in row], twice.values.to_numpy(zero_copy_only=False), share, slack))
            ends.append(ends[-1] + len(found[-1][0]))
        i, j, sure = (np.concatenate(x) for x in zip(*found))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(sure)], names=["i", "j", "sure"]))

    # Stated as objects, as the annotations above are strings to a worker.
    run.__annotations__ = dict.fromkeys(("area", "lat", "lon", "prices", "places", "copies", "return"), pa.Array)
    return F.arrow_udf(run, "array<struct<i: int, j: int, sure: boolean>>")


def linked(rows: DataFrame, price_rel_pct: float, slack: float = SLACK) -> DataFrame:
    """(``id``, ``label``) of rows on streets of any size: ids of one component of matches share labels, as ``cluster.joined`` takes them.

    Times on the market don't count. Rows alike in all that matching reads are one kind: they match each other or none does.
    Kinds that can match at all meet in ``links``; a street of more than ``BLOCK`` kinds is dealt out as pairs of blocks.
    """
    same = ["street", "property_type", "transaction_type", "__layout"]
    kinds = rows.filter("internal_id IS NOT NULL AND area_m2 > 0").groupBy(*READ).agg(F.min("internal_id").alias("low"), F.max("internal_id").alias("high"))
    able = kinds.withColumns({"__layout": stated(F.col("disposition")), "__known": known(F.col("prices")).cast("array<double>")}).filter(F.size("__known") > 0).dropna(subset=same)
    sized = able.withColumn("__blocks", F.ceil(F.count("*").over(Window.partitionBy(*same)) / BLOCK))
    dealt = sized.withColumn("__own", F.pmod(F.xxhash64(*READ), "__blocks")).withColumn("__met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1))).filter("__blocks = 1 OR __own <> __met")
    # Dealt anew, else all blocks of a street stay in the task that counted them.
    dealt = dealt.withColumns({"__a": F.least("__own", "__met"), "__b": F.greatest("__own", "__met")}).repartition(*same, "__a", "__b")
    blocks = dealt.groupBy(*same, "__a", "__b").agg(F.array_sort(F.collect_list(F.struct("low", "high", *READ, "__known"))).alias("k"))
    copies = F.transform("k", lambda x: x["low"] < x["high"])
    met = blocks.withColumn("hits", _links(price_rel_pct / 100.0, slack)(*[F.col(f"k.{c}") for c in ("area_m2", "lat", "lon", "__known", "places")], copies))
    hit = lambda h: F.struct(F.get("k", h["i"]).alias("a"), F.get("k", h["j"])["low"].alias("label"), F.when(~h["sure"], F.get("k", h["j"])).alias("b"))
    hits = saved(met.select(F.inline(F.transform("hits", hit))))
    told = lambda s, label: [*[F.col(f"{s}.{c}").alias(f"__{c}") for c in READ], label.alias("__label")]
    labels, unsure = hits.filter("b IS NULL").select(*told("a", F.col("label"))), hits.filter("b IS NOT NULL")
    if not unsure.isEmpty():
        found = unsure.filter(confidence(_side("a"), _side("b"), overlap=False, price_rel_pct=price_rel_pct).isNotNull())
        for s in ("a", "b"):
            labels = labels.unionByName(found.select(*told(s, F.least("a.low", "b.low"))))
    # Rows are sorted by a hash alone; it only proposes.
    labels = labels.withColumn("__hash", F.xxhash64(*[f"__{c}" for c in READ]))
    one = [F.xxhash64(*READ) == F.col("__hash"), *[F.col(c).eqNullSafe(F.col(f"__{c}")) for c in READ]]
    return rows.join(labels, one, "left").select(F.col("internal_id").alias("id"), F.when(F.col("internal_id").isNotNull(), F.coalesce("__label", "internal_id")).alias("label"))
