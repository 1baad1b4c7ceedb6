"""Operators over whole corpora against brute force: mixing, join, WARC, nearest neighbours, pipeline."""

import gzip
import math
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import annpartition, mixing, ngramjoin, warc
from tidemark.llm import components as parts
from tidemark.llm.components import components
from tidemark.llm.queries import ORACLE_SQL, QUERIES
from tidemark.llm.store import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(docs):
    """(size, component, number of links) of each id."""
    sets = {i: shingle_set(t) for i, t in docs}
    label, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(sets[i]), root(i), links[i]) for i in sets}


def hard_corpus(seed):
    """Copies, near copies around one base, drifting chains, shared passages, short and empty texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(4000)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    passage, line = draw(60), draw(8)
    docs = ["", None, "one", "one", "One two", "one two", " ".join(line)] * 2
    base = draw(120)
    for _ in range(60):
        v = list(base)
        for _ in range(rng.randint(0, 4)):
            v[rng.randrange(len(v))] = rng.choice(words)
        docs.append(" ".join(v))
    drift = draw(150)
    for k in range(25):
        drift = drift[4:] + draw(4) if k % 2 else drift + draw(3)
        docs.append(" ".join(drift))
    docs += [" ".join(draw(rng.randint(5, 80)) + passage + draw(rng.randint(0, 40))) for _ in range(60)]
    docs += [" ".join(draw(3) + line * rng.randint(1, 3)) for _ in range(60)]
    docs += [docs[20]] * 40 + [" ".join(draw(rng.randint(1, 7))) for _ in range(30)]
    rng.shuffle(docs)
    return [(10 * i, t) for i, t in enumerate(docs)]


def joined(docs, count_links=True):
    return {r.doc_id: tuple(r)[1:] for r in ngramjoin.near_duplicates(docs, count_links=count_links).collect()}


@pytest.mark.parametrize(("seed", "block", "entries"), [(1, 256, 1 << 20), (2, 8, 1 << 20), (3, 5, 900)])
def test_join_equals_all_pairs(spark, monkeypatch, seed, block, entries):
    """Also with columns and groups cut into many row blocks."""
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    monkeypatch.setattr(parts, "LOCAL_LINKS", 0 if seed == 3 else 1 << 20)
    monkeypatch.setattr(ngramjoin, "ENTRIES", entries)
    rows = hard_corpus(seed)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(5)
    want = brute_components(rows)
    assert joined(docs) == want
    got = joined(docs, count_links=False)
    assert got == {i: x[:2] for i, x in want.items()}
    kept = {r.doc_id for r in ngramjoin.keep_one(docs).collect()}
    assert kept == {i for i, (_, c) in got.items() if i == c}


def test_join_of_a_hot_group(spark, monkeypatch):
    """A third of all rows in one group of different near copies, another in exact copies, over many blocks."""
    monkeypatch.setattr(ngramjoin, "BLOCK", 16)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    base = [rng.choice(words) for _ in range(100)]
    rows = []
    for k in range(450):
        v = list(base)
        if k % 3 == 0:
            for _ in range(3):
                v[rng.randrange(100)] = rng.choice(words)
        elif k % 3 == 1:
            v = [rng.choice(words) for _ in range(rng.randint(1, 60))]
        rows.append((k, " ".join(v)))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(6)
    want = brute_components(rows)
    assert joined(docs) == want and joined(docs, count_links=False) == {i: x[:2] for i, x in want.items()}


def test_join_meets_strays(spark, monkeypatch):
    """Rows outside a column's largest component meet each other, whatever blocks they are in."""
    monkeypatch.setattr(ngramjoin, "BLOCK", 2)
    passage = [f"p{k}" for k in range(30)]
    rows = [(10 * k + c, " ".join([f"x{k}y{j}" for j in range(3)] + passage[: 20 + k % 7] + [f"z{c}"])) for k in range(25) for c in range(2)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(3)
    want = brute_components(rows)
    assert joined(docs) == want and joined(docs, count_links=False) == {i: x[:2] for i, x in want.items()}


def test_join_odd_tables(spark):
    """Repeated rows, null ids, clashing column names and one very long text."""
    rng = random.Random(4)
    long = " ".join(f"v{rng.randrange(9000)}" for _ in range(30_000))
    near = long + " tail"
    rows = [(1, long, 1, 2), (2, near, 1, 2), (3, "a b", 1, 2), (3, "a b", 1, 2), (4, "A b", 1, 2), (None, "a b", 1, 2), (5, None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` int, __other int")
    got = sorted(tuple(r) for r in ngramjoin.near_duplicates(docs, count_links=True).collect())
    sizes = [len(shingle_set(t)) for t in (long, near)]
    assert got == [(1, sizes[0], 1, 1), (2, sizes[1], 1, 1), (3, 1, 3, 2), (3, 1, 3, 2), (4, 1, 3, 2), (5, 0, 5, 0)]
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 3, 5]


def test_near_pairs_are_all_pairs(spark):
    """Pairs within a group of near copies too, each between the smallest ids of two different sets."""
    rows = hard_corpus(3)
    first = {}
    for i, t in rows:
        if shingle_set(t):
            first.setdefault(frozenset(shingle_set(t)), i)
    want = {(a, b) for x, a in first.items() for y, b in first.items() if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    pairs, copies = ngramjoin.near_pairs(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(5))
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    assert {tuple(r) for r in copies.collect()} == {(i, c) for i, t in rows if shingle_set(t) and (c := first[frozenset(shingle_set(t))]) != i}


def test_join_of_near_copies_of_a_longer_text(spark):
    """Near copies that share columns only with a text that holds both of them and is far too long."""
    a, p = [f"a{i}" for i in range(15)], [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(a[:14])), (2, " ".join(a)), (84, " ".join(a + p * 5))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS)
    got = joined(docs)
    assert got == brute_components(rows) and got[2] == (11, 1, 1)


def test_join_of_nothing(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert ngramjoin.near_duplicates(none).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None), (2, "", None, None, None)], COLUMNS)
    assert sorted(tuple(r) for r in ngramjoin.near_duplicates(blank).collect()) == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]


@pytest.mark.parametrize("local", [0, 1 << 20])
def test_components(spark, monkeypatch, local):
    """In rounds over all executors, and by one task."""
    monkeypatch.setattr(parts, "LOCAL_LINKS", local)
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[100] == got[95] == 90
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_mix(rows, weights, fraction, epochs, seed=17):
    """rows: (doc_id, path, tokens)."""
    import hashlib

    avail = defaultdict(int)
    for _, path, n in rows:
        avail[path] += n
    weight = lambda path: float(weights.get(path, 1))

    def limit(prefix):
        if len(prefix) == 3:
            return avail[prefix] * epochs
        kids = {p[: len(prefix) + 1] for p in avail if p[: len(prefix)] == prefix}
        return sum(limit(k) for k in kids if weight(k) > 0)

    budget = {}

    def split(prefix, amount):
        if len(prefix) == 3:
            budget[prefix] = math.floor(amount + 1e-6)
            return
        kids = {p[: len(prefix) + 1] for p in avail if p[: len(prefix)] == prefix}
        live = {k: min(weight(k), 1e9) for k in kids if weight(k) > 0}
        given, left, open_ = {}, amount, set(live)
        while open_:
            each = left / sum(live[k] for k in open_)
            full = {k for k in open_ if limit(k) <= each * live[k] + 1e-9}
            if not full:
                given |= {k: each * live[k] for k in open_}
                break
            for k in full:
                given[k] = limit(k)
                left -= limit(k)
            open_ -= full
        for k, a in given.items():
            split(k, a)

    split((), float(math.floor(sum(avail.values()) * fraction)))
    out = {}
    for path in avail:
        if avail[path] and budget.get(path):
            passes, rest = divmod(budget[path], avail[path])
            own = sorted((hashlib.md5(f"{seed}:{passes}:{i}".encode()).hexdigest(), i, n) for i, p, n in rows if p == path)
            used = 0
            for _, i, n in own:
                used += n
                if passes + (used <= rest):
                    out[i] = passes + (used <= rest)
    return out


def test_mixing_redistributes_and_fills(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["src1", "src9", "src9", "src20", "odd", None])
        rows.append((i, " ".join(["w"] * rng.randint(0, 30)) if i % 17 else None, lang, source, 0))
    docs = spark.createDataFrame(rows, COLUMNS)
    for fraction, epochs in ((0.3, 1), (0.6, 2), (1.0, 1), (1.7, 2), (0.0, 1)):
        got = {r.doc_id: r.copies for r in mixing.mix_documents(docs, fraction, epochs).collect()}
        domain = lambda s: "other" if not s or not s[-1].isdigit() else "web" if int(s[3:]) < 8 else "books" if int(s[3:]) < 14 else "forums"
        brute = brute_mix([(i, (domain(s), lang or "", s or ""), len((t or "").split())) for i, t, lang, s, _ in rows], mixing.WEIGHTS, fraction, epochs)
        assert got == brute, (fraction, epochs)
    assert mixing.mix_documents(docs.limit(0), 0.5, 1).count() == 0


def test_shut_subtree_gets_nothing(spark):
    docs = spark.createDataFrame([(i, "a b c", "en" if i % 2 else "de", "src1", 0) for i in range(20)], COLUMNS)
    out = mixing.mix_sources(docs, ["lang"], {("de",): 0}, fraction=0.5, max_epochs=1).collect()
    assert {r.lang for r in out} == {"en"} and len(out) == 10


@pytest.mark.parametrize("name", ["op1_mixing", "op3_ngram_join", "op5_warc"])
def test_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for t in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    r = duck.execute(ORACLE_SQL[name])
    cols = [d[0] for d in r.description]
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(str, (tuple(x[c] for c in cols) for x in df.collect()))) == sorted(map(str, r.fetchall()))


def test_warc_revisits_and_round_trip(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 1000
    rows = [(1, "http://a", long), (2, "http://b", long), (3, None, long), (4, "u\r\nv", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "y" * 1000), (8, "u", "y" * 1000), (9, "u", "y" * 999), (10, "u", "y" * 999), (None, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fresh_path(spark, "warc-test")
    warc.write_archive(pages, path)
    archive = warc.read_archive(spark, path)
    got = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes) for r in warc.restore(archive).collect())
    size = len(long.encode())
    assert got == sorted([(0, "response", None, size), (1, "revisit", 3, size), (2, "revisit", 3, size), (3, "response", None, size), (4, "response", None, 5), (5, "response", None, 5), (6, "response", None, 0), (7, "response", None, 0), (8, "response", None, 1000), (8, "response", None, 1000), (9, "response", None, 999), (10, "response", None, 999)])
    # Any reader of gzip members finds the mandatory headers, and a record at each member's offset.
    names, members = [], 0
    for content in [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect() if "part-" in r.path]:
        for headers, _ in warc.parse(content):
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(headers) and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", headers["WARC-Date"])
            names.append(headers["WARC-Record-ID"])
        assert gzip.decompress(content).count(b"WARC-Record-ID") == len(list(warc.parse(content)))
        members += content.count(b"\x1f\x8b\x08")
    assert len(names) == len(set(names)) == len(rows) and members >= 2 * len(rows)
    bodies = {r.page_id: r.payload for r in archive.filter("record_type = 'response'").collect()}
    assert bodies[3] == long and bodies[6] == "" and bodies[4] == "short"
    none = fresh_path(spark, "warc-none")
    warc.write_archive(pages.limit(0), none)
    assert warc.read_archive(spark, none).count() == 0


def test_neighbours_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    x = (centres[rng.integers(0, 12, 6000)] + 0.6 * rng.normal(size=(6000, 24))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(6000, None), (6001, [0.0] * 24), (6100, [math.nan] * 24), (6200, [1.0] * 23), (6300, [None] * 24), (6400, [math.inf] * 24)]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>")
    out = defaultdict(list)
    for r in annpartition.search(df, sample=1500, parts=12).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score, r["rank"]))
    assert set(out) == set(range(0, 6000, 100))
    hit = 0
    for q, got in out.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(6000), d))[:10]
        hit += len(set(best.tolist()) & {v for v, _, _ in got})
        assert len(got) == 10 and [k for _, _, k in got] == list(range(1, 11)) and q not in {v for v, _, _ in got}
        assert all(abs(d[v] - s) < 1e-9 for v, s, _ in got)
    assert hit / (10 * len(out)) >= 0.9


def exact_neighbours(x, ids, q, k=10):
    """(vec_id, distance) of the nearest distinct ids of vector q, its own id left out."""
    best = {}
    for i, v in zip(ids, x, strict=True):
        if i != ids[q]:
            best[i] = min(best.get(i, math.inf), float(np.sqrt(((v - x[q]) ** 2).sum())))
    return sorted(((d, i) for i, d in best.items()))[:k]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_neighbours_recall_on_the_table_at_the_defaults(spark, sf):
    """Against exact search over all rows; one part is exact, which numpy confirms."""
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    exact = annpartition.search(df, parts=1)
    assert annpartition.recall(annpartition.search(df), exact) >= 0.9
    rows = [(r.vec_id, r.embedding) for r in annpartition.valid(df, "vec_id", "embedding").select(F.col("id").alias("vec_id"), F.col("vec").alias("embedding")).collect()]
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
    got = defaultdict(list)
    for r in exact.filter("query_id % 500 = 0").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    for q, found in got.items():
        want = exact_neighbours(x, ids, ids.index(q))
        assert [i for _, i in found] == [i for _, i in want] and np.allclose([d for d, _ in found], [d for d, _ in want])


def test_neighbours_with_repeated_ids(spark):
    """An id that is repeated near a query takes one place, not all of them; the rest come from other parts."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, (x[0] + 1e-3 * k).tolist()) for k in range(15)]
    for parts in (None, 5):
        got = annpartition.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), parts=parts).orderBy("rank").collect()
        want = exact_neighbours(np.array([v for _, v in rows]), [i for i, _ in rows], 0)
        assert [(r.query_id, r["rank"]) for r in got] == [(0, k) for k in range(1, 11)]
        assert len({r.vec_id for r in got}) == 10 and got[0].vec_id == 7 and abs(got[0].score - want[0][0]) < 1e-12
    few = [(0, [1.0, 2.0])] + [(3, [1.0, k / 9]) for k in range(40)] + [(4, [9.0, 9.0])]
    got = annpartition.search(spark.createDataFrame(few, "vec_id long, embedding array<double>"), parts=4).collect()
    assert sorted((r.vec_id, r["rank"]) for r in got) == [(3, 1), (4, 2)]


def test_parts_are_balanced_over_all_rows(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(6000, 8)), rng.normal(size=(2000, 8)) * 0.1 + 3])
    df = annpartition.valid(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), "vec_id", "embedding")
    router = annpartition.build_router(df, 2000, 10)
    sizes = annpartition._sizes(annpartition._assigned(df, router), 10)
    assert sizes.sum() == 8000 and sizes.max() < 1.7 * sizes.mean()


def test_neighbours_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [1.0, 1.0]), (200, [1.0]), (201, [3.0]), (300, []), (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in annpartition.search(df).collect())
    assert got == [(0, 1, 7), (0, 2, 100), (100, 1, 7), (100, 2, 0), (200, 1, 201)]
    assert annpartition.search(df.limit(0)).count() == 0


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen, now = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, sf).cache()
        seen.append(now.count())
        if name == "near duplicates":
            want = {i for i, (_, c, _) in brute_components([(r.doc_id, r.text) for r in before.collect()]).items() if i == c}
            assert {r.doc_id for r in now.collect()} == want
        if name == "personal data":
            assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text) for r in now.collect())
        if name != "encoding":
            assert now.columns == docs.columns
    assert seen[0] > seen[1] > seen[2] == seen[3] > seen[4] == seen[5] > 0
    assert now.filter("NOT exact").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "personal data", "mixing", "encoding"]


def test_mixture_keeps_what_it_chose_without_an_id(spark):
    """A null id is an id: its documents stay in the leaves where the mixture chose it, and in no others."""
    rows = [(i, "a b c d", "en", "s1", 7) for i in range(40)] + [(None, "a b", "en", "s1", 3), (None, "a", None, None, 1), (None, "e f g h", "xx", "s2", 7)] + [(100 + i, "e f g h", "xx", "s2", 7) for i in range(40)] + [(5, "e f g h", "xx", "s2", 7)]
    docs = spark.createDataFrame(rows, COLUMNS)
    chosen = {(r.doc_id, r.lang, r.source) for r in mixing.mix_documents(docs, 0.9, 1).collect()}
    want = [r for r in rows if (r[0], r[2] or "", r[3] or "") in chosen]
    got = corpus_pipeline.mix_to_weights(spark, docs, "")
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(r[0] is None for r in want) and len(want) < len(rows)
