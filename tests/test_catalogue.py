"""Every registered query against its SQL in DuckDB, and the entry module without the optional subpackage."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import catalogue

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).parent.parent


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6) if abs(v) < 1e6 else float(f"{v:.11g}")
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in cols) for r in df.collect()], key=str)
    if name in catalogue.ORACLE_SQL:
        r = duck.execute(catalogue.ORACLE_SQL[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == cols
        at = sorted(range(len(names)), key=lambda i: names[i])
        assert got == sorted([tuple(plain(x[i]) for i in at) for x in r.fetchall()], key=str)
    else:
        assert got


def test_street_limit_is_the_rules(spark, tmp_path):
    """Blocks of 17 and 400 rows are paired whole, one of 401 is skipped."""
    sizes = {"a": 17, "b": 400, "c": 401}
    rows = [(k, "n x", b, "t", 1, 1.0) for k, b in enumerate(b for b, n in sizes.items() for _ in range(n))]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = {(r.a_id, r.b_id) for r in catalogue.QUERIES["street_block_pairs"](spark, str(tmp_path)).collect()}
    assert got == {(a, b) for lo, hi in ((0, 17), (17, 417)) for a in range(lo, hi) for b in range(a + 1, hi)}


def test_bootstrap_reads_every_line(spark, duck):
    got = {(r.l_returnflag, r.l_linestatus, r.n) for r in catalogue.QUERIES["bootstrap_ci"](spark, SF).collect()}
    assert got == set(duck.execute("SELECT l_returnflag, l_linestatus, count(l_extendedprice) FROM lineitem GROUP BY ALL").fetchall())


def test_sole_value_sees_every_customer(spark, tmp_path):
    """A balance is no key to a segment if any customer of it is in another one, whatever the balance."""
    rows = [(1, 0, -900.0, "A"), (2, 0, -900.0, "A"), (3, 0, 5.0, "A"), (4, 0, 5.0, "B"), (5, 1, 7.0, "B")]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    assert {tuple(r) for r in catalogue.QUERIES["sole_value_all"](spark, str(tmp_path)).collect()} == {(-900.0, "A"), (7.0, "B")}


def test_copies_hold_every_row_between_them(spark, duck):
    assert catalogue.QUERIES["log_union_all"](spark, SF).count() == duck.execute("SELECT count(DISTINCT (event_id, user_id, event_type)) FROM events").fetchone()[0]
    got = {r.id for r in catalogue.QUERIES["three_way_all"](spark, SF).collect()}
    # Only orders of the base that a side lacks are gone, as deleted.
    gone = duck.execute("SELECT o_orderkey FROM orders").fetchall()
    gone = {k for (k,) in gone if k not in got}
    assert gone and all(k % 2 == 0 and not 3 <= k % 10 < 8 for k in gone) and any(k % 15 == 0 for k in got)


def test_entry_without_the_optional_subpackage(tmp_path):
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 50 and not any(k.startswith('op') for k in e.queries()) and len(e.oracle_sql()) > 50"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_copies_of_parts_make_no_pairs(spark, tmp_path, monkeypatch):
    """Copies of a part are matched as one; a part that can't match stays alone with all its copies, and an id in two rows joins them."""
    kinds = {0: ("x", 10, 900.0), 1: ("x", 11, 900.0), 2: ("x", 49, 900.0), 3: ("x", 49, 0.0)}
    rows = [(120 * n + 3 * k, f"{w} y", "b", "t", size, price) for n in range(200) for k, (w, size, price) in kinds.items()]
    rows += [(9, "x y", "b", "t", 10, 900.0)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    made, real = [], catalogue.cluster.components
    monkeypatch.setattr(catalogue.cluster, "components", lambda nodes, edges: made.append(edges.count()) or real(nodes, edges))
    got = {r.id: r.component for r in catalogue.QUERIES["components"](spark, str(tmp_path)).collect()}
    assert len(got) == 800 and all(got[i] == {0: 0, 3: 0, 6: 6, 9: i}[i % 120] for i in got if i != 9) and got[9] == 0
    assert made[0] <= 10


def test_different_parts_of_a_street_make_no_pairs(spark, tmp_path, monkeypatch):
    """Parts that all differ are linked without a row for each matching pair."""
    rows = [(k, f"w{k % 7} y", "b", "t", k % 40, 900.0 + k / 10) for k in range(600)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    made, real = [], catalogue.cluster.components
    monkeypatch.setattr(catalogue.cluster, "components", lambda nodes, edges: made.append(edges.count()) or real(nodes, edges))
    got = catalogue.QUERIES["components"](spark, str(tmp_path)).collect()
    edges = catalogue._edges(spark, str(tmp_path))
    want = {r.id: r.component for r in real(spark.createDataFrame([(r[0],) for r in rows], "id long"), edges).collect()}
    assert len(got) == 600 and {r.id: r.component for r in got} == want and edges.count() > 10_000
    assert sum(made) < 600
