import datetime as dt
import gzip

import shutil
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import sinks, tables
from tidemark.streaming import log


def test_listings_round_trip_and_duplicates(spark, tmp_path):
    head = "internal_id,source,area_m2,last_seen_at,status,extra\n"
    (tmp_path / "live.csv").write_text(head + 'a,idnes,"55.5",2026-01-02,active,x\nb,idnes,,2026-01-02,active,x\n')
    with gzip.open(tmp_path / "2026-01.csv.gz", "wt") as f:
        f.write(head + "a,idnes,50,2026-01-02,removed,x\n")
    rows = {r.internal_id: r for r in tables.read_listings(spark, str(tmp_path / "live.csv"), [str(tmp_path / "2026-01.csv.gz")]).collect()}
    assert rows["a"].status == "removed" and rows["b"].area_m2 is None and set(rows["a"].asDict()) == set(schemas.LISTINGS.names)
    out = str(tmp_path / "out")
    sinks.write_listings(tables.read_listings(spark, str(tmp_path / "live.csv")), out)
    assert spark.read.parquet(out).filter("bucket = 'live'").count() == 2


def test_write_if_changed_and_snapshot(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    path = str(tmp_path / "t")
    assert sinks.write_if_changed(rows, path) and not sinks.write_if_changed(rows.orderBy(F.desc("k")), path) and sinks.write_if_changed(rows.limit(1), path)
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "x.txt").write_text("one")
    before = spark.createDataFrame(sinks.manifest(spark, str(tmp_path / "data")).collect())
    assert sinks.verify(spark, str(tmp_path / "data"), before).count() == 0
    (tmp_path / "data" / "x.txt").write_text("two")
    assert [r.fault for r in sinks.verify(spark, str(tmp_path / "data"), before).collect()] == ["changed"]


def test_logs_append_by_month_of_run(spark, tmp_path):
    rows = spark.createDataFrame([("a", dt.datetime(2020, 1, 1))], "internal_id string, observed_at timestamp")
    for _ in range(2):
        sinks.append_log(rows, str(tmp_path / "log"), F.lit("2026-09-21").cast("date"))
    assert [(r.month, r.n) for r in spark.read.parquet(str(tmp_path / "log")).groupBy("month").agg(F.count("*").alias("n")).collect()] == [("2026-09", 2)]


def test_raw_and_register(spark, tmp_path):
    with gzip.open(tmp_path / "raw.json.gz", "wt") as f:
        f.write('{"results": [{"id": 1}, {"id": 2}]}')
    raw = tables.read_raw(spark, str(tmp_path / "raw.json.gz"))
    assert tables.advert_pages(raw, schemas.struct(id=schemas._L)).count() == 2
    (tmp_path / "export.csv").write_bytes("KOD;ULICE\n1;Růžová\n".encode("cp1250"))
    got = tables.read_register_export(spark, str(tmp_path / "export.csv"), schemas.struct(point_id=schemas._S, street=schemas._S), {"KOD": "point_id", "ULICE": "street"}).first()
    assert (got.point_id, got.street) == ("1", "Růžová")


def stream(spark, tmp_path, rows, schema):
    for k, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def drained(df, tmp_path, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name).collect()


def test_streamed_change_log_equals_batch(spark, tmp_path):
    t = dt.datetime(2026, 1, 1)
    rows = [[("a", t, 1, 100.0, "x"), ("a", t + dt.timedelta(1), 2, None, "x")], [("a", t + dt.timedelta(2), 3, None, "y"), ("b", t, 4, 5.0, "x")]]
    s = stream(spark, tmp_path, rows, "internal_id string, observed_at timestamp, event_id long, price double, status string")
    got = {(r.internal_id, r.price, r.status) for r in drained(log.change_only(s), tmp_path, "changes")}
    assert got == {("a", 100.0, "x"), ("a", None, "y"), ("b", 5.0, "x")}


def test_streamed_windows_and_removals(spark, tmp_path):
    t = dt.datetime(2026, 1, 1, 12)
    rows = [[("a", t), ("b", t)], [("a", t + dt.timedelta(days=9))], [("c", t + dt.timedelta(days=20))]]
    s = stream(spark, tmp_path, rows, "internal_id string, observed_at timestamp")
    got = drained(log.counts(s, "observed_at", []), tmp_path, "daily")
    assert (dt.datetime(2026, 1, 1), 2) in {(r.start, r.n) for r in got}
    gone = drained(log.removals(s), tmp_path, "gone")
    assert {r.internal_id for r in gone} >= {"b"} and all(r.status == "removed" for r in gone)


def test_a_replacement_cut_short_loses_no_row(spark, tmp_path):
    """Killed while writing, after setting aside, or before the last clean-up: one whole table is found."""
    path = str(tmp_path / "state")
    first, second = spark.range(3), spark.range(5)
    sinks.write_state(first, path)
    with pytest.raises(ZeroDivisionError):
        sinks.replace(spark, path, lambda to: (second.write.parquet(to), 1 / 0))
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "state.new").exists()
    (tmp_path / "state").rename(tmp_path / "state.old")
    second.write.parquet(f"{path}.new")
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    shutil.copytree(tmp_path / "state", tmp_path / "state.old")
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "state.old").exists()
    sinks.write_state(spark.read.parquet(path).union(spark.read.parquet(path)), path)
    assert spark.read.parquet(path).count() == 6
