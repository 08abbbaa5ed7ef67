import uuid

import pytest
from pyspark.sql import functions as F

from assaylake.sinks import exports, manifest, tables as sinks
from assaylake.sources import tables as sources


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [("a", f"s{i}", float(i)) for i in range(30)] + [("b", "t", 1.0)], "cls string, id string, v double"
    )


@pytest.fixture
def name(spark):
    made = f"t_{uuid.uuid4().hex}"
    yield made
    sinks.unpublish(spark, made)


def test_publish_replaces_rows_and_schema(spark, frame, name):
    sinks.publish(frame, name, ["cls"])
    sinks.publish(frame.select("id").limit(2), name)
    stored = sources.read_table(spark, name)
    assert stored.columns == ["id"] and stored.count() == 2
    assert [r[0] for r in sources.find_tables(spark, name[:10] + "*").collect()] == [name]
    assert sources.table_or_compute(spark, name, lambda: spark.range(9)).count() == 2


def test_partitioned_write_and_republish(spark, frame, name, tmp_path):
    path = str(tmp_path / "long")
    sinks.write_long(frame, path, ["cls"], ["id"])
    back = sources.read_path(spark, path)
    assert back.select(frame.columns).exceptAll(frame).count() == 0 and back.count() == 31
    assert {p.name for p in (tmp_path / "long").iterdir() if p.is_dir()} == {"cls=a", "cls=b"}
    sinks.publish_path(spark, path, name, ["cls"])
    assert spark.table(name).count() == 31


def test_partitioned_write_splits_a_large_class(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        large = spark.range(200_000).select(F.lit("hot").alias("cls"), F.xxhash64("id").alias("id"))
        sinks.write_long(large, str(tmp_path / "hot"), ["cls"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "cls=hot").glob("*.parquet"))) > 1


def test_register_location(spark, frame, name, tmp_path):
    path = str(tmp_path / "at")
    sinks.write_long(frame, path, ["cls"])
    sinks.register_locations(spark, {name: path})
    sinks.register_location(spark, name, path)
    assert spark.table(name).filter("cls = 'b'").count() == 1


def test_csv_exports(spark, frame, tmp_path, rows):
    exports.export_csv(frame, str(tmp_path / "all.csv"))
    parts = list((tmp_path / "all.csv").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[0] == "cls,id,v"
    exports.export_csv(frame, str(tmp_path / "first.csv"), order=["id"], limit=2)
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "first.csv")).select("id")) == [("s0",), ("s1",)]
    with pytest.raises(ValueError):
        exports.export_csv(frame, str(tmp_path / "x.csv"), limit=2)


def test_manifest(spark, rows):
    meta = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "file_id string, file_name string")
    listing = spark.createDataFrame([("1", "/p1", 9), ("1", "/p0", 0), ("2", "/p2", 0)], "file_id string, path string, length bigint")
    got = manifest.ingest_manifest(meta, listing)
    assert rows(got) == [("1", "a", "present", "/p1"), ("2", "b", "empty", "/p2"), ("3", "c", "missing", None)]
    assert rows(manifest.manifest_states(got)) == [("empty", 1), ("missing", 1), ("present", 1)]


def test_a_failed_write_leaves_the_rows_that_were_there(spark, frame, name, monkeypatch):
    sinks.publish(frame, name, ["cls"])
    bad = spark.range(3).select(F.expr("raise_error('no')").alias("id"), F.lit("a").alias("cls"))
    for by in ((), ("cls",)):
        with pytest.raises(Exception):
            sinks.publish(bad, name, by)
        assert spark.table(name).count() == 31 and len(sinks.versions(spark, name)) == 1
    # The rows are written, the switch fails: the second write of a partitioned table used to fail here.
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **b: (_ for _ in ()).throw(RuntimeError("lost")) if q.startswith("CREATE OR") else sql(self, q, *a, **b))
    with pytest.raises(RuntimeError):
        sinks.publish(frame.limit(1), name, ["cls"])
    monkeypatch.undo()
    assert spark.table(name).count() == 31 and len(sinks.versions(spark, name)) == 1


def test_readers_find_the_table_at_every_moment(spark, frame, name):
    import threading

    sinks.publish(frame, name, ["cls"])
    seen, over = [], threading.Event()

    def read():
        while not over.is_set():
            try:
                seen.append(spark.table(name).count())
            except Exception as error:
                seen.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for _ in range(4):
        sinks.publish(frame, name, ["cls"])
    over.set()
    reader.join()
    assert seen and set(seen) == {31}
    assert len(sinks.versions(spark, name)) == 2
    sinks.publish(frame, f"{name}_other")
    try:
        assert len(sinks.versions(spark, name)) == 2
        assert [r[0] for r in sources.find_tables(spark, f"{name}*").collect()] == [name, f"{name}_other"]
    finally:
        sinks.unpublish(spark, f"{name}_other")


def test_a_plain_table_becomes_the_first_version(spark, frame, name):
    frame.write.saveAsTable(name)
    sinks.publish(spark.table(name).limit(3), name)
    assert spark.table(name).count() == 3 and len(sinks.versions(spark, name)) == 2
    sinks.unpublish(spark, name)
    assert not spark.catalog.tableExists(name) and sinks.versions(spark, name) == []


def test_rows_of_catalog_tables_without_a_scan(spark, frame, name, tmp_path):
    import io
    from contextlib import redirect_stdout

    sinks.publish(frame, name, ["cls"])
    registry = {"one": sources.TableEntry(name, None), "none": sources.TableEntry(f"{name}_missing", None)}
    status = sources.table_status(spark, "table", registry=registry)
    out = io.StringIO()
    with redirect_stdout(out):
        status.explain("simple")
    assert "FileScan" not in out.getvalue()
    assert sorted((r.clave, r.existe, r.filas, r.columnas) for r in status.collect()) == [("none", False, 0, 0), ("one", True, 31, 3)]
    # A table without statistics, and one whose statistics went with a write, are counted.
    plain = f"{name}_plain"
    try:
        frame.write.saveAsTable(plain)
        assert sources.stored_count(spark, plain) is None
        spark.sql(f"ANALYZE TABLE {plain} COMPUTE STATISTICS")
        assert sources.stored_count(spark, plain) == 31
        frame.write.insertInto(plain)
        assert sources.stored_count(spark, plain) in (None, 62)
        status = sources.table_status(spark, "table", registry={"p": sources.TableEntry(plain, None)})
        assert status.first()["filas"] == 62
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {plain}")


def test_buckets_by_sample_stay_small(spark, tmp_path):
    """A task sorts a bucket, so more rows give more buckets and not larger ones."""
    n = 1_200_000
    long = spark.range(n).selectExpr("string(id % 50000) AS sample_id", "string(id div 50000) AS gene_id_base", "id")
    stored = sinks.write_by_sample(long, f"small_buckets_{uuid.uuid4().hex}", str(tmp_path / "t"))
    per_bucket = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_bucket) == n
    assert max(per_bucket) < 600_000
