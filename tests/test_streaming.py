import os
import random

import pytest
from pyspark.sql import functions as F
from test_keyed import CHANGES, current, feed, random_feed

from foliomill import session
from foliomill.plans import medallion
from foliomill.sources import files, tables
from foliomill.streaming import changes, ingest

KEYS, ORDER = ["k"], ["seq", "tie"]


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(data)


@pytest.fixture
def folder(tmp_path):
    root = str(tmp_path / "files")
    put(root, "Team A/First Doc.pdf", b"one\ntwo words")
    put(root, "Team A/deep/second.pdf", b"three")
    put(root, "Team A/image.png", b"\x89")
    return root


def test_scan_selects_by_glob_and_skips_bytes(spark, folder):
    found = files.scan_binary(spark, folder, "*.pdf")
    names = {(os.path.basename(r.input_file).replace("%20", " "), r.length) for r in found.collect()}
    assert names == {("First Doc.pdf", 13), ("second.pdf", 5)}
    plan = found.select("input_file", "length")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_ingest_delivers_each_file_once(spark, folder, tmp_path):
    target, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def drain():
        return ingest.drain_to_table(files.stream_binary(spark, folder, "*.pdf"), target, checkpoint)

    assert drain().count() == 2
    assert drain().count() == 2
    put(folder, "Team B/third.pdf", b"x")
    put(folder, "Team B/other.txt", b"x")
    bronze = drain()
    assert bronze.count() == 3
    assert bronze.filter("processing_time IS NULL OR content IS NULL").count() == 0


def test_rewritten_files_come_in_by_batch(spark, folder):
    known = files.scan_binary(spark, folder, "*.pdf").withColumnRenamed("input_file", "path")
    known = spark.createDataFrame(known.select("path", "modificationTime").collect(), "path string, modificationTime timestamp")
    changed = os.path.join(folder, "Team A/deep/second.pdf")
    put(folder, "Team A/deep/second.pdf", b"three, revised")
    os.utime(changed, (2_000_000_000, 2_000_000_000))
    put(folder, "Team B/new.pdf", b"n")
    listing = files.scan_binary(spark, folder, "*.pdf").withColumnRenamed("input_file", "path").select("path", "modificationTime")
    assert {os.path.basename(r.path) for r in files.changed_files(listing, known).collect()} == {"second.pdf", "new.pdf"}


def test_layers_from_files(spark, folder, tmp_path):
    layers = medallion.Layers(*[str(tmp_path / name) for name in ("bronze", "silver", "gold")])
    source = files.scan_binary(spark, folder, "*.pdf").withColumn("input_file", F.url_decode("input_file"))
    gold = medallion.build_layers(source, layers, "pdf")
    rows = gold.collect()
    got = {(r.document_name, r.page_nr, r.content_chunk) for r in rows}
    assert got == {("team_a/first_doc", "0", "one"), ("team_a/first_doc", "1", "two words"), ("deep/second", "0", "three")}
    again = medallion.build_layers(source, layers, "pdf")
    assert {r.chunk_id for r in again.collect()} == {r.chunk_id for r in rows}
    assert again.select("chunk_id").distinct().count() == 3


def test_stored_schema_is_kept(spark, tmp_path):
    location, sample = str(tmp_path / "schema"), str(tmp_path / "sample")
    spark.range(3).selectExpr("id", "'x' AS t").write.parquet(sample)
    first = files.stored_schema(spark, location, sample)
    spark.range(3).selectExpr("id", "'x' AS t", "1 AS extra").write.mode("overwrite").parquet(sample)
    assert files.stored_schema(spark, location, sample) == first
    assert first.names == ["id", "t"]


def test_flows_share_a_target_and_a_repeated_batch_replaces_itself(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).write.parquet(source)
    stream = spark.readStream.schema("id bigint").parquet(source)
    for name, part in (("even", stream.filter("id % 2 = 0")), ("odd", stream.filter("id % 2 = 1"))):
        ingest.run_flow(part, target, name, str(tmp_path / f"cp-{name}"))
    ingest.run_flow(stream.filter("id % 2 = 0"), target, "even", str(tmp_path / "cp-lost"))
    rows = ingest.flow_rows(stream, target).collect()
    assert sorted((r.id, r.flow) for r in rows) == [(i, "odd" if i % 2 else "even") for i in range(10)]


@pytest.mark.parametrize("seed", [11, 12])
def test_changes_by_stream_equal_changes_by_batch(spark, tmp_path, seed):
    rows = random_feed(seed, 240)
    random.Random(seed).shuffle(rows)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "changes", "cp"))
    feed(spark, rows, 1).limit(0).write.parquet(source)
    stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(source)
    seen = []
    for part in range(4):
        seen += rows[part * 60 : part * 60 + 60]
        feed(spark, rows[part * 60 : part * 60 + 60], 2).write.mode("append").parquet(source)
        changes.ingest_changes(stream, target, checkpoint, KEYS, ORDER)
        got = {r.k: r.v for r in changes.read_current(stream, target, KEYS, ORDER).collect()}
        assert got == current(feed(spark, seen))
        if part == 1:
            base = str(tmp_path / "base1")
            changes.fold_changes(stream, target, base, KEYS, ORDER)
    folded = changes.read_current(stream, target, KEYS, ORDER, base)
    assert {r.k: r.v for r in folded.collect()} == current(feed(spark, rows))
    base2 = str(tmp_path / "base2")
    changes.fold_changes(stream, target, base2, KEYS, ORDER, base)
    assert {r.k: r.v for r in changes.read_current(stream, target, KEYS, ORDER, base2).collect()} == current(feed(spark, rows))
    changes.ingest_changes(stream, target, checkpoint, KEYS, ORDER)
    assert {r.k: r.v for r in changes.read_current(stream, target, KEYS, ORDER, base2).collect()} == current(feed(spark, rows))


def test_snapshot_and_typed_overwrite(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "cast(id AS string) AS t")
    snap = tables.snapshot_table(df, "snap_test", str(tmp_path / "snap"))
    assert snap.count() == 3
    again = tables.overwrite_table(df, str(tmp_path / "typed"), "t string, id int")
    assert again.dtypes == [("t", "string"), ("id", "int")]
    saved = tables.save_table(df.limit(2), "save_test", str(tmp_path / "saved"), "id bigint")
    assert saved.columns == ["id"] and saved.count() == 2


def test_scratch_folder_follows_the_session(spark):
    root = session.shared_root(spark)
    assert session.fresh_path(spark, "x").startswith(root + "/x-")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


class StubSession:
    """The parts of a session that the folder rule looks at."""

    def __init__(self, setting, master):
        self.conf = self.sparkContext = self
        self.setting, self.master, self.applicationId = setting, master, f"app-{master}"

    def get(self, key, default=None):
        return self.setting

    def getConf(self):
        return self


def test_scratch_folder_rule():
    assert session.shared_root(StubSession("/shared/place/", "spark://x")) == "/shared/place"
    with pytest.raises(ValueError, match="shared"):
        session.shared_root(StubSession(None, "spark://x"))
    local = session.shared_root(StubSession(None, "local[2]"))
    assert os.path.isdir(local) and session.shared_root(StubSession(None, "local[2]")) == local
