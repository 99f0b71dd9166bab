import os
import time

from pyspark.sql import functions as F

from foliomill.operators import retrieval
from foliomill.plans import incremental
from foliomill.plans.medallion import extracted_texts


def put(folder, name, text, mtime):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    os.utime(path, (mtime, mtime))


def texts(run):
    return {os.path.basename(r.path): r.extracted_text for r in run.current.collect()}


def test_runs_follow_new_and_rewritten_files(spark, tmp_path):
    folder, root = str(tmp_path / "files"), str(tmp_path / "lake")
    put(folder, "a/one.html", "<p>alpha beta alpha</p>", 1_700_000_000)
    put(folder, "a/two.html", "<b>gamma</b> delta", 1_700_000_000)
    put(folder, "a/skip.txt", "not a page", 1_700_000_000)
    first = incremental.refresh(spark, folder, root, 1)
    assert texts(first) == {"one.html": "alpha beta alpha", "two.html": "gamma delta"}
    assert first.history.count() == 2 and first.index.count() == 2
    assert {r.topic for r in first.gold.collect()} == {'{"topic":"alpha"}', '{"topic":"delta"}'}

    again = incremental.refresh(spark, folder, root, 2, previous_index=first.index_path)
    assert texts(again) == texts(first) and again.history.count() == 2

    put(folder, "a/two.html", "<b>omega</b>", 1_800_000_000)
    put(folder, "b/three.html", "<i>kappa</i>", 1_800_000_000)
    third = incremental.refresh(spark, folder, root, 3, previous_index=again.index_path)
    assert texts(third) == {"one.html": "alpha beta alpha", "two.html": "omega", "three.html": "kappa"}
    versions = [(r["__END_AT"] is None) for r in third.history.filter(F.col("path").endswith("two.html")).collect()]
    assert sorted(versions) == [False, True]
    rebuilt = retrieval.index_rows(
        third.gold.select(incremental.chunk_id("path", "chunk_ix").alias("chunk_id"), "chunked_text"), "chunk_id", "chunked_text"
    )
    assert sorted(map(tuple, third.index.collect())) == sorted(map(tuple, rebuilt.collect()))

    repeated = incremental.refresh(spark, folder, root, 3, previous_index=third.index_path)
    assert texts(repeated) == texts(third) and repeated.history.count() == 4


def test_bytes_that_are_no_text_stop_nothing(spark):
    rows = [("a.html", bytearray(b"<p>fine \xc3\xa9</p>")), ("b.html", bytearray(b"<p>\xe9</p>")), ("c.html", None)]
    texts = extracted_texts(spark.createDataFrame(rows, "path string, content binary"), ".html")
    assert {(r.path, r.extracted_text, r.readable) for r in texts.collect()} == {
        ("a.html", "fine é", True), ("b.html", "", False), ("c.html", "", False),
    }


def test_a_file_between_stream_and_listing_is_landed_once(spark, tmp_path, monkeypatch):
    """It is in the listing, but not yet known: the stream of the next run brings it."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.html").write_text("one")
    real = incremental.run_flow

    def flow_then_arrival(*args, **kwargs):
        real(*args, **kwargs)
        (folder / "b.html").write_text("two")

    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "cp")
    monkeypatch.setattr(incremental, "run_flow", flow_then_arrival)
    first = incremental.ingest_files(spark, str(folder), "*", bronze, checkpoint, 1)
    assert first.count() == 1
    monkeypatch.setattr(incremental, "run_flow", real)
    assert incremental.ingest_files(spark, str(folder), "*", bronze, checkpoint, 2).count() == 2


def test_old_files_that_arrive_late_are_landed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "new.html").write_text("new")
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "cp")
    incremental.ingest_files(spark, str(folder), "*", bronze, checkpoint, 1)
    (folder / "old.html").write_text("old")
    long_ago = time.time() - 90 * 86400
    os.utime(folder / "old.html", (long_ago, long_ago))
    assert incremental.ingest_files(spark, str(folder), "*", bronze, checkpoint, 2).count() == 2
