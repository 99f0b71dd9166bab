"""Tables kept up to date batch by batch, against rebuilding them."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliomill.operators import keyed, refresh
from foliomill.plans import medallion, updates
from foliomill.sources.buckets import BucketTable, read_if_there
from foliomill.streaming import history

SHAPE = "path string, extracted_text string, version bigint, _change_type string"


def batch(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(n)) + "\n\n" + "tail " * (n // 4)


@pytest.fixture(scope="module")
def batches(spark):
    one = [(f"d{i}", text(i), 1, "insert") for i in range(30)]
    two = [("d1", text(1)[:150], 2, "update_postimage"), ("d2", None, 2, "delete"), ("d30", text(30), 2, "insert"), ("d3", text(3), 2, "update_postimage"),
           ("d4", "before", 2, "update_preimage"), ("d5", "   ", 2, "update_postimage"), ("d6", None, 2, "update_postimage"), (None, text(40), 2, "insert")]
    three = [("d2", text(2), 3, "INSERT"), ("d7", None, 3, "Delete"), ("d8", text(8) + " more", 3, "update_postimage"), ("gone", None, 3, "delete")]
    return [batch(spark, rows) for rows in (one, two, three)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rebuilt(batches, splitter):
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2]).filter("path IS NOT NULL")
    return updates.cut(keyed.current_rows(whole, ["path"], ["version"]), splitter)


@pytest.mark.parametrize("splitter", [medallion.incremental_splitter, medallion.batch_splitter])
def test_refresh_equals_a_rebuild(spark, batches, tmp_path, splitter):
    tables = updates.refresh_all(spark, batches, str(tmp_path), "index", splitter)
    want = rebuilt(batches, splitter)
    gold = tables["gold"]
    assert rows_of(gold.read(spark)) == rows_of(want.select(*gold.schema.names))
    index = tables["index"].read(spark).select("chunk_id", "text_hash")
    assert rows_of(index) == rows_of(want.select(F.md5(F.concat_ws("#", "path", "chunk_ix")), F.md5("chunked_text")))
    assert tables["index"].read(spark).filter("embedding IS NULL").count() == 0


def test_only_changed_documents_are_derived_again(spark, batches, tmp_path):
    tables = updates._tables(str(tmp_path))
    seen = []
    for version, rows in enumerate(batches, 1):
        buckets = refresh.refresh_current(tables["current"], rows, ["version"], version)
        delta = refresh.document_delta(tables["current"], spark, buckets, version, "extracted_text")
        seen.append({r.path: r.action for r in delta.collect()})
        delta.write.parquet(str(tmp_path / f"delta{version}"))
        delta = spark.read.parquet(str(tmp_path / f"delta{version}"))
        cut = []
        refresh.refresh_derived(tables["gold"], tables["current"], delta, version, lambda t: cut.append(sorted(r.path for r in t.collect())) or updates.cut(t))
        assert cut == [sorted(p for p, a in seen[-1].items() if a != "delete")]
    assert len(seen[0]) == 30
    assert seen[1] == {"d1": "update", "d2": "delete", "d30": "insert", "d5": "update", "d6": "update"}
    assert seen[2] == {"d2": "insert", "d7": "delete", "d8": "update"}


def test_stored_vectors_are_kept(spark, batches, tmp_path):
    """A chunk whose text did not change keeps its vector, even where its document did."""
    tables = updates.refresh_all(spark, batches[:1], str(tmp_path), "index")
    index, gold = tables["index"], tables["gold"]
    marked = index.read(spark).withColumn("embedding", F.array(F.lit(-1.0)))
    index.replace(marked, list(range(updates.BUCKETS)), 1)
    longer = batch(spark, [("d8", text(8) + " more", 2, "update_postimage")])
    buckets = refresh.refresh_current(tables["current"], longer, ["version"], 2)
    delta = refresh.document_delta(tables["current"], spark, buckets, 2, "extracted_text")
    refresh.refresh_derived(gold, tables["current"], delta, 2, updates.cut)
    refresh.refresh_index(index, gold, delta, 2, "chunked_text")
    fresh = index.read(spark).filter(F.element_at("embedding", 1) != -1.0)
    assert fresh.select("path").distinct().collect()[0].path == "d8" and 0 < fresh.count() < index.read(spark).filter("path = 'd8'").count()


def test_late_changes_do_not_revive_a_key(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("path",), batch(spark, []).schema, 4)
    for version, rows in enumerate([[("a", "x", 5, "insert")], [("a", None, 9, "delete")], [("a", "late", 7, "update_postimage")]], 1):
        refresh.refresh_current(table, batch(spark, rows), ["version"], version)
    assert refresh.live(table.read(spark)).count() == 0 and table.read(spark).first().version == 9


# --- buckets


def bucket_table(spark, tmp_path, n=8):
    return BucketTable(str(tmp_path / "t"), ("k",), StructType.fromDDL("k bigint, v string"), n)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string")


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    table = bucket_table(spark, tmp_path)
    table.replace(frame(spark, [(i, "one") for i in range(100)]), list(range(8)), 1)
    change = frame(spark, [(3, "two")])
    buckets = table.touched(change)
    assert len(buckets) == 1
    files = table.read(spark, buckets).inputFiles()
    assert files and all(f"_bucket={buckets[0]}/" in f for f in files)
    table.replace(table.read(spark, buckets).filter("k <> 3").unionByName(change), buckets, 2)
    held = table.manifest(spark)
    assert {b for b, v in held.items() if v == 2} == set(buckets) and len(held) == 8
    assert rows_of(table.read(spark)) == rows_of(frame(spark, [(i, "two" if i == 3 else "one") for i in range(100)]))
    assert table.read(spark, before=2).filter("v = 'two'").count() == 0  # the version before stays readable


def test_a_lost_write_leaves_the_old_state(spark, tmp_path):
    table = bucket_table(spark, tmp_path)
    table.replace(frame(spark, [(1, "one"), (2, "one")]), list(range(8)), 1)
    # data of a version that never got its manifest
    frame(spark, [(1, "half")]).withColumn("_bucket", table.bucket()).write.partitionBy("_bucket").parquet(f"{table.root}/data/version=2")
    assert rows_of(table.read(spark)) == [(1, "one"), (2, "one")]
    for _ in range(2):  # the version runs again, and once more
        table.replace(frame(spark, [(1, "two")]), table.touched(frame(spark, [(1, "")])), 2)
        assert rows_of(table.read(spark)) == [(1, "two"), (2, "one")]


def test_emptied_buckets_and_tables(spark, tmp_path):
    table = bucket_table(spark, tmp_path, 2)
    assert table.read(spark).count() == 0 and table.manifest(spark) == {}
    table.replace(frame(spark, [(1, "a"), (None, "b")]), [0, 1], 1)
    table.replace(frame(spark, []), [0, 1], 2)
    assert table.read(spark).count() == 0 and table.read(spark, before=2).count() == 2
    with pytest.raises(ValueError, match="not read"):
        table.replace(frame(spark, [(i, "x") for i in range(20)]), [0], 3)
    assert read_if_there(spark, "a int", str(tmp_path / "none")).count() == 0


# --- history


CHANGE = "k string, ts int, id int, v string, _change_type string"


def changes(seed, n=150):
    rng = random.Random(seed)
    kinds = ["insert", "update_postimage", "delete", "update_preimage"]
    keys = ["hot"] * 6 + list("abcde")
    return [(rng.choice(keys), rng.randrange(40), i, rng.choice([None, "x", "y"]), rng.choices(kinds, [3, 4, 2, 1])[0]) for i in range(n)]


@pytest.mark.parametrize("seed,slices", [(1, None), (2, 5)])
def test_history_of_batches_with_late_rows(spark, tmp_path, seed, slices):
    rows = changes(seed)
    random.Random(seed).shuffle(rows)
    for number in range(5):
        part = spark.createDataFrame(rows[number * 30 : number * 30 + 30], CHANGE)
        for _ in range(1 + (number == 2)):  # one batch runs twice
            history.apply_batch(part, number, str(tmp_path / "h"), ["k"], ["ts", "id"], 4, slices)
        so_far = spark.createDataFrame(rows[: number * 30 + 30], CHANGE)
        got = history.read_history(so_far, str(tmp_path / "h"), ["k"], ["ts", "id"])
        want = keyed.history_rows(so_far, ["k"], ["ts", "id"])
        assert rows_of(got.select(*want.columns)) == rows_of(want)


def test_batches_in_order_never_read_the_log(spark, tmp_path, monkeypatch):
    rows = sorted(changes(3), key=lambda r: (r[1], r[2]))
    monkeypatch.setattr(history, "_resolved", lambda log, *a: _only_empty(log))
    for number in range(3):
        history.apply_batch(spark.createDataFrame(rows[number * 50 : number * 50 + 50], CHANGE), number, str(tmp_path / "h"), ["k"], ["ts", "id"], 4)
    monkeypatch.undo()
    whole = spark.createDataFrame(rows, CHANGE)
    got = history.read_history(whole, str(tmp_path / "h"), ["k"], ["ts", "id"])
    want = keyed.history_rows(whole, ["k"], ["ts", "id"])
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def _only_empty(log):
    assert log.count() == 0
    return log.drop("batch_id", "_bucket")


def test_a_change_delivered_again_takes_its_place(spark, tmp_path):
    one = [("a", 1, 1, "x", "insert"), ("a", 5, 2, "y", "update_postimage")]
    for number, rows in enumerate([one, [("a", 1, 1, "z", "insert")], []]):
        history.apply_batch(spark.createDataFrame(rows, CHANGE), number, str(tmp_path / "h"), ["k"], ["ts", "id"], 4)
    got = history.read_history(spark.createDataFrame([], CHANGE), str(tmp_path / "h"), ["k"], ["ts", "id"])
    assert rows_of(got.select("ts", "v", "__START_AT", "__END_AT")) == [(1, "z", 1, 5), (5, "y", 5, None)]


def test_changes_are_stored_once(spark, tmp_path):
    """Neither the log nor the open intervals repeat what a change holds."""
    rng = random.Random(4)
    rows = [(f"k{i % 60}", i, i, "%0400x" % rng.getrandbits(1600), "update_postimage") for i in range(600)]
    size = lambda folder: sum(p.stat().st_size for p in (tmp_path / folder).rglob("*.parquet"))
    for number in range(3):
        part = spark.createDataFrame(rows[number * 200 : number * 200 + 200], CHANGE).coalesce(1)
        part.write.parquet(str(tmp_path / f"plain/{number}"))
        history.apply_batch(part, number, str(tmp_path / "h"), ["k"], ["ts", "id"], 1)
    assert size("h") < 1.6 * size("plain")
    got = history.read_history(part, str(tmp_path / "h"), ["k"], ["ts", "id"])
    assert rows_of(got) == rows_of(keyed.history_rows(spark.createDataFrame(rows, CHANGE), ["k"], ["ts", "id"]).select(*got.columns))
