"""Tables that append the rows of changed keys, and the documents kept in them."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliomill.operators import keyed, refresh
from foliomill.plans import updates
from foliomill.sources import parts
from foliomill.sources.parts import PartTable

SHAPE = "path string, extracted_text string, version bigint, _change_type string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def part_table(tmp_path, n=4):
    return PartTable(str(tmp_path / "t"), ("k",), StructType.fromDDL("k bigint, v string"), n)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string")


def put(spark, table, rows, version):
    """Rows in place of those that their keys have."""
    new = frame(spark, rows)
    table.append(new.repartition(table.n_buckets, "k"), new.select("k"), version, table.n_buckets)


def test_a_batch_over_all_buckets_writes_what_it_changes(spark, tmp_path):
    """Changed documents in every bucket do not make the tables be written again."""
    rng = random.Random(5)
    text = lambda: " ".join("%06x" % rng.getrandbits(24) for _ in range(150))
    one = [(f"d{i}", text(), 1, "insert") for i in range(300)]
    two = [(f"d{i}", text(), 2, "update_postimage") for i in range(30)]
    size = lambda: sum(p.stat().st_size for p in tmp_path.rglob("data/**/*.parquet"))
    batches = [spark.createDataFrame(rows, SHAPE) for rows in (one, two)]
    updates.refresh_all(spark, batches[:1], str(tmp_path), "index")
    first = size()
    tables = updates._tables(str(tmp_path))
    buckets = refresh.refresh_current(tables["current"], batches[1], ["version"], 2)
    assert len(buckets) > updates.BUCKETS // 2
    delta = refresh.document_delta(tables["current"], spark, buckets, 2, "extracted_text")
    delta.write.parquet(str(tmp_path / "delta2"))
    delta = spark.read.parquet(str(tmp_path / "delta2"))
    refresh.refresh_derived(tables["gold"], tables["current"], delta, 2, updates.cut)
    refresh.refresh_index(tables["index"], tables["gold"], delta, 2, "chunked_text")
    assert size() < 1.5 * first  # 16 files a table and version have a fixed cost
    want = updates.cut(spark.createDataFrame(one[30:] + two, SHAPE).drop("version", "_change_type"))
    assert rows_of(tables["gold"].read(spark)) == rows_of(want.select(*tables["gold"].schema.names))
    assert rows_of(tables["index"].read(spark).select("chunk_id", "text_hash")) == rows_of(want.select("chunk_id", F.md5("chunked_text")))


def test_stored_rows_are_not_shuffled_when_read(spark, tmp_path):
    table = part_table(tmp_path)
    put(spark, table, [(i, "one") for i in range(40)], 1)
    put(spark, table, [(i, "two") for i in range(0, 40, 3)], 2)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for found in (table.read(spark), table.read(spark, only=frame(spark, [(1, ""), (3, "")]))):
            plan = found._jdf.queryExecution().executedPlan().toString()
            at = lambda line: len(line) - len(line.lstrip(" :+-"))
            lines = plan.splitlines()
            for i, line in enumerate(lines):
                if "Exchange" in line:
                    below = [x for x in lines[i + 1 :] if x.strip()]
                    inside = below[: next((j for j, x in enumerate(below) if at(x) <= at(line)), len(below))]
                    assert not any("/data/" in x for x in inside), plan
        assert rows_of(table.read(spark)) == rows_of(frame(spark, [(i, "one" if i % 3 else "two") for i in range(40)]))
        assert rows_of(found) == [(1, "one"), (3, "two")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_versions_repeat_fold_and_outlive_a_session(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "FOLD_AFTER", 2)
    table, state, states = part_table(tmp_path), {}, {}
    assert table.read(spark).count() == 0 and table.added(spark, 1).count() == 0
    for version in range(1, 6):
        new = [(i, f"{version}") for i in range(version, 20, version)]
        for _ in range(1 + (version == 3)):  # one version runs twice
            put(spark, table, new, version)
        state |= dict(new)
        states[version] = rows_of(frame(spark, list(state.items())))
        assert rows_of(table.read(spark)) == states[version]
        assert rows_of(table.added(spark, version)) == rows_of(frame(spark, new))
    assert len(table.parts(spark)) == 2
    lines = spark.read.parquet(f"{table.root}/parts/version=4")  # folding leaves the line of the version
    assert sorted(r.whole for r in lines.collect()) == [False, True]
    assert rows_of(table.read(spark, before=5)) == states[4] and rows_of(table.read(spark, before=2)) == states[1]
    for _, name, _ in table.parts(spark):  # external tables: the files stay
        spark.sql(f"DROP TABLE {name}")
    assert rows_of(table.read(spark)) == states[5]
    # data of a version that never got its line
    frame(spark, [(1, "half")]).write.parquet(f"{table.root}/data/part_lost")
    assert rows_of(table.read(spark)) == states[5]


def test_replaced_buckets(spark, tmp_path):
    table = part_table(tmp_path)
    put(spark, table, [(i, "one") for i in range(40)], 1)
    some = table.touched(frame(spark, [(3, "")]))
    old = table.read(spark, some)
    kept = old.count()
    table.replace(old.filter("k <> 3"), some, 2)
    assert rows_of(table.read(spark)) == rows_of(frame(spark, [(i, "one") for i in range(40) if i != 3])) and 0 < kept < 40
    table.replace(table.read(spark).withColumn("v", F.lit("two")), list(range(4)), 2)  # over itself
    assert rows_of(table.read(spark)) == rows_of(frame(spark, [(i, "two") for i in range(40) if i != 3]))
    with pytest.raises(ValueError, match="not read"):
        table.replace(frame(spark, [(i, "x") for i in range(40)]), some, 3)


def test_current_rows_with_late_and_repeated_changes(spark, tmp_path):
    rng = random.Random(8)
    table = PartTable(str(tmp_path / "t"), ("path",), StructType.fromDDL(SHAPE), 4)
    kinds = ["insert", "update_postimage", "delete", "update_preimage"]
    order = rng.sample(range(120), 120)
    rows = [(rng.choice(["hot", "a", "b", "c", None]), rng.choice([None, "x", "y"]), at, rng.choice(kinds)) for at in order]
    for version in range(1, 5):
        batch = spark.createDataFrame(rows[version * 30 - 30 : version * 30], SHAPE)
        for _ in range(1 + (version == 2)):
            refresh.refresh_current(table, batch, ["version"], version)
        whole = spark.createDataFrame(rows[: version * 30], SHAPE).filter("path IS NOT NULL")
        want = keyed.current_rows(whole, ["path"], ["version"])
        assert rows_of(refresh.live(table.read(spark)).select(*want.columns)) == rows_of(want)
    assert refresh.refresh_current(table, spark.createDataFrame([], SHAPE), ["version"], 5) == []
    assert rows_of(refresh.live(table.read(spark)).select(*want.columns)) == rows_of(want)
