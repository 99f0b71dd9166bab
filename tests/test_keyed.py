import random

import pytest
from pyspark.sql import functions as F

from foliomill.operators import keyed, ranking

CHANGES = "k string, seq int, tie int, v string, _change_type string"


def feed(spark, rows, parts=1):
    return spark.createDataFrame(rows, CHANGES).repartition(parts)


def random_feed(seed, n=300, hot=0.4):
    rng = random.Random(seed)
    kinds = ["insert", "update_preimage", "update_postimage", "delete", "DELETE"]
    return [
        ("hot" if rng.random() < hot else f"k{rng.randrange(20)}", rng.randrange(80), i, f"v{i}", rng.choice(kinds))
        for i in range(n)
    ]


def plain_current(rows):
    last = {}
    for k, seq, tie, v, kind in rows:
        if kind != "update_preimage" and (seq, tie) >= last.get(k, ((-1, -1),))[0]:
            last[k] = ((seq, tie), v, kind)
    return {k: v for k, (_, v, kind) in last.items() if kind.lower() != "delete"}


def plain_history(rows):
    by_key = {}
    for k, seq, tie, v, kind in rows:
        if kind != "update_preimage":
            by_key.setdefault(k, []).append((seq, tie, v, kind))
    out = set()
    for k, versions in by_key.items():
        versions.sort()
        for at, (seq, _, v, kind) in enumerate(versions):
            if kind.lower() != "delete":
                out.add((k, v, seq, versions[at + 1][0] if at + 1 < len(versions) else None))
    return out


def current(df):
    return {r.k: r.v for r in keyed.current_rows(df, ["k"], ["seq", "tie"]).collect()}


def test_current_rows_cases(spark):
    rows = [
        ("a", 1, 1, "old", "insert"), ("a", 2, 2, "new", "update_postimage"), ("a", 3, 3, "pre", "update_preimage"),
        ("b", 5, 1, "kept", "insert"), ("b", 4, 2, None, "delete"),
        ("c", 1, 1, "x", "insert"), ("c", 2, 2, None, "DELETE"),
        ("d", 1, 1, "x", "delete"), ("d", 2, 2, "back", "insert"),
        ("e", 1, 1, "x", "insert"), ("e", 2, 2, None, "update_postimage"),
        ("f", 1, 1, "first", "insert"), ("f", 1, 2, "tied", "update_postimage"),
    ]
    assert current(feed(spark, rows)) == {"a": "new", "b": "kept", "d": "back", "e": None, "f": "tied"}
    assert current(feed(spark, [("z", 1, 1, "x", "insert")]).limit(0)) == {}


@pytest.mark.parametrize("seed", [1, 2])
def test_current_rows_ignore_arrival_order(spark, seed):
    rows = random_feed(seed)
    expected = plain_current(sorted(rows, key=lambda r: (r[1], r[2])))
    for parts in (1, 5):
        random.Random(seed).shuffle(rows)
        assert current(feed(spark, rows, parts)) == expected


@pytest.mark.parametrize("slices", [None, 1, 7, 40])
def test_history_is_the_same_in_any_number_of_slices(spark, slices):
    rows = random_feed(3)
    got = keyed.history_rows(feed(spark, rows, 3), ["k"], ["seq", "tie"], slices).collect()
    assert {(r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in got} == plain_history(rows)
    assert len(got) == len(plain_history(rows))


def test_history_of_a_stored_feed(spark, tmp_path):
    rows = random_feed(6)
    feed(spark, rows, 4).write.parquet(str(tmp_path / "feed"))
    stored = spark.read.parquet(str(tmp_path / "feed"))
    for slices in (1, 10, 100):
        got = keyed.history_rows(stored, ["k"], ["seq", "tie"], slices).collect()
        assert {(r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in got} == plain_history(rows)


def test_one_key_with_one_time_is_cut_by_the_whole_order(spark):
    """A bulk load: all rows of a key at one time. The ties alone order them, over several slices."""
    rows = [("k", 5, i, f"v{i}", "insert") for i in range(200)]
    got = keyed.history_rows(feed(spark, rows, 4), ["k"], ["seq", "tie"], 8).collect()
    assert {(r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in got} == plain_history(rows)


def test_open_history_is_the_current_table(spark):
    rows = random_feed(4)
    history = keyed.history_rows(feed(spark, rows), ["k"], ["seq", "tie"], 20)
    assert {r.k: r.v for r in history.filter("__END_AT IS NULL").collect()} == current(feed(spark, rows))


def test_change_feed_turns_old_into_new(spark):
    schema = "id int, t string, n int"
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (5, None, 5)], schema)
    new = spark.createDataFrame([(2, "b", None), (3, "C", 3), (4, "d", 4), (5, None, None)], schema)
    feed_rows = keyed.change_feed(old, new, ["id"], 7)
    kinds = sorted((r.id, r._change_type, r.t) for r in feed_rows.collect() if r.id != 5)
    assert kinds == [(1, "delete", "a"), (3, "update_postimage", "C"), (3, "update_preimage", "c"), (4, "insert", "d")]
    assert {r._commit_version for r in feed_rows.collect()} == {7}
    after = keyed.apply_feed(old, feed_rows, ["id"])
    assert sorted(after.select("id", "t", "n").collect()) == sorted(new.collect())


def test_key_violations_and_quarantine(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, None)], "x int, y string")
    row = keyed.key_violations(df, ["x", "y"], "r").first()
    assert (row.n_rows, row.n_null_rows, row.n_repeated_keys, row.n_repeated_rows) == (5, 2, 1, 2)
    good, bad = keyed.quarantine(df, ["x", "y"])
    assert (good.count(), bad.count()) == (3, 2)
    empty = keyed.key_violations(df.limit(0), ["x"], "r").first()
    assert (empty.n_rows, empty.n_repeated_keys) == (0, 0)


def test_merge_records(spark):
    schema = "h string, id int, expected string"
    existing = spark.createDataFrame([("a", 1, "keep"), ("b", 2, "old"), ("c", 3, "only")], schema)
    incoming = spark.createDataFrame([("a", 9, None), ("b", 8, "new"), ("b", 7, "newish"), ("d", 6, "fresh")], schema)
    merged = keyed.merge_records(existing, incoming, ["h"], ["id"], ["expected"])
    assert {tuple(r) for r in merged.collect()} == {
        ("a", 9, "keep", "incoming"), ("b", 8, "new", "incoming"), ("c", 3, "only", "existing"), ("d", 6, "fresh", "incoming"),
    }


def test_identity_ids_are_dense_and_repeatable(spark):
    df = spark.range(2000).select(F.col("id").alias("k"))
    once = {r.k: r.id for r in ranking.identity_ids(df.repartition(7), ["k"], 50).collect()}
    again = {r.k: r.id for r in ranking.identity_ids(df.repartition(3), ["k"], 50, "id").collect()}
    assert once == again
    assert sorted(once.values()) == list(range(51, 2051))
    assert ranking.last_used_id(spark.createDataFrame([(7,), (9,)], "id bigint")) == 9
    assert ranking.last_used_id(spark.range(0)) == 0


@pytest.mark.parametrize("n", [0, 3, 10, 25])
def test_allocation_spends_every_question(spark, n):
    got = [r.n_questions for r in ranking.allocate_questions(spark.range(10), "id", n).collect()]
    assert sum(got) == n and len(got) == 10 and max(got) - min(got) <= 1


def test_repeated_keys_stop_a_change_feed(spark):
    old = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id int, t string")
    new = spark.createDataFrame([(1, "y"), (2, "z")], "id int, t string")
    for before, after in ((old, new), (new, old)):
        with pytest.raises(Exception, match="more than once"):
            keyed.change_feed(before, after, ["id"], 1).collect()


def test_broken_keys_stop_the_job(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    keyed.require_keys(keyed.key_violations(df.distinct(), ["x"], "fine"))
    with pytest.raises(ValueError, match="bad"):
        keyed.require_keys(keyed.key_violations(df, ["x"], "bad"))


def plain_patch(rows):
    out = {}
    for k, ts, n, v, kind in sorted(rows, key=lambda r: (r[1], r[2])):
        kind = kind.lower()
        if kind == "delete":
            out.pop(k, None)
        elif kind != "update_preimage":
            out[k] = (k, ts, n, v if v is not None else out.get(k, (None,) * 4)[3])
    return sorted(out.values())


@pytest.mark.parametrize("seed", range(4))
def test_patched_rows(spark, seed):
    rng = random.Random(seed)
    kinds = ["insert", "update_postimage", "Delete", "update_preimage"]
    rows = [(rng.choice("aaabcd"), rng.randrange(20), i, rng.choice([None, None, "x", "y", "z"]), rng.choices(kinds, [2, 4, 1, 1])[0]) for i in range(120)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, ts int, n int, v string, _change_type string").repartition(5)
    got = keyed.patched_rows(df, ["k"], ["ts", "n"])
    assert got.columns == ["k", "ts", "n", "v"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == plain_patch(rows)
    assert "partial_max_by" in plan and plan.count("Exchange hashpartitioning") == 1
    assert keyed.patched_rows(df.filter("false"), ["k"], ["ts", "n"]).count() == 0
