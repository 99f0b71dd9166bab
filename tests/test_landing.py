"""Answers kept by request, parsing with quarantine, writes under rules, streams with changing columns."""

import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliomill.operators import answers, parse
from foliomill.sources import checked
from foliomill.streaming import evolving


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- answers


def counting(spark, fail_on=None, silent=()):
    calls = spark.sparkContext.accumulator(0)

    def model(requests: pd.Series) -> pd.Series:
        if fail_on is not None and requests.isin([fail_on]).any():
            raise RuntimeError("the model is down")
        calls.add(len(requests))
        return requests.map(lambda r: None if r in silent else r.upper())

    return model, calls


def asked(spark, requests):
    return spark.createDataFrame([(i, r) for i, r in enumerate(requests)], "id int, q string").repartition(3)


def test_each_request_is_sent_once(spark, tmp_path):
    model, calls = counting(spark)
    requests = ["a", "b", "a", None, "", "c", "a"] * 20
    got = answers.infer_once(asked(spark, requests), F.col("q"), str(tmp_path), model, 1, part_rows=2)
    assert rows_of(got) == rows_of(spark.createDataFrame([(i, r, None if r is None else r.upper(), None if r is None else 1) for i, r in enumerate(requests)], "id int, q string, answer string, run long"))
    assert got.columns == ["id", "q", "answer", "run"] and calls.value == 4
    again = answers.infer_once(asked(spark, ["c", "d", "d"]), F.col("q"), str(tmp_path), model, 2)
    assert {(r.q, r.answer, r.run) for r in again.collect()} == {("c", "C", 1), ("d", "D", 2)}
    again.collect()
    assert calls.value == 5  # reading the result calls nothing


def test_a_failure_keeps_the_answers_before_it(spark, tmp_path):
    requests = [f"q{i}" for i in range(40)]
    model, calls = counting(spark, fail_on="q17")
    with pytest.raises(Exception, match="the model is down"):
        answers.ask_missing(asked(spark, requests).select(F.col("q").alias("request")), str(tmp_path), model, 1, part_rows=4)
    landed = answers.answers(spark, str(tmp_path)).count()
    model, calls = counting(spark)
    sent = answers.ask_missing(asked(spark, requests).select(F.col("q").alias("request")), str(tmp_path), model, 2, part_rows=4)
    assert sent == calls.value == 40 - landed and answers.answers(spark, str(tmp_path)).count() == 40


def test_requests_without_an_answer_are_sent_again(spark, tmp_path):
    model, calls = counting(spark, silent=("b",))
    df = asked(spark, ["a", "b"])
    assert {(r.q, r.answer) for r in answers.infer_once(df, F.col("q"), str(tmp_path), model, 1).collect()} == {("a", "A"), ("b", None)}
    model, calls = counting(spark)
    assert {(r.q, r.answer, r.run) for r in answers.infer_once(df, F.col("q"), str(tmp_path), model, 2).collect()} == {("a", "A", 1), ("b", "B", 2)}
    assert calls.value == 1
    with pytest.raises(Exception, match="answers to"):
        answers.infer_once(asked(spark, ["x", "y"]), F.col("q"), str(tmp_path), lambda r: r[:1], 3, part_rows=10).collect()


# --- parsing


def test_html_pages():
    page = b"<html><style>p{x:1}</style><H1 id=a>One</h1> two\n\n three<br>four<!-- <h1> -->five<script>if (a<b) '</p>'</SCRIPT ><h1></h1><h1>  </h1>six &amp; \xc3\xa9"
    assert parse.html_pages(page) == ["One two three four five", "six &amp; é"]
    assert parse.html_pages(b"") == parse.html_pages(b" <p> </p> ") == []
    assert parse.html_pages(b"plain") == ["plain"]
    for bad, message in ((b"a\xff", "no UTF-8 at byte 1"), (b"a <p class", "a tag is not closed"), (b"<script>x", "script is not closed")):
        with pytest.raises(ValueError, match=message):
            parse.html_pages(bad)


def test_scanner_agrees_with_the_expressions(spark, sf_dir):
    from foliomill.functions.text import html_text

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("html", html_text(F.col("html")).alias("text")).collect()
    assert len(rows) > 20
    for r in rows:
        assert re.sub("[ \t\r\n]+", " ", " ".join(parse.html_pages(r.html.encode()))).strip() == r.text


@pytest.mark.parametrize("out_bytes", [1, 1 << 20])
def test_files_are_parsed_once_into_two_tables(spark, tmp_path, monkeypatch, out_bytes):
    monkeypatch.setattr(parse, "OUT_BYTES", out_bytes)
    parsed = spark.sparkContext.accumulator(0)

    def parser(content: bytes) -> list[str]:
        parsed.add(1)
        return parse.html_pages(content)

    files = [(1, b"<h1>a<h1>b"), (2, b"\xff"), (3, None), (4, b""), (None, b"<p"), (5, b"x" * 5000), (1, b"<h1>a<h1>b")]
    df = spark.createDataFrame([(i, c, "clash") for i, c in files], "key int, content binary, error string").repartition(2)
    pages, errors = parse.parse_files(df, parser, "key", "content", str(tmp_path / "t"))
    assert rows_of(pages) == rows_of(spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 0, "a"), (1, 1, "b"), (5, 0, "x" * 5000)], "k int, n int, c string"))
    assert rows_of(errors) == sorted([(2, 1, "ValueError: no UTF-8 at byte 0"), (3, None, "no content"), (None, 2, "ValueError: a tag is not closed at character 0")], key=repr)
    assert parsed.value == 6
    none, failed = parse.parse_files(df.filter("false"), parser, "key", "content", str(tmp_path / "none"))
    assert none.count() == failed.count() == 0


# --- writes under rules


def read_once(spark, df):
    """``df`` through a step that counts the rows it is read for."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


@pytest.mark.parametrize("salts", [1, 4])
def test_write_checked(spark, tmp_path, salts):
    rows = [(i, "hot" if i % 3 else f"k{i % 5}", None if i % 7 == 0 else i % 4) for i in range(200)]
    rows += [(500, None, 1), (501, None, 1), (502, "hot", None)]
    df, seen = read_once(spark, spark.createDataFrame(rows, "id int, k string, v int").repartition(5))
    rules = {"v is there": F.col("v").isNotNull(), "v is small": F.col("v") < 3}
    found = checked.write_checked(df, str(tmp_path / "t"), rules, ["k"], ["id"], salts)
    good, bad, first = [], [], set()
    for i, k, v in sorted(rows):
        problems = ([] if v is not None else ["v is there"]) + ([] if v is not None and v < 3 else ["v is small"])
        if not problems and k is not None and k in first:
            problems = [checked.REPEATED]
        elif not problems:
            first.add(k)
        (bad if problems else good).append((i, k, v, problems) if problems else (i, k, v))
    assert rows_of(found.good) == sorted(good, key=repr) and rows_of(found.bad) == sorted(bad, key=repr)
    assert found.counts == {
        "rows": 203, "good": len(good), "v is there": sum("v is there" in r[3] for r in bad),
        "v is small": sum("v is small" in r[3] for r in bad), checked.REPEATED: sum(checked.REPEATED in r[3] for r in bad),
    }
    assert seen.value == 203


def test_write_checked_without_keys_or_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, t string")
    found = checked.write_checked(df, str(tmp_path / "a"), {"t": F.col("t").isNotNull()})
    assert rows_of(found.good) == [(2, "x")] and rows_of(found.bad) == [(1, None, ["t"])] and found.counts == {"rows": 2, "good": 1, "t": 1}
    none = checked.write_checked(df.filter("false"), str(tmp_path / "b"), {"t": F.col("t").isNotNull()}, ["id"], ["id"])
    assert none.good.count() == none.bad.count() == 0 and none.counts == {"rows": 0, "good": 0, "t": 0, checked.REPEATED: 0}


# --- changing columns


def lines(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_columns_come_and_misfits_are_kept(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "t")
    lines(folder, "one", [{"a": 1, "b": "x"}, {"a": 2, "b": None}, "no json", "[1]"])
    evolving.ingest_lines(spark, str(folder), target)
    assert evolving.columns(spark, target) == {"a": "bigint", "b": "string"}
    lines(folder, "two", [{"a": "three", "c": 1.5, "d": None}, {"c": 2, "a": 4, "_rescued": "own", "e": {"f": 1}}])
    evolving.ingest_lines(spark, str(folder), target)
    assert evolving.columns(spark, target) == {"a": "bigint", "b": "string", "c": "double", "e": "string"}
    lines(folder, "three", [{"c": "many"}, {}])
    evolving.ingest_lines(spark, str(folder), target)
    got = {(r.a, r.b, r.c, r.e, r._rescued) for r in evolving.read_lines(spark, target).collect()}
    assert got == {
        (1, "x", None, None, None), (2, None, None, None, None), (None, None, None, None, '{"_line":"no json"}'), (None, None, None, None, '{"_line":"[1]"}'),
        (None, None, 1.5, None, '{"a":"three"}'), (4, None, 2.0, '{"f":1}', '{"_rescued":"own"}'), (None, None, None, None, '{"c":"many"}'), (None, None, None, None, None),
    }
    assert evolving.columns(spark, target, before=1) == {"a": "bigint", "b": "string"}


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    target = str(tmp_path / "t")
    one = spark.createDataFrame([('{"a": 1}',)], "value string")
    two = spark.createDataFrame([('{"b": "x"}',), ('{"a": 2}',)], "value string")
    for batch, number in ((one, 0), (two, 1), (two, 1)):
        evolving.land_batch(batch, number, target)
    assert rows_of(evolving.read_lines(spark, target).select("a", "b")) == [(1, None), (2, None), (None, "x")]
    assert evolving.columns(spark, target) == {"a": "bigint", "b": "string"}
