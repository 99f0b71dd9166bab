import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliomill.functions import text as tx
from foliomill.operators import enrich


def values(spark, texts, column):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(column(F.col("t"))).collect()]


def test_strip_removes_what_python_strips(spark):
    texts = ["", " ", "\t a b \n", " x ", "　", "a b", None, "\x1c\x85y"]
    assert values(spark, texts, tx.strip) == [None if t is None else t.strip() for t in texts]
    assert values(spark, texts, tx.is_blank) == [t is None or not t.strip() for t in texts]


def test_document_name(spark):
    paths = ["/a/My Dir/Some File.pdf", "dbfs:/x/y/Z.pdf", "/only.pdf", "/a/b/c.PDF", "/a/b/c.txt", None]
    got = values(spark, paths, lambda c: tx.document_name(c, "pdf"))
    assert got == ["my_dir/some_file", "y/z", "/", "/", "/", None]


def test_html_text(spark):
    pages = ["<p>a</p><script>x<y</script>b", "<style>\np{}\n</style> c \n\n d", "", None]
    assert values(spark, pages, tx.html_text) == ["a b", "c d", "", None]


@pytest.mark.parametrize("size,overlap", [(475, 50), (10, 3), (4, 3), (5, 0), (7, 4)])
def test_fixed_chunks_equal_plain_slices(spark, size, overlap):
    rng = random.Random(7)
    texts = ["".join(rng.choice("aé😀\n ") for _ in range(n)) for n in (0, 1, 3, 4, 5, 7, 10, 11, 50, 475, 476, 900, 1000)]
    step = size - overlap

    def plain(t):
        return [t[i * step : i * step + size] for i in range(max(math.ceil((len(t) - overlap) / step), 1))] if t else []

    assert values(spark, texts, lambda c: tx.fixed_chunks(c, size, overlap)) == [plain(t) for t in texts]
    assert values(spark, [None], lambda c: tx.fixed_chunks(c, size, overlap)) == [None]


def test_fixed_chunks_reject_overlap_of_size():
    with pytest.raises(ValueError):
        tx.fixed_chunks(F.lit("x"), 10, 10)


def test_pages_round_trip(spark):
    text = "\n".join(f"p{i}" for i in range(12))
    df = spark.createDataFrame([(text.encode(),), (b"",)], "content binary")
    pages = enrich.text_pages(F.col("content"))
    assert [r[0] for r in df.select(tx.join_pages(pages)).collect()] == [text.replace("\n", ""), ""]
    rows = enrich.explode_pages(df.limit(1), pages, []).collect()
    assert [(r.page_nr, r.page_ix) for r in rows] == [(str(i), i) for i in range(12)]


def test_empty_and_null_maps_drop(spark):
    df = spark.createDataFrame([("a", {}), ("b", None), ("c", {"0": "x"})], "f string, pages map<string,string>")
    assert [r.f for r in enrich.explode_pages(df, F.col("pages"), ["f"]).collect()] == ["c"]


def test_hashed_embedding(spark):
    texts = ["", "the cat the dog", "Ünïcode words", None]

    def plain(t):
        import re

        counts = Counter(int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % 64 for w in re.findall("[a-z]+", t.lower()))
        norm = math.sqrt(sum(n * n for n in counts.values()))
        return [counts.get(b, 0) / norm if norm else 0.0 for b in range(64)]

    got = values(spark, texts, tx.hashed_embedding)
    assert got[3] is None
    for vector, t in zip(got[:3], texts):
        assert vector == pytest.approx(plain(t))


def test_topic(spark):
    texts = ["apple banana apple cherry", "zebra yacht", "tiny me", "", None, "delta alpha alpha delta gamma"]
    got = values(spark, texts, enrich.topic_json)
    topics = ["apple", "yacht", "N/A", "N/A", "N/A", "alpha"]
    assert got == ['{"topic":"%s"}' % t for t in topics]


def test_malformed_topic_becomes_empty_object(spark):
    df = spark.createDataFrame([('{"topic":"x","extra":1}',), ("oops",), (None,)], "topic string")
    assert [r.parsed_topic_str for r in enrich.parse_topic(df).collect()] == ['{"topic":"x"}', "{}", None]


def test_prompt_is_null_for_missing_text(spark):
    assert values(spark, ["a", None], lambda c: enrich.build_request("p:", c)) == ["p:a", None]


def test_parser_plug_in(spark):
    df = spark.createDataFrame([("a", b"one|two"), ("b", b"\xff"), ("c", None)], "path string, content binary")

    def parser(data):
        return data.decode("utf-8").split("|")

    rows = {r.path: r for r in enrich.extract_pages(df, parser, ["path"], on_error="record").collect()}
    assert rows["a"].pages == {"0": "one", "1": "two"} and rows["a"].error is None
    assert rows["b"].pages == {} and rows["b"].error.startswith("UnicodeDecodeError")
    assert rows["c"].pages == {} and rows["c"].error is None
    with pytest.raises(Exception, match="UnicodeDecodeError"):
        enrich.extract_pages(df, parser, ["path"]).collect()


def test_coverage_names_every_loss(spark):
    df = spark.createDataFrame([("a.pdf", "text"), ("b.pdf", " \n"), ("c.pdf", None), ("d.txt", "x"), ("e.pdf", "")], "p string, t string")
    with_chunks = df.withColumn("c", tx.fixed_chunks(F.col("t"), 10, 2))
    reason = enrich.coverage_reason(F.col("t"), F.col("c"), F.col("p").endswith(".pdf"))
    got = {r.p: r.r for r in with_chunks.select("p", reason.alias("r")).collect()}
    assert got == {"a.pdf": "chunked", "b.pdf": "blank text", "c.pdf": "null text", "d.txt": "not eligible", "e.pdf": "blank text"}
    chunks = enrich.chunk_fixed(df, "t", 10, 2)
    assert {r.p for r in enrich.uncovered(df, chunks, "p").collect()} == {"c.pdf", "e.pdf"}


def test_model_seams(spark):
    df = spark.createDataFrame([("ab",), ("c",)], "request string")
    out = enrich.infer(df, lambda s: s.str.upper(), "request", "reply")
    out = enrich.embed(out, lambda s: s.map(lambda t: [float(len(t))]), "request")
    assert {(r.request, r.reply, r.embedding[0]) for r in out.collect()} == {("ab", "AB", 2.0), ("c", "C", 1.0)}


def test_vectors_are_handed_back_in_parts(spark, monkeypatch):
    import pyarrow as pa

    made = []
    kept = tx.F.arrow_udf
    monkeypatch.setattr(tx.F, "arrow_udf", lambda kind: lambda f: made.append(f) or kept(kind)(f))
    tx.hashed_embedding(tx.F.lit("a"), 4)
    lists = [None if i % 7 == 0 else [i % 4] * (i % 3) for i in range(1000)]
    parts = list(made[0]([pa.array(lists, pa.list_(pa.int32()))]))
    assert max(map(len, parts)) <= 256
    want = [None if b is None else [float(bool(b) and b[0] == c) for c in range(4)] for b in lists]
    assert [v for part in parts for v in part.to_pylist()] == want
