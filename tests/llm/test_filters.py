"""Archives, decontamination, the classifier and URL lists."""

import hashlib
import re
import zlib
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from foliomill.llm import quality, url_lists, warc
from foliomill.llm.decontaminate import contamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_repr(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# --- archives


def test_archive_round_trip(spark, tmp_path):
    big, other = "<p>" + "é" * 600 + "</p>", "<p>" + "x" * 2000
    pages = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "u", None), (5, "u", ""), (6, "u\r\nbad", "small"),
             (7, "u", "small"), (8, "u", other), (9, "u", big), (9, "u", big), (None, "u", other), (None, "u", "tiny")]
    rows = [(i, u, h, "clash", 1) for i, u, h in pages]
    schema = "page_id long, url string, html string, payload string, _row int"
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(str(tmp_path / "p"))
    found = warc.archive_round_trip(spark, spark.read.parquet(str(tmp_path / "p")))
    want, given = [], set()
    for i, _, h in pages:
        data = (h or "").encode()
        owner = max((p[0] for p in pages if p[2] == h and p[0] is not None), default=None) if len(data) >= 1000 else i
        first = len(data) < 1000 or (i == owner and (h not in given))
        if first:
            given.add(h)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if first else "revisit", None if first else owner))
    assert by_repr(found.collect()) == by_repr(want)
    none = spark.createDataFrame([], schema)
    assert warc.archive_round_trip(spark, none).count() == 0


def test_archives_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", "x" * 3000 + str(i)) for i in range(400)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    folder = str(tmp_path / "archives")
    archives = warc.write_archives(spark.read.parquet(str(tmp_path / "p")), folder, archive_bytes=30_000)
    n = archives.count()
    records = warc.read_archives(archives, folder)
    per_task = [r["count"] for r in records.groupBy(F.spark_partition_id()).count().collect()]
    assert n > 8 and records.rdd.getNumPartitions() == n and len(per_task) > n / 3 and sum(per_task) == 400
    monkeypatch.setattr(warc, "MOST_READERS", 3)
    assert warc.read_archives(archives, folder).rdd.getNumPartitions() == 3


def test_only_revisits_are_joined(spark, tmp_path):
    schema = "record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to_record string"
    records = spark.createDataFrame([("a", 1, "response", 5, "d", None), ("b", 2, "revisit", None, "d", "a"), ("c", 3, "revisit", None, "e", "gone")], schema)
    assert by_repr(warc.resolve_revisits(records).collect()) == by_repr([(1, 5, "d", "response", None), (2, 5, "d", "revisit", 1), (3, None, "e", "revisit", None)])


def test_archive_layout():
    records = [warc.write_record({"WARC-Type": "resource", "WARC-Record-ID": f"<{i}>", "WARC-Date": warc.DATE}, b"text %d " % i * 90) for i in range(200)]
    archive = b"".join(warc.pack_records(records))
    assert struct.unpack_from("<I", archive)[0] == warc.DICTIONARY_FRAME
    dictionary, at = warc.split_dictionary(memoryview(archive))
    assert dictionary and at > 8
    frames = []
    while at < len(archive):
        end = warc.frame_end(memoryview(archive), at)
        frames.append(archive[at:end])
        at = end
    assert len(frames) == 200
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert unpack.decompress(frames[7], max_output_size=1 << 20) == records[7]
    assert [r.payload for r in warc.read_archive(archive)] == [b"text %d " % i * 90 for i in range(200)]


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
        lambda r: r.replace(b"Content-Length: 4", b"Content-Length: 5"),
        lambda r: r.replace(b"WARC-Date", b"X-Date"),
        lambda r: r[:-2],
        lambda r: r.replace(b"text", b"tExt"),
        lambda r: r.replace(b"WARC-Type:", b"WARC-Type"),
    ],
)
def test_damaged_records_are_refused(change):
    digest = hashlib.sha1(b"text").hexdigest()
    record = warc.write_record(
        {"WARC-Type": "response", "WARC-Record-ID": "<1>", "WARC-Date": warc.DATE, "WARC-Payload-Digest": f"sha1:{digest}"}, b"text"
    )
    assert warc.parse_record(record).payload == b"text"
    with pytest.raises(ValueError):
        warc.parse_record(change(record))


def test_cut_off_archives_are_refused():
    archive = b"".join(warc.pack_records([warc.write_record({"WARC-Type": "resource", "WARC-Record-ID": "1", "WARC-Date": "d"}, b"x" * 50)]))
    with pytest.raises(ValueError):
        list(warc.read_archive(archive[:-3]))
    with pytest.raises(ValueError):
        list(warc.read_archive(archive + b"junk"))


# --- decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected_hits(docs, items, size=10):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(item, w[s : s + size]) for s in range(max(1, len(w) - size + 1))] if w else []
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, window in windows:
            for s in range(len(w) - len(window) + 1):
                if w[s : s + len(window)] == window:
                    hit |= set(range(s, s + len(window)))
                    if item is not None:
                        found.add(str(item))
        out.append((i, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return by_repr(out)


def test_contamination(spark, docs, no_docs, texts):
    source = words(texts[0][1])
    items = [(1, " ".join(source[5:25])), (2, "A b C"), (10, "a b c"), (3, None), (4, "  ?!"), (5, "never seen words here"), (None, "one two"),
             (6, " ".join(source[30:40]).upper()), (6, " ".join(source[30:40])), (7, "ünïcode"), (8, "Ünïcode")]
    schema = "item_id long, text string, _words string"
    table = spark.createDataFrame([(i, t, "clash") for i, t in items], schema)
    found = contamination(docs, table)
    assert by_repr(found.collect()) == expected_hits(texts, items)
    clean = contamination(docs, spark.createDataFrame([], schema))
    assert clean.count() == len(texts) and clean.filter("contaminated or n_hit > 0").count() == 0
    assert contamination(no_docs, table).count() == 0


def test_contamination_in_blocks(spark, docs, texts, monkeypatch):
    from foliomill.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    items = [(i, " ".join(words(texts[k][1])[3:40])) for i, k in enumerate((0, 9, 25, 30))]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert by_repr(contamination(docs, table).collect()) == expected_hits(texts, items)


def test_contamination_runs_no_python(spark, docs):
    table = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = contamination(docs, table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- classifier


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = quality.Network(*(x.astype(np.float64) for x in quality.new_network()))
    net = net._replace(bias=rng.normal(0.1, 0.05, quality.FILTERS))
    data = [bytes(rng.integers(32, 120, n).astype(np.uint8)) for n in (10, 700, 1500, 300)]
    y, w = np.array([0, 1, 1, 0.0]), np.ones(4)

    def loss(n):
        p = quality.probabilities(n, data)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    for name, value, grad in zip(net._fields, net, quality.gradients(net, data, y, w), strict=True):
        place = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        up, down = value.copy(), value.copy()
        up[place] += 1e-5
        down[place] -= 1e-5
        slope = (loss(net._replace(**{name: up})) - loss(net._replace(**{name: down}))) / 2e-5
        assert slope == pytest.approx(grad[place], rel=1e-3), name


def naive_probability(net, text):
    """The network by loops: every filter at every step of every chunk."""
    hops = (len(text) + quality.STEP) // quality.HOP + 1
    data = bytes(quality.STEP) + text + bytes(hops * quality.HOP - len(text))
    maxima = []
    for h in range(hops):
        best = np.full(quality.FILTERS, -np.inf)
        for step in range(quality.STEPS):
            at = (h * quality.STEPS + step) * quality.STEP
            seen = np.concatenate([net.embed[b] for b in data[at : at + quality.WIDTH]])
            best = np.maximum(best, seen @ net.filters)
        maxima.append(best)
    chunks = [np.maximum(np.maximum(a, b) + net.bias, 0) for a, b in zip(maxima, maxima[1:] or maxima)]
    features = np.concatenate([np.mean(chunks, 0), np.max(chunks, 0)])
    return 1 / (1 + np.exp(-(features @ net.weights + net.offset[0])))


def test_scores_match_loops():
    rng = np.random.default_rng(6)
    net = quality.new_network(3)._replace(bias=rng.normal(0.1, 0.1, quality.FILTERS).astype(np.float32))
    texts = [bytes(rng.integers(1, 256, n).astype(np.uint8)) for n in (0, 1, 7, 251, 252, 255, 256, 257, 511, 1030)]
    assert quality.probabilities(net, texts) == pytest.approx([naive_probability(net, t) for t in texts], abs=1e-5)


def test_training_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (10, 1), (13, 0), (13, 0), (8, 1), (None, 1)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in quality.training_rows(docs, labels).collect()}
    held = {i for i in (1, 10, 13, 8) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert set(rows) == {1, 10, 13, 8} - held and len(held) < 3
    for i, want in ((1, 0), (10, 1), (13, 0), (8, 1)):
        assert i in held or rows[i].quality == want
    assert 13 in held or rows[13].text == "a b c d e f g"  # one row of a repeated id
    assert 10 in held or len(rows[10].text) > 100_000  # whole texts
    small = quality.training_rows(docs, labels, most_bytes=1000).collect()
    assert all(sum(len(r.text.encode()) for r in small if r.quality == q) <= 1000 for q in (0, 1))


def test_pieces_of_a_long_text_score_as_a_whole(monkeypatch):
    net = quality.new_network()
    text = bytes(np.random.default_rng(1).integers(32, 120, 9000).astype(np.uint8))
    whole = quality.probabilities(net, [b"x", text, b""])
    monkeypatch.setattr(quality, "PIECE_HOPS", 3)
    assert quality.probabilities(net, [b"x", text, b""]) == pytest.approx(whole)
    assert quality.probabilities(net, [text])[0] == pytest.approx(whole[1])


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    scores = quality.quality_scores(docs, quality.learn(docs, labels))
    judged = scores.join(labels, "doc_id").filter("held_out").select("predicted", "quality", "score").toPandas()
    assert len(judged) > 50
    assert (judged.predicted == judged.quality).mean() > 0.9
    assert judged.score[judged.quality == 1].mean() > judged.score[judged.quality == 0].mean() + 0.3


def test_quality_of_odd_rows(spark, docs, no_docs, texts):
    labels = spark.createDataFrame([(1, 1), (2, 1), (100, 0), (101, 0), (None, 1), (3, None), (102, 7)], "doc_id long, quality int")
    net = quality.learn(docs, labels, epochs=2)
    rows = quality.quality_scores(docs, net).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert quality.quality_scores(no_docs, net).count() == 0
    kept = quality.keep_good(docs, net)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    flat = quality.learn(docs, labels.filter("false"))
    assert {r.score for r in quality.quality_scores(docs, flat).collect()} == {0.5}


# --- URL lists


def test_lookup_keys(spark):
    rows = [("https://User@A.B.Example.com:80/x/y/?q#f",), (None,), ("nonsense",), ("http://" + "a." * 200 + "com/",), ("http://h",)]
    urls = spark.createDataFrame(rows, "url string")
    keys = [r[0] for r in urls.select(url_lists.lookup_keys(F.col("url"), 4)).collect()]
    assert keys[0] == ["a.b.example.com", "b.example.com", "example.com", "com", "a.b.example.com/x/y/"]
    assert keys[1:3] == [[], []] and keys[4] == ["h", "h/"]
    assert keys[3] == ["a.a.a.com", "a.a.com", "a.com", "com", "a." * 200 + "com/"]
    assert urls.select(url_lists.lookup_keys(F.col("url"), 2)).first()[0] == ["example.com", "com", "a.b.example.com/x/y/"]


def test_blocks_make_up_a_range(spark):
    ranges = [(a, b) for a in range(-9, 20, 2) for b in range(a - 1, 25, 3)] + [(0, 10**12), (-(10**12), 5)]
    rows = spark.createDataFrame(ranges, "a long, b long").select("a", "b", url_lists.blocks(F.col("a"), F.col("b")).alias("k")).collect()
    for r in rows:
        parts = sorted((x.block << x.level, (x.block + 1) << x.level) for x in r.k or [])
        assert [p[0] for p in parts[1:]] == [p[1] for p in parts[:-1]] and len(parts) <= 82
        assert (parts[0][0], parts[-1][1] - 1) == (r.a, r.b) if r.a <= r.b else not parts


def test_one_far_fetch_time_is_harmless(spark):
    """A capture whose time is in milliseconds makes pieces in proportion to the digits of the time, not to the time."""
    lists = spark.createDataFrame([("ads", f"h{i}.com", i, "add") for i in range(50)], "list string, key string, at long, action string")
    caps = spark.createDataFrame([(1, "http://h3.com/", 10**9), (2, "http://h4.com/", 1_700_000_000_000)], "page_id long, url string, at long")
    assert url_lists.validity(lists, 1_700_000_000_000 // url_lists.PERIOD_SECONDS).count() < 50 * 50
    assert {(r.page_id, r.blocked) for r in url_lists.active_entries(caps, lists, "page_id", "url", "at").collect()} == {(1, True), (2, True)}


def test_long_hosts_are_looked_up(spark):
    lists = spark.createDataFrame([("ads", "b.com", 0, "add")], "list string, key string, at long, action string")
    caps = spark.createDataFrame([(1, "http://" + "x." * 4000 + "b.com/", 5)], "page_id long, url string, at long")
    row = url_lists.active_entries(caps, lists, "page_id", "url", "at").first()
    assert row.blocked and len(row.host) == 8005


def test_active_entries(spark):
    entries = [("ads", "x.com", 100, "add"), ("ads", "x.com", 200, "remove"), ("ads", "x.com", 150, "add"), ("ads", "x.com", 900, "add"),
               ("spam", "a.x.com", 10, "add"), ("spam", "a.x.com", 10, "remove"), ("url", "y.com/p/", 50, "add"), ("ads", None, 1, "add"),
               ("ads", "y.com", None, "add"), ("ads", "y.com", 5, "other"), ("old", "x.com", -500, "add")]
    captures = [(i, "http://a.x.com/q", t) for i, t in enumerate((-600, -500, 99, 100, 199, 200, 899, 900, 5000))]
    captures += [(20, "http://y.com/p?z", 60), (20, "http://y.com/p?z", 60), (21, "http://y.com/p/q", 60), (22, None, 60), (23, "http://x.com", None), (None, "http://x.com", 150)]
    caps = spark.createDataFrame([(*c, "clash") for c in captures], "page_id long, url string, at long, _key string")
    lists = spark.createDataFrame(entries, "list string, key string, at long, action string")

    def active(url, t):
        host = url_lists_host(url)
        if not host or t is None:
            return []
        keys = [host.split(".", k)[-1] for k in range(host.count(".") + 1)] + [host + re.sub("/+$", "", re.sub(r"[?#].*", "", url.split(host, 1)[1])) + "/"]
        out = []
        for name, key in sorted({e[:2] for e in entries if e[1] in keys}):
            past = [(e[2], e[3]) for e in entries if e[:2] == (name, key) and e[2] is not None and e[2] <= t and e[3] in ("add", "remove")]
            if past and max(past)[1] == "add":
                out.append(name)
        return out

    def url_lists_host(url):
        return re.sub(r"^https?://", "", url).split("/")[0] if url else ""

    want = by_repr((i, t, url_lists_host(u), len(a := active(u, t)), sorted(set(a)), bool(a)) for i, u, t in captures)
    for period in (30 * 86400, 70):
        assert by_repr(url_lists.active_entries(caps, lists, "page_id", "url", "at", period).collect()) == want
    assert url_lists.active_entries(caps.filter("false"), lists, "page_id", "url", "at").count() == 0
    assert url_lists.active_entries(caps, lists.filter("false"), "page_id", "url", "at").filter("blocked").count() == 0
