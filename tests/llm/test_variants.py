"""Spelling variants, whitening and repeated runs of words against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliomill.llm import recompress, spelling, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters,seed", [(k, s) for k in (1, 2, 4) for s in range(30)])
def test_one_edit_pairs(letters, seed):
    rng = random.Random(f"{letters} {seed}")
    words = sorted({"".join(rng.choice("abcd"[:letters]) for _ in range(rng.randrange(8))) for _ in range(60)})
    found = list(spelling.one_edit_pairs(words))
    assert sorted(found) == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])]


def expected_variants(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = defaultdict(list)
    for w in words:
        for i in range(len(w) + 1):
            for v in {w[:i] + w[i + 1 :], *(w[:i] + c + w[i + j :] for j in (0, 1) for c in ALPHABET)}:
                if v in words and one_edit(w, v) and v not in near[w]:
                    near[w].append(v)
    form = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in form.items() if words[v] >= 2 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(
        ((w, form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words), key=repr
    )


ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def spelled_rows():
    """Words with slips of several kinds, a dense family that is cut down to single places, accents and a very long word."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 11))) for _ in range(60)]
    family = ["stem" + a + b for a in "abcdefghij" for b in "abcdefghij"]
    rows = []
    for i in range(120):
        own = []
        for w in base:
            for _ in range(rng.randrange(4)):
                at, c = rng.randrange(len(w)), rng.choice("abcÀÿ")
                slip = rng.random()
                own.append(w if slip < 0.8 else w[:at] + c + w[at:] if slip < 0.87 else w[:at] + w[at + 1 :] if slip < 0.94 else w[:at] + c + w[at + 1 :])
        own += rng.sample(family, 20) + ["z" * 300, "z" * 299, "Y" * 300][: rng.randrange(4)]
        rows.append((i, " ".join(own).upper() if i % 3 == 0 else "1".join(own)))
    return rows


def test_spelling_variants(spark, docs, no_docs, texts, monkeypatch):
    rows = spelled_rows()
    monkeypatch.setattr(spelling, "FILE_WORDS", 6)
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    found = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = expected_variants(rows)
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert sorted(map(tuple, spelling.spelling_variants(docs).collect()), key=repr) == expected_variants(texts)
    assert spelling.spelling_variants(no_docs).count() == 0


def test_files_stay_small(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FILE_WORDS", 20)
    words = spark.createDataFrame([("stem" + a + b + "x", 3) for a in "abcdefghijklm" for b in "abcdefghijklm"], "word string, n long")
    sizes = spelling._bounded_files(words).groupBy("m", "a", "b", "before", "behind").count().collect()
    assert all(r["count"] <= 20 or r.b - r.a == 1 for r in sizes) and any(r["count"] > 1 for r in sizes)
    near = spelling.near_words(words)
    assert near.count() == near.distinct().count() == 169 * 24


@pytest.mark.parametrize("seed", range(25))
def test_leading_vectors(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 40))
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = [rng.random(d) * 9, np.full(d, 2.0), rng.integers(0, 3, d), 5 + np.arange(d) * 1e-9, np.where(np.arange(d) < 3, 4, 0)][seed % 5]
    m = np.diag(values.astype(float)) if seed % 2 else (q * values) @ q.T
    m = (m + m.T) / 2
    found, vectors = whitening.leading_vectors(m, 8)
    scale = max(1.0, np.abs(m).max())
    assert np.abs(found - np.sort(np.linalg.eigvalsh(m))[::-1][:8]).max() < 1e-12 * scale
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12
    assert np.abs(m @ vectors.T - vectors.T * found).max() < 1e-11 * scale


def vectors_table(spark, rows):
    schema = "vec_id long, embedding array<float>, _id string, _w int, n long"
    return spark.createDataFrame([(i, v, "clash", 1, 2) for i, v in rows], schema)


def test_whitened(spark):
    rng = np.random.default_rng(3)
    good = [(int(i), v) for i, v in enumerate((rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12))).astype(np.float32).tolist())]
    good += [(None, good[0][1]), (7, good[8][1]), (7, good[7][1])]
    bad = [(900, None), (901, [None] + good[0][1][1:]), (902, [math.nan] + good[0][1][1:]), (903, [math.inf] + good[0][1][1:]), (904, [])]
    found = whitening.whitened(vectors_table(spark, good + bad)).toPandas()
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good], dtype=np.int64)
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    assert len(found) == 8 * n and set(found.n) == {n}
    assert sorted(set(zip(found.vec_id.fillna(-1), found.deviation))) == sorted(
        {(-1 if i is None else i, int(((n * r - sums) ** 2).sum())) for (i, _), r in zip(good, x)}
    )
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    for k in range(8):
        own = found[found.component == k + 1]
        assert abs(own.explained.iloc[0] - e[-1 - k] / e.sum()) < 1e-12
        want = centred @ v[:, -1 - k] / math.sqrt(e[-1 - k])
        sign = np.sign(want[20] * own[own.vec_id == 20].whitened.iloc[0])
        assert np.allclose(np.sort(own.whitened), np.sort(sign * want), atol=1e-9)


def test_whitened_odd_tables(spark):
    empty = vectors_table(spark, [])
    same = vectors_table(spark, [(i, [1.0, 2.0]) for i in range(5)])
    assert whitening.whitened(empty).count() == whitening.whitened(same).count() == 0
    assert whitening.whitened(empty).columns == whitening.whitened(vectors_table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])).columns
    line = whitening.whitened(vectors_table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert {(r.vec_id, r.component, r.deviation, round(abs(r.whitened), 9), r.explained) for r in line} == {(1, 1, 1024**2, 1, 1), (2, 1, 1024**2, 1, 1)}
    with pytest.raises(ValueError, match="entries"):
        whitening.whitened(vectors_table(spark, [(1, [0.0]), (2, [1.0, 1.0])]))


def test_large_deviations_are_exact(spark):
    """Squares that might leave 64 bits when summed are added as whole numbers of any size; one that does leave them is an error."""
    rows = [(1, [2.0**19] + [0.0] * 7), (2, [-(2.0**19)] + [0.0] * 7)]
    assert {(r.vec_id, r.deviation) for r in whitening.whitened(vectors_table(spark, rows)).collect()} == {(1, 2**60), (2, 2**60)}
    with pytest.raises(Exception, match="too large|overflow|OverflowError|int too big"):
        whitening.whitened(vectors_table(spark, [(1, [2.0**30]), (2, [-(2.0**30)])])).collect()


def expected_removed(rows, width):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()), key=repr)


def test_repeated_words(spark, docs, no_docs, texts, tmp_path, monkeypatch):
    want = expected_removed(texts, recompress.WINDOW)
    assert any(0 < r[2] < r[1] for r in want)
    assert removed(recompress.remove_repeated_words(docs)) == want
    assert recompress.remove_repeated_words(no_docs).count() == 0
    rng = random.Random(9)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randrange(30, 90))] for _ in range(12)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(1, 8)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            own += rng.choice([p, p[a:], p[: a + 20], [rng.choice("abcdefghijkl") for _ in range(rng.randrange(40))], ["run"] * rng.randrange(80)])
        rows.append((i, " ".join(own)))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "t"))
    want = expected_removed(rows, recompress.WINDOW)
    for piece in (recompress.PIECE, 40):
        monkeypatch.setattr(recompress, "PIECE", piece)
        monkeypatch.setattr(recompress, "CHUNK", piece)
        assert removed(recompress.remove_repeated_words(spark.read.parquet(str(tmp_path / "t")))) == want


def test_equal_windows_have_equal_anchors():
    """What stands around a window has no say in its anchor, its offset or its key."""
    rng = np.random.default_rng(4)
    for case in range(60):
        alphabet = rng.integers(0, 2**63, rng.integers(1, 40)).astype(np.uint64)
        window = rng.choice(alphabet, recompress.WINDOW)
        seen = set()
        for _ in range(6):
            before, behind = (rng.choice(alphabet, rng.integers(0, 60)) for _ in range(2))
            words = np.concatenate([before, window, behind])
            found = recompress.anchors(recompress.Piece([0], [0], [len(words)], words))
            at = len(before)
            i = int(np.flatnonzero((found["_low"] <= at) & (at <= found["_high"]))[0])
            seen.add(int(found["_key"][i]))
        assert len(seen) == 1, case


def test_runs_and_pairs_shrink_a_text():
    words = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64)
    sizes = [len(s.name) for s in recompress.parse(words, np.zeros(3000, np.int64))]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < 0.35 * sizes[0]
    run = recompress.name_runs(recompress.Symbols(np.full(50, 7, np.uint64), np.zeros(50, int), np.arange(50), np.arange(50) + 1), 0)
    assert len(run.name) == 1
