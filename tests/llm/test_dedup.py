"""Exact copies, near copies and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliomill.llm import exact_dup, near_dup, repeats
from foliomill.llm import components as cp
from foliomill.llm.components import components
from foliomill.llm.exact_dup import exact_duplicates
from foliomill.llm.words import run_hashes, shingle_sets, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected_exact(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    out, given = [], set()
    for i, t in texts:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        kept = i == keep and (t or "") not in given
        if kept:
            given.add(t or "")
        out.append((i, keep, len(groups[t or ""]), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_duplicates(docs, no_docs, texts):
    assert rows_of(exact_duplicates(docs)) == expected_exact(texts)
    assert exact_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("share", [1, 10**9])
def test_frequent_texts_give_the_same_groups(docs, texts, monkeypatch, share):
    """No text counts as frequent, or all do."""
    monkeypatch.setattr(exact_dup, "HOT_SHARE", share)
    assert rows_of(exact_duplicates(docs)) == expected_exact(texts)


def test_exact_duplicates_compare_texts_when_digests_clash(docs, texts):
    weak = exact_duplicates(docs, digest=lambda text: F.octet_length(text).cast("string"))
    assert rows_of(weak) == expected_exact(texts)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def expected_near(texts):
    sets = [shingles(t) for _, t in texts]
    part = list(range(len(texts)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= 75 * len(sets[a] | sets[b]):
                part[max(root(a), root(b))] = min(root(a), root(b))
    ids = defaultdict(list)
    for k, (i, _) in enumerate(texts):
        ids[root(k)].append(i)
    out = []
    for k, (i, _) in enumerate(texts):
        known = [x for x in ids[root(k)] if x is not None]
        least = min(known) if known else None
        out.append((i, len(sets[k]), least, i == least))
    return sorted(out, key=repr)


def test_near_duplicates(docs, no_docs, texts):
    assert rows_of(near_dup.near_duplicates(docs)) == expected_near(texts)
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_near_duplicates_in_buckets_of_several_groups(spark, tmp_path):
    """Many variants of one text, of which some are only linked to others than the first centres."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(own)))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    found = near_dup.near_duplicates(spark.read.parquet(str(tmp_path / "t")))
    assert rows_of(found) == expected_near(texts)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**64, 600, dtype=np.uint64)
    b = np.concatenate([a[:480], rng.integers(0, 2**64, 120, dtype=np.uint64)])
    agree = (near_dup.signature(np.sort(a)) == near_dup.signature(np.sort(b))).mean()
    assert abs(agree - 480 / 720) < 0.15
    one = near_dup.signature(np.sort(a[:1]))
    assert (one == a[0]).all()  # empty bins take over the only value


def test_words_and_runs():
    data = [b"The  quick\tFox", b"", b" the quick fox "]
    hashes, counts = word_hashes(data)
    assert counts.tolist() == [3, 0, 3]
    assert (hashes[:3] == hashes[3:]).all() and len(set(hashes[:3].tolist())) == 3
    assert len(run_hashes(hashes, 2)) == 5
    assert [len(s) for s in shingle_sets(data, 5)] == [1, 0, 1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (159, 200)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {x: 100 for x in [*range(101, 160), 200]}


def expected_repeats(texts, n=200):
    data = [(t or "").encode() for _, t in texts]
    seen = Counter(t[s : s + n] for t in data for s in range(len(t) - n + 1))
    out = []
    for (i, _), t in zip(texts, data):
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - n + 1):
            if seen[t[s : s + n]] > 1:
                gone[s : s + n] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digest(df):
    return rows_of(df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))


def test_repeated_passages(docs, no_docs, texts):
    assert digest(repeats.remove_repeats(docs)) == expected_repeats(texts)
    assert repeats.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("piece", [1 << 20, 700])
def test_repeated_passages_of_mixed_lengths(spark, tmp_path, monkeypatch, piece):
    """Overlapping, self-repeating and barely too short passages; also with texts cut into many pieces."""
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(piece)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(150, 900))) for _ in range(8)]
    texts = []
    for i in range(60):
        t = "".join(rng.choice("abcdef é") for _ in range(rng.randint(0, 300)))
        for _ in range(rng.randint(0, 3)):
            b = rng.choice(base)
            x = rng.randrange(len(b))
            t += b[x : rng.randint(x, len(b))] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 30)))
        texts.append((i, t))
    texts += [(100, "a" * 500), (101, "a" * 201), (102, "a" * 200), (103, "ab" * 300), (104, base[0] * 3), (105, "x" * 199)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "t"))
    assert digest(repeats.remove_repeats(spark.read.parquet(str(tmp_path / "t")))) == expected_repeats(texts)


def passages_in_common(seed, n):
    """Texts of shared passages and own words, many of them just below or above the similarity that links."""
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(60)] for k in range(3)]
    out = []
    for i in range(n):
        own = [f"d{i}w{j}" for j in range(rng.randrange(16))]
        text = [w for p in sorted(rng.sample(passages, rng.randrange(1, 4))) for w in p[: rng.randrange(54, 61)]]
        at = rng.randrange(len(text))
        out.append((i, " ".join(text[:at] + own + text[at:])))
    return out


def test_prefix_links_miss_nothing(spark):
    rows = passages_in_common(1, 120) + [(200, "one two"), (201, "a b c d e f"), (202, "a b c d e g")]
    sets = {i: shingles(t) for i, t in rows}
    linked = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    texts = spark.createDataFrame(rows, "_c long, _text string")
    alone = spark.createDataFrame([(i, i) for i in sets], "_c long, _label long")
    found = {(r.u, r.v) for r in near_dup._prefix_links(alone, texts).collect()}
    assert len(linked) > 50 and linked <= found and len(found) < 0.7 * len(sets) * (len(sets) - 1) / 2
    together = spark.createDataFrame([(i, 0) for i in sets], "_c long, _label long")
    assert near_dup._prefix_links(together, texts).count() == 0


def test_unconnected_buckets_are_closed(spark, tmp_path, monkeypatch):
    """With all texts in one bucket a star of the first text alone would lose nearly every link."""
    rows = passages_in_common(2, 90)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(near_dup, "bands", lambda values: np.zeros(2, np.uint64))
    found = near_dup.near_duplicates(spark.read.parquet(str(tmp_path / "t")))
    assert rows_of(found) == expected_near(rows)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
def test_contracted_links_keep_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(cp, "CHUNK", chunk)
    rng = random.Random(chunk)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(400, 440)]
    rng.shuffle(links)
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "u long, v long").repartition(3)).collect()}
    assert found == {x: root(x) for x in parent if root(x) != x}
