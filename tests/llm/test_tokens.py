"""Tokenizers against the public libraries, and the language model against exact counts."""

import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from foliomill.llm import bpe, ngram_lm
from foliomill.llm.token_count import PieceMerger, _counts, text_units, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)


def by_repr(rows):
    return sorted(rows, key=repr)


def test_encoding_and_decoding(docs, no_docs, texts, library):
    got = by_repr((r.doc_id, bytes(r.token_ids), r.decoded) for r in bpe.encode_texts(docs, BYTE_BPE).collect())
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    assert got == by_repr(want)
    assert bpe.encode_texts(no_docs, BYTE_BPE).count() == 0
    assert bpe.encoded_digests(no_docs, BYTE_BPE).count() == 0


def test_small_cache_gives_the_same_ids(monkeypatch, texts, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    coder = bpe.ByteBpe(BYTE_BPE)
    for _, t in texts:
        (ids,) = coder.encode_many([t or ""])
        assert list(memoryview(ids).cast("I")) == library.encode(t or "", add_special_tokens=False).ids


def test_every_token_is_its_own_encoding():
    """What the trie relies on: the last token of a prefix can be any token that ends there."""
    coder = bpe.ByteBpe(BYTE_BPE)
    ranks = {(coder.bytes_of[a], coder.bytes_of[b]): r for (a, b), r in coder.merge_rank.items()}
    for token in list(coder.ids)[::37]:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, i = min((ranks.get((parts[i], parts[i + 1]), math.inf), i) for i in range(len(parts) - 1))
            if rank == math.inf:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert parts == [token]


def test_token_counts(docs, no_docs, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = by_repr(tuple(r) for r in token_counts(docs, PIECES).collect())
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in texts]
    assert got == by_repr(want)
    assert token_counts(no_docs, PIECES).count() == 0


def test_stand_ins_for_blanks():
    """U+2581 in a text is a blank to the library, beside real blanks too."""
    import random

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = _counts(PIECES)
    parts = ["▁", " ", "  ", "\xa0", "a", "the", "▁the", "\n", "\t", "é", "　", "x▁", "日", "<s>", "\x00"]
    for seed in range(3000):
        rng = random.Random(seed)
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 12)))
        assert sum(map(counts.__getitem__, text_units(counts, text))) == len(model.encode(text)), repr(text)


def test_merging_long_units():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    merger = PieceMerger.load(PIECES)
    for unit in ("the" * 4000, "=" * 999, "aaaab" * 300, "日本" * 50):
        assert merger.count_unit(" " + unit) == len(model.encode(unit))


def exact_model(texts):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None] for _, t in texts]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    counts = Counter(w for ws, o in zip(tokens, out) if not o for w in ws)
    return tokens, out, counts


def test_language_model(docs, texts):
    tokens, out, counts = exact_model(texts)
    total, types = sum(counts.values()), len(counts)
    want = []
    for (i, _), ws, o in zip(texts, tokens, out):
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ws)
        want.append((i, o, len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6)))
    rows = ngram_lm.score_texts(docs, ngram_lm.learn(docs)).collect()
    assert by_repr((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == by_repr(want)
    assert all(r.score < 0 for r in rows)
    assert sum(r.score for r in rows if not r.held_out) > sum(r.base_score for r in rows if not r.held_out)


def test_rare_tokens_are_joined(docs, texts, monkeypatch):
    """With a single heavy token all the others take the way over the join."""
    want = {(r.doc_id, round(r.base_score, 6), r.n_known) for r in ngram_lm.score_texts(docs, ngram_lm.learn(docs)).collect()}
    monkeypatch.setattr(ngram_lm, "HEAVY_TOKENS", 2)
    got = {(r.doc_id, round(r.base_score, 6), r.n_known) for r in ngram_lm.score_texts(docs, ngram_lm.learn(docs)).collect()}
    assert got == want


def test_model_without_texts(docs, no_docs):
    model = ngram_lm.learn(no_docs)
    assert (model.n_tokens, model.n_types) == (0, 0)
    assert ngram_lm.score_texts(no_docs, model).count() == 0
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in ngram_lm.score_texts(docs, model).collect())


def test_filter_finds_what_was_inserted(docs, texts):
    """Probed counts are never below the true level, and seldom above."""
    model = ngram_lm.learn(docs)
    data = model.shared.value[0]
    rows = model.unigrams.toPandas()
    keys, true = rows["_key"].to_numpy(np.int64).view(np.uint64), ngram_lm.levels(rows["_n"].to_numpy())
    found = ngram_lm.probe(data, model.shape, keys, model.cuts[0])
    assert (found >= true).all() and (found > true).mean() < 0.1
    strange = np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64)
    assert (ngram_lm.probe(data, model.shape, strange, 1) > 0).mean() == pytest.approx(ngram_lm.false_rate(), abs=0.015)


def test_levels():
    n = np.arange(1, 5000)
    level = ngram_lm.levels(n)
    assert level[:8].tolist() == [1, 2, 3, 4, 4, 5, 5, 6] and (np.diff(level) >= 0).all() and (np.diff(level) <= 1).all()
    assert (ngram_lm.count_of(level) <= n).all() and (ngram_lm.most_of(level) >= n).all() and (ngram_lm.most_of(level) < 1.5 * n + 1).all()
    assert (ngram_lm.levels(ngram_lm.count_of(level)) == level).all() and ngram_lm.most_of(np.array([0]))[0] == 0


def probabilities_after(model, history):
    """Of every token of the vocabulary, and of one unseen token, after a history."""
    keys = model.unigrams.toPandas()["_key"].to_numpy(np.int64).view(np.uint64)
    keys = np.append(keys[keys != ngram_lm.START], np.uint64(12345))
    grams = ngram_lm.ngrams(keys, np.full(len(keys), history, np.uint64))
    data, shape = model.shared.value[0], model.shape
    found = (ngram_lm.probe(data, shape, grams.singles, 1), ngram_lm.probe(data, shape, grams.pairs, 1))
    return 10.0 ** ngram_lm.log_probabilities(grams, *found, model.types)


def test_probabilities_add_up_to_one(spark, sf_dir):
    """After frequent, rare and unseen histories; what is missing to one is lost to rounding of counts."""
    model = ngram_lm.learn(spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet"))
    ranked = model.unigrams.orderBy(F.col("_n").desc(), "_key").toPandas()["_key"].to_numpy(np.int64).view(np.uint64)
    ranked = ranked[ranked != ngram_lm.END]
    for own in (ranked[:8], ranked[400:420], ranked[3000:3020], ranked[-40:], [ngram_lm.START], [np.uint64(99)]):
        sums = [probabilities_after(model, h).sum() for h in own]
        assert 0.5 < np.mean(sums) <= 1.01 and max(sums) < 1.1, sums
    assert probabilities_after(model, np.uint64(99)).sum() == pytest.approx(1, abs=0.01)


@pytest.mark.parametrize("bits,hashes,worst,usual", [(None, None, 3.0, 0.5), (40, 24, 0.5, 0.1)])
def test_scores_are_close_to_exact_counts(docs, texts, monkeypatch, bits, hashes, worst, usual):
    """Against the same formula over exact counts, in powers of ten a token: with a filter that is large enough to have no
    false positives, only the rounding of counts is left."""
    if bits:
        monkeypatch.setattr(ngram_lm, "BITS_PER_EVENT", bits)
        monkeypatch.setattr(ngram_lm, "HASHES", hashes)
        monkeypatch.setattr(ngram_lm, "false_rate", lambda rate=ngram_lm.false_rate(): rate)
    tokens, out, counts = exact_model(texts)
    pairs = Counter(p for ws, o in zip(tokens, out) if not o for p in zip(["<start>", *ws[:-1]], ws))
    after = Counter(h for ws, o in zip(tokens, out) if not o for h in ["<start>", *ws[:-1]])
    total, types = sum(counts.values()), len(counts)
    want = []
    for (i, _), ws in zip(texts, tokens):
        chances = [
            (pairs[h, w] + ngram_lm.PRIOR * (counts[w] + 1) / (total + types + 1)) / (after[h] + ngram_lm.PRIOR)
            for h, w in zip(["<start>", *ws[:-1]], ws)
        ]
        want.append((i, len(ws), sum(map(math.log10, chances))))
    got = by_repr((r.doc_id, r.n_tokens, r.score) for r in ngram_lm.score_texts(docs, ngram_lm.learn(docs)).collect())
    for a, b in zip(got, by_repr(want)):
        assert a[:2] == b[:2]
    gaps = np.array([(a[2] - b[2]) / a[1] for a, b in zip(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[2])), sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2])))])
    assert np.abs(gaps).max() < worst and np.abs(gaps).mean() < usual, gaps


def test_small_filter_leaves_out_low_levels(docs):
    model = ngram_lm.learn(docs, filter_bits=1 << 17)
    assert model.cuts[1] > 1
    assert len(model.shared.value[0]) * 8 <= 1 << 17
    assert all(r.score < 0 for r in ngram_lm.score_texts(docs, model).collect())


def test_large_filter_keeps_all_levels(docs, no_docs, monkeypatch):
    """A filter too large to be sent is asked segment by segment: no count is left out and the scores are the same."""
    monkeypatch.setattr(ngram_lm, "SEGMENT_TOKENS", 1 << 10)
    want = by_repr(tuple(r) for r in ngram_lm.score_texts(docs, ngram_lm.learn(docs)).collect())
    monkeypatch.setattr(ngram_lm, "SHARED_BITS", 1 << 10)
    monkeypatch.setattr(ngram_lm, "UNIT_BYTES", 1 << 14)
    model = ngram_lm.learn(docs)
    assert model.cuts == (1, 1) and model.shared.value[0] is None and model.shape.segment_bits > 0
    assert by_repr(tuple(r) for r in ngram_lm.score_texts(docs, model).collect()) == want
    assert ngram_lm.score_texts(no_docs, model).count() == 0


def test_once_seen_bigrams_are_in_the_filter(docs, texts):
    model = ngram_lm.learn(docs)
    learned = [(t or "").encode() for i, t in texts if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    keys, before, _ = ngram_lm.token_keys(learned)
    pairs, n = np.unique(ngram_lm.pair_keys(before, keys), return_counts=True)
    found = ngram_lm.probe(model.shared.value[0], model.shape, pairs, 1)
    assert (n == 1).any() and (found >= ngram_lm.levels(n)).all()
