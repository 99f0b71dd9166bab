"""Quality classifier: a small convolutional network over the bytes of a text, written in numpy.

A filter sees 8 bytes and moves by 4. Filters are max-pooled over chunks of 512 bytes that overlap by half and cover the
whole text; the mean and the maximum over the chunks go through one logistic unit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm.sizes import BATCH_ROWS, small_batches

STEP = 4
WIDTH = 8
HOP = 256  # half a chunk, in bytes
STEPS = HOP // STEP
EMBED = 8
FILTERS = 24
PIECE_HOPS = 2048  # bytes / HOP that go through the filters at once

SAMPLE_PER_CLASS = 2000  # labelled rows that the network is fitted on, at most
SAMPLE_BYTES = 32 << 20  # bytes of such rows of one label, at most: a row that does not fit in whole is not taken
EPOCHS = 10
LEAST_STEPS = 500  # so that a small sample is learned too
BATCH = 32
RATE = 0.004


class Network(NamedTuple):
    embed: np.ndarray  # 256 x EMBED, row 0 stays zero
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # 1


def new_network(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
    embed[0] = 0
    filters = rng.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32)
    weights = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
    return Network(embed, filters, np.zeros(FILTERS, np.float32), weights, np.zeros(1, np.float32))


def padded(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each behind a zero step and filled up with zeros to whole hops, and the hops of each.

    The last filter of a text reaches into the first step of the next, which is that zero step: no filter sees two texts.
    """
    hops = np.array([(len(t) + STEP) // HOP + 1 for t in texts])
    out = np.zeros(int(hops.sum()) * HOP + STEP, np.uint8)
    at = 0
    for text, n in zip(texts, hops, strict=True):
        out[at + STEP : at + STEP + len(text)] = np.frombuffer(text, np.uint8)
        at += int(n) * HOP
    return out, hops


def convolve(net: Network, data: np.ndarray) -> np.ndarray:
    """Filter values at each step: (len(data) - STEP) / STEP rows."""
    half = STEP * EMBED
    seen = net.embed[data].reshape(-1, half)
    return (seen @ net.filters[:half])[:-1] + (seen @ net.filters[half:])[1:]


def hop_values(net: Network, data: np.ndarray) -> Iterator[np.ndarray]:
    """Filter values by hop and step, piece by piece."""
    hops = (len(data) - STEP) // HOP
    for at in range(0, hops, PIECE_HOPS):
        yield convolve(net, data[at * HOP : min(at + PIECE_HOPS, hops) * HOP + STEP]).reshape(-1, STEPS, FILTERS)


def hop_maxima(net: Network, data: np.ndarray) -> np.ndarray:
    """Largest value of each filter in each hop."""
    return np.concatenate([values.max(1) for values in hop_values(net, data)])


def chunk_plan(hops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second hop of every chunk, and where each text's chunks begin. A text of one hop is one chunk."""
    chunks = np.maximum(hops - 1, 1)
    starts = np.cumsum(chunks) - chunks
    first = np.arange(int(chunks.sum())) - np.repeat(starts - (np.cumsum(hops) - hops), chunks)
    second = first + np.repeat(hops > 1, chunks)
    return first, second, starts


def pooled(net: Network, maxima: np.ndarray, hops: np.ndarray) -> np.ndarray:
    first, second, starts = chunk_plan(hops)
    chunks = np.maximum(np.maximum(maxima[first], maxima[second]) + net.bias, 0)
    means = np.add.reduceat(chunks, starts) / np.maximum(hops - 1, 1)[:, None]
    return np.concatenate([means, np.maximum.reduceat(chunks, starts)], 1)


def probabilities(net: Network, texts: Sequence[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    data, hops = padded(texts)
    logits = pooled(net, hop_maxima(net, data), hops) @ net.weights + net.offset
    return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -40, 40)))


def gradients(net: Network, texts: Sequence[bytes], labels: np.ndarray, weights: np.ndarray) -> Network:
    """Gradient of the weighted mean log loss; whole texts, a piece at a time."""
    data, hops = padded(texts)
    best = [(where := values.argmax(1), np.take_along_axis(values, where[:, None], 1)[:, 0]) for values in hop_values(net, data)]
    where, maxima = (np.concatenate(x) for x in zip(*best, strict=True))  # hop x filter
    first, second, starts = chunk_plan(hops)
    n_chunks = np.maximum(hops - 1, 1)
    take_second = maxima[second] > maxima[first]
    chunks = np.maximum(np.maximum(maxima[first], maxima[second]) + net.bias, 0)
    tops = np.maximum.reduceat(chunks, starts)
    features = np.concatenate([np.add.reduceat(chunks, starts) / n_chunks[:, None], tops], 1)
    chance = 1 / (1 + np.exp(-np.clip(features @ net.weights + net.offset, -30, 30)))
    d_logit = ((chance - labels) * weights / len(texts)).astype(np.float32)
    d_features = d_logit[:, None] * net.weights
    of = np.repeat(np.arange(len(texts)), n_chunks)
    top = chunks == tops[of]
    ties = np.add.reduceat(top.astype(np.float32), starts)
    d_chunks = d_features[of, :FILTERS] / n_chunks[of, None] + top * (d_features[:, FILTERS:] / ties)[of]
    d_chunks *= chunks > 0
    d_maxima = np.zeros_like(maxima)
    column = np.broadcast_to(np.arange(FILTERS), d_chunks.shape)
    np.add.at(d_maxima, (np.where(take_second, second[:, None], first[:, None]), column), d_chunks)
    d_filters, d_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
    for at in range(0, len(maxima), PIECE_HOPS):
        own = slice(at, at + PIECE_HOPS)
        begin = (np.arange(at, at + len(where[own]))[:, None] * STEPS + where[own]) * STEP
        seen = data[begin[:, :, None] + np.arange(WIDTH)]  # hop x filter x WIDTH
        looked = net.embed[seen].reshape(*begin.shape, WIDTH * EMBED)
        d_filters += np.einsum("hf,hfk->kf", d_maxima[own], looked)
        np.add.at(d_embed, seen.reshape(-1), (d_maxima[own][:, :, None] * net.filters.T).reshape(-1, EMBED))
    d_embed[0] = 0
    return Network(d_embed, d_filters, d_chunks.sum(0), features.T @ d_logit, d_logit.sum(keepdims=True))


def fit(texts: Sequence[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam over shuffled batches; the same input gives the same network."""
    net, rng = new_network(seed), np.random.default_rng(seed)
    epochs = max(epochs, -(-LEAST_STEPS // -(-len(texts) // BATCH)))
    first, second, t = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net], 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        rate = RATE * (1 - epoch / epochs)
        for at in range(0, len(order), BATCH):
            own, t = order[at : at + BATCH], t + 1
            step = []
            for k, g in enumerate(gradients(net, [texts[i] for i in own], labels[own], weights[own])):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                step.append(rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8))
            net = Network(*((x - s).astype(np.float32) for x, s in zip(net, step, strict=True)))
    return net


def held_out(id_column: str) -> Column:
    """Rows that labels are never learned from: a remainder of the id's checksum. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, most_bytes: int = SAMPLE_BYTES
) -> DataFrame:
    """``doc_id, quality, share, text``: at most ``per_class`` rows of each label, those with the lowest hash of their id,
    with whole texts of together at most ``most_bytes`` a label; a text that would go beyond is passed over.

    ``share`` is the label's number of labelled ids. An id with several labels has the lowest, one with several texts the
    first in order. Only ids, labels and lengths are ordered; the rows chosen are few enough to be sent to every executor,
    so the texts stay where they are.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out("doc_id") & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    totals = known.groupBy("quality").agg(F.count("*").cast("double").alias("share"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).join(F.broadcast(totals), "quality")
    text = F.min(F.coalesce("text", F.lit("")))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality", "share").agg(text.alias("text"))
    sizes = found.select("doc_id", "quality", order.alias("_hash"), F.octet_length("text").alias("_bytes")).collect()
    left, taken = dict.fromkeys((0, 1), most_bytes), []
    for row in sorted(sizes, key=lambda r: (r["_hash"], r["doc_id"])):
        if row["_bytes"] <= left[row["quality"]]:
            left[row["quality"]] -= row["_bytes"]
            taken.append((row["doc_id"],))
    ids = docs.sparkSession.createDataFrame(taken, known.select("doc_id").schema)
    return found.join(F.broadcast(ids), "doc_id")


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, epochs: int = EPOCHS) -> Network:
    """Network fitted on the bounded sample; with no or one label only, one that answers with that label's chance."""
    rows = training_rows(docs, labels, per_class).select("doc_id", "text", "quality", "share").collect()
    rows = sorted((r.doc_id, r.quality, r.share, r.text) for r in rows)
    y = np.array([r[1] for r in rows], np.float32)
    net = new_network()
    if not rows or y.min() == y.max():
        chance = 0.5 if not rows else 0.01 + 0.98 * float(y[0])
        return net._replace(weights=net.weights * 0, offset=np.array([np.log(chance / (1 - chance))], np.float32))
    total = {q: share for _, q, share, _ in rows}
    n = {q: int((y == q).sum()) for q in total}
    # a sampled row stands for as many rows as its label has per sampled row
    weights = np.array([total[q] / n[q] for _, q, _, _ in rows], np.float32)
    # between the labels' true shares and equal ones, so that the rarer label is learned too
    balanced = np.array([1 / n[q] for _, q, _, _ in rows], np.float32)
    weights = weights / weights.mean() + 0.5 * balanced / balanced.mean()
    return fit([r[3].encode() for r in rows], y, weights / weights.mean(), epochs)


def quality_scores(
    docs: DataFrame, network: Network, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: ``<id_column>, held_out, score, predicted``. Only the text is looked at.

    Null and empty texts are one hop of zeros. Ids are passed on as they are, null and repeated ones too; other columns
    are not read; an empty table gives an empty result.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.record_batch([part.column(0), pa.array(probabilities(network, texts), pa.float64())], names=["_id", "score"])

    found = rows.mapInArrow(score, f"_id {id_type}, score double")
    return found.select(
        F.col("_id").alias(id_column),
        held_out("_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, network: Network, threshold: float = 0.7, text_column: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores at least ``threshold``; nothing is shuffled."""
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
                yield part.filter(pa.array(probabilities(network, texts) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
